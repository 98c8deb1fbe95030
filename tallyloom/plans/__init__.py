"""Registered queries over the driver tables, each with an equivalent DuckDB SQL oracle.

Every query is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables.
Output conventions shared with the oracle: money is computed in decimal and
shown as a rounded double, dates are ``yyyy-MM-dd`` text, integers are bigint.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

# Fixed run dates: orders run 1995-01-01..2001-08-01, events over January 2024.
AS_OF_ORDERS = "2001-08-31"
AS_OF_EVENTS = "2024-01-31"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its DuckDB SQL oracle."""
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return wrap


def load_all() -> None:
    """Import every plan module so all queries are registered."""
    from . import (  # noqa: F401
        aggregates,
        catalog,
        changes,
        core,
        joins,
        ledger,
        marts,
        metadata,
        opportunity,
        property,
        storage,
        targets,
        texts,
    )
