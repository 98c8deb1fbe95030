"""Predicates with the null handling spelled out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def excluded(col, values: Sequence) -> Column:
    """``col NOT IN values OR col IS NULL`` (plain NOT IN drops NULLs)."""
    c = _c(col)
    return ~c.isin(list(values)) | c.isNull()


def live(flag_col: str = "deleted") -> Column:
    """Soft-delete filter: keep rows not flagged deleted."""
    return F.col(flag_col).isNull()


def in_range(col, lo, hi) -> Column:
    """Inclusive range; works on dates and on fixed-width code text (lexical)."""
    return _c(col).between(F.lit(lo), F.lit(hi))
