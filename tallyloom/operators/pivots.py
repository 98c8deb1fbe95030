"""Pivots: static (known values), dynamic (width from data), milestone (code -> date column).

All three are conditional aggregations (``max(when(k == v, x))``), so they
combine map-side like any hash aggregate and never gather a group in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbering import sequence_in_parent


def static_pivot(df: DataFrame, group: Sequence[str], key: str, values: Mapping[str, str] | Sequence[str],
                 agg: str = "count", value_col: str | None = None, fill=None,
                 extra_aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """One column per listed ``key`` value.  ``values`` maps value -> output column name.

    ``agg`` is ``count``, ``sum``, ``max`` or ``min`` over ``value_col``;
    ``extra_aggs`` (name -> aggregate) are computed in the same pass.
    """
    names = values if isinstance(values, Mapping) else {v: str(v) for v in values}
    cols = []
    for v, name in names.items():
        hit = F.col(key) == F.lit(v)
        if agg == "count":
            c = F.count(F.when(hit, F.lit(1)))
        else:
            fn = {"sum": F.sum, "max": F.max, "min": F.min}[agg]
            c = fn(F.when(hit, F.col(value_col)))
            if fill is not None:
                c = F.coalesce(c, F.lit(fill))
        cols.append(c.alias(name))
    cols += [a.alias(n) for n, a in (extra_aggs or {}).items()]
    return df.groupBy(*group).agg(*cols)


def pivot_width(df: DataFrame, group: Sequence[str]) -> int:
    """Largest group size (one scalar to the driver)."""
    return int(df.groupBy(*group).count().agg(F.max("count")).first()[0] or 0)


def dynamic_pivot(df: DataFrame, group: Sequence[str], order: Sequence, attributes: Mapping[str, Column | str],
                  fill: Mapping[str, object] | None = None, width: int | None = None,
                  count_as: str | None = None) -> DataFrame:
    """Attributes of each group's rows as numbered columns ``<attr>_1 .. <attr>_n``.

    Rows are numbered inside their group by ``order`` (skew-safe numbering), the
    width ``n`` is the largest group size (computed here unless the caller
    already holds it), then every slot is a conditional max; ``count_as`` adds
    the group's size.  The width follows the data without a cap: for groups of
    very many rows keep the numbered rows (``sequence_in_parent``) instead.
    """
    if width is None:
        width = pivot_width(df, group)
    numbered = sequence_in_parent(df, group, order, out="_tl_slot", max_group_rows=width)
    fill = fill or {}
    cols = [F.max("_tl_slot").alias(count_as)] if count_as else []
    for i in range(1, width + 1):
        for name, expr in attributes.items():
            e = F.col(expr) if isinstance(expr, str) else expr
            c = F.max(F.when(F.col("_tl_slot") == i, e))
            if name in fill:
                c = F.coalesce(c, F.lit(fill[name]))
            cols.append(c.alias(f"{name}_{i}"))
    return numbered.groupBy(*group).agg(*cols)


def milestone_pivot(df: DataFrame, parent: Sequence[str], code_col: str, date_col: str,
                    codes: Mapping[str, str] | Sequence[str], first: bool = True) -> DataFrame:
    """First (or last) date of each milestone code per parent; unknown codes are ignored,
    repeated codes reduce to one date."""
    names = codes if isinstance(codes, Mapping) else {c: c for c in codes}
    fn = F.min if first else F.max
    return df.groupBy(*parent).agg(*[fn(F.when(F.col(code_col) == F.lit(c), F.col(date_col))).alias(n)
                                     for c, n in names.items()])
