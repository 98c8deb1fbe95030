"""Aggregations: conditional sums/counts, all/none/some status, level roll-ups, ordered lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def sum_if(cond: Column, value, otherwise=0) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE otherwise END)``."""
    return F.sum(F.when(cond, _c(value)).otherwise(F.lit(otherwise)))


def count_when(cond: Column) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)``."""
    return F.count(F.when(cond, F.lit(1)))


def group_status(cond: Column, all_label: str = "ALL", none_label: str = "NONE", some_label: str = "SOME",
                 none_cond: Column | None = None) -> Column:
    """All / none / some rows of the group satisfy ``cond`` (compare count_if with count).

    With ``none_cond`` the "none" label needs every row to satisfy it (e.g. all
    flags 'N'), so rows with an unknown flag make the group "some".
    """
    hits = F.count_if(cond)
    total = F.count(F.lit(1))
    none = (F.count_if(none_cond) == total) if none_cond is not None else (hits == 0)
    return F.when(hits == total, F.lit(all_label)).when(none, F.lit(none_label)).otherwise(F.lit(some_label))


def level_rollup(df: DataFrame, code_col: str, lengths: Sequence[int], measures: Sequence[str],
                 level_col: str = "level", out_code: str = "code") -> DataFrame:
    """Sum measures at each prefix length of a positional code (F7 + A4).

    The caller's frame should already be aggregated at the finest code, so
    the fan-out to ``len(lengths)`` rows per code happens on reduced data.
    """
    levels = F.explode(F.array(*[
        F.struct(F.lit(i + 1).cast("long").alias(level_col), F.substring(_c(code_col), 1, n).alias(out_code))
        for i, n in enumerate(lengths)
    ])).alias("_tl_lv")
    expanded = df.select(levels, *measures).select(f"_tl_lv.{level_col}", f"_tl_lv.{out_code}", *measures)
    return expanded.groupBy(level_col, out_code).agg(*[F.sum(m).alias(m) for m in measures])


def ordered_distinct_text(col, sep: str = ", ") -> Column:
    """``STRING_AGG(DISTINCT x ORDER BY x)``: set is bounded by distinct values, combined map-side."""
    return F.array_join(F.sort_array(F.collect_set(_c(col))), sep)
