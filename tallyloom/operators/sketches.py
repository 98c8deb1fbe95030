"""Distinct counts that can be merged: sketch columns kept per day and key.

A distinct count of a month is not the sum of its days' counts, and counting it
again reads the month again.  A sketch is a few kilobytes, and the union of the
days' sketches is the month's: history keeps sketches, a new day adds its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12  # 2^12 registers


def relative_error(lg_k: int = LG_K) -> float:
    """Three standard errors of an estimate: about 0.833 / sqrt(2^lg_k) each."""
    return 3 * 0.833 / 2 ** (lg_k / 2)


def daily_sketches(rows: DataFrame, keys: Sequence[str], day: Column, value: str, lg_k: int = LG_K) -> DataFrame:
    """(keys, day, rows, sketch) per key and day; NULL values count as rows and not as values."""
    return rows.groupBy(*keys, day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(value, lg_k).alias("sketch"))


def merge_sketches(stored: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """History with the days of ``fresh`` in place of its own; no row that was counted is read again."""
    days = fresh.select("day").distinct()
    return stored.join(days, "day", "left_anti").select(fresh.columns).unionByName(fresh)


def distinct_between(sketches: DataFrame, keys: Sequence[str], start=None, end=None) -> DataFrame:
    """(keys, n_rows, distinct) over the days from ``start`` to ``end``, both included: the union of their sketches."""
    if start is not None:
        sketches = sketches.filter(F.col("day") >= F.lit(start))
    if end is not None:
        sketches = sketches.filter(F.col("day") <= F.lit(end))
    return sketches.groupBy(*keys).agg(F.sum("n_rows").alias("n_rows"),
                                       F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))
