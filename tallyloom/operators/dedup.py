"""One row per key: latest/first per key, by priority, plain de-duplication.

``latest_per_key`` is an aggregate (``max``/``min`` of a struct whose leading
fields are the order columns), not a window.  Spark runs a maximum over a struct
as a sort aggregate: each task sorts its own rows and combines them before the
shuffle, so a key holding a third of all rows is reduced inside every task
before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = True,
                   cols: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the greatest (or least) by ``order``.

    NULL order values lose when descending and win when ascending (SQL default
    null order).  Remaining ties are broken by the other carried columns, so the
    pick is deterministic.
    """
    keys = list(keys)
    order = list(order)
    cols = [c for c in (cols or df.columns) if c not in keys]
    rest = [c for c in cols if c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    agg = F.max(packed) if descending else F.min(packed)
    picked = df.groupBy(*keys).agg(agg.alias("_pick"))
    return picked.select(
        *keys,
        *[F.col(f"_pick._o{order.index(c)}").alias(c) if c in order else F.col(f"_pick.{c}") for c in cols],
    )


def latest_by_priority(df: DataFrame, keys: Sequence[str], kind_col: str, priorities: Sequence[str],
                       order: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Newest row of the best-ranked kind per key (e.g. purchase, else signup, else view).

    Rows whose kind is not listed are ignored.
    """
    rank = None
    for i, kind in enumerate(priorities):
        cond = F.col(kind_col) == F.lit(kind)
        rank = F.when(cond, F.lit(-i)) if rank is None else rank.when(cond, F.lit(-i))
    cols = list(cols or df.columns)
    ranked = df.filter(F.col(kind_col).isin(list(priorities))).withColumn("_tl_rank", rank)
    out = latest_per_key(ranked, keys, ["_tl_rank", *order], True, cols + ["_tl_rank"])
    return out.drop("_tl_rank")
