"""Row numbers without a single-task window.

``ROW_NUMBER() OVER (PARTITION BY p ORDER BY o)`` sends every row of a parent
to one task; over a whole table (no ``p``), or for a parent holding a third
of all rows, that task holds everything.  ``sequence_number`` therefore:

1. counts rows per parent (a map-side combined aggregate over the key columns
   only) and takes the *hot* parents above ``hot_rows`` -- at most
   ``rows / hot_rows`` keys; the planner broadcasts the list if it is small;
2. numbers ordinary parents with the plain window (each window <= ``hot_rows``);
3. numbers hot parents (and whole-table numbering) by range-partitioning on
   ``(parent, order)`` so one parent spans many tasks; each task knows its
   rows' positions, and a table with one row per (partition, hot parent)
   supplies the count of that parent's rows in earlier partitions.

Both ways number by the same total order, so a parent's size changes the plan
and never the numbers: ``order`` must end in columns that tell rows apart.

All steps are JVM-side DataFrame operations.

A running number is a fact of one run: rows added before a row change it.
``stable_keys`` keeps numbers in a key map instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import append_rows

_PID, _POS = "_tl_pid", "_tl_pos"
DEFAULT_HOT_ROWS = 1_000_000


def _sort_cols(order: Sequence) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def _range_numbered(df: DataFrame, parent: list[str], order: Sequence, out: str, partitions: int | None) -> DataFrame:
    """Number rows by range partitioning on (parent, order) plus an offset table with one
    row per (partition, parent): at most partitions + parents in ``df``.

    Without an explicit ``partitions`` the range exchange is left to AQE, which may
    merge adjacent (still ordered) ranges into right-sized partitions.
    """
    sort_cols = [F.col(p).asc_nulls_first() for p in parent] + _sort_cols(order)
    pkey = F.struct(*[F.col(p) for p in parent]) if parent else F.struct(F.lit(0).alias("k"))
    ranged_in = df.repartitionByRange(partitions, *sort_cols) if partitions else df.repartitionByRange(*sort_cols)
    ranged = (
        ranged_in
        .sortWithinPartitions(*sort_cols)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33))
        .withColumn("_tl_pkey", pkey)
    )
    # read twice (stats and numbering): written once to the shared checkpoint folder, so both see
    # the same positions and a lost executor loses nothing
    ranged = ranged.checkpoint(eager=True)
    # one row per (partition, parent): first position there and row count
    stats = ranged.groupBy(_PID, "_tl_pkey").agg(F.min(_POS).alias("_tl_first"), F.count(F.lit(1)).alias("_tl_n"))
    before = Window.partitionBy("_tl_pkey").orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_tl_offset", F.coalesce(F.sum("_tl_n").over(before), F.lit(0))).drop("_tl_n")
    numbered = ranged.join(offsets, [_PID, "_tl_pkey"]).withColumn(
        out, (F.col(_POS) - F.col("_tl_first") + 1 + F.col("_tl_offset")).cast("long"))
    return numbered.drop(_PID, _POS, "_tl_pkey", "_tl_first", "_tl_offset")


def sequence_number(df: DataFrame, order: Sequence, parent: Sequence[str] | None = None, out: str = "rn",
                    partitions: int | None = None, hot_rows: int = DEFAULT_HOT_ROWS,
                    max_group_rows: int | None = None, hot_keys_from: DataFrame | None = None) -> DataFrame:
    """1-based ``row_number`` over ``order``, restarting per ``parent`` columns.

    ``order`` holds column names (ascending, nulls first) or sort Columns such as
    ``F.col('x').desc()``; it must be a total order of a parent's rows (append
    unique columns).  Rows equal in every order column are interchangeable.
    ``max_group_rows``, when the caller already knows the largest parent size,
    skips the hot-parent count.  ``hot_keys_from`` is a cheaper frame with the
    parent columns whose per-key counts bound the input's (e.g. the base table
    when later steps only filter or join one-to-one); keys are counted there.
    Over-counting only routes a key to the range path; results are the same.
    """
    parent = list(parent or [])
    n = partitions  # None: spark.sql.shuffle.partitions ranges, coalescible by AQE
    if not parent:
        return _range_numbered(df, [], order, out, n)

    window = Window.partitionBy(*parent).orderBy(*_sort_cols(order))
    if max_group_rows is not None and max_group_rows <= hot_rows:
        return df.withColumn(out, F.row_number().over(window).cast("long"))
    # key-only count: Catalyst prunes the scan to the parent columns; the input is
    # recomputed rather than cached (caching a wide input measured slower than re-reading it)
    source = hot_keys_from if hot_keys_from is not None else df
    counts = source.groupBy(*parent).agg(F.count(F.lit(1)).alias("_tl_cnt"))
    hot = counts.filter(F.col("_tl_cnt") > hot_rows).select(*parent)
    n_hot = hot.count()
    if n_hot == 0:
        return df.withColumn(out, F.row_number().over(window).cast("long"))
    hot_keys = [f"_tl_h{i}" for i in range(len(parent))]
    hot_b = hot.select(*[F.col(p).alias(h) for p, h in zip(parent, hot_keys)]).withColumn("_tl_hot", F.lit(True))
    cond = [F.col(p).eqNullSafe(F.col(h)) for p, h in zip(parent, hot_keys)]
    tagged = df.join(hot_b, cond, "left").drop(*hot_keys)
    cold = tagged.filter(F.col("_tl_hot").isNull()).drop("_tl_hot")
    warm = tagged.filter(F.col("_tl_hot").isNotNull()).drop("_tl_hot")
    cold_n = cold.withColumn(out, F.row_number().over(window).cast("long"))
    warm_n = _range_numbered(warm, parent, order, out, n)
    return cold_n.unionByName(warm_n)


def running_number(df: DataFrame, order: Sequence, out: str = "rn", partitions: int | None = None) -> DataFrame:
    """Whole-table running key ``ROW_NUMBER() OVER (ORDER BY order)`` without a one-task sort."""
    return sequence_number(df, order, None, out, partitions)


def sequence_in_parent(df: DataFrame, parent: Sequence[str], order: Sequence, out: str = "seq",
                       partitions: int | None = None, hot_rows: int = DEFAULT_HOT_ROWS,
                       max_group_rows: int | None = None, hot_keys_from: DataFrame | None = None) -> DataFrame:
    """Instalment/slot number inside a parent (W3), safe when one parent is huge."""
    return sequence_number(df, order, parent, out, partitions, hot_rows, max_group_rows, hot_keys_from)


def stable_keys(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], order: Sequence | None = None,
                out: str = "id") -> DataFrame:
    """``rows`` with a surrogate number per business key that later runs keep.

    The key map at ``path`` holds (keys, ``out``).  Keys not in it get the numbers
    above its highest, in ``order`` (columns of ``rows``; a key's least value counts,
    then the key itself), and are appended; known keys keep theirs, whatever rows
    come, go or move.  NULL is a key value like any other.  Only unseen keys are
    sorted, over many tasks.  A failed run appends nothing; one writer at a time.
    """
    keys = list(keys)
    order = [o for o in (order or []) if o not in keys]
    try:
        known = spark.read.parquet(path)
        highest = known.agg(F.max(out)).first()[0] or 0
    except AnalysisException:  # first run
        known, highest = None, 0
    fresh = rows.groupBy(*keys).agg(*[F.min(o).alias(o) for o in order], F.count(F.lit(1)).alias("_tl_n"))
    if known is not None:
        fresh = fresh.join(known.select(*[F.col(k).alias(f"_tl_{k}") for k in keys]),
                           [F.col(k).eqNullSafe(F.col(f"_tl_{k}")) for k in keys], "left_anti")
    numbered = running_number(fresh, [*order, *keys], out)
    added = numbered.select(*keys, (F.col(out) + F.lit(highest)).alias(out))
    append_rows(added, path)
    named = spark.read.parquet(path).select(*[F.col(k).alias(f"_tl_{k}") for k in keys], out)
    return rows.join(named, [F.col(k).eqNullSafe(F.col(f"_tl_{k}")) for k in keys]).drop(*[f"_tl_{k}" for k in keys])
