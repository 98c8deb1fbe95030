"""Upsert of a partitioned target that reads and rewrites only the partitions it touches.

``changes.scd1_upsert`` gives the whole new target.  ``upsert_partitions`` finds
the partitions that the source's keys are in or go to, merges those alone, and
overwrites them; every other partition is neither read beyond its key columns nor
written.  With the partition columns among the keys, or told by them
(``key_bucket``), the others are not read at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import overwrite_partitions, remove_partitions
from .changes import scd1_upsert
from .dedup import latest_per_key
from .lookup import check_unique

PART = "_tl_part"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A partition number told by the key: 0 to ``buckets`` - 1, the same in every run."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def pruned(target: DataFrame, parts: list, partition_by: Sequence[str]) -> DataFrame:
    """The rows of the listed partitions (rows of partition values): a literal filter, so the others' files are not listed.

    All partitions that share their first columns' values are one IN list, and the
    lists are put together two by two, so a long list makes no deep expression.
    """
    if not parts:
        return target.filter(F.lit(False))
    *leading, last = partition_by
    groups: dict[tuple, list] = {}
    for r in parts:
        groups.setdefault(tuple(r[p] for p in leading), []).append(r[last])
    conds = []
    for values, lasts in groups.items():
        some = [v for v in lasts if v is not None]
        cond = F.col(last).isin(some) if some else F.lit(False)
        if len(some) < len(lasts):
            cond = cond | F.col(last).isNull()
        conds.append(reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(v)) for p, v in zip(leading, values)] + [cond]))
    while len(conds) > 1:
        conds = [a | b for a, b in zip(conds[::2], conds[1::2])] + conds[len(conds) // 2 * 2:]
    return target.filter(conds[0])


def touched_partitions(target: DataFrame | None, source: DataFrame, keys: Sequence[str],
                       partition_by: Sequence[str], fixed: bool) -> list:
    """Partition values that the source's rows go to, and unless ``fixed`` those that hold their keys now.

    The second part reads the target's key and partition columns only, in a semi
    join with the source's keys.  Both lists are as long as there are partitions.
    """
    found = source.select(*partition_by)
    if target is not None and not fixed:
        found = found.unionByName(target.select(*{*keys, *partition_by}).join(
            source.select(*keys), list(keys), "left_semi").select(*partition_by))
    return found.distinct().collect()


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str],
                      run_ts, dedup_order: Sequence[str] | None = None, fixed: bool | None = None,
                      update_cols: Sequence[str] | None = None, insert_cols: Sequence[str] | None = None,
                      loaded_col: str = "loaded_at", updated_col: str = "updated_at") -> list:
    """Type-1 merge of ``source`` into the table at ``path``, partitioned by ``partition_by``; returns the touched partitions.

    * ``source`` has the keys, the partition columns and the columns to set; a first
      run creates the table from it.
    * ``dedup_order`` keeps the newest row per key; without it repeated keys are refused.
    * ``fixed`` says that a key never changes its partition: true when the partition
      columns are keys, or a function of them.  Otherwise a row whose partition
      changed is taken out of the old one, which is rewritten too.
    * A failed run leaves the table as it was (files are moved when the job commits);
      a run repeated with the same source gives the same rows.  One writer at a time.
    """
    keys, partition_by = list(keys), list(partition_by)
    fixed = set(partition_by) <= set(keys) if fixed is None else fixed
    if dedup_order:
        source = latest_per_key(source, keys, dedup_order)
    source = source.checkpoint(eager=True)  # read for the partitions and for the merge
    if not dedup_order:
        check_unique(source, keys)
    try:
        target = spark.read.parquet(path)
    except AnalysisException:
        target = None
    parts = touched_partitions(target, source, keys, partition_by, fixed)
    if target is None:
        run = F.lit(run_ts)
        overwrite_partitions(source.withColumns({loaded_col: run, updated_col: run}), path, partition_by)
        return parts
    for p in partition_by:  # as stored: the reader tells a partition column's type from its folder names
        source = source.withColumn(p, F.col(p).cast(target.schema[p].dataType))
    old = pruned(target, parts, partition_by)
    update = [c for c in target.columns if c in source.columns and c not in keys] if update_cols is None else \
        [*update_cols, *(p for p in partition_by if p not in keys)]
    insert = update if insert_cols is None else [*insert_cols, *(p for p in partition_by if p not in keys)]
    merged = scd1_upsert(old, source, keys, run_ts, update, insert, loaded_col=loaded_col, updated_col=updated_col,
                         null_safe=True, action_col=None)
    # written once before the partitions it comes from are overwritten
    rows = merged.select(*target.columns).checkpoint(eager=True)
    overwrite_partitions(rows, path, partition_by)
    if not fixed:
        left = {tuple(r) for r in rows.select(*partition_by).distinct().collect()}
        remove_partitions(spark, path, [r for r in parts if tuple(r) not in left])
    return parts
