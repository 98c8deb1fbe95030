"""Write semantics without a table format: upsert, soft delete, window replace, snapshots.

Each operator returns the new version of the target as a DataFrame; the
caller writes it to a new path (``sources.tables.write_replace``) so the
version being read is never overwritten.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, is_month_end, lit_date
from .dedup import latest_per_key
from .lookup import check_unique


def _key_cond(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    conds = [(left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k]) for k in keys]
    return reduce(lambda a, b: a & b, conds)


def scd1_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], run_ts,
                update_cols: Sequence[str] | None = None, insert_cols: Sequence[str] | None = None,
                key_defaults: Mapping[str, object] | None = None, null_safe: bool = False,
                dedup_order: Sequence[str] | None = None, loaded_col: str = "loaded_at",
                updated_col: str = "updated_at", action_col: str | None = "_action") -> DataFrame:
    """Type-1 MERGE: matched keys take the source's ``update_cols``, new source keys
    are inserted, target-only keys are kept.

    * ``key_defaults`` replaces NULL keys on both sides before matching (M2);
      otherwise NULL keys never match unless ``null_safe``.
    * ``dedup_order`` first keeps the newest source row per key (M3); without it
      a source that repeats a key is refused (one key-only aggregate), because
      the join would write the key more than once.
    * ``loaded_col``/``updated_col`` are audit columns set from ``run_ts``.

    The merge is a full outer join on the keys.  When the target is stored
    bucketed on them (``sources.tables.write_bucketed``), Spark reads it without
    an exchange and shuffles only the source, so a run moves the changes, not
    the whole dimension.
    """
    keys = list(keys)
    if key_defaults:
        fill = {k: v for k, v in key_defaults.items()}
        target = target.select(*[F.coalesce(F.col(c), F.lit(fill[c])).alias(c) if c in fill else F.col(c)
                                 for c in target.columns])
        source = source.select(*[F.coalesce(F.col(c), F.lit(fill[c])).alias(c) if c in fill else F.col(c)
                                 for c in source.columns])
    if dedup_order:
        source = latest_per_key(source, keys, dedup_order)
    else:
        check_unique(source if null_safe else source.dropna(subset=keys), keys)
    data_cols = [c for c in target.columns if c not in keys and c not in (loaded_col, updated_col)]
    update_cols = list(update_cols) if update_cols is not None else [c for c in data_cols if c in source.columns]
    insert_cols = list(insert_cols) if insert_cols is not None else [c for c in data_cols if c in source.columns]
    run = F.lit(run_ts)

    t = target.withColumn("_tl_t", F.lit(True)).alias("t")
    s = source.select(*keys, *sorted(set(update_cols) | set(insert_cols))).withColumn("_tl_s", F.lit(True)).alias("s")
    j = t.join(s, _key_cond(t, s, keys, null_safe), "full_outer")
    matched = F.col("t._tl_t").isNotNull() & F.col("s._tl_s").isNotNull()
    only_s = F.col("t._tl_t").isNull()

    out = [F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) if not null_safe else
           F.when(only_s, F.col(f"s.{k}")).otherwise(F.col(f"t.{k}")).alias(k) for k in keys]
    for c in data_cols:
        tv = F.col(f"t.{c}")
        if c in update_cols or c in insert_cols:
            sv = F.col(f"s.{c}")
            up = sv if c in update_cols else tv
            ins = sv if c in insert_cols else F.lit(None).cast(target.schema[c].dataType)
            out.append(F.when(matched, up).when(only_s, ins).otherwise(tv).alias(c))
        else:
            out.append(tv.alias(c))
    if loaded_col in target.columns:
        out.append(F.when(only_s, run.cast(target.schema[loaded_col].dataType))
                   .otherwise(F.col(f"t.{loaded_col}")).alias(loaded_col))
    if updated_col in target.columns:
        out.append(F.when(matched | only_s, run.cast(target.schema[updated_col].dataType))
                   .otherwise(F.col(f"t.{updated_col}")).alias(updated_col))
    if action_col:
        out.append(F.when(matched, "update").when(only_s, "insert").otherwise("keep").alias(action_col))
    return j.select(*out)


def flag_soft_deletes(raw: DataFrame, live_keys: DataFrame, key: str, flag_col: str = "deleted",
                      flag_value: str = "1") -> DataFrame:
    """Set ``flag_col`` on rows whose key left the live-key list; a flag is never cleared.

    NULL keys are never flagged (they cannot be looked up).  The live list is
    reduced to distinct keys (map-side) before the join, so duplicates cannot
    multiply raw rows.
    """
    if flag_col not in raw.columns:  # first run: no row has been flagged yet
        raw = raw.withColumn(flag_col, F.lit(None).cast("string"))
    live = live_keys.select(F.col(key)).filter(F.col(key).isNotNull()).distinct().withColumn("_tl_live", F.lit(True))
    j = raw.join(live, key, "left")
    gone = F.col(key).isNotNull() & F.col("_tl_live").isNull()
    return j.withColumn(flag_col, F.when(gone, F.lit(flag_value)).otherwise(F.col(flag_col))).select(*raw.columns)


# Reconciliation status labels (no difference / difference).
RECONCILE_OK, RECONCILE_DIFF = "SIN DIFERENCIA", "CON DIFERENCIA"


def reconcile_counts(raw: DataFrame, live_keys: DataFrame, key: str, flag_col: str = "deleted",
                     ok_label: str = RECONCILE_OK, diff_label: str = RECONCILE_DIFF) -> DataFrame:
    """One row: keys missing from the live list vs rows flagged deleted, with a status."""
    live = live_keys.select(key).distinct()
    missing = raw.join(live, key, "left_anti").select(F.lit("missing").alias("origin"))
    flagged = raw.filter(F.col(flag_col).isNotNull()).select(F.lit("flagged").alias("origin"))
    counts = missing.unionByName(flagged).groupBy().agg(
        F.count(F.when(F.col("origin") == "missing", 1)).alias("missing_keys"),
        F.count(F.when(F.col("origin") == "flagged", 1)).alias("flagged_rows"),
    )
    diff = F.col("missing_keys") - F.col("flagged_rows")
    return counts.select(
        "missing_keys", "flagged_rows", diff.alias("difference"),
        F.when(diff != 0, F.lit(diff_label)).otherwise(F.lit(ok_label)).alias("status"),
    )


def replace_date_window(target: DataFrame, recomputed: DataFrame, date_col: str, start, end) -> DataFrame:
    """Delete target rows with ``start <= date_col <= end`` and insert the recomputed ones.

    Rows outside the window are kept untouched; recomputed rows outside the
    window are ignored.  The window filter is a literal range, so it reaches
    the Parquet scan (and prunes date partitions).  For a month-partitioned
    target, ``sources.tables.replace_months`` rewrites just the window's months.
    """
    lo, hi = lit_date(start), lit_date(end)
    d = F.to_date(F.col(date_col))
    kept = target.filter(~d.between(lo, hi) | F.col(date_col).isNull())
    new = recomputed.filter(d.between(lo, hi)).select(*target.columns)
    return kept.unionByName(new)


def month_end_snapshot(history: DataFrame, current: DataFrame, as_of, stamp_col: str = "snapshot_date") -> DataFrame:
    """Append a copy of ``current`` stamped ``as_of`` only when ``as_of`` is a month end.

    A stamp that ``history`` already holds is replaced, so a second run of the
    same day leaves one copy.
    """
    if not is_month_end(as_of):
        return history
    stamped = current.withColumn(stamp_col, F.lit(as_date(as_of)))
    missing = [c for c in history.columns if c not in stamped.columns]
    if missing:
        raise ValueError(f"snapshot source lacks columns {missing}")
    earlier = history.filter(~F.to_date(F.col(stamp_col)).eqNullSafe(F.lit(as_date(as_of))))
    return earlier.unionByName(stamped.select(*history.columns))


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str, date_col: str | None, action: str,
                    out: str, sentinel="1900-01-01", action_col: str = "action",
                    new_date_col: str = "new_date", override_key: str = "number",
                    flag_out: str | None = None) -> DataFrame:
    """Manual override date beats the source date; a missing source date becomes ``sentinel``.

    ``overrides`` rows whose ``action_col`` contains ``action`` apply; they are
    reduced to one row per key first (newest date wins) so they never repeat
    rows.  With ``date_col=None`` the result is the override date or NULL.
    ``flag_out`` names an optional 0/1 column telling whether an override applied.
    """
    ov = (
        overrides.filter(F.col(action_col).contains(action))
        .groupBy(F.col(override_key).alias("_tl_okey"))
        .agg(F.max(new_date_col).alias("_tl_new"))
    )
    j = df.join(ov, df[key] == ov["_tl_okey"], "left")
    new = F.to_date(F.col("_tl_new"))
    if date_col is None:
        eff = new
    else:
        eff = F.when(new.isNotNull(), new).otherwise(F.coalesce(F.to_date(F.col(date_col)), lit_date(sentinel)))
    j = j.withColumn(out, eff)
    if flag_out:
        j = j.withColumn(flag_out, new.isNotNull().cast("long"))
    return j.drop("_tl_okey", "_tl_new")
