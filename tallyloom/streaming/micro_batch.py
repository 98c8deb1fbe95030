"""Run batch operators on landed rows as they arrive (Structured Streaming).

* ``upsert_stream`` - each micro-batch is merged into the current version of a
  target table with ``scd1_upsert`` and written as a new version
  (``write_replace``), so a failed batch never leaves a half-written target;
  a batch may run again after a failure (at least once): the merge then gives the
  same rows.  Each batch rewrites the target, and old versions stay until removed.
* ``upsert_partitions_stream`` - the same for a target partitioned by columns of
  its key: a batch reads and rewrites only the partitions that its keys are in.
* ``daily_counts_stream`` - rows per (key, local day) with a watermark, the
  streaming form of the daily measure that ``daily_measure_upsert`` merges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import local_time
from ..operators.changes import scd1_upsert
from ..operators.merge import upsert_partitions
from ..session import ensure_checkpoint_dir
from ..sources.tables import read_current, write_replace


def _checkpoint(spark: SparkSession, name: str, location: str | None) -> str:
    return location or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def upsert_stream(stream: DataFrame, target_path: str, keys: Sequence[str], run_ts_col: str,
                  dedup_order: Sequence[str] | None = None, name: str = "upsert",
                  checkpoint_location: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Merge every micro-batch into ``target_path`` (type-1 upsert, new version per batch).

    ``run_ts_col`` names the landing-time column of the stream; its maximum in
    the batch becomes the audit time of the merge.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_ts = batch.agg(F.max(run_ts_col)).first()[0]
        source = batch.drop(run_ts_col)
        target = read_current(spark, target_path)
        merged = scd1_upsert(target, source, keys, run_ts, dedup_order=dedup_order, action_col=None)
        write_replace(merged.select(*target.columns), target_path)

    writer = stream.writeStream.foreachBatch(merge).option(
        "checkpointLocation", _checkpoint(spark, name, checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def upsert_partitions_stream(stream: DataFrame, target_path: str, keys: Sequence[str], partition_by: Sequence[str],
                             run_ts_col: str, dedup_order: Sequence[str] | None = None, fixed: bool | None = None,
                             name: str = "upsert-partitions", checkpoint_location: str | None = None,
                             available_now: bool = True) -> StreamingQuery:
    """Merge every micro-batch into the partitioned table at ``target_path`` with ``merge.upsert_partitions``.

    A batch that runs again after a failure gives the same rows.  See there for ``fixed``.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_ts = batch.agg(F.max(run_ts_col)).first()[0]
        upsert_partitions(batch.sparkSession, target_path, batch.drop(run_ts_col), keys, partition_by, run_ts, dedup_order, fixed)

    writer = stream.writeStream.foreachBatch(merge).option(
        "checkpointLocation", _checkpoint(spark, name, checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def daily_counts_stream(stream: DataFrame, ts_col: str, keys: Sequence[str], zone: str,
                        watermark: str = "2 days") -> DataFrame:
    """Rows per key and local calendar day of a UTC wall-clock timestamp column.

    The watermark needs an instant, so the local wall-clock time is re-read as
    if it were UTC: its UTC day is the local day, and one-day windows then
    align to local midnight.  Rows later than the watermark are dropped by
    Spark; the rest update their day's count.
    """
    session_tz = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    shifted = F.convert_timezone(F.lit("UTC"), F.lit(session_tz), local_time(ts_col, zone)).cast("timestamp")
    start_utc = F.convert_timezone(F.lit(session_tz), F.lit("UTC"), F.col("w.start").cast("timestamp_ntz"))
    return (
        stream.withColumn("_tl_local_ts", shifted)
        .withWatermark("_tl_local_ts", watermark)
        .groupBy(*keys, F.window("_tl_local_ts", "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_events"))
        .select(*keys, F.to_date(start_utc).alias("day"), "n_events")
    )
