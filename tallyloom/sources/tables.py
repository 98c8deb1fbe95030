"""Reading and writing warehouse tables (Parquet), literal and empty frames, calendars.

Writes never overwrite a path that is being read: ``write_replace`` writes a
new version folder and returns it; a small pointer (written by Spark, so any
file system works) names the current one.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Scan one table; Catalyst pushes filters and column pruning into the Parquet reader."""
    path = f"{base.rstrip('/')}/{name}.parquet"
    local = "://" not in base
    if local and not os.path.exists(path) and os.path.isdir(os.path.join(base, name)):
        path = os.path.join(base, name)  # a table folder (e.g. written by write_replace) instead of one file
    return spark.read.parquet(path)


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.orders``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.base, name)
        return self._cache[name]


def literal_rows(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """Hand-kept rows (``INSERT ... VALUES``) as a local relation: the planner knows that it is small."""
    parsed = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    columns = zip(*rows, strict=True) if rows else [[] for _ in parsed]
    table = pa.table([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, parsed, strict=True)],
                     names=parsed.names)
    return spark.createDataFrame(table, parsed)


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """Typed zero-row table."""
    return spark.createDataFrame([], schema)


def generate_calendar(spark: SparkSession, start, end, col: str = "day") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive (parameters, not data)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(_d(start)), F.lit(_d(end)), F.expr("interval 1 day"))).alias(col)
    )


def calendar_between(bounds: DataFrame, start_col: str, end_col: str, col: str = "day") -> DataFrame:
    """Calendar whose range comes from data: ``bounds`` holds one row with two dates."""
    return bounds.select(
        F.explode(F.sequence(F.col(start_col), F.col(end_col), F.expr("interval 1 day"))).alias(col)
    )


def _d(v):
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v))


def cluster(df: DataFrame, cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Cluster-by: co-locate and sort rows on ``cols`` inside each output file."""
    cols = list(cols)
    rep = df.repartition(partitions, *cols) if partitions else df.repartition(*cols)
    return rep.sortWithinPartitions(*cols)


def write_replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
                  metadata: dict | None = None, validate=None) -> str:
    """Full rebuild (``CREATE OR REPLACE TABLE AS``) into a new version folder.

    Returns the version path; a numbered pointer under ``path/_CURRENT`` (written
    by Spark, so any file system works) names it, and the highest complete one
    counts.  Readers of the previous version keep working while the new one is
    written; the pointer is added only after the data is in place and
    ``validate(written_df)`` (if given) has returned without raising, e.g. a
    row-count or key-uniqueness check.  Two writers at once may take the same
    number; then the later version name counts.  ``metadata`` (description,
    labels) is saved beside the data.
    """
    spark = df.sparkSession
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d%H%M%S")
    name = f"v-{stamp}-{uuid.uuid4().hex[:8]}"
    version = f"{path.rstrip('/')}/{name}"
    out = cluster(df, cluster_by) if cluster_by else df
    writer = out.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    if validate is not None:
        validate(spark.read.parquet(version))  # raises: the pointer stays on the previous version
    if metadata:
        import json

        spark.createDataFrame([(json.dumps(metadata, sort_keys=True, default=str),)], "value string") \
            .coalesce(1).write.mode("overwrite").text(f"{version}_meta")
    _point_to(spark, path, name)
    return version


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of every complete pointer; an unfinished write has no part file yet."""
    try:
        rows = spark.read.text(f"{path.rstrip('/')}/_CURRENT/*").collect()
    except AnalysisException:  # no pointer so far
        return []
    return sorted((int(n), name) for n, name in (r[0].split(" ", 1) for r in rows))


def _point_to(spark: SparkSession, path: str, name: str) -> None:
    """Add a pointer with the next number; none is ever changed, so a failed write leaves the last one standing."""
    number = max([n for n, _ in _pointers(spark, path)], default=0) + 1
    spark.createDataFrame([(f"{number} {name}",)], "value string").coalesce(1).write.text(
        f"{path.rstrip('/')}/_CURRENT/{number:08d}-{uuid.uuid4().hex[:8]}")


def current_version(spark: SparkSession, path: str) -> str:
    """Folder of the version that the highest complete pointer names."""
    found = _pointers(spark, path)
    if not found:
        raise FileNotFoundError(f"{path} has no current version")
    return f"{path.rstrip('/')}/{found[-1][1]}"


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """Read the current version of a table written by ``write_replace``."""
    return spark.read.parquet(current_version(spark, path))


def read_metadata_of(spark: SparkSession, version: str) -> dict:
    """Description and labels saved beside a version."""
    import json

    return json.loads(spark.read.text(f"{version}_meta").first()[0])


def month_partition(df: DataFrame, date_col: str, out: str = "month") -> DataFrame:
    """Partition column by month of a date (day partitions over decades make too many files)."""
    return df.withColumn(out, F.date_format(F.col(date_col), "yyyy-MM"))


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str,
                   mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as a catalog table bucketed and sorted on ``keys`` at ``path``.

    Two tables bucketed the same way on the join key are joined without an
    exchange on either side (co-located sort-merge join), which removes the
    largest shuffle of repeated fact-to-fact joins (e.g. lines to orders).
    """
    keys = list(keys)
    (df.write.mode(mode).format("parquet").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite).

    Partitions that ``df`` has no row for stay as they are; to rebuild a date
    window use ``replace_months``, which also clears what became empty.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*partition_by).parquet(path)


def replace_months(recomputed: DataFrame, path: str, date_col: str, start, end, month_col: str = "month") -> None:
    """Rebuild the window ``start..end`` of a table stored by ``month_partition``.

    Only the window's months are read and written.  Rows of a partly covered
    month outside the window are kept, rows of ``recomputed`` outside it are
    ignored, and a month that is left without rows is removed.
    """
    spark, lo, hi = recomputed.sparkSession, _d(start), _d(end)
    months, m = [], lo.replace(day=1)
    while m <= hi:
        months.append(m.strftime("%Y-%m"))
        m = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    inside = F.to_date(F.col(date_col)).between(F.lit(lo), F.lit(hi))
    stored = spark.read.parquet(path)
    stored = stored.withColumn(month_col, F.col(month_col).cast("string")).filter(F.col(month_col).isin(months))
    new = month_partition(recomputed.filter(inside), date_col, month_col).select(*stored.columns)
    # written once before the path it comes from is overwritten
    rows = stored.filter(~F.coalesce(inside, F.lit(False))).unionByName(new).checkpoint(eager=True)
    overwrite_partitions(rows, path, [month_col])
    left = {r[0] for r in rows.select(month_col).distinct().collect()}  # a month list at most
    remove_partitions(spark, path, [Row(**{month_col: m}) for m in months if m not in left])


def remove_partitions(spark: SparkSession, path: str, parts: Sequence[Row]) -> None:
    """Delete partition folders by their values; NULL is the reader's default partition, marks are escaped as the writer does."""
    jvm = spark.sparkContext._jvm
    escape = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for part in parts:
        names = [escape(k, None if v is None else str(v)) for k, v in part.asDict().items()]
        folder = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def append_rows(df: DataFrame, path: str, schema: T.StructType | None = None) -> None:
    """``INSERT INTO ... SELECT`` by column name, after checking the target's schema.

    The schema is read from the target unless given; a first write has none to check.
    """
    if schema is None:
        try:
            schema = df.sparkSession.read.parquet(path).schema
        except AnalysisException:
            schema = df.schema
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if missing or extra:
        raise ValueError(f"schema drift: missing={missing} extra={extra}")
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).write.mode("append").parquet(path)
