"""Metadata and audit frames: typed schemas and readers (S5, S6).

The warehouse catalog is never crawled live: table, column, option, routine
and audit rows are exported to files and read with an explicit schema, so
the metadata jobs are ordinary Spark plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, L, I, TS, D = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType(), T.DateType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "table_meta": _schema(("dataset", S), ("table", S), ("type", S), ("rows", L), ("bytes", L), ("modified", TS)),
    "column_meta": _schema(("dataset", S), ("table", S), ("column", S), ("position", I), ("is_partition", S),
                           ("cluster_position", I)),
    "partition_meta": _schema(("dataset", S), ("table", S), ("partition_id", S), ("rows", L), ("bytes", L),
                              ("modified", TS)),
    "schemata": _schema(("dataset", S), ("description", S), ("location", S), ("created", TS)),
    "option_meta": _schema(("dataset", S), ("table", S), ("option", S), ("value", S)),
    "routines": _schema(("name", S), ("ddl", S)),
    "read_edges": _schema(("routine", S), ("target", S), ("source", S)),
    "daily_rows": _schema(("table", S), ("day", D), ("rows", L)),
    "descriptions": _schema(("dataset", S), ("table", S), ("column", S), ("description", S)),
    "audit_log": T.StructType([
        T.StructField("timestamp", TS),
        T.StructField("payload", T.StructType([
            T.StructField("method", S),
            T.StructField("user", _schema(("email", S))),
            T.StructField("auth", T.ArrayType(_schema(("resource", S), ("permission", S)))),
            T.StructField("job", T.StructType([
                T.StructField("dest", _schema(("dataset", S), ("table", S))),
                T.StructField("start", TS), T.StructField("end", TS), T.StructField("billed", L)])),
        ])),
    ]),
}


def read_metadata(spark: SparkSession, path: str, kind: str, fmt: str = "parquet") -> DataFrame:
    """Read one exported metadata table with its declared schema (no inference)."""
    return spark.read.schema(SCHEMAS[kind]).format(fmt).load(path)


def empty_metadata(spark: SparkSession, kind: str) -> DataFrame:
    """Typed zero-row frame (S4), e.g. the start of a lineage table."""
    return spark.createDataFrame([], SCHEMAS[kind])
