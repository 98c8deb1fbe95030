import datetime as dt

from pyspark.sql import functions as F

from tallyloom.operators.catalog import (
    data_dictionary,
    lineage_closure,
    lineage_detail,
    partition_cluster_profile,
    table_monitor,
)
from tallyloom.sources.metadata import SCHEMAS, empty_metadata, read_metadata

from conftest import rows


def test_partition_cluster_profile_none_partitioned(spark):
    cols = spark.createDataFrame([
        ("DS", "T1", "a", 1, "YES", None), ("DS", "T1", "b", 2, "NO", 1), ("DS", "T1", "c", 3, "NO", 2),
        ("DS", "T2", "x", 1, "NO", None)], SCHEMAS["column_meta"])
    got = rows(partition_cluster_profile(cols), "table", "n_columns", "n_partition_columns", "partition_column",
               "cluster_1", "cluster_2", "cluster_3")
    assert got == [("T1", 3, 1, "a", "b", "c", None), ("T2", 1, 0, None, None, None, None)]


def test_data_dictionary(spark):
    cols = spark.createDataFrame([("DS", "T", "a", 1, "NO", None), ("DS", "T", "b", 2, "NO", None)],
                                 SCHEMAS["column_meta"])
    desc = spark.createDataFrame([("DS", "T", "a", "first"), ("DS", "U", "a", "other table")],
                                 SCHEMAS["descriptions"])
    out = data_dictionary(cols, desc)
    assert rows(out, "column", "description") == [("a", "first"), ("b", None)]
    assert out.select(F.countDistinct("sk_column")).first()[0] == 2


def test_lineage_detail_and_monitor(spark):
    edges = spark.createDataFrame([("M.A", "M.B"), ("M.B", "RAW.X"), ("M.A", "RAW.Y"), ("M.C", "M.D")],
                                  "src string, dst string")
    starts = spark.createDataFrame([("M.A",), ("M.C",)], "start string")
    fresh = spark.createDataFrame([("RAW.X", dt.datetime(2024, 1, 2)), ("RAW.Y", None)],
                                  "table string, modified timestamp")
    detail = lineage_detail(lineage_closure(edges, starts), fresh)
    assert rows(detail, "start", "node", "source_modified") == [
        ("M.A", "RAW.X", dt.datetime(2024, 1, 2)), ("M.A", "RAW.Y", None)]
    tables = spark.createDataFrame([("M.A",), ("M.C",)], "start string")
    mon = rows(table_monitor(tables, detail), "start", "sources", "oldest_source")
    # an unknown (NULL) change date counts as the oldest; a table without raw sources keeps its row
    assert mon == [("M.A", "RAW.X, RAW.Y", "RAW.Y"), ("M.C", None, None)]


def test_read_metadata_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("DS", "T", "BASE TABLE", 10, 2048, dt.datetime(2024, 1, 1))], SCHEMAS["table_meta"])
    df.write.mode("overwrite").json(str(tmp_path / "tm"))
    back = read_metadata(spark, str(tmp_path / "tm"), "table_meta", fmt="json")
    assert back.schema == SCHEMAS["table_meta"] and back.count() == 1
    assert empty_metadata(spark, "routines").count() == 0


def test_partition_sizes_profile(spark):
    from tallyloom.operators.catalog import table_profile

    parts = spark.createDataFrame([
        ("DS", "T", "202401", 10, 5 * 1024, dt.datetime(2024, 1, 31)),
        ("DS", "T", "202402", 20, 3 * 1024 * 1024, dt.datetime(2024, 2, 29)),
        ("DS", "T", "__NULL__", 0, 0, None)], SCHEMAS["partition_meta"])
    got = rows(table_profile(parts, "bytes"), "partition_id", "size_label")
    assert got == [("202401", "5 KB"), ("202402", "3 MB"), ("__NULL__", "0 KB")]
    assert empty_metadata(spark, "schemata").columns == ["dataset", "description", "location", "created"]
