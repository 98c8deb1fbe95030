import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.merge import key_bucket, pruned, upsert_partitions
from tallyloom.operators.numbering import stable_keys

from conftest import rows

T1, T2 = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names
            if f.endswith(".parquet")}


def table(spark, path):
    return rows(spark.read.parquet(path), "id", "region", "name", "loaded_at", "updated_at")


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "dim")
    first = spark.createDataFrame([(k, f"r{k % 5}", f"n{k}") for k in range(50)], "id long, region string, name string")
    upsert_partitions(spark, path, first, ["id"], ["region"], T1)
    before = files(path)
    change = spark.createDataFrame([(1, "r1", "new"), (2, "r3", "moved"), (100, "r7", "added")], first.schema)
    parts = upsert_partitions(spark, path, change, ["id"], ["region"], T2)
    assert {r[0] for r in parts} == {"r1", "r2", "r3", "r7"}
    after = files(path)
    for name in ("r0", "r4"):  # the same files, not written again
        kept = {f: t for f, t in before.items() if f"region={name}" in f}
        assert kept and kept == {f: t for f, t in after.items() if f"region={name}" in f}
    want = {k: (k, f"r{k % 5}", f"n{k}", T1, T1) for k in range(50)}
    want |= {1: (1, "r1", "new", T1, T2), 2: (2, "r3", "moved", T1, T2), 100: (100, "r7", "added", T2, T2)}
    assert table(spark, path) == sorted(want.values(), key=repr)
    upsert_partitions(spark, path, change, ["id"], ["region"], T2)  # run again: the same rows
    assert table(spark, path) == sorted(want.values(), key=repr)


def test_untouched_partitions_are_not_scanned(spark, tmp_path):
    path, keys = str(tmp_path / "by-key"), ["id"]
    first = spark.range(200).select("id", F.col("id").cast("string").alias("name")).withColumn("bucket", key_bucket(keys, 16))
    upsert_partitions(spark, path, first, keys, ["bucket"], T1)
    change = first.filter("id = 7").withColumn("name", F.lit("x"))
    parts = upsert_partitions(spark, path, change, keys, ["bucket"], T2, fixed=True)
    assert len(parts) == 1
    old = pruned(spark.read.parquet(path), parts, ["bucket"])
    plan = old._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in filters and str(parts[0][0]) in filters
    read = {r[0].split("bucket=")[1].split("/")[0] for r in old.select(F.input_file_name()).distinct().collect()}
    assert read == {str(parts[0][0])}
    got = {r.id: r.name for r in spark.read.parquet(path).collect()}
    assert got == {k: "x" if k == 7 else str(k) for k in range(200)}


def test_a_partition_left_empty_goes_and_nulls_have_one(spark, tmp_path):
    path = str(tmp_path / "dim")
    first = spark.createDataFrame([(1, "a b/c=1", "x"), (2, None, "y")], "id long, region string, name string")
    upsert_partitions(spark, path, first, ["id"], ["region"], T1)
    upsert_partitions(spark, path, spark.createDataFrame([(1, "q", "z"), (2, "q", "z")], first.schema), ["id"], ["region"], T2)
    assert table(spark, path) == [(1, "q", "z", T1, T2), (2, "q", "z", T1, T2)]
    upsert_partitions(spark, path, spark.createDataFrame([(2, None, "w")], first.schema), ["id"], ["region"], T2)
    assert table(spark, path) == [(1, "q", "z", T1, T2), (2, None, "w", T1, T2)]


def test_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "dim")
    twice = spark.createDataFrame([(1, "a", "old"), (1, "a", "young")], "id long, region string, name string")
    with pytest.raises(Exception, match="unique|repeat|key"):
        upsert_partitions(spark, path, twice, ["id"], ["region"], T1)
    upsert_partitions(spark, path, twice, ["id"], ["region"], T1, dedup_order=["name"])
    assert table(spark, path) == [(1, "a", "young", T1, T1)]


def test_stable_keys(spark, tmp_path):
    path = str(tmp_path / "keys")
    schema = "code string, day int"
    first = spark.createDataFrame([("b", 2), ("a", 5), ("b", 1), (None, 3)], schema)
    got = rows(stable_keys(spark, path, first, ["code"], ["day"]), "code", "day", "id")
    assert got == sorted([("b", 1, 1), ("b", 2, 1), (None, 3, 2), ("a", 5, 3)], key=repr)
    # rows added before and between, others gone, all in another order
    second = spark.createDataFrame([("z", 0), ("a", 9), ("c", 1), (None, 0)], schema)
    assert rows(stable_keys(spark, path, second, ["code"], ["day"]), "code", "id") == sorted(
        [("z", 4), ("c", 5), ("a", 3), (None, 2)], key=repr)
    again = stable_keys(spark, path, first.unionByName(second), ["code"], ["day"])
    assert {(r.code, r.id) for r in again.collect()} == {("b", 1), (None, 2), ("a", 3), ("z", 4), ("c", 5)}
    assert rows(spark.read.parquet(path).agg(F.count("*").alias("n"), F.countDistinct("id").alias("d")), "n", "d") == [(5, 5)]


def test_stable_keys_of_nothing(spark, tmp_path):
    path = str(tmp_path / "keys")
    none = spark.createDataFrame([], "code string")
    assert stable_keys(spark, path, none, ["code"]).collect() == []
    assert rows(stable_keys(spark, path, spark.createDataFrame([("q",)], "code string"), ["code"]), "code", "id") == [("q", 1)]


def test_pruning_by_several_columns_and_many_partitions(spark):
    df = spark.createDataFrame([(k, k % 47 if k % 41 else None, f"m{k % 61}" if k % 7 else None) for k in range(3000)], "k int, a int, b string")
    parts = df.filter("k % 2 = 0").select("a", "b").distinct().collect()
    assert len(parts) > 500
    want = {tuple(p) for p in parts}
    got = pruned(df, parts, ["a", "b"])
    assert {r.k for r in got.collect()} == {r.k for r in df.collect() if (r.a, r.b) in want}
    one = pruned(df, [p for p in parts if p.a is None][:1], ["a", "b"]).collect()
    assert one and all(r.a is None for r in one)
    assert pruned(df, [], ["a", "b"]).count() == 0
    nulls = df.filter("a is null or a = 3").select("a").distinct().collect()
    assert {r.a for r in pruned(df, nulls, ["a"]).collect()} == {None, 3}
