from pyspark.sql import functions as F

from tallyloom.operators.reconcile import differing_leaves, leaf_digests, suspect_rows, table_diff

from conftest import rows

SCHEMA = "id long, name string, amount double, day string"


def test_rows_and_columns_that_differ(spark):
    left = [(k, f"n{k}", float(k), "d") for k in range(500)] + [(1000, None, None, ""), (None, "null key", 1.0, "d")]
    right = list(left)
    right[7] = (7, "other", 7.0, None)
    right[9] = (9, "n9", 10.0, "d")
    del right[20]
    right += [(2000, "new", 1.0, "d")]
    right[-3] = (1000, "", None, None)  # empty text is not NULL, and values do not slide into the next column
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).orderBy(F.rand(3))
    assert rows(table_diff(a, b, ["id"]), "id", "kind", "column", "left_value", "right_value") == sorted([
        (7, "changed", "name", "n7", "other"), (7, "changed", "day", "d", None), (9, "changed", "amount", "9.0", "10.0"),
        (20, "left only", None, None, None), (2000, "right only", None, None, None),
        (1000, "changed", "name", None, ""), (1000, "changed", "day", "", None)], key=repr)


def test_equal_tables_join_nothing(spark):
    a = spark.range(1000).select("id", F.col("id").cast("string").alias("name"))
    b = a.orderBy(F.desc("id")).repartition(3)
    assert differing_leaves(leaf_digests(a, ["id"], ["name"]), leaf_digests(b, ["id"], ["name"])).count() == 0
    assert table_diff(a, b, ["id"]).collect() == []
    assert table_diff(a.limit(0), b.limit(0), ["id"]).collect() == []


def test_only_rows_of_differing_buckets_reach_the_join(spark):
    a = spark.range(4000).select("id", F.lit("x").alias("name"))
    b = a.withColumn("name", F.when(F.col("id") == 17, "y").otherwise("x"))
    leaves = differing_leaves(leaf_digests(a, ["id"], ["name"]), leaf_digests(b, ["id"], ["name"]))
    assert leaves.count() == 1
    assert suspect_rows(a, leaves, ["id"], ["name"]).count() < 10  # 4,000 keys in 2^18 buckets


def test_swapped_rows_are_seen(spark):
    """The same values under other keys, and repeated rows: sums and exclusive ors of whole-row hashes tell them."""
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, name string")
    b = spark.createDataFrame([(1, "y"), (2, "x")], "id long, name string")
    assert table_diff(a, b, ["id"]).count() == 2
