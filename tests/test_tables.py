import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.tables import (
    append_rows,
    current_version,
    generate_calendar,
    month_partition,
    read_current,
    read_metadata_of,
    write_replace,
)

from conftest import rows


def test_write_replace_versions_partitions_and_metadata(spark, tmp_path):
    base = str(tmp_path / "fact")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (2, dt.date(2024, 2, 7))], "k long, d date")
    v1 = write_replace(month_partition(df, "d"), base, partition_by=["month"], cluster_by=["k"],
                       metadata={"description": "test fact", "labels": {"tipo": "fact"}})
    assert current_version(spark, base) == v1
    assert rows(read_current(spark, base), "k", "month") == [(1, "2024-01"), (2, "2024-02")]
    assert read_metadata_of(spark, v1)["labels"] == {"tipo": "fact"}
    # a rebuild writes beside the old version; readers of v1 are unaffected
    old = spark.read.parquet(v1)
    v2 = write_replace(df.filter("k = 1"), base)
    assert current_version(spark, base) == v2 and v2 != v1
    assert old.count() == 2 and read_current(spark, base).count() == 1


def test_append_rows_checks_schema_by_name(spark, tmp_path):
    target = str(tmp_path / "hist")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    append_rows(spark.createDataFrame([("x", 1)], "b string, a long"), target, schema)
    append_rows(spark.createDataFrame([("y", 2)], "b string, a long"), target, schema)
    assert rows(spark.read.parquet(target), "a", "b") == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        append_rows(spark.createDataFrame([(3,)], "a long"), target, schema)


def test_generate_calendar_size(spark):
    cal = generate_calendar(spark, "2000-01-01", "2080-12-31")
    assert cal.count() == 29586
    assert cal.agg(F.min("day"), F.max("day")).first() == (dt.date(2000, 1, 1), dt.date(2080, 12, 31))


def test_overwrite_partitions_touches_only_window(spark, tmp_path):
    from tallyloom.operators.changes import replace_date_window
    from tallyloom.sources.tables import overwrite_partitions

    path = str(tmp_path / "fact_m")
    base = spark.createDataFrame([(i, dt.date(2024, m, 10), 1) for i, m in enumerate([1, 2, 3, 4])],
                                 "k long, d date, v long")
    overwrite_partitions(month_partition(base, "d"), path, ["month"])
    new = spark.createDataFrame([(9, dt.date(2024, 2, 20), 5), (8, dt.date(2024, 3, 1), 6)], "k long, d date, v long")
    window = replace_date_window(base.limit(0), new, "d", "2024-02-01", "2024-03-31")
    overwrite_partitions(month_partition(window, "d"), path, ["month"])
    got = rows(spark.read.parquet(path), "month", "k", "v")
    assert got == [("2024-01", 0, 1), ("2024-02", 9, 5), ("2024-03", 8, 6), ("2024-04", 3, 1)]


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    from tallyloom.sources.tables import write_bucketed

    orders = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("c"))
    lines = spark.range(3000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    o = write_bucketed(orders, "tl_test_orders_b", ["k"], 8, str(tmp_path / "ob"))
    li = write_bucketed(lines, "tl_test_lines_b", ["k"], 8, str(tmp_path / "lb"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = li.join(o, "k")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS tl_test_orders_b")
        spark.sql("DROP TABLE IF EXISTS tl_test_lines_b")


def test_write_replace_validation_keeps_old_version(spark, tmp_path):
    from tallyloom.operators.lookup import check_unique

    base = str(tmp_path / "dim_v")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    v1 = write_replace(good, base, validate=lambda d: check_unique(d, ["k"]))
    bad = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(ValueError):
        write_replace(bad, base, validate=lambda d: check_unique(d, ["k"]))
    assert current_version(spark, base) == v1
    assert read_current(spark, base).count() == 2


def test_upsert_into_bucketed_target_shuffles_only_the_source(spark, tmp_path):
    from tallyloom.operators.changes import scd1_upsert
    from tallyloom.sources.tables import write_bucketed

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tgt = write_bucketed(spark.range(2000).select(F.col("id").alias("k"), F.col("id").alias("v")),
                             "tl_test_dim_b", ["k"], 8, str(tmp_path / "dimb"))
        src = spark.range(0, 4000, 7).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
        merged = scd1_upsert(tgt, src, ["k"], dt.datetime(2024, 1, 1), action_col=None)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
        assert merged.count() == 2000 + len(range(2002, 4000, 7))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS tl_test_dim_b")


def test_replace_months_clears_emptied_and_keeps_partial(spark, tmp_path):
    from tallyloom.sources.tables import month_partition, overwrite_partitions, replace_months

    path = str(tmp_path / "fact")
    base = spark.createDataFrame([(1, "2024-01-10"), (2, "2024-02-05"), (3, "2024-02-25"), (4, "2024-03-03"),
                                  (5, "2024-04-01")], "id long, d string").selectExpr("id", "to_date(d) AS d")
    overwrite_partitions(month_partition(base, "d"), path, ["month"])
    new = spark.createDataFrame([(9, "2024-02-20"), (8, "2024-01-01")], "id long, d string").selectExpr("id", "to_date(d) AS d")
    replace_months(new, path, "d", "2024-02-10", "2024-03-31")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 5, 9]


def test_pointer_survives_a_failed_write(spark, tmp_path):
    import os

    from tallyloom.sources.tables import read_current, write_replace

    path = str(tmp_path / "t")
    write_replace(spark.range(2), path)
    os.makedirs(f"{path}/_CURRENT/00000002-broken/_temporary/0")  # a writer that died before it finished
    assert read_current(spark, path).count() == 2
    write_replace(spark.range(5), path)
    assert read_current(spark, path).count() == 5


def test_append_checks_the_targets_schema(spark, tmp_path):
    from tallyloom.sources.tables import append_rows, empty_table

    path = str(tmp_path / "a")
    append_rows(empty_table(spark, "id long, n int"), path)
    append_rows(spark.range(3).selectExpr("1 AS n", "id"), path)
    with pytest.raises(ValueError, match="schema drift"):
        append_rows(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
