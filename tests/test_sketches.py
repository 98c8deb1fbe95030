import datetime as dt

from pyspark.sql import functions as F

from tallyloom.operators.sketches import daily_sketches, distinct_between, merge_sketches, relative_error

from conftest import rows

DAY = dt.date(2024, 1, 1)


def _rows(spark, days, shift=0):
    return spark.range(20000).select((F.col("id") % 3).alias("kind"), F.date_add(F.lit(DAY), (F.col("id") % days).cast("int") + shift).alias("d"),
                                     F.when(F.col("id") % 7 > 0, F.col("id") % 4001).alias("user"))


def test_merged_days_near_the_exact_count(spark, tmp_path):
    old, new = _rows(spark, 10), _rows(spark, 5, shift=8)  # days 8 and 9 come again, changed
    daily_sketches(old, ["kind"], F.col("d"), "user").write.parquet(str(tmp_path / "s"))
    kept = merge_sketches(spark.read.parquet(str(tmp_path / "s")), daily_sketches(new, ["kind"], F.col("d"), "user"), ["kind"])
    union = old.filter(F.datediff("d", F.lit(DAY)) < 8).unionByName(new)
    for start, end in ((None, None), (DAY + dt.timedelta(days=4), DAY + dt.timedelta(days=9))):
        part = union.filter(F.col("d").between(start, end)) if start else union
        exact = {r.kind: (r.n, r.u) for r in part.groupBy("kind").agg(F.count("*").alias("n"), F.countDistinct("user").alias("u")).collect()}
        got = distinct_between(kept, ["kind"], start, end).collect()
        assert {r.kind for r in got} == set(exact)
        for r in got:
            assert r.n_rows == exact[r.kind][0] and abs(r["distinct"] - exact[r.kind][1]) <= relative_error() * exact[r.kind][1]


def test_empty_and_null(spark):
    none = spark.createDataFrame([], "kind int, d date, user long")
    assert distinct_between(daily_sketches(none, ["kind"], F.col("d"), "user"), ["kind"]).collect() == []
    nulls = spark.createDataFrame([(1, DAY, None), (1, DAY, None)], "kind int, d date, user long")
    assert rows(distinct_between(daily_sketches(nulls, ["kind"], F.col("d"), "user"), ["kind"]), "n_rows", "distinct") == [(2, 0)]
