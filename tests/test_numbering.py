import random

import pandas as pd
from pyspark.sql import functions as F

from tallyloom.operators.numbering import running_number, sequence_in_parent


def _frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # one parent holds a third of all rows; one parent is NULL
        p = 0 if i % 3 == 0 else (None if i % 97 == 0 else rnd.randint(1, 40))
        data.append((i, p, rnd.randint(0, 50), rnd.random()))
    return spark.createDataFrame(data, "id long, p long, v long, w double"), pd.DataFrame(data, columns=["id", "p", "v", "w"])


def _expected(pdf, parent):
    s = pdf.sort_values(["v", "id"], ascending=[False, True], kind="mergesort")
    if parent:
        s = s.assign(_k=s["p"].fillna(-999))
        return dict(zip(s["id"], s.groupby("_k").cumcount() + 1))
    return dict(zip(s["id"], range(1, len(s) + 1)))


def test_running_number_matches_global_sort(spark):
    df, pdf = _frame(spark)
    out = running_number(df, [F.col("v").desc(), F.col("id").asc()], out="rn", partitions=7)
    got = {r.id: r.rn for r in out.select("id", "rn").collect()}
    assert got == _expected(pdf, False)


def test_sequence_in_parent_hot_parent_split(spark):
    df, pdf = _frame(spark)
    want = _expected(pdf, True)
    for hot_rows in (50, 10_000_000):  # hot path (range numbering) and plain window path
        out = sequence_in_parent(df, ["p"], [F.col("v").desc(), F.col("id").asc()], out="seq",
                                 partitions=5, hot_rows=hot_rows)
        got = {r.id: r.seq for r in out.select("id", "seq").collect()}
        assert got == want, hot_rows
        assert out.count() == len(pdf)


def test_running_number_empty_and_single(spark):
    empty = spark.createDataFrame([], "id long")
    assert running_number(empty, ["id"]).count() == 0
    one = spark.createDataFrame([(5,)], "id long")
    assert [r.rn for r in running_number(one, ["id"]).collect()] == [1]


def test_hot_keys_from_upper_bound(spark):
    df, pdf = _frame(spark)
    bound = df.select("p").unionByName(df.select("p"))  # over-counts every key: results must not change
    out = sequence_in_parent(df, ["p"], [F.col("v").desc(), F.col("id").asc()], out="seq", partitions=5,
                             hot_rows=80, hot_keys_from=bound)
    assert {r.id: r.seq for r in out.select("id", "seq").collect()} == _expected(pdf, True)


def test_numbers_do_not_depend_on_the_way(spark):
    df, pdf = _frame(spark)
    for hot_rows in (1, 50, 10**6):  # every parent hot, some, none
        out = sequence_in_parent(df, ["p"], [F.col("v").desc(), F.col("id").asc()], out="seq", partitions=5, hot_rows=hot_rows)
        assert {r.id: r.seq for r in out.select("id", "seq").collect()} == _expected(pdf, True)


def test_default_partitions_left_to_aqe(spark):
    df, pdf = _frame(spark)
    rn = running_number(df, [F.col("v").desc(), F.col("id").asc()], out="rn")
    assert {r.id: r.rn for r in rn.select("id", "rn").collect()} == _expected(pdf, False)
    seq = sequence_in_parent(df, ["p"], [F.col("v").desc(), F.col("id").asc()], out="seq", hot_rows=50)
    assert {r.id: r.seq for r in seq.select("id", "seq").collect()} == _expected(pdf, True)
