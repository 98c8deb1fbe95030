import datetime as dt

from tallyloom.operators.dedup import latest_by_priority, latest_per_key

from conftest import rows


def test_latest_per_key_ties_and_nulls(spark):
    df = spark.createDataFrame([
        (1, dt.date(2024, 1, 1), "a"), (1, dt.date(2024, 1, 3), "b"), (1, dt.date(2024, 1, 3), "c"),
        (2, None, "x"), (2, dt.date(2023, 1, 1), "y"), (3, None, "z")], "k long, d date, v string")
    got = rows(latest_per_key(df, ["k"], ["d"]), "k", "v")
    # newest wins, tie broken by the carried column, NULL dates lose when descending
    assert got == [(1, "c"), (2, "y"), (3, "z")]
    first = rows(latest_per_key(df, ["k"], ["d"], descending=False), "k", "v")
    assert first == [(1, "a"), (2, "x"), (3, "z")]  # NULL first when ascending


def test_latest_by_priority(spark):
    df = spark.createDataFrame([
        (1, "view", 5), (1, "signup", 1), (2, "view", 3), (2, "view", 4), (3, "click", 9), (4, "purchase", 1),
        (4, "signup", 8)], "u long, kind string, t long")
    got = rows(latest_by_priority(df, ["u"], "kind", ["purchase", "signup", "view"], ["t"]), "u", "kind", "t")
    assert got == [(1, "signup", 1), (2, "view", 4), (4, "purchase", 1)]
