import datetime as dt


from tallyloom.operators.pivots import dynamic_pivot, milestone_pivot, pivot_width, static_pivot

from conftest import rows


def test_static_pivot_and_unpivot_roundtrip(spark):
    df = spark.createDataFrame([("s1", "A"), ("s1", "A"), ("s1", "B"), ("s2", "C")], "seg string, k string")
    p = static_pivot(df, ["seg"], "k", {"A": "n_a", "B": "n_b", "C": "n_c"})
    assert rows(p, "seg", "n_a", "n_b", "n_c") == [("s1", 2, 1, 0), ("s2", 0, 0, 1)]
    back = p.unpivot("seg", ["n_a", "n_b", "n_c"], "col", "n").filter("n > 0")
    assert sum(r.n for r in back.collect()) == df.count()


def test_dynamic_pivot_width_from_data(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "opp long, pos long, item string")
    assert pivot_width(df, ["opp"]) == 2
    p = dynamic_pivot(df, ["opp"], ["pos"], {"item": "item"})
    assert rows(p, "opp", "item_1", "item_2") == [(1, "x", "y"), (2, "z", None)]
    counted = dynamic_pivot(df, ["opp"], ["pos"], {"item": "item"}, count_as="n")
    assert rows(counted, "opp", "n") == [(1, 2), (2, 1)]
    wide = spark.range(100).selectExpr("0L AS opp", "id AS pos")
    assert len(dynamic_pivot(wide, ["opp"], ["pos"], {"item": "pos"}).columns) == 101


def test_milestone_pivot_repeated_and_unknown(spark):
    t = dt.datetime
    df = spark.createDataFrame([(1, "A", t(2024, 1, 2)), (1, "A", t(2024, 1, 1)), (1, "ZZ", t(2024, 1, 3)),
                                (2, "B", t(2024, 2, 1))], "parent long, code string, done timestamp")
    p = milestone_pivot(df, ["parent"], "code", "done", {"A": "ms_a", "B": "ms_b"})
    assert rows(p, "parent", "ms_a", "ms_b") == [(1, t(2024, 1, 1), None), (2, None, t(2024, 2, 1))]
    assert "ZZ" not in p.columns
