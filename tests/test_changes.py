import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.changes import (
    apply_overrides,
    flag_soft_deletes,
    month_end_snapshot,
    reconcile_counts,
    replace_date_window,
    scd1_upsert,
)

from conftest import rows

DIM = "bk long, bk2 string, name string, amount decimal(18,2), loaded_at timestamp, updated_at timestamp"
T0 = dt.datetime(2024, 1, 1)
RUN = dt.datetime(2024, 2, 1)


def _dims(spark):
    target = spark.createDataFrame([
        (1, "a", "one", Decimal("1.00"), T0, T0),      # matched
        (2, "b", "two", Decimal("2.00"), T0, T0),      # target only
        (3, None, "three", Decimal("3.00"), T0, T0),   # null bk2
    ], DIM)
    source = spark.createDataFrame([
        (1, "a", "ONE", Decimal("10.00"), T0, T0),
        (4, "d", "four", Decimal("4.00"), T0, T0),     # insert only
        (3, None, "THREE", Decimal("30.00"), T0, T0),  # null bk2 again
    ], DIM).drop("loaded_at", "updated_at")
    return target, source


def test_scd1_upsert_cases(spark):
    target, source = _dims(spark)
    out = scd1_upsert(target, source, ["bk", "bk2"], RUN)
    got = {(r.bk, r.bk2): (r.name, r._action, r.updated_at) for r in out.collect()}
    assert got[(1, "a")] == ("ONE", "update", RUN)
    assert got[(2, "b")] == ("two", "keep", T0)
    assert got[(4, "d")] == ("four", "insert", RUN)
    # NULL keys never match by default: the source row is inserted beside the target row
    assert rows(out.filter("bk = 3"), "name", "_action") == [("THREE", "insert"), ("three", "keep")]
    safe = scd1_upsert(target, source, ["bk", "bk2"], RUN, null_safe=True)
    assert rows(safe.filter("bk = 3"), "name", "_action") == [("THREE", "update")]
    defaulted = scd1_upsert(target, source, ["bk", "bk2"], RUN, key_defaults={"bk2": "-1"})
    assert rows(defaulted.filter("bk = 3"), "bk2", "name") == [("-1", "THREE")]


def test_scd1_upsert_twice_equals_once(spark):
    target, source = _dims(spark)
    once = scd1_upsert(target, source, ["bk"], RUN, action_col=None)
    twice = scd1_upsert(once, source, ["bk"], RUN, action_col=None)
    assert rows(once) == rows(twice)


def test_dedup_then_upsert(spark):
    target, _ = _dims(spark)
    src = spark.createDataFrame([(1, "a", "old", Decimal("1.00"), T0), (1, "a", "new", Decimal("2.00"), RUN)],
                                "bk long, bk2 string, name string, amount decimal(18,2), ts timestamp")
    out = scd1_upsert(target, src.drop("bk2"), ["bk"], RUN, dedup_order=["ts"],
                      update_cols=["name", "amount"], insert_cols=["name", "amount"])
    assert rows(out.filter("bk = 1"), "name") == [("new",)]


def test_flag_soft_deletes_and_reconcile(spark):
    raw = spark.createDataFrame([(1, "p", None), (2, "q", "1"), (3, "r", None), (None, "s", None), (4, "t", "1")],
                                "id long, payload string, deleted string")
    live = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id long")
    out = flag_soft_deletes(raw, live, "id")
    got = {r.payload: r.deleted for r in out.collect()}
    # 3 left the list; 2 came back but keeps its flag; NULL key is never flagged
    assert got == {"p": None, "q": "1", "r": "1", "s": None, "t": "1"}
    assert out.count() == raw.count()
    rec = reconcile_counts(out, live, "id").first()
    # missing keys: 3, 4 and the NULL key; flagged rows: 2, 3, 4
    assert (rec.missing_keys, rec.flagged_rows, rec.difference, rec.status) == (3, 3, 0, "SIN DIFERENCIA")


def test_replace_date_window_keeps_outside_rows(spark):
    tgt = spark.createDataFrame([(1, dt.date(2024, 1, 31), 1), (2, dt.date(2024, 2, 1), 2), (3, dt.date(2024, 4, 1), 3)],
                                "k long, d date, v long")
    new = spark.createDataFrame([(2, dt.date(2024, 2, 1), 20), (9, dt.date(2023, 1, 1), 99)], "k long, d date, v long")
    out = replace_date_window(tgt, new, "d", "2024-02-01", "2024-03-31")
    assert rows(out, "k", "v") == [(1, 1), (2, 20), (3, 3)]


def test_month_end_snapshot(spark):
    hist = spark.createDataFrame([("x", 1, dt.date(2024, 1, 31))], "seg string, n long, snapshot_date date")
    cur = spark.createDataFrame([("x", 2)], "seg string, n long")
    assert month_end_snapshot(hist, cur, "2024-02-28").count() == 1   # not the month end (leap year)
    assert rows(month_end_snapshot(hist, cur, "2024-02-29"), "n") == [(1,), (2,)]


def test_apply_overrides_both_actions(spark):
    df = spark.createDataFrame([("A1", dt.datetime(2024, 1, 5)), ("A2", None), ("A3", dt.datetime(2024, 3, 1))],
                               "number string, sep timestamp")
    ov = spark.createDataFrame([("A1", "Ventas", dt.date(2024, 2, 2)), ("A1", "Desistimiento", dt.date(2024, 4, 4)),
                                ("A2", "Ventas x", dt.date(2024, 5, 5)), ("A2", "Ventas", dt.date(2024, 6, 6))],
                               "number string, action string, new_date date")
    out = apply_overrides(df, ov, "number", "sep", "Ventas", "eff")
    got = {r.number: r.eff for r in out.collect()}
    assert got == {"A1": dt.date(2024, 2, 2), "A2": dt.date(2024, 6, 6), "A3": dt.date(2024, 3, 1)}
    no_date = apply_overrides(df.withColumn("sep", F.lit(None).cast("timestamp")), ov.limit(0), "number", "sep",
                              "Ventas", "eff")
    assert {r.eff for r in no_date.collect()} == {dt.date(1900, 1, 1)}


def test_invoice_tax_fallback_and_posting(spark):
    from tallyloom.operators.marts import invoice_tax

    D = Decimal
    lines = spark.createDataFrame([
        # invoice A: tax matched by distribution
        ("A", "d1", "r1", None, "ITEM", D("100.00"), "Y"), ("A", "d2", "r1", None, "ITEM", D("50.00"), "Y"),
        ("A", "t1", "r1", "d1", "TAX", D("19.00"), "Y"),
        # invoice B: tax only by receipt (its applies_to matches no distribution)
        ("B", "d3", "r9", None, "ITEM", D("10.00"), "N"), ("B", "t2", "r9", "zz", "TAX", D("1.90"), "N"),
        # invoice C: mixed and unknown posted flags, no tax
        ("C", "d4", "r5", None, "ITEM", D("5.00"), "Y"), ("C", "d5", "r5", None, "ITEM", D("5.00"), None),
        ("D", "d6", "r6", None, "ITEM", D("1.00"), None),
    ], "invoice string, dist string, receipt string, applies_to string, type string, amount decimal(18,2), "
       "posted string")
    got = {r.invoice: (r.net, r.tax, r.total, r.posting_status) for r in invoice_tax(lines).collect()}
    assert got["A"] == (D("150.00"), D("19.00"), D("169.00"), "Contabilizado")
    assert got["B"] == (D("10.00"), D("1.90"), D("11.90"), "No Contabilizado")
    assert got["C"] == (D("10.00"), D("0.00"), D("10.00"), "Contabilizado Parcialmente")
    assert got["D"][3] == "Contabilizado Parcialmente"  # an unknown flag is not "all N"


def test_lookup_many_single_join(spark):
    from tallyloom.operators.lookup import lookup_many

    df = spark.createDataFrame([(1, "10", "20", None), (2, "20", "99", "10")], "id long, a string, b string, c string")
    lk = spark.createDataFrame([("10", "ten"), ("20", "twenty"), ("20", "twenty")], "code string, meaning string")
    got = rows(lookup_many(df, ["a", "b", "c"], lk), "id", "a_name", "b_name", "c_name")
    assert got == [(1, "ten", "twenty", None), (2, "twenty", None, "ten")]


def test_refund_and_second_party(spark):
    from tallyloom.functions.money import refund, second_party

    D = Decimal
    df = spark.createDataFrame([(D("100.00"), D("30.00"), 60, "b1"), (D("10.00"), D("30.00"), 100, "b2"),
                                (None, D("5.00"), None, "b3"), (D("7.00"), None, 40, "b4")],
                               "collected decimal(18,2), penalty decimal(18,2), share int, buyer2 string")
    got = [(r.r, r.b) for r in df.select(refund("collected", "penalty").alias("r"),
                                         second_party("buyer2", "share").alias("b")).collect()]
    assert got == [(D("70.00"), "b1"), (D("0.00"), None), (D("0.00"), "b3"), (D("7.00"), "b4")]


def test_star_join_fan_out_guard(spark):
    import pytest

    from tallyloom.operators.lookup import star_join

    fact = spark.createDataFrame([(1, 10, 100), (2, 20, 100)], "id long, c long, p long")
    cust = spark.createDataFrame([(10, "x"), (20, "y")], "ck long, cname string")
    part = spark.createDataFrame([(100, "a"), (100, "b")], "pk long, pname string")  # not unique: would fan out
    ok = star_join(fact, [(cust, "c", "ck")], check=True)
    assert rows(ok, "id", "cname") == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        star_join(fact, [(cust, "c", "ck"), (part, "p", "pk")], check=True)
    assert star_join(fact, [(part, "p", "pk")]).count() == 4  # unchecked: the fan-out the guard prevents


def test_flag_soft_deletes_first_run_adds_flag(spark):
    raw = spark.createDataFrame([(1, "p"), (2, "q")], "id long, payload string")
    live = spark.createDataFrame([(1,)], "id long")
    out = flag_soft_deletes(raw, live, "id")
    assert out.columns == ["id", "payload", "deleted"]
    assert rows(out, "id", "deleted") == [(1, None), (2, "1")]


def test_upsert_refuses_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    source = spark.createDataFrame([(1, "b"), (1, "c")], "k long, v string")
    with pytest.raises(ValueError, match="not unique"):
        scd1_upsert(target, source, ["k"], "2024-01-01")
    nulls = spark.createDataFrame([(None, "b"), (None, "c")], "k long, v string")  # null keys match nothing: both are inserted
    assert scd1_upsert(target, nulls, ["k"], "2024-01-01").count() == 3


def test_three_part_key_upsert(spark):
    schema = "d string, t string, c string, text string"
    target = spark.createDataFrame([("a", "b", "c", "old"), ("a", "b", "x", "kept")], schema)
    source = spark.createDataFrame([("a", "b", "c", "new"), ("a", "z", "c", "added")], schema)
    got = scd1_upsert(target, source, ["d", "t", "c"], "2024-01-01")
    assert rows(got, "d", "t", "c", "text", "_action") == [
        ("a", "b", "c", "new", "update"), ("a", "b", "x", "kept", "keep"), ("a", "z", "c", "added", "insert")]


def test_snapshot_of_one_day_stays_one_copy(spark):
    current = spark.createDataFrame([("s", 1)], "seg string, n long")
    empty = spark.createDataFrame([], "seg string, n long, snapshot_date date")
    once = month_end_snapshot(empty, current, "2024-01-31")
    twice = month_end_snapshot(once, current, "2024-01-31")
    assert twice.count() == 1
    assert month_end_snapshot(twice, current, "2024-02-29").count() == 2
