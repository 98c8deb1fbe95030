import datetime as dt
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F

from tallyloom.operators.ledger import balances_with_history, nonzero, period_balances, split_history, spread_label

from conftest import rows

D = Decimal


def _lines(spark):
    data = [
        ("4100000000", dt.date(2022, 11, 5), D("100.00"), D("0")),   # result account: restarts each year
        ("4100000000", dt.date(2023, 2, 10), D("50.00"), D("20.00")),
        ("1100000000", dt.date(2022, 10, 1), D("10.00"), D("0")),    # balance account: accumulates
        ("1100000000", dt.date(2022, 12, 31), D("0"), D("10.00")),   # sums to 0
        ("1100000000", dt.date(2023, 3, 15), D("0.10"), D("0")),
    ]
    return spark.createDataFrame(data, "account string, d date, debit decimal(18,2), credit decimal(18,2)")


def restart():
    return F.col("account").between("4000000000", "6999999999")


def _brute(pdf, as_of):
    """The rule as stated: a range join of movements to every period, in pandas."""
    out = []
    months = pd.period_range(pdf.d.min(), as_of, freq="M")
    for acc, g in pdf.groupby("account"):
        restart = "4000000000" <= acc <= "6999999999"
        for m in months:
            ps, pe = m.start_time.date(), m.end_time.date()
            lo = dt.date(ps.year, 1, 1) if restart else dt.date(1900, 1, 1)
            sel = g[(g.d >= lo) & (g.d <= pe)]
            if sel.empty:
                continue
            before = sel[sel.d < ps]
            inside = sel[sel.d >= ps]
            mv = lambda x: sum(x.debit) - sum(x.credit)
            out.append((acc, ps, mv(before), sum(inside.debit, D(0)), sum(inside.credit, D(0)), mv(inside), mv(sel)))
    return sorted(out, key=repr)


def test_running_form_matches_range_rule(spark):
    lines = _lines(spark)
    got = rows(period_balances(lines, ["account"], "d", "debit", "credit", "2023-04-30", restart()),
               "account", "period", "opening", "debit", "credit", "movement", "closing")
    want = _brute(lines.toPandas(), dt.date(2023, 4, 30))
    assert [tuple(x) for x in got] == [tuple(x) for x in want]


def test_closing_equals_next_opening(spark):
    bal = period_balances(_lines(spark), ["account"], "d", "debit", "credit", "2023-04-30", restart()).toPandas()
    for acc, g in bal.sort_values("period").groupby("account"):
        g = g.reset_index(drop=True)
        for i in range(len(g) - 1):
            same_year = g.period[i].year == g.period[i + 1].year
            if acc.startswith("1") or same_year:
                assert g.closing[i] == g.opening[i + 1]


def test_history_union_equals_full_computation(spark):
    lines = _lines(spark)
    full = nonzero(period_balances(lines, ["account"], "d", "debit", "credit", "2023-04-30", restart()))
    closed, current = split_history(lines, "d", "2023-04-30")
    assert closed.count() + current.count() == lines.count()
    history = period_balances(closed, ["account"], "d", "debit", "credit", "2022-12-31", restart())
    both = balances_with_history(current, history, ["account"], "d", "debit", "credit", "2023-04-30", restart())
    assert rows(full) == rows(both)
    # movements of closed years among the current ones are not counted twice
    again = balances_with_history(lines, history, ["account"], "d", "debit", "credit", "2023-04-30", restart())
    assert rows(full) == rows(again)


def test_current_year_cut_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    _, current = split_history(orders, "o_orderdate", "2001-08-31")
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_spread_label(spark):
    df = spark.createDataFrame([("n1", "A"), ("n1", "B"), ("n2", "C")], "nit string, name string")
    assert rows(spread_label(df, ["nit"], "name", "label"), "nit", "name", "label") == [
        ("n1", "A", "B"), ("n1", "B", "B"), ("n2", "C", "C")]
