import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.ledger import nonzero
from tallyloom.operators.periods import (
    balances_any_with_history,
    interval_join,
    period_balances_any,
    week_period_rows,
    week_periods,
)

from conftest import rows

D = dt.date
LINES = "account string, d date, debit decimal(18,2), credit decimal(18,2)"
PERIODS = "period string, start date, end date, year_start date"


def brute(lines, periods, as_of, restarts, floor=None):
    """The rule as stated: every movement against every period."""
    out = {}
    for account, d, debit, credit in lines:
        for name, ps, pe, ys in periods:
            if d is None or d > as_of or pe > as_of or (floor and (ps < floor or d < floor)):
                continue
            if d > pe or (restarts(account) and d < ys):
                continue
            x = out.setdefault((account, name), [0, 0, 0])
            if d < ps:
                x[0] += debit - credit
            else:
                x[1], x[2] = x[1] + debit, x[2] + credit
    return sorted(((*k, o, a, c, a - c, o + a - c) for k, (o, a, c) in out.items()), key=repr)


def random_lines(seed, n=300):
    r = random.Random(seed)
    day = lambda: D(2020, 1, 1) + dt.timedelta(days=r.randrange(900))
    return [(r.choice(["1A", "1B", "4A", None]), r.choice([day(), day(), None]) if k % 50 == 0 else day(),
             Decimal(r.randrange(1000)), Decimal(r.randrange(1000))) for k in range(n)]


CASES = {
    "weeks": week_period_rows("2020-02-03", 2),
    "adjusted": week_period_rows("2020-02-03", 2, adjustment=True),
    "gaps and overlaps": [("a", D(2020, 3, 1), D(2020, 5, 31), D(2020, 3, 1)), ("b", D(2020, 5, 1), D(2020, 7, 15), D(2020, 3, 1)),
                          ("c", D(2020, 9, 1), D(2021, 2, 28), D(2020, 3, 1)), ("d", D(2021, 1, 10), D(2021, 1, 10), D(2021, 1, 1))],
    "none": [],
}


@pytest.mark.parametrize("floor", [None, D(2020, 6, 1)])
@pytest.mark.parametrize("name", sorted(CASES))
def test_any_periods_match_the_rule(spark, name, floor):
    lines, as_of = random_lines(7), D(2022, 1, 15)
    got = period_balances_any(spark.createDataFrame(lines, LINES), spark.createDataFrame(CASES[name], PERIODS), ["account"], "d",
                              "debit", "credit", as_of, F.col("account").startswith("4"), floor)
    want = brute(lines, CASES[name], as_of, lambda a: bool(a) and a.startswith("4"), floor)
    assert rows(got, "account", "period", "opening", "debit", "credit", "movement", "closing") == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_empty_lines(spark):
    got = period_balances_any(spark.createDataFrame([], LINES), week_periods(spark, "2020-02-03", 1), ["account"], "d", "debit", "credit",
                              "2022-01-15")
    assert got.collect() == []


def test_week_periods():
    got = week_period_rows("2020-02-03", 2, adjustment=True)
    assert len(got) == 26
    days = [(e - s).days + 1 for n, s, e, _ in got if not n.endswith("ADJ")]
    assert days == [28, 28, 35] * 8
    assert got[13][1] == got[11][2] + dt.timedelta(days=1) == got[13][3]  # the second year begins after the first
    assert got[12] == ("FY2020-ADJ", got[11][2], got[11][2], D(2020, 2, 3))


@pytest.mark.parametrize("bin_days", [1, 32, 1000])
def test_interval_join(spark, bin_days):
    points = spark.createDataFrame([(k, D(2020, 1, 1) + dt.timedelta(days=3 * k)) for k in range(40)] + [(99, None)], "k int, at date")
    spans = [("x", D(2019, 12, 1), D(2020, 1, 4)), ("y", D(2020, 1, 4), D(2020, 3, 20)), ("z", D(2020, 2, 1), D(2020, 2, 1)),
             ("bad", D(2020, 2, 2), D(2020, 2, 1)), ("open", D(2020, 1, 1), None)]
    got = interval_join(points, spark.createDataFrame(spans, "name string, s date, e date"), "at", "s", "e", bin_days)
    want = [(k, n) for k in range(40) for n, s, e in spans if e and s <= D(2020, 1, 1) + dt.timedelta(days=3 * k) <= e]
    assert rows(got, "k", "name") == sorted(want, key=repr)
    assert got.columns == ["k", "at", "name", "s", "e"]


def test_history_and_current_equal_the_whole(spark):
    periods = week_period_rows("2020-02-03", 2, adjustment=True)
    cut, as_of = periods[13][1], D(2021, 11, 1)
    table, lines = spark.createDataFrame(periods, PERIODS), spark.createDataFrame(random_lines(11), LINES)
    args, restart = (["account"], "d", "debit", "credit"), F.col("account").startswith("4")
    whole = nonzero(period_balances_any(lines, table, *args, as_of, restart))
    history = period_balances_any(lines, table, *args, cut - dt.timedelta(days=1), restart)
    for current in (lines.filter(F.col("d") >= F.lit(cut)), lines):  # movements of closed years are not counted twice
        assert rows(balances_any_with_history(current, history, table, *args, as_of, cut, restart)) == rows(whole.select(
            "account", "period", "opening", "debit", "credit", "movement", "closing"))
    with pytest.raises(ValueError, match="last closed period"):
        balances_any_with_history(lines, history, table, *args, as_of, cut + dt.timedelta(days=2), restart)
