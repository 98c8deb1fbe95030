"""Queries for period balances (running-window form) and balances with frozen history.

The oracles state the rule directly as a range join of movements to periods;
the Spark plans use per-month sums, a generated month grid and running windows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.money import money
from ..operators.ledger import MEASURES, balances_with_history, period_balances, split_history
from ..operators.periods import PERIOD_SCHEMA, balances_any_with_history, period_balances_any, week_period_rows
from ..sources.tables import Tables, literal_rows
from . import AS_OF_ORDERS, query

# Segments whose balances restart every 1 January.
RESTART_SEGMENTS = ("AUTOMOBILE", "BUILDING")
_RESTART_SQL = ", ".join(f"'{s}'" for s in RESTART_SEGMENTS)

_RANGE_SQL = f"""
mv AS (SELECT c.c_mktsegment AS seg, CAST(o.o_orderdate AS DATE) AS d,
              CASE WHEN o.o_orderstatus IN ('O', 'P') THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS debit,
              CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS credit
       FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
       WHERE CAST(o.o_orderdate AS DATE) <= DATE '{AS_OF_ORDERS}'),
periods AS (SELECT CAST(g AS DATE) AS ps, CAST(g + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS pe
            FROM generate_series((SELECT CAST(date_trunc('month', min(d)) AS DATE) FROM mv),
                                 CAST(date_trunc('month', DATE '{AS_OF_ORDERS}') AS DATE), INTERVAL 1 MONTH) t(g)),
j AS (SELECT mv.seg, p.ps, mv.d, mv.debit, mv.credit FROM periods p JOIN mv
      ON mv.d <= p.pe AND mv.d >= CASE WHEN mv.seg IN ({_RESTART_SQL}) THEN make_date(year(p.ps), 1, 1)
                                       ELSE DATE '1900-01-01' END),
bal AS (SELECT seg AS c_mktsegment, ps,
               ROUND(SUM(CASE WHEN d < ps THEN debit - credit ELSE 0 END), 2) AS opening,
               ROUND(SUM(CASE WHEN d >= ps THEN debit ELSE 0 END), 2) AS debit,
               ROUND(SUM(CASE WHEN d >= ps THEN credit ELSE 0 END), 2) AS credit,
               ROUND(SUM(CASE WHEN d >= ps THEN debit - credit ELSE 0 END), 2) AS movement,
               ROUND(SUM(debit - credit), 2) AS closing
        FROM j GROUP BY seg, ps)"""

_OUT_SQL = """SELECT c_mktsegment, strftime(ps, '%Y-%m') AS period, CAST(opening AS DOUBLE) AS opening,
       CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit, CAST(movement AS DOUBLE) AS movement,
       CAST(closing AS DOUBLE) AS closing FROM bal"""


def _movements(t):
    o = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    zero = F.lit(0).cast("decimal(18,2)")
    return o.select("c_mktsegment", F.to_date("o_orderdate").alias("d"),
                    F.when(F.col("o_orderstatus").isin("O", "P"), price).otherwise(zero).alias("debit"),
                    F.when(F.col("o_orderstatus") == "F", price).otherwise(zero).alias("credit"))


def _present(df):
    return df.select("c_mktsegment", F.date_format("period", "yyyy-MM").alias("period"),
                     *[F.col(m).cast("double").alias(m) for m in ("opening", "debit", "credit", "movement", "closing")])


@query("period_balances", sql=f"WITH {_RANGE_SQL} {_OUT_SQL}")
def q_period_balances(spark, sf_dir):
    """Segment x month balances; AUTOMOBILE and BUILDING restart each year."""
    t = Tables(spark, sf_dir)
    bal = period_balances(_movements(t), ["c_mktsegment"], "d", "debit", "credit", AS_OF_ORDERS,
                          restart=F.col("c_mktsegment").isin(*RESTART_SEGMENTS))
    return _present(bal)


# Accounts of the two-part query: a buyer's nation and the order status.  F orders settle at once
# (debit and credit), P orders start again every year, so months without movement come to zero.
_YEAR_START = dt.date(2001, 1, 1)
_ACCOUNT_SQL = f"""
mv AS (SELECT c.c_nationkey, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS d,
              CAST(o.o_totalprice AS DECIMAL(18,2)) AS debit,
              CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS credit
       FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
       WHERE CAST(o.o_orderdate AS DATE) <= DATE '{AS_OF_ORDERS}'),
periods AS (SELECT CAST(g AS DATE) AS ps, CAST(g + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS pe
            FROM generate_series((SELECT CAST(date_trunc('month', min(d)) AS DATE) FROM mv),
                                 CAST(date_trunc('month', DATE '{AS_OF_ORDERS}') AS DATE), INTERVAL 1 MONTH) t(g)),
j AS (SELECT mv.*, p.ps, p.ps >= DATE '2001-01-01' AS is_current FROM periods p JOIN mv ON mv.d <= p.pe
      AND CASE WHEN p.ps >= DATE '2001-01-01' THEN mv.d >= DATE '2001-01-01'
               WHEN mv.o_orderstatus = 'P' THEN mv.d >= make_date(year(p.ps), 1, 1) ELSE TRUE END),
part AS (SELECT c_nationkey, o_orderstatus, ps, SUM(CASE WHEN d < ps THEN debit - credit ELSE 0 END) AS opening,
                SUM(CASE WHEN d >= ps THEN debit ELSE 0 END) AS debit,
                SUM(CASE WHEN d >= ps THEN credit ELSE 0 END) AS credit,
                SUM(CASE WHEN d >= ps THEN debit - credit ELSE 0 END) AS movement, SUM(debit - credit) AS closing
         FROM j GROUP BY ALL),
carry AS (SELECT h.c_nationkey, h.o_orderstatus, p.ps, h.closing AS opening, 0 AS debit, 0 AS credit, 0 AS movement,
                 h.closing AS closing
          FROM part h JOIN periods p ON p.ps >= DATE '2001-01-01'
          WHERE h.ps = DATE '2000-12-01' AND h.o_orderstatus <> 'P'),
bal AS (SELECT c_nationkey, o_orderstatus, ps, SUM(opening) AS opening, SUM(debit) AS debit, SUM(credit) AS credit,
               SUM(movement) AS movement, SUM(closing) AS closing
        FROM (SELECT c_nationkey, o_orderstatus, ps, opening, debit, credit, movement, closing FROM part
              UNION ALL SELECT * FROM carry) GROUP BY ALL)"""


def _accounts(orders, customer):
    """Movements of an order frame already cut by its stored date."""
    price = money("o_totalprice")
    o = orders.select("o_custkey", "o_orderstatus", "o_orderdate", price.alias("debit"),
                      F.when(F.col("o_orderstatus") == "F", price).otherwise(F.lit(0).cast("decimal(18,2)")).alias("credit"))
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return o.join(c, "o_custkey").withColumn("d", F.to_date("o_orderdate"))


@query("balances_with_history", sql=f"""WITH {_ACCOUNT_SQL}
SELECT c_nationkey, o_orderstatus, strftime(ps, '%Y-%m') AS period, CAST(opening AS DOUBLE) AS opening,
       CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit, CAST(movement AS DOUBLE) AS movement,
       CAST(closing AS DOUBLE) AS closing
FROM bal WHERE opening <> 0 OR debit <> 0 OR credit <> 0 OR movement <> 0 OR closing <> 0""")
def q_balances_with_history(spark, sf_dir):
    """Closed years frozen once, the current year's orders added to them; zero rows dropped."""
    t = Tables(spark, sf_dir)
    group, restart = ["c_nationkey", "o_orderstatus"], F.col("o_orderstatus") == "P"
    closed, current = split_history(t.orders, "o_orderdate", AS_OF_ORDERS)
    last_closed = _YEAR_START - dt.timedelta(days=1)
    # what the year-end run stored; the checkpoint stands for that table
    history = period_balances(_accounts(closed, t.customer), group, "d", "debit", "credit", last_closed,
                              restart).checkpoint(eager=True)
    bal = balances_with_history(_accounts(current, t.customer), history, group, "d", "debit", "credit", AS_OF_ORDERS, restart)
    return bal.select(*group, F.date_format("period", "yyyy-MM").alias("period"),
                      *[F.col(m).cast("double").alias(m) for m in MEASURES])


# Fiscal years of 4-4-5 weeks from the first Monday of February, each with an adjustment day, and
# the day from which accumulating accounts are kept.
FISCAL_PERIODS = week_period_rows("1995-02-06", 7, adjustment=True)
FLOOR = "1996-02-05"
_PERIOD_VALUES = ", ".join(f"('{n}', DATE '{s}', DATE '{e}', DATE '{y}')" for n, s, e, y in FISCAL_PERIODS)


_ANY_SQL = f"""
WITH mv AS (SELECT c.c_nationkey, o.o_orderstatus, CAST(o.o_orderdate AS DATE) AS d,
                   CAST(o.o_totalprice AS DECIMAL(18,2)) AS debit,
                   CASE WHEN o.o_orderstatus = 'F' THEN CAST(o.o_totalprice AS DECIMAL(18,2)) ELSE 0 END AS credit
            FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
            WHERE CAST(o.o_orderdate AS DATE) BETWEEN DATE '{FLOOR}' AND DATE '{AS_OF_ORDERS}'),
p(period, ps, pe, ys) AS (SELECT * FROM (VALUES {_PERIOD_VALUES}) v(a, b, c, d)
                          WHERE b >= DATE '{FLOOR}' AND c <= DATE '{AS_OF_ORDERS}')
SELECT c_nationkey, o_orderstatus, period,
       CAST(SUM(CASE WHEN d < ps THEN debit - credit ELSE 0 END) AS DOUBLE) AS opening,
       CAST(SUM(CASE WHEN d >= ps THEN debit ELSE 0 END) AS DOUBLE) AS debit,
       CAST(SUM(CASE WHEN d >= ps THEN credit ELSE 0 END) AS DOUBLE) AS credit,
       CAST(SUM(CASE WHEN d >= ps THEN debit - credit ELSE 0 END) AS DOUBLE) AS movement,
       CAST(SUM(debit - credit) AS DOUBLE) AS closing
FROM mv JOIN p ON mv.d <= p.pe AND (o_orderstatus <> 'P' OR mv.d >= p.ys)
GROUP BY c_nationkey, o_orderstatus, period
"""


@query("period_balances_any", sql=_ANY_SQL)
def q_period_balances_any(spark, sf_dir):
    """Balances per nation and status over 4-4-5 fiscal periods with adjustment days; P orders restart each fiscal year."""
    t = Tables(spark, sf_dir)
    periods = literal_rows(spark, FISCAL_PERIODS, PERIOD_SCHEMA)
    bal = period_balances_any(_accounts(t.orders, t.customer), periods, ["c_nationkey", "o_orderstatus"], "d", "debit", "credit",
                              AS_OF_ORDERS, F.col("o_orderstatus") == "P", FLOOR)
    return bal.select("c_nationkey", "o_orderstatus", "period", *[F.col(m).cast("double").alias(m) for m in MEASURES])


_FISCAL_START = "2001-01-29"  # of the year that AS_OF_ORDERS is in


@query("balances_any_with_history", sql=f"""
SELECT * FROM ({_ANY_SQL}) WHERE opening <> 0 OR debit <> 0 OR credit <> 0 OR movement <> 0 OR closing <> 0
""")
def q_balances_any_with_history(spark, sf_dir):
    """Closed fiscal years frozen once, this fiscal year's orders added to them; zero rows dropped."""
    t = Tables(spark, sf_dir)
    group, restart = ["c_nationkey", "o_orderstatus"], F.col("o_orderstatus") == "P"
    start = dt.date.fromisoformat(_FISCAL_START)
    periods = literal_rows(spark, [p for p in FISCAL_PERIODS if p[1] >= dt.date.fromisoformat(FLOOR)], PERIOD_SCHEMA)
    closed, current = (t.orders.filter(F.col("o_orderdate") < F.lit(start)), t.orders.filter(F.col("o_orderdate") >= F.lit(start)))
    # what the year-end run stored; the checkpoint stands for that table
    history = period_balances_any(_accounts(closed, t.customer), periods, group, "d", "debit", "credit",
                                  start - dt.timedelta(days=1), restart, FLOOR).checkpoint(eager=True)
    bal = balances_any_with_history(_accounts(current, t.customer), history, periods, group, "d", "debit", "credit",
                                    AS_OF_ORDERS, start, restart)
    return bal.select(*group, "period", *[F.col(m).cast("double").alias(m) for m in MEASURES])
