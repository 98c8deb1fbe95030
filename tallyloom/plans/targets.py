"""Queries that keep a target between runs: partition upsert, stable keys, sketches, and the comparison of two versions.

Each writes its target into the shared folder and works on it in a second run, as
a nightly job does; the oracles state what both runs together must leave.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import local_day
from ..functions.money import cents, money
from ..operators.merge import upsert_partitions
from ..operators.numbering import stable_keys
from ..operators.reconcile import table_diff
from ..operators.sketches import daily_sketches, distinct_between, merge_sketches, relative_error
from ..session import shared_path
from ..sources.tables import Tables
from . import query
from .changes import LOCAL_ZONE

_FIRST, _SECOND = dt.date(2001, 6, 30), dt.date(2001, 8, 31)
_STORED, _CHANGED = dt.date(2001, 3, 1), dt.date(2001, 1, 1)


@query("upsert_touched", sql="""
WITH t AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS total
           FROM orders WHERE o_orderdate < TIMESTAMP '2001-03-01'),
s AS (SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 1 MONTH ELSE o_orderdate END, '%Y-%m')
             AS month, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS total
      FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')
SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey, COALESCE(s.month, t.month) AS month,
       COALESCE(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus, CAST(COALESCE(s.total, t.total) AS DOUBLE) AS total,
       CASE WHEN t.o_orderkey IS NULL THEN '2001-08-31' ELSE '2001-06-30' END AS loaded_at,
       CASE WHEN s.o_orderkey IS NULL THEN '2001-06-30' ELSE '2001-08-31' END AS updated_at
FROM t FULL JOIN s ON s.o_orderkey = t.o_orderkey
""")
def q_upsert_touched(spark, sf_dir):
    """Orders stored by month, then merged with the year's changes, some of which move to the next month."""
    orders = Tables(spark, sf_dir).orders
    path = shared_path(spark, "orders-by-month")
    moved = F.when(F.col("o_orderkey") % 10 == 0, F.add_months(F.to_date("o_orderdate"), 1)).otherwise(F.to_date("o_orderdate"))
    stored = orders.filter(F.col("o_orderdate") < F.lit(_STORED)).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus", money("o_totalprice").alias("total"))
    changed = orders.filter(F.col("o_orderdate") >= F.lit(_CHANGED)).select(
        "o_orderkey", F.date_format(moved, "yyyy-MM").alias("month"), "o_orderstatus",
        (money("o_totalprice") + 1).cast("decimal(18,2)").alias("total"))
    upsert_partitions(spark, path, stored, ["o_orderkey"], ["month"], _FIRST)
    upsert_partitions(spark, path, changed, ["o_orderkey"], ["month"], _SECOND)
    return spark.read.schema("o_orderkey long, o_orderstatus string, total decimal(18,2), loaded_at date, updated_at date, "
                             "month string").parquet(path).select(
        "o_orderkey", "month", "o_orderstatus", cents("total").alias("total"),
        F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded_at"), F.date_format("updated_at", "yyyy-MM-dd").alias("updated_at"))


@query("stable_keys", sql="""
WITH a AS (SELECT o_custkey, o_orderstatus, min(o_orderdate) AS d FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1, 2),
first AS (SELECT o_custkey, o_orderstatus, row_number() OVER (ORDER BY d, o_custkey, o_orderstatus) AS id FROM a),
b AS (SELECT o_custkey, o_orderstatus, min(o_orderdate) AS d, count(*) AS n FROM orders GROUP BY 1, 2),
second AS (SELECT b.o_custkey, b.o_orderstatus, (SELECT count(*) FROM first) + row_number() OVER (ORDER BY d, o_custkey, o_orderstatus) AS id
           FROM b ANTI JOIN first USING (o_custkey, o_orderstatus)),
keys AS (SELECT * FROM first UNION ALL SELECT * FROM second)
SELECT o_custkey, o_orderstatus, CAST(keys.id AS BIGINT) AS id, n AS n_orders FROM b JOIN keys USING (o_custkey, o_orderstatus)
""")
def q_stable_keys(spark, sf_dir):
    """Numbers of (customer, status) pairs: those of the first year's orders stay when all orders come."""
    orders = Tables(spark, sf_dir).orders.select("o_custkey", "o_orderstatus", "o_orderdate")
    path, keys = shared_path(spark, "order-keys"), ["o_custkey", "o_orderstatus"]
    stable_keys(spark, path, orders.filter(F.col("o_orderdate") < F.lit(dt.date(1996, 1, 1))), keys, ["o_orderdate"])
    return stable_keys(spark, path, orders, keys, ["o_orderdate"]).groupBy(*keys, "id").agg(
        F.count(F.lit(1)).alias("n_orders"))


_DAY_SQL = "CAST(ts - INTERVAL 5 HOUR AS DATE)"


@query("distinct_sketches", sql=f"""
SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, CAST(1 AS BIGINT) AS within_bound
FROM events WHERE {_DAY_SQL} >= DATE '2024-01-10' GROUP BY event_type
""")
def q_distinct_sketches(spark, sf_dir):
    """Distinct users per event type from daily sketches merged in two runs, held against the exact count."""
    events, day = Tables(spark, sf_dir).events, local_day("ts", LOCAL_ZONE)
    path = shared_path(spark, "daily-users")
    cut, late = dt.date(2024, 1, 20), dt.date(2024, 1, 18)
    daily_sketches(events.filter(day < F.lit(cut)), ["event_type"], day, "user_id").write.parquet(path)
    fresh = daily_sketches(events.filter(day >= F.lit(late)), ["event_type"], day, "user_id")  # late rows: two days again
    kept = merge_sketches(spark.read.parquet(path), fresh, ["event_type"])
    start = dt.date(2024, 1, 10)
    told = distinct_between(kept, ["event_type"], start)
    exact = events.filter(day >= F.lit(start)).groupBy("event_type").agg(F.countDistinct("user_id").alias("n_users"))
    near = F.abs(F.col("distinct") - F.col("n_users")) <= F.col("n_users") * relative_error()
    return told.join(exact, "event_type").select("event_type", "n_rows", "n_users", near.cast("long").alias("within_bound"))


def _customer_mart(t, upto):
    o = t.orders.filter(F.col("o_orderdate") < F.lit(upto + dt.timedelta(days=1)))
    return o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).cast("decimal(18,2)").alias("total"),
        F.max(F.to_date("o_orderdate")).alias("last_date"),
        F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))).alias("highest"))


def _mart_sql(upto):
    return f"""SELECT o_custkey, count(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total,
       CAST(max(o_orderdate) AS DATE) AS last_date, max(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS highest
  FROM orders WHERE o_orderdate < TIMESTAMP '{upto + dt.timedelta(days=1)}' GROUP BY o_custkey"""


_DIFF_SQL = "\nUNION ALL\n".join(
    f"SELECT o_custkey, 'changed', '{c}', CAST(l_{c} AS VARCHAR), CAST(r_{c} AS VARCHAR) FROM j "
    f"WHERE l_key IS NOT NULL AND r_key IS NOT NULL AND l_{c} IS DISTINCT FROM r_{c}"
    for c in ("n_orders", "total", "last_date", "highest"))


@query("mart_diff_rows", sql=f"""
WITH l AS ({_mart_sql(dt.date(1999, 6, 30))}), r AS ({_mart_sql(dt.date(1999, 7, 31))}),
j AS (SELECT COALESCE(l.o_custkey, r.o_custkey) AS o_custkey, l.o_custkey AS l_key, r.o_custkey AS r_key,
             {", ".join(f"l.{c} AS l_{c}, r.{c} AS r_{c}" for c in ("n_orders", "total", "last_date", "highest"))}
      FROM l FULL JOIN r ON l.o_custkey = r.o_custkey)
SELECT o_custkey, CASE WHEN r_key IS NULL THEN 'left only' ELSE 'right only' END AS kind, CAST(NULL AS VARCHAR) AS "column",
       CAST(NULL AS VARCHAR) AS left_value, CAST(NULL AS VARCHAR) AS right_value FROM j WHERE l_key IS NULL OR r_key IS NULL
UNION ALL
{_DIFF_SQL}
""")
def q_mart_diff_rows(spark, sf_dir):
    """What a month of orders changed in a customer mart: keys that came, and every column that moved."""
    t = Tables(spark, sf_dir)
    return table_diff(_customer_mart(t, dt.date(1999, 6, 30)), _customer_mart(t, dt.date(1999, 7, 31)), ["o_custkey"])
