"""Queries for the change operators: soft deletes, upserts, window replace, snapshots, overrides."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import local_day, window_start
from ..functions.money import GROSS_SQL, cents, gross_amount, money
from ..operators.changes import (
    apply_overrides,
    flag_soft_deletes,
    month_end_snapshot,
    reconcile_counts,
    replace_date_window,
    scd1_upsert,
)
from ..operators.dedup import latest_per_key
from ..sources.tables import Tables, literal_rows
from . import AS_OF_EVENTS, AS_OF_ORDERS, query

_Y2001 = (dt.date(2001, 1, 1), dt.date(2002, 1, 1))


def _raw_customers(t):
    """Customer rows as a landed RAW table; negative balances were flagged on an earlier run."""
    return t.customer.select("c_custkey", "c_name",
                             F.when(F.col("c_acctbal") < 0, F.lit("1")).cast("string").alias("deleted"))


def _live_keys(t):
    """Current key list: customers with an order in 2001."""
    o = t.orders
    return o.filter((o.o_orderdate >= F.lit(_Y2001[0])) & (o.o_orderdate < F.lit(_Y2001[1]))) \
        .select(F.col("o_custkey").alias("c_custkey"))


_RAW_SQL = """
raw AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN '1' END AS deleted FROM customer),
live AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders
         WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2002-01-01'),
flagged AS (
  SELECT r.c_custkey, r.c_name,
         CASE WHEN r.c_custkey IS NOT NULL AND l.c_custkey IS NULL THEN '1' ELSE r.deleted END AS deleted
  FROM raw r LEFT JOIN live l ON r.c_custkey = l.c_custkey)"""


@query("soft_delete_flags", sql=f"WITH {_RAW_SQL} SELECT * FROM flagged")
def q_soft_delete_flags(spark, sf_dir):
    """Customers as a RAW table flagged deleted when they left the list of 2001 buyers."""
    t = Tables(spark, sf_dir)
    return flag_soft_deletes(_raw_customers(t), _live_keys(t), "c_custkey")


@query("soft_delete_reconcile", sql=f"""
WITH {_RAW_SQL},
missing AS (SELECT count(*) AS n FROM flagged f LEFT JOIN live l ON f.c_custkey = l.c_custkey
            WHERE l.c_custkey IS NULL),
fl AS (SELECT count(*) AS n FROM flagged WHERE deleted IS NOT NULL)
SELECT missing.n AS missing_keys, fl.n AS flagged_rows, missing.n - fl.n AS difference,
       CASE WHEN missing.n - fl.n <> 0 THEN 'CON DIFERENCIA' ELSE 'SIN DIFERENCIA' END AS status
FROM missing, fl
""")
def q_soft_delete_reconcile(spark, sf_dir):
    """Keys missing from the live list against rows flagged deleted, with a status."""
    t = Tables(spark, sf_dir)
    live = _live_keys(t)
    flagged = flag_soft_deletes(_raw_customers(t), live, "c_custkey")
    return reconcile_counts(flagged, live, "c_custkey")


_RUN_DATE = dt.date(2001, 8, 31)
_FIRST_LOAD = dt.date(2001, 1, 1)


_FIRST_LOAD_CUTOFF = dt.date(1999, 1, 1)   # customers whose first order precedes this were in the first load
_ACTIVE_SINCE = dt.date(1998, 1, 1)        # today's extract: customers with an order since this day


@query("scd1_upsert", sql="""
WITH hist AS (SELECT o_custkey, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders GROUP BY 1),
c AS (SELECT c.*, h.first_ts, h.last_ts FROM customer c LEFT JOIN hist h ON h.o_custkey = c.c_custkey),
t AS (SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
             DATE '2001-01-01' AS loaded_at, DATE '2001-01-01' AS updated_at
      FROM c WHERE first_ts < TIMESTAMP '1999-01-01' OR first_ts IS NULL),
s AS (SELECT c_custkey, lower(c_name) AS c_name, CAST(c_acctbal AS DECIMAL(18,2)) + 100 AS c_acctbal, c_mktsegment
      FROM c WHERE last_ts >= TIMESTAMP '1998-01-01')
SELECT COALESCE(t.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN s.c_custkey IS NOT NULL THEN s.c_name ELSE t.c_name END AS c_name,
       CAST(CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS DOUBLE) AS c_acctbal,
       CASE WHEN t.c_custkey IS NULL THEN s.c_mktsegment ELSE t.c_mktsegment END AS c_mktsegment,
       strftime(CASE WHEN t.c_custkey IS NULL THEN DATE '2001-08-31' ELSE t.loaded_at END, '%Y-%m-%d') AS loaded_at,
       strftime(CASE WHEN s.c_custkey IS NOT NULL THEN DATE '2001-08-31' ELSE t.updated_at END, '%Y-%m-%d') AS updated_at,
       CASE WHEN t.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL THEN 'update'
            WHEN t.c_custkey IS NULL THEN 'insert' ELSE 'keep' END AS action
FROM t FULL OUTER JOIN s ON t.c_custkey = s.c_custkey
""")
def q_scd1_upsert(spark, sf_dir):
    """Customer dimension as first loaded (customers ordering before 1999, or never) merged with
    today's changed extract (customers active since 1998): keep, update and insert all occur."""
    t = Tables(spark, sf_dir)
    hist = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_ts"), F.max("o_orderdate").alias("last_ts"))
    c = t.customer.join(hist, "c_custkey", "left")
    target = c.filter((F.col("first_ts") < F.lit(_FIRST_LOAD_CUTOFF)) | F.col("first_ts").isNull()).select(
        "c_custkey", "c_name", money("c_acctbal").alias("c_acctbal"), "c_mktsegment",
        F.lit(_FIRST_LOAD).alias("loaded_at"), F.lit(_FIRST_LOAD).alias("updated_at"))
    source = c.filter(F.col("last_ts") >= F.lit(_ACTIVE_SINCE)).select(
        "c_custkey", F.lower("c_name").alias("c_name"), (money("c_acctbal") + 100).alias("c_acctbal"),
        "c_mktsegment")
    merged = scd1_upsert(target, source, ["c_custkey"], _RUN_DATE,
                         update_cols=["c_name", "c_acctbal"], insert_cols=["c_name", "c_acctbal", "c_mktsegment"])
    return merged.select(
        "c_custkey", "c_name", cents("c_acctbal").alias("c_acctbal"), "c_mktsegment",
        F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded_at"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated_at"),
        F.col("_action").alias("action"))


def _line_version(df):
    return df.select("l_orderkey", "l_linenumber", "l_quantity", money("l_extendedprice").alias("l_extendedprice"),
                     F.to_date("l_shipdate").alias("l_shipdate"))


_LINE_DEDUP_SQL = """
  SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM (
    SELECT COALESCE(l_orderkey, -1) AS l_orderkey, COALESCE(l_linenumber, -1) AS l_linenumber, l_quantity,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate,
           row_number() OVER (PARTITION BY COALESCE(l_orderkey, -1), COALESCE(l_linenumber, -1)
                              ORDER BY CAST(l_shipdate AS DATE) DESC, l_quantity DESC,
                                       CAST(l_extendedprice AS DECIMAL(18,2)) DESC) AS rn
    FROM lineitem WHERE {cond}) WHERE rn = 1"""


@query("upsert_composite_key", sql=f"""
WITH t AS ({_LINE_DEDUP_SQL.format(cond="l_shipdate < TIMESTAMP '2000-01-01'")}),
s AS ({_LINE_DEDUP_SQL.format(cond="l_shipdate >= TIMESTAMP '1998-01-01'")})
SELECT COALESCE(t.l_orderkey, s.l_orderkey) AS l_orderkey, COALESCE(t.l_linenumber, s.l_linenumber) AS l_linenumber,
       CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_quantity ELSE t.l_quantity END AS l_quantity,
       CAST(CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_extendedprice ELSE t.l_extendedprice END AS DOUBLE)
         AS l_extendedprice,
       strftime(CASE WHEN s.l_orderkey IS NOT NULL THEN s.l_shipdate ELSE t.l_shipdate END, '%Y-%m-%d') AS ship_date,
       CASE WHEN t.l_orderkey IS NOT NULL AND s.l_orderkey IS NOT NULL THEN 'update'
            WHEN t.l_orderkey IS NULL THEN 'insert' ELSE 'keep' END AS action
FROM t FULL OUTER JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
""")
def q_upsert_composite_key(spark, sf_dir):
    """Composite-key upsert of line versions; keys defaulted to -1, source de-duplicated first."""
    t = Tables(spark, sf_dir)
    li = t.lineitem
    defaults = {"l_orderkey": -1, "l_linenumber": -1}
    old = _line_version(li.filter(F.col("l_shipdate") < F.lit(dt.date(2000, 1, 1)))).na.fill(defaults)
    target = latest_per_key(old, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    source = _line_version(li.filter(F.col("l_shipdate") >= F.lit(dt.date(1998, 1, 1))))
    merged = scd1_upsert(target, source, ["l_orderkey", "l_linenumber"], _RUN_DATE, key_defaults=defaults,
                         dedup_order=["l_shipdate"])
    return merged.select("l_orderkey", "l_linenumber", "l_quantity", cents("l_extendedprice").alias("l_extendedprice"),
                         F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
                         F.col("_action").alias("action"))


# The warehouse's local zone (UTC-5 all year, no daylight saving).
LOCAL_ZONE = "America/Bogota"


def _daily_counts(t, cond=None):
    ev = t.events
    if cond is not None:
        ev = ev.filter(cond)
    return ev.groupBy("event_type", local_day("ts", LOCAL_ZONE).alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(money("value")).alias("value_sum"))


_DAILY_SQL = """
  SELECT event_type, CAST(ts - INTERVAL 5 HOUR AS DATE) AS day, count(*) AS n_events,
         SUM(CAST(value AS DECIMAL(18,2))) AS value_sum
  FROM events GROUP BY 1, 2"""


@query("daily_measure_upsert", sql=f"""
WITH d AS ({_DAILY_SQL}),
t AS (SELECT *, DATE '2024-01-19' AS loaded_at, DATE '2024-01-19' AS updated_at FROM d WHERE day < DATE '2024-01-20'),
s AS (SELECT * FROM d WHERE day >= DATE '2024-01-15')
SELECT COALESCE(t.event_type, s.event_type) AS event_type, strftime(COALESCE(t.day, s.day), '%Y-%m-%d') AS day,
       CASE WHEN s.day IS NOT NULL THEN s.n_events ELSE t.n_events END AS n_events,
       CAST(CASE WHEN s.day IS NOT NULL THEN s.value_sum ELSE t.value_sum END AS DOUBLE) AS value_sum,
       strftime(CASE WHEN t.day IS NULL THEN DATE '{AS_OF_EVENTS}' ELSE t.loaded_at END, '%Y-%m-%d') AS loaded_at,
       strftime(CASE WHEN s.day IS NOT NULL THEN DATE '{AS_OF_EVENTS}' ELSE t.updated_at END, '%Y-%m-%d') AS updated_at,
       CASE WHEN t.day IS NOT NULL AND s.day IS NOT NULL THEN 'update'
            WHEN t.day IS NULL THEN 'insert' ELSE 'keep' END AS action
FROM t FULL OUTER JOIN s ON t.event_type = s.event_type AND t.day = s.day
""")
def q_daily_measure_upsert(spark, sf_dir):
    """Daily row counts per (event type, local day) merged into the stored history."""
    t = Tables(spark, sf_dir)
    # per-(type, day) counts are small and feed both sides of the merge: aggregated once
    counts = _daily_counts(t).checkpoint(eager=True)
    stored = dt.date(2024, 1, 19)
    history = counts.filter(F.col("day") < F.lit(dt.date(2024, 1, 20))) \
        .withColumn("loaded_at", F.lit(stored)).withColumn("updated_at", F.lit(stored))
    today = counts.filter(F.col("day") >= F.lit(dt.date(2024, 1, 15)))
    merged = scd1_upsert(history, today, ["event_type", "day"], dt.date.fromisoformat(AS_OF_EVENTS))
    return merged.select(
        "event_type", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_events",
        cents("value_sum").alias("value_sum"),
        F.date_format("loaded_at", "yyyy-MM-dd").alias("loaded_at"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("updated_at"), F.col("_action").alias("action"))


@query("replace_date_window", sql=f"""
WITH fact AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
                     CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders),
lines AS (SELECT l_orderkey, SUM({GROSS_SQL}) AS total FROM lineitem GROUP BY l_orderkey),
recomputed AS (SELECT f.o_orderkey, f.order_date, COALESCE(l.total, 0) AS total FROM fact f LEFT JOIN lines l ON l.l_orderkey = f.o_orderkey
               WHERE f.order_date BETWEEN DATE '2001-05-01' AND DATE '{AS_OF_ORDERS}')
SELECT o_orderkey, strftime(order_date, '%Y-%m-%d') AS order_date, CAST(total AS DOUBLE) AS total,
       CAST(0 AS BIGINT) AS recomputed
FROM fact WHERE NOT (order_date BETWEEN DATE '2001-05-01' AND DATE '{AS_OF_ORDERS}')
UNION ALL
SELECT o_orderkey, strftime(order_date, '%Y-%m-%d'), CAST(total AS DOUBLE), CAST(1 AS BIGINT) FROM recomputed
""")
def q_replace_date_window(spark, sf_dir):
    """Order fact whose last three months (plus the current one) are rebuilt from the lines; an order without lines has total 0."""
    t = Tables(spark, sf_dir)
    start = window_start(AS_OF_ORDERS, 3)
    fact = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                           money("o_totalprice").alias("total"))
    in_window = fact.filter(F.col("order_date").between(F.lit(start), F.lit(dt.date.fromisoformat(AS_OF_ORDERS))))
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(gross_amount()).alias("total"))
    recomputed = in_window.drop("total").join(lines.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left") \
        .select("o_orderkey", "order_date", F.coalesce("total", F.lit(0)).cast("decimal(38,2)").alias("total"))
    fact = fact.select("o_orderkey", "order_date", F.col("total").cast("decimal(38,2)").alias("total"))
    tagged_old = fact.withColumn("recomputed", F.lit(0).cast("long"))
    tagged_new = recomputed.withColumn("recomputed", F.lit(1).cast("long"))
    out = replace_date_window(tagged_old, tagged_new, "order_date", start, AS_OF_ORDERS)
    return out.select("o_orderkey", F.date_format("order_date", "yyyy-MM-dd").alias("order_date"),
                      cents("total").alias("total"), "recomputed")


def _segment_totals(t, upto: dt.date):
    o = t.orders.filter(F.col("o_orderdate") < F.lit(upto + dt.timedelta(days=1)))
    return o.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey") \
        .groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"),
                                     F.sum(money("o_totalprice")).alias("total"))


@query("month_end_snapshot", sql="""
WITH seg AS (SELECT c.c_mktsegment, o.o_orderdate, CAST(o.o_totalprice AS DECIMAL(18,2)) AS price
             FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)
SELECT '2001-07-31' AS snapshot_date, c_mktsegment, count(*) AS n_orders, CAST(SUM(price) AS DOUBLE) AS total
FROM seg WHERE o_orderdate < TIMESTAMP '2001-08-01' GROUP BY c_mktsegment
UNION ALL
SELECT '2001-08-31', c_mktsegment, count(*), CAST(SUM(price) AS DOUBLE)
FROM seg WHERE o_orderdate < TIMESTAMP '2001-09-01' GROUP BY c_mktsegment
""")
def q_month_end_snapshot(spark, sf_dir):
    """Order totals per segment, appended as a stamped copy on a month-end run date."""
    t = Tables(spark, sf_dir)
    july = dt.date(2001, 7, 31)
    history = _segment_totals(t, july).withColumn("snapshot_date", F.lit(july))
    current = _segment_totals(t, dt.date.fromisoformat(AS_OF_ORDERS))
    snap = month_end_snapshot(history, current, AS_OF_ORDERS)
    return snap.select(F.date_format("snapshot_date", "yyyy-MM-dd").alias("snapshot_date"), "c_mktsegment",
                       "n_orders", cents("total").alias("total"))


# Hand-kept override rows (order number, action, new date).
OVERRIDE_ROWS = [
    ("5", "Ventas", "2001-02-01"),
    ("5", "Desistimiento", "2001-03-01"),
    ("7", "Ventas", "1999-12-31"),
    ("11", "Desistimiento", "2000-06-15"),
    ("13", "Ventas incluidas", "2000-01-10"),
    ("13", "Ventas", "2000-01-20"),
]
_OVERRIDE_SCHEMA = T.StructType([
    T.StructField("number", T.StringType()), T.StructField("action", T.StringType()),
    T.StructField("new_date", T.StringType())])
_OVERRIDE_VALUES = ", ".join(f"('{a}', '{b}', DATE '{c}')" for a, b, c in OVERRIDE_ROWS)


@query("literal_override_rows", sql=f"""
WITH ov(number, action, new_date) AS (VALUES {_OVERRIDE_VALUES}),
sale AS (SELECT number, max(new_date) AS d FROM ov WHERE action LIKE '%Ventas%' GROUP BY number),
wd AS (SELECT number, max(new_date) AS d FROM ov WHERE action LIKE '%Desistimiento%' GROUP BY number)
SELECT o.o_orderkey, strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') AS order_date,
       strftime(CASE WHEN sale.d IS NOT NULL THEN sale.d ELSE COALESCE(CAST(o.o_orderdate AS DATE), DATE '1900-01-01') END,
                '%Y-%m-%d') AS sale_date,
       strftime(wd.d, '%Y-%m-%d') AS withdrawal_date,
       CAST(CASE WHEN sale.d IS NOT NULL OR wd.d IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS overridden
FROM orders o LEFT JOIN sale ON sale.number = CAST(o.o_orderkey AS VARCHAR)
LEFT JOIN wd ON wd.number = CAST(o.o_orderkey AS VARCHAR)
""")
def q_literal_override_rows(spark, sf_dir):
    """Hand-kept corrections of sale and withdrawal dates applied over every order."""
    t = Tables(spark, sf_dir)
    ov = literal_rows(spark, OVERRIDE_ROWS, _OVERRIDE_SCHEMA).withColumn("new_date", F.to_date("new_date"))
    o = t.orders.select("o_orderkey", "o_orderdate", F.col("o_orderkey").cast("string").alias("number"))
    o = apply_overrides(o, ov, "number", "o_orderdate", "Ventas", "sale_date", flag_out="_sale_ov")
    o = apply_overrides(o, ov, "number", None, "Desistimiento", "withdrawal_date", flag_out="_wd_ov")
    return o.select(
        "o_orderkey", F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("order_date"),
        F.date_format("sale_date", "yyyy-MM-dd").alias("sale_date"),
        F.date_format("withdrawal_date", "yyyy-MM-dd").alias("withdrawal_date"),
        F.greatest("_sale_ov", "_wd_ov").alias("overridden"))
