"""Queries for keys, calendar, numbering, de-duplication, text and code lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import composite_key, hash_key, with_unknown
from ..functions.money import money
from ..functions.predicates import excluded
from ..functions.text import decode, split_count, split_nth, text_after, text_before
from ..operators.aggregates import level_rollup
from ..operators.calendar import DAYS_ES, MONTHS_ES, calendar_attributes
from ..operators.dedup import latest_by_priority, latest_per_key
from ..operators.lookup import code_lookup
from ..operators.numbering import running_number, sequence_in_parent
from ..sources.tables import Tables, calendar_between, literal_rows
from . import query

_MONTHS_SQL = " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(MONTHS_ES))
_DAYS_SQL = " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(DAYS_ES))


@query("calendar_dim", sql=f"""
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
days AS (SELECT CAST(g.d AS DATE) AS d FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS g(d)),
per_day AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT strftime(days.d, '%Y-%m-%d') AS day,
       CAST(strftime(days.d, '%Y%m%d') AS BIGINT) AS date_key,
       year(days.d) AS year, quarter(days.d) AS quarter, month(days.d) AS month,
       CAST(strftime(days.d, '%U') AS BIGINT) AS week, day(days.d) AS day_of_month,
       dayofweek(days.d) + 1 AS day_of_week,
       'T' || quarter(days.d) || '/' || right(CAST(year(days.d) AS VARCHAR), 2) AS quarter_name,
       upper(monthname(days.d)) AS month_name_en,
       CASE month(days.d) {_MONTHS_SQL} END AS month_name_es,
       upper(dayname(days.d)) AS day_name_en,
       CASE dayofweek(days.d) + 1 {_DAYS_SQL} END AS day_name_es,
       'FY' || right(CAST(year(days.d) AS VARCHAR), 2) AS fiscal_year,
       'P' || month(days.d) AS fiscal_period, 'Q' || quarter(days.d) AS fiscal_quarter,
       COALESCE(per_day.n, 0) AS n_orders
FROM days LEFT JOIN per_day ON per_day.d = days.d
""")
def q_calendar_dim(spark, sf_dir):
    """Calendar over the order-date range (taken from the data) with orders per day."""
    t = Tables(spark, sf_dir)
    # per-day counts (one row per day, small) feed both the range and the join: written
    # once to the checkpoint folder so the orders are aggregated a single time
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n_orders")).checkpoint(eager=True)
    bounds = per_day.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    cal = calendar_attributes(calendar_between(bounds, "lo", "hi"))
    # both sides are bounded by the number of days in the range
    out = cal.join(per_day, "day", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("surrogate_keys", sql="""
WITH dim_nation AS (SELECT * FROM nation WHERE n_regionkey <> 0)
SELECT c.c_custkey,
       sha256(CAST(c.c_custkey AS VARCHAR)) AS sk_customer,
       COALESCE(sha256(CAST(n.n_nationkey AS VARCHAR)), sha256('INDETERMINADO')) AS sk_nation,
       CAST(COALESCE(n.n_nationkey, -1) AS BIGINT) AS bk_nation,
       sha256(c.c_mktsegment || '|' || CAST(c.c_nationkey AS VARCHAR)) AS sk_segment_nation,
       sha256(CAST(c.c_custkey AS VARCHAR) || CAST(c.c_nationkey AS VARCHAR)) AS legacy_key
FROM customer c LEFT JOIN dim_nation n ON n.n_nationkey = c.c_nationkey
""")
def q_surrogate_keys(spark, sf_dir):
    """Hash surrogate keys, composite keys, and the unknown member for unmatched nations."""
    t = Tables(spark, sf_dir)
    dim_nation = t.nation.filter(F.col("n_regionkey") != 0).select("n_nationkey")
    c = t.customer.join(dim_nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.select(
        "c_custkey",
        hash_key("c_custkey").alias("sk_customer"),
        with_unknown(hash_key("n_nationkey")).alias("sk_nation"),
        F.coalesce("n_nationkey", F.lit(-1)).cast("long").alias("bk_nation"),
        composite_key("c_mktsegment", "c_nationkey").alias("sk_segment_nation"),
        composite_key("c_custkey", "c_nationkey", sep=None).alias("legacy_key"),
    )


@query("running_number", sql="""
SELECT c_custkey, c_name, c_acctbal,
       row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rn
FROM customer
""")
def q_running_number(spark, sf_dir):
    """Whole-table running key by balance (desc), then key — without a one-task sort."""
    t = Tables(spark, sf_dir)
    c = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return running_number(c, [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey").asc()], out="rn")


@query("latest_per_key", sql="""
SELECT o_custkey, o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS order_date,
       o_totalprice, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) WHERE rn = 1
""")
def q_latest_per_key(spark, sf_dir):
    """Newest order per customer (ties on date broken by the larger order key)."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "o_orderstatus")
    latest = latest_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest.select("o_custkey", "o_orderkey",
                         F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("order_date"),
                         "o_totalprice", "o_orderstatus")


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]


@query("sequence_in_parent", sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, {", ".join(_LINE_ORDER)}) AS seq
FROM lineitem
""")
def q_sequence_in_parent(spark, sf_dir):
    """Line slot within its order by price (desc), then every other column."""
    t = Tables(spark, sf_dir)
    li = t.lineitem
    seq = sequence_in_parent(li, ["l_orderkey"], [F.col("l_extendedprice").desc_nulls_last(), *_LINE_ORDER],
                             out="seq")
    return seq.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "seq")


# Event kinds in priority order for the "who acted last" pick.
EVENT_PRIORITY = ["purchase", "signup", "view"]


@query("latest_event_by_priority", sql="""
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value
FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id
        ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END, ts DESC, event_id DESC) AS rn
      FROM events WHERE event_type IN ('purchase', 'signup', 'view'))
WHERE rn = 1
""")
def q_latest_event_by_priority(spark, sf_dir):
    """Per user: newest purchase, else newest signup, else newest view."""
    t = Tables(spark, sf_dir)
    ev = t.events.select("user_id", "event_id", "event_type", "ts", "value")
    out = latest_by_priority(ev, ["user_id"], "event_type", EVENT_PRIORITY, ["ts", "event_id"])
    return out.select("user_id", "event_id", "event_type",
                      F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value")


@query("text_before_mark", sql="""
SELECT p_partkey,
       split_part(p_brand, '#', 1) AS brand_prefix,
       string_split(p_brand, '#')[2] AS brand_no,
       CAST(len(string_split(p_brand, '#')) AS BIGINT) AS brand_pieces,
       CAST(instr(p_brand, '#') AS BIGINT) AS mark_pos,
       split_part(p_name, ' ', 1) AS name_first,
       CASE WHEN instr(p_name, ' ') > 0 THEN substr(p_name, instr(p_name, ' ') + 1) END AS name_rest,
       lpad(CAST(p_size AS VARCHAR), 3, '0') AS size_code,
       upper(p_type) AS type_upper, CAST(length(p_name) AS BIGINT) AS name_len
FROM part
""")
def q_text_before_mark(spark, sf_dir):
    """Text before/after a mark, split and nth piece, position, padding."""
    t = Tables(spark, sf_dir)
    p = t.part
    return p.select(
        "p_partkey",
        text_before("p_brand", "#").alias("brand_prefix"),
        split_nth("p_brand", "#", 1).alias("brand_no"),
        split_count("p_brand", "#").cast("long").alias("brand_pieces"),
        F.instr("p_brand", "#").cast("long").alias("mark_pos"),
        text_before("p_name", " ").alias("name_first"),
        text_after("p_name", " ").alias("name_rest"),
        F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size_code"),
        F.upper("p_type").alias("type_upper"),
        F.length("p_name").cast("long").alias("name_len"),
    )


@query("hierarchy_levels", sql="""
WITH d AS (SELECT strftime(o_orderdate, '%Y%m%d') AS code, count(*) AS n_orders,
                  SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total
           FROM orders GROUP BY 1),
lv AS (SELECT 1 AS level, substr(code, 1, 4) AS code, n_orders, total FROM d
       UNION ALL SELECT 2, substr(code, 1, 6), n_orders, total FROM d
       UNION ALL SELECT 3, substr(code, 1, 8), n_orders, total FROM d)
SELECT CAST(level AS BIGINT) AS level, code, CAST(SUM(n_orders) AS BIGINT) AS n_orders,
       CAST(SUM(total) AS DOUBLE) AS total
FROM lv GROUP BY level, code
""")
def q_hierarchy_levels(spark, sf_dir):
    """Order totals rolled up over the yyyymmdd code cut to 4, 6 and 8 characters."""
    t = Tables(spark, sf_dir)
    daily = t.orders.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("code")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).alias("total"))
    out = level_rollup(daily, "code", [4, 6, 8], ["n_orders", "total"])
    return out.select("level", "code", "n_orders", F.col("total").cast("double").alias("total"))


@query("null_safe_exclusion", sql="""
SELECT c.c_custkey, COALESCE(o.o_orderkey, -1) AS o_orderkey, o.o_orderstatus
FROM customer c
LEFT JOIN orders o ON o.o_custkey = c.c_custkey
     AND o.o_orderdate >= TIMESTAMP '2001-01-01' AND o.o_orderdate < TIMESTAMP '2002-01-01'
WHERE (o.o_orderstatus NOT IN ('F', 'P') OR o.o_orderstatus IS NULL)
  AND c.c_name LIKE 'Customer#%' AND c.c_name NOT LIKE '%9' AND c.c_mktsegment NOT LIKE '%URN%'
""")
def q_null_safe_exclusion(spark, sf_dir):
    """Customers with their 2001 orders; excluded statuses dropped but customers without orders kept."""
    t = Tables(spark, sf_dir)
    o = t.orders.filter((F.col("o_orderdate") >= F.lit(dt.date(2001, 1, 1)))
                        & (F.col("o_orderdate") < F.lit(dt.date(2002, 1, 1))))
    c = t.customer.filter(F.col("c_name").like("Customer#%") & ~F.col("c_name").like("%9")
                          & ~F.col("c_mktsegment").like("%URN%"))
    j = c.join(o, F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.filter(excluded("o_orderstatus", ["F", "P"])).select(
        "c_custkey", F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"), "o_orderstatus")


# Code table rows (type, code, language, meaning).
CODE_ROWS = [
    ("STATUS", "f", "ES", "CERRADA"), ("STATUS", "f", "EN", "CLOSED"),
    ("STATUS", "o", "ES", "ABIERTA"), ("STATUS", "o", "EN", "OPEN"),
    ("STATUS", "p", "ES", "PARCIAL"), ("STATUS", "p", "EN", "PARTIAL"),
    ("PRIORITY", "1", "ES", "URGENTE"), ("PRIORITY", "1", "EN", "URGENT"),
    ("PRIORITY", "2", "ES", "ALTA"), ("PRIORITY", "2", "EN", "HIGH"),
    ("PRIORITY", "3", "ES", "MEDIA"), ("PRIORITY", "3", "EN", "MEDIUM"),
    ("PRIORITY", "4", "ES", "SIN ESPECIFICAR"), ("PRIORITY", "4", "EN", "NOT SPECIFIED"),
    ("PRIORITY", "5", "ES", "BAJA"), ("PRIORITY", "5", "EN", "LOW"),
]
# Status decode used when no code table is at hand.
STATUS_DECODE = {"F": "closed", "O": "open"}
_CODE_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("type", "code", "lang", "meaning")])
_CODE_VALUES = ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in CODE_ROWS)


@query("code_lookup", sql=f"""
WITH codes(type, code, lang, meaning) AS (VALUES {_CODE_VALUES}),
st AS (SELECT code, max(meaning) AS m FROM codes WHERE type = 'STATUS' AND lang = 'ES' GROUP BY code),
pr AS (SELECT CAST(code AS INTEGER) AS code, max(meaning) AS m FROM codes
       WHERE type = 'PRIORITY' AND lang = 'ES' GROUP BY 1)
SELECT o.o_orderkey, st.m AS status_label, pr.m AS priority_label,
       CAST(TRY_CAST(split_part(o.o_orderpriority, '-', 1) AS INTEGER) AS BIGINT) AS priority_no,
       CASE o.o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' ELSE 'unknown' END AS status_decode
FROM orders o
LEFT JOIN st ON st.code = lower(o.o_orderstatus)
LEFT JOIN pr ON pr.code = TRY_CAST(split_part(o.o_orderpriority, '-', 1) AS INTEGER)
""")
def q_code_lookup(spark, sf_dir):
    """Status and priority labels from a two-language code table; a literal decode beside it."""
    t = Tables(spark, sf_dir)
    codes = literal_rows(spark, CODE_ROWS, _CODE_SCHEMA)
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority",
                        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).try_cast("int").alias("priority_no"))
    o = code_lookup(o, codes, "STATUS", "ES", F.lower("o_orderstatus"), "status_label")
    o = code_lookup(o, codes, "PRIORITY", "ES", F.col("priority_no"), "priority_label", code_cast="int")
    return o.select("o_orderkey", "status_label", "priority_label", F.col("priority_no").cast("long"),
                    decode("o_orderstatus", STATUS_DECODE, "unknown").alias("status_decode"))


@query("multi_code_lookup", sql=f"""
WITH codes(type, code, lang, meaning) AS (VALUES {_CODE_VALUES}),
lk AS (SELECT type || ':' || code AS k, max(meaning) AS m FROM codes WHERE lang = 'EN' GROUP BY 1)
SELECT o.o_orderkey, s.m AS status_code_name, p.m AS priority_code_name
FROM orders o
LEFT JOIN lk s ON s.k = 'STATUS:' || lower(o.o_orderstatus)
LEFT JOIN lk p ON p.k = 'PRIORITY:' || split_part(o.o_orderpriority, '-', 1)
""")
def q_multi_code_lookup(spark, sf_dir):
    """Several code columns of each order labelled from one code table, without a shuffle of the orders."""
    from ..operators.lookup import lookup_many

    t = Tables(spark, sf_dir)
    codes = literal_rows(spark, CODE_ROWS, _CODE_SCHEMA).filter(F.col("lang") == "EN").select(
        F.concat_ws(":", "type", "code").alias("code"), "meaning")
    o = t.orders.select(
        "o_orderkey",
        F.concat(F.lit("STATUS:"), F.lower("o_orderstatus")).alias("status_code"),
        F.concat(F.lit("PRIORITY:"), F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("priority_code"))
    return lookup_many(o, ["status_code", "priority_code"], codes).select(
        "o_orderkey", "status_code_name", "priority_code_name")
