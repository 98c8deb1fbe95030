"""Queries for conditional aggregates, pivots, ordered lists, expense status and label spreading."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import NET_SQL, cents, money, net_amount, rate
from ..operators.aggregates import count_when, group_status, ordered_distinct_text, sum_if
from ..operators.pivots import dynamic_pivot, milestone_pivot, pivot_width, static_pivot
from ..sources.tables import Tables
from . import query


@query("conditional_aggregates", sql="""
SELECT l_returnflag, count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders,
       CAST(count_if(l_linestatus = 'F') AS BIGINT) AS n_closed,
       CAST(SUM(CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE)
         AS big_discount_value,
       count(CASE WHEN l_tax > 0 THEN 1 END) AS taxed_lines
FROM lineitem GROUP BY l_returnflag
""")
def q_conditional_aggregates(spark, sf_dir):
    """COUNT, COUNT DISTINCT, COUNTIF, conditional SUM and conditional COUNT per return flag."""
    t = Tables(spark, sf_dir)
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.countDistinct("l_orderkey").alias("n_orders"),
        F.count_if(F.col("l_linestatus") == "F").alias("n_closed"),
        sum_if(F.col("l_discount") > 0.05, money("l_extendedprice")).cast("double").alias("big_discount_value"),
        count_when(F.col("l_tax") > 0).alias("taxed_lines"),
    )


# The five order priorities and their pivot column names.
PRIORITY_COLUMNS = {"1-URGENT": "prio_1", "2-HIGH": "prio_2", "3-MEDIUM": "prio_3",
                    "4-NOT SPECIFIED": "prio_4", "5-LOW": "prio_5"}
_PRIO_SQL = ", ".join(f"count(*) FILTER (WHERE o.o_orderpriority = '{v}') AS {n}" for v, n in PRIORITY_COLUMNS.items())


@query("static_pivot", sql=f"""
SELECT c.c_mktsegment, {_PRIO_SQL}
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY c.c_mktsegment
""")
def q_static_pivot(spark, sf_dir):
    """Order counts by priority (one column per listed value) per market segment."""
    t = Tables(spark, sf_dir)
    o = t.orders.select("o_custkey", "o_orderpriority").join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    return static_pivot(o, ["c_mktsegment"], "o_orderpriority", PRIORITY_COLUMNS)


_SLOT_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dynamic_pivot", sql=f"""
WITH s AS (SELECT l_orderkey, l_partkey, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_SLOT_ORDER)}) AS slot FROM lineitem)
SELECT l_orderkey, count(*) AS n_lines, max(CASE WHEN slot = 1 THEN l_partkey END) AS part_1,
       string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY slot) AS parts,
       string_agg(CAST(qty AS VARCHAR), ',' ORDER BY slot) AS quantities
FROM s GROUP BY l_orderkey
""")
def q_dynamic_pivot(spark, sf_dir):
    """Every order: each line's part and quantity as numbered columns, as many as the largest
    order has lines; shown as the lists of the numbered columns, which do not depend on the width."""
    t = Tables(spark, sf_dir)
    li = t.lineitem
    width = pivot_width(li, ["l_orderkey"])
    wide = dynamic_pivot(li, ["l_orderkey"], _SLOT_ORDER,
                         {"part": "l_partkey", "qty": money("l_quantity")}, width=width, count_as="n_lines")
    slots = range(1, width + 1)
    return wide.select("l_orderkey", "n_lines", *(["part_1"] if width else [F.lit(None).cast("long").alias("part_1")]),
                       F.concat_ws(",", *[F.col(f"part_{i}") for i in slots]).alias("parts"),
                       F.concat_ws(",", *[F.col(f"qty_{i}") for i in slots]).alias("quantities"))


# Milestone codes (event kinds) and their columns.
MILESTONES = {"click": "first_click", "error": "first_error", "purchase": "first_purchase",
              "signup": "first_signup", "view": "first_view"}
_MS_SQL = ", ".join(f"strftime(min(CASE WHEN event_type = '{c}' THEN ts END), '%Y-%m-%d %H:%M:%S.%f') AS {n}"
                    for c, n in MILESTONES.items())


@query("milestone_pivot", sql=f"SELECT user_id, {_MS_SQL} FROM events GROUP BY user_id")
def q_milestone_pivot(spark, sf_dir):
    """First time each user reached each milestone."""
    t = Tables(spark, sf_dir)
    p = milestone_pivot(t.events, ["user_id"], "event_type", "ts", MILESTONES)
    return p.select("user_id", *[F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(n) for n in MILESTONES.values()])


@query("ordered_text_list", sql="""
SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities,
       min(o_orderpriority) AS first_priority, count(DISTINCT o_orderpriority) AS n_priorities,
       count(*) AS n_orders
FROM orders GROUP BY o_custkey
""")
def q_ordered_text_list(spark, sf_dir):
    """Distinct priorities per customer as ordered text, first item and count."""
    t = Tables(spark, sf_dir)
    g = t.orders.groupBy("o_custkey").agg(
        ordered_distinct_text("o_orderpriority").alias("priorities"),
        F.sort_array(F.collect_set("o_orderpriority")).alias("_set"),
        F.count(F.lit(1)).alias("n_orders"))
    return g.select("o_custkey", "priorities", F.get("_set", 0).alias("first_priority"),
                    F.size("_set").cast("long").alias("n_priorities"), "n_orders")


# Accounting status of an order by its lines' posting.
POSTING_LABELS = ("CONTABILIZADO", "NO CONTABILIZADO", "PARCIAL")


@query("expense_mart", sql=f"""
WITH lines AS (SELECT l_orderkey, l_linestatus, {NET_SQL} AS net, CAST(l_tax AS DECIMAL(7,4)) AS rate FROM lineitem),
tax AS (SELECT l_orderkey, SUM(ROUND(net * rate, 2)) AS tax FROM lines GROUP BY l_orderkey),
agg AS (SELECT l_orderkey, count(*) AS n_lines, SUM(net) AS net,
               CASE WHEN count_if(l_linestatus = 'F') = count(*) THEN '{POSTING_LABELS[0]}'
                    WHEN count_if(l_linestatus = 'F') = 0 THEN '{POSTING_LABELS[1]}'
                    ELSE '{POSTING_LABELS[2]}' END AS posting_status
        FROM lines GROUP BY l_orderkey)
SELECT a.l_orderkey AS o_orderkey, a.n_lines, CAST(a.net AS DOUBLE) AS net, CAST(t.tax AS DOUBLE) AS tax,
       CAST(a.net + t.tax AS DOUBLE) AS total, o.o_totalprice AS order_value, a.posting_status
FROM agg a JOIN tax t ON t.l_orderkey = a.l_orderkey JOIN orders o ON o.o_orderkey = a.l_orderkey
WHERE a.net + t.tax <> 0
""")
def q_expense_mart(spark, sf_dir):
    """Per order: net, tax, total, order value and posted/not posted/partial status; a total of 0 is left out (HAVING)."""
    t = Tables(spark, sf_dir)
    lines = t.lineitem.select("l_orderkey", "l_linestatus", net_amount().alias("net"),
                              rate("l_tax").alias("rate"))
    # net, tax and posting status in one pass (the tax lookup of the source system
    # becomes a second measure of the same aggregate, not a self-join)
    agg = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("net").alias("net"),
        F.sum(F.round(F.col("net") * F.col("rate"), 2)).alias("tax"),
        group_status(F.col("l_linestatus") == "F", *POSTING_LABELS).alias("posting_status"),
    ).filter(F.col("net") + F.col("tax") != 0)
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("order_value"))
    out = agg.join(o, "l_orderkey")
    return out.select(F.col("l_orderkey").alias("o_orderkey"), "n_lines", cents("net").alias("net"),
                      cents("tax").alias("tax"), cents(F.col("net") + F.col("tax")).alias("total"),
                      "order_value", "posting_status")


@query("spread_label", sql="""
WITH j AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_brand, p.p_name
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, p_brand, max(p_name) OVER (PARTITION BY p_brand) AS brand_label FROM j
""")
def q_spread_label(spark, sf_dir):
    """``MAX(name) OVER (PARTITION BY brand)`` on every line: the parts that occur on a line are
    labelled by brand (one row per part), and lines take the label by their part key."""
    from ..operators.ledger import spread_label

    t = Tables(spark, sf_dir)
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name").join(
        t.lineitem.select("l_partkey"), "l_partkey", "left_semi")
    labelled = spread_label(parts, ["p_brand"], "p_name", "brand_label").select("l_partkey", "p_brand", "brand_label")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(labelled, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "p_brand", "brand_label")


# Return flags pivoted into amount columns.
FLAG_COLUMNS = {"A": "amount_a", "N": "amount_n", "R": "amount_r"}
_FLAG_SQL = ", ".join(f"CAST(COALESCE(SUM(CASE WHEN l_returnflag = '{f}' THEN {NET_SQL} END), 0) AS DOUBLE) AS {c}"
                      for f, c in FLAG_COLUMNS.items())


@query("statement_pivot", sql=f"""
SELECT l_orderkey, {_FLAG_SQL}, strftime(CAST(max(l_shipdate) AS DATE), '%Y-%m-%d') AS last_ship_date,
       count(*) AS n_lines
FROM lineitem GROUP BY l_orderkey
""")
def q_statement_pivot(spark, sf_dir):
    """One row per order: net amounts pivoted by return flag (0 when absent) and the last shipment."""
    t = Tables(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_returnflag", "l_shipdate", net_amount().alias("net"))
    p = static_pivot(li, ["l_orderkey"], "l_returnflag", FLAG_COLUMNS, agg="sum", value_col="net", fill=0,
                     extra_aggs={"_last": F.max("l_shipdate"), "n_lines": F.count(F.lit(1))})
    return p.select(
        "l_orderkey", *[F.col(c).cast("double").alias(c) for c in FLAG_COLUMNS.values()],
        F.date_format(F.to_date("_last"), "yyyy-MM-dd").alias("last_ship_date"), "n_lines")
