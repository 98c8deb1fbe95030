"""Marts with a second buyer found through the first, a long chain of party lookups, and a master row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import same_month
from ..functions.money import money, second_party
from ..operators.lookup import fallback_chain, master_join
from ..operators.pivots import milestone_pivot
from ..sources.tables import Tables
from . import AS_OF_ORDERS, query

# Return flags as milestones of an order.
_STEPS = {"A": "accepted", "N": "notified", "R": "returned"}
_STEP_SQL = ", ".join(f"strftime(min(CASE WHEN l_returnflag = '{f}' THEN l_shipdate END), '%Y-%m-%d') AS {n}"
                      for f, n in _STEPS.items())


@query("two_buyer_mart", sql=f"""
WITH steps AS (SELECT l_orderkey, {_STEP_SQL} FROM lineitem GROUP BY l_orderkey),
share AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 5000 THEN 100 ELSE 60 END AS pct, c_custkey + 1 AS partner FROM customer)
SELECT o.o_orderkey, a.c_name AS first_buyer, CAST(a.pct AS BIGINT) AS first_share,
       CASE WHEN a.pct < 100 THEN b.c_name END AS second_buyer,
       CAST(CASE WHEN a.pct < 100 AND b.c_name IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS has_second,
       s.accepted, s.notified, s.returned,
       CAST(CASE WHEN date_trunc('month', o.o_orderdate) = date_trunc('month', DATE '{AS_OF_ORDERS}') THEN 1 ELSE 0 END AS BIGINT)
         AS ordered_this_month
FROM orders o JOIN share a ON a.c_custkey = o.o_custkey LEFT JOIN share b ON b.c_custkey = a.partner
LEFT JOIN steps s ON s.l_orderkey = o.o_orderkey
""")
def q_two_buyer_mart(spark, sf_dir):
    """Order with its first buyer, the second through the first (hidden when the first holds all), and milestones."""
    t = Tables(spark, sf_dir)
    share = F.when(F.col("c_acctbal") < 5000, 100).otherwise(60).cast("long")
    first = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("first_buyer"), share.alias("first_share"),
                              (F.col("c_custkey") + 1).alias("partner"))
    second = t.customer.select(F.col("c_custkey").alias("partner"), F.col("c_name").alias("_second"))
    steps = milestone_pivot(t.lineitem, ["l_orderkey"], "l_returnflag", "l_shipdate", _STEPS)
    j = (t.orders.select("o_orderkey", "o_custkey", "o_orderdate").join(first.join(second, "partner", "left"), "o_custkey")
         .join(steps, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
    shown = second_party("_second", "first_share")
    return j.select("o_orderkey", "first_buyer", "first_share", shown.alias("second_buyer"),
                    shown.isNotNull().cast("long").alias("has_second"),
                    *[F.date_format(n, "yyyy-MM-dd").alias(n) for n in _STEPS.values()],
                    same_month("o_orderdate", AS_OF_ORDERS).cast("long").alias("ordered_this_month"))


@query("party_chain", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       COALESCE(a.s_name, b.c_name, p.p_brand, d.s_name, e.n_name, 'S/N') AS party,
       CASE WHEN a.s_name IS NOT NULL THEN 'PAYABLES' WHEN b.c_name IS NOT NULL THEN 'JOURNAL' WHEN p.p_brand IS NOT NULL THEN 'PARTY'
            WHEN d.s_name IS NOT NULL THEN 'RECEIVABLES' WHEN e.n_name IS NOT NULL THEN 'PURCHASE' ELSE 'NONE' END AS party_source
FROM lineitem l
LEFT JOIN supplier a ON a.s_suppkey = l.l_suppkey AND a.s_acctbal > 8000
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer b ON b.c_custkey = o.o_custkey AND b.c_acctbal > 8000
LEFT JOIN part p ON p.p_partkey = l.l_partkey AND p.p_size > 40
LEFT JOIN supplier d ON d.s_suppkey = l.l_suppkey AND d.s_acctbal > 2000
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation e ON e.n_nationkey = s.s_nationkey AND e.n_regionkey < 3
""")
def q_party_chain(spark, sf_dir):
    """Party of each line along five lookups given as data, else 'S/N'; every link supplies some rows."""
    t = Tables(spark, sf_dir)
    s, c = t.supplier, t.customer
    buyers = t.orders.select("o_orderkey", "o_custkey").join(
        c.filter(F.col("c_acctbal") > 8000).select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    nations = s.join(t.nation.filter(F.col("n_regionkey") < 3).select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
    chain = [
        ("PAYABLES", s.filter(F.col("s_acctbal") > 8000), "l_suppkey", "s_suppkey", "s_name"),
        ("JOURNAL", buyers, "l_orderkey", "o_orderkey", "c_name"),
        ("PARTY", t.part.filter(F.col("p_size") > 40), "l_partkey", "p_partkey", "p_brand"),
        ("RECEIVABLES", s.filter(F.col("s_acctbal") > 2000), "l_suppkey", "s_suppkey", "s_name"),
        ("PURCHASE", nations, "l_suppkey", "s_suppkey", "n_name"),
    ]
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return fallback_chain(lines, chain, "party", default="S/N", source_col="party_source")


@query("master_row", sql="""
WITH o AS (SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
           FROM orders WHERE o_orderstatus <> 'P'),
e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
k AS (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM o UNION SELECT user_id FROM e)
SELECT k.k, c.c_name AS customer_c_name, CAST(CAST(c.c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS balance,
       COALESCE(o.o_orderkey, -1) AS newest_order, e.event_type AS event_event_type
FROM k LEFT JOIN customer c ON c.c_custkey = k.k LEFT JOIN o ON o.o_custkey = k.k AND o.rn = 1
LEFT JOIN e ON e.user_id = k.k AND e.rn = 1
""")
def q_master_row(spark, sf_dir):
    """One row per key over customers, their orders and events: the newest row of each source, any may be missing."""
    t = Tables(spark, sf_dir)
    out = master_join({
        "customer": (t.customer.select("c_custkey", "c_name", money("c_acctbal").alias("c_acctbal")), "c_custkey"),
        "order": (t.orders.filter(F.col("o_orderstatus") != "P").select("o_custkey", "o_orderdate", "o_orderkey"), "o_custkey"),
        "event": (t.events.select("user_id", "ts", "event_id", "event_type"), "user_id"),
    }, "k", {"customer": ["c_name"], "order": ["o_orderdate", "o_orderkey"], "event": ["ts", "event_id"]})
    return out.select("k", "customer_c_name", F.col("customer_c_acctbal").cast("double").alias("balance"), F.coalesce("order_o_orderkey", F.lit(-1)).alias("newest_order"),
                      "event_event_type")
