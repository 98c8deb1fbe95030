"""Queries for star/snowflake joins, role-playing dimensions, lookups and conforming."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import NET_SQL, cents, money, net_amount
from ..operators.conform import (
    best_keyword_match,
    classify_by_prefix,
    conform_parties,
    union_tagged,
)
from ..operators.lookup import fallback, fallback_chain, scalar_lookup, star_join
from ..sources.tables import Tables, literal_rows
from . import query


@query("star_fact", sql=f"""
WITH ps AS (SELECT l_partkey, l_suppkey, count(*) AS ps_lines FROM lineitem GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_custkey, c.c_name, p.p_name, s.s_name,
       strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') AS order_date,
       CAST({NET_SQL.replace('l_', 'l.l_')} AS DOUBLE) AS net, ps.ps_lines
FROM orders o RIGHT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN part p ON p.p_partkey = l.l_partkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN ps ON ps.l_partkey = l.l_partkey AND ps.l_suppkey = l.l_suppkey
WHERE o.o_orderkey IS NOT NULL
""")
def q_star_fact(spark, sf_dir):
    """Line fact with its order, customer, part, supplier and part/supplier stats.

    Lines meet orders first (both keyed on the order key); a right join whose
    optional side is then filtered is planned as the inner join it is.
    """
    t = Tables(spark, sf_dir)
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    lines = o.join(li, li.l_orderkey == o.o_orderkey, "right").filter(F.col("o_orderkey").isNotNull())
    ps = li.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("ps_lines"))
    fact = star_join(lines, [
        (t.customer.select("c_custkey", "c_name"), "o_custkey", "c_custkey"),
        (t.part.select("p_partkey", "p_name"), "l_partkey", "p_partkey"),
        (t.supplier.select("s_suppkey", "s_name"), "l_suppkey", "s_suppkey"),
        (ps, ["l_partkey", "l_suppkey"], ["l_partkey", "l_suppkey"]),
    ])
    return fact.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "c_name", "p_name",
                       "s_name", F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("order_date"),
                       net_amount().cast("double").alias("net"), "ps_lines")


@query("role_playing_dims", sql=f"""
WITH lines AS (
  SELECT cn.n_name AS cust_nation, cr.r_name AS cust_region, sn.n_name AS supp_nation, sr.r_name AS supp_region,
         fn.n_nationkey AS foreign_key, {NET_SQL} AS net
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation cn ON cn.n_nationkey = c.c_nationkey JOIN region cr ON cr.r_regionkey = cn.n_regionkey
  JOIN nation sn ON sn.n_nationkey = s.s_nationkey JOIN region sr ON sr.r_regionkey = sn.n_regionkey
  LEFT JOIN nation fn ON fn.n_nationkey = s.s_nationkey AND fn.n_nationkey <> c.c_nationkey),
agg AS (
  SELECT cust_nation, cust_region, supp_nation, supp_region, count(*) AS n_lines, SUM(net) AS revenue,
         CAST(max(CASE WHEN foreign_key IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS cross_border
  FROM lines GROUP BY 1, 2, 3, 4)
SELECT cust_nation, cust_region, supp_nation, supp_region, n_lines, CAST(revenue AS DOUBLE) AS revenue, cross_border,
       row_number() OVER (PARTITION BY cust_region, supp_region
                          ORDER BY revenue DESC, cust_nation, supp_nation) AS rank_in_regions
FROM agg
""")
def q_role_playing_dims(spark, sf_dir):
    """Nation and region joined twice (customer side, supplier side); the supplier's nation
    is joined a third time only when it differs from the customer's (inequality in ON)."""
    from pyspark.sql import Window

    t = Tables(spark, sf_dir)
    nation, region = t.nation, t.region

    def nation_role(prefix):
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias(f"{prefix}_nationkey"), F.col("n_name").alias(f"{prefix}_nation"),
            F.col("r_name").alias(f"{prefix}_region"))

    li = t.lineitem.select("l_orderkey", "l_suppkey", net_amount().alias("net"))
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("cust_nationkey"))
    s = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("supp_nationkey"))
    foreign = nation.select(F.col("n_nationkey").alias("foreign_key"))
    lines = (
        li.join(o, "l_orderkey").join(c, "o_custkey").join(s, "l_suppkey")
        .join(nation_role("cust"), "cust_nationkey").join(nation_role("supp"), "supp_nationkey")
        .join(foreign, (F.col("foreign_key") == F.col("supp_nationkey"))
              & (F.col("foreign_key") != F.col("cust_nationkey")), "left")
    )
    agg = lines.groupBy("cust_nation", "cust_region", "supp_nation", "supp_region").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("net").alias("revenue"),
        F.max(F.col("foreign_key").isNotNull().cast("long")).alias("cross_border"))
    w = Window.partitionBy("cust_region", "supp_region").orderBy(
        F.col("revenue").desc(), "cust_nation", "supp_nation")
    return agg.select("cust_nation", "cust_region", "supp_nation", "supp_region", "n_lines",
                      cents("revenue").alias("revenue"), "cross_border",
                      F.row_number().over(w).cast("long").alias("rank_in_regions"))


@query("snowflake_mart", sql="""
SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_acctbal, n.n_name, r.r_name,
       sha256(CAST(c.c_custkey AS VARCHAR)) AS sk_customer
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def q_snowflake_mart(spark, sf_dir):
    """Customer flattened through nation to region (snowflake chain)."""
    t = Tables(spark, sf_dir)
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    c = t.customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "n_name", "r_name",
                    F.sha2(F.col("c_custkey").cast("string"), 256).alias("sk_customer"))


@query("lookup_scalar", sql="""
WITH agg AS (SELECT o_custkey, max(o_orderdate) AS last_ts, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS total,
                    count(*) AS n FROM orders GROUP BY o_custkey),
last AS (SELECT o_custkey, o_orderpriority FROM (
           SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
           FROM orders) WHERE rn = 1)
SELECT c.c_custkey, strftime(CAST(agg.last_ts AS DATE), '%Y-%m-%d') AS last_order_date,
       CAST(COALESCE(agg.total, 0) AS DOUBLE) AS total_spent, COALESCE(agg.n, 0) AS n_orders,
       last.o_orderpriority AS last_priority
FROM customer c LEFT JOIN agg ON agg.o_custkey = c.c_custkey LEFT JOIN last ON last.o_custkey = c.c_custkey
""")
def q_lookup_scalar(spark, sf_dir):
    """Correlated scalar subqueries (MAX, SUM, COUNT, and the latest row's value) as one
    pre-aggregated lookup: every measure, including the latest row (a struct max), comes
    from a single aggregation of orders joined once."""
    t = Tables(spark, sf_dir)
    c = scalar_lookup(t.customer.select("c_custkey"), t.orders, "c_custkey", "o_custkey", [
        F.max("o_orderdate").alias("last_ts"), F.sum(money("o_totalprice")).alias("total"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority")).alias("_last")])
    return c.select("c_custkey", F.date_format(F.to_date("last_ts"), "yyyy-MM-dd").alias("last_order_date"),
                    F.coalesce(F.col("total"), F.lit(0)).cast("double").alias("total_spent"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_orders"),
                    F.col("_last.o_orderpriority").alias("last_priority"))


# Label of a line whose party is found nowhere in the chain.
NO_PARTY = "S/N"


@query("fallback_enrich", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       COALESCE(s.s_name, c.c_name, 'S/N') AS party,
       CASE WHEN s.s_name IS NOT NULL THEN 'SUPPLIER' WHEN c.c_name IS NOT NULL THEN 'CUSTOMER' ELSE 'NONE' END
         AS party_source,
       COALESCE(n.n_name, 'S/N') AS party_nation
FROM lineitem l
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON s.s_suppkey = l.l_suppkey
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = COALESCE(s.s_nationkey, c.c_nationkey)
""")
def q_fallback_enrich(spark, sf_dir):
    """Party of each line: live supplier, else live customer of its order, else 'S/N' -- the
    chain is listed once, as data -- and the party's nation through a join on the coalesced key."""
    t = Tables(spark, sf_dir)
    live_s = t.supplier.filter(F.col("s_acctbal") > 0)
    order_customer = t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.filter(F.col("c_acctbal") > 0), F.col("o_custkey") == F.col("c_custkey"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    party = fallback_chain(lines, [
        ("SUPPLIER", live_s, "l_suppkey", "s_suppkey", F.struct(F.col("s_name").alias("name"),
                                                                  F.col("s_nationkey").alias("nation"))),
        ("CUSTOMER", order_customer, "l_orderkey", "o_orderkey", F.struct(F.col("c_name").alias("name"),
                                                                            F.col("c_nationkey").alias("nation"))),
    ], "_party", source_col="party_source")
    party = party.withColumn("party", fallback(F.col("_party.name"), default=NO_PARTY))
    j = party.join(t.nation.select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("_party.nation"), "left")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "party", "party_source",
                    fallback("n_name", default=NO_PARTY).alias("party_nation"))


_NORM_RE = "#0*([0-9]+)$"


@query("conform_parties", sql=f"""
WITH parties AS (
  SELECT 'CUSTOMER' AS origin, c_custkey AS id, c_name AS name FROM customer
  UNION ALL SELECT 'SUPPLIER', s_suppkey, s_name FROM supplier),
tagged AS (SELECT *, NULLIF(regexp_extract(name, '{_NORM_RE}', 1), '') AS norm_id FROM parties),
best AS (SELECT norm_id, max(name) AS best_name, count(DISTINCT name) AS n_names FROM tagged GROUP BY norm_id)
SELECT t.origin, t.id, t.name, t.norm_id, b.best_name, b.n_names
FROM tagged t LEFT JOIN best b ON b.norm_id = t.norm_id
""")
def q_conform_parties(spark, sf_dir):
    """Customers and suppliers as one party list; one best name per normalised number."""
    from ..functions.text import regex_or_null

    t = Tables(spark, sf_dir)
    parties = union_tagged({
        "CUSTOMER": t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        "SUPPLIER": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
    }, ["id", "name"])
    out = conform_parties(parties, "name", regex_or_null("name", _NORM_RE))
    return out.select("origin", "id", "name", "norm_id", "best_name", "n_names")


# Name prefix -> class.
PREFIX_CLASSES = {"small": "SIZE", "large": "SIZE", "red": "COLOR", "blue": "COLOR",
                  "hot": "TEMPERATURE", "cold": "TEMPERATURE"}
_PREFIX_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PREFIX_CLASSES.items())


@query("classify_by_prefix", sql=f"""
WITH p AS (SELECT p_partkey, NULLIF(regexp_extract(p_name, '^([a-z]+) ', 1), '') AS prefix FROM part)
SELECT prefix, CASE prefix {_PREFIX_SQL} ELSE 'OTHER' END AS system, count(*) AS n_parts
FROM p GROUP BY 1, 2
""")
def q_classify_by_prefix(spark, sf_dir):
    """Class of each part by the first word of its name; distinct classes with part counts."""
    t = Tables(spark, sf_dir)
    p = classify_by_prefix(t.part, "p_name", "^([a-z]+) ", PREFIX_CLASSES, "OTHER")
    return p.groupBy("prefix", "system").agg(F.count(F.lit(1)).alias("n_parts"))


# Keyword table (type prefix, module, words).
KEYWORDS = [
    ("STANDARD", "HARDWARE", ["bolt", "rod", "ring"]),
    ("STANDARD", "MACHINES", ["gear", "gizmo"]),
    ("MEDIUM", "HARDWARE", ["plate", "anvil"]),
    ("MEDIUM", "TOOLS", ["anvil", "widget"]),
    ("ECONOMY", "COLORS", ["red", "blue"]),
    ("ECONOMY", "TEMPERATURE", ["hot", "cold"]),
    ("LARGE", "EMPTY", []),
    ("SMALL", "SIZES", ["small", "large"]),
]
_KW_SCHEMA = T.StructType([T.StructField("prefix", T.StringType()), T.StructField("module", T.StringType()),
                           T.StructField("words", T.ArrayType(T.StringType()))])
_KW_SQL = ", ".join(f"('{a}', '{b}', [{', '.join(repr(w) for w in ws)}]::VARCHAR[])" for a, b, ws in KEYWORDS)


@query("best_keyword_match", sql=f"""
WITH kw(prefix, module, words) AS (VALUES {_KW_SQL}),
w AS (SELECT prefix, module, unnest(words) AS word FROM kw),
cand AS (SELECT p.p_partkey, w.module, w.word,
                row_number() OVER (PARTITION BY p.p_partkey ORDER BY length(w.word) DESC, w.word, w.module) AS rn
         FROM part p JOIN w ON w.prefix = p.p_type AND contains(lower(p.p_name), lower(w.word)))
SELECT p.p_partkey, p.p_name, COALESCE(c.module, 'DESCONOCIDO') AS module, c.word AS keyword
FROM part p LEFT JOIN (SELECT * FROM cand WHERE rn = 1) c ON c.p_partkey = p.p_partkey
""")
def q_best_keyword_match(spark, sf_dir):
    """Module of each part by the longest keyword in its name (keywords per part type)."""
    t = Tables(spark, sf_dir)
    kw = literal_rows(spark, KEYWORDS, _KW_SCHEMA)
    out = best_keyword_match(t.part.select("p_partkey", "p_name", "p_type"), kw, "p_partkey", "p_name", "p_type")
    return out.select("p_partkey", "p_name", "module", "keyword")
