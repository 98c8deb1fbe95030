"""Property mart and purchase fact over the driver tables.

Parts stand for properties and orders for sales: an order sells its parts, its
priority is the sale's stage, its status F a withdrawal, and its lines are the
account statement and the milestones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import cents, money
from ..operators.pivots import milestone_pivot
from ..operators.property import FUND, HOUSING, MILESTONES, UP_TO_DATE, property_mart, purchase_fact
from ..sources.tables import Tables, literal_rows
from . import AS_OF_ORDERS, query

# Milestone by return flag and line status; statement concept by line number.
_CODES = dict(zip(("AF", "AO", "NF", "NO", "RF", "RO"), MILESTONES, strict=True))
_CONCEPTS = {1: "SEPARACION", 2: "CONFIRMACION", 3: "CUOTA 1", 4: "ULTIMA CUOTA", 5: "SUBSIDIO 1", 6: "CREDITO", 7: "CESANTIAS 1"}
_SECOND = {5: "SUBSIDIO 2", 6: "CREDITO TERCERO 1"}  # of suppliers with an odd number
_PARTIES = (FUND + " A", "FONDO " + HOUSING, "OTRA ENTIDAD")

_MONTHS = "strftime({}, '%B')"
_STEP_SQL = ", ".join(f"min(CASE WHEN l_returnflag || l_linestatus = '{c}' THEN CAST(l_shipdate AS DATE) END) AS {n}" for c, n in _CODES.items())
_CONCEPT_SQL = " ".join(f"WHEN {n} THEN '{c}'" for n, c in _CONCEPTS.items())
_INITIAL_SQL = ("(concept LIKE 'CUOTA %' OR concept IN ('ULTIMA CUOTA', 'SEPARACION', 'CONFIRMACION') OR concept LIKE 'CESANTIAS %' "
                "OR concept LIKE 'SUBSIDIO %')")
_INSTALMENT_SQL = "(concept LIKE 'CUOTA %' OR concept = 'ULTIMA CUOTA')"


@query("property_mart", sql=f"""
WITH items AS (SELECT * FROM (
  SELECT p_partkey AS item, p_name || '/' || p_brand AS name, p_brand || '-' || p_size || '-' || p_type AS reference, p_size % 25 AS project,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price, row_number() OVER (PARTITION BY p_name || '/' || p_brand ORDER BY p_partkey DESC) AS rn
  FROM part) WHERE rn = 1),
sales AS (SELECT DISTINCT l.l_partkey AS item, o.o_orderkey AS sale, CAST(o.o_orderdate AS DATE) AS sale_date,
                 substr(o.o_orderpriority, 1, 1) AS stage, CASE WHEN o.o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS withdrawn,
                 CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount, o.o_custkey AS buyer, o.o_custkey + 2 AS seller
          FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
live AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY sale_date DESC, sale DESC) AS rn FROM sales
                        WHERE stage <> '1' AND withdrawn = 'N') WHERE rn = 1),
gone AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY sale_date DESC, sale DESC) AS rn FROM sales
                        WHERE stage <> '1' AND withdrawn = 'Y') WHERE rn = 1),
n_gone AS (SELECT item, count(*) AS n FROM sales WHERE stage <> '1' AND withdrawn = 'Y' GROUP BY item),
n_all AS (SELECT item, count(*) AS n FROM sales GROUP BY item),
lines AS (SELECT l_orderkey AS sale, CASE WHEN l_suppkey % 2 = 1 AND l_linenumber = 5 THEN 'SUBSIDIO 2'
                      WHEN l_suppkey % 2 = 1 AND l_linenumber = 6 THEN 'CREDITO TERCERO 1' ELSE CASE l_linenumber {_CONCEPT_SQL} END END AS concept,
                 CAST(l_extendedprice AS DECIMAL(18,2)) AS agreed, CAST(l_quantity AS DECIMAL(18,2)) AS paid,
                 CAST(l_extendedprice AS DECIMAL(18,2)) AS overdue, CAST(l_quantity AS BIGINT) AS days_late,
                 CASE WHEN l_returnflag = 'A' THEN '{UP_TO_DATE}' ELSE 'MORA ' || l_returnflag END AS state,
                 CASE l_suppkey % 3 WHEN 0 THEN '{_PARTIES[0]}' WHEN 1 THEN '{_PARTIES[1]}' ELSE '{_PARTIES[2]}' END AS party FROM lineitem),
st AS (SELECT sale, SUM(CASE WHEN {_INITIAL_SQL} THEN agreed ELSE 0 END) AS initial_total, SUM(paid) AS paid_total,
              SUM(CASE WHEN state <> '{UP_TO_DATE}' THEN overdue ELSE 0 END) AS overdue,
              MAX(CASE WHEN state <> '{UP_TO_DATE}' THEN days_late END) AS days_late,
              MAX(CASE WHEN state <> '{UP_TO_DATE}' THEN state END) AS late_state,
              COUNT(CASE WHEN {_INSTALMENT_SQL} THEN 1 END) AS n_instalments, SUM(CASE WHEN {_INSTALMENT_SQL} THEN agreed END) AS instalments,
              MAX(CASE WHEN concept = 'SEPARACION' THEN paid END) AS deposit, MAX(CASE WHEN concept = 'CONFIRMACION' THEN paid END) AS confirmation,
              SUM(CASE WHEN concept LIKE 'CESANTIAS %' THEN agreed END) AS severance, SUM(CASE WHEN concept LIKE 'SUBSIDIO %' THEN agreed END) AS subsidy,
              MAX(CASE WHEN concept = 'SUBSIDIO 1' THEN party END) AS s1, MAX(CASE WHEN concept = 'SUBSIDIO 2' THEN party END) AS s2,
              SUM(CASE WHEN concept LIKE 'CREDITO%' THEN agreed END) AS loans, SUM(CASE WHEN concept = 'CREDITO' THEN agreed END) AS loan,
              MAX(CASE WHEN concept = 'CREDITO' THEN party END) AS loan_party FROM lines GROUP BY sale),
steps AS (SELECT l_orderkey AS sale, {_STEP_SQL} FROM lineitem GROUP BY l_orderkey),
homes AS (SELECT c_nationkey AS project, count(*) AS n FROM customer GROUP BY 1),
j AS (SELECT i.item, i.name, split_part(i.reference, '-', 1) AS tower, split_part(i.reference, '-', 2) AS unit, i.price, live.sale AS live_sale,
             COALESCE(live.sale, gone.sale) AS shown_sale, COALESCE(live.sale_date, gone.sale_date) AS sale_date,
             COALESCE(live.stage, gone.stage) AS stage, COALESCE(live.withdrawn, gone.withdrawn) AS withdrawn,
             COALESCE(live.amount, gone.amount) AS amount, COALESCE(live.buyer, gone.buyer) AS buyer, COALESCE(live.seller, gone.seller) AS seller,
             gone.sale_date AS last_withdrawn, COALESCE(n_gone.n, 0) AS n_withdrawn, CASE WHEN gone.sale IS NOT NULL THEN n_all.n END AS n_optioned,
             n.n_name AS project_name, r.r_name AS kind, COALESCE(homes.n, 0) AS n_homes,
             CAST(DATE '2001-12-15' + INTERVAL 1 DAY * (i.project * 10) AS DATE) AS first_payment_end
      FROM items i LEFT JOIN nation n ON n.n_nationkey = i.project LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
      LEFT JOIN homes ON homes.project = i.project LEFT JOIN live ON live.item = i.item LEFT JOIN gone ON gone.item = i.item
      LEFT JOIN n_gone ON n_gone.item = i.item LEFT JOIN n_all ON n_all.item = i.item)
SELECT j.item, j.name, j.tower, j.unit, CAST(j.price AS DOUBLE) AS price,
       CASE WHEN live_sale IS NULL THEN 'A. NO VENDIDO' WHEN s.fesc IS NOT NULL THEN 'D. ESCRITURADO'
            WHEN s.llpt IS NOT NULL THEN 'C. VENDIDO PROMETIDO' ELSE 'B. VENDIDO NO PROMETIDO' END AS sale_class,
       CAST(live_sale IS NOT NULL AS BIGINT) AS sold, project_name, kind, CAST(n_homes * 0.6 AS DOUBLE) AS break_even, shown_sale,
       strftime(sale_date, '%Y-%m-%d') AS sale_date, stage, withdrawn, CAST(amount AS DOUBLE) AS amount,
       CAST(CASE WHEN withdrawn = 'Y' THEN amount ELSE 0 END AS DOUBLE) AS withdrawn_amount, CAST(n_withdrawn AS BIGINT) AS n_withdrawn,
       strftime(last_withdrawn, '%Y-%m-%d') AS last_withdrawn, CAST(COALESCE(n_optioned, -1) AS BIGINT) AS n_optioned,
       CAST(COALESCE(strftime(last_withdrawn, '%Y-%m') = '{AS_OF_ORDERS[:7]}', FALSE) AS BIGINT) AS withdrawn_this_month,
       CAST(COALESCE(strftime(sale_date, '%Y-%m') = '{AS_OF_ORDERS[:7]}', FALSE) AS BIGINT) AS sold_this_month,
       upper(c3.c_name) AS seller_name, upper(c1.c_name) AS buyer1, upper(c2.c_name) AS buyer2,
       {", ".join(f"CAST(st.{c} AS DOUBLE) AS {c}" for c in ("initial_total", "paid_total", "overdue", "instalments", "deposit", "confirmation", "severance", "subsidy", "loans", "loan"))},
       COALESCE(st.days_late, -1) AS days_late, st.late_state, COALESCE(st.n_instalments, -1) AS n_instalments, st.loan_party,
       CAST(CASE WHEN st.subsidy IS NULL THEN 0 WHEN s1 = '{_PARTIES[2]}' OR s2 = '{_PARTIES[2]}' THEN 1 ELSE 0 END AS BIGINT) AS other_subsidy,
       CAST(COALESCE(s1 = '{_PARTIES[0]}', FALSE) OR COALESCE(s2 = '{_PARTIES[0]}', FALSE) AS BIGINT) AS fund_subsidy,
       CAST(COALESCE(s1 = '{_PARTIES[1]}', FALSE) OR COALESCE(s2 = '{_PARTIES[1]}', FALSE) AS BIGINT) AS housing_subsidy,
       CAST(date_diff('month', DATE '{AS_OF_ORDERS}', first_payment_end) AS BIGINT) AS months_to_pay,
       CAST(date_diff('day', DATE '{AS_OF_ORDERS}', first_payment_end) AS BIGINT) AS days_to_pay,
       {", ".join(f"strftime(s.{m}, '%Y-%m-%d') AS {m}" for m in MILESTONES)},
       CAST(s.rvdf IS NOT NULL AS BIGINT) AS linked, CAST(s.bstr IS NOT NULL AS BIGINT) AS blocked, CAST(s.llpt IS NOT NULL AS BIGINT) AS promised,
       upper({_MONTHS.format("s.llpt")}) AS promise_month, CAST(s.epp5 IS NOT NULL AS BIGINT) AS deed_agreed,
       upper({_MONTHS.format("s.epp5")}) AS deed_month, CAST(COALESCE(s.vcav >= DATE '{AS_OF_ORDERS}', FALSE) AS BIGINT) AS approval_valid,
       CAST(s.vcav IS NOT NULL AS BIGINT) AS approval_known, CAST(s.fesc IS NOT NULL AS BIGINT) AS deeded
FROM j LEFT JOIN customer c1 ON c1.c_custkey = j.buyer LEFT JOIN customer c2 ON c2.c_custkey = c1.c_custkey + 1
LEFT JOIN customer c3 ON c3.c_custkey = j.seller LEFT JOIN st ON st.sale = j.shown_sale LEFT JOIN steps s ON s.sale = j.shown_sale
""")
def q_property_mart(spark, sf_dir):
    """Every property with its live sale, else its last withdrawn one, and some twenty flags."""
    t = Tables(spark, sf_dir)
    li, p = t.lineitem, t.part
    name = F.concat_ws("/", "p_name", "p_brand")
    items = p.select(F.col("p_partkey").alias("item"), name.alias("name"), F.concat_ws("-", "p_brand", "p_size", "p_type").alias("reference"),
                     F.col("p_partkey").alias("price_key"), money("p_retailprice").alias("price"), (F.col("p_size") % 25).alias("project"))
    sales = li.select(F.col("l_partkey").alias("item"), F.col("l_orderkey").alias("o_orderkey")).distinct().join(t.orders, "o_orderkey").select(
        "item", F.col("o_orderkey").alias("sale"), F.to_date("o_orderdate").alias("sale_date"), F.substring("o_orderpriority", 1, 1).alias("stage"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("withdrawn"), money("o_totalprice").alias("amount"),
        F.col("o_custkey").alias("buyer"), (F.col("o_custkey") + 2).alias("seller"))
    people = t.customer.select(F.col("c_custkey").alias("person"), F.col("c_name").alias("full_name"), (F.col("c_custkey") + 1).alias("partner"))
    homes = t.customer.groupBy(F.col("c_nationkey").alias("project")).agg(F.count(F.lit(1)).alias("n_homes"))
    projects = (t.nation.join(t.region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("kind")), "n_regionkey")
                .select(F.col("n_nationkey").alias("project"), F.col("n_name").alias("project_name"), "kind",
                        F.date_add(F.lit("2001-12-15").cast("date"), F.col("n_nationkey") * 10).alias("first_payment_end"))
                .join(homes, "project", "left"))
    number, odd = F.col("l_linenumber"), F.col("l_suppkey") % 2 == 1
    concept = F.lit(None).cast("string")
    for n, c in _CONCEPTS.items():
        concept = F.when(number == n, F.when(odd, F.lit(_SECOND[n])).otherwise(c) if n in _SECOND else F.lit(c)).otherwise(concept)
    party = F.element_at(F.array(*map(F.lit, _PARTIES)), (F.col("l_suppkey") % 3 + 1).cast("int"))
    price, flag = money("l_extendedprice"), F.col("l_returnflag")
    statement = li.select(F.col("l_orderkey").alias("sale"), concept.alias("concept"), price.alias("agreed"), money("l_quantity").alias("paid"),
                          price.alias("overdue"), F.col("l_quantity").cast("long").alias("days_late"),
                          F.when(flag == "A", UP_TO_DATE).otherwise(F.concat(F.lit("MORA "), flag)).alias("state"), party.alias("party"))
    steps = li.select(F.col("l_orderkey").alias("sale"), F.concat("l_returnflag", "l_linestatus").alias("code"), F.to_date("l_shipdate").alias("day"))
    mart = property_mart(items, sales, people, projects, statement, milestone_pivot(steps, ["sale"], "code", "day", _CODES), AS_OF_ORDERS)
    shown = {"date": lambda c: F.date_format(c, "yyyy-MM-dd").alias(c), "deci": lambda c: cents(c).alias(c),
             "bigi": lambda c: F.coalesce(c, F.lit(-1)).alias(c)}
    return mart.select(*[shown.get(kind[:4], F.col)(c) for c, kind in mart.dtypes])


# Days to pay by terms code.
_TERMS = [("1", 0), ("2", 15), ("3", 30), ("4", 60)]
_TERM_VALUES = ", ".join(f"('{c}', {d})" for c, d in _TERMS)


@query("purchase_fact", sql=f"""
WITH terms(code, due_days) AS (VALUES {_TERM_VALUES}),
lines AS (SELECT l_orderkey, l_linenumber, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
                 min(l_partkey) AS part FROM lineitem WHERE l_linenumber > 1 GROUP BY 1, 2),
dist AS (SELECT l_orderkey, l_linenumber, l_orderkey || '.' || l_linenumber || '.' || l_suppkey AS distribution,
                SUM(CAST(l_tax AS DECIMAL(18,2))) AS lost_tax FROM lineitem WHERE l_linenumber > 2 GROUP BY 1, 2, 3),
receipts AS (SELECT l_orderkey || '.' || l_linenumber || '.' || l_suppkey AS distribution,
                    l_orderkey || '.' || l_linenumber || '.' || l_suppkey || '.' || l_returnflag AS receipt, l_returnflag AS kind
             FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2, 3)
SELECT sha256(CAST(o.o_orderkey AS VARCHAR)) AS sk_header, sha256(CAST(l.l_linenumber AS VARCHAR)) AS sk_line, sha256(d.distribution) AS sk_distribution,
       sha256(r.receipt) AS sk_receipt, sha256(CAST(o.o_custkey AS VARCHAR)) AS sk_vendor, o.o_orderkey AS header, CAST(COALESCE(l.l_linenumber, -1) AS BIGINT) AS line,
       CAST(COALESCE(t.due_days, -1) AS BIGINT) AS due_days, o.o_orderstatus AS status, strftime(o.o_orderdate, '%Y-%m-%d') AS ordered,
       CAST(l.amount AS DOUBLE) AS amount, CAST(l.quantity AS DOUBLE) AS quantity, COALESCE(CAST(l.amount * 100 AS BIGINT) // CAST(l.quantity AS BIGINT), -1) AS unit_cents,
       CAST(d.lost_tax AS DOUBLE) AS lost_tax, r.kind AS receipt_kind, p.p_brand AS request, p.p_type AS request_state
FROM orders o LEFT JOIN terms t ON t.code = substr(o.o_orderpriority, 1, 1) LEFT JOIN lines l ON l.l_orderkey = o.o_orderkey
LEFT JOIN dist d ON d.l_orderkey = l.l_orderkey AND d.l_linenumber = l.l_linenumber LEFT JOIN receipts r ON r.distribution = d.distribution
LEFT JOIN part p ON p.p_partkey = l.part AND p.p_size > 25
""")
def q_purchase_fact(spark, sf_dir):
    """Purchase orders by line, distribution and receipt; parts of a size over 25 came from a request."""
    t = Tables(spark, sf_dir)
    li = t.lineitem
    keys = [F.col("l_orderkey").alias("header"), F.col("l_linenumber").alias("line")]
    dist = F.concat_ws(".", "l_orderkey", "l_linenumber", "l_suppkey").alias("distribution")
    headers = t.orders.select(F.col("o_orderkey").alias("header"), F.col("o_custkey").alias("vendor"), F.col("o_orderstatus").alias("status"),
                              F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered"), F.substring("o_orderpriority", 1, 1).alias("terms"))
    terms = literal_rows(spark, _TERMS, "terms string, due_days bigint")
    # a line's request is found from its first part, so lines are summed once and split
    lines = li.filter("l_linenumber > 1").groupBy(*keys).agg(
        F.sum(money("l_extendedprice")).alias("amount"), F.sum(money("l_quantity")).alias("quantity"), F.min("l_partkey").alias("p_partkey"))
    wanted = t.part.filter("p_size > 25").select("p_partkey", F.col("p_brand").alias("request"), F.col("p_type").alias("request_state"))
    requests = lines.join(wanted, "p_partkey").select("header", "line", "request", "request_state")
    dists = li.filter("l_linenumber > 2").groupBy(*keys, dist).agg(F.sum(money("l_tax")).alias("lost_tax"))
    receipts = li.filter("l_linestatus = 'F'").select(dist, F.col("l_returnflag").alias("receipt_kind")).distinct().withColumn(
        "receipt", F.concat_ws(".", "distribution", "receipt_kind"))
    known = lambda x, name: F.coalesce(x, F.lit(-1)).alias(name)
    fact = purchase_fact(headers, lines.drop("p_partkey"), dists, receipts, requests, terms)
    return fact.select(*[c for c in fact.columns if c.startswith("sk_")], "header", known(F.col("line").cast("long"), "line"), known(F.col("due_days"), "due_days"), "status",
                       "ordered", cents("amount").alias("amount"), cents("quantity").alias("quantity"),
                       known(F.expr("cast(amount * 100 as long) div cast(quantity as long)"), "unit_cents"),
                       cents("lost_tax").alias("lost_tax"), "receipt_kind", "request", "request_state")
