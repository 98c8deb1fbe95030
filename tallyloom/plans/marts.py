"""Statement, aging and one-row-per-entity marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import NET_SQL, cents, money, net_amount, rate
from ..operators.aging import invoice_aging, receivable_aging
from ..operators.numbering import sequence_in_parent
from ..sources.tables import Tables
from . import AS_OF_ORDERS, query

_AGING_SQL_LABEL = """
  CASE WHEN status = 'F' THEN 'AL DÍA'
       WHEN diff > 1 AND diff <= 30 THEN 'MENOS DE 30 DÍAS EN MORA'
       WHEN diff > 30 AND diff <= 90 THEN 'MÁS DE 30 DÍAS DE MORA'
       WHEN diff > 90 AND diff <= 180 THEN 'MÁS DE 90 DÍAS DE MORA'
       WHEN diff > 180 THEN 'MÁS DE 180 DÍAS DE MORA'
       ELSE 'AL DÍA' END"""


@query("receivable_aging", sql=f"""
WITH paid AS (
  SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS paid
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey),
inst AS (
  SELECT o.o_orderkey, o.o_custkey AS c_custkey, c.c_name, o.o_orderstatus AS status,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS agreed,
         CAST(o.o_orderdate AS DATE) + 30 AS due_date, p.paid
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN paid p ON p.l_orderkey = o.o_orderkey),
aged AS (
  SELECT *, date_diff('day', due_date, DATE '{AS_OF_ORDERS}') AS diff FROM inst
  WHERE NOT (status = 'F' AND (paid IS NULL OR paid = 0)))
SELECT o_orderkey, c_custkey, c_name,
       row_number() OVER (PARTITION BY c_custkey ORDER BY due_date, o_orderkey) AS instalment_no,
       strftime(due_date, '%Y-%m-%d') AS due_date,
       CAST(agreed AS DOUBLE) AS agreed, CAST(paid AS DOUBLE) AS paid,
       CASE WHEN status = 'F' THEN 0 WHEN diff < 0 THEN 0 ELSE diff END AS days_late,
       {_AGING_SQL_LABEL} AS aging_bucket,
       CAST(CASE WHEN status <> 'F' AND diff > 0 THEN 1 ELSE 0 END AS BIGINT) AS overdue_flag
FROM aged
""")
def q_receivable_aging(spark, sf_dir):
    """Orders as instalments: due 30 days after the order, status F = closed, paid = closed lines."""
    t = Tables(spark, sf_dir)
    paid = (
        t.lineitem.filter(F.col("l_linestatus") == "F")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(money("l_extendedprice")).alias("paid"))
    )
    inst = (
        t.orders.select(
            "o_orderkey",
            F.col("o_custkey").alias("c_custkey"),
            F.col("o_orderstatus").alias("status"),
            money("o_totalprice").alias("agreed"),
            F.date_add(F.to_date("o_orderdate"), 30).alias("due_date"),
        )
        .join(t.customer.select("c_custkey", "c_name"), "c_custkey")
        .join(paid, "o_orderkey", "left")
    )
    aged = receivable_aging(inst, AS_OF_ORDERS, status_col="status", closed_value="F", paid_col="paid")
    # the aging only filters orders joined one-to-one, so order counts per customer bound the parents
    numbered = sequence_in_parent(aged, ["c_custkey"], ["due_date", "o_orderkey"], out="instalment_no",
                                  hot_keys_from=t.orders.select(F.col("o_custkey").alias("c_custkey")))
    return numbered.select(
        "o_orderkey", "c_custkey", "c_name", "instalment_no",
        F.date_format("due_date", "yyyy-MM-dd").alias("due_date"),
        cents("agreed").alias("agreed"), cents("paid").alias("paid"),
        "days_late", "aging_bucket", "overdue_flag",
    )


_TERM_DAYS = 45


@query("invoice_aging", sql=f"""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) + {_TERM_DAYS} AS due FROM lineitem),
d AS (SELECT *, date_diff('day', due, DATE '{AS_OF_ORDERS}') AS days_overdue FROM l)
SELECT l_orderkey, l_linenumber, l_partkey, strftime(due, '%Y-%m-%d') AS due_date, days_overdue,
       CASE WHEN days_overdue <= 30 THEN 'Menor o igual a 30 Días'
            WHEN days_overdue > 30 AND days_overdue <= 60 THEN 'Entre 30 y 60 Días'
            WHEN days_overdue > 60 THEN 'Mayor o igual a 60 Días' ELSE 'Otro' END AS overdue_range,
       CAST((year(DATE '{AS_OF_ORDERS}') * 12 + month(DATE '{AS_OF_ORDERS}')) - (year(due) * 12 + month(due)) AS BIGINT)
         AS months_since_due,
       CAST(CASE WHEN date_trunc('month', due) = date_trunc('month', DATE '{AS_OF_ORDERS}') THEN 1 ELSE 0 END AS BIGINT)
         AS due_this_month
FROM d
""")
def q_invoice_aging(spark, sf_dir):
    """Lines as invoices due 45 days after shipping: days overdue, overdue range, months, same-month flag."""
    t = Tables(spark, sf_dir)
    aged = invoice_aging(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"),
                         AS_OF_ORDERS, "l_shipdate", _TERM_DAYS)
    return aged.select("l_orderkey", "l_linenumber", "l_partkey",
                       F.date_format("due_date", "yyyy-MM-dd").alias("due_date"), "days_overdue", "overdue_range",
                       "months_since_due", "due_this_month")


_ENTITY_COLS = ["c_custkey", "c_name", "c_mktsegment", "shown_order", "shown_status", "n_orders", "n_open",
                "n_closed", "n_pending", "open_value", "closed_value", "state", "has_open", "last_order_date",
                "ordered_this_month"]

_ENTITY_SQL = f"""
agg AS (SELECT o_custkey, count(*) AS n_orders,
               count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS n_open,
               count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_closed,
               count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS n_pending,
               SUM(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS open_value,
               SUM(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS closed_value,
               max(CAST(o_orderdate AS DATE)) AS last_date
        FROM orders GROUP BY o_custkey),
shown AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END,
                                         o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders WHERE o_orderstatus IN ('O', 'F')) WHERE rn = 1),
entity AS (
  SELECT c.c_custkey, c.c_name, c.c_mktsegment, COALESCE(s.o_orderkey, -1) AS shown_order,
         s.o_orderstatus AS shown_status, COALESCE(a.n_orders, 0) AS n_orders, COALESCE(a.n_open, 0) AS n_open,
         COALESCE(a.n_closed, 0) AS n_closed, COALESCE(a.n_pending, 0) AS n_pending,
         CAST(COALESCE(a.open_value, 0) AS DOUBLE) AS open_value,
         CAST(COALESCE(a.closed_value, 0) AS DOUBLE) AS closed_value,
         CASE WHEN a.n_open > 0 THEN 'OPEN' WHEN a.n_pending > 0 THEN 'PENDING'
              WHEN a.n_closed > 0 THEN 'CLOSED' ELSE 'NONE' END AS state,
         CAST(CASE WHEN s.o_orderstatus = 'O' THEN 1 ELSE 0 END AS BIGINT) AS has_open,
         strftime(a.last_date, '%Y-%m-%d') AS last_order_date,
         CAST(CASE WHEN date_trunc('month', a.last_date) = date_trunc('month', DATE '{AS_OF_ORDERS}') THEN 1 ELSE 0 END
              AS BIGINT) AS ordered_this_month
  FROM customer c LEFT JOIN agg a ON a.o_custkey = c.c_custkey LEFT JOIN shown s ON s.o_custkey = c.c_custkey)"""


@query("entity_360", sql=f"WITH {_ENTITY_SQL} SELECT * FROM entity")
def q_entity_360(spark, sf_dir):
    """One row per customer: open order shown, else the last closed one; counts, values, state, flags."""
    from ..operators.marts import entity_summary

    t = Tables(spark, sf_dir)
    return entity_summary(t.customer, t.orders, AS_OF_ORDERS).select(*_ENTITY_COLS)


_ENTITY_A_SQL = """
entity_a AS (
  SELECT e.c_custkey, e.c_name, e.c_mktsegment, COALESCE(p.pick.k, -1) AS shown_order, p.pick.s AS shown_status,
         e.n_orders, e.n_open, e.n_closed, e.n_pending, e.open_value, e.closed_value, e.state,
         CAST(CASE WHEN p.pick.s = 'O' THEN 1 ELSE 0 END AS BIGINT) AS has_open, e.last_order_date, e.ordered_this_month
  FROM entity e LEFT JOIN (
    SELECT o_custkey, max(CASE WHEN o_orderstatus IN ('O', 'F') THEN
             struct_pack(o := CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END, d := o_orderdate, k := o_orderkey,
                         s := o_orderstatus) END) AS pick
    FROM orders GROUP BY o_custkey) p ON p.o_custkey = e.c_custkey)"""


@query("mart_diff", sql=f"""
WITH {_ENTITY_SQL}, {_ENTITY_A_SQL}
SELECT count(a.c_custkey) AS rows_a, count(b.c_custkey) AS rows_b,
       CAST(count_if(a.c_custkey IS NULL OR b.c_custkey IS NULL
                     OR (a.c_name, a.c_mktsegment, a.shown_order, a.shown_status, a.n_orders, a.n_open, a.n_closed,
                         a.n_pending, a.open_value, a.closed_value, a.state, a.has_open, a.last_order_date,
                         a.ordered_this_month)
                        IS DISTINCT FROM
                        (b.c_name, b.c_mktsegment, b.shown_order, b.shown_status, b.n_orders, b.n_open, b.n_closed,
                         b.n_pending, b.open_value, b.closed_value, b.state, b.has_open, b.last_order_date,
                         b.ordered_this_month)) AS BIGINT) AS n_diff
FROM entity_a a FULL OUTER JOIN entity b ON a.c_custkey = b.c_custkey
""")
def q_mart_diff(spark, sf_dir):
    """The entity mart derived twice (aggregate picks vs numbered rows) and compared row by row."""
    from ..operators.marts import entity_summary, entity_summary_by_rows, mart_diff

    t = Tables(spark, sf_dir)
    a = entity_summary(t.customer, t.orders, AS_OF_ORDERS).select(*_ENTITY_COLS)
    b = entity_summary_by_rows(t.customer, t.orders, AS_OF_ORDERS).select(*_ENTITY_COLS)
    return mart_diff(a, b, ["c_custkey"])


PENALTY_RATE = "0.10"


@query("withdrawal_refund", sql=f"""
WITH collected AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS collected
                   FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey)
SELECT o.o_orderkey, o.o_custkey,
       CAST(COALESCE(c.collected, 0) AS DOUBLE) AS collected,
       CAST(ROUND(CAST(o.o_totalprice AS DECIMAL(18,2)) * {PENALTY_RATE}, 2) AS DOUBLE) AS penalty,
       CAST(greatest(COALESCE(c.collected, 0) - ROUND(CAST(o.o_totalprice AS DECIMAL(18,2)) * {PENALTY_RATE}, 2), 0)
            AS DOUBLE) AS refund
FROM orders o LEFT JOIN collected c ON c.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus = 'P'
""")
def q_withdrawal_refund(spark, sf_dir):
    """Withdrawn (status P) orders: amount collected, penalty, refund floored at 0 (NULL counts as 0);
    the collected amount is a pre-aggregated lookup joined once."""
    from decimal import Decimal

    from ..functions.money import refund
    from ..operators.lookup import scalar_lookup

    t = Tables(spark, sf_dir)
    withdrawn = t.orders.filter(F.col("o_orderstatus") == "P").select("o_orderkey", "o_custkey", "o_totalprice")
    closed = t.lineitem.filter(F.col("l_linestatus") == "F")
    j = scalar_lookup(withdrawn, closed, "o_orderkey", "l_orderkey",
                      [F.sum(money("l_extendedprice")).alias("collected")])
    penalty = F.round(money("o_totalprice") * F.lit(Decimal(PENALTY_RATE)), 2)
    return j.select("o_orderkey", "o_custkey",
                    F.coalesce("collected", F.lit(0)).cast("double").alias("collected"),
                    penalty.cast("double").alias("penalty"),
                    refund(F.col("collected"), penalty).cast("double").alias("refund"))


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]


def _invoice_lines_sql() -> str:
    return f"""
numbered AS (
  SELECT l_orderkey AS invoice, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(_LINE_ORDER)}) AS no,
         l_suppkey, {NET_SQL} AS net, ROUND({NET_SQL} * CAST(l_tax AS DECIMAL(7,4)), 2) AS tax,
         max(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY l_orderkey) AS by_dist,
         CASE l_linestatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'N' END AS posted
  FROM lineitem),
lines AS (
  SELECT invoice, no AS dist, l_suppkey * 1000 + no AS receipt, CAST(NULL AS BIGINT) AS applies_to, 'ITEM' AS type,
         net AS amount, posted FROM numbered
  UNION ALL
  SELECT invoice, CAST(NULL AS BIGINT), l_suppkey * 1000 + no, CASE WHEN by_dist = 1 THEN no END, 'TAX', tax, posted
  FROM numbered)"""


@query("invoice_tax_match", sql=f"""
WITH {_invoice_lines_sql()},
items AS (SELECT * FROM lines WHERE type <> 'TAX'),
by_dist AS (SELECT invoice, applies_to, SUM(amount) AS t FROM lines WHERE type = 'TAX' GROUP BY 1, 2),
by_rcpt AS (SELECT invoice, receipt, SUM(amount) AS t FROM lines WHERE type = 'TAX' GROUP BY 1, 2),
j AS (SELECT i.invoice, i.amount, i.posted, d.t AS tax_d, r.t AS tax_r FROM items i
      LEFT JOIN by_dist d ON d.invoice = i.invoice AND d.applies_to = i.dist
      LEFT JOIN by_rcpt r ON r.invoice = i.invoice AND r.receipt = i.receipt),
agg AS (SELECT invoice, SUM(amount) AS net, SUM(tax_d) AS tax_d, SUM(tax_r) AS tax_r,
               CASE WHEN count_if(posted = 'Y') = count(*) THEN 'Contabilizado'
                    WHEN count_if(posted = 'N') = count(*) THEN 'No Contabilizado'
                    ELSE 'Contabilizado Parcialmente' END AS posting_status
        FROM j GROUP BY invoice)
SELECT invoice, CAST(net AS DOUBLE) AS net, CAST(COALESCE(tax_d, tax_r, 0) AS DOUBLE) AS tax,
       CAST(net + COALESCE(tax_d, tax_r, 0) AS DOUBLE) AS total, posting_status
FROM agg
""")
def q_invoice_tax_match(spark, sf_dir):
    """Order lines as invoice lines (one item row and one tax row per line): tax matched to items by
    distribution, on invoices of returned lines only by receipt, with the invoice's posting status.
    A line's place in its order is its distribution, as (order, line number) repeats."""
    from ..operators.marts import invoice_tax

    t = Tables(spark, sf_dir)
    numbered = sequence_in_parent(t.lineitem.drop("l_comment"), ["l_orderkey"], _LINE_ORDER, out="no")
    flags = t.lineitem.groupBy("l_orderkey").agg(F.max(F.col("l_returnflag") != "R").alias("by_dist"))
    numbered = numbered.join(flags, "l_orderkey")
    net = net_amount()
    receipt = F.col("l_suppkey") * 1000 + F.col("no")
    none = F.lit(None).cast("long")
    rows = F.explode(F.array(
        F.struct(F.col("no").alias("dist"), none.alias("applies_to"), F.lit("ITEM").alias("type"),
                 net.cast("decimal(38,2)").alias("amount")),
        F.struct(none.alias("dist"), F.when(F.col("by_dist"), F.col("no")).alias("applies_to"), F.lit("TAX").alias("type"),
                 F.round(net * rate("l_tax"), 2).cast("decimal(38,2)").alias("amount"))))
    posted = F.when(F.col("l_linestatus") == "F", "Y").when(F.col("l_linestatus") == "O", "N")
    lines = numbered.select(F.col("l_orderkey").alias("invoice"), receipt.alias("receipt"), posted.alias("posted"),
                            rows.alias("r")).select("invoice", "receipt", "posted", "r.*")
    out = invoice_tax(lines)
    return out.select("invoice", cents("net").alias("net"), cents("tax").alias("tax"), cents("total").alias("total"),
                      "posting_status")


@query("order_obt", sql=f"""
WITH newest AS (
  SELECT l_orderkey, l_partkey AS newest_partkey, CAST(l_extendedprice AS DOUBLE) AS newest_price,
         strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS newest_ship_date
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                     ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC,
                                              l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
                                              l_returnflag DESC, l_linestatus DESC) AS rn
        FROM lineitem) WHERE rn = 1)
SELECT o.o_orderkey, CAST(strftime(o.o_orderdate, '%Y%m%d') AS BIGINT) AS date_key,
       'T' || quarter(o.o_orderdate) || '/' || right(CAST(year(o.o_orderdate) AS VARCHAR), 2) AS quarter_name,
       'FY' || right(CAST(year(o.o_orderdate) AS VARCHAR), 2) AS fiscal_year,
       c.c_name AS buyer, n.n_name AS buyer_nation, r.r_name AS buyer_region,
       COALESCE(nw.newest_partkey, -1) AS newest_partkey, nw.newest_price, nw.newest_ship_date,
       CAST(CASE WHEN nw.l_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS has_lines
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN newest nw ON nw.l_orderkey = o.o_orderkey
""")
def q_order_obt(spark, sf_dir):
    """One big table per order: calendar attributes by date key, buyer with nation and region,
    and the newest line (latest ship date, full tie-break) of the order."""
    from ..functions.keys import date_key
    from ..operators.calendar import calendar_attributes
    from ..operators.dedup import latest_per_key
    from ..sources.tables import calendar_between

    t = Tables(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    newest = latest_per_key(li, ["l_orderkey"], ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                                 "l_returnflag", "l_linestatus"])
    # calendar over the order-date range, one row per day: its length is the data's, so no hint
    bounds = o.agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    cal = calendar_attributes(calendar_between(bounds, "lo", "hi")).select("date_key", "quarter_name", "fiscal_year")
    geo = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t.customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("buyer"), F.col("n_name").alias("buyer_nation"),
        F.col("r_name").alias("buyer_region"))
    obt = (o.withColumn("date_key", date_key("o_orderdate").cast("long"))
           .join(buyers, "o_custkey")
           .join(cal, "date_key", "left")
           .join(newest.withColumnRenamed("l_orderkey", "o_orderkey").withColumn("_has", F.lit(1)),
                 "o_orderkey", "left"))
    return obt.select(
        "o_orderkey", "date_key", "quarter_name", "fiscal_year", "buyer", "buyer_nation", "buyer_region",
        F.coalesce("l_partkey", F.lit(-1)).alias("newest_partkey"), F.col("l_extendedprice").alias("newest_price"),
        F.date_format(F.to_date("l_shipdate"), "yyyy-MM-dd").alias("newest_ship_date"),
        F.col("_has").isNotNull().cast("long").alias("has_lines"))
