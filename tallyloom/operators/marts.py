"""One-row-per-entity summaries, and the comparison of two derivations of a mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import same_month
from ..functions.money import money
from .aggregates import count_when, sum_if
from .numbering import sequence_in_parent

# Entity states, decided in this order.
STATES = [("n_open", "OPEN"), ("n_pending", "PENDING"), ("n_closed", "CLOSED")]
NO_STATE = "NONE"


def _status_aggs():
    st = F.col("o_orderstatus")
    price = money("o_totalprice")
    return [
        F.count(F.lit(1)).alias("n_orders"),
        count_when(st == "O").alias("n_open"),
        count_when(st == "F").alias("n_closed"),
        count_when(st == "P").alias("n_pending"),
        sum_if(st == "O", price).alias("open_value"),
        sum_if(st == "F", price).alias("closed_value"),
        F.max(F.to_date("o_orderdate")).alias("last_date"),
    ]


def _finish(customers: DataFrame, agg: DataFrame, as_of) -> DataFrame:
    """``agg``: one row per customer with the status measures and the shown order."""
    state = None
    for col, label in STATES:
        cond = F.col(col) > 0
        state = F.when(cond, F.lit(label)) if state is None else state.when(cond, F.lit(label))
    j = customers.select("c_custkey", "c_name", "c_mktsegment").join(agg, "c_custkey", "left")
    return j.select(
        "c_custkey", "c_name", "c_mktsegment",
        F.coalesce("shown_order", F.lit(-1)).alias("shown_order"), "shown_status",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_orders", "n_open", "n_closed", "n_pending")],
        *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("open_value", "closed_value")],
        state.otherwise(F.lit(NO_STATE)).alias("state"),
        (F.col("shown_status") == "O").cast("long").alias("_has_open"),
        F.date_format("last_date", "yyyy-MM-dd").alias("last_order_date"),
        F.when(F.col("last_date").isNull(), F.lit(0)).otherwise(same_month("last_date", as_of))
        .cast("long").alias("ordered_this_month"),
    ).withColumn("has_open", F.coalesce("_has_open", F.lit(0))).drop("_has_open")


def entity_summary(customers: DataFrame, orders: DataFrame, as_of) -> DataFrame:
    """Per customer in one aggregation: counts and values by status, plus the shown order
    (newest open, else newest closed) picked as the max of a struct -- combined map-side,
    so a customer holding a third of all orders never lands whole in one task."""
    st = F.col("o_orderstatus")
    pick = F.max(F.when(st.isin("O", "F"), F.struct(
        (st == "O").alias("is_open"), F.col("o_orderdate").alias("d"), F.col("o_orderkey").alias("k"),
        st.alias("s")))).alias("_pick")
    agg = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*_status_aggs(), pick)
    # one frame, one join: splitting the aggregate into two branches would let the
    # optimizer prune them differently and aggregate the orders twice
    agg = agg.withColumn("shown_order", F.col("_pick.k")).withColumn("shown_status", F.col("_pick.s")).drop("_pick")
    return _finish(customers, agg, as_of)


def entity_summary_by_rows(customers: DataFrame, orders: DataFrame, as_of) -> DataFrame:
    """Second derivation: number each customer's candidate orders and keep slot 1."""
    agg = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*_status_aggs())
    cand = orders.filter(F.col("o_orderstatus").isin("O", "F")).withColumn(
        "_prio", F.when(F.col("o_orderstatus") == "O", 0).otherwise(1))
    first = sequence_in_parent(cand, ["o_custkey"], ["_prio", F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
                               out="_slot", hot_keys_from=orders.select("o_custkey")).filter(F.col("_slot") == 1)
    shown = first.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("shown_order"),
                         F.col("o_orderstatus").alias("shown_status"))
    return _finish(customers, agg.join(shown, "c_custkey", "full_outer"), as_of)


def mart_diff(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of two derivations and the number of keys whose rows differ (null-safe)."""
    keys = list(keys)
    cols = [c for c in a.columns if c not in keys]
    ta = a.select(*keys, F.struct(*cols).alias("_a"), F.lit(1).alias("_in_a"))
    tb = b.select(*keys, F.struct(*cols).alias("_b"), F.lit(1).alias("_in_b"))
    j = ta.join(tb, keys, "full_outer")
    differs = ~F.col("_a").eqNullSafe(F.col("_b"))
    return j.agg(F.count("_in_a").alias("rows_a"), F.count("_in_b").alias("rows_b"),
                 F.count_if(differs).cast("long").alias("n_diff"))


# Accounting status of an invoice from its lines' posted flags.
POSTED_ALL, POSTED_NONE, POSTED_SOME = "Contabilizado", "No Contabilizado", "Contabilizado Parcialmente"


def invoice_tax(lines: DataFrame, invoice: str = "invoice", dist: str = "dist", receipt: str = "receipt",
                applies_to: str = "applies_to", kind: str = "type", amount: str = "amount",
                posted: str = "posted", tax_kind: str = "TAX") -> DataFrame:
    """Per invoice: amount without tax, tax, total and posting status.

    Tax lines are matched to item lines by distribution; only when no item of
    the invoice matches that way are they matched by receipt.  A distribution
    (or, where taxes go by receipt, a receipt) that several items of an invoice
    share would take the same tax more than once, so it fails the query.  Items
    and taxes meet in one aggregate per (invoice, key); nothing is joined per line.
    """
    is_tax = F.col(kind) == tax_kind
    # every line under both of its keys: one aggregate by (invoice, way, key) and one by invoice serve both ways
    ways = F.explode(F.array(
        F.struct(F.lit("d").alias("way"), F.when(is_tax, F.col(applies_to)).otherwise(F.col(dist)).alias("key")),
        F.struct(F.lit("r").alias("way"), F.col(receipt).alias("key"))))
    per_key = lines.select(invoice, kind, amount, posted, ways.alias("_w")).groupBy(
        invoice, F.col("_w.way").alias("_way"), F.col("_w.key").alias("_key")).agg(
        F.count(F.when(~is_tax, 1)).alias("_items"), F.sum(F.when(is_tax, F.col(amount))).alias("_tax"),
        F.sum(F.when(~is_tax, F.col(amount))).alias("_net"),
        F.count(F.when(~is_tax & (F.col(posted) == "Y"), 1)).alias("_y"),
        F.count(F.when(~is_tax & (F.col(posted) == "N"), 1)).alias("_n"))
    hit = F.col("_key").isNotNull() & (F.col("_items") > 0) & F.col("_tax").isNotNull()
    by_dist = F.col("_way") == "d"
    # per invoice: the tax that found an item, and whether some of it found more than one
    found = lambda x: [F.sum(F.when(hit & (F.col("_way") == x), F.col("_tax"))).alias(f"_tax_{x}"),
                       F.max(hit & (F.col("_way") == x) & (F.col("_items") > 1)).alias(f"_shared_{x}")]
    j = per_key.groupBy(invoice).agg(
        *[F.sum(F.when(by_dist, F.col(c))).alias(o) for c, o in (("_net", "net"), ("_items", "_items"), ("_y", "_y"), ("_n", "_n"))],
        *found("d"), *found("r")).filter(F.col("_items") > 0)
    shared = F.when(F.col("_tax_d").isNotNull(), F.col("_shared_d")).otherwise(F.col("_shared_r"))
    by = F.when(F.col("_tax_d").isNotNull(), F.lit("distribution")).otherwise(F.lit("receipt"))
    text = F.concat(F.lit("items share a "), by, F.lit(" that tax applies to, invoice "), F.col(invoice).cast("string"))
    kind_of_sum = j.schema["net"].dataType
    zero = F.lit(0).cast(lines.schema[amount].dataType)
    tax = F.when(shared, F.raise_error(text).cast(kind_of_sum)).otherwise(F.coalesce("_tax_d", "_tax_r", zero))
    status = F.when(F.col("_y") == F.col("_items"), POSTED_ALL).when(F.col("_n") == F.col("_items"), POSTED_NONE) \
        .otherwise(POSTED_SOME)
    return j.withColumn("tax", tax).select(invoice, "net", "tax", (F.col("net") + F.col("tax")).alias("total"),
                                           status.alias("posting_status"))
