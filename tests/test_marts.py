import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.functions.money import net_amount, rate
from tallyloom.operators.marts import entity_summary, entity_summary_by_rows, invoice_tax, mart_diff

from conftest import rows

T = dt.datetime


def _frames(spark):
    customers = spark.createDataFrame([(1, "a", "S1"), (2, "b", "S1"), (3, "c", "S2"), (4, "d", "S2")],
                                      "c_custkey long, c_name string, c_mktsegment string")
    orders = spark.createDataFrame([
        (10, 1, "F", 100.0, T(2001, 8, 20)),   # newer, but closed
        (11, 1, "O", 50.0, T(2001, 1, 5)),     # open: shown
        (20, 2, "F", 10.0, T(2000, 3, 1)),
        (21, 2, "F", 20.0, T(2000, 3, 1)),     # same date: larger key wins
        (22, 2, "P", 30.0, T(2001, 8, 2)),     # pending orders are never shown
        (30, 3, "P", 5.0, T(1999, 1, 1)),      # only pending: nothing shown
    ], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp")
    return customers, orders


def test_entity_summary_shown_order_and_state(spark):
    customers, orders = _frames(spark)
    got = {r.c_custkey: (r.shown_order, r.shown_status, r.state, r.n_orders, r.has_open, r.ordered_this_month)
           for r in entity_summary(customers, orders, "2001-08-31").collect()}
    assert got[1] == (11, "O", "OPEN", 2, 1, 1)
    assert got[2] == (21, "F", "PENDING", 3, 0, 1)
    assert got[3] == (-1, None, "PENDING", 1, 0, 0)
    assert got[4] == (-1, None, "NONE", 0, 0, 0)   # customer without orders keeps its row


def test_two_derivations_agree(spark):
    customers, orders = _frames(spark)
    cols = ["c_custkey", "shown_order", "shown_status", "n_orders", "state", "has_open", "open_value"]
    a = entity_summary(customers, orders, "2001-08-31").select(*cols)
    b = entity_summary_by_rows(customers, orders, "2001-08-31").select(*cols)
    assert rows(mart_diff(a, b, ["c_custkey"]), "rows_a", "rows_b", "n_diff") == [(4, 4, 0)]
    changed = b.withColumn("state", F.when(F.col("c_custkey") == 1, "X").otherwise(F.col("state")))
    assert rows(mart_diff(a, changed, ["c_custkey"]), "n_diff") == [(1,)]


_INVOICE = "invoice long, dist long, receipt long, applies_to long, type string, amount decimal(18,2), posted string"


def test_tax_allotted_equals_tax_booked(spark):
    lines = spark.createDataFrame([
        (1, 1, 10, None, "ITEM", Decimal(100), "Y"), (1, 2, 11, None, "ITEM", Decimal(50), "N"),
        (1, None, 10, 1, "TAX", Decimal(19), "Y"), (1, None, 11, 2, "TAX", Decimal(9), "Y"),
        (2, 1, 20, None, "ITEM", Decimal(10), "Y"), (2, None, 20, None, "TAX", Decimal(2), "Y"),
        (3, 1, 30, None, "ITEM", Decimal(7), "N"), (4, None, 40, 1, "TAX", Decimal(5), "Y")], _INVOICE)
    got = invoice_tax(lines)
    assert rows(got, "invoice", "net", "tax", "posting_status") == [
        (1, Decimal(150), Decimal(28), "Contabilizado Parcialmente"), (2, Decimal(10), Decimal(2), "Contabilizado"),
        (3, Decimal(7), Decimal(0), "No Contabilizado")]


def test_shared_distribution_is_refused(spark):
    lines = spark.createDataFrame([
        (1, 1, 10, None, "ITEM", Decimal(100), "Y"), (1, 1, 11, None, "ITEM", Decimal(50), "Y"),
        (1, None, 10, 1, "TAX", Decimal(19), "Y")], _INVOICE)
    with pytest.raises(Exception, match="distribution"):
        invoice_tax(lines).collect()


def test_registered_invoices_allot_all_tax(spark):
    from tallyloom import plans

    plans.load_all()
    base = "/root/testdata/sf0.001"
    allotted = plans.QUERIES["invoice_tax_match"](spark, base).agg(F.sum("tax")).first()[0]
    booked = spark.read.parquet(f"{base}/lineitem.parquet").agg(
        F.sum(F.round(net_amount() * rate("l_tax"), 2))).first()[0]
    assert round(allotted, 2) == float(booked)




def test_shown_sale(spark):
    from tallyloom.operators.property import shown_sale

    D = dt.date
    sales = [("a", 1, D(2024, 1, 1), "2", "N"), ("a", 2, D(2024, 3, 1), "3", "Y"), ("a", 3, D(2024, 2, 1), "5", "N"),
             ("b", 4, D(2024, 1, 1), "4", "Y"), ("b", 5, D(2024, 1, 1), "4", "Y"), ("b", 6, D(2024, 9, 1), "1", "N"),
             ("c", 7, D(2024, 1, 1), "1", "N"), ("d", 8, D(2024, 1, 1), None, "N"), ("e", 9, None, "2", "N"), ("e", 10, D(2023, 1, 1), "2", "N")]
    got = shown_sale(spark.createDataFrame(sales, "item string, sale int, sale_date date, stage string, withdrawn string"))
    assert rows(got, "item", "live_sale", "withdrawn_sale", "shown_sale", "n_withdrawn", "last_withdrawn", "n_optioned") == [
        ("a", 3, 2, 3, 1, D(2024, 3, 1), 3),
        ("b", None, 5, 5, 2, D(2024, 1, 1), 3),  # the visit does not count as sold; a tie goes to the greater key
        ("e", 10, None, 10, 0, None, None)]


def test_purchase_fact_keeps_headers_without_lines(spark):
    from tallyloom.operators.property import purchase_fact

    df = spark.createDataFrame
    fact = purchase_fact(
        df([(1, "v", "30"), (2, "w", None)], "header int, vendor string, terms string"),
        df([(1, 10, 5.0), (1, 11, 6.0)], "header int, line int, amount double"),
        df([(1, 10, "d1"), (1, 10, "d2")], "header int, line int, distribution string"),
        df([("d1", "r1"), ("d1", "r2")], "distribution string, receipt string"),
        df([(1, 11, "q")], "header int, line int, request string"), df([("30", 30)], "terms string, due int"))
    assert rows(fact, "header", "line", "distribution", "receipt", "request", "due") == sorted([
        (1, 10, "d1", "r1", None, 30), (1, 10, "d1", "r2", None, 30), (1, 10, "d2", None, None, 30),
        (1, 11, None, None, "q", 30), (2, None, None, None, None, None)], key=repr)
