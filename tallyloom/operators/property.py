"""The widest marts: one row per property with its shown sale, and one row per purchase distribution and receipt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lit_date, month_diff, same_month
from ..functions.keys import hash_key
from ..functions.text import regex_or_null, split_nth
from .aggregates import count_when, sum_if
from .dedup import latest_per_key

# Stages of a sale that count as sold, and with the first one as optioned.
SOLD_STAGES = ("2", "3", "4", "5")
OPTIONED_STAGES = ("1", *SOLD_STAGES)
# Milestone codes of a sale in the mart.
MILESTONES = ("rvdf", "bstr", "llpt", "epp5", "vcav", "fesc")
# Marks of concepts and financing parties in an account statement, and its state without arrears.
INSTALMENT, LAST_INSTALMENT, DEPOSIT, CONFIRMATION = "CUOTA ", "ULTIMA CUOTA", "SEPARACION", "CONFIRMACION"
SUBSIDY, SEVERANCE, LOAN = "SUBSIDIO ", "CESANTIAS ", "CREDITO"
FUND, HOUSING = "CAJA DE COMPENSACION FAMILIAR", "VIVIENDA FONVIVIENDA"
UP_TO_DATE = "AL DÍA"
# Sale classes, later steps first.
DEEDED, PROMISED, SOLD, UNSOLD = "D. ESCRITURADO", "C. VENDIDO PROMETIDO", "B. VENDIDO NO PROMETIDO", "A. NO VENDIDO"


def shown_sale(sales: DataFrame, item: str = "item", sale: str = "sale", date: str = "sale_date", stage: str = "stage",
               withdrawn: Column | None = None) -> DataFrame:
    """Per item: the newest live sale, else the newest withdrawn one, with counts of both kinds.

    One aggregate over the sales (maximum of a struct, combined map-side), so an
    item with very many sales is reduced before the shuffle.  Ties of the date go
    to the greatest sale key.  ``n_optioned`` is known for items withdrawn once.
    """
    gone = withdrawn if withdrawn is not None else F.col("withdrawn") == "Y"
    sold = F.col(stage).isin(*SOLD_STAGES)
    newest = lambda cond: F.max(F.when(cond, F.struct(F.col(date).alias("d"), F.col(sale).alias("k"))))
    picked = sales.groupBy(item).agg(
        newest(sold & ~gone).alias("_live"), newest(sold & gone).alias("_gone"), count_when(sold & gone).alias("n_withdrawn"),
        count_when(F.col(stage).isin(*OPTIONED_STAGES)).alias("_optioned"))
    return picked.select(
        item, F.col("_live.k").alias("live_sale"), F.col("_gone.k").alias("withdrawn_sale"),
        F.coalesce("_live.k", "_gone.k").alias("shown_sale"), "n_withdrawn", F.col("_gone.d").alias("last_withdrawn"),
        F.when(F.col("_gone").isNotNull(), F.col("_optioned")).alias("n_optioned")).filter("shown_sale is not null")


def statement_summary(lines: DataFrame, sale: str = "sale") -> DataFrame:
    """An account statement as one row per sale: (sale, concept, agreed, paid, overdue, days_late, state, party) lines."""
    c, agreed = F.col("concept"), F.col("agreed")
    late = F.col("state") != UP_TO_DATE
    instalment = c.startswith(INSTALMENT) | (c == LAST_INSTALMENT)
    initial = instalment | c.isin(DEPOSIT, CONFIRMATION) | c.startswith(SEVERANCE) | c.startswith(SUBSIDY)
    only = lambda cond, x: F.max(F.when(cond, F.col(x)))
    return lines.groupBy(sale).agg(
        sum_if(initial, agreed).alias("initial_total"), F.sum("paid").alias("paid_total"), sum_if(late, F.col("overdue")).alias("overdue"),
        only(late, "days_late").alias("days_late"), only(late, "state").alias("late_state"),
        count_when(instalment).alias("n_instalments"), sum_if(instalment, agreed, None).alias("instalments"),
        only(c == DEPOSIT, "paid").alias("deposit"), only(c == CONFIRMATION, "paid").alias("confirmation"),
        sum_if(c.startswith(SEVERANCE), agreed, None).alias("severance"), sum_if(c.startswith(SUBSIDY), agreed, None).alias("subsidy"),
        only(c == SUBSIDY + "1", "party").alias("subsidy_party1"), only(c == SUBSIDY + "2", "party").alias("subsidy_party2"),
        sum_if(c.startswith(LOAN), agreed, None).alias("loans"), sum_if(c == LOAN, agreed, None).alias("loan"),
        only(c == LOAN, "party").alias("loan_party"))


def property_mart(items: DataFrame, sales: DataFrame, people: DataFrame, projects: DataFrame, statement: DataFrame,
                  milestones: DataFrame, as_of) -> DataFrame:
    """One row per property: its project, shown sale, buyers, statement, milestones and flags.

    * ``items``: (item, name, reference, price_key, price, project); of equal names
      the one with the highest price key counts.
    * ``sales``: (item, sale, sale_date, stage, withdrawn, amount, buyer, seller),
      one row per item and sale.
    * ``people``: (person, full_name, partner); the second buyer is found through the first.
    * ``projects``: (project, project_name, kind, n_homes, first_payment_end).
    * ``statement``: lines for ``statement_summary``; ``milestones``: (sale, ``MILESTONES``...).
    Every join but the first two is on a key that is unique on its right side.
    """
    today = lit_date(as_of)
    items = latest_per_key(items, ["name"], ["price_key"])
    shown = shown_sale(sales)
    facts = sales.select("item", F.col("sale").alias("shown_sale"), "sale_date", "stage", "withdrawn", "amount", "buyer", "seller")
    person = lambda key, name, *more: people.select(F.col("person").alias(key), F.upper("full_name").alias(name), *more)
    j = (items.join(projects, "project", "left").join(shown, "item", "left").join(facts, ["item", "shown_sale"], "left")
         .join(person("buyer", "buyer1", F.col("partner").alias("_partner")), "buyer", "left")
         .join(person("_partner", "buyer2"), "_partner", "left").join(person("seller", "seller_name"), "seller", "left")
         .join(statement_summary(statement).withColumnRenamed("sale", "shown_sale"), "shown_sale", "left")
         .join(milestones.withColumnRenamed("sale", "shown_sale"), "shown_sale", "left"))
    sold = F.col("live_sale").isNotNull()
    there = lambda c: F.col(c).isNotNull().cast("long")
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("long")
    p1, p2 = F.col("subsidy_party1"), F.col("subsidy_party2")
    other = lambda p: ~p.startswith(FUND) & ~p.contains(HOUSING)
    month = lambda c: F.upper(F.date_format(c, "MMMM"))
    gone = F.col("withdrawn") == "Y"
    return j.select(
        "item", "name", regex_or_null("reference", r"^([^\\-]+)").alias("tower"), split_nth("reference", "-", 1).alias("unit"), "price",
        F.when(sold & F.col("fesc").isNotNull(), DEEDED).when(sold & F.col("llpt").isNotNull(), PROMISED).when(sold, SOLD)
        .otherwise(UNSOLD).alias("sale_class"), sold.cast("long").alias("sold"),
        "project_name", "kind", (F.coalesce("n_homes", F.lit(0)) * F.lit(0.6).cast("decimal(2,1)")).cast("double").alias("break_even"),
        "shown_sale", "sale_date", "stage", "withdrawn", "amount",
        F.when(gone, F.col("amount")).otherwise(0).alias("withdrawn_amount"),
        F.coalesce("n_withdrawn", F.lit(0)).cast("long").alias("n_withdrawn"), "last_withdrawn",
        F.col("n_optioned").cast("long").alias("n_optioned"), flag(same_month("last_withdrawn", as_of) == 1).alias("withdrawn_this_month"),
        flag(same_month("sale_date", as_of) == 1).alias("sold_this_month"),
        "seller_name", "buyer1", "buyer2", "initial_total", "paid_total", "overdue", "days_late", "late_state",
        F.col("n_instalments").cast("long").alias("n_instalments"), "instalments", "deposit", "confirmation", "severance", "subsidy",
        "loans", "loan", "loan_party",
        F.when(F.col("subsidy").isNull(), 0).otherwise(flag(other(p1)).bitwiseOR(flag(other(p2)))).cast("long").alias("other_subsidy"),
        flag(p1.contains(FUND)).bitwiseOR(flag(p2.contains(FUND))).alias("fund_subsidy"),
        flag(p1.contains(HOUSING)).bitwiseOR(flag(p2.contains(HOUSING))).alias("housing_subsidy"),
        month_diff(F.col("first_payment_end"), today).cast("long").alias("months_to_pay"),
        F.datediff("first_payment_end", today).cast("long").alias("days_to_pay"),
        *MILESTONES, there("rvdf").alias("linked"), there("bstr").alias("blocked"), there("llpt").alias("promised"),
        month("llpt").alias("promise_month"), there("epp5").alias("deed_agreed"), month("epp5").alias("deed_month"),
        flag(F.col("vcav") >= today).alias("approval_valid"), there("vcav").alias("approval_known"), there("fesc").alias("deeded"))


def purchase_fact(headers: DataFrame, lines: DataFrame, distributions: DataFrame, receipts: DataFrame, requests: DataFrame,
                  terms: DataFrame, header: str = "header", line: str = "line", distribution: str = "distribution",
                  hashed: Sequence[str] = ("header", "line", "distribution", "receipt", "vendor")) -> DataFrame:
    """Purchase orders by line, distribution and receipt, with the payment terms and the request they came from.

    A header without lines, a line without distributions and a distribution without
    receipts keep one row.  Lines, distributions and requests meet first, on
    (header, line); terms and requests must be unique on their keys.
    """
    below = distributions.join(receipts, distribution, "left")
    full = lines.join(requests, [header, line], "left").join(below, [header, line], "left")
    j = headers.join(terms, "terms", "left").join(full, header, "left")
    return j.select(*[hash_key(c).alias(f"sk_{c}") for c in hashed], "*")
