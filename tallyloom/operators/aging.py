"""Receivable and invoice aging (days late, labelled ranges, month differences)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.buckets import aging_label, overdue_range
from ..functions.dates import lit_date, month_diff, same_month


def receivable_aging(instalments: DataFrame, as_of, due_col: str = "due_date", status_col: str = "status",
                     closed_value: str = "CL", paid_col: str = "paid", number_col: str | None = None,
                     concept_col: str | None = None, excluded_prefix: str = "NC") -> DataFrame:
    """Days late and aging label per instalment, with the statement's exclusion rules.

    * days late = 0 when the instalment is closed or not yet due, else days since due;
    * label: closed -> up to date; 1 day late -> up to date; then (1,30], (30,90],
      (90,180], >180;
    * dropped: closed with NULL or zero payment, numbers starting with
      ``excluded_prefix``, NULL concept.
    """
    today = lit_date(as_of)
    closed = F.col(status_col) == F.lit(closed_value)
    diff = F.datediff(today, F.col(due_col))
    days_late = F.when(closed, 0).when(diff < 0, 0).otherwise(diff).cast("long")
    out = instalments.withColumn("days_late", days_late).withColumn(
        "aging_bucket", aging_label(diff, closed)
    ).withColumn("overdue_flag", (F.col("days_late") > 0).cast("long"))
    keep = ~(closed & (F.col(paid_col).isNull() | (F.col(paid_col) == 0)))
    if number_col:
        keep = keep & ~F.col(number_col).startswith(excluded_prefix)
    if concept_col:
        keep = keep & F.col(concept_col).isNotNull()
    return out.filter(keep)


def invoice_aging(lines: DataFrame, as_of, date_col: str, term_days: int) -> DataFrame:
    """Due date = date + term, days overdue, overdue range, months since due, same-month flag."""
    today = lit_date(as_of)
    due = F.date_add(F.to_date(F.col(date_col)), term_days)
    return (
        lines.withColumn("due_date", due)
        .withColumn("days_overdue", F.datediff(today, F.col("due_date")).cast("long"))
        .withColumn("overdue_range", overdue_range(F.col("days_overdue")))
        .withColumn("months_since_due", month_diff(today, F.col("due_date")).cast("long"))
        .withColumn("due_this_month", same_month(F.col("due_date"), as_of).cast("long"))
    )
