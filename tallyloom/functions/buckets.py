"""Ordered bucket labels built from a list of bounds (aging, overdue ranges, states)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def bucket(col, bounds: Sequence, labels: Sequence[str], lower_open: bool = True,
           default: str | None = None) -> Column:
    """Label ``col`` by consecutive ranges.

    ``bounds=[b0, b1, ..., bn]`` and ``labels=[l1, ..., ln, l_over]``: label ``li``
    when ``b(i-1) < x <= bi`` (``lower_open``), ``l_over`` when ``x > bn``;
    values ``<= b0`` or NULL take ``default``.
    """
    if len(labels) != len(bounds):
        raise ValueError("need one label per bound (the last one is open-ended)")
    x = _c(col)
    expr = None
    for i in range(1, len(bounds)):
        lo, hi = bounds[i - 1], bounds[i]
        cond = ((x > lo) if lower_open else (x >= lo)) & (x <= hi)
        expr = F.when(cond, F.lit(labels[i - 1])) if expr is None else expr.when(cond, F.lit(labels[i - 1]))
    over = (x > bounds[-1]) if lower_open else (x >= bounds[-1])
    expr = F.when(over, F.lit(labels[-1])) if expr is None else expr.when(over, F.lit(labels[-1]))
    return expr.otherwise(F.lit(default))


# Receivable aging labels and day bounds (1, 30, 90, 180 days late).
AGING_UP_TO_DATE = "AL DÍA"
AGING_BOUNDS = [1, 30, 90, 180]
AGING_LABELS = [
    "MENOS DE 30 DÍAS EN MORA",
    "MÁS DE 30 DÍAS DE MORA",
    "MÁS DE 90 DÍAS DE MORA",
    "MÁS DE 180 DÍAS DE MORA",
]

# Invoice overdue ranges (days past due, bounds 30 and 60).
OVERDUE_LABELS = ["Menor o igual a 30 Días", "Entre 30 y 60 Días", "Mayor o igual a 60 Días"]
OVERDUE_OTHER = "Otro"


def aging_label(days_late, closed) -> Column:
    """Receivable aging: closed -> up to date; exactly one day late is still up to date."""
    return F.when(_c(closed), F.lit(AGING_UP_TO_DATE)).otherwise(
        bucket(days_late, AGING_BOUNDS, AGING_LABELS, default=AGING_UP_TO_DATE)
    )


def overdue_range(days) -> Column:
    """Invoice overdue range: up to 30 days, 30 to 60, over 60; NULL days -> other."""
    x = _c(days)
    return (
        F.when(x <= 30, F.lit(OVERDUE_LABELS[0]))
        .when((x > 30) & (x <= 60), F.lit(OVERDUE_LABELS[1]))
        .when(x > 60, F.lit(OVERDUE_LABELS[2]))
        .otherwise(F.lit(OVERDUE_OTHER))
    )
