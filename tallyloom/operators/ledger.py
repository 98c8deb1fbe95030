"""Ledger balances per period: opening / debit / credit / movement / closing.

The rule (a range join) says: for a group and a period, opening is the sum of
movements before the period, closing the sum up to its end, starting at the
beginning of time -- or at 1 January for groups that restart each year -- and
a row exists once the group has a movement in that span.

Joining every movement to every later period costs rows x periods.  Here the
movements are summed per (group, month) first (map-side combined), a grid of
months is generated per group with ``sequence`` (no join), and the balances
are running sums over a window whose partitions hold one row per month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date

MEASURES = ("opening", "debit", "credit", "movement", "closing")


def _month(d: dt.date) -> dt.date:
    return dt.date(d.year, d.month, 1)


def monthly_movements(lines: DataFrame, group: Sequence[str], date_col: str, debit_col: str, credit_col: str,
                      as_of, period_col: str = "period") -> DataFrame:
    """Debit and credit summed per (group, month) up to ``as_of`` -- the only pass over raw lines."""
    end = as_date(as_of)
    return (
        lines.filter(F.col(date_col) <= F.lit(end))
        .groupBy(*group, F.trunc(F.col(date_col), "MM").alias(period_col))
        .agg(F.sum(debit_col).alias("debit"), F.sum(credit_col).alias("credit"))
    )


def balances_from_monthly(monthly: DataFrame, group: Sequence[str], as_of, restart: Column | None = None,
                          period_col: str = "period") -> DataFrame:
    """Opening/debit/credit/movement/closing per (group, month) from monthly sums."""
    group = list(group)
    end_month = _month(as_date(as_of))
    restarting = restart if restart is not None else F.lit(False)
    monthly = monthly.withColumn("_tl_reset", F.when(restarting, F.year(period_col)).otherwise(F.lit(0)))
    starts = monthly.groupBy(*group, "_tl_reset").agg(F.min(period_col).alias("_tl_first"))
    grid_end = F.when(F.col("_tl_reset") > 0,
                      F.least(F.make_date(F.col("_tl_reset"), F.lit(12), F.lit(1)), F.lit(end_month))
                      ).otherwise(F.lit(end_month))
    grid = starts.select(*group, "_tl_reset",
                         F.explode(F.sequence(F.col("_tl_first"), grid_end, F.expr("interval 1 month")))
                         .alias(period_col))
    zero = F.lit(0).cast(monthly.schema["debit"].dataType)
    filled = grid.join(monthly, [*group, "_tl_reset", period_col], "left").select(
        *group, "_tl_reset", period_col,
        F.coalesce("debit", zero).alias("debit"), F.coalesce("credit", zero).alias("credit"))
    w = Window.partitionBy(*group, "_tl_reset").orderBy(period_col).rowsBetween(Window.unboundedPreceding, 0)
    movement = F.col("debit") - F.col("credit")
    closing = F.sum(movement).over(w)
    return filled.select(
        *group, period_col,
        F.round(closing - movement, 2).alias("opening"),
        F.round(F.col("debit"), 2).alias("debit"),
        F.round(F.col("credit"), 2).alias("credit"),
        F.round(movement, 2).alias("movement"),
        F.round(closing, 2).alias("closing"),
    )


def period_balances(lines: DataFrame, group: Sequence[str], date_col: str, debit_col: str, credit_col: str,
                    as_of, restart: Column | None = None, period_col: str = "period") -> DataFrame:
    """Monthly balances per group up to the month of ``as_of``.

    ``restart`` is a predicate over group columns: where true, balances start
    again each 1 January and a year's rows begin at its first movement.
    """
    # the monthly sums feed both the grid starts and the grid join: checkpointed once
    # (groups x months, small) so the raw lines are read a single time
    monthly = monthly_movements(lines, group, date_col, debit_col, credit_col, as_of, period_col).checkpoint(eager=True)
    return balances_from_monthly(monthly, group, as_of, restart, period_col)


def nonzero(df: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Keep a balance row when any of its rounded measures is non-zero (HAVING)."""
    cond = None
    for m in measures:
        c = F.col(m) != 0
        cond = c if cond is None else (cond | c)
    return df.filter(cond)


def split_history(df: DataFrame, date_col: str, as_of) -> tuple[DataFrame, DataFrame]:
    """(closed, current): rows before 1 January of ``as_of``'s year, and from then on.

    Both cuts are literal ranges on the column as it is stored, so they reach the
    scan; rows without a date belong to neither.
    """
    year_start = F.lit(dt.date(as_date(as_of).year, 1, 1))
    return df.filter(F.col(date_col) < year_start), df.filter(F.col(date_col) >= year_start)


def balances_with_history(current: DataFrame, history: DataFrame, group: Sequence[str], date_col: str, debit_col: str,
                          credit_col: str, as_of, restart: Column | None = None, period_col: str = "period") -> DataFrame:
    """Balances of all periods from the current year's movements and the frozen balances of closed years.

    * ``history``: stored balances (group, period, measures) up to last December, as
      ``period_balances`` gave them when the years were closed; never recomputed;
    * carry: each accumulating group's closing at last December, spread over every
      period of this year up to ``as_of``'s month (restarting groups carry nothing);
    * ``current``: this year's movements only; earlier ones are ignored.
    The three are united, summed per (group, period), and zero rows are dropped.
    """
    group = list(group)
    end = as_date(as_of)
    year_start = dt.date(end.year, 1, 1)
    last_closed = year_start - dt.timedelta(days=1)
    restarting = restart if restart is not None else F.lit(False)
    history = history.select(*group, period_col, *MEASURES).filter(F.col(period_col) < F.lit(year_start))
    monthly = monthly_movements(current.filter(F.col(date_col) >= F.lit(year_start)), group, date_col, debit_col,
                                credit_col, end, period_col).checkpoint(eager=True)
    moved = balances_from_monthly(monthly, group, end, F.lit(True), period_col)
    last_hist = history.filter(F.col(period_col) == F.lit(_month(last_closed))).filter(~restarting)
    months = F.sequence(F.lit(year_start), F.lit(_month(end)), F.expr("interval 1 month"))
    zero = F.lit(0).cast(history.schema["debit"].dataType)
    carry = last_hist.select(*group, F.explode(months).alias(period_col), F.col("closing").alias("opening"),
                             zero.alias("debit"), zero.alias("credit"), zero.alias("movement"),
                             F.col("closing").alias("closing"))
    united = history.unionByName(carry).unionByName(moved)
    return nonzero(united.groupBy(*group, period_col).agg(*[F.sum(m).alias(m) for m in MEASURES]))


def spread_label(df: DataFrame, group: Sequence[str], col: str, out: str, fn=F.max) -> DataFrame:
    """``fn(col) OVER (PARTITION BY group)`` as an aggregate joined back (W9).

    The aggregate is combined map-side, so a group with a third of all rows is
    never sorted in one task; the label table has one row per group.
    """
    labels = df.groupBy(*group).agg(fn(col).alias(out))
    return df.join(labels, list(group), "left")
