"""Balances per period of any period table: fiscal years, 4-4-5 weeks, gaps, overlapping adjustment periods.

The rule is a range join of movements to periods.  Here it is an equi-join:

* ``interval_join`` cuts time into bins, gives every interval the bins that it
  touches and every point its own, joins on the bin and keeps the exact bounds as
  a residual.  A point has one bin, so no pair comes twice.
* ``period_balances_any`` cuts the calendar at every period's bounds into slots.
  A period is a run of slots, however periods overlap; movements are summed per
  (group, day), then per (group, slot), and a running sum over slots, read at a
  period's first and last slot and at its restart, gives all its balances.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import as_date
from ..sources.tables import literal_rows
from .ledger import MEASURES, nonzero

BIN_DAYS = 32


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str,
                  bin_days: int = BIN_DAYS) -> DataFrame:
    """Every point beside each interval that holds its day, both bounds included.

    Points without a day and intervals without a bound match nothing.  Choose
    ``bin_days`` near an interval's usual length: shorter bins copy long intervals
    often, longer ones compare more pairs.  The bin key can be as hot as a day is:
    aggregate points per day first, as ``period_balances_any`` does.
    """
    bin_of = lambda day: F.floor(F.unix_date(F.to_date(day)) / F.lit(bin_days)).cast("int")
    cut = intervals.filter(F.col(start) <= F.col(end)).withColumn(
        "_tl_bin", F.explode(F.sequence(bin_of(F.col(start)), bin_of(F.col(end)))))
    held = points.filter(F.col(at).isNotNull()).withColumn("_tl_bin", bin_of(F.col(at)))
    return held.join(cut, (held["_tl_bin"] == cut["_tl_bin"]) & F.to_date(F.col(at)).between(F.col(start), F.col(end))) \
        .drop(cut["_tl_bin"]).drop("_tl_bin")


PERIOD_SCHEMA = "period string, start date, end date, year_start date"


def week_period_rows(year_start, years: int, weeks: Sequence[int] = (4, 4, 5), adjustment: bool = False) -> list[tuple]:
    """(period, start, end, year_start) of fiscal years of four quarters, each cut into periods of whole weeks.

    A year starts the day after the one before it ended.  ``adjustment`` adds a
    period of the year's last day alone, which the last regular period holds too.
    """
    day, rows = as_date(year_start), []
    for _ in range(years):
        first = day
        for number, n in enumerate(list(weeks) * 4, 1):
            end = day + dt.timedelta(weeks=n, days=-1)
            rows.append((f"FY{first.year}-{number:02d}", day, end, first))
            day = end + dt.timedelta(days=1)
        if adjustment:
            rows.append((f"FY{first.year}-ADJ", end, end, first))
    return rows


def week_periods(spark: SparkSession, year_start, years: int, weeks: Sequence[int] = (4, 4, 5),
                 adjustment: bool = False) -> DataFrame:
    """``week_period_rows`` as a period table."""
    return literal_rows(spark, week_period_rows(year_start, years, weeks, adjustment), PERIOD_SCHEMA)


def _slots(periods: DataFrame, floor: Column | None) -> DataFrame:
    """(slot, slot_start, slot_end): the calendar cut wherever a period or a fiscal year begins or ends.

    Works on distinct bounds of the period table, one row per bound: a window
    without a key is fine there.
    """
    cuts = periods.select(F.explode(F.array("start", F.date_add("end", 1), "year_start")).alias("slot_start"))
    if floor is not None:
        cuts = cuts.select(F.greatest("slot_start", floor).alias("slot_start"))
    ordered = Window.orderBy("slot_start")
    return cuts.filter("slot_start is not null").distinct().select(
        F.row_number().over(ordered).alias("slot"), "slot_start",
        F.date_sub(F.coalesce(F.lead("slot_start").over(ordered), F.col("slot_start")), 1).alias("slot_end"))


def period_balances_any(lines: DataFrame, periods: DataFrame, group: Sequence[str], date_col: str, debit_col: str,
                        credit_col: str, as_of, restart: Column | None = None, floor=None,
                        period_col: str = "period") -> DataFrame:
    """Opening/debit/credit/movement/closing per group and period, from the group's first movement on.

    ``periods`` has (``period_col``, start, end, year_start), one row per period; the
    last day belongs to it.  Balances cover the periods that end by ``as_of``.
    * An accumulating group's opening is all movements before the period, from
      ``floor`` on when given; a period exists once the group has a movement up to
      its end.
    * A group for which ``restart`` holds starts again at each ``year_start``, and a
      year's rows begin with its first movement.
    * Movements outside all periods count in later openings, in no period's own sums.
    * Periods that start before ``floor``, and movements before it, do not count.
    """
    group, end = list(group), F.lit(as_date(as_of))
    low = F.lit(as_date(floor)) if floor is not None else None
    used = periods.filter(F.col("end") <= end)
    lines = lines.filter(F.col(date_col) <= end)
    if low is not None:
        used, lines = used.filter(F.col("start") >= low), lines.filter(F.col(date_col) >= low)
    used = used.select(period_col, "start", "end", F.coalesce("year_start", "start").alias("year_start"))
    used = used.checkpoint(eager=True)  # read four times, small
    slots = _slots(used, low).checkpoint(eager=True)
    first = slots.agg(F.min("slot_start")).first()[0]
    if first is None:
        first = as_date(as_of) + dt.timedelta(days=1)
    # days before every slot belong to slot 0: they only count in openings
    known = F.greatest(F.to_date(date_col), F.lit(first - dt.timedelta(days=1)))
    before = slots.select(F.lit(0).alias("slot"), F.lit(first - dt.timedelta(days=1)).alias("slot_start"),
                          F.lit(first - dt.timedelta(days=1)).alias("slot_end")).limit(1)
    # once per (group, day), combined map-side, before any join
    days = lines.groupBy(*group, known.alias("_tl_day")).agg(
        F.sum(debit_col).alias("debit"), F.sum(credit_col).alias("credit"))
    sums = interval_join(days, slots.unionByName(before), "_tl_day", "slot_start", "slot_end").groupBy(*group, "slot").agg(
        F.sum("debit").alias("debit"), F.sum("credit").alias("credit"))
    sums = sums.checkpoint(eager=True)  # groups x slots: feeds the probes and the running sum

    at = slots.select("slot", "slot_start")
    runs = (used.join(at.select(F.col("slot_start").alias("start"), F.col("slot").alias("_tl_first")), "start")
            .join(at.select(F.date_sub("slot_start", 1).alias("end"), (F.col("slot") - 1).alias("_tl_last")), "end")
            .withColumn("_tl_year", F.greatest("year_start", low) if low is not None else F.col("year_start"))
            .join(at.select(F.col("slot_start").alias("_tl_year"), F.col("slot").alias("_tl_reset")), "_tl_year")
            .select(period_col, "_tl_first", "_tl_last", "_tl_reset"))
    restarting = restart if restart is not None else F.lit(False)
    # each (group, period) asks for the running sum at three places; the last slots run from the group's first to the end
    starts = sums.groupBy(*group).agg(F.min("slot").alias("_tl_from"))
    places = slots.agg(F.max("slot").alias("m")).first()[0] or 0
    asked = (starts.withColumn("_tl_last", F.explode(F.sequence(F.col("_tl_from"), F.greatest("_tl_from", F.lit(places)))))
             .join(runs, "_tl_last")
             .withColumn("_tl_base", F.when(restarting, F.col("_tl_reset") - 1).otherwise(F.lit(-1))))
    probes = asked.select(*group, period_col, F.posexplode(
        F.array(F.col("_tl_base"), F.col("_tl_first") - 1, F.col("_tl_last"))).alias("_tl_kind", "slot"))
    none, zero = F.lit(None), F.lit(0).cast(sums.schema["debit"].dataType)
    events = sums.select(*group, "slot", none.cast(used.schema[period_col].dataType).alias(period_col),
                         none.cast("int").alias("_tl_kind"), "debit", "credit", F.lit(1).alias("_tl_n")).unionByName(
        probes.select(*group, "slot", period_col, "_tl_kind", zero.alias("debit"), zero.alias("credit"), F.lit(0).alias("_tl_n")))
    running = Window.partitionBy(*group).orderBy("slot").rangeBetween(Window.unboundedPreceding, 0)
    read = events.select(*group, period_col, "_tl_kind", *[F.sum(c).over(running).alias(c) for c in ("debit", "credit", "_tl_n")])
    # the window's partitioning by group serves this aggregate too: no further shuffle
    kind = lambda k, c: F.max(F.when(F.col("_tl_kind") == k, F.coalesce(c, F.lit(0))))
    found = read.filter(F.col("_tl_kind").isNotNull()).groupBy(*group, period_col).agg(
        *[kind(k, F.col(c)).alias(f"{c}{k}") for k in range(3) for c in ("debit", "credit", "_tl_n")])
    net = lambda k: F.col(f"debit{k}") - F.col(f"credit{k}")
    exact = {"opening": net(1) - net(0), "debit": F.col("debit2") - F.col("debit1"), "credit": F.col("credit2") - F.col("credit1"),
             "movement": net(2) - net(1), "closing": net(2) - net(0)}
    return found.filter(F.col("_tl_n2") > F.col("_tl_n0")).select(
        *group, period_col, *[F.round(exact[m], 2).alias(m) for m in MEASURES])


def balances_any_with_history(current: DataFrame, history: DataFrame, periods: DataFrame, group: Sequence[str], date_col: str,
                              debit_col: str, credit_col: str, as_of, year_start, restart: Column | None = None,
                              period_col: str = "period") -> DataFrame:
    """Balances of all periods from this fiscal year's movements and the frozen balances of closed ones.

    * ``history``: stored balances (group, period, measures) of the periods that
      ended before ``year_start``, as ``period_balances_any`` gave them; never
      recomputed.  The last of them must reach up to ``year_start``.
    * carry: each accumulating group's closing of the last closed period, put into
      every period of this year that ended by ``as_of``.
    * ``current``: movements from ``year_start`` on; earlier ones are ignored, and
      so are those in closed periods.
    The three are united, summed per (group, period), and zero rows are dropped.
    """
    group, cut = list(group), F.lit(as_date(year_start))
    restarting = restart if restart is not None else F.lit(False)
    closed = periods.filter(F.col("end") < cut)
    ours = periods.filter((F.col("start") >= cut) & (F.col("end") <= F.lit(as_date(as_of))))
    last = closed.agg(F.max_by(period_col, F.struct("end", F.col(period_col))).alias("p"), F.max("end").alias("e")).first()
    if last.e is not None and last.e + dt.timedelta(days=1) != as_date(year_start):
        raise ValueError(f"the last closed period ends on {last.e}, not the day before {year_start}")
    names = [r[0] for r in ours.select(period_col).collect()]  # the periods of one year
    history = history.select(*group, period_col, *MEASURES).join(closed.select(period_col), period_col, "left_semi")
    moved = period_balances_any(current, ours.withColumn("year_start", cut), group, date_col, debit_col, credit_col, as_of,
                                F.lit(True), year_start, period_col)
    zero = F.lit(0).cast(history.schema["debit"].dataType)
    carry = history.filter((F.col(period_col) == F.lit(last.p)) & ~F.coalesce(restarting, F.lit(False))).select(
        *group, F.explode(F.array(*map(F.lit, names)) if names else F.array().cast("array<string>")).alias(period_col),
        F.col("closing").alias("opening"), zero.alias("debit"), zero.alias("credit"), zero.alias("movement"), "closing")
    united = history.unionByName(carry).unionByName(moved)
    return nonzero(united.groupBy(*group, period_col).agg(*[F.sum(m).alias(m) for m in MEASURES]))
