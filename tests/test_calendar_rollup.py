import datetime as dt

from tallyloom.operators.aggregates import level_rollup
from tallyloom.operators.calendar import calendar_attributes
from tallyloom.operators.conform import classify_by_prefix
from tallyloom.sources.tables import generate_calendar

from conftest import rows


def test_calendar_labels(spark):
    cal = calendar_attributes(generate_calendar(spark, "2024-02-28", "2024-03-03"))
    got = {r.day: r for r in cal.collect()}
    d = got[dt.date(2024, 2, 29)]
    assert (d.date_key, d.year, d.quarter, d.month, d.day_of_week) == (20240229, 2024, 1, 2, 5)
    assert (d.month_name_en, d.month_name_es, d.day_name_en, d.day_name_es) == ("FEBRUARY", "FEBRERO", "THURSDAY",
                                                                                "JUEVES")
    assert (d.quarter_name, d.fiscal_year, d.fiscal_period, d.fiscal_quarter) == ("T1/24", "FY24", "P2", "Q1")
    sunday = got[dt.date(2024, 3, 3)]
    assert (sunday.day_of_week, sunday.day_name_es, sunday.week) == (1, "DOMINGO", 9)
    assert cal.count() == 5


def test_level_rollup(spark):
    daily = spark.createDataFrame([("20240105", 2), ("20240120", 3), ("20240201", 4), ("20250101", 1)],
                                  "code string, n long")
    got = rows(level_rollup(daily, "code", [4, 6], ["n"]), "level", "code", "n")
    assert got == [(1, "2024", 9), (1, "2025", 1), (2, "202401", 5), (2, "202402", 4), (2, "202501", 1)]


def test_classify_by_prefix_defaults(spark):
    df = spark.createDataFrame([("small ring",), ("tiny gear",), ("42",), (None,)], "name string")
    out = classify_by_prefix(df, "name", "^([a-z]+) ", {"small": "SIZE"}, "OTHER")
    assert rows(out, "name", "prefix", "system") == [
        ("42", None, "OTHER"), ("small ring", "small", "SIZE"), ("tiny gear", "tiny", "OTHER"), (None, None, "OTHER")]
