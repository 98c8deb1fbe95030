"""Calendar dimension: date parts, two-language names, fiscal labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import week_of_year_sunday
from ..functions.keys import date_key
from ..functions.text import decode

# Spanish month names, January to December.
MONTHS_ES = ["ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO", "AGOSTO",
             "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE"]
# Spanish day names, Sunday (1) to Saturday (7).
DAYS_ES = ["DOMINGO", "LUNES", "MARTES", "MIÉRCOLES", "JUEVES", "VIERNES", "SÁBADO"]


def calendar_attributes(days: DataFrame, col: str = "day") -> DataFrame:
    """Add the calendar columns to a frame of dates (one row per day)."""
    d = F.col(col)
    yy = F.substring(F.year(d).cast("string"), 3, 2)
    return days.select(
        "*",
        date_key(d).cast("long").alias("date_key"),
        F.year(d).cast("long").alias("year"),
        F.quarter(d).cast("long").alias("quarter"),
        F.month(d).cast("long").alias("month"),
        week_of_year_sunday(d).cast("long").alias("week"),
        F.dayofmonth(d).cast("long").alias("day_of_month"),
        F.dayofweek(d).cast("long").alias("day_of_week"),
        F.concat(F.lit("T"), F.quarter(d).cast("string"), F.lit("/"), yy).alias("quarter_name"),
        F.upper(F.date_format(d, "MMMM")).alias("month_name_en"),
        decode(F.month(d), {i + 1: m for i, m in enumerate(MONTHS_ES)}).alias("month_name_es"),
        F.upper(F.date_format(d, "EEEE")).alias("day_name_en"),
        decode(F.dayofweek(d), {i + 1: n for i, n in enumerate(DAYS_ES)}).alias("day_name_es"),
        F.concat(F.lit("FY"), yy).alias("fiscal_year"),
        F.concat(F.lit("P"), F.month(d).cast("string")).alias("fiscal_period"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("fiscal_quarter"),
    )
