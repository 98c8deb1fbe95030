import datetime as dt

from pyspark.sql import functions as F

from tallyloom.functions.dates import month_diff, same_month, week_of_year_sunday, window_start
from tallyloom.functions.keys import composite_key, date_key, hash_key, with_unknown
from tallyloom.functions.text import (
    decode,
    dots_to_spaces,
    one_line,
    regex_or_null,
    right,
    size_label,
    split_nth,
    text_after,
    text_before,
)


def test_text_helpers(spark):
    df = spark.createDataFrame([("900123-4", "ana.maria.lopez@x.org", "a\nb\r\nc", 2024)],
                               "tax string, mail string, note string, y int")
    r = df.select(
        text_before("tax", "-").alias("t1"), text_after("tax", "-").alias("t2"), text_after("mail", "#").alias("t3"),
        dots_to_spaces(text_before("mail", "@")).alias("u"), one_line("note").alias("n"),
        right(F.col("y").cast("string"), 2).alias("yy"), split_nth("mail", ".", 5).alias("oob"),
        regex_or_null("tax", r"^(\d{3})").alias("rx"), regex_or_null("tax", r"^([a-z]+)").alias("none"),
        decode("y", {2024: "this year"}, "other").alias("d"),
    ).first()
    assert (r.t1, r.t2, r.t3) == ("900123", "4", None)
    assert (r.u, r.n, r.yy, r.oob, r.rx, r.none, r.d) == ("ana maria lopez", "a b c", "24", None, "900", None,
                                                           "this year")


def test_size_label_bounds(spark):
    df = spark.createDataFrame([(0,), (1536,), (1024 ** 2 - 1,), (1024 ** 2,), (5 * 1024 ** 3,)], "b long")
    assert [r.s for r in df.select(size_label("b").alias("s")).collect()] == ["0 KB", "2 KB", "1024 KB", "1 MB", "5 GB"]


def test_keys(spark):
    df = spark.createDataFrame([(12, "ab", "c"), (None, "a", "bc")], "k long, a string, b string")
    r = df.select(hash_key("k").alias("h"), with_unknown(hash_key("k")).alias("u"),
                  composite_key("a", "b", sep=None).alias("legacy"), composite_key("a", "b").alias("safe")).collect()
    assert r[0].h == r[0].u and r[1].h is None and r[1].u != r[0].u
    assert r[0].legacy == r[1].legacy          # ('ab','c') and ('a','bc') collide without a separator
    assert r[0].safe != r[1].safe              # and not with one
    assert spark.range(1).select(date_key(F.lit(dt.date(2024, 2, 9))).alias("d")).first().d == 20240209


def test_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 7),), (dt.date(2023, 11, 30),)], "d date")
    r = df.select(week_of_year_sunday("d").alias("w"), month_diff(F.lit(dt.date(2024, 1, 31)), "d").alias("m"),
                  same_month("d", "2024-01-15").alias("s")).collect()
    assert [(x.w, x.m, x.s) for x in r] == [(0, 0, 1), (1, 0, 1), (48, 2, 0)]
    assert window_start("2024-03-15", 3) == dt.date(2023, 12, 1)
