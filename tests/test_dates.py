"""Dates counted in seconds or weeks, against the standard library."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.functions.dates import parse_date

DAYS = [dt.date(1999, 12, 25) + dt.timedelta(days=3 * k) for k in range(3000)]


def read(spark, texts, form):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select(parse_date(F.col("t"), form).alias("d"), "i").orderBy("i").select("d").collect()]


@pytest.mark.parametrize("form", ["%G-W%V-%u", "%Y %W %w", "%Y/%U/%u", "%Y-%U-%w", "week %W of %Y, day %u"])
def test_weeks_match_the_standard_library(spark, form):
    assert read(spark, [d.strftime(form) for d in DAYS], form) == DAYS


def test_seconds_and_offsets(spark):
    assert read(spark, ["0", "-1", "86399", "1700000000", "x", None], "%s") == [
        dt.date(1970, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(2023, 11, 14), None, None
    ]
    texts = ["2024-03-01 00:30:00+01:00", "2024-03-01 23:30:00-05:00", "2024-03-01 00:30:00+0100"]
    assert read(spark, texts, "%Y-%m-%d %H:%M:%S%:z") == [dt.date(2024, 2, 29), dt.date(2024, 3, 2), None]


def test_weeks_that_do_not_exist(spark):
    assert read(spark, ["2021-W53-1", "2020-W53-5", "2020-W00-1", "2020-W53-8", ""], "%G-W%V-%u") == [
        None, dt.date(2021, 1, 1), None, None, None
    ]


def test_week_without_a_weekday_raises(spark):
    with pytest.raises(ValueError, match="Unsupported"):
        parse_date(F.lit("2020 5"), "%Y %W")
