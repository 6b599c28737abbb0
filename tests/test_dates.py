from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from snapdiff.functions import dates as dt
from snapdiff.model import ConfigError

US, ISO = "%m/%d/%y", "%Y-%m-%d"


def reformat(a, b):
    return lambda c: dt.reformat_date(c, a, b)


US_DATES = [
    ("01/02/18", "2018-01-02"), ("1/2/18", "2018-01-02"), ("1/ 2/18", "2018-01-02"), ("12/31/99", "1999-12-31"),
    ("01/01/49", "2049-01-01"), ("01/01/50", "1950-01-01"), ("01/01/68", "1968-01-01"), ("01/01/69", "1969-01-01"),
    ("01/01/70", "1970-01-01"), ("01/01/00", "2000-01-01"), ("02/29/00", "2000-02-29"), ("02/29/52", "1952-02-29"),
    ("02/29/18", None), ("02/30/18", None), ("13/01/18", None), ("00/01/18", None), ("01/00/18", None),
    ("01/02/18 ", None), (" 01/02/18", None), ("01/02/2018", None), ("01-02-18", None), ("x", None), ("", None),
    ("2018-01-02", None), ("20--", None), ("01/ 12/18", None),
]


def test_us_dates(values):
    texts, expected = zip(*US_DATES)
    assert list(zip(texts, values(reformat(US, ISO), *texts))) == US_DATES
    assert values(lambda c: dt.is_date(c, US), *texts) == [e is not None for e in expected]


def test_other_expressions_keep_the_common_century_rule(values):
    assert values(reformat("%m-%d-%y", ISO), "01-01-50", "01-01-68", "01-01-69") == [
        "2050-01-01", "2068-01-01", "1969-01-01"]


@pytest.mark.parametrize("expression, text", [
    ("%Y%m%d", "20180910"), ("%Y%m%d", "2018910"), ("%d %b %Y", "3 sep 2018"), ("%B %d, %Y", "March 03, 2018"),
    ("%Y-%m-%d %H:%M:%S", "2018-09-10 1:2:3"), ("%Y-%m-%dT%H:%M:%S.%f", "2018-09-10T23:59:59.5"),
    ("%m/%d/%Y %I:%M %p", "09/10/2018 12:05 AM"), ("%m/%d/%Y %I:%M %p", "09/10/2018 12:05 pm"),
    ("%m/%d/%Y %I:%M %p", "09/10/2018 3:05 PM"), ("%A %d.%m.%Y", "monday 10.09.2018"), ("%H:%M", "07:30"),
    ("%Y", "2018"), ("%d%%%m%%%Y", "1%2%2018"), ("%Y  %m", "2018 \t 9"), ("%y%m%d", "180910"),
    ("%Y-%m-%d", "0001-01-01"),
])
def test_agrees_with_strptime(spark, expression, text):
    df = spark.range(1).select(F.lit(text).alias("t"))
    got = df.select(dt.parse_date(F.col("t"), expression).alias("v")).first().v
    assert got == datetime.strptime(text, expression)
    assert df.select(dt.is_date(F.col("t"), expression).alias("v")).first().v


@pytest.mark.parametrize("expression, text", [
    ("%Y-%m-%d", "0000-01-01"), ("%Y-%m-%d", "18-01-01"), ("%Y-%m-%d", "02018-01-01"), ("%H:%M", "24:00"),
    ("%S", "60x"), ("%d %b %Y", "3 sept 2018"), ("%Y%m%d", "2018-09-10"), ("%I:%M %p", "13:00 PM"),
    ("%Y-%m-%d", "2018-09-31"), ("%Y-%m-%d", "2018-09-10\n"),
])
def test_rejects_what_strptime_rejects(values, expression, text):
    with pytest.raises(ValueError):
        datetime.strptime(text, expression)
    assert values(lambda c: dt.is_date(c, expression), text) == [False]


@pytest.mark.parametrize("expression", ["%Y-%m-%d", "%d.%m.%y", "%b %d, %Y", "%B %A", "%H:%M:%S %p %I", "on %j 'q' #{}[]"])
def test_prints_like_strftime(spark, expression):
    moment = datetime(2018, 9, 3, 15, 4, 5)
    df = spark.range(1).select(F.lit(moment).alias("t"))
    got = df.select(F.date_format("t", dt.spark_date_pattern(expression)).alias("v")).first().v
    assert got == moment.strftime(expression)


@pytest.mark.parametrize("expression", ["%Q", "%Y %", "%G", "%Y %Y"])
def test_unsupported_directives_are_refused(spark, expression):
    with pytest.raises(ConfigError):
        dt.parse_date(F.lit("x"), expression)


def test_run_dates():
    assert dt.snapshot_days(date(2018, 9, 10), 0, 1) == (date(2018, 9, 10), date(2018, 9, 9))
    assert dt.snapshot_days(date(2018, 3, 1), 1, 2) == (date(2018, 2, 28), date(2018, 2, 27))
    assert dt.snapshot_path("s3://b/", "raw/x/", date(2018, 9, 9)) == "s3://b/raw/x/2018/09/09/"
    assert dt.run_timestamp(datetime(2018, 9, 10, 6, 5, 4)) == "2018-09-10 06:05:04"


def test_dated_columns(spark):
    day = F.lit(date(2018, 9, 10))
    row = spark.range(1).select(
        dt.dated_path("s3://b/", "raw/", dt.days_ago(day, 10)).alias("p"),
        dt.dated_text("feed_{0}-{1}-{2}.csv", day).alias("n"),
        dt.timestamp_text(F.lit(datetime(2018, 9, 10, 6, 5, 4))).alias("t")).first()
    assert tuple(row) == ("s3://b/raw/2018/08/31/", "feed_2018-09-10.csv", "2018-09-10 06:05:04")


MOMENTS = [datetime(1970, 1, 2) + timedelta(days=41 * n, seconds=7919 * n) for n in range(500)]


@pytest.mark.parametrize("expression", [
    "%Y%j", "%y%j", "%Y%m%d%j", "%j %I:%M %p %Y", "%c", "%x %X", "%Y-%m-%d %H:%M:%S %z", "%w %U %W %Y-%m-%d"])
def test_directives_as_python_reads_them(spark, expression):
    texts = [m.strftime(expression.replace("%z", "+0130")) for m in MOMENTS[::10]]
    texts += ["2019366", "2020366", "2019367", "2019000", "20196", "2018-01-01 00:00:00 Z", "2018-01-01 00:00:00 -01:00:30", "x"]

    def read(text):
        try:
            return datetime.strptime(text, expression).replace(tzinfo=None)
        except ValueError:
            return None

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(
        dt.parse_date(F.col("t"), expression), dt.is_date(F.col("t"), expression)).collect()
    assert [tuple(r) for r in rows] == [(read(t), read(t) is not None) for t in texts]


@pytest.mark.parametrize("expression", ["%w %U %W", "%x|%X", "%c", "%j %e%%|", "%Y-%m-%d%z"])
def test_directives_as_python_prints_them(spark, expression):
    rows = spark.createDataFrame(list(enumerate(MOMENTS)), "i int, t timestamp_ntz").orderBy("i").select(
        dt.format_moment(F.col("t"), expression)).collect()
    assert [r[0] for r in rows] == [m.strftime(expression) for m in MOMENTS]


def _strptime(text, expression):
    try:
        return datetime.strptime(text, expression)
    except ValueError:
        return None


@pytest.mark.parametrize("expression", [
    "%Y %U %w", "%Y %W %a", "%A %U %y", "%Y-%m-%d %U %a", "%W %w %U %a %Y", "%I%p %Y %W %A", "%Y%j %U %w", "%%a %%U %Y", "%Y %U"])
def test_weeks_and_weekdays_as_python_reads_them(spark, expression):
    days = [date(y, 1, 1) + timedelta(days=n) for y in (1, 1900, 2000, 2015, 2017, 2018, 2024, 9999) for n in (0, 1, 5, 6, 7, 58, 59, 200, 358, 364)]
    texts = [datetime(d.year, d.month, d.day, 13).strftime(expression.replace("%Y", f"{d.year:04}")) for d in days]
    texts += ["2018 00 0", "2018 0 6", "2018 53 6", "2018 54 1", "0001 00 0", "9999 53 6", "2018 1 Mon", "2018 12 fri", "2018-02-30 10 Tue", "x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(
        dt.parse_date(F.col("t"), expression), dt.is_date(F.col("t"), expression)).collect()
    want = [_strptime(t, expression) for t in texts]
    assert [tuple(r) for r in rows] == [(w, w is not None) for w in want]


ZONES = ["+0000", "-0000", "Z", "+0130", "-01:30", "+23:59:59", "-235959.5", "+01:00:00.000100", "+0000:30", "+01:0030",
         "+2400", "-99:00", "+00:00:00.0", "-00:00:01", "z", "", "+010000"]


@pytest.mark.parametrize("wanted", ["%z", "%d%z|%%z", "%H:%M"])
def test_zones_are_printed_as_python_does(spark, wanted):
    texts = [f"2018-09-03 15:04 {z}" for z in ZONES]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(
        dt.reformat_date(F.col("t"), "%Y-%m-%d %H:%M %z", wanted)).collect()
    want = [_strptime(t, "%Y-%m-%d %H:%M %z") for t in texts]
    assert [r[0] for r in rows] == [w and w.strftime(wanted) for w in want]
