import math
from datetime import date

from pyspark.sql import functions as F

from courtline.functions.dates import (
    event_instant, event_local_date, game_date, local_date_of_instant, local_date_of_utc)
from courtline.functions.text import fill, matchup, nickname, number_text

NUMBERS = [0.0, -0.0, 4.0, -3.5, 0.1, 6.7, -12.3, 110.0, 215.5, 1234567.0, -0.04, 1e22, None]
SHARES = [0.5, 0.565, 0.585, 0.595, 0.125, 0.001, 0.999, 1.0, 0.0, 0.555, None]


def _python(value, spec):
    return format(math.nan if value is None else value, spec)


def test_number_text_prints_like_python(spark):
    cases = [
        (NUMBERS, ".1f", dict(decimals=1)),
        (NUMBERS, "+.1f", dict(decimals=1, signed=True)),
        ([*NUMBERS, 0.5, 1.5, 2.5, -2.5], "+.0f", dict(decimals=0, signed=True)),
        (SHARES, ".0%", dict(decimals=0, percent=True)),
        (SHARES, ".1%", dict(decimals=1, percent=True)),
    ]
    for values, spec, how in cases:
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
        got = [r[0] for r in df.orderBy("i").select(number_text(F.col("x"), **how)).collect()]
        assert got == [_python(v, spec) for v in values], spec


def test_names(spark):
    names = ["Los Angeles  Lakers", " Boston Celtics ", "Heat", "a\tb", "", None]
    df = spark.createDataFrame([(n,) for n in names], "x string")
    assert [r[0] for r in df.select(nickname(F.col("x"))).collect()] == [
        "Lakers", "Celtics", "Heat", "b", None, None]
    pairs = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "a string, b string")
    assert [r[0] for r in pairs.select(matchup(F.col("a"), F.col("b"))).collect()] == ["A @ B", None, None]


def test_fill(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    assert df.select(fill("%s-%s, 100%", "a", "b")).first()[0] == "x-nan, 100%"


def test_game_dates(spark):
    texts = ["NOV 04, 2025", "Dec 25, 2025", "nov 4, 2025", "", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    assert [r[0] for r in df.select(game_date(F.col("x"))).collect()] == [
        date(2025, 11, 4), date(2025, 12, 25), date(2025, 11, 4), None, None, None]


def test_local_dates_do_not_depend_on_the_session_zone(spark):
    texts = ["2025-11-04T00:30Z", "2025-11-04T05:30:00Z", "2025-11-04T05:30:00+00:00",
             "2025-03-09T07:30Z", "2025-11-04T00:30:15.500Z", "later", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")

    def local(zone):
        return [r[0] for r in df.select(local_date_of_instant(event_instant(F.col("x")), zone)).collect()]

    new_york = [date(2025, 11, 3), date(2025, 11, 4), date(2025, 11, 4), date(2025, 3, 9), date(2025, 11, 3),
                None, None]
    utc = [date(2025, 11, 4)] * 3 + [date(2025, 3, 9), date(2025, 11, 4), None, None]
    original = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            assert local("America/New_York") == new_york
            assert local("UTC") == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", original)
    zoneless = spark.createDataFrame(
        [("2025-11-04T23:30",), ("2025-11-04",), ("2025-11-04T05:30Z",), ("2025-13-40",), ("4 Nov",)], "x string")
    assert [r[0] for r in zoneless.select(event_local_date(F.col("x"), "America/Los_Angeles")).collect()] == [
        date(2025, 11, 4), date(2025, 11, 4), date(2025, 11, 3), None, None]
    stamp = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 04:59:59' AS x")
    assert stamp.select(local_date_of_utc(F.col("x"), "-05:00")).first()[0] == date(2023, 12, 31)


def test_the_repeated_hour_of_the_session_zone(spark):
    """The instant lies in an hour that New York's clock shows twice."""
    df = spark.createDataFrame([("2025-11-02T06:30Z",), ("2025-11-02T05:30Z",)], "x string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            got = [str(r[0]) for r in df.select(event_local_date(F.col("x"), "America/Costa_Rica")).collect()]
            assert got == ["2025-11-02", "2025-11-01"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
