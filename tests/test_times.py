import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylag.functions import times

DAY = "2015-12-31"


@pytest.mark.parametrize(
    "hhmm, text, stamp",
    [
        ("0005", "00:05:00Z", dt.datetime(2015, 12, 31, 0, 5)),
        ("2400", "23:59:00Z", dt.datetime(2015, 12, 31, 23, 59)),
        ("2430", "23:59:00Z", dt.datetime(2015, 12, 31, 23, 59)),
        ("2359", "23:59:00Z", dt.datetime(2015, 12, 31, 23, 59)),
        ("05", ":05:00Z", None),
        ("", "::00Z", None),
        (None, None, None),
    ],
)
def test_schedule_times(spark, hhmm, text, stamp):
    df = spark.createDataFrame([(DAY, hhmm)], "d string, h string")
    row = df.select(times.hhmm_to_time("h").alias("t"), times.schedule_ts("d", "h").alias("s")).first()
    assert row["t"] == text
    assert row["s"] == stamp


def test_schedule_does_not_follow_the_session_zone(spark):
    df = spark.createDataFrame([(DAY, "0305")], "d string, h string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        row = df.select(
            times.schedule_ts("d", "h").alias("s"), times.parse_iso_date("d").alias("day")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row["s"] == dt.datetime(2015, 12, 31, 3, 5)
    assert row["day"] == dt.date(2015, 12, 31)


@pytest.mark.parametrize("arr, day", [("0100", 1), ("0200", 31), ("0300", 31)])
def test_only_earlier_arrivals_move_to_the_next_day(spark, arr, day):
    df = spark.createDataFrame([(DAY, "0200", arr)], "d string, dep string, arr string")
    fixed = times.fix_overnight(times.schedule_ts("d", "dep"), times.schedule_ts("d", "arr"))
    assert df.select(fixed.alias("x")).first()["x"].day == day


def test_request_weekdays_start_at_zero(spark):
    df = spark.createDataFrame([("2016-12-25",), ("2016-12-25T10:00:00",), ("soon",)], "d string")
    rows = df.select(*[c.alias(n) for n, c in times.date_parts("d").items()]).collect()
    assert tuple(rows[0]) == tuple(rows[1]) == (360, 25, 6)
    assert tuple(rows[2]) == (None, None, None)
