import datetime

import pytest
from rows import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rillmark.functions import calendar as cal
from pyspark.sql import functions as F


def week(d: datetime.date) -> int:
    """Week with Sunday first that holds 1 January as week 1, by counting days."""
    saturday = d + datetime.timedelta(days=(5 - d.weekday()) % 7)
    n, first = 1, datetime.date(saturday.year, 1, 1)
    first += datetime.timedelta(days=(5 - first.weekday()) % 7)
    while first < saturday:
        first += datetime.timedelta(days=7)
        n += 1
    return n


def test_weeks_of_many_years(spark):
    days = [datetime.date(y, m, d) for y in range(1995, 2031) for m, d in [(1, x) for x in range(1, 9)] + [(12, x) for x in range(24, 32)] + [(2, 28), (7, 4)]]
    df = spark.createDataFrame([(f"{d} 10:00:00", f"{d.year}-W{week(d):02d}", d.isoweekday()) for d in days], "t string, w string, k int")
    assert df.where((cal.year_week("t") != F.col("w")) | (cal.weekday("t") != F.col("k"))).count() == 0


def test_year_end_week_keeps_calendar_year(frame):
    assert values(frame("t", "2018-12-30 08:00:00").select(cal.year_week("t"))) == [("2018-W01",)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2019-1-5 8:0:0", ("2019-1-5", "2019", "2019-Q1", "2019-01", "2019-W01", "2019-01-T1", "08", "2019-W01-6")),
        ("2019-10-11 23:59:59", ("2019-10-11", "2019", "2019-Q4", "2019-10", "2019-W41", "2019-10-T2", "23", "2019-W41-5")),
        ("2019-13-21 00:00:00", ("2019-13-21", "2019", None, "2019-13", "", "2019-13-T3", "00", "-0")),
        ("2019-01-05", ("2019-01-05", "2019", "2019-Q1", "2019-01", "", "2019-01-T1", None, "-0")),
        ("bad", ("bad", "bad", None, None, "", None, None, "-0")),
        (None, (None,) * 8),
    ],
)
def test_event_calendar(frame, text, expected):
    columns = cal.event_calendar("t")
    names = ["k_dt", "k_year", "k_year_quarter", "k_year_month", "k_year_week", "k_y_m_tenofmonth", "k_hours", "k_year_week_day"]
    assert values(frame("t", text).select(*[columns[n] for n in names])) == [expected]


def test_strict_parse_drops_lenient_dates(frame):
    df = frame("t", "2019-02-30 00:00:00", "2019-01-01T00:00:00", "2019-01-01 25:00:00", "2019-01-01 01:02:03")
    assert [r[0] is not None for r in values(df.select(cal.parsed("t")))] == [False, False, False, True]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.datetimes(datetime.datetime(1971, 1, 1), datetime.datetime(2100, 1, 1)), min_size=20, max_size=60))
def test_epoch_and_calendar_agree(spark, times):
    rows = [(str(int(t.replace(tzinfo=datetime.timezone.utc).timestamp() * 1000)), f"{t:%Y-%m-%d %H:%M:%S}", t.hour, week(t.date())) for t in times]
    df = spark.createDataFrame(rows, "ms string, t string, h int, w int")
    bad = (cal.epoch_ms_to_time("ms") != F.col("t")) | (cal.epoch_ms_to_hour("ms") != F.col("h")) | (cal.week_number(F.to_date("t")) != F.col("w"))
    assert df.where(bad).count() == 0


def test_epoch_in_a_zone_does_not_depend_on_the_session(spark, frame):
    df = frame("ms", "1547979394117", "x", None)
    want = [("2019-01-20 18:16:34",), (None,), (None,)]
    assert values(df.select(cal.epoch_ms_to_time("ms", "Asia/Shanghai"))) == want
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values(df.select(cal.epoch_ms_to_time("ms", "Asia/Shanghai"))) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
