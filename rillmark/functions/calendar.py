"""Calendar columns derived from time strings.

Times arrive as text, usually ``yyyy-MM-dd HH:mm:ss``, sometimes without zero
padding. Every function takes such a column and stays inside built-in
expressions. Parts of a text that cannot be read give NULL unless a function
says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TIME_SHAPE = r"^\d{4,}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d*)?$"
_EPOCH = "1970-01-01 00:00:00"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(c: Column | str) -> Column:
    """The part before the first blank."""
    return F.substring_index(_col(c), " ", 1)


def _date_part(c: Column | str, index: int) -> Column:
    return F.get(F.split(day(c), "-"), F.lit(index))


def _number(c: Column) -> Column:
    return c.try_cast("int")


def _pad2(c: Column) -> Column:
    return F.when(F.length(c) > 1, c).otherwise(F.concat(F.lit("0"), c))


def parsed(c: Column | str) -> Column:
    """Strictly parsed wall-clock time, NULL when the text is no full time."""
    c = _col(c)
    return F.when(c.rlike(_TIME_SHAPE), c.try_cast("timestamp_ntz"))


def year(c: Column | str) -> Column:
    return F.substring_index(day(c), "-", 1)


def quarter(c: Column | str) -> Column:
    """``yyyy-Qn``; NULL for a month beyond 12."""
    month = _number(_date_part(c, 1))
    n = F.when(month < 4, "1").when(month < 7, "2").when(month < 10, "3").when(month < 13, "4")
    return F.concat(year(c), F.lit("-Q"), n)


def year_month(c: Column | str) -> Column:
    return F.concat(year(c), F.lit("-"), _pad2(_date_part(c, 1)))


def ten_of_month(c: Column | str) -> Column:
    """``yyyy-MM-T1`` for days 1-10, ``T2`` for 11-20, ``T3`` after."""
    dom = _number(_date_part(c, 2))
    part = F.when(dom < 11, "-T1").when(dom < 21, "-T2").when(dom < 32, "-T3")
    return F.concat(year_month(c), part)


def hour(c: Column | str) -> Column:
    return _pad2(F.substring_index(F.get(F.split(_col(c), " "), F.lit(1)), ":", 1))


def week_number(d: Column) -> Column:
    """Week of year, weeks start on Sunday and week 1 holds 1 January.

    A week belongs to the year of its Saturday, and the Saturdays of a year
    are seven days apart: the n-th of them closes week n.
    """
    saturday = F.date_add(d, 7 - F.dayofweek(d))
    return F.ceil(F.dayofyear(saturday) / 7).cast("int")


def year_week(c: Column | str) -> Column:
    """``yyyy-Wnn`` with the calendar year; '' when the time does not parse.

    The last days of December may belong to week 1 and still carry the old
    year. Stored data is keyed that way, so it is kept.
    """
    d = parsed(c).cast("date")
    text = F.concat(F.year(d).cast("string"), F.lit("-W"), F.lpad(week_number(d).cast("string"), 2, "0"))
    return F.coalesce(text, F.when(_col(c).isNotNull(), ""))


def weekday(c: Column | str) -> Column:
    """Monday 1 to Sunday 7; 0 when the time does not parse."""
    d = parsed(c).cast("date")
    return F.coalesce(F.weekday(d) + 1, F.when(_col(c).isNotNull(), 0))


def year_week_day(c: Column | str) -> Column:
    return F.concat(year_week(c), F.lit("-"), weekday(c).cast("string"))


def event_calendar(c: Column | str) -> dict[str, Column]:
    """The calendar columns every event table carries."""
    return {
        "k_dt": day(c),
        "k_year": year(c),
        "k_year_quarter": quarter(c),
        "k_year_month": year_month(c),
        "k_year_week": year_week(c),
        "k_y_m_tenofmonth": ten_of_month(c),
        "k_hours": hour(c),
        "k_year_week_day": year_week_day(c),
    }


def tracker_calendar(d: Column | str) -> dict[str, Column]:
    """The second calendar dialect, used by the app tracker table."""
    d = _col(d).cast("date")
    y = F.year(d).cast("string")
    dom = F.dayofmonth(d)
    return {
        "dt": F.date_format(d, "yyyy-MM-dd"),
        "years": y,
        "year_week": (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("string"),
        "y_m_tenofmonth": F.when(dom <= 10, "1").when(dom <= 20, "2").when(dom.isNotNull(), "3"),
        "year_quarter": F.concat(y, F.lit("_Q"), F.quarter(d).cast("string")),
        "year_month": F.concat(y, F.lit("年"), F.month(d).cast("string"), F.lit("月")),
        "numofweek": (F.weekday(d) + 1).cast("string"),
        "numofyear": F.dayofyear(d).cast("string"),
    }


def epoch_seconds_to_time(seconds: Column, tz: str = "UTC") -> Column:
    """Epoch seconds to a time string on the wall clock of ``tz``."""
    utc = F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )
    wall = utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return F.date_format(wall, "yyyy-MM-dd HH:mm:ss")


def epoch_ms_to_time(c: Column | str, tz: str = "UTC") -> Column:
    """Epoch milliseconds (text or number) to a time string, floored to seconds."""
    return epoch_seconds_to_time(F.floor(_col(c).try_cast("bigint") / 1000), tz)


def epoch_ms_to_hour(c: Column | str, tz: str = "UTC") -> Column:
    return F.substring(epoch_ms_to_time(c, tz), 12, 2).cast("int")


def epoch_ms(ts: Column | str) -> Column:
    """Epoch milliseconds of a time in the session zone."""
    return F.unix_millis(_col(ts).cast("timestamp"))
