"""Birthday and age expressions. ``as_of`` is a ``yyyy-MM-dd`` text or column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import _col
from .labels import STAGE_MAX_MONTHS


def _today(as_of: Column | str | None) -> Column:
    if as_of is None:
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.lit(as_of) if isinstance(as_of, str) else as_of


def next_birthday(c: Column | str, as_of: Column | str | None = None, short: str | None = None) -> Column:
    """Next ``MM-dd`` on or after ``as_of``; a text too short gives ``short``."""
    c, now = _col(c), _today(as_of)
    month_day = F.substring(c, 6, 5)
    this_year = F.substring(now, 1, 4)
    year = F.when(
        F.substring(now, 6, 5) > month_day, (this_year.try_cast("int") + 1).cast("string")
    ).otherwise(this_year)
    return F.when(F.length(c) >= 10, F.concat(year, F.lit("-"), month_day)).when(
        c.isNotNull(), F.lit(short)
    )


def age_months(c: Column | str, as_of: Column | str | None = None) -> Column:
    """Months between year-months, days ignored; NULL when unreadable."""
    c, now = _col(c), _today(as_of)

    def part(text: Column, start: int, length: int) -> Column:
        return F.substring(text, start, length).try_cast("int")

    months = (part(now, 1, 4) - part(c, 1, 4)) * 12 + (part(now, 6, 2) - part(c, 6, 2))
    return F.when(F.length(c) >= 10, months)


def age_stage(months: Column | str) -> Column:
    """Stage code '0' (before conception is likely) to '11' by month age."""
    months = _col(months)
    chain = F.when(months <= STAGE_MAX_MONTHS[0], "0")
    for code, upper in enumerate(STAGE_MAX_MONTHS[1:], start=1):
        chain = chain.when(months <= upper, str(code))
    return chain.when(months.isNotNull(), str(len(STAGE_MAX_MONTHS)))
