"""Row filters."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import parsed
from ..functions.coerce import required_columns
from ..functions.text import blank


def table_matches(base: str | None, col: str = "tableName") -> Column:
    """True where the table is ``base`` or one of its numbered shards."""
    if not base:
        return F.lit(True)
    return F.coalesce(F.col(col).rlike(f"^(?:{base}_?[0-9]*)$"), F.lit(False))


def filter_table(df: DataFrame, base: str | None, col: str = "tableName") -> DataFrame:
    return df.where(table_matches(base, col))


def filter_any_table(df: DataFrame, bases: Sequence[str], col: str = "tableName") -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [table_matches(b, col) for b in bases]))


def filter_table_exact(df: DataFrame, name: str, col: str = "tableName") -> DataFrame:
    """Table name equal, ignoring case."""
    return df.where(F.lower(F.col(col)) == name.lower())


def filter_changes(
    df: DataFrame, tables: Sequence[str], ops: Sequence[str] = ("INSERT", "UPDATE"),
    table: str = "tableName", op: str = "optType",
) -> DataFrame:
    return df.where(F.col(table).isin(*tables) & F.col(op).isin(*ops))


def filter_account(df: DataFrame, col: str = "fAccountType") -> DataFrame:
    """Points (2) and level value (4) accounts."""
    return df.where(F.col(col).isin("2", "4"))


def filter_envelope(df: DataFrame, spec: str, type_col: str = "_cal_type_sel", platform_col: str = "cal_platformNum") -> DataFrame:
    """Rows of the type and platform named in ``topic#type#platform``."""
    parts = spec.split("#")
    if len(parts) < 2:
        return df
    return df.where((F.col(type_col) == parts[1]) & (F.col(platform_col) == parts[2]))


def all_present(cols: Sequence[str]) -> Column:
    """True where no listed column is NULL or ''."""
    return reduce(lambda a, b: a & b, [~blank(c) for c in cols], F.lit(True))


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Drop rows that miss a value the target requires."""
    return df.where(all_present(required_columns(schema)))


def retention_floor(as_of: Column, months: int = 2, late_day: int | None = None) -> Column:
    """First day of the retained window as ``yyyy-MM-dd`` text.

    With ``late_day`` a later day of the month keeps one month less.
    """
    as_of = as_of.cast("date")
    back = F.lit(-months)
    if late_day is not None:
        back = F.when(F.dayofmonth(as_of) > late_day, -(months - 1)).otherwise(back)
    return F.date_format(F.trunc(F.add_months(as_of, back), "MM"), "yyyy-MM-dd")


def filter_retention(df: DataFrame, col: str, as_of: Column | None = None, months: int = 2, late_day: int | None = None) -> DataFrame:
    """Drop rows before the floor and rows without a time; times compare as text."""
    floor = retention_floor(F.current_date() if as_of is None else as_of, months, late_day)
    return df.where((F.col(col) != "") & (F.col(col) >= floor))


def filter_parseable(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose time is no strict ``yyyy-MM-dd HH:mm:ss``."""
    return df.where(parsed(col).isNotNull())


def filter_tracker(df: DataFrame, day: str, logtype: str = "40000") -> DataFrame:
    """One day of one log type with a known user."""
    return df.where(
        (F.col("days") == day) & (F.col("logtype") == logtype)
        & ~blank("userid") & (F.col("userid") != "0")
    )


def split_valid(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that do not; NULL counts as not passing."""
    flag = F.coalesce(predicate, F.lit(False))
    return df.where(flag), df.where(~flag)


def parse_condition(text: str | None) -> tuple[str, str, str] | None:
    """``field_op_value`` with op ``=``, ``>`` or ``<``; None means always."""
    match = re.fullmatch(r"(.+?)_([=<>])_(.*)", text or "")
    return match.groups() if match else None
