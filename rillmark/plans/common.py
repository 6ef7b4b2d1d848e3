"""Shared parts of the entity mappings.

A mapping takes a frame whose columns are named like the source fields (case
does not matter) and returns the target columns. A field the frame lacks is
NULL. NULL in a mapped row means the column is absent: a partial upsert
leaves the stored value alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text


def source_columns(df: DataFrame) -> Callable[[str], Column]:
    """Lookup of a source field by name, as text."""
    have = {name.lower(): name for name in df.columns}

    def get(name: str) -> Column:
        found = have.get(name.lower())
        return F.lit(None).cast("string") if found is None else F.col(f"`{found}`").cast("string")

    return get


def cleaned(get: Callable[[str], Column], names: Sequence[str]) -> list[Column]:
    """Cleaned copies of fields under their lower-case names."""
    return [clean_text(get(n)).alias(n.lower()) for n in names]


def plain(get: Callable[[str], Column], names: Sequence[str]) -> list[Column]:
    return [get(n).alias(n.lower()) for n in names]


def etl_date(as_of: str | Column | None = None) -> Column:
    """Load time ``yyyy-MM-dd HH:mm:ss``."""
    if as_of is None:
        return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return F.lit(as_of) if isinstance(as_of, str) else as_of


def with_etl_date(df: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    return df.withColumn("etl_date", etl_date(as_of))


def carried(df: DataFrame) -> list[Column]:
    """The place of a record in its topic, which jobs carry through a mapping."""
    return [F.col("_place")] if "_place" in df.columns else []
