"""Lookups in dimension tables.

Each lookup is a left join on a dimension reduced to one row per key. No
broadcast is forced: a dimension under the broadcast threshold is broadcast,
a larger one is joined by shuffle. The join key is a struct built after the
reduction, so both sides of that join are plain shuffles: only then can the
runtime split the partition of a code that many rows share, or of the rows
without a code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import _col
from ..functions.text import blank, region_codes


def one_per_key(dim: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key; of several the smallest values in order, so reruns agree."""
    first = F.min(F.struct(*values)).alias("_v")
    return dim.groupBy(*keys).agg(first).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def lookup(df: DataFrame, dim: DataFrame, on: dict[str, object], out: dict[str, str]) -> DataFrame:
    """Left join ``dim`` on ``{dim key: df column}``, adding ``{new column: dim value}``."""
    reduced = one_per_key(dim, list(on), list(out.values()))
    keyed = reduced.select(
        F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(on)]).alias("_key"),
        *[F.col(v).alias(n) for n, v in out.items()],
    )
    codes = [_col(c).cast("string") for c in on.values()]
    wanted = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(codes)])
    # An empty code is never looked up.
    known = reduce(lambda a, b: a & b, [~blank(c) for c in codes])
    return df.withColumn("_code", F.when(known, wanted)).join(keyed, F.col("_code") == F.col("_key"), "left").drop("_code", "_key")


def enrich_region(df: DataFrame, dim: DataFrame, col: str = "fregion") -> DataFrame:
    """Province, city and district names of a ``p_c_d`` code."""
    province, city, district = region_codes(col)
    on = {"fprovincesysno": province, "fcitysysno": city, "fdistrictsysno": district}
    names = ["fprovincename", "fcityname", "fdistrictname"]
    return lookup(df, dim, on, {n: n for n in names})


def enrich_name(df: DataFrame, dim: DataFrame, codes: dict[str, str], tenant: str = "k_ftenancy_id") -> DataFrame:
    """Names of several code columns from one (tenant, code) dimension; ``codes`` maps code to output."""
    for code, out in codes.items():
        df = lookup(df, dim, {"k_ftenancy_id": tenant, "code": code}, {out: "name"})
    return df


def enrich_store(df: DataFrame, dim: DataFrame, code: str, out: str, tenant: str = "k_ftenancy_id") -> DataFrame:
    return lookup(df, dim, {"k_ftenancy_id": tenant, "storecode": code}, {out: "storename"})


def enrich_source(df: DataFrame, dim: DataFrame, source: str, out: str, tenant: str = "k_ftenancy_id") -> DataFrame:
    on = {"k_ftenancy_id": tenant, "fmembersource": source}
    return lookup(df, dim, on, {out: "fmembersource_name"})
