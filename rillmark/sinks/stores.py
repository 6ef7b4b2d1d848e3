"""Other targets: warehouse tables, wide stores, key-value cache, dry run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import blank, row_key
from ..operators.keyed import to_cells
from ..operators.ordering import latest

DAY_SECONDS = 24 * 60 * 60
KV_SCHEMA = "kv_table string, tenant string, key string, value string, expires_at timestamp"


def archive(df: DataFrame, table: str, path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a warehouse table with a keyed table's rows."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def wide_rows(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Row key and all columns as text."""
    return df.select(row_key(key_cols).alias("rowkey"), *[F.col(c).cast("string").alias(c) for c in df.columns])


def bulk_load(df: DataFrame, path: str, key_cols: Sequence[str], order: Sequence[str], rows_per_partition: int = 50_000) -> None:
    """Load a warehouse table into a keyed wide store, sorted by row key.

    Of rows with the same key the last by ``order`` is kept. The store is
    ranges of keys, so reads by key prefix or range skip files. No file has
    more than ``rows_per_partition`` rows; the number of tasks is the
    shuffle's, joined where they are small.
    """
    last = latest(df, list(key_cols), list(order)).select(*df.columns)
    wide = wide_rows(last, key_cols).repartitionByRange("rowkey").sortWithinPartitions("rowkey")
    wide.write.mode("overwrite").option("maxRecordsPerFile", rows_per_partition).parquet(path)


def write_cells(df: DataFrame, path: str, key: str, ts: Column, family: str = "info", mode: str = "append") -> None:
    """Write rows as cells."""
    to_cells(df, key, ts, family).write.mode(mode).parquet(path)


def kv_rows(df: DataFrame, table: str, key: str, value: str, tenant: str, now: Column | None = None, ttl: int = 30 * DAY_SECONDS, carry: Sequence[str] = ()) -> DataFrame:
    """Cache entries of a dimension batch, with the columns in ``carry``; rows with an empty key are skipped."""
    now = F.current_timestamp() if now is None else now
    return df.where(~blank(key)).select(
        F.lit(table).alias("kv_table"),
        F.col(tenant).cast("string").alias("tenant"),
        F.col(key).cast("string").alias("key"),
        F.col(value).cast("string").alias("value"),
        (now + F.make_dt_interval(secs=F.lit(ttl))).alias("expires_at"),
        *carry,
    )


def live_entries(cache: DataFrame, now: Column | None = None) -> DataFrame:
    """Cache entries that have not expired."""
    return cache.where(F.col("expires_at") > (F.current_timestamp() if now is None else now))


def dry_run(df: DataFrame) -> None:
    """Run everything but the write."""
    df.write.format("noop").mode("overwrite").save()


def reset_tables(spark: SparkSession, tables: dict[str, T.StructType | str], path: str, drop: bool = False, partition_by: dict[str, Sequence[str]] | None = None) -> None:
    """Optionally drop, then create catalog tables that are not there."""
    for name, schema in tables.items():
        if drop:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        if not spark.catalog.tableExists(name):
            empty = spark.createDataFrame([], schema)
            archive(empty, name, f"{path}/{name}", (partition_by or {}).get(name, ()))
