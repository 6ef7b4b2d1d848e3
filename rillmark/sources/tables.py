"""Table scans: warehouse, keyed, polled and JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, name: str, where: str | Column | None = None) -> DataFrame:
    """A catalog table with a partition predicate."""
    df = spark.table(name)
    return df if where is None else df.where(where)


def scan_keyed(df: DataFrame, eq: dict, cols: Sequence[str]) -> DataFrame:
    """Projected columns of the rows that match typed equality predicates.

    Values are cast to the column's type on the driver side of the plan, so
    the scan receives plain ``column = literal`` filters.
    """
    for name, value in eq.items():
        df = df.where(F.col(name) == F.lit(value).cast(df.schema[name].dataType))
    return df.select(*cols)


def poll_snapshot(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """First ``n`` rows by key: what one tick of a polled snapshot emits."""
    return df.orderBy(key).limit(n).withColumn("rowkey", F.col(key).cast("string"))


def poll_every(spark: SparkSession, read, sink, key: str, n: int = 1000, every: str = "10 seconds"):
    """Re-read a table on every tick and hand the snapshot to ``sink(df, tick)``.

    ``read()`` returns the current table. Returns the running query.
    """
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def tick(_, batch_id):
        sink(poll_snapshot(read(), key, n), batch_id)

    return ticks.writeStream.foreachBatch(tick).trigger(processingTime=every).start()


def read_jdbc(
    spark: SparkSession, url: str, query: str, properties: dict | None = None,
    partition: dict | None = None,
) -> DataFrame:
    """A query over JDBC, every column as text.

    ``partition`` (column, lower, upper, n) splits the read over executors;
    without it one task reads the whole result.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**(properties or {}))
    if partition:
        reader = (
            reader.option("dbtable", f"({query}) q")
            .option("partitionColumn", partition["column"])
            .option("lowerBound", str(partition["lower"]))
            .option("upperBound", str(partition["upper"]))
            .option("numPartitions", str(partition["n"]))
        )
    else:
        reader = reader.option("query", query)
    df = reader.load()
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
