"""JDBC targets: upsert through a staging table, and batched inserts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRESENT = "_present"


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str], present: bool = False) -> str:
    """One server-side statement that moves staged rows into the table.

    NULL means the column is absent, so the stored value stays; with
    ``present`` the staged rows name columns whose NULL is written.
    """
    names = ", ".join(columns)
    rest = [c for c in columns if c not in keys]

    def value(c):
        kept = f"COALESCE(VALUES({c}), {table}.{c})"
        return f"CASE WHEN FIND_IN_SET('{c}', {staging}.{PRESENT}) > 0 THEN VALUES({c}) ELSE {kept} END" if present else kept

    sets = ", ".join(f"{c} = {value(c)}" for c in rest or keys[:1])
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON DUPLICATE KEY UPDATE {sets}"


def write_options(url: str, table: str, properties: dict | None = None, batch_size: int = 10_000, partitions: int | None = None) -> dict:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size), **(properties or {})}
    if partitions:
        options["numPartitions"] = str(partitions)
    return options


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None, batch_size: int = 10_000, partitions: int | None = None) -> None:
    """Batched inserts, one transaction per partition."""
    options = write_options(url, table, properties, batch_size, partitions)
    df.write.format("jdbc").mode("append").options(**options).save()


def jdbc_upsert(df: DataFrame, url: str, table: str, keys: Sequence[str], properties: dict | None = None, partitions: int | None = None) -> None:
    """Upsert the present columns of a batch: stage in parallel, then one statement.

    ``df`` has one row per key; an array column ``_present`` names columns
    written even when NULL. A failure leaves the table as it was and the batch
    is run again. Every run stages in a table of its own, dropped at the end.
    """
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    present = PRESENT in df.columns
    columns = [c for c in df.columns if c != PRESENT]
    staged = df.withColumn(PRESENT, F.concat_ws(",", PRESENT)) if present else df
    jvm = df.sparkSession._jvm
    props = jvm.java.util.Properties()
    for name, value in (properties or {}).items():
        props.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        options = write_options(url, staging, properties, partitions=partitions)
        staged.write.format("jdbc").mode("overwrite").options(**options).save()
        statement = connection.createStatement()
        statement.executeUpdate(upsert_statement(table, staging, columns, keys, present))
        statement.executeUpdate(f"DROP TABLE {staging}")
    finally:
        connection.close()
