"""Reads by row key, and the cell layout of a wide row.

Cells are rows of (rowkey, family, column, value, ts), values as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import matching
from .ranges import before, constants, cut, sample_places

CELL_COLUMNS = ["rowkey", "family", "column", "value", "ts"]


def get_rows(df: DataFrame, keys: DataFrame, key: str = "rowkey") -> DataFrame:
    """Rows of many keys at once; ``keys`` has the same key column."""
    return matching(df, keys, [key])


def get_column(cells: DataFrame, key, column: str) -> DataFrame:
    """One column of one row with its timestamp."""
    return cells.where((F.col("rowkey") == key) & (F.col("column") == column))


def get_families(cells: DataFrame, families: Sequence[str], long_columns: Sequence[str] = ()) -> DataFrame:
    """Cells of some families; ``long_columns`` are also read as numbers."""
    number = F.when(F.col("column").isin(*long_columns), F.col("value").try_cast("bigint")) if long_columns else F.lit(None).cast("bigint")
    return cells.where(F.col("family").isin(*families)).withColumn("long_value", number)


def key_prefix(df: DataFrame, prefix: str, key: str = "rowkey") -> DataFrame:
    return df.where(F.col(key).startswith(prefix))


def key_prefix_any(df: DataFrame, prefixes: DataFrame, key: str = "rowkey", prefix: str = "prefix", ranges: int | None = None) -> DataFrame:
    """Rows whose key starts with any of many prefixes.

    A prefix that starts with another one is left out; what remains are intervals of keys that do not
    overlap. Rows and intervals are dealt into the same ranges of keys, cut where a sample of the
    rows says, and each range is merged in key order: the last interval that begins at or before a key is the only one it can be in.
    One shuffle of the rows, whatever lengths there are. A key of very many rows takes up several cuts, and
    its rows are spread over the ranges between them. ``ranges`` is the number of ranges, by default twice that of shuffle partitions.
    """
    ranges = ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = prefixes.select(F.col(prefix).cast("string").alias("_prefix")).where(F.length("_prefix") > 0).distinct()
    starts = wanted.select("_prefix", F.explode(F.sequence(F.lit(1), F.length("_prefix"))).alias("_n")).where(F.col("_n") < F.length("_prefix"))
    shorter = wanted.select(F.col("_prefix").alias("_shorter"))
    longer = starts.join(shorter, F.substring("_prefix", F.lit(1), F.col("_n")) == F.col("_shorter"), "left_semi").select("_prefix").distinct()
    wanted = wanted.join(longer, "_prefix", "left_anti")

    rows = df.where(F.col(key).isNotNull())
    cuts = cut(sample_places(rows, [key], ranges))
    at, n = constants(rows, [key], cuts), len(cuts)
    low = before(at, n, lambda c: c[key] < F.col(key))
    equal = before(at, n, lambda c: c[key] <= F.col(key)) - low
    # Any of the ranges that end at a cut equal to the key will do, and the one that begins at the last.
    spread = low + F.pmod(F.xxhash64(*df.columns), equal + 1).cast("int")
    first = before(at, n, lambda c: c[key] < F.col("_prefix"))
    last = before(at, n, lambda c: F.substring(c[key], F.lit(1), F.length("_prefix")) <= F.col("_prefix"))
    intervals = wanted.select(F.explode(F.sequence(first, last)).alias("_range"), F.col("_prefix").alias("_at"), "_prefix")
    both = rows.select(spread.alias("_range"), F.col(key).alias("_at"), F.struct(*df.columns).alias("_row")).unionByName(intervals, allowMissingColumns=True)
    # An interval comes before the rows that begin where it does.
    order = Window.partitionBy("_range").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = both.withColumn("_last", F.last("_prefix", ignorenulls=True).over(order))
    return merged.where(F.col("_row").isNotNull() & F.col("_at").startswith(F.col("_last"))).select("_row.*")


def key_regex(df: DataFrame, pattern: str, key: str = "rowkey") -> DataFrame:
    """Rows whose key contains a match."""
    return df.where(F.col(key).rlike(pattern))


def key_range(df: DataFrame, start: str, stop: str, key: str = "rowkey") -> DataFrame:
    """Rows with ``start <= key < stop``."""
    return df.where((F.col(key) >= start) & (F.col(key) < stop))


def key_list(df: DataFrame, key: str = "rowkey") -> DataFrame:
    return df.select(key)


def to_cells(df: DataFrame, key: str, ts: Column, family: str = "info") -> DataFrame:
    """One cell per non-NULL column of every row."""
    values = [c for c in df.columns if c != key]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in values])
    rows = df.select(F.col(key).alias("rowkey"), ts.alias("ts"), F.explode(cells).alias("_c"))
    return rows.where(F.col("_c.value").isNotNull()).select(
        "rowkey", F.lit(family).alias("family"), "_c.column", "_c.value", "ts"
    )


def from_cells(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Latest value of each listed column, one row per key."""
    def newest(column: str) -> Column:
        mine = F.col("column") == column
        return F.max_by(F.when(mine, F.col("value")), F.when(mine, F.col("ts"))).alias(column)

    wanted = cells.where(F.col("column").isin(*columns))
    return wanted.groupBy("rowkey").agg(*[newest(c) for c in columns])


# Deleting cells: a mark hides what is not newer than it in its scope.

TABLE_FAMILY, ROW, FAMILY, COLUMN = "table family", "row", "family", "column"
SCOPES = {TABLE_FAMILY: ["family"], ROW: ["rowkey"], FAMILY: ["rowkey", "family"], COLUMN: ["rowkey", "family", "column"]}


def deletion(df: DataFrame, scope: str, ts: str | Column) -> DataFrame:
    """Marks for cells to be deleted, to be stored with the cells.

    ``df`` has the columns that name the scope: the row, the row and family, those and the column, or a family of the whole table.
    Cells with a time up to ``ts`` are deleted, and later ones are not, whichever is stored first.
    """
    named = SCOPES[scope]
    columns = [(F.col(c) if c in named else F.lit(None)).cast("string").alias(c) for c in ("rowkey", "family", "column")]
    return df.select(*columns, F.lit(None).cast("string").alias("value"), _at(ts).alias("ts"), F.lit(scope).alias("deleted")).distinct()


def _at(ts: str | Column) -> Column:
    return (F.col(ts) if isinstance(ts, str) else ts).cast("bigint")


def live_cells(cells: DataFrame, versions: int = 1) -> DataFrame:
    """The newest ``versions`` of every cell that no mark hides.

    Marks are reduced to the newest of each scope before they meet the cells. The keys are structs
    built right before the joins, so the runtime can split a row of very many cells.
    """
    found = cells.where("deleted is null").drop("deleted")
    for scope, named in SCOPES.items():
        marks = cells.where(F.col("deleted") == scope).groupBy(*named).agg(F.max("ts").alias("_gone"))
        marks = marks.select(F.struct(*named).alias("_scope"), "_gone")
        found = found.withColumn("_scope", F.struct(*named)).join(marks, "_scope", "left")
        found = found.where(F.col("_gone").isNull() | (F.col("ts") > F.col("_gone"))).select(*CELL_COLUMNS)
    newest = Window.partitionBy("rowkey", "family", "column").orderBy(F.col("ts").desc(), F.col("value").desc())
    return found.withColumn("_n", F.row_number().over(newest)).where(F.col("_n") <= versions).drop("_n")
