"""Latest per key, ordered output, limits and pages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ranges import SAMPLE_PER_RANGE, before, constants, cut, sample_places

# Ranges that the rows of a table are counted in to find a page, and how many rows are sorted at last.
PAGE_RANGES, PAGE_ROWS = 256, 100_000

def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The last written row of every key.

    ``order`` must tell any two rows of a key apart. The limit on the rank is
    applied in every task before the shuffle, so a hot key sends one row per
    task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[_column(c).desc() for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns are among those of ``keys``.

    Repeated keys are reduced before the shuffle. The struct is built after
    that, so both sides of the join are plain shuffles and the runtime can
    split the rows of a hot key.
    """
    types = {c: df.schema[c].dataType for c in on}
    wanted = keys.select(*[F.col(c).cast(types[c]).alias(c) for c in on]).distinct()
    wanted = wanted.select(F.struct(*on).alias("_wanted")).where(all_known("_wanted", on))
    keyed = df.withColumn("_key", F.struct(*on))
    return keyed.join(wanted, F.col("_key") == F.col("_wanted"), "left_semi").drop("_key")


def all_known(struct: str, names: Sequence[str]) -> Column:
    """True where no field of a struct is NULL: NULL equals nothing."""
    return reduce(lambda a, b: a & b, [F.col(f"{struct}.{n}").isNotNull() for n in names])


def order_changes(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, so the whole is ordered.

    ``order`` should end in a unique column: equal values share a partition.
    """
    cols = [F.col(c) for c in order]
    spread = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return spread.sortWithinPartitions(*order)


def with_sequence(df: DataFrame, order: Sequence[str], name: str = "seq") -> DataFrame:
    """Number all rows 1..n in global order without a single-task sort.

    The sorted rows are checkpointed once, so that the counts per partition
    and the numbering see the same partitions. Only the counts, one per
    partition, meet in one place.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ordered = order_changes(df, order).checkpoint()
    placed = ordered.withColumn("_part", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n")).collect()
    starts, total = [], 0
    for part, n in sorted((r["_part"], r["_n"]) for r in counts):
        starts.append((part, total))
        total += n
    offsets = spark.createDataFrame(starts, "_part int, _start bigint")
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_start") + F.col("_pos") + 1).alias(name))


def limit_scan(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows by key."""
    return df.orderBy(key).limit(n)


def page(df: DataFrame, key: str, pattern: str, number: int, size: int, unique: Sequence[str] = ()) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows whose key matches a regex.

    ``unique`` are columns that, with the key, tell any two rows apart:
    without such an order rows with equal keys could be on two pages or none.

    The order is cut into ranges where a sample says, the rows of each range are counted, and the running total of the
    counts tells which ranges hold the page. These are cut again until
    they hold few rows; only they are sorted. No task holds what precedes the page, however deep it is.
    """
    if not unique:
        raise ValueError("name the columns that make the order unique, the key itself if it is")
    order = list(dict.fromkeys([key, *unique]))
    found, skip = _around(df.where(F.col(key).cast("string").rlike(pattern)), order, (number - 1) * size, size)
    return found.orderBy(*order).offset(skip).limit(size)


def _around(rows: DataFrame, order: Sequence[str], skip: int, size: int) -> tuple[DataFrame, int]:
    """The ranges that hold ``size`` rows after the first ``skip``, and how many of their rows come before these."""
    found = rows
    # More rows than that are not sorted to find a page; a page itself may be larger.
    most = max(2 * size, PAGE_ROWS)
    while len(sample := sample_places(found, order, PAGE_RANGES)) == PAGE_RANGES * SAMPLE_PER_RANGE:
        cuts = list(dict.fromkeys(cut(sample)))
        inside, counts = _count_ranges(found, order, cuts)
        first, skip = _range_of(counts, skip)
        if first is None:
            return rows.limit(0), 0
        last, _ = _range_of(counts[first:], skip + size - 1)
        last = len(counts) - 1 if last is None else first + last
        held = sum(counts[first : last + 1])
        narrower = inside.where(F.col("_range").between(first, last))
        # Bounds on the key alone reach the scan.
        lo, hi = (cuts[first - 1][0] if first else None), (cuts[last][0] if last < len(cuts) else None)
        bounds = [F.col(order[0]) >= lo] * (lo is not None) + [F.col(order[0]) <= hi] * (hi is not None)
        found = reduce(DataFrame.where, bounds, narrower).select(*rows.columns)
        if held <= most or held == sum(counts):
            break
    return found, skip


def _count_ranges(df: DataFrame, order: Sequence[str], cuts: list[tuple]) -> tuple[DataFrame, list[int]]:
    """The rows with the number of their range (``_range``), and how many each range has."""
    at = constants(df, order, cuts)
    place = F.struct(*order)
    inside = df.withColumn("_range", before(at, len(cuts), lambda c: c <= place))
    counted = dict(inside.groupBy("_range").count().collect())
    return inside, [counted.get(i, 0) for i in range(len(cuts) + 1)]


def _range_of(counts: list[int], skip: int) -> tuple[int | None, int]:
    """The range that holds the row after ``skip`` rows, and how many of these are in it; None beyond the last row."""
    for i, n in enumerate(counts):
        if skip < n:
            return i, skip
        skip -= n
    return None, skip
