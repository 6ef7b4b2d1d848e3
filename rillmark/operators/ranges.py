"""Ranges of an order, cut where a sample of the rows says."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 16


def sample_places(df: DataFrame, order: Sequence[str], ranges: int) -> list[tuple]:
    """Places of ``SAMPLE_PER_RANGE`` times ``ranges`` rows, or of all if there are no more, in order.

    Rows are drawn, not values: what a third of all rows hold is a third of the sample.
    """
    drawn = df.select(*order).orderBy(F.rand(1)).limit(ranges * SAMPLE_PER_RANGE)
    return [tuple(r) for r in drawn.orderBy(*order).collect()]


def cut(sample: list[tuple]) -> list[tuple]:
    """Every ``SAMPLE_PER_RANGE``-th place, but for the first."""
    return sample[SAMPLE_PER_RANGE::SAMPLE_PER_RANGE]


def constants(df: DataFrame, order: Sequence[str], cuts: list[tuple]) -> Column:
    """The cuts as one constant array of structs of the type of ``struct(order)``."""
    types = [df.schema[c].dataType for c in order]
    return F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for c, v, t in zip(order, place, types)]) for place in cuts])


def before(cuts: Column, n: int, holds: Callable[[Column], Column]) -> Column:
    """How many of ``n`` sorted cuts a condition holds for; where it holds for a cut, it does for all smaller ones.

    A binary search: few comparisons a row, whatever ``n`` is.
    """
    if not n:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(n.bit_length()))]
    # Beyond the last cut there is none, and no condition holds.
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: at + F.when(F.coalesce((at + step <= n) & holds(F.get(cuts, at + step - 1)), F.lit(False)), step).otherwise(0),
    )
