"""Text, code and bit expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .calendar import _col, epoch_seconds_to_time


def clean_text(c: Column | str) -> Column:
    """Remove tabs and line breaks."""
    return F.translate(_col(c), "\r\n\t", "")


def blank(c: Column | str) -> Column:
    """True where the value is NULL or ''."""
    return F.coalesce(_col(c).cast("string"), F.lit("")) == ""


def default_if_empty(c: Column | str, default: str) -> Column:
    """Replace '' (not NULL) by a default."""
    c = _col(c)
    return F.when(c == "", F.lit(default)).otherwise(c)


def decode_label(c: Column | str, labels: dict, default: str | None = None) -> Column:
    """Code to label; unknown codes give ``default``, codes that are no number give NULL."""
    code = _col(c).try_cast("int")
    chain = None
    for key, label in labels.items():
        chain = F.when(code == key, label) if chain is None else chain.when(code == key, label)
    return chain.when(code.isNotNull(), F.lit(default))


def region_codes(c: Column | str) -> list[Column]:
    """``p_c_d`` to its three codes; NULL where a part is missing."""
    parts = F.split(_col(c), "_")
    return [F.get(parts, F.lit(i)) for i in range(3)]


def row_key(cols: Sequence[Column | str]) -> Column:
    """Key columns joined with ``_``; NULL is written as ``null``."""
    return F.concat_ws("_", *[F.coalesce(_col(c).cast("string"), F.lit("null")) for c in cols])


def hash_bucket(cols: Sequence[Column | str], n: int = 10) -> Column:
    """Bucket 0 to n-1 by the hash of some columns."""
    return F.pmod(F.xxhash64(*[_col(c) for c in cols]), F.lit(n)).cast("int")


def keyed_list_lookup(
    pairs: Column | str, key: Column | str, fallback: Column | str, tz: str = "UTC", bad: str | None = None
) -> Column:
    """Time stored under ``key`` in a ``k:epoch;k:epoch`` list.

    The first pair with the key counts. An empty list gives ``fallback``, no
    such key gives NULL, an epoch that is no number gives ``bad``.
    """
    pairs, key = _col(pairs), _col(key)
    hit = F.get(F.filter(F.split(pairs, ";"), lambda p: F.substring_index(p, ":", 1) == key), F.lit(0))
    epoch = F.get(F.split(hit, ":"), F.lit(1))
    time = F.coalesce(epoch_seconds_to_time(epoch.try_cast("bigint"), tz), F.lit(bad))
    return F.when(blank(pairs), _col(fallback)).when(epoch.isNotNull(), time)


def _bits(c: Column | str) -> Column:
    number = F.when(blank(c), F.lit(0).cast("bigint")).otherwise(_col(c).try_cast("bigint"))
    return F.bin(number)


def bit_string(c: Column | str, bad: str | None = "") -> Column:
    """Binary digits of a long; empty counts as 0, no number gives ``bad``."""
    return F.coalesce(_bits(c), F.lit(bad))


def bit_flag(c: Column | str, n: int = 5, absent: str | None = "") -> Column:
    """The n-th binary digit from the right, ``absent`` when there are fewer."""
    bits = _bits(c)
    digit = F.when(F.length(bits) >= n, F.substring(bits, -n, 1))
    return F.coalesce(digit, F.lit(absent))


def latest_operation(ops: Sequence[tuple[int, Column | str]]) -> tuple[Column, Column]:
    """Code and time of the latest of several operations.

    ``ops`` lists (code, time); an empty time means never, on a tie the
    earlier listed operation wins.
    """
    times = [F.coalesce(_col(t), F.lit("")) for _, t in ops]
    newest = F.greatest(*times)
    code = F.when(times[0] == newest, ops[0][0])
    for (value, _), time in list(zip(ops, times))[1:]:
        code = code.when(time == newest, value)
    return code, newest
