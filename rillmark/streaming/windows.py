"""Event time and tumbling windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import _col


def with_event_time(df: DataFrame, time: str | Column = "opttime", delay: str = "0 seconds", name: str = "event_time") -> DataFrame:
    """Event time from epoch milliseconds, with a watermark.

    A row is late only once the watermark of an earlier batch has passed it.
    """
    ms = _col(time).try_cast("bigint")
    return df.withColumn(name, F.timestamp_millis(ms)).withWatermark(name, delay)


def tumble(df: DataFrame, width: str, record_id: Sequence[str], time: str = "event_time") -> DataFrame:
    """Records tagged with their tumbling window, given out once it closes.

    Every record is a group of its own, found by ``record_id``: a window's
    records stay spread over the tasks however many it holds. A record that
    comes twice in its window is given once. On a batch frame all windows
    are given.
    """
    rest = [c for c in df.columns if c not in record_id]
    grouped = df.groupBy(F.window(time, width).alias("_w"), *record_id)
    rows = grouped.agg(F.first(F.struct(*rest)).alias("_r"))
    return rows.select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"),
        *record_id, *[F.col(f"_r.`{c}`").alias(c) for c in rest],
    )


def window_function(
    df: DataFrame, width: str, time: str, inputs: Sequence[str],
    partial: Callable, partial_schema: str, merge: Sequence[Column],
) -> DataFrame:
    """User function over the elements of each window, in two steps.

    ``partial`` gets a pandas frame with some elements of one window (the
    ``inputs`` columns) and returns a frame of ``partial_schema``; ``merge``
    are aggregates over those. No task ever holds a whole window.
    """
    start = F.window(time, width).getField("start").alias("window_start")
    tagged = df.select(start, *inputs)

    def pieces(frames):
        for frame in frames:
            for value, elements in frame.groupby("window_start", sort=False):
                out = partial(elements[list(inputs)])
                out.insert(0, "window_start", value)
                yield out

    parts = tagged.mapInPandas(pieces, f"window_start timestamp, {partial_schema}")
    return parts.groupBy("window_start").agg(*merge)


def whole_window_function(
    df: DataFrame, width: str, time: str, keys: Sequence[str], record_id: Sequence[str], inputs: Sequence[str],
    function: Callable, schema: str,
) -> DataFrame:
    """User function over all elements of a window and key at once, on a stream; for what cannot be merged from parts.

    ``function`` gets a pandas frame of the ``record_id``, ``inputs`` and ``time`` columns, in order of arrival, and
    returns a frame of ``schema``. It is called once, when the watermark reaches the end of the window. A record that comes after that is
    dropped, one that comes twice in its window counts once, and one that is late in an open window counts.

    State holds the records of open windows, so the width of a window and the delay of the
    watermark bound it; what has been given out is removed. A window's records of one key are in one task:
    choose keys so that this fits, or ``window_function`` where parts can be merged.
    Whole numbers come as pandas' nullable integers, so large ones stay exact beside a NULL.
    """
    # The close of its window is the event time of a record from here on: only that decides what is late.
    names = list(dict.fromkeys([*record_id, *inputs, time]))
    close = F.window_time(F.col("_w")).alias("_close")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    whole = [n for n in {*names, *keys} if isinstance(kinds[n], T.IntegralType)]
    # Whole numbers travel as text: pandas would make floats of those beside a NULL.
    plain = [F.timestamp_micros(F.unix_micros(n)).alias(n) if n == time else F.col(n).cast("string").alias(n) if n in whole else F.col(n) for n in dict.fromkeys([*keys, *names])]
    rows = df.select(F.window(time, width).alias("_w"), *plain).select(close, F.col("_w.start").alias("_start"), *dict.fromkeys([*keys, *names]))
    sent = {f.name: f.dataType for f in rows.schema.fields}
    state_type = T.StructType([T.StructField(n, T.ArrayType(T.LongType() if isinstance(sent[n], T.TimestampType) else sent[n])) for n in names])
    out_type = T.StructType([T.StructField("window_start", T.TimestampType()), *[T.StructField(k, sent[k]) for k in keys], *T.StructType.fromDDL(schema).fields])
    times = [n for n in names if isinstance(sent[n], T.TimestampType)]
    numbers = [n for n in names if n in whole]

    def frame(columns):
        import pandas as pd

        out = pd.DataFrame(dict(zip(names, columns)))
        for n in times:
            out[n] = pd.to_datetime(out[n], unit="us")
        for n in numbers:
            out[n] = pd.array([None if x is None else int(x) for x in out[n]], "Int64")
        return out

    def each(key, frames, state):
        import pandas as pd

        if state.hasTimedOut:
            elements = frame(state.get)
            state.remove()
            out = function(elements)
            for i, value in enumerate(key[1:]):
                out.insert(i, ["window_start", *keys][i], value)
            yield out
            return
        columns = [list(c) for c in state.get] if state.exists else [[] for _ in names]
        known = set(zip(*(columns[names.index(n)] for n in record_id)))
        for part in frames:
            part = part[names].copy()
            for n in times:
                part[n] = part[n].astype("datetime64[us]").astype("int64")
            for row in part.astype(object).where(part.notna(), None).itertuples(index=False):
                place = tuple(row[names.index(n)] for n in record_id)
                if place not in known:
                    known.add(place)
                    for column, value in zip(columns, row):
                        column.append(value)
        state.update(tuple(columns))
        # The close is a microsecond before the end; a window is given when the watermark reaches its end.
        state.setTimeoutTimestamp(int(pd.Timestamp(key[0]).timestamp() * 1000))

    found = rows.groupBy("_close", "_start", *keys).applyInPandasWithState(each, out_type, state_type, "append", "EventTimeTimeout")
    return found.select("window_start", *[F.col(k).cast(kinds[k]).alias(k) for k in keys], *T.StructType.fromDDL(schema).names)
