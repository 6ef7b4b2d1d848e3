"""Change messages to records.

A message is JSON text. Parsing stays in built-in expressions, so the same
functions serve batch and streaming frames. A message that does not parse
gives no rows; the ``undecodable`` functions return those messages instead.
Numbers are kept as they are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAP = "map<string,string>"
# A character of private use before each number while it is a string.
MARK = "\ue000"
# From the end of the last match: no number and whole strings, then a number.
NUMBER = r'\G([^"0-9-]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"0-9-]*+)*+)(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)'


def _others(df: DataFrame, value: str) -> list[str]:
    return [c for c in df.columns if c != value]


def number_text(value: Column) -> Column:
    """JSON text with its numbers as marked strings, which parsing keeps as they are written: ``1.50``, ``10000000.0``."""
    return F.regexp_replace(value, F.lit(NUMBER), F.lit(f'$1"{MARK}$2"'))


def _number(value: Column) -> Column:
    """A parsed text without marks; numbers in a nested value, which is JSON text, are numbers again."""
    return F.when(F.contains(value, F.lit(MARK)), F.regexp_replace(value, f'"?{MARK}([-+.0-9eE]+)"?', "$1")).otherwise(value)


def _numbers(record: Column) -> Column:
    return F.transform_values(record, lambda _, v: _number(v))


def _elements(value: Column) -> Column:
    # Elements that are objects come out as text again, and would lose their numbers' text on the way.
    return F.from_json(F.when(value.rlike(r"^\s*\[\s*\{"), number_text(value)).otherwise(value), "array<string>")


def _lowered(text: Column, lower: str | None) -> Column:
    return F.lower(text) if lower == "all" else text


def _texts(value: str, lower: str | None) -> Column:
    """The elements of a message as JSON text, numbers marked."""
    return F.transform(_elements(F.col(value)), lambda e: number_text(_lowered(F.replace(e, F.lit("\n\t"), F.lit("")), lower)))


def _parse(text: Column, lower: str | None) -> Column:
    record = F.from_json(text, MAP)
    if lower == "keys":
        record = F.transform_keys(record, lambda k, _: F.lower(k))
    return record


def _records(value: str, lower: str | None = None, fields: Sequence[str] | None = None) -> Column:
    """All elements of a message parsed; NULL for what does not parse. Structs are without marks, maps still hold them."""
    texts = _texts(value, lower)
    if fields is None:
        return F.transform(texts, lambda t: _parse(t, lower))
    schema = ", ".join(f"`{f}` string" for f in fields)

    def unmarked(p):
        restored = F.struct(*[_number(p["record"][f]).alias(f) for f in fields])
        return F.when(p["marked"] & p["record"].isNotNull(), restored).otherwise(p["record"])

    # Each text is made once, and only records with numbers have theirs restored. Done here, not on the columns of the
    # exploded rows: the code of a stage with a replacement for every field is too long for the JVM to compile.
    parsed = F.transform(texts, lambda t: F.struct(F.contains(t, F.lit(MARK)).alias("marked"), F.from_json(t, schema).alias("record")))
    return F.transform(parsed, unmarked)


def decode_changes(
    df: DataFrame, value: str = "value", lower: str | None = None, fields: Sequence[str] | None = None
) -> DataFrame:
    """JSON array to one row per element, the other columns are carried.

    An element may be an object or a string holding one. ``lower="all"``
    lowers the whole text, ``lower="keys"`` only the keys. With ``fields``
    only those are parsed and ``record`` is a struct, else it is a map.
    One element that is no object drops its whole message. ``position`` is
    the place within the message.
    """
    keep = _others(df, value)
    # One nested expression, exploded directly: a filter on a named column
    # would be moved below its definition and parse every message again.
    whole = F.filter(F.array(_records(value, lower, fields)), lambda rs: ~F.exists(rs, lambda r: r.isNull()))
    rows = df.select(*keep, F.posexplode(F.flatten(whole)).alias("position", "record"))
    record = _numbers(F.col("record")) if fields is None else F.col("record")
    return rows.select(*keep, "position", record.alias("record"))


def undecodable(df: DataFrame, value: str = "value") -> DataFrame:
    """The messages ``decode_changes`` drops."""
    return df.where(F.coalesce(F.exists(_records(value), lambda r: r.isNull()), F.lit(True)))


def _one_or_many(value: Column, struct: str) -> Column:
    """A JSON array of ``struct``, or a single object as an array of one."""
    value = number_text(value)
    many = F.from_json(value, f"array<{struct}>")
    return F.coalesce(many, F.array(F.from_json(value, struct)))


def _faulty(envelopes: Column, good) -> Column:
    """True where there is no envelope, or one that is not as it should be."""
    return F.coalesce(F.size(envelopes) == 0, F.lit(True)) | F.coalesce(F.exists(envelopes, lambda e: ~good(e)), F.lit(True))


def undecodable_content(df: DataFrame, platform_key: str, value: str = "value") -> DataFrame:
    """Messages of which ``decode_content`` loses all or some envelopes."""
    envelopes = _one_or_many(F.col(value), f"struct<`{platform_key}`: string, content: {MAP}>")
    return df.where(_faulty(envelopes, lambda e: e.isNotNull() & e["content"].isNotNull()))


def undecodable_batches(df: DataFrame, value: str = "value") -> DataFrame:
    """Messages of which ``decode_batches`` loses all or some rows."""
    envelopes = _one_or_many(F.col(value), f"struct<content: struct<type: string, platformNum: string, data: array<{MAP}>>>")

    def good(e):
        data = e["content"]["data"]
        return e.isNotNull() & data.isNotNull() & ~F.exists(data, lambda r: r.isNull())

    return df.where(_faulty(envelopes, good))


def _put(record: Column, key: str, value: Column) -> Column:
    """Set one key of a map, replacing what it held."""
    rest = F.map_filter(record, lambda k, _: k != key)
    return F.map_concat(rest, F.create_map(F.lit(key), value))


def decode_content(df: DataFrame, platform_key: str, value: str = "value") -> DataFrame:
    """``{<platform>, content}`` envelopes to content records holding the platform."""
    keep = _others(df, value)
    struct = f"struct<`{platform_key}`: string, content: {MAP}>"
    rows = df.select(*keep, F.posexplode(_one_or_many(F.col(value), struct)).alias("position", "_e"))
    record = _put(_numbers(F.col("_e.content")), platform_key, _number(F.col(f"_e.`{platform_key}`")))
    return rows.where(F.col("_e.content").isNotNull()).select(*keep, "position", record.alias("record"))


def decode_batches(
    df: DataFrame,
    value: str = "value",
    platform_field: str = "cal_platformNum",
    type_field: str = "_cal_type_sel",
    only_type: int | str | None = None,
) -> DataFrame:
    """``content.data[]`` rows with platform and type attached.

    ``only_type`` keeps one kind of envelope before its rows are unpacked.
    ``position`` is the place of the envelope and of the row in it.
    """
    keep = _others(df, value)
    struct = f"struct<content: struct<type: string, platformNum: string, data: array<{MAP}>>>"
    rows = df.select(*keep, F.posexplode(_one_or_many(F.col(value), struct)).alias("_n", "_e"))
    rows = rows.select(*keep, "_n", _number(F.col("_e.content.type")).alias("type"), _number(F.col("_e.content.platformNum")).alias("platformNum"), "_e.content.data")
    if only_type is not None:
        rows = rows.where(F.col("type") == str(only_type))
    rows = rows.select(*keep, "_n", "type", "platformNum", F.posexplode("data").alias("_m", "record"))
    record = _put(_put(_numbers(F.col("record")), platform_field, F.col("platformNum")), type_field, F.col("type"))
    position = F.struct(F.col("_n").alias("envelope"), F.col("_m").alias("row")).alias("position")
    return rows.where(F.col("record").isNotNull()).select(*keep, position, record.alias("record"))


def decode_path(df: DataFrame, path: str, value: str = "value") -> DataFrame:
    """The object at a dotted path as a map record."""
    keep = _others(df, value)
    record = F.from_json(F.get_json_object(number_text(F.col(value)), f"$.{path}"), MAP)
    return df.select(*keep, _numbers(record).alias("record")).where(F.col("record").isNotNull())


def fields(df: DataFrame, names: Sequence[str], record: str = "record") -> DataFrame:
    """Replace the record by one column per named field."""
    keep = _others(df, record)
    return df.select(*keep, *[F.col(record)[n].alias(n) for n in names])
