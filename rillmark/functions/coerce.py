"""Typed columns from text, with one policy for what does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .calendar import _col

# Store and database type names and the Spark type each becomes.
STORE_TYPES = {
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "float": "float",
    "double": "double",
    "string": "string",
    "binary": "binary",
    "unixtime_micros": "bigint",
    "tinyint": "tinyint",
    "int": "int",
    "bigint": "bigint",
    "char": "string",
    "varchar": "string",
    "text": "string",
    "date": "date",
    "datetime": "timestamp_ntz",
}
_TYPES = {
    t.simpleString(): t
    for t in (
        T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
        T.StringType(), T.BinaryType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(),
    )
}
_INTEGERS = {"tinyint", "smallint", "int", "bigint"}
_FLOATS = {"float", "double"}
POLICIES = ("null", "skip", "zero", "error")


def spark_type(name: str, micros_as_timestamp: bool = False) -> str:
    """Spark type of a store type; unknown names become strings."""
    name = name.lower()
    if micros_as_timestamp and name == "unixtime_micros":
        return "timestamp"
    return STORE_TYPES.get(name, "string")


def schema_of(columns: list[tuple], micros_as_timestamp: bool = False) -> T.StructType:
    """Target schema from (name, store type[, nullable]) tuples."""
    fields = []
    for name, store_type, *nullable in columns:
        data_type = _TYPES[spark_type(store_type, micros_as_timestamp)]
        fields.append(T.StructField(name, data_type, nullable[0] if nullable else True))
    return T.StructType(fields)


def coerce(c: Column | str, data_type: str, policy: str = "null") -> Column:
    """Cast text to a type.

    ``null`` and ``skip`` give NULL for what does not fit (for ``skip`` the
    column counts as absent, so '' stays '' in text columns), ``zero`` gives
    0 for a bad number, ``error`` fails the query. Booleans are true only for
    the word true, in any case.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    c = _col(c).cast("string")
    if data_type == "string":
        return F.nullif(c, F.lit("")) if policy in ("null", "error") else c
    if data_type == "boolean":
        value = F.lower(c) == "true"
        return F.when(c != "", value) if policy in ("null", "error") else value
    if policy == "error":
        return F.nullif(c, F.lit("")).cast(data_type)
    # Blanks around a whole number do not fit.
    fits = c.rlike(r"^[+-]?[0-9]+$") if data_type in _INTEGERS else F.lit(True)
    value = F.when(fits, c.try_cast(data_type))
    if policy == "zero" and data_type in _INTEGERS | _FLOATS:
        return F.when(c.isNotNull(), F.coalesce(value, F.lit(0).cast(data_type)))
    return value


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def conform(df: DataFrame, schema: T.StructType, policy: str = "null", strict: bool = False) -> DataFrame:
    """Target columns in target order; extra fields go, missing ones are NULL.

    With ``strict`` a column the target does not have is an error.
    """
    have = {name.lower(): name for name in df.columns}
    if strict:
        unknown = sorted(set(have) - {f.name.lower() for f in schema.fields})
        if unknown:
            raise ValueError(f"columns the target does not have: {unknown}")
    out = []
    for field in schema.fields:
        name, data_type = field.name, field.dataType.simpleString()
        source = have.get(name.lower())
        value = F.lit(None).cast(data_type) if source is None else coerce(F.col(source), data_type, policy)
        out.append(value.alias(name))
    return df.select(*out)


def conform_record(df: DataFrame, record: str, schema: T.StructType) -> DataFrame:
    """Map column to target columns; a key the target does not have fails the query."""
    names = F.array(*[F.lit(f.name) for f in schema.fields])
    unknown = F.array_except(F.map_keys(record), names)
    message = F.concat(F.lit("columns the target does not have: "), F.concat_ws(",", unknown))
    out = []
    for position, field in enumerate(schema.fields):
        value = coerce(F.col(record)[field.name], field.dataType.simpleString())
        if position == 0:
            value = F.when(F.size(unknown) > 0, F.raise_error(message).cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return df.select(*out)
