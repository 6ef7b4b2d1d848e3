"""Mapping driven by a configuration.

A configuration lists rules. Each rule has an event id, an optional condition
and, per target column, a source field or a constant. It becomes one plan over
one read of the records, which gives a row per rule a record matches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import calendar as cal
from ..functions.coerce import coerce, required_columns
from ..functions.text import blank
from ..operators.filters import all_present, parse_condition
from .common import carried, source_columns

TIME_TARGET = "_fopt_time"
TENANT_TARGET = "_ftenancy_id"
EVENT_TARGET = "_event_id"

# Target columns computed from the operation time.
DERIVED = {
    "_dt": cal.day,
    "_years": cal.year,
    "_year_quarter": cal.quarter,
    "_year_month": cal.year_month,
    "_year_week": cal.year_week,
    "_y_m_tenofmonth": cal.ten_of_month,
    "_hours": cal.hour,
}


def _rules(config: Mapping) -> list[dict]:
    """Rules with their mappings by lower-case target. The key ``mappping`` is spelled as stored."""
    out = []
    for rule in config["configs"]:
        by_target = {m["target"].lower(): m for m in rule["mappping"]}
        out.append({**rule, "by_target": by_target})
    return out


def tenant_field(config: Mapping) -> str | None:
    """Source field of the tenant, taken from the first rule."""
    for mapping in config["configs"][0]["mappping"]:
        if mapping["target"] == TENANT_TARGET:
            return mapping["source"]
    return None


def condition_column(condition: str | tuple | None, get) -> Column:
    """A condition as a predicate; numbers compare as numbers where both sides are."""
    parts = parse_condition(condition) if isinstance(condition, str) or condition is None else condition
    if parts is None:
        return F.lit(True)
    field, op, value = parts
    text = get(field)
    if op == "=":
        return F.coalesce(text == value, F.lit(False))
    number, bound = text.try_cast("double"), F.lit(value).try_cast("double")
    numeric = number.isNotNull() & bound.isNotNull()
    if op == ">":
        test = F.when(numeric, number > bound).otherwise(text > value)
    else:
        test = F.when(numeric, number < bound).otherwise(text < value)
    return F.coalesce(test, F.lit(False))


def required_sources(config: Mapping, schema: T.StructType) -> list[str]:
    """Source fields a record must hold: those of required targets without default or derivation."""
    required = set(required_columns(schema))
    sources: dict[str, str] = {}
    for rule in config["configs"]:
        for m in rule["mappping"]:
            if m["target"] not in required or m.get("defaultvalue") or m["target"] in (*DERIVED, EVENT_TARGET):
                continue
            sources[m["target"]] = m["source"]
    return sorted(set(sources.values()))


def source_fields(config: Mapping) -> list[str]:
    """All source fields a configuration reads."""
    found = {m["source"] for rule in config["configs"] for m in rule["mappping"] if m.get("source")}
    for rule in config["configs"]:
        condition = rule.get("condition")
        parts = parse_condition(condition) if isinstance(condition, str) else condition
        if parts:
            found.add(parts[0])
    return sorted(found)


def require_sources(df: DataFrame, config: Mapping, schema: T.StructType) -> DataFrame:
    return df.where(all_present(required_sources(config, schema)))


def _underivable(name: str, time: Column) -> Column:
    """True where the derivation cannot be computed from a time that is there."""
    parts = F.split(cal.day(time), "-")
    month, dom = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    if name == "_year_quarter":
        return month.try_cast("int").isNull()
    if name == "_year_month":
        return month.isNull()
    if name == "_y_m_tenofmonth":
        return month.isNull() | dom.try_cast("int").isNull()
    if name == "_hours":
        return F.get(F.split(time, " "), F.lit(1)).isNull()
    return F.lit(False)


def _per_rule(rules: list[dict], choose: Callable[[dict], tuple], get) -> Column:
    """A column whose definition depends on the rule of the row.

    ``choose`` names a rule's definition: a source field, a constant or
    nothing. Rules with the same one share it.
    """
    groups: dict[tuple, list[int]] = {}
    for number, rule in enumerate(rules):
        groups.setdefault(choose(rule), []).append(number)

    def column(definition: tuple) -> Column:
        kind, text = definition
        return get(text) if kind == "source" else F.lit(text).cast("string")

    if len(groups) == 1:
        return column(next(iter(groups)))
    (definition, numbers), *rest = groups.items()
    chain = F.when(F.col("_rule").isin(numbers), column(definition))
    for definition, numbers in rest:
        chain = chain.when(F.col("_rule").isin(numbers), column(definition))
    return chain


def _definition(mapping: dict | None) -> tuple:
    if mapping is None:
        return "constant", None
    return ("constant", mapping["defaultvalue"]) if mapping.get("defaultvalue") else ("source", mapping["source"])


def fanout_events(df: DataFrame, config: Mapping, schema: T.StructType, on_error: str = "drop") -> DataFrame:
    """One text row per record and matching rule.

    The rules a record matches are found first; columns are then computed
    once per row, whatever the number of rules. A row one of whose derived
    columns cannot be computed is dropped; with ``on_error="keep"`` it stays
    with that column NULL.
    """
    rules = _rules(config)
    keys = {m["target"] for rule in rules for m in rule["mappping"]}
    get = source_columns(df)
    matched = F.array(*[F.when(condition_column(r.get("condition"), get), F.lit(i)) for i, r in enumerate(rules)])
    rows = df.select("*", F.explode(matched).alias("_rule")).where(F.col("_rule").isNotNull())

    def time_of(rule: dict) -> tuple:
        mapping = rule["by_target"].get(TIME_TARGET)
        return ("source", mapping["source"]) if mapping else ("constant", None)

    rows = rows.withColumn("_time", _per_rule(rules, time_of, get))
    time, bad, out = F.col("_time"), F.lit(False), []
    for name in schema.names:
        value = _per_rule(rules, lambda r: _definition(r["by_target"].get(name.lower()) if name in keys else None), get)
        if name == EVENT_TARGET:
            # Without a time there is no event id either; stored data has it so.
            event = _per_rule(rules, lambda r: ("constant", r["eventId"]), get)
            value = F.when(blank(value), F.when(time.isNotNull(), event)).otherwise(value)
        elif name in DERIVED:
            derived = DERIVED[name](time)
            if name in keys:
                bad = bad | (blank(value) & time.isNotNull() & _underivable(name, time))
                derived = F.when(blank(value), derived).otherwise(value)
            else:
                bad = bad | (time.isNotNull() & _underivable(name, time))
            value = derived
        out.append(value.alias(name))
    if on_error == "drop":
        rows = rows.where(~F.coalesce(bad, F.lit(False)))
    # Rows of one record share its place; the rule tells them apart.
    told = [F.struct("_place.*", F.col("_rule").alias("rule")).alias("_place")] if carried(df) else []
    return rows.select(*out, *told)


def map_events(
    df: DataFrame, config: Mapping, schema: T.StructType, on_error: str = "drop", policy: str = "error"
) -> DataFrame:
    """Configured mapping to typed target columns.

    A value that does not fit its type fails the query; other policies of
    ``coerce`` may be chosen.
    """
    rows = fanout_events(df, config, schema, on_error)
    return rows.select(
        *[coerce(F.col(f.name), f.dataType.simpleString(), policy).alias(f.name) for f in schema.fields], *carried(rows)
    )
