"""Every operator as a query over the given tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL of the same result."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return register


def load() -> None:
    from . import aggregates, decoding, filters, joins, keyed, mappings, scalars, sinks, sources, streams  # noqa: F401
