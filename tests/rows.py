"""Helpers that test modules import by name."""


def values(df):
    return [tuple(r) for r in df.collect()]
