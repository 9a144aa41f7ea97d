"""Checks that name what fails them."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: How many of the values that fail a check its message names.
NAMED = 20


def missing(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """The distinct values of a key that ``known`` lacks."""
    return rows.select(key).distinct().join(known.select(key), key, "left_anti")


def require_known(rows: DataFrame, known: DataFrame, key: str, what: str, error: type[Exception] = ValueError) -> None:
    """Raises an error that names some values of the key that ``known`` lacks."""
    lacking = missing(rows, known, key).orderBy(key).limit(NAMED).collect()
    if lacking:
        raise error(f"{what}: {[r[0] for r in lacking]}")
