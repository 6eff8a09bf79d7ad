"""Checks on keys, coverage and emptiness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import as_list


def distinct_ids(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """The ids children are asked for, as a frame instead of a list on the driver."""
    return df.select(*as_list(keys)).distinct()


def parents_without_children(
    parent: DataFrame, child: DataFrame, on: str | list[str] | dict[str, str]
) -> DataFrame:
    """Distinct parent keys that no child row carries.

    ``on`` may map parent columns to differently named child columns.
    """
    pairs = on if isinstance(on, dict) else {k: k for k in as_list(on)}
    seen = distinct_ids(child, list(pairs.values()))  # a busy parent counts once
    seen = seen.select(*[F.col(c).alias(f"_child_{p}") for p, c in pairs.items()])
    same = [F.col(p) == F.col(f"_child_{p}") for p in pairs]
    return distinct_ids(parent, list(pairs)).join(seen, same, "left_anti")


def duplicate_keys(df: DataFrame, keys: str | list[str], name: str = "copies") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*as_list(keys)).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def assert_unique(df: DataFrame, keys: str | list[str]) -> DataFrame:
    """Return ``df`` if ``keys`` are unique in it, else raise with an example."""
    example = duplicate_keys(df, keys).head()
    if example is not None:
        raise ValueError(f"keys {as_list(keys)} are not unique: {example.asDict()}")
    return df


def require_rows(df: DataFrame, what: str = "source") -> DataFrame:
    """Return ``df`` if it has a row, else raise."""
    if df.isEmpty():
        raise ValueError(f"{what} returned no rows")
    return df
