"""Grouped counts, pivots by hand, majority values and sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import as_col, as_list


def conditional_counts(value: str | Column, names: dict[str, str]) -> list[Column]:
    """``{alias: wanted value}`` -> one counting aggregate per wanted value."""
    return [F.count_if(as_col(value) == wanted).alias(alias) for alias, wanted in names.items()]


def distinct_counts(df: DataFrame, keys: str | list[str], counted: str, name: str) -> DataFrame:
    """``count(distinct counted)`` per key.

    Spark shuffles this on (keys, counted) first, so a hot key is spread
    over all tasks and only its partial counts meet.
    """
    return df.groupBy(*as_list(keys)).agg(F.count_distinct(counted).alias(name))


def majority(
    df: DataFrame,
    group: str | list[str],
    choice: str,
    votes: str = "votes",
    total: str = "total",
) -> DataFrame:
    """Per group: the most frequent choice, its count and the group's size.

    Ties go to the smallest choice, NULL before all others. Everything is
    an aggregate over the (group, choice) histogram, so no group has to
    fit into one task.
    """
    group = as_list(group)
    histogram = df.groupBy(*group, choice).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("minus_n"), F.col(choice).alias("choice")))
    return (
        histogram.groupBy(*group)
        .agg(F.sum("_n").alias(total), best.alias("_best"))
        .select(
            *group,
            F.col("_best.choice").alias(choice),
            (-F.col("_best.minus_n")).alias(votes),
            total,
        )
    )


def sorted_set(
    df: DataFrame, keys: str | list[str], member: str, name: str
) -> DataFrame:
    """Per key the sorted array of distinct non-NULL members.

    Duplicates are removed in a shuffle on (keys, member) before any
    array is built; an array holds distinct members only.
    """
    keys = as_list(keys)
    pairs = df.select(*keys, member).distinct()
    return pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(member)).alias(name))
