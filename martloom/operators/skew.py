"""Joins on keys of which a few hold a large part of the rows.

AQE splits a shuffle partition that is large in bytes. It cannot see a key
that is small on both sides but multiplies in the join; salting can.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import as_list


def hot_keys(df: DataFrame, keys: str | list[str], rows_per_task: int) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of salts each needs.

    At most count(df) / rows_per_task keys can qualify.
    """
    n = F.count("*").alias("_n")
    return (
        df.groupBy(*as_list(keys))
        .agg(n)
        .filter(F.col("_n") > rows_per_task)
        .withColumn("_salts", F.ceil(F.col("_n") / rows_per_task).cast("int"))
        .drop("_n")
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    how: str = "inner",
    spread_by: list[str | Column] = (),
    rows_per_task: int = 1_000_000,
) -> DataFrame:
    """``left.join(right, on, how)`` with the hot keys of ``left`` spread over salts.

    Only hot keys are salted, and only their right rows are repeated, so
    all other keys cost nothing extra. ``spread_by`` are left columns that
    differ within a key; the salt is their hash, which a retried task
    computes again unchanged. Valid for inner, left, left_semi, left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salting the left side does not allow a {how} join")
    on = as_list(on)
    spread = list(spread_by) or [c for c in left.columns if c not in on]
    # grows with the left side, so Spark decides by its size whether to broadcast it
    hot = hot_keys(left, on, rows_per_task)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    salted_left = (
        left.join(hot, on, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
        .drop("_salts")
    )
    salted_right = (
        right.join(hot, on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    joined = salted_left.join(salted_right, [*on, "_salt"], how)
    return joined.drop("_salt")
