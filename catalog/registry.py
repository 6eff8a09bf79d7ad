"""Queries register themselves by name together with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def half_up(expr: str, digits: int) -> str:
    """DuckDB text that rounds a double the way Spark does, half away from zero."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def exact_mean(column: str) -> str:
    """DuckDB text for the mean of two-digit values, rounded half up in whole numbers."""
    cents = f"CAST(sum(CAST({column} AS DECIMAL(18,2))) * 100 AS HUGEINT)"
    return f"CAST(({cents} * 2 + count({column})) // (count({column}) * 2) AS DOUBLE) / 100"
