"""Typed projections that survive dirty input and can report what they lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martloom.functions.columns import as_col

# (source column or expression, target name, target type)
CastSpec = list[tuple[str | Column, str, str]]


def typed_select(
    df: DataFrame,
    spec: CastSpec,
    losses: Observation | None = None,
    parsed: dict[str, str | Column] | None = None,
) -> DataFrame:
    """Rename and cast in one projection; a value that does not fit becomes NULL.

    ``losses`` collects, while the result is written or otherwise used once, the number of ``rows`` and per target
    column how many non-NULL inputs became NULL. Where a source is an expression that parses a
    column, ``parsed`` names the column it came from (target name -> source).
    """
    if losses is not None:
        raw = {name: as_col((parsed or {}).get(name, src)) for src, name, _ in spec}
        counts = [
            F.count_if(raw[name].isNotNull() & as_col(src).try_cast(kind).isNull()).alias(name) for src, name, kind in spec
        ]
        df = df.observe(losses, F.count(F.lit(1)).alias("rows"), *counts)
    return df.select(*[as_col(src).try_cast(kind).alias(name) for src, name, kind in spec])


def cast_losses(df: DataFrame, spec: CastSpec) -> DataFrame:
    """Per target column: how many non-NULL inputs the cast turned into NULL."""
    counts = df.agg(
        *[
            F.count_if(as_col(src).isNotNull() & as_col(src).try_cast(kind).isNull()).alias(name)
            for src, name, kind in spec
        ]
    )
    names = [name for _, name, _ in spec]
    return counts.unpivot([], names, "column_name", "lost_values")


def parse_timestamp(c: str | Column, pattern: str = "yyyy-MM-dd'T'HH:mm") -> Column:
    """Timestamp in ``pattern``, else any form Spark's own cast knows, else NULL."""
    return F.coalesce(
        F.try_to_timestamp(as_col(c), F.lit(pattern)), as_col(c).try_cast("timestamp")
    )


def parse_date(c: str | Column) -> Column:
    return as_col(c).try_cast("date")
