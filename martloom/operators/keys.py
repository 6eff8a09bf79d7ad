"""Surrogate keys 1..n, and keys that survive reruns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import as_list
from martloom.operators.dedupe import tie_break
from martloom.operators.placement import place, with_offsets
from martloom.session import checkpointed


def dense_key(df: DataFrame, order_by: str | list[str], name: str) -> DataFrame:
    """Number the rows 1..n in the order of ``order_by``, as a bigint column.

    Meant for rows that are unique on ``order_by``, as after ``dedupe``;
    the other columns break ties. Rows are range-partitioned, stored once,
    and numbered from the offset of their partition; no task sees more than its range.
    """
    order_by = as_list(order_by)
    order = [F.col(c).asc_nulls_first() for c in order_by] + tie_break(df, order_by)
    placed = with_offsets(place(df, order), {"_rows": F.count("*")})
    numbered = placed.withColumn(name, F.col("_rows_before") + F.col("_row") + 1)
    return numbered.select(name, *df.columns)


def stable_key(
    incoming: DataFrame,
    existing: DataFrame | None,
    natural_key: str | list[str],
    name: str,
) -> DataFrame:
    """Give each natural key the number it already has, new ones the next numbers.

    ``existing`` is the current table (natural key and ``name``), or None
    on the first load. ``incoming`` is unique on the natural key; it is worked out
    once, with the numbers it has, and split from there.
    """
    natural_key = as_list(natural_key)
    if existing is None:
        return dense_key(incoming, natural_key, name)
    held = existing.select(*[F.col(k).alias(f"_held_{k}") for k in natural_key], name)
    same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in natural_key]
    matched = checkpointed(incoming.join(held, same, "left").select(name, *incoming.columns))
    known = matched.filter(F.col(name).isNotNull()).withColumn(name, F.col(name).cast("bigint"))
    fresh = dense_key(matched.filter(F.col(name).isNull()).drop(name), natural_key, name)
    highest = existing.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint")).scalar()
    return known.unionByName(fresh.withColumn(name, F.col(name) + highest))
