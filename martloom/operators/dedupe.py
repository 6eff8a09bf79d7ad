"""One row per key, always the same one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.columns import as_list

UNORDERABLE = (T.MapType, T.VariantType, T.CalendarIntervalType)


def tie_break(df: DataFrame, used: list[str]) -> list[Column]:
    """Every orderable column not in ``used``, ascending: makes an order total."""
    return [
        F.col(f.name).asc_nulls_first()
        for f in df.schema.fields
        if f.name not in used and not isinstance(f.dataType, UNORDERABLE)
    ]


def dedupe(
    df: DataFrame, keys: str | list[str], newest_by: str | list[str] | None = None
) -> DataFrame:
    """Keep the newest row per key; the remaining columns break ties.

    NULL keys form a group like any other value. Spark limits each group
    to its best row before the shuffle, so a key that holds a large part
    of the table sends at most one row per map task.
    """
    keys = as_list(keys)
    newest = as_list(newest_by or [])
    order = [F.col(c).desc_nulls_last() for c in newest]
    order += tie_break(df, keys + newest)
    if not order:
        return df.select(*keys).distinct()
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")
