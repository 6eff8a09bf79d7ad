"""Slowly changing dimension, type 2.

Intervals are half-open: a version holds from ``valid_from`` up to, but not
on, ``valid_to``; the current version has no ``valid_to``.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.columns import as_list
from martloom.operators.dedupe import dedupe

VALIDITY = ["valid_from", "valid_to", "is_current"]


def open_history(df: DataFrame, as_of: dt.date) -> DataFrame:
    """First versions: everything is current from ``as_of`` on."""
    return df.withColumns(
        {
            "valid_from": F.lit(as_of),
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )


def _joined(history: DataFrame, incoming: DataFrame, keys: list[str], how: str) -> DataFrame:
    now = history.filter("is_current").alias("c")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys]
    return now.join(incoming.alias("i"), same, how)


def scd2_apply(
    history: DataFrame,
    incoming: DataFrame,
    keys: str | list[str],
    tracked: str | list[str],
    as_of: dt.date,
    newest_by: str | list[str] | None = None,
    close_missing: bool = False,
) -> DataFrame:
    """The history after a batch that describes the state on ``as_of``.

    - A key without a current version opens one, also when it returns after
      having been closed.
    - A change in a tracked column closes the current version on ``as_of``
      and opens the next. When the current version itself began on ``as_of``
      it is replaced, so a rerun or correction leaves no empty interval.
    - Without such a change the other columns are refreshed in place.
    - A batch older than the current version changes nothing for that key;
      ``late_rows`` lists what was refused.
    - A key missing from the batch stays current unless ``close_missing``.

    Closed versions are passed through; only current ones are joined.
    """
    keys, tracked = as_list(keys), as_list(tracked)
    values = [c for c in history.columns if c not in VALIDITY]
    day = F.lit(as_of)
    incoming = dedupe(incoming, keys, newest_by).withColumn("_in", F.lit(True))
    current = history.withColumn("_cur", F.lit(True))
    both = _joined(current, incoming, keys, "full")

    has_current = F.col("c._cur").isNotNull()
    has_incoming = F.col("i._in").isNotNull()
    late = F.coalesce(F.col("c.valid_from") > day, F.lit(False))
    changed = ~reduce(
        lambda a, b: a & b, [F.col(f"c.{c}").eqNullSafe(F.col(f"i.{c}")) for c in tracked]
    )
    same_day = F.col("c.valid_from") == day

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in values],
            start.cast("date").alias("valid_from"),
            end.cast("date").alias("valid_to"),
            end.isNull().alias("is_current"),
        )

    none = F.lit(None).cast("date")
    unchanged = version("c", F.col("c.valid_from"), none)
    closed = version("c", F.col("c.valid_from"), day)
    opened = version("i", day, none)
    refreshed = version("i", F.col("c.valid_from"), none)

    missing = (
        F.when(same_day | late, F.array(unchanged)).otherwise(F.array(closed))
        if close_missing
        else F.array(unchanged)
    )
    versions = (
        F.when(~has_current, F.array(opened))
        .when(~has_incoming, missing)
        .when(late, F.array(unchanged))
        .when(~changed | same_day, F.array(refreshed))
        .otherwise(F.array(closed, opened))
    )
    now = both.select(F.inline(versions))
    past = history.filter(~F.col("is_current"))
    return past.unionByName(now.select(*history.columns))


def late_rows(
    history: DataFrame, incoming: DataFrame, keys: str | list[str], as_of: dt.date
) -> DataFrame:
    """Incoming rows that ``scd2_apply`` refuses because a newer version is current."""
    keys = as_list(keys)
    refused = _joined(history, incoming, keys, "inner").filter(F.col("c.valid_from") > F.lit(as_of))
    return refused.select("i.*")
