"""Global order without a single-task window.

Rows are range-partitioned and sorted, and each row's place is written
down before anything is counted. The frame is checkpointed at that point:
sampled range bounds may differ between two runs of one plan, so the
counts and the rows must come from one run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import checkpointed

ROW_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def place(df: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``_part`` and ``_row``; together they follow ``order``, which must be total."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return (
        checkpointed(placed)
        .withColumn("_part", F.shiftright("_place", ROW_BITS))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
        .drop("_place")
    )


def with_offsets(placed: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Add, per sum ``x``, ``x_before`` (all earlier partitions) and ``x_total``.

    The joined table has one row per shuffle partition, so its broadcast
    and its one-task window are bounded by the partition count.
    """
    per_part = placed.groupBy("_part").agg(*[c.alias(name) for name, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = per_part.select(
        "_part",
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in sums],
        *[F.sum(s).over(everything).alias(f"{s}_total") for s in sums],
    )
    return placed.join(F.broadcast(offsets), "_part")
