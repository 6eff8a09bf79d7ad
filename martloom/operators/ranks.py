"""Ranks inside groups and over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.columns import as_list
from martloom.operators.placement import place, with_offsets
from martloom.session import checkpointed


def top_n_per_group(
    df: DataFrame, group: str | list[str], order: list[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group with their row number.

    ``order`` should end in columns that make it total. Spark cuts every
    group to ``n`` rows before the shuffle as well as after it.
    """
    w = Window.partitionBy(*as_list(group)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def share_of_max(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``{column: new name}``: each value as a percentage of the column's maximum.

    The maxima come from one scalar subquery, not from a global window.
    """
    maxima = df.agg(F.struct(*[F.max(c).alias(c) for c in columns])).scalar()
    return df.withColumns(
        {new: F.try_divide(F.col(c), maxima[c]) * 100 for c, new in columns.items()}
    )


def global_ranks(
    df: DataFrame,
    score: str,
    dense_desc: str | None = None,
    percent_asc: str | None = None,
    stored: bool = False,
) -> DataFrame:
    """Dense rank by descending score and percent rank by ascending score.

    The distinct scores are ranked over range partitions and joined back, so
    no task sees more than its share, however few or many scores there are.

    The scores are read twice, so the table is checkpointed first
    unless it is ``stored`` already: a mean computed again in another order
    may differ in its last bit and match nothing.
    """
    kept = df if stored else checkpointed(df)
    histogram = kept.groupBy(F.col(score).alias("_score")).agg(F.count("*").alias("_n"))
    counted = _in_ranges(histogram)
    out = []
    if dense_desc:
        out.append((F.col("_values") - F.col("_nth") + 1).alias(dense_desc))
    if percent_asc:
        below = F.col("_upto") - F.col("_n")
        share = F.try_divide(below.cast("double"), (F.col("_rows") - 1).cast("double"))
        out.append(F.coalesce(share, F.lit(0.0)).alias(percent_asc))
    ranks = counted.select("_score", *out)
    return kept.join(ranks, F.col(score).eqNullSafe(F.col("_score")), "inner").drop("_score")


def _in_ranges(histogram: DataFrame) -> DataFrame:
    """Add to each distinct score its place, the rows up to it, and both totals."""
    placed = with_offsets(
        place(histogram, [F.col("_score").asc_nulls_first()]),
        {"_values": F.count("*"), "_rows": F.sum("_n")},
    )
    so_far = (
        Window.partitionBy("_part")
        .orderBy("_row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return placed.select(
        "_score",
        "_n",
        (F.col("_values_before") + F.col("_row") + 1).alias("_nth"),
        (F.col("_rows_before") + F.sum("_n").over(so_far)).alias("_upto"),
        F.col("_values_total").alias("_values"),
        F.col("_rows_total").alias("_rows"),
    )
