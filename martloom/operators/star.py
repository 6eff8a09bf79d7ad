"""Star joins."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martloom.functions.columns import as_col


@dataclass(frozen=True)
class Dim:
    """A dimension to attach to a fact.

    ``on`` pairs a fact column or expression with a dimension column or
    expression. ``columns`` are the attributes to bring along: names, or a
    map from dimension name to output name. The dimension must be unique
    on its side of ``on`` unless fan-out is wanted, as with a bridge.
    """

    df: DataFrame
    on: list[tuple[str | Column, str | Column]]
    columns: list[str] | dict[str, str] = field(default_factory=list)
    how: str = "inner"

    def trimmed(self, prefix: str) -> tuple[DataFrame, list[str]]:
        """Only the join keys, under private names, and the wanted attributes."""
        wanted = self.columns
        if not isinstance(wanted, dict):
            wanted = {c: c for c in wanted}
        keys = [f"{prefix}{i}" for i in range(len(self.on))]
        return self.df.select(
            *[as_col(right).alias(k) for (_, right), k in zip(self.on, keys)],
            *[F.col(c).alias(new) for c, new in wanted.items()],
        ), keys


def star_join(fact: DataFrame, *dims: Dim, losses: Observation | None = None) -> DataFrame:
    """Attach dimensions in the given order; put the ones that filter most first.

    No hint is given: Spark broadcasts a dimension below
    ``spark.sql.autoBroadcastJoinThreshold`` and AQE splits hot fact keys
    in the joins that do shuffle.

    ``losses`` collects, while the result is used once, the fact's ``rows``, those ``kept``, and for the inner dimension i
    ``lost_i``, how many rows it has no partner for. Dimensions must then be unique on their keys.
    """
    out, hits = fact, {}
    for i, dim in enumerate(dims):
        right, keys = dim.trimmed(f"_dim{i}_")
        same = [as_col(left) == F.col(k) for (left, _), k in zip(dim.on, keys)]
        if losses is None or dim.how != "inner":
            out = out.join(right, same, dim.how).drop(*keys)
            continue
        hits[i] = f"_hit{i}"  # an inner join drops rows before they can be counted
        out = out.join(right.withColumn(hits[i], F.lit(True)), same, "left").drop(*keys)
    if not hits:
        return out
    whole = reduce(lambda a, b: a & b, [F.col(h).isNotNull() for h in hits.values()])
    missed = [F.count_if(F.col(h).isNull()).alias(f"lost_{i}") for i, h in hits.items()]
    out = out.observe(losses, F.count(F.lit(1)).alias("rows"), F.count_if(whole).alias("kept"), *missed)
    return out.where(whole).drop(*hits.values())


def match_report(fact: DataFrame, dims: dict[str, Dim]) -> DataFrame:
    """Per dimension, how many fact rows find a partner and how many an inner join would drop.

    Dimensions must be unique on their keys.
    """
    out = fact
    for i, (name, dim) in enumerate(dims.items()):
        right, keys = dim.trimmed(f"_dim{i}_")
        right = right.select(*keys, F.lit(True).alias(f"_hit{i}"))
        same = [as_col(left) == F.col(k) for (left, _), k in zip(dim.on, keys)]
        out = out.join(right, same, "left").drop(*keys)
    counts = out.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("dimension"),
                    F.count(F.col(f"_hit{i}")).alias("matched_rows"),
                    F.count_if(F.col(f"_hit{i}").isNull()).alias("dropped_rows"),
                )
                for i, name in enumerate(dims)
            ]
        ).alias("report")
    )
    return counts.select(F.inline("report"))
