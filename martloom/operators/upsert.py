"""Key-based upsert as a DataFrame operator."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.columns import as_list
from martloom.operators.dedupe import dedupe
from martloom.session import checkpointed


# True, False, or the key columns in which NULL equals NULL.
NullSafe = bool | list[str]


def _is_safe(key: str, null_safe: NullSafe) -> bool:
    return null_safe if isinstance(null_safe, bool) else key in null_safe


def key_matches(left: str, right: str, keys: list[str], null_safe: NullSafe) -> list[Column]:
    """Equality of the keys under two aliases."""
    return [
        (Column.eqNullSafe if _is_safe(k, null_safe) else Column.__eq__)(
            F.col(f"{left}.{k}"), F.col(f"{right}.{k}")
        )
        for k in keys
    ]


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def newest_per_key(
    source: DataFrame, keys: list[str], newest_by: str | list[str] | None, null_safe: NullSafe
) -> DataFrame:
    """The source rows an upsert may apply.

    A row with a NULL in a key column that is not compared ``null_safe``
    equals no other row, so all such rows stay.
    """
    strict = [k for k in keys if not _is_safe(k, null_safe)]
    if not strict:
        return dedupe(source, keys, newest_by)
    complete = _all([F.col(k).isNotNull() for k in strict])
    return dedupe(source.filter(complete), keys, newest_by).unionByName(source.filter(~complete))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | list[str],
    update_map: dict[str, str] | None = None,
    newest_by: str | list[str] | None = None,
    null_safe: NullSafe = False,
) -> DataFrame:
    """Rows of ``target`` after matched updates and unmatched inserts from ``source``.

    Matched rows take all non-key columns of the source, or only those in
    ``update_map`` ({target column: source column}). The source is reduced
    to its newest row per key first. Keys are compared with ``=``, under
    which NULL matches nothing; ``null_safe`` (or the columns it lists) compares NULLs as equal.
    Without ``update_map`` a source column the target lacks, other than ``newest_by``, is
    an error.

    The target is only ever joined against the source's keys. With a batch
    small enough to broadcast it is therefore streamed through, not shuffled.
    """
    keys = as_list(keys)
    if update_map is None:
        require_known_columns(target, source, newest_by)
    newest = newest_per_key(source, keys, newest_by, null_safe)
    return apply_newest(target, newest, keys, update_map, null_safe)


def require_known_columns(
    target: DataFrame, source: DataFrame, newest_by: str | list[str] | None
) -> None:
    extra = [c for c in source.columns if c not in target.columns and c not in as_list(newest_by or [])]
    if extra:
        raise ValueError(f"the target lacks the source columns {extra}")


def apply_newest(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_map: dict[str, str] | None = None,
    null_safe: NullSafe = False,
) -> DataFrame:
    """``upsert`` with a source that ``newest_per_key`` has been applied to."""
    def matches(left: str, right: str) -> list[Column]:
        return key_matches(left, right, keys, null_safe)

    t, s = target.alias("t"), source.alias("s")
    if update_map is None:
        kept = t.join(source.select(*keys).alias("s"), matches("t", "s"), "left_anti")
        return kept.unionByName(source.select(*target.columns))

    # one full join: matched rows are updated, the others pass from their side
    joined = (
        target.withColumn("_in_target", F.lit(True))
        .alias("t")
        .join(source.withColumn("_in_source", F.lit(True)).alias("s"), matches("t", "s"), "full")
    )
    old, new = F.col("t._in_target").isNotNull(), F.col("s._in_source").isNotNull()

    def value(c: str) -> Column:
        kept = F.col(f"t.{c}")
        if c in update_map:
            kept = F.when(new, F.col(f"s.{update_map[c]}")).otherwise(kept)
        inserted = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        return F.when(old, kept).otherwise(inserted).alias(c)

    return joined.select(*[value(c) for c in target.columns])


@dataclass(frozen=True)
class Within:
    """The part of a condition that says ``dest.<point> BETWEEN orig.<low> AND orig.<high>``, for numbers or dates."""

    point: str
    low: str
    high: str


def upsert_where(
    target: DataFrame,
    source: DataFrame,
    condition: str | Column,
    target_key: str | list[str],
    within: Within | None = None,
) -> DataFrame:
    """Upsert on a free condition over the aliases ``dest`` and ``orig``.

    A matched target row becomes the source row, an unmatched source row is
    inserted. ``target_key`` identifies a target row, NULLs in it equal to nothing; the
    job fails when two source rows match the same one, as no order between them is
    defined.

    A condition needs an equality to be joined by. One that has none, but requires a target
    column to lie in an interval of the source, names it in ``within``: both sides are then joined by bins.
    Without either, every row would be compared with every other, and the call is refused.
    """
    condition = F.expr(condition) if isinstance(condition, str) else condition
    target_key = as_list(target_key)
    if within is None:
        joined = (
            target.withColumn("_in_target", F.lit(True))
            .alias("dest")
            .join(source.withColumn("_in_source", F.lit(True)).alias("orig"), condition, "full")
        )
        _require_no_loop(joined)
    else:
        joined, inserted = _joined_by_bins(target, source, condition, within)
    old, new = F.col("dest._in_target").isNotNull(), F.col("orig._in_source").isNotNull()
    complete = _all([F.col(f"dest.{k}").isNotNull() for k in target_key])
    matched = old & new & complete
    per_row = Window.partitionBy(matched, *[F.col(f"dest.{k}") for k in target_key])
    # only matched rows with a whole key can be matched twice; the others go past the count
    counted = joined.filter(matched).withColumn("_matches", F.count("*").over(per_row))
    once = F.when(F.col("_matches") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit("several source rows match one target row"))
    )
    replaced = counted.filter(once).select(*[F.col(f"orig.{c}") for c in target.columns])
    others = joined.filter(~matched).select(
        *[F.when(new, F.col(f"orig.{c}")).otherwise(F.col(f"dest.{c}")).alias(c) for c in target.columns]
    )
    rows = others.unionByName(replaced)
    return rows if within is None else rows.unionByName(inserted.select(*target.columns))


def _require_no_loop(joined: DataFrame) -> None:
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    if "NestedLoopJoin" in plan or "CartesianProduct" in plan:
        raise ValueError("the condition has no equality to join by; give `within`, or add one")


def _number(c: Column, kind: T.DataType) -> Column:
    """Days and times as seconds, so that they compare with each other; all else as it is."""
    moment = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return (c.cast("timestamp") if moment else c).cast("double")


def _joined_by_bins(target: DataFrame, source: DataFrame, condition: Column, within: Within) -> tuple[DataFrame, DataFrame]:
    """(target left-joined with its matches, source rows without a match).

    Bins are as wide as the mean interval, so the source rows are repeated at most three times on average; a target
    row is in one bin, and meets each match once.
    """
    low, high = (_number(F.col(c), source.schema[c].dataType) for c in (within.low, within.high))
    batch = checkpointed(source.withColumn("_in_source", F.monotonically_increasing_id()))
    real = batch.where((low <= high) & (F.abs(low) < _FAR) & (F.abs(high) < _FAR))
    mean = real.agg(F.avg(high - low)).first()[0]
    width = mean or 1.0
    bins = F.sequence(F.floor(low / width), F.floor(high / width))
    orig = real.withColumn("_bin", F.explode(bins)).alias("orig")
    point = _number(F.col(within.point), target.schema[within.point].dataType)
    dest = target.withColumn("_in_target", F.lit(True)).withColumn("_bin", F.when(F.abs(point) < _FAR, F.floor(point / width)))
    inside = F.col(f"dest.{within.point}").between(F.col(f"orig.{within.low}"), F.col(f"orig.{within.high}"))
    # stored, as the matches decide both what is replaced and what is inserted
    joined = dest.alias("dest").join(orig, (F.col("dest._bin") == F.col("orig._bin")) & inside & condition, "left")
    met = joined.where(F.col("orig._in_source").isNotNull()).select(F.col("orig._in_source").alias("_met")).distinct()
    return joined, batch.join(met, F.col("_in_source") == F.col("_met"), "left_anti")


# Bounds beyond this are not binned: NaN and infinity lie in no interval.
_FAR = 1e15
