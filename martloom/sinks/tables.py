"""Writing catalog tables without a transactional format.

Two layouts can be upserted:

- partitioned: the touched partitions are rewritten in place by dynamic
  partition overwrite. Files are swapped per partition when the job commits.
- unpartitioned: each upsert writes a new version table, then the view that
  carries the table's name is pointed at it. Readers see the old or the new
  version, never a mixture; superseded versions can be dropped later.

Neither protects against two writers at once.
"""

from __future__ import annotations

from contextlib import contextmanager
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.columns import as_col, as_list
from martloom.operators.upsert import (
    NullSafe,
    Within,
    apply_newest,
    key_matches,
    newest_per_key,
    require_known_columns,
    upsert_where,
)
from martloom.session import checkpointed


def save(
    df: DataFrame,
    table: str,
    mode: str = "append",
    fmt: str = "parquet",
    partition_by: str | list[str] = (),
    overwrite_schema: bool = False,
    order_by: str | Column | list[str | Column] = (),
) -> None:
    """``saveAsTable`` with modes append, overwrite, ignore and error.

    Partitioned writes are rebalanced on the partition columns first: one
    file set per partition, with AQE splitting partitions that are too big.
    ``order_by`` stores the rows in that order, within each partition: they are dealt out by ranges
    and sorted, so files do not overlap and readers skip those whose least and greatest values rule them out.
    ``overwrite_schema`` passes the option on to formats that know it.
    """
    partition_by = as_list(partition_by)
    order = [as_col(c) for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)]
    if order:
        bounds = [*[F.col(c) for c in partition_by], *order]
        df = df.repartitionByRange(*bounds).sortWithinPartitions(*bounds)
    elif partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode(mode)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if overwrite_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def load(
    df: DataFrame,
    table: str,
    keys: str | list[str],
    partition_by: str | list[str] = (),
    fmt: str = "parquet",
    **upsert_options,
) -> None:
    """First load creates the table, later loads upsert into it."""
    if df.sparkSession.catalog.tableExists(table):
        upsert_table(df, table, keys, fmt=fmt, **upsert_options)
        return
    keys = as_list(keys)
    first = newest_per_key(
        df, keys, upsert_options.get("newest_by"), upsert_options.get("null_safe", False)
    )
    if partition_by:
        save(first, table, "overwrite", fmt, partition_by, overwrite_schema=True)
    else:
        replace(first, table, fmt)


def upsert_table(
    source: DataFrame,
    table: str,
    keys: str | list[str],
    update_map: dict[str, str] | None = None,
    newest_by: str | list[str] | None = None,
    null_safe: NullSafe = False,
    keys_fix_partition: bool = False,
    fmt: str = "parquet",
) -> None:
    """Upsert ``source`` into a table written by ``load`` or ``save``.

    ``keys_fix_partition`` promises that a key never changes partition (the
    partition columns are keys or derived from them); the search for the old
    partitions of matched keys is then skipped.
    """
    spark = source.sparkSession
    keys = as_list(keys)
    target = spark.table(table)
    # read several times below, so it is worked out once
    if update_map is None:
        require_known_columns(target, source, newest_by)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    # a catalog keeps the empty text as the NULL partition
    texts = [p for p in parts if isinstance(target.schema[p].dataType, T.StringType)]
    source = source.withColumns({p: F.when(F.col(p) != "", F.col(p)) for p in texts})
    source = checkpointed(newest_per_key(source, keys, newest_by, null_safe))
    if not parts:
        replace(apply_newest(target, source, keys, update_map, null_safe), table, fmt)
        return

    touched = source.select(*parts).distinct()
    if not keys_fix_partition:
        sought = source.select(*keys).alias("s")
        old = target.alias("t").join(sought, key_matches("t", "s", keys, null_safe), "left_semi")
        touched = checkpointed(touched.union(old.select(*parts)).distinct())
    if touched.isEmpty():
        return
    here = [F.col(f"t.{p}").eqNullSafe(F.col(f"p.{p}")) for p in parts]
    read = target.alias("t").join(touched.alias("p"), here, "left_semi")
    merged = apply_newest(read, source, keys, update_map, null_safe).select(*target.columns)
    if not keys_fix_partition:
        merged = checkpointed(merged)
    rebalanced = merged.hint("rebalance", *[F.col(p) for p in parts])
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rebalanced.write.mode("overwrite").insertInto(table)
    if not keys_fix_partition:
        left = merged.select(*parts).distinct()
        empty = touched.alias("t").join(left.alias("p"), here, "left_anti")
        for row in empty.collect():  # partitions all of whose rows moved away
            _drop_partition(spark, table, parts, row)


def load_where(
    source: DataFrame,
    table: str,
    condition: str | Column,
    target_key: str | list[str],
    within: Within | None = None,
    fmt: str = "parquet",
) -> None:
    """First load creates the table, later loads ``upsert_where`` into it; a new version each time."""
    spark = source.sparkSession
    if not spark.catalog.tableExists(table):
        replace(source, table, fmt)
        return
    replace(upsert_where(spark.table(table), source, condition, target_key, within), table, fmt)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for the length of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _drop_partition(spark: SparkSession, table: str, parts: list[str], row) -> None:
    """Remove a partition whose rows have all moved to others."""
    spec = ", ".join(f"{p} = " + ("NULL" if row[p] is None else _quoted(row[p])) for p in parts)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _quoted(value) -> str:
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _versions(spark: SparkSession, table: str) -> list[int]:
    db, _, name = table.rpartition(".")
    prefix = f"{name}__v".lower()
    tables = spark.catalog.listTables(db) if db else spark.catalog.listTables()
    return sorted(
        int(t.name[len(prefix):])
        for t in tables
        if t.name.lower().startswith(prefix) and t.name[len(prefix):].isdigit()
    )


def replace(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    partition_by: str | list[str] = (),
    order_by: str | Column | list[str | Column] = (),
) -> None:
    """Full rebuild: write a new version, then point the view ``table`` at it.

    ``df`` may read the version it replaces.
    """
    spark = df.sparkSession
    number = (_versions(spark, table) or [0])[-1] + 1
    version = f"{table}__v{number:06d}"
    save(df, version, "error", fmt, partition_by, order_by=order_by)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {version}")


def drop_old_versions(spark: SparkSession, table: str, keep: int = 2) -> list[str]:
    """Drop all but the newest ``keep`` versions; call it when no reader is left on them."""
    old = [f"{table}__v{n:06d}" for n in _versions(spark, table)[:-keep]]
    for version in old:
        spark.sql(f"DROP TABLE {version}")
    return old


def future_view(spark: SparkSession, view: str, table: str, date: str, as_of: str | None = None):
    """A view of the rows dated after ``as_of``, or after the day of the query."""
    day = "current_date()" if as_of is None else f"DATE '{as_of}'"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table} WHERE {date} > {day}")
