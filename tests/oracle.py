"""Run a query in Spark and its oracle in DuckDB and say how they differ.

``python -m tests.oracle [sf_dir] [name ...]`` checks registered queries.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(value) -> str:
    return type(value).__name__


def _key(row):
    return tuple((v is None, str(type(v).__name__), str(v)) for v in row)


def difference(spark_df, con, sql: str) -> str | None:
    """None when names, row count and all values agree, else the first difference."""
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != names:
        return f"columns {names} != {sorted(columns)}"
    places = [columns.index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in places) for r in result.fetchall()), key=_key)
    ours = sorted((tuple(r) for r in spark_df.select(*names).collect()), key=_key)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if not _same(a, b)]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ in {names}: {bad[0][0]} != {bad[0][1]}"
    return None


def _same(a, b) -> bool:
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y):
            continue
        if x != y or (x is not None and _kind(x) != _kind(y)):
            return False
    return True


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = argv[1:] or list(queries)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in wanted:
        start = time.time()
        try:
            problem = difference(queries[name](spark, sf_dir), con, oracles[name])
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - failed} of {len(wanted)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
