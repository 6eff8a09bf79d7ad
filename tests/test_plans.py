"""What must hold of the physical plans at any size of data."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import catalog
from martloom.operators import dedupe, parents_without_children, share_of_max, upsert
from martloom.plans import marts as M

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Every join must stand without a small side."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def lineitem(spark):
    return spark.read.parquet(f"{SF_DIR}/lineitem.parquet")


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_pairwise_join_and_no_python(spark, no_broadcast, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in text


def test_dedupe_limits_groups_before_the_shuffle(spark):
    text = plan(dedupe(lineitem(spark), ["l_orderkey", "l_linenumber"], "l_shipdate"))
    assert re.search(r"WindowGroupLimit .*Final", text) and re.search(r"WindowGroupLimit .*Partial", text)
    assert text.count("Exchange hashpartitioning") == 1


def test_marts_do_not_put_groups_into_windows(spark, no_broadcast):
    lines = lineitem(spark)
    for df in (
        M.zscore_outliers(lines, "l_returnflag", "l_extendedprice", ["l_orderkey"]),
        M.alignment(lines, ["l_suppkey"], "l_returnflag"),
        M.concentration_index(lines, "l_suppkey", "l_returnflag", "l_partkey"),
        share_of_max(lines.groupBy("l_suppkey").agg(F.count("*").alias("n")), {"n": "share"}),
    ):
        assert "Window" not in plan(df)


def test_alignment_reads_the_votes_once(spark):
    assert plan(M.alignment(lineitem(spark), ["l_suppkey"], "l_returnflag")).count("FileScan") == 1


def test_upsert_of_a_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    target = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    target.filter("o_orderdate > '2001-07-01'").write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    text = plan(upsert(target, batch, "o_orderkey"))
    kept = text[text.index("BroadcastHashJoin") : text.index("BroadcastExchange")]
    assert "LeftAnti, BuildRight" in kept and "Exchange hash" not in kept


def test_filters_and_columns_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(orders.filter("o_orderstatus = 'F'").select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in text and "struct<o_orderkey:bigint,o_orderstatus:string>" in text
    wide = plan(entry.queries()["zscore_lines"](spark, SF_DIR))
    assert all("l_tax" not in schema for schema in re.findall(r"ReadSchema: (\S+)", wide))


def test_busy_parent_is_counted_once_before_the_join(spark, no_broadcast):
    lines = lineitem(spark)
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    text = plan(parents_without_children(orders, lines, {"o_orderkey": "l_orderkey"}))
    assert text.count("HashAggregate(keys=[l_orderkey") == 2
