"""Time the headline queries; prints one JSON line.

Tables come from $BENCH_SF_DIR, threads from $BENCH_CPUS. Each query runs
once to warm up, then $BENCH_RUNS times into the noop sink; the middle time
counts. The legislative tables include the making of their stand-in records. ``python bench.py naive`` times the plain forms of the rewritten
operators instead, for comparison.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import Window
from pyspark.sql import functions as F

import catalog
from catalog.registry import table
from martloom.operators import dedupe, dense_key, global_ranks, share_of_max
from martloom.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "top_n_monthly",
    "star_join_lineitem",
    "alignment_brands_with_null_votes",
    "alignment_nations",
    "cohesion_nations",
    "concentration_suppliers",
    "participation",
    "zscore_lines",
    "attendance_rate",
    "weekly_density",
    "period_comparison",
    "engagement_customers",
    "engagement_by_nation",
    "dedupe_lineitem",
    "top_n_orders_per_customer",
    "upsert_orders",
    "upsert_partial",
    "scd2_customers",
    "event_star",
    "roster",
    "json_decode_events",
    "status_flags",
    "share_of_max",
    "json_explode_pages",
    "quarantine_passed",
    "silver_dim_evento",
    "silver_despesas",
    "silver_votos",
    "gold_eventos",
    "gold_comparativo_periodo",
    "gold_fat_despesas",
    "gold_top_gastos_partido",
    "gold_anomalias_despesas",
    "gold_frentes_votacoes",
    "gold_engajamento_deputado",
]


def lineitem(spark, d):
    return table(spark, d, "lineitem")


def operators(spark, d):
    """The operators of the baseline table, as built."""
    return {
        "op_share_of_max": lambda: share_of_max(lineitem(spark, d), {"l_extendedprice": "share"}),
        "op_ranks_few_values": lambda: global_ranks(lineitem(spark, d), "l_quantity", "dense", "pct"),
        "op_ranks_many_values": lambda: global_ranks(lineitem(spark, d), "l_extendedprice", "dense", "pct"),
        "op_dense_key": lambda: dense_key(lineitem(spark, d), ["l_shipdate", "l_orderkey"], "sk"),
        "op_dedupe": lambda: dedupe(lineitem(spark, d), ["l_orderkey", "l_linenumber"], "l_shipdate"),
    }


def naive(spark, d):
    """The same results as written without regard to scale."""

    def everything():
        return Window.partitionBy()

    def ranks(score):
        return lineitem(spark, d).select(
            "*",
            F.dense_rank().over(Window.orderBy(F.col(score).desc())).alias("dense"),
            F.percent_rank().over(Window.orderBy(score)).alias("pct"),
        )

    def alignment():
        part = table(spark, d, "part").select("p_partkey", "p_brand")
        base = lineitem(spark, d).join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            "p_brand", F.date_format("l_shipdate", "yyyy-MM").alias("ym"), "l_returnflag"
        )
        votes = base.groupBy("p_brand", "ym", "l_returnflag").count()
        ballot = Window.partitionBy("p_brand", "ym")
        ranked = votes.select("*", F.sum("count").over(ballot).alias("total"), F.max("count").over(ballot).alias("aligned"))
        return ranked.select("p_brand", "ym", "total", "aligned").distinct()

    def concentration():
        part = table(spark, d, "part").select("p_partkey", "p_brand")
        pairs = lineitem(spark, d).join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", "p_brand", "l_partkey")
        shares = pairs.distinct().groupBy("l_suppkey", "p_brand").count()
        share = F.col("count") / F.sum("count").over(Window.partitionBy("l_suppkey"))
        squared = shares.select("l_suppkey", "count", (share * share).alias("square")).groupBy("l_suppkey")
        return squared.agg(F.sum("count").alias("total"), F.count("*").alias("brands"), F.round(F.sum("square"), 4).alias("hhi"))

    def engagement():
        orders, customer = table(spark, d, "orders"), table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
        days = orders.groupBy("o_custkey").agg(F.countDistinct(F.to_date("o_orderdate")).alias("events"))
        status = F.upper("o_orderstatus")
        votes = lineitem(spark, d).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey")
        votes = votes.agg(F.countDistinct("l_partkey").alias("ballots"), *[F.count_if(status == k).alias(k) for k in "FOP"])
        rows = customer.join(days, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")
        rows = rows.join(votes, F.col("c_custkey") == F.col("o_custkey"))
        most = [F.col(c) / F.max(c).over(everything()) for c in ("events", "ballots")]
        rows = rows.withColumn("score", most[0] * 40 + most[1] * 60)
        up, down = Window.orderBy("score"), Window.orderBy(F.col("score").desc())
        return rows.select("*", F.dense_rank().over(down).alias("rank"), F.percent_rank().over(up).alias("pct"))

    def zscore():
        w = Window.partitionBy("p_type", "l_returnflag")
        part = table(spark, d, "part").select("p_partkey", "p_type")
        joined = lineitem(spark, d).join(part, F.col("l_partkey") == F.col("p_partkey"))
        price = F.col("l_extendedprice")
        return joined.withColumn("z", (price - F.avg(price).over(w)) / F.stddev_samp(price).over(w))

    def sql(text):
        for name in ("lineitem", "orders", "customer", "nation", "part", "events"):
            table(spark, d, name).createOrReplaceTempView(name)
        return spark.sql(text)

    order = Window.orderBy("l_shipdate", "l_orderkey")
    return {
        "top_n_monthly": lambda: sql("""
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ym ORDER BY total DESC) AS rank
            FROM (SELECT year(l_shipdate) AS y, month(l_shipdate) AS m,
                         date_format(l_shipdate, 'yyyy-MM') AS ym, n_name,
                         count(DISTINCT o_custkey) AS members, count(*) AS n,
                         round(sum(l_extendedprice), 2) AS total
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                  GROUP BY 1, 2, 3, 4)) WHERE rank <= 10"""),
        "concentration_suppliers": concentration,
        "participation": lambda: sql("""
            SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, collect_set(p_brand) AS brands
            FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""),
        "engagement_customers": engagement,
        "weekly_density": lambda: sql("""
            WITH days AS (SELECT explode(sequence(DATE'1995-01-01', DATE'2002-12-31', INTERVAL 1 DAY)) AS day)
            SELECT year(day) AS y, weekofyear(day) AS w, count(DISTINCT o_orderkey) AS events
            FROM days LEFT JOIN orders ON to_date(o_orderdate) = day GROUP BY 1, 2"""),
        "attendance_rate": lambda: sql("""
            WITH e AS (SELECT user_id, weekofyear(ts) AS w, event_type,
                              concat_ws('|', event_type, to_date(ts)) AS meeting FROM events),
                 t AS (SELECT w, event_type, count(DISTINCT meeting) AS total FROM e GROUP BY 1, 2),
                 a AS (SELECT user_id, w, event_type, count(DISTINCT meeting) AS attended FROM e GROUP BY 1, 2, 3)
            SELECT a.*, total, round(attended / total, 4) AS rate, round(attended / total * 100, 2) AS pct
            FROM a JOIN t ON a.w = t.w AND a.event_type = t.event_type"""),
        "op_share_of_max": lambda: lineitem(spark, d).withColumn(
            "share", F.col("l_extendedprice") / F.max("l_extendedprice").over(everything()) * 100
        ),
        "op_ranks_few_values": lambda: ranks("l_quantity"),
        "op_ranks_many_values": lambda: ranks("l_extendedprice"),
        "op_dense_key": lambda: lineitem(spark, d).withColumn("sk", F.row_number().over(order)),
        "op_dedupe": lambda: lineitem(spark, d).dropDuplicates(["l_orderkey", "l_linenumber"]),
        "alignment_brands_with_null_votes": alignment,
        "zscore_lines": zscore,
    }


def seconds(build) -> float:
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="run-bench-")
    spark = get_session(
        "bench",
        spark__master=f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="8g",
        spark__checkpoint__dir=f"{scratch}/checkpoint",
    )
    spark.sparkContext.setLogLevel("ERROR")
    if "naive" in sys.argv[1:]:
        builds = naive(spark, SF_DIR)
    else:
        builds = {n: lambda n=n: catalog.QUERIES[n](spark, SF_DIR) for n in HEADLINE}
        builds.update(operators(spark, SF_DIR))
    queries = {name: seconds(build) for name, build in builds.items()}
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
