"""Operators, one query each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import exact_mean, half_up, query, table
from martloom.functions import (
    blank_to_null,
    cast_losses,
    date_parts,
    digits_only,
    exact_percent,
    hash_key,
    money,
    money_sum,
    month_label,
    norm_text,
    parse_date,
    parse_timestamp,
    party_kind,
    rounded_money_mean,
    tax_id_or_name,
    trailing_id,
    typed_select,
    week_label,
)
from martloom.functions.dates import iso_year
from martloom.operators import (
    Dim,
    Period,
    calendar_between,
    conditional_counts,
    dedupe,
    dense_key,
    distinct_counts,
    distinct_ids,
    duplicate_keys,
    global_ranks,
    majority,
    match_report,
    open_history,
    parents_without_children,
    salted_join,
    scd2_apply,
    share_of_max,
    sorted_set,
    stable_key,
    star_join,
    top_n_per_group,
    upsert,
    upsert_where,
)
from martloom.sinks import add_audit, stamp

AS_OF = dt.datetime(2024, 3, 15, 12, 0)


# --- projections, functions -------------------------------------------------

@query(
    "typed_projection",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS order_key, CAST(o_custkey AS VARCHAR) AS customer,
           CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 0) AS BIGINT) AS whole_price,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_number,
           TRY_CAST(substr(o_orderpriority, 3) AS INTEGER) AS not_a_number,
           CAST(o_orderdate AS DATE) AS order_date
    FROM orders
    """,
)
def typed_projection(spark, d):
    return typed_select(
        table(spark, d, "orders"),
        [
            ("o_orderkey", "order_key", "int"),
            ("o_custkey", "customer", "string"),
            (F.round(money("o_totalprice"), 0), "whole_price", "bigint"),
            (F.substring("o_orderpriority", 1, 1), "priority_number", "int"),
            (F.expr("substring(o_orderpriority, 3)"), "not_a_number", "int"),
            ("o_orderdate", "order_date", "date"),
        ],
    )


@query(
    "cast_losses",
    """
    SELECT 'page_number' AS column_name,
           count(*) FILTER (WHERE TRY_CAST(split_part(url, '/', 5) AS BIGINT) IS NULL) AS lost_values
    FROM pages
    UNION ALL SELECT 'id', 0
    """,
)
def cast_losses_of_pages(spark, d):
    return cast_losses(
        table(spark, d, "pages"),
        [(F.split_part("url", F.lit("/"), F.lit(5)), "page_number", "bigint"), ("page_id", "id", "int")],
    )


@query(
    "date_parts",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y,
           CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(month(o_orderdate) AS INTEGER) AS m,
           CAST(week(o_orderdate) AS INTEGER) AS w, CAST(day(o_orderdate) AS INTEGER) AS dom,
           CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow,
           strftime(o_orderdate, '%Y-%m') AS month_text,
           CAST(isoyear(o_orderdate) AS VARCHAR) || '-'
             || lpad(CAST(week(o_orderdate) AS VARCHAR), 2, '0') AS iso_week_text,
           CAST(o_orderdate AS DATE) AS parsed_day,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS parsed_key
    FROM orders
    """,
)
def dates(spark, d):
    parts = {"year": "y", "quarter": "q", "month": "m", "iso_week": "w", "day": "dom", "weekday": "dow"}
    written = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")
    parsed = parse_timestamp(written)
    return table(spark, d, "orders").select(
        "o_orderkey",
        *date_parts("o_orderdate", parts),
        month_label(F.year("o_orderdate"), F.month("o_orderdate")).alias("month_text"),
        week_label(iso_year("o_orderdate"), F.weekofyear("o_orderdate")).alias("iso_week_text"),
        parse_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("parsed_day"),
        F.date_format(parsed, "yyyyMMdd").cast("int").alias("parsed_key"),
    )


@query(
    "uri_id",
    r"""
    SELECT page_id, TRY_CAST(regexp_extract(url, '(\d+)$', 1) AS BIGINT) AS trailing_number,
           TRY_CAST(regexp_extract(url, '/en/(\d+)', 1) AS BIGINT) AS english_number
    FROM pages
    """,
)
def uri_id(spark, d):
    from martloom.functions import id_after

    return table(spark, d, "pages").select(
        "page_id",
        trailing_id("url").alias("trailing_number"),
        id_after("url", "en").alias("english_number"),
    )


@query(
    "hash_keys",
    """
    SELECT o_orderkey,
           sha256(concat_ws('|', o_orderkey, o_custkey, CAST(o_orderdate AS DATE),
                  CAST(o_totalprice AS DECIMAL(18,2)), o_orderpriority)) AS order_hash,
           sha256(concat_ws('|', o_orderkey,
                  coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END, ''),
                  o_orderpriority)) AS with_gap,
           sha256(concat_ws('|', o_orderkey,
                  CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END,
                  o_orderpriority)) AS without_gap
    FROM orders
    """,
)
def hash_keys(spark, d):
    gap = F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))
    return table(spark, d, "orders").select(
        "o_orderkey",
        hash_key(
            "o_orderkey", "o_custkey", F.to_date("o_orderdate"), money("o_totalprice"), "o_orderpriority"
        ).alias("order_hash"),
        hash_key("o_orderkey", gap, "o_orderpriority").alias("with_gap"),
        hash_key("o_orderkey", gap, "o_orderpriority", skip_nulls=True).alias("without_gap"),
    )


@query(
    "supplier_natural_key",
    """
    SELECT page_id, host, digits, digit_count, natural_key, kind FROM (
      SELECT page_id, host, digits, length(digits) AS digit_count,
             CASE WHEN trim(digits) <> '' THEN digits ELSE host END AS natural_key,
             CASE length(digits) WHEN 14 THEN 'PJ' WHEN 11 THEN 'PF'
                  ELSE 'NAO_IDENTIFICADO' END AS kind
      FROM (SELECT page_id, split_part(url, '/', 3) AS host,
                   regexp_replace(url, '[^0-9]', '', 'g') AS digits FROM pages) p) k
    """,
)
def supplier_natural_key(spark, d):
    digits = digits_only("url")
    return (
        table(spark, d, "pages")
        .select(
            "page_id",
            F.split_part("url", F.lit("/"), F.lit(3)).alias("host"),
            digits.alias("digits"),
            F.length(digits).cast("bigint").alias("digit_count"),
        )
        .withColumn("natural_key", tax_id_or_name("digits", "host"))
        .withColumn("kind", party_kind("digits"))
    )


@query(
    "norm_text_join",
    """
    SELECT n.n_nationkey, r.r_regionkey, c.customers
    FROM nation n LEFT JOIN region r
      ON upper(trim('  ' || lower(n.name) || ' ')) = upper(trim(r.r_name || '  '))
    JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) c
      ON c.c_nationkey = n.n_nationkey
    """.replace("nation n", "(SELECT n_nationkey, r2.r_name AS name FROM nation "
                "JOIN region r2 ON n_regionkey = r2.r_regionkey) n"),
)
def norm_text_join(spark, d):
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    named = star_join(nation, Dim(region, [("n_regionkey", "r_regionkey")], {"r_name": "name"}))
    messy = named.withColumn("messy", F.concat(F.lit("  "), F.lower("name"), F.lit(" ")))
    padded = region.withColumn("padded", F.concat("r_name", F.lit("  ")))
    customers = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("customers"))
    return star_join(
        messy,
        Dim(padded, [(norm_text("messy"), norm_text("padded"))], ["r_regionkey"], "left"),
        Dim(customers, [("n_nationkey", "c_nationkey")], ["customers"]),
    ).select("n_nationkey", "r_regionkey", "customers")


@query(
    "fallback_chain",
    """
    SELECT doc_id, coalesce(CASE WHEN trim(l.label) <> '' THEN l.label END, d.source, d.lang) AS name
    FROM documents d LEFT JOIN (
      SELECT doc_id AS lab_id, CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE ' ' END
             AS label FROM labels) l ON d.doc_id = l.lab_id
    """,
)
def fallback_chain(spark, d):
    text = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise(" ")
    labels = table(spark, d, "labels").withColumn("label", text)
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    joined = star_join(docs, Dim(labels, [("doc_id", "doc_id")], ["label"], "left"))
    return joined.select(
        "doc_id", F.coalesce(blank_to_null("label"), "source", "lang").alias("name")
    )


@query(
    "calendar_days",
    """
    WITH days AS (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
                         INTERVAL 1 DAY)) AS DATE) AS date FROM orders),
         n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders GROUP BY 1)
    SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date,
           CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           strftime(date, '%B') AS month_name, CAST(quarter(date) AS INTEGER) AS quarter,
           strftime(date, '%Y-%m') AS year_month, CAST(week(date) AS INTEGER) AS iso_week,
           CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS weekday,
           strftime(date, '%A') AS weekday_name, dayofweek(date) IN (0, 6) AS is_weekend,
           date BETWEEN DATE '1998-08-01' AND DATE '1998-10-31' AS in_period,
           CASE WHEN date BETWEEN DATE '1998-08-01' AND DATE '1998-10-31'
                THEN 'campaign 1998' ELSE 'outside' END AS period_label,
           coalesce(n.orders, 0) AS orders
    FROM days LEFT JOIN n ON n.day = days.date
    """,
)
def calendar_days(spark, d):
    orders = table(spark, d, "orders")
    period = Period(dt.date(1998, 8, 1), dt.date(1998, 10, 31), "campaign 1998")
    counts = orders.groupBy(F.to_date("o_orderdate").alias("on")).agg(F.count("*").alias("n"))
    joined = star_join(
        calendar_between(orders, "o_orderdate", [period]),
        Dim(counts, [("date", "on")], ["n"], "left"),
    )
    return joined.withColumn("orders", F.coalesce("n", F.lit(0).cast("bigint"))).drop("n")


# --- deduplication, keys, ranks -----------------------------------------------

@query(
    "dedupe_lineitem",
    """
    SELECT * EXCLUDE (nth) FROM (
      SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
                 l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST,
                 l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST) AS nth
      FROM lineitem) t WHERE nth = 1
    """,
)
def dedupe_lineitem(spark, d):
    return dedupe(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "dense_key_parts",
    """
    SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS sk, p_partkey, p_name FROM part
    """,
)
def dense_key_parts(spark, d):
    return dense_key(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "sk")


@query(
    "dense_key_range_lineitem",
    """
    SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                              l_quantity, l_extendedprice) AS sk,
           l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
    FROM lineitem
    """,
)
def dense_key_range_lineitem(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return dense_key(rows, ["l_shipdate", "l_orderkey", "l_linenumber"], "sk")


@query(
    "stable_key_customers",
    """
    WITH first_load AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < DATE '1995-03-01'),
         held AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS sk FROM first_load),
         fresh AS (SELECT DISTINCT o_custkey FROM orders
                   WHERE o_custkey NOT IN (SELECT o_custkey FROM first_load))
    SELECT sk, o_custkey FROM held
    UNION ALL
    SELECT (SELECT max(sk) FROM held) + row_number() OVER (ORDER BY o_custkey), o_custkey FROM fresh
    """,
)
def stable_key_customers(spark, d):
    orders = table(spark, d, "orders")
    early = distinct_ids(orders.filter(F.col("o_orderdate") < F.lit(dt.date(1995, 3, 1))), "o_custkey")
    held = stable_key(early, None, "o_custkey", "sk")
    return stable_key(distinct_ids(orders, "o_custkey"), held, "o_custkey", "sk")


@query(
    "top_n_orders_per_customer",
    """
    SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (
      SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (
             PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
      FROM orders) t WHERE rank <= 3
    """,
)
def top_n_orders_per_customer(spark, d):
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return top_n_per_group(orders, "o_custkey", order, 3)


@query(
    "share_of_max",
    """
    WITH t AS (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent,
                      count(*) AS orders FROM orders GROUP BY 1)
    SELECT o_custkey, spent, orders, spent / (SELECT max(spent) FROM t) * 100 AS spent_share,
           orders / (SELECT max(orders) FROM t) * 100 AS order_share FROM t
    """,
)
def share_of_max_customers(spark, d):
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(
        money_sum("o_totalprice").cast("double").alias("spent"), F.count("*").alias("orders")
    )
    return share_of_max(spent, {"spent": "spent_share", "orders": "order_share"})


_RANK_SQL = """
    SELECT {key}, {score}, dense_rank() OVER (ORDER BY {score} DESC) AS dense,
           percent_rank() OVER (ORDER BY {score}) AS pct FROM {table}
"""


@query("global_ranks_orders", _RANK_SQL.format(key="o_orderkey", score="o_totalprice", table="orders"))
def global_ranks_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return global_ranks(orders, "o_totalprice", "dense", "pct")


@query(
    "global_ranks_histogram_orders",
    _RANK_SQL.format(key="o_orderkey", score="o_totalprice", table="orders"),
)
def global_ranks_histogram_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return global_ranks(orders, "o_totalprice", "dense", "pct")


@query(
    "global_ranks_range_orders",
    _RANK_SQL.format(key="o_orderkey", score="o_totalprice", table="orders"),
)
def global_ranks_range_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return global_ranks(orders, "o_totalprice", "dense", "pct")


@query(
    "global_ranks_range_quantity",
    _RANK_SQL.format(
        key="l_orderkey, l_linenumber, l_partkey, l_suppkey", score="l_quantity", table="lineitem"
    ),
)
def global_ranks_range_quantity(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return global_ranks(lines, "l_quantity", "dense", "pct")


# --- aggregates ---------------------------------------------------------------

@query(
    "conditional_counts",
    """
    SELECT user_id, count(*) AS events,
           count(*) FILTER (WHERE upper(event_type) = 'CLICK') AS clicks,
           count(*) FILTER (WHERE upper(event_type) = 'VIEW') AS views,
           count(*) FILTER (WHERE upper(event_type) = 'PURCHASE') AS purchases,
           count(*) FILTER (WHERE upper(event_type) = 'SIGNUP') AS signups,
           count(*) FILTER (WHERE upper(event_type) = 'ERROR') AS errors
    FROM events GROUP BY user_id
    """,
)
def conditional_counts_events(spark, d):
    kinds = {"clicks": "CLICK", "views": "VIEW", "purchases": "PURCHASE", "signups": "SIGNUP", "errors": "ERROR"}
    return table(spark, d, "events").groupBy("user_id").agg(
        F.count("*").alias("events"), *conditional_counts(F.upper("event_type"), kinds)
    )


@query(
    "distinct_counts",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1",
)
def distinct_parts(spark, d):
    return distinct_counts(table(spark, d, "lineitem"), "l_suppkey", "l_partkey", "parts")


@query(
    "sorted_set",
    """
    SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS brands
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1
    """,
)
def sorted_brands(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_partkey")
    branded = star_join(lines, Dim(table(spark, d, "part"), [("l_partkey", "p_partkey")], ["p_brand"]))
    brands = sorted_set(branded, "l_suppkey", "p_brand", "set")
    return brands.select("l_suppkey", F.array_join("set", ",").alias("brands"))


@query(
    "basic_aggregates",
    """
    SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           """ + exact_mean("o_totalprice") + """ AS mean,
           """ + half_up("stddev_samp(o_totalprice)", 2) + """ AS spread,
           min(o_totalprice) AS lowest, max(o_totalprice) AS highest,
           CAST(((count(*) FILTER (WHERE o_orderstatus = 'F')) * 20000 + count(*)) // (2 * count(*))
                AS DOUBLE) / 100 AS percent_f
    FROM orders GROUP BY 1
    """,
)
def basic_aggregates(spark, d):
    return (
        table(spark, d, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count("*").alias("orders"),
            F.count_distinct("o_custkey").alias("customers"),
            money_sum("o_totalprice").cast("double").alias("total"),
            rounded_money_mean("o_totalprice").alias("mean"),
            F.round(F.stddev_samp("o_totalprice"), 2).alias("spread"),
            F.min("o_totalprice").alias("lowest"),
            F.max("o_totalprice").alias("highest"),
            exact_percent(F.count_if(F.col("o_orderstatus") == "F"), F.count("*")).alias("percent_f"),
        )
    )


@query(
    "majority_event_type",
    """
    WITH h AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL),
         r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type NULLS FIRST)
               AS nth, sum(n) OVER (PARTITION BY user_id) AS total FROM h)
    SELECT user_id, event_type, n AS votes, CAST(total AS BIGINT) AS total FROM r WHERE nth = 1
    """,
)
def majority_event_type(spark, d):
    return majority(table(spark, d, "events"), "user_id", "event_type")


# --- joins, checks --------------------------------------------------------------

@query(
    "star_join_lineitem",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand, p_type, s_name,
           o_custkey, strftime(o_orderdate, '%Y-%m') AS order_month, c_mktsegment, n_name AS nation
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    """,
)
def star_join_lineitem(spark, d):
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    orders = table(spark, d, "orders").withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    return star_join(
        lines,
        Dim(table(spark, d, "supplier"), [("l_suppkey", "s_suppkey")], ["s_name"]),
        Dim(table(spark, d, "part"), [("l_partkey", "p_partkey")], ["p_brand", "p_type"]),
        Dim(orders, [("l_orderkey", "o_orderkey")], ["o_custkey", "order_month"]),
        Dim(table(spark, d, "customer"), [("o_custkey", "c_custkey")], ["c_mktsegment", "c_nationkey"]),
        Dim(table(spark, d, "nation"), [("c_nationkey", "n_nationkey")], {"n_name": "nation"}),
    ).drop("c_nationkey")


@query(
    "match_report",
    """
    SELECT 'finished_order' AS dimension,
           count(o_orderkey) AS matched_rows, count(*) - count(o_orderkey) AS dropped_rows
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o
      ON l_orderkey = o_orderkey
    UNION ALL
    SELECT 'part', count(p_partkey), count(*) - count(p_partkey)
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    """,
)
def match_report_lineitem(spark, d):
    finished = table(spark, d, "orders").filter("o_orderstatus = 'F'")
    return match_report(
        table(spark, d, "lineitem").select("l_orderkey", "l_partkey"),
        {
            "finished_order": Dim(finished, [("l_orderkey", "o_orderkey")]),
            "part": Dim(table(spark, d, "part"), [("l_partkey", "p_partkey")]),
        },
    )


@query(
    "salted_join_suppliers",
    """
    SELECT l_suppkey, p_brand, s_nationkey, count(*) AS lines
    FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
    GROUP BY ALL
    """,
)
def salted_join_suppliers(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey")
    branded = star_join(lines, Dim(table(spark, d, "part"), [("l_partkey", "p_partkey")], ["p_brand"]))
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    joined = salted_join(branded, suppliers, "l_suppkey", spread_by=["l_orderkey"], rows_per_task=500)
    return joined.groupBy("l_suppkey", "p_brand", "s_nationkey").agg(F.count("*").alias("lines"))


@query("distinct_ids", "SELECT DISTINCT o_custkey FROM orders")
def distinct_customer_ids(spark, d):
    return distinct_ids(table(spark, d, "orders"), "o_custkey")


@query(
    "parents_without_children",
    "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def orders_without_lines(spark, d):
    return parents_without_children(
        table(spark, d, "orders"), table(spark, d, "lineitem"), {"o_orderkey": "l_orderkey"}
    )


@query(
    "duplicate_keys",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY ALL HAVING count(*) > 1
    """,
)
def duplicate_line_keys(spark, d):
    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- upsert, history -------------------------------------------------------------

LOADED_UNTIL = dt.date(2000, 1, 1)
PULLED_FROM = dt.date(1999, 7, 1)

_PULL_SQL = """
    WITH target AS (SELECT * FROM orders WHERE o_orderdate < DATE '2000-01-01'),
         lines AS (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
                   AS price FROM lineitem GROUP BY 1),
         source AS (SELECT o.* REPLACE (coalesce(price, o_totalprice) AS o_totalprice,
                                        lower(o_orderstatus) AS o_orderstatus)
                    FROM orders o LEFT JOIN lines ON l_orderkey = o_orderkey
                    WHERE o_orderdate >= DATE '1999-07-01')
"""


def _pull(spark, d):
    """An initial load, and a later pull of a window that overlaps it.

    The pull holds every order twice: as first seen and as corrected.
    """
    orders = table(spark, d, "orders")
    target = orders.filter(F.col("o_orderdate") < F.lit(LOADED_UNTIL))
    lines = (
        table(spark, d, "lineitem")
        .groupBy("l_orderkey")
        .agg(money_sum("l_extendedprice").cast("double").alias("price"))
    )
    window = orders.filter(F.col("o_orderdate") >= F.lit(PULLED_FROM))
    corrected = star_join(window, Dim(lines, [("o_orderkey", "l_orderkey")], ["price"], "left"))
    corrected = corrected.withColumns(
        {
            "o_totalprice": F.coalesce("price", "o_totalprice"),
            "o_orderstatus": F.lower("o_orderstatus"),
            "pulled": F.lit(2),
        }
    ).drop("price")
    return target, window.withColumn("pulled", F.lit(1)).unionByName(corrected)


@query(
    "upsert_orders",
    _PULL_SQL + """
    SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM source)
    UNION ALL SELECT * FROM source
    """,
)
def upsert_orders(spark, d):
    target, source = _pull(spark, d)
    return upsert(target, source, "o_orderkey", newest_by="pulled")


@query(
    "upsert_partial",
    _PULL_SQL + """
    SELECT t.* REPLACE (coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice)
    FROM target t LEFT JOIN source s USING (o_orderkey)
    UNION ALL
    SELECT * FROM source WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)
    """,
)
def upsert_partial(spark, d):
    target, source = _pull(spark, d)
    return upsert(
        target, source, "o_orderkey", {"o_totalprice": "o_totalprice"}, newest_by="pulled"
    )


@query(
    "upsert_null_keys",
    """
    WITH old AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS kind,
                        count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY ALL),
         new AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS kind,
                        count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY ALL)
    SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new WHERE new.user_id = old.user_id
                                        AND new.kind IS NOT DISTINCT FROM old.kind)
    UNION ALL SELECT * FROM new
    """,
)
def upsert_null_keys(spark, d):
    kind = F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    events = table(spark, d, "events").select("user_id", kind, "ts")
    late = F.col("ts") >= F.lit(dt.date(2024, 1, 15))

    def counted(part):
        return part.groupBy("user_id", "kind").agg(F.count("*").alias("n"))

    return upsert(
        counted(events.filter(~late)), counted(events.filter(late)), ["user_id", "kind"], null_safe=True
    )


@query(
    "upsert_where",
    """
    WITH dest AS (SELECT o_custkey, max(o_totalprice) AS best FROM orders
                  WHERE o_orderdate < DATE '1998-01-01' GROUP BY 1),
         orig AS (SELECT o_custkey, max(o_totalprice) AS best FROM orders
                  WHERE o_orderdate >= DATE '1998-01-01' GROUP BY 1)
    SELECT dest.* FROM dest WHERE NOT EXISTS (
      SELECT 1 FROM orig WHERE dest.o_custkey = orig.o_custkey AND orig.best > dest.best)
    UNION ALL
    SELECT orig.* FROM orig JOIN dest ON dest.o_custkey = orig.o_custkey AND orig.best > dest.best
    UNION ALL
    SELECT orig.* FROM orig WHERE NOT EXISTS (
      SELECT 1 FROM dest WHERE dest.o_custkey = orig.o_custkey AND orig.best > dest.best)
    """,
)
def upsert_where_better(spark, d):
    orders = table(spark, d, "orders")
    late = F.col("o_orderdate") >= F.lit(dt.date(1998, 1, 1))

    def best(part):
        return part.groupBy("o_custkey").agg(F.max("o_totalprice").alias("best"))

    return upsert_where(
        best(orders.filter(~late)),
        best(orders.filter(late)),
        "dest.o_custkey = orig.o_custkey AND orig.best > dest.best",
        "o_custkey",
    )


SNAPSHOTS = [dt.date(1996, 1, 1), dt.date(1998, 6, 1), dt.date(2001, 6, 1)]


@query(
    "scd2_customers",
    """
    WITH days AS (SELECT unnest([DATE '1996-01-01', DATE '1998-06-01', DATE '2001-06-01']) AS as_of),
         ranked AS (
           SELECT o_custkey, as_of, o_orderpriority, count(*) OVER (PARTITION BY as_of, o_custkey) AS n,
                  row_number() OVER (PARTITION BY as_of, o_custkey
                                     ORDER BY o_orderdate DESC, o_orderkey DESC) AS nth
           FROM orders JOIN days ON o_orderdate < as_of),
         snaps AS (SELECT o_custkey, as_of, o_orderpriority, n FROM ranked WHERE nth = 1),
         flagged AS (SELECT *, CASE WHEN lag(o_orderpriority) OVER w = o_orderpriority THEN 0 ELSE 1 END
                     AS starts FROM snaps WINDOW w AS (PARTITION BY o_custkey ORDER BY as_of)),
         runs AS (SELECT *, sum(starts) OVER (PARTITION BY o_custkey ORDER BY as_of) AS run FROM flagged),
         versions AS (SELECT o_custkey, run, min(o_orderpriority) AS last_priority,
                             arg_max(n, as_of) AS orders, min(as_of) AS valid_from
                      FROM runs GROUP BY o_custkey, run)
    SELECT o_custkey, last_priority, orders, valid_from,
           lead(valid_from) OVER v AS valid_to, lead(valid_from) OVER v IS NULL AS is_current
    FROM versions WINDOW v AS (PARTITION BY o_custkey ORDER BY run)
    """,
)
def scd2_customers(spark, d):
    orders = table(spark, d, "orders")

    def snapshot(day):
        latest = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderpriority"))
        return (
            orders.filter(F.col("o_orderdate") < F.lit(day))
            .groupBy("o_custkey")
            .agg(latest.alias("latest"), F.count("*").alias("orders"))
            .select("o_custkey", F.col("latest.o_orderpriority").alias("last_priority"), "orders")
        )

    history = open_history(snapshot(SNAPSHOTS[0]), SNAPSHOTS[0])
    for day in SNAPSHOTS[1:]:
        history = scd2_apply(history, snapshot(day), "o_custkey", "last_priority", day)
    return history


# --- audit -----------------------------------------------------------------------

@query(
    "audit_columns",
    """
    SELECT o_orderkey, 'batch-1' AS batch_id, '/orders' AS source_endpoint, '1.0' AS pipeline_version,
           CAST(2024 AS INTEGER) AS ano_ingestao, CAST(3 AS INTEGER) AS mes_ingestao,
           DATE '2024-03-15' AS ingested_on, 'silver' AS source_layer, 'landed' AS source_system
    FROM orders
    """,
)
def audit_columns(spark, d):
    audited = add_audit(
        table(spark, d, "orders").select("o_orderkey"), "/orders", "batch-1", "1.0", AS_OF
    )
    stamped = stamp(audited, "1.0", AS_OF, "silver", "landed")
    return stamped.withColumn("ingested_on", F.to_date("ingested_at")).drop("ingested_at", "updated_at")
