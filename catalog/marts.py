"""Marts with their columns taken from the trading tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.registry import exact_mean, half_up, query, table
from martloom.functions import month_label
from martloom.operators import Dim, Period, calendar_between, in_any_period, period_of, star_join
from martloom.plans import marts as M

AS_OF = dt.date(2000, 6, 30)


def _branded_lines(spark, d, *columns):
    lines = table(spark, d, "lineitem").select("l_partkey", *columns)
    return star_join(lines, Dim(table(spark, d, "part"), [("l_partkey", "p_partkey")], ["p_brand", "p_type"]))


@query(
    "top_n_monthly",
    """
    WITH totals AS (
      SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
             strftime(l_shipdate, '%Y-%m') AS year_month, n_name AS nation,
             count(DISTINCT o_custkey) AS members, count(*) AS rows,
             CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY year_month ORDER BY total DESC, nation)
                   AS INTEGER) AS rank FROM totals) t WHERE rank <= 10
    """,
)
def top_n_monthly(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_extendedprice")
    facts = star_join(
        lines,
        Dim(table(spark, d, "orders"), [("l_orderkey", "o_orderkey")], ["o_custkey"]),
        Dim(table(spark, d, "customer"), [("o_custkey", "c_custkey")], ["c_nationkey"]),
        Dim(table(spark, d, "nation"), [("c_nationkey", "n_nationkey")], {"n_name": "nation"}),
    ).select(
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        "nation",
        "o_custkey",
        "l_extendedprice",
    )
    top = M.top_n_monthly(facts, "nation", ["year", "month"], "l_extendedprice", "o_custkey")
    return top.withColumn("year_month", month_label("year", "month"))


_HHI_SQL = """
    WITH c AS ({members}),
         s AS (SELECT g, CAST(sum(n) AS BIGINT) AS members, count(category) AS categories,
                      sum(CAST(n AS DOUBLE) * n) / (sum(CAST(n AS DOUBLE)) * sum(CAST(n AS DOUBLE))) AS x
               FROM c GROUP BY g),
         i AS (SELECT g, members, categories, """ + half_up("x", 4) + """ AS hhi FROM s)
    SELECT g AS {group}, members, categories, hhi,
           CASE WHEN hhi <= 0.15 THEN 'Alta diversidade' WHEN hhi <= 0.25 THEN 'Média diversidade'
                ELSE 'Baixa diversidade' END AS diversity_band FROM i
"""


@query(
    "concentration_suppliers",
    _HHI_SQL.format(
        group="l_suppkey",
        members="SELECT l_suppkey AS g, p_brand AS category, count(DISTINCT l_partkey) AS n "
        "FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL",
    ),
)
def concentration_suppliers(spark, d):
    return M.concentration_index(_branded_lines(spark, d, "l_suppkey"), "l_suppkey", "p_brand", "l_partkey")


@query(
    "concentration_customers",
    _HHI_SQL.format(
        group="o_custkey",
        members="SELECT o_custkey AS g, o_orderpriority AS category, count(DISTINCT o_orderkey) AS n "
        "FROM orders GROUP BY ALL",
    ),
)
def concentration_customers(spark, d):
    return M.concentration_index(
        table(spark, d, "orders"), "o_custkey", "o_orderpriority", "o_orderkey"
    )


@query(
    "participation",
    """
    SELECT l_suppkey, count(DISTINCT l_partkey) AS parts,
           array_to_string(list_sort(list(DISTINCT p_brand)), ',') AS brands
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1
    """,
)
def participation(spark, d):
    ranked = M.participation_ranking(
        _branded_lines(spark, d, "l_suppkey"), "l_suppkey", "l_partkey", "p_brand", "parts", "set"
    )
    return ranked.select("l_suppkey", "parts", F.array_join("set", ",").alias("brands"))


@query(
    "event_star",
    """
    WITH bridge AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key, s_suppkey, s_name,
           n_name AS nation, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month, CAST(week(o_orderdate) AS INTEGER) AS iso_week
    FROM orders JOIN bridge ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    """,
)
def event_star(spark, d):
    return _event_star(spark, d)


def _event_star(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_day"), "o_orderstatus"
    )
    bridge = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    return star_join(
        orders,
        Dim(
            calendar_between(orders, "order_day"),
            [("order_day", "date")],
            ["date_key", "year", "month", "iso_week"],
        ),
        Dim(bridge, [("o_orderkey", "l_orderkey")], {"l_suppkey": "s_suppkey"}),
        Dim(table(spark, d, "supplier"), [("s_suppkey", "s_suppkey")], ["s_name", "s_nationkey"]),
        Dim(table(spark, d, "nation"), [("s_nationkey", "n_nationkey")], {"n_name": "nation"}),
    ).drop("s_nationkey")


@query(
    "future_events",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, o_orderstatus FROM orders
    WHERE CAST(o_orderdate AS DATE) > DATE '2000-06-30'
    """,
)
def future_orders(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_day"), "o_orderstatus"
    )
    return M.future_events(orders, "order_day", AS_OF)


_WEEK_SQL = """
    WITH days AS (SELECT CAST(unnest(generate_series(date_trunc('day', min(o_orderdate)), max(o_orderdate),
                         INTERVAL 1 DAY)) AS DATE) AS date FROM orders)
    SELECT CAST({year}(date) AS INTEGER) AS year, CAST(week(date) AS INTEGER) AS iso_week,
           CAST({year}(date) AS VARCHAR) || '-' || lpad(CAST(week(date) AS VARCHAR), 2, '0') AS year_week,
           count(DISTINCT o_orderkey) AS events, count(DISTINCT o_orderkey) > 0 AS has_events
    FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date GROUP BY ALL
"""


def _density(spark, d, iso_years):
    orders = table(spark, d, "orders")
    return M.weekly_density(calendar_between(orders, "o_orderdate"), orders, "o_orderdate", "o_orderkey", iso_years)


@query("weekly_density", _WEEK_SQL.format(year="year"))
def weekly_density(spark, d):
    return _density(spark, d, False)


@query("weekly_density_iso_year", _WEEK_SQL.format(year="isoyear"))
def weekly_density_iso_year(spark, d):
    return _density(spark, d, True)


@query(
    "period_comparison",
    """
    SELECT year, in_period, period_label, o_orderpriority, events,
           """ + half_up("events / weeks", 2) + """ AS events_per_week, units
    FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
                 CAST(o_orderdate AS DATE) BETWEEN DATE '1998-08-01' AND DATE '1998-10-31' AS in_period,
                 CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-08-01' AND DATE '1998-10-31'
                      THEN 'campaign 1998' ELSE 'outside' END AS period_label,
                 o_orderpriority, count(DISTINCT o_orderkey) AS events,
                 count(DISTINCT week(o_orderdate)) AS weeks, count(DISTINCT l_suppkey) AS units
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) t
    """,
)
def period_comparison(spark, d):
    periods = [Period(dt.date(1998, 8, 1), dt.date(1998, 10, 31), "campaign 1998")]
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.year("o_orderdate").alias("year"),
        F.weekofyear("o_orderdate").alias("iso_week"),
        in_any_period(F.to_date("o_orderdate"), periods).alias("in_period"),
        period_of(F.to_date("o_orderdate"), periods, "outside").alias("period_label"),
    )
    attributes = ["o_orderpriority", "year", "iso_week", "in_period", "period_label"]
    dated = star_join(lines, Dim(orders, [("l_orderkey", "o_orderkey")], attributes))
    keys = ["year", "in_period", "period_label", "o_orderpriority"]
    return M.period_comparison(dated, keys, "l_orderkey", "iso_week", "l_suppkey")


@query(
    "attendance_rate",
    """
    WITH e AS (SELECT user_id, CAST(week(ts) AS INTEGER) AS iso_week, event_type, CAST(ts AS DATE) AS day
               FROM events),
         a AS (SELECT user_id, iso_week, event_type, count(DISTINCT day) AS attended FROM e GROUP BY ALL),
         t AS (SELECT iso_week, event_type, count(DISTINCT day) AS total FROM e GROUP BY ALL)
    SELECT iso_week, event_type, user_id, attended, total,
           """ + half_up("attended / total", 4) + """ AS attendance_rate,
           """ + half_up("attended / total * 100", 2) + """ AS attendance_percent
    FROM a JOIN t USING (iso_week, event_type)
    """,
)
def attendance_rate(spark, d):
    days = table(spark, d, "events").select(
        "user_id",
        F.concat_ws("|", "event_type", F.to_date("ts")).alias("meeting"),
        F.weekofyear("ts").alias("iso_week"),
        "event_type",
    )
    meetings = days.select("meeting", "iso_week", "event_type").distinct()
    return M.attendance_rate(days, meetings, "user_id", "meeting", "iso_week", "event_type")


_Z_SQL = """
    WITH s AS (SELECT {group}, avg({value}) AS mean, """ + exact_mean("{value}") + """ AS group_mean,
                      stddev_samp({value}) AS sd FROM {table}
               GROUP BY ALL HAVING stddev_samp({value}) > 0),
         z AS (SELECT {keep}, {group}, """ + half_up("{value}", 2) + """ AS {value},
                      group_mean, """ + half_up("sd", 2) + """ AS group_stddev,
                      """ + half_up("({value} - mean) / sd", 2) + """ AS z_score
               FROM {table} JOIN s USING ({group}))
    SELECT *, CASE WHEN abs(z_score) < 1 THEN 'Comportamento esperado'
                   WHEN abs(z_score) < 2 THEN 'Leve desvio' WHEN abs(z_score) < 3 THEN 'Atenção'
                   WHEN abs(z_score) < 4 THEN 'Possível anomalia' ELSE 'Muito atípico' END AS outlier_band
    FROM z
"""


@query(
    "zscore_events",
    _Z_SQL.format(group="event_type", value="value", keep="event_id", table="events"),
)
def zscore_events(spark, d):
    return M.zscore_outliers(
        table(spark, d, "events"), "event_type", "value", ["event_id"], amounts=True
    )


@query(
    "zscore_lines",
    _Z_SQL.format(
        group="p_type, l_returnflag",
        value="l_extendedprice",
        keep="l_orderkey, l_linenumber, l_partkey",
        table="(SELECT * FROM lineitem JOIN part ON p_partkey = l_partkey)",
    ),
)
def zscore_lines(spark, d):
    lines = _branded_lines(spark, d, "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    keep = ["l_orderkey", "l_linenumber", "l_partkey"]
    return M.zscore_outliers(lines, ["p_type", "l_returnflag"], "l_extendedprice", keep, amounts=True)


# The majority is the highest bar of a ballot's histogram; blank votes agree with nobody, but win against as many others.
_ALIGN_SQL = """
    WITH ballots AS (SELECT {group}, year_month, count(*) AS total, count(*) - count(choice) AS blank,
                            CAST(list_max(map_values(histogram(choice))) AS BIGINT) AS most
                     FROM ({base}) GROUP BY ALL),
         p AS (SELECT {group}, year_month, total, CASE WHEN most > blank THEN most ELSE 0 END AS aligned,
                      CAST((aligned * 20000 + total) // (2 * total) AS DOUBLE) / 100 AS percent_aligned FROM ballots)
"""
_ALIGN_OUT = """
    SELECT *, (['Baixo', 'Médio', 'Alto'])[1 + CAST(percent_aligned >= 60 AS INTEGER) + CAST(percent_aligned >= 80 AS INTEGER)]
      AS alignment_band FROM p
"""
_COHESION_OUT = """
    , c AS (SELECT nation, count(*) AS ballots, """ + exact_mean("percent_aligned") + """ AS mean_alignment,
                   min(percent_aligned) AS min_alignment, max(percent_aligned) AS max_alignment,
                   stddev_samp(percent_aligned) AS sd FROM p GROUP BY nation)
    SELECT nation, ballots, mean_alignment, min_alignment, max_alignment,
           CASE WHEN mean_alignment >= 80 THEN 'Muito Coesa' WHEN mean_alignment >= 60 THEN 'Coesa'
                ELSE 'Fragmentada' END AS cohesion_band,
           """ + half_up("sd", 2) + """ AS stddev_alignment,
           CASE WHEN sd < 10 THEN 'Sim' ELSE 'Não' END AS has_low_spread FROM c
"""
_NATION_VOTES = _ALIGN_SQL.format(
    group="nation",
    base="SELECT n_name AS nation, strftime(o_orderdate, '%Y-%m') AS year_month, o_orderstatus AS choice "
    "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey",
)
_BRAND_VOTES = _ALIGN_SQL.format(
    group="p_brand",
    base="SELECT p_brand, strftime(l_shipdate, '%Y-%m') AS year_month, "
    "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS choice "
    "FROM lineitem JOIN part ON p_partkey = l_partkey",
)


def _nation_alignment(spark, d):
    orders = table(spark, d, "orders").select(
        "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("year_month"), "o_orderstatus"
    )
    votes = star_join(
        orders,
        Dim(table(spark, d, "customer"), [("o_custkey", "c_custkey")], ["c_nationkey"]),
        Dim(table(spark, d, "nation"), [("c_nationkey", "n_nationkey")], {"n_name": "nation"}),
    )
    return M.alignment(votes, ["nation", "year_month"], "o_orderstatus")


@query("alignment_nations", _NATION_VOTES + _ALIGN_OUT)
def alignment_nations(spark, d):
    return _nation_alignment(spark, d)


@query("alignment_brands_with_null_votes", _BRAND_VOTES + _ALIGN_OUT)
def alignment_brands(spark, d):
    votes = _branded_lines(spark, d, "l_shipdate", "l_returnflag").select(
        "p_brand",
        F.date_format("l_shipdate", "yyyy-MM").alias("year_month"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("choice"),
    )
    return M.alignment(votes, ["p_brand", "year_month"], "choice")


@query("cohesion_nations", _NATION_VOTES + _COHESION_OUT)
def cohesion_nations(spark, d):
    return M.cohesion(_nation_alignment(spark, d), "nation")


_SCORE_SQL = """
    WITH deeds AS (SELECT o_custkey AS who, 'E' || CAST(o_orderdate AS DATE) AS deed, NULL AS kind FROM orders
                   UNION ALL SELECT o_custkey, 'B' || l_partkey, upper(o_orderstatus) FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
         counted AS (SELECT who, count(DISTINCT deed) FILTER (deed[1] = 'E') AS events,
                            count(DISTINCT deed) FILTER (deed[1] = 'B') AS ballots, count(*) FILTER (kind = 'F') AS finished,
                            count(*) FILTER (kind = 'O') AS open, count(*) FILTER (kind = 'P') AS pending
                     FROM deeds GROUP BY who HAVING events > 0 AND ballots > 0),
         known AS (SELECT c_custkey, c_name, c_nationkey, counted.* EXCLUDE (who) FROM counted JOIN customer ON c_custkey = who),
         top AS (SELECT max(events) AS e, max(ballots) AS b FROM known),
         s AS (SELECT known.*, (events / e * 100) * 0.4::DOUBLE + (ballots / b * 100) * 0.6::DOUBLE AS score FROM known, top)
"""


def _scores(spark, d):
    orders = table(spark, d, "orders")
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"
    )
    presence = orders.select("o_custkey", F.to_date("o_orderdate").alias("day"))
    votes = star_join(
        table(spark, d, "lineitem").select("l_orderkey", "l_partkey"),
        Dim(orders, [("l_orderkey", "o_orderkey")], ["o_custkey", "o_orderstatus"]),
    )
    return M.engagement_score(
        customers,
        presence,
        votes,
        "o_custkey",
        ["c_name", "c_nationkey"],
        "day",
        "l_partkey",
        "o_orderstatus",
        {"finished": "F", "open": "O", "pending": "P"},
    )


@query(
    "engagement_customers",
    _SCORE_SQL + """
    SELECT c_custkey AS o_custkey, c_name, c_nationkey, events, ballots, finished, open, pending, score,
           dense_rank() OVER (ORDER BY score DESC) AS rank,
           percent_rank() OVER (ORDER BY score) AS percentile FROM s
    """,
)
def engagement_customers(spark, d):
    return _scores(spark, d)


@query(
    "engagement_by_nation",
    _SCORE_SQL + """
    , g AS (SELECT c_nationkey, count(*) AS members, avg(score) AS m, max(score) AS hi, min(score) AS lo
            FROM s GROUP BY 1)
    SELECT c_nationkey, members, """ + half_up("m", 2) + """ AS mean_score,
           """ + half_up("hi", 2) + """ AS max_score, """ + half_up("lo", 2) + """ AS min_score,
           dense_rank() OVER (ORDER BY m DESC) AS rank,
           CASE WHEN m >= 80 THEN 'Alto' WHEN m >= 60 THEN 'Médio' ELSE 'Baixo' END AS score_band FROM g
    """,
)
def engagement_by_nation(spark, d):
    return M.engagement_by_group(_scores(spark, d), "c_nationkey")


@query(
    "roster",
    """
    SELECT DISTINCT l_suppkey, l_partkey, s_name, s_nationkey, p_name, p_brand
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
    JOIN part ON l_partkey = p_partkey
    """,
)
def roster(spark, d):
    pairs = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    solvent = table(spark, d, "supplier").filter("s_acctbal > 0")
    return star_join(
        pairs,
        Dim(solvent, [("l_suppkey", "s_suppkey")], ["s_name", "s_nationkey"]),
        Dim(table(spark, d, "part"), [("l_partkey", "p_partkey")], ["p_name", "p_brand"]),
    )


@query(
    "status_flags",
    """
    WITH e AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_day,
                      CASE WHEN o_orderstatus <> 'O' THEN max(CAST(l_shipdate AS DATE)) END AS end_day
               FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
               GROUP BY o_orderkey, o_orderdate, o_orderstatus)
    SELECT o_orderkey, start_day, end_day,
           CASE WHEN end_day IS NULL OR end_day >= DATE '2000-06-30' THEN 'Em andamento'
                ELSE 'Encerrada' END AS status,
           CASE WHEN start_day IS NOT NULL THEN 'Sim' ELSE 'Não' END AS has_start,
           CASE WHEN end_day IS NOT NULL THEN 'Sim' ELSE 'Não' END AS has_end
    FROM e
    """,
)
def status_flags(spark, d):
    last = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.to_date("l_shipdate")).alias("last")
    )
    orders = star_join(
        table(spark, d, "orders"), Dim(last, [("o_orderkey", "l_orderkey")], ["last"], "left")
    )
    dated = orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("start_day"),
        F.when(F.col("o_orderstatus") != "O", F.col("last")).alias("end_day"),
    ).withColumn("status", M.open_status("end_day", AS_OF))
    return M.inquiry_catalog(dated, "start_day", "end_day")
