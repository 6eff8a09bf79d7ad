import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.functions import money_sum
from martloom.operators import (
    Dim,
    assert_unique,
    calendar,
    majority,
    match_report,
    require_rows,
    salted_join,
    sorted_set,
    star_join,
)
from martloom.plans import marts as M
from martloom.plans.legislative import schemas as S
from martloom.plans.legislative import silver as L
from tests.conftest import rows


def votes(spark, *data):
    return spark.createDataFrame(list(data), "g string, v string")


def test_majority_ties_and_nulls(spark):
    df = votes(
        spark, ("t", "B"), ("t", "A"), ("n", None), ("n", None), ("n", "A"), ("tn", None), ("tn", "A"), ("s", "X")
    )
    got = rows(majority(df, "g", "v"), "g", "v", "votes", "total")
    assert got == [("n", None, 2, 3), ("s", "X", 1, 1), ("t", "A", 1, 2), ("tn", None, 1, 2)]


def test_alignment_bands_and_null_majority(spark):
    data = [("p60", "A")] * 3 + [("p60", "B")] * 2 + [("p80", "A")] * 4 + [("p80", "B")]
    data += [("null", None)] * 2 + [("null", "A")] + [("one", "A")]
    got = rows(M.alignment(votes(spark, *data), "g", "v"))
    assert got == [
        ("null", 0, 3, 0.0, "Baixo"),
        ("one", 1, 1, 100.0, "Alto"),
        ("p60", 3, 5, 60.0, "Médio"),
        ("p80", 4, 5, 80.0, "Alto"),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_alignment_equals_two_pass_form(spark, seed):
    rng = random.Random(seed)
    data = [(f"g{rng.randrange(30)}", rng.choice(["A", "B", "C", None])) for _ in range(900)]
    df = votes(spark, *data).repartition(5)
    df.createOrReplaceTempView("base")
    want = spark.sql("""
        WITH h AS (SELECT g, v, count(*) AS n FROM base GROUP BY g, v),
             m AS (SELECT g, v FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, v) AS rn
                   FROM h) WHERE rn = 1)
        SELECT b.g, sum(CASE WHEN b.v = m.v THEN 1 ELSE 0 END) AS a, count(*) AS t
        FROM base b JOIN m ON b.g = m.g GROUP BY b.g""")
    assert rows(M.alignment(df, "g", "v"), "g", "aligned", "total") == rows(want)


def test_cohesion_bands_use_rounded_mean_and_raw_spread(spark):
    data = [("up", 79.99), ("up", 80.0), ("lone", 60.0), ("wide", 90.0), ("wide", 50.0)]
    got = rows(M.cohesion(spark.createDataFrame(data, "g string, percent_aligned double"), "g"))
    assert got[0] == ("lone", 1, 60.0, 60.0, 60.0, "Coesa", None, "Não")
    # the mean 79.995 is rounded to 80.00 before it is banded
    assert got[1] == ("up", 2, 80.0, 79.99, 80.0, "Muito Coesa", 0.01, "Sim")
    assert got[2][5:] == ("Coesa", 28.28, "Não")


def test_concentration_edges(spark):
    even = [("even", f"p{i}", i) for i in range(4)]
    seven = [("seven", f"p{i}", i) for i in range(7)]
    one = [("one", "p", 1), ("one", "p", 2), ("one", "p", 2)]
    gap = [("gap", None, 1), ("gap", "p", 2)]
    df = spark.createDataFrame(even + seven + one + gap, "g string, party string, m int")
    got = rows(M.concentration_index(df, "g", "party", "m"))
    assert got == [
        ("even", 4, 4, 0.25, "Média diversidade"),
        ("gap", 2, 1, 0.5, "Baixa diversidade"),
        ("one", 2, 1, 1.0, "Baixa diversidade"),
        ("seven", 7, 7, 0.1429, "Alta diversidade"),
    ]


@pytest.mark.parametrize("seed", [3, 4])
def test_concentration_bounds(spark, seed):
    rng = random.Random(seed)
    data = [(rng.randrange(20), f"p{rng.randrange(6)}", rng.randrange(50)) for _ in range(600)]
    df = M.concentration_index(spark.createDataFrame(data, "g int, p string, m int"), "g", "p", "m")
    assert df.filter("hhi < round(1.0 / categories, 4) OR hhi > 1").isEmpty()


def test_zscore_drops_groups_without_spread(spark):
    data = [("one", 1, 5.0), ("flat", 2, 3.0), ("flat", 3, 3.0), (None, 4, 1.0), (None, 5, 2.0)]
    data += [("ok", 6, 1.0), ("ok", 7, 2.0), ("ok", 8, 3.0)]
    df = spark.createDataFrame(data, "g string, id int, v double")
    got = rows(M.zscore_outliers(df, "g", "v", ["id"]), "id", "group_mean", "group_stddev", "z_score", "outlier_band")
    assert got == [
        (6, 2.0, 1.0, -1.0, "Leve desvio"),
        (7, 2.0, 1.0, 0.0, "Comportamento esperado"),
        (8, 2.0, 1.0, 1.0, "Leve desvio"),
    ]


def test_zscore_group_may_be_the_value_to_keep(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, v double")
    assert M.zscore_outliers(df, "g", "v", ["g"]).columns[:2] == ["g", "v"]


def test_weekly_density_zero_fills_and_cuts_to_the_calendar(spark):
    days = calendar(spark, dt.date(2022, 12, 26), dt.date(2023, 1, 15))
    events = spark.createDataFrame(
        [(1, dt.date(2023, 1, 1)), (1, dt.date(2023, 1, 1)), (2, dt.date(2023, 1, 3)), (3, dt.date(2023, 2, 1))],
        "e int, d date",
    )
    got = rows(M.weekly_density(days, events, "d", "e"), "year_week", "events", "has_events")
    assert got == [("2022-52", 0, False), ("2023-01", 1, True), ("2023-02", 0, False), ("2023-52", 1, True)]
    iso = rows(M.weekly_density(days, events, "d", "e", iso_years=True), "year_week", "events")
    assert iso == [("2022-52", 1), ("2023-01", 1), ("2023-02", 0)]


def test_attendance_counts_each_event_once(spark):
    presence = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (2, 11), (2, 99)], "m int, e int")
    events = spark.createDataFrame(
        [(10, 2024, "a"), (11, 2024, "a"), (12, 2024, "a"), (13, 2024, "b")], "e int, y int, k string"
    )
    got = rows(M.attendance_rate(presence, events, "m", "e", "y", "k"), "m", "attended", "total", "attendance_rate",
               "attendance_percent")
    assert got == [(1, 2, 3, 0.6667, 66.67), (2, 1, 3, 0.3333, 33.33)]


def test_period_comparison_counts_weeks_with_events(spark):
    df = spark.createDataFrame(
        [("x", 1, 5, 7), ("x", 1, 5, 8), ("x", 2, 53, 7), ("x", 3, 53, None)], "k string, e int, w int, u int"
    )
    assert rows(M.period_comparison(df, ["k"], "e", "w", "u")) == [("x", 3, 1.5, 2)]


def test_engagement_needs_both_kinds_of_activity(spark):
    members = spark.createDataFrame([(i, f"m{i}") for i in range(1, 5)], "m int, name string")
    presence = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (3, 1)], "m int, e int")
    cast = spark.createDataFrame(
        [(1, "b1", "Sim"), (2, "b1", "sim"), (2, "b2", "Não"), (4, "b1", "Sim"), (1, "b3", None)],
        "m int, b string, v string",
    )
    got = M.engagement_score(
        members, presence, cast, "m", ["name"], "e", "b", "v", {"yes": "SIM", "no": "NÃO"}
    )
    assert rows(got, "m", "events", "ballots", "yes", "no", "score", "rank", "percentile") == [
        (1, 2, 2, 1, 0, 100.0, 1, 1.0),
        (2, 1, 2, 1, 1, 80.0, 2, 0.0),
    ]
    alone = M.engagement_score(
        members, presence.filter("m = 1"), cast, "m", ["name"], "e", "b", "v", {"yes": "SIM"}
    )
    assert rows(alone, "m", "rank", "percentile") == [(1, 1, 0.0)]


def test_engagement_by_group_bands_the_raw_mean(spark):
    df = spark.createDataFrame([("a", 79.996), ("b", 60.0), ("c", 10.0), ("c", 30.0)], "g string, score double")
    got = rows(M.engagement_by_group(df, "g"), "g", "mean_score", "rank", "score_band")
    assert got == [("a", 80.0, 1, "Médio"), ("b", 60.0, 2, "Médio"), ("c", 20.0, 3, "Baixo")]


def test_top_n_monthly_sums_money_exactly(spark):
    data = [("p", 1, 0.1)] * 10 + [("q", 1, 1.0)]
    df = spark.createDataFrame(data, "g string, m int, v double").withColumn("month", F.lit("2024-01"))
    got = rows(M.top_n_monthly(df, "g", ["month"], "v", "m"), "g", "rows", "total", "rank")
    assert got == [("p", 10, 1.0, 1), ("q", 1, 1.0, 2)]


def test_future_events(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),), (None,)], "d date")
    assert rows(M.future_events(df, "d", dt.date(2024, 1, 1))) == [(dt.date(2024, 1, 2),)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(300)], "k int, v int").repartition(4)
    right = spark.createDataFrame([(1, "a"), (1, "b"), (30, "c"), (7, "d")], "k int, t string")
    got = salted_join(left, right, "k", how, rows_per_task=20)
    assert rows(got, *sorted(got.columns)) == rows(left.join(right, "k", how), *sorted(got.columns))


def test_star_join_left_keeps_and_report_counts_unmatched(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "k int, c string")
    dim = Dim(spark.createDataFrame([("a", "A")], "c string, name string"), [("c", "c")], ["name"], "left")
    assert rows(star_join(fact, dim), "k", "name") == [(1, "A"), (2, "A"), (3, None)]
    assert rows(match_report(fact, {"dim": dim})) == [("dim", 2, 1)]


def test_sorted_set_drops_nulls_and_copies(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    assert rows(sorted_set(df, "k", "v", "s")) == [(1, ["a", "b"]), (2, [])]


def test_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    assert assert_unique(df, ["a", "b"]) is df
    with pytest.raises(ValueError, match="not unique"):
        assert_unique(df, "a")
    with pytest.raises(ValueError, match="members returned no rows"):
        require_rows(df.filter("a > 5"), "members")


def test_calendar_has_one_row_per_day(spark):
    span = spark.sql("SELECT * FROM VALUES (DATE '2027-12-31'), (DATE '2023-01-01'), (NULL) AS t(day)")
    days = L.dim_data(span, "day", S.ELECTION_PERIODS)
    assert days.count() == 1826
    got = rows(days.filter("data IN (DATE '2026-10-31', DATE '2026-11-01')"), "sk_data", "nome_dia_semana",
               "is_fim_semana", "periodo_eleitoral", "descricao_periodo_eleitoral")
    assert got == [
        (20261031, "Saturday", True, True, "Período eleitoral 2026"),
        (20261101, "Sunday", True, False, "Fora do período eleitoral"),
    ]


def test_sums_are_rounded_once_and_refuse_odd_numbers(spark):
    df = spark.createDataFrame([(0.005,), (0.005,), (0.005,), (0.004,)], "v double")
    assert float(df.agg(money_sum("v")).first()[0]) == 0.02
    for odd in (float("nan"), float("inf"), 1e20):
        with pytest.raises(Exception, match="finite number"):
            df.union(spark.createDataFrame([(odd,)], "v double")).agg(money_sum("v")).collect()


def test_events_per_week_with_year_and_week_keys(spark):
    df = spark.createDataFrame([("g", i, 202300 + i, "u") for i in range(104)], "g string, e int, w int, u string")
    assert M.period_comparison(df, ["g"], "e", "w", "u").first()[:] == ("g", 104, 1.0, 1)


def test_weekly_density_counts_only_days_of_the_calendar(spark):
    days = spark.sql("SELECT d AS date, weekofyear(d) AS iso_week FROM VALUES (DATE '2024-01-01'), (DATE '2024-01-05') AS t(d)")
    events = spark.sql("SELECT * FROM VALUES (1, DATE '2024-01-01'), (2, DATE '2024-01-03') AS t(e, d)")
    assert [r.events for r in M.weekly_density(days, events, "d", "e").collect()] == [1]
