import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martloom.operators import dedupe, dense_key, global_ranks, share_of_max, stable_key, top_n_per_group
from tests.conftest import rows


def test_dedupe_keeps_the_newest_and_groups_nulls(spark):
    df = spark.createDataFrame(
        [(1, 10, "b"), (1, 20, "z"), (1, 20, "a"), (None, 1, "p"), (None, 2, "q"), (2, None, "n"), (2, 5, "m")],
        "k int, at int, v string",
    )
    want = [(None, 2, "q"), (1, 20, "a"), (2, 5, "m")]
    assert rows(dedupe(df, "k", "at")) == rows(spark.createDataFrame(want, df.schema))


def test_dedupe_with_columns_that_have_no_order(spark):
    df = spark.sql("SELECT 1 AS k, map('a', 1) AS m UNION ALL SELECT 1, map('b', 2)")
    assert dedupe(df, "k").count() == 1


def test_dedupe_does_not_depend_on_input_order(spark):
    rng = random.Random(5)
    data = [(rng.randrange(20), rng.randrange(3), rng.randrange(1000)) for _ in range(400)]
    want = rows(dedupe(spark.createDataFrame(data, "k int, at int, v int"), "k", "at"))
    for _ in range(3):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k int, at int, v int").repartition(rng.randrange(1, 9))
        assert rows(dedupe(df, "k", "at")) == want


def test_dense_key(spark):
    rng = random.Random(1)
    names = [f"n{rng.randrange(10**6)}" for _ in range(3000)] + [None]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, id int").repartition(7)
    got = dense_key(df, "name", "sk")
    assert got.columns == ["sk", "name", "id"]
    ordered = sorted(range(len(names)), key=lambda i: (names[i] is not None, names[i] or "", i))
    assert {r.id: r.sk for r in got.collect()} == {i: n + 1 for n, i in enumerate(ordered)}


def test_dense_key_of_nothing(spark):
    df = spark.createDataFrame([], "name string")
    assert dense_key(df, "name", "sk").count() == 0


def test_stable_key_keeps_numbers(spark):
    first = spark.createDataFrame([("b",), ("d",), (None,)], "nk string")
    held = stable_key(first, None, "nk", "sk")
    assert rows(held, "nk", "sk") == [(None, 1), ("b", 2), ("d", 3)]
    second = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "nk string")
    got = stable_key(second, held, "nk", "sk")
    assert rows(got, "nk", "sk") == [(None, 1), ("a", 4), ("b", 2), ("c", 5)]
    # a key that left does not free its number
    again = stable_key(spark.createDataFrame([("d",), ("e",)], "nk string"), held, "nk", "sk")
    assert rows(again, "nk", "sk") == [("d", 3), ("e", 4)]


def test_top_n_with_equal_totals_at_the_edge(spark):
    data = [("g", f"m{i:02d}", 100.0 if i in (9, 10) else 200.0 - i) for i in range(12)]
    df = spark.createDataFrame(data, "g string, m string, total double").repartition(5)
    order = [F.col("total").desc(), F.col("m").asc()]
    got = rows(top_n_per_group(df, "g", order, 10), "rank", "m")
    assert len(got) == 10
    assert (10, "m11") in got or (10, "m09") in got
    assert got == rows(top_n_per_group(df.repartition(2), "g", order, 10), "rank", "m")


def test_share_of_max(spark):
    df = spark.createDataFrame([(1, 5), (2, 10), (3, 0)], "k int, v int")
    assert rows(share_of_max(df, {"v": "s"}), "k", "s") == [(1, 50.0), (2, 100.0), (3, 0.0)]
    zeros = spark.createDataFrame([(1, 0)], "k int, v int")
    assert rows(share_of_max(zeros, {"v": "s"}), "k", "s") == [(1, None)]


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 1.0, 1.0], [3.0, 1.0, 2.0, 2.0, None], [float(i % 17) for i in range(500)],
    [random.Random(3).random() for _ in range(700)],
])
def test_ranks_of_distinct_scores_equal_window_ranks(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double").repartition(6)
    got = rows(global_ranks(df, "v", "dense", "pct"), "id", "dense", "pct")
    plain = df.select(
        "id",
        F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("bigint"),
        F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_first())),
    )
    assert got == rows(plain)


def test_ranks_of_averages_match_themselves(spark):
    """A mean computed twice may differ in its last bit; no group may get lost by that."""
    rng = random.Random(9)
    data = [(i % 40, rng.random() * 10 ** rng.randrange(-8, 8)) for i in range(4000)]
    df = spark.createDataFrame(data, "g int, v double").repartition(16)
    means = df.groupBy("g").agg(F.avg("v").alias("m"))
    assert global_ranks(means, "m", "dense").count() == 40
