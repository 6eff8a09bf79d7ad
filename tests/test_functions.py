import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom import functions as M
from martloom.functions import bands as B
from martloom.functions.dates import iso_year


def one(spark, schema, value, *columns):
    return tuple(spark.createDataFrame([value], schema).select(*columns).head())


@pytest.mark.parametrize(
    "raw, digits, kind, key",
    [
        ("12.345.678/0001-90", "12345678000190", "PJ", "12345678000190"),
        ("123.456.789-01", "12345678901", "PF", "12345678901"),
        ("12-3", "123", "NAO_IDENTIFICADO", "123"),
        ("", "", "NAO_IDENTIFICADO", "ACME"),
        ("n/a", "", "NAO_IDENTIFICADO", "ACME"),
        (None, None, "NAO_IDENTIFICADO", "ACME"),
    ],
)
def test_supplier_key(spark, raw, digits, kind, key):
    df = spark.createDataFrame([(raw, "ACME")], "raw string, name string")
    df = df.withColumn("d", M.digits_only("raw"))
    got = df.select("d", M.party_kind("d"), M.tax_id_or_name("d", "name")).head()
    assert tuple(got) == (digits, kind, key)


def test_ids_in_uris(spark):
    got = one(
        spark, "a string, b string, c string",
        ("http://x/eventos/77", "http://x/eventos/77/", "http://x/partidos/36898?p=1"),
        M.trailing_id("a"), M.trailing_id("b"), M.id_after("c", "partidos"), M.id_after("a", "partidos"),
    )
    assert got == (77, None, 36898, None)


def test_typed_select_survives_dirt_and_counts_it(spark):
    df = spark.createDataFrame([("1", "2024-01-05"), ("x", ""), (None, None)], "n string, d string")
    spec = [("n", "number", "int"), ("d", "day", "date")]
    got = [tuple(r) for r in M.typed_select(df, spec).collect()]
    assert got == [(1, dt.date(2024, 1, 5)), (None, None), (None, None)]
    lost = {r.column_name: r.lost_values for r in M.cast_losses(df, spec).collect()}
    assert lost == {"number": 1, "day": 1}


def test_timestamps(spark):
    df = spark.createDataFrame(
        [("2024-02-03T10:20",), ("2024-02-03T10:20:30",), ("",), ("soon",)], "t string"
    )
    got = [r[0] for r in df.select(M.parse_timestamp("t").cast("string")).collect()]
    assert got == ["2024-02-03 10:20:00", "2024-02-03 10:20:30", None, None]


@pytest.mark.parametrize(
    "day, week, label, iso_label",
    [
        (dt.date(2023, 1, 1), 52, "2023-52", "2022-52"),
        (dt.date(2024, 12, 30), 1, "2024-01", "2025-01"),
        (dt.date(2027, 1, 1), 53, "2027-53", "2026-53"),
        (dt.date(2024, 7, 1), 27, "2024-27", "2024-27"),
    ],
)
def test_weeks_at_year_ends(spark, day, week, label, iso_label):
    w = F.weekofyear("d")
    got = one(
        spark, "d date", (day,), w, M.week_label(F.year("d"), w), M.week_label(iso_year("d"), w)
    )
    assert got == (week, label, iso_label)


def test_month_label(spark):
    df = spark.createDataFrame([(2024, 3), (2024, None), (None, None)], "y int, m int")
    assert [r[0] for r in df.select(M.month_label("y", "m")).collect()] == ["2024-03", "2024", None]


def test_hash_keys_tell_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    guarded = [r[0] for r in df.select(M.hash_key("x", "y", "z")).collect()]
    skipping = [r[0] for r in df.select(M.hash_key("x", "y", "z", skip_nulls=True)).collect()]
    assert guarded[0] != guarded[1]
    assert skipping[0] == skipping[1]


def test_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in (None, 59.99, 60.0, 79.99, 80.0)], "v double")
    got = [r[0] for r in df.select(M.band_at_least("v", B.ALIGNMENT_BANDS, "Baixo")).collect()]
    assert got == ["Baixo", "Baixo", "Médio", "Médio", "Alto"]
    df = spark.createDataFrame([(v,) for v in (None, 0.15, 0.1501, 0.25, 0.2501)], "v double")
    got = [r[0] for r in df.select(M.band_at_most("v", B.DIVERSITY_BANDS, B.DIVERSITY_OTHERWISE)).collect()]
    assert [g.split()[0] for g in got] == ["Baixa", "Alta", "Média", "Média", "Baixa"]
    df = spark.createDataFrame([(v,) for v in (None, 0.99, 1.0, 2.0, 3.0, 3.99, 4.0)], "v double")
    got = [r[0] for r in df.select(M.band_below("v", B.OUTLIER_BANDS, B.OUTLIER_OTHERWISE)).collect()]
    assert got == [
        None, "Comportamento esperado", "Leve desvio", "Atenção", "Possível anomalia",
        "Possível anomalia", "Muito atípico",
    ]


def test_percentages(spark):
    got = one(
        spark, "a bigint, b bigint, z bigint", (1, 3, 0),
        M.exact_percent("a", "b"), M.ratio("a", "b"), M.percent("a", "b"), M.exact_percent("a", "z"),
    )
    assert got == (33.33, 0.3333, 33.33, None)
    # 12.345 % exactly: half up, in spite of what the nearest double says
    assert one(spark, "a bigint, b bigint", (2469, 20000), M.exact_percent("a", "b")) == (12.35,)


def test_money_sums_are_exact_for_any_sign_and_size(spark):
    df = spark.createDataFrame([(v,) for v in (0.1, 0.2, -0.3, 1e13, 0.01, -5.55, None)], "v double")
    assert df.select(M.money_sum("v").cast("string")).head()[0] == "9999999999994.46"
    many = spark.range(2000).select(F.lit(9e15).alias("v"))
    assert many.select(M.money_sum("v").cast("string")).head()[0] == "18000000000000000000.00"
    assert spark.createDataFrame([], "v double").select(M.money_sum("v")).head()[0] is None


def test_money_means_round_half_cents_away_from_zero(spark):
    for values, want in (((0.01, 0.02), 0.02), ((-0.01, -0.02), -0.02), ((1.0, 2.0, 2.0), 1.67), ((), None)):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        assert df.select(M.rounded_money_mean("v")).head()[0] == want
    df = spark.createDataFrame([(0.1,), (None,), (0.2,)], "v double")
    assert df.select(M.rounded_money_mean("v"), F.round(M.money_mean("v"), 6)).head() == (0.15, 0.15)
