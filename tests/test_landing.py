"""The ledger of landed files, the one-pass split of rejected records, and losses counted on the way."""

import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from martloom.functions import typed_select
from martloom.operators import Dim, star_join
from martloom.sinks import split_once
from martloom.sources import judge, read_landed_pages
from martloom.sources.ledger import landed_files, paths_of, record, unread
from tests.conftest import rows


def test_only_new_and_changed_files_are_read(spark, database, tmp_path):
    for n in (1, 2):
        (tmp_path / f"{n}.json").write_text(json.dumps({"dados": [{"id": n}]}))
    ledger, path = f"{database}.ledger", f"{tmp_path}/*.json"
    first = unread(landed_files(spark, path), ledger, "p")
    assert len(paths_of(first)) == 2
    record(first, ledger, "p", "b1")
    assert unread(landed_files(spark, path), ledger, "p").isEmpty()
    assert unread(landed_files(spark, path), ledger, "q").count() == 2
    (tmp_path / "2.json").write_text(json.dumps({"dados": [{"id": 22}]}))
    (tmp_path / "3.json").write_text(json.dumps({"dados": [{"id": 3}]}))
    new = unread(landed_files(spark, path), ledger, "p")
    assert sorted(p.rsplit("/", 1)[1] for p in paths_of(new)) == ["2.json", "3.json"]
    record(new, ledger, "p", "b2")
    assert rows(spark.table(ledger).groupBy("batch_id").count(), "batch_id", "count") == [("b1", 2), ("b2", 2)]


def test_rejected_records_are_split_in_one_write(spark):
    texts = ['{"id": 1}', '{"id": 2', '{"x": 1}', '{"id": 4}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    seen = Observation()
    good, bad = split_once(judge(df.mapInArrow(counted, df.schema), "t", "id bigint", ["id"]), seen)
    assert rows(good, "n") == [(0,), (3,)]
    assert rows(bad, "n", "tipo_erro") == [(1, "malformed_json"), (2, "missing_id"), (4, "malformed_json")]
    assert reads.value == len(texts) and seen.get == {"rows": 5, "rejected": 3}
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "_rejected" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_losses_of_casts_and_joins_are_counted_in_the_same_run(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("4", None)], "n string, k string")
    losses, missed = Observation(), Observation()
    typed = typed_select(df, [("n", "n", "int"), ("k", "k", "string")], losses)
    dims = [
        Dim(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), [("k", "k")], ["v"]),
        Dim(spark.createDataFrame([(1, "one")], "n int, w string"), [("n", "n")], ["w"], "left"),
        Dim(spark.createDataFrame([(1,), (4,)], "n int"), [("n", "n")]),
    ]
    joined = star_join(typed, *dims, losses=missed)
    joined.write.parquet(f"{tmp_path}/out")
    assert losses.get == {"rows": 4, "n": 1, "k": 0}
    assert missed.get == {"rows": 4, "kept": 1, "lost_0": 2, "lost_2": 2}
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(star_join(typed_select(df, [("n", "n", "int"), ("k", "k", "string")]), *dims))


def test_parsed_columns_count_what_parsing_lost(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01",), ("31/12/2023",), (None,)], "d string")
    losses = Observation()
    typed_select(df, [(F.col("d").try_cast("date"), "day", "date")], losses, {"day": "d"}).write.parquet(f"{tmp_path}/out")
    assert losses.get == {"rows": 3, "day": 1}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_star_join_without_losses_to_count_is_as_before(spark, how):
    fact = spark.createDataFrame([(1,), (2,)], "k int")
    dim = Dim(spark.createDataFrame([(1, "a")], "k int, v string"), [("k", "k")], ["v"], how)
    assert star_join(fact, dim).count() == (1 if how == "inner" else 2)


def test_landed_pages_are_compressed_and_read_whole(spark, tmp_path):
    from catalog.bronze import land

    records = spark.range(3000).select((F.col("id") % 2).alias("parent"), F.to_json(F.struct("id")).alias("record"))
    land(records, f"{tmp_path}/pages", ["parent"])
    files = [p for p in (tmp_path / "pages").rglob("part-*")]
    assert len(files) > 2 and all(p.suffix == ".gz" for p in files)
    pages = read_landed_pages(spark, f"{tmp_path}/pages", {"parent": (r"/parent=(\d+)", "bigint")})
    assert pages.select("parent", "raw_payload").exceptAll(records).isEmpty() and pages.count() == 3000
