"""Ordered writes, keyed tables, range-binned upserts and history tables: what is rewritten and read."""

import datetime as dt
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martloom.operators import Within, upsert_where
from martloom.session import kept, release, shared_folder
from martloom.sinks import files_of, load_bucketed, load_history, load_indexed, load_where, old_partitions, replace, save
from tests.conftest import rows


def _ranges(df, column):
    """(least, greatest) of each data file, from its footer."""
    out = []
    for f in df.inputFiles():
        groups = pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata
        at = groups.schema.to_arrow_schema().get_field_index(column)
        stats = [groups.row_group(i).column(at).statistics for i in range(groups.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats)))
    return sorted(out)


def test_ordered_files_do_not_overlap(spark, database):
    df = spark.range(0, 20_000, 1, 8).select("id", ((F.col("id") * 7919) % 20_000).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        replace(df, f"{database}.t", order_by="score")
        replace(df, f"{database}.plain")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = _ranges(spark.table(f"{database}.t"), "score")
    assert len(ranges) > 2 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(low <= 777 <= high for low, high in ranges) == 1
    assert sum(low <= 777 <= high for low, high in _ranges(spark.table(f"{database}.plain"), "score")) > 1
    assert spark.table(f"{database}.t").count() == 20_000


def test_ordered_within_partitions(spark, database):
    df = spark.range(0, 5000, 1, 6).select(F.concat(F.lit("p"), F.col("id") % 3).alias("p"), ((F.col("id") * 31) % 5000).alias("v"))
    save(df, f"{database}.t", "overwrite", partition_by="p", order_by=F.col("v").desc())
    for file in spark.table(f"{database}.t").inputFiles():
        values = pq.read_table(file.removeprefix("file://").removeprefix("file:"))["v"].to_pylist()
        assert values == sorted(values, reverse=True) and len(values) > 1
    assert spark.table(f"{database}.t").count() == 5000


def test_bucketed_upsert_rewrites_only_its_buckets(spark, database):
    table = f"{database}.t"
    load_bucketed(spark.range(1000).select("id", F.lit("old").alias("v")), table, "id", buckets=16)
    assert spark.table(table).columns == ["id", "v"]
    before = files_of(spark, table)
    batch = spark.createDataFrame([(5, "new"), (5000, "x")], "id int, v string")  # a narrower key type
    load_bucketed(batch, table, "id", newest_by="v")
    after = files_of(spark, table)
    assert len(before - after) <= 2 < len(before & after) and len(after - before) <= 2
    assert spark.table(table).count() == 1001
    assert rows(spark.table(table).where("v <> 'old'")) == [(5, "new"), (5000, "x")]
    load_bucketed(batch, table, "id", newest_by="v")
    assert spark.table(table).count() == 1001
    load_bucketed(batch.where("false"), table, "id", newest_by="v")
    with pytest.raises(ValueError, match="keyed by"):
        load_bucketed(batch, table, "v")
    with pytest.raises(ValueError, match="lacks"):
        load_bucketed(batch.withColumn("w", F.lit(1)), table, "id")


def test_bucketed_upsert_of_null_keys(spark, database):
    table = f"{database}.t"
    first = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (1, "x", "c")], "k int, l string, v string")
    load_bucketed(first, table, ["k", "l"], buckets=4, null_safe=True)
    load_bucketed(spark.createDataFrame([(None, None, "B"), (1, None, "A")], "k int, l string, v string"), table, ["k", "l"], null_safe=True)
    assert {r.v for r in spark.table(table).collect()} == {"A", "B", "c"}


def test_partial_upsert_by_buckets(spark, database):
    table = f"{database}.t"
    load_bucketed(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string"), table, "k", buckets=4)
    load_bucketed(spark.createDataFrame([(1, "A", "no"), (3, "n", "z")], "k int, v string, w string"), table, "k", update_map={"v": "v"})
    assert rows(spark.table(table)) == [(1, "A", "x"), (2, "b", "y"), (3, "n", "z")]


def test_indexed_upsert_looks_old_partitions_up(spark, database):
    table = f"{database}.t"
    first = spark.range(600).select("id", F.concat(F.lit("2024-"), F.lpad((F.col("id") % 6 + 1).cast("string"), 2, "0")).alias("month"), F.lit("old").alias("v"))
    load_indexed(first, table, "id", "month", buckets=8)
    before = files_of(spark, table)
    # 0 is corrected in January, 1 moves from February to January, 900 is new in a new month, 6 loses its month
    batch = spark.createDataFrame([(0, "2024-01", "n"), (1, "2024-01", "n"), (900, "2024-09", "n"), (6, "", "n")], "id bigint, month string, v string")
    old = old_partitions(batch, table, ["id"], ["month"])
    assert rows(old) == [("2024-01",), ("2024-02",)]
    assert all("__keys__buckets" in f for f in old.inputFiles())
    load_indexed(batch, table, "id", "month")
    kept = before & files_of(spark, table)
    assert {f.split("month=")[1].split("/")[0] for f in kept} == {"2024-03", "2024-04", "2024-05", "2024-06"}
    want = {r.id: (r.month, r.v) for r in first.collect()} | {0: ("2024-01", "n"), 1: ("2024-01", "n"), 900: ("2024-09", "n"), 6: (None, "n")}
    assert {r.id: (r.month, r.v) for r in spark.table(table).collect()} == want
    assert {r.id: r.month for r in spark.table(f"{table}__keys").collect()} == {k: m for k, (m, _) in want.items()}
    load_indexed(batch, table, "id", "month")
    assert {r.id: (r.month, r.v) for r in spark.table(table).collect()} == want


def test_indexed_upsert_after_a_run_that_stopped(spark, database, monkeypatch):
    from martloom.sinks import keyed

    table = f"{database}.t"
    load_indexed(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], "id int, p int, v string"), table, "id", "p", buckets=2)
    moved = spark.createDataFrame([(1, 3, "c")], "id int, p int, v string")
    monkeypatch.setattr(keyed, "_drop_partition", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        load_indexed(moved, table, "id", "p")
    monkeypatch.undo()
    # whatever comes next finds the row in its new partition as well as what was left of the old one
    load_indexed(spark.createDataFrame([(1, 4, "d")], "id int, p int, v string"), table, "id", "p")
    assert rows(spark.table(table), "id", "p", "v") == [(1, 4, "d"), (2, 2, "b")]


def test_indexed_upsert_by_two_partition_columns(spark, database):
    table, rng = f"{database}.t", random.Random(2)
    ddl = "id int, year int, month string, v int"
    held = {}
    for n in range(4):
        batch = [(i, rng.choice([2023, 2024, None]), rng.choice(["a", "b"]), n) for i in rng.sample(range(30), 12)]
        load_indexed(spark.createDataFrame(batch, ddl), table, "id", ["year", "month"], buckets=3)
        held |= {b[0]: b[1:] for b in batch}
        assert {r.id: (r.year, r.month, r.v) for r in spark.table(table).collect()} == held


@pytest.mark.parametrize("kind", ["int", "date"])
def test_upsert_where_by_intervals_is_what_all_pairs_give(spark, kind):
    rng = random.Random(7)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n) if kind == "date" else n
    dest = [(i, day(rng.randint(0, 400)), rng.random()) for i in range(300)] + [(None, day(5), 0.9), (999, None, 0.9)]
    cuts = sorted(rng.sample(range(400), 30))
    orig = [(1000 + i, day(a), float(i), day(a), day(b - 1)) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    orig += [(2000, day(0), 0.0, day(700), day(900)), (2001, day(0), 0.0, None, day(3)), (2002, day(0), 0.0, day(9), day(8))]
    target = spark.createDataFrame(dest, f"id int, x {kind}, w double")
    source = spark.createDataFrame(orig, f"id int, x {kind}, w double, lo {kind}, hi {kind}")
    got = upsert_where(target, source, "dest.w > 0.3", "id", Within("x", "lo", "hi"))
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    want, met = [], set()
    for row in dest:
        hits = [o for o in orig if row[1] is not None and o[3] is not None and o[3] <= row[1] <= o[4] and row[2] > 0.3]
        met |= {o[0] for o in hits}
        want += [o[:3] for o in hits] or [row]
    want += [o[:3] for o in orig if o[0] not in met]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_upsert_where_refuses_all_pairs_and_double_matches(spark, database):
    target = spark.createDataFrame([(1, 5)], "id int, x int")
    source = spark.createDataFrame([(1, 5, 0, 9), (2, 5, 3, 7)], "id int, x int, lo int, hi int")
    with pytest.raises(ValueError, match="no equality"):
        upsert_where(target, source, "dest.x > orig.lo", "id")
    with pytest.raises(Exception, match="several source rows"):
        upsert_where(target, source, F.lit(True), "id", Within("x", "lo", "hi")).collect()
    load_where(source.select("id", "x"), f"{database}.t", "dest.id = orig.id", "id")
    load_where(spark.createDataFrame([(2, 8), (3, 9)], "id int, x int"), f"{database}.t", "dest.id = orig.id", "id")
    assert rows(spark.table(f"{database}.t")) == [(1, 5), (2, 8), (3, 9)]


DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(40)]


def test_history_rewrites_only_open_rows(spark, database):
    table = f"{database}.h"
    people = lambda *r: spark.createDataFrame(list(r), "id int, party string, email string")
    load_history(people((1, "A", "x"), (2, "B", "y")), table, "id", "party", DAYS[0])
    load_history(people((1, "C", "x"), (2, "B", "z")), table, "id", "party", DAYS[5])
    closed = {f for f in spark.table(table).inputFiles() if "is_current=false" in f}
    load_history(people((1, "C", "x"), (2, "D", "z"), (3, "E", "w")), table, "id", "party", DAYS[9])
    assert closed <= set(spark.table(table).inputFiles())
    want = [
        (1, "A", DAYS[0], DAYS[5]), (1, "C", DAYS[5], None), (2, "B", DAYS[0], DAYS[9]), (2, "D", DAYS[9], None), (3, "E", DAYS[9], None),
    ]
    got = lambda: sorted(map(tuple, spark.table(table).select("id", "party", "valid_from", "valid_to").collect()), key=str)
    assert got() == sorted(want, key=str)
    load_history(people((1, "C", "x"), (2, "D", "z"), (3, "E", "w")), table, "id", "party", DAYS[9])
    assert got() == sorted(want, key=str)
    # a second batch of the same day closes more; what the first one closed stays
    load_history(people((1, "F", "x")), table, "id", "party", DAYS[9])
    assert ("2024-01-10", 2) in {(str(r.valid_to), r.id) for r in spark.table(table).collect()}
    assert (1, "C", DAYS[5], DAYS[9]) in got()


def test_history_of_members_who_all_leave_and_return(spark, database):
    table = f"{database}.h"
    people = lambda *r: spark.createDataFrame(list(r), "id int, party string")
    load_history(people((1, "A"), (None, "N")), table, "id", "party", DAYS[0])
    load_history(people(), table, "id", "party", DAYS[3], close_missing=True)
    assert spark.table(table).where("is_current").isEmpty() and spark.table(table).count() == 2
    load_history(people((1, "A")), table, "id", "party", DAYS[6])
    assert rows(spark.table(table).where("id = 1"), "valid_from", "valid_to") == [(DAYS[0], DAYS[3]), (DAYS[6], None)]


def test_upserts_leave_no_copies_of_their_steps(spark, database):
    folder = shared_folder(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(folder))
    rows_of = lambda a, b, v: spark.range(a, b).select("id", (F.col("id") % 3).alias("part"), F.lit(v).alias("v"))
    for loader, name, options in ((load_indexed, "i", {"partition_by": "part"}), (load_bucketed, "b", {})):
        loader(rows_of(0, 50, "a"), f"{database}.{name}", keys="id", buckets=4, **options)
        loader(rows_of(40, 60, "b"), f"{database}.{name}", keys="id", **options)
        assert {r.v: r["count"] for r in spark.table(f"{database}.{name}").groupBy("v").count().collect()} == {"a": 40, "b": 20}
    assert not set(os.listdir(folder)) - before


def test_kept_steps_hold_any_column_and_go_on_release(spark):
    plain = kept(spark.range(5).select("id", F.lit("x").alias("v")))
    odd = kept(spark.range(5).select("id", F.lit(None).alias("nothing")))
    assert rows(odd.where("nothing IS NULL"), "id") == rows(plain, "id") == [(i,) for i in range(5)]
    folders = {f.removeprefix("file://").rsplit("/", 1)[0] for f in plain.inputFiles()}
    assert all(os.path.isdir(f) for f in folders)
    release(plain, odd)
    assert not any(os.path.isdir(f) for f in folders) and odd.count() == 5
