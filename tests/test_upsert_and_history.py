import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martloom.operators import late_rows, open_history, scd2_apply, upsert, upsert_where
from tests.conftest import rows

SCHEMA = "a int, b string, v int, w int"


def model(target, source, null_safe, update=None):
    """Upsert over Python rows (a, b | v, w); the last source row per key is the newest."""
    def comparable(key):
        return null_safe or None not in key

    newest, loose = {}, []
    for a, b, v, w in source:
        if comparable((a, b)):
            newest[(a, b)] = (v, w)
        else:
            loose.append((a, b, v, w))
    out, seen = [], set()
    for a, b, v, w in target:
        if comparable((a, b)) and (a, b) in newest:
            seen.add((a, b))
            nv, nw = newest[(a, b)]
            out.append((a, b, nv, nw if update is None else w))
        else:
            out.append((a, b, v, w))
    return out + loose + [(*k, *v) for k, v in newest.items() if k not in seen]


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("update", [None, {"v": "v"}])
@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_model(spark, null_safe, update, seed):
    rng = random.Random(seed)

    def key():
        return (rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, "x", "y"]))

    target = [(*k, rng.randrange(9), rng.randrange(9)) for k in {key() for _ in range(12)}]
    source = [(*key(), rng.randrange(10, 99), rng.randrange(10, 99)) for _ in range(15)]
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame([(*r, i) for i, r in enumerate(source)], SCHEMA + ", at int")
    got = upsert(t, s, ["a", "b"], update, newest_by="at", null_safe=null_safe)
    want = spark.createDataFrame(model(target, source, null_safe, update), SCHEMA)
    assert rows(got) == rows(want)
    if null_safe:
        again = upsert(got, s, ["a", "b"], update, newest_by="at", null_safe=True)
        assert rows(again) == rows(got)


def test_upsert_renames_on_update(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    s = spark.createDataFrame([(1, 11), (3, 33)], "k int, fresh int")
    got = upsert(t, s, "k", {"v": "fresh"})
    assert rows(got) == [(1, 11), (2, 20), (3, None)]


def test_upsert_where(spark):
    t = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    s = spark.createDataFrame([(1, 15), (2, 5), (3, 1)], "k int, v int")
    got = upsert_where(t, s, "dest.k = orig.k AND orig.v > dest.v", "k")
    assert rows(got) == [(1, 15), (2, 20), (2, 5), (3, 1)]


def test_upsert_where_refuses_two_matches(spark):
    t = spark.createDataFrame([(1, 10)], "k int, v int")
    s = spark.createDataFrame([(1, 15), (1, 16)], "k int, v int")
    with pytest.raises(Exception, match="several source rows"):
        upsert_where(t, s, "dest.k = orig.k", "k").collect()


D = [dt.date(2024, 1, d) for d in range(1, 32)]
PEOPLE = "id int, party string, mail string"


def people(spark, *data):
    return spark.createDataFrame(list(data), PEOPLE)


def test_scd2_change_refresh_and_new(spark):
    h = open_history(people(spark, (1, "A", "x"), (2, "B", "x"), (3, None, "x")), D[0])
    batch = people(spark, (1, "C", "y"), (2, "B", "y"), (3, None, "y"), (4, "D", "y"))
    got = scd2_apply(h, batch, "id", "party", D[9])
    assert rows(got) == rows(
        spark.createDataFrame(
            [
                (1, "A", "x", D[0], D[9], False),
                (1, "C", "y", D[9], None, True),
                (2, "B", "y", D[0], None, True),
                (3, None, "y", D[0], None, True),
                (4, "D", "y", D[9], None, True),
            ],
            got.schema,
        )
    )
    assert rows(scd2_apply(got, batch, "id", "party", D[9])) == rows(got)


def test_scd2_same_day_correction_leaves_no_empty_interval(spark):
    h = open_history(people(spark, (1, "A", "x")), D[0])
    h = scd2_apply(h, people(spark, (1, "B", "x")), "id", "party", D[5])
    h = scd2_apply(h, people(spark, (1, "C", "x")), "id", "party", D[5])
    assert rows(h, "party", "valid_from", "valid_to") == [("A", D[0], D[5]), ("C", D[5], None)]


def test_scd2_missing_and_returning_member(spark):
    h = open_history(people(spark, (1, "A", "x"), (2, "B", "x")), D[0])
    only_two = people(spark, (2, "B", "x"))
    assert scd2_apply(h, only_two, "id", "party", D[3]).filter("is_current").count() == 2
    h = scd2_apply(h, only_two, "id", "party", D[3], close_missing=True)
    assert rows(h.filter("id = 1"), "valid_from", "valid_to", "is_current") == [(D[0], D[3], False)]
    h = scd2_apply(h, people(spark, (1, "A", "x")), "id", "party", D[8])
    assert rows(h.filter("id = 1"), "valid_from", "valid_to") == [(D[0], D[3]), (D[8], None)]


def test_scd2_late_batch_changes_nothing_and_is_reported(spark):
    h = open_history(people(spark, (1, "A", "x")), D[10])
    late = people(spark, (1, "Z", "x"), (2, "N", "x"))
    got = scd2_apply(h, late, "id", "party", D[2])
    assert rows(got, "id", "party") == [(1, "A"), (2, "N")]
    assert rows(late_rows(h, late, "id", D[2]), "id", "party") == [(1, "Z")]


@pytest.mark.parametrize("seed", [1, 2])
def test_scd2_intervals(spark, seed):
    rng = random.Random(seed)

    def batch():
        return people(spark, *[(i, rng.choice("AB"), rng.choice("xy")) for i in rng.sample(range(12), 8)])

    h = open_history(batch(), D[0])
    for day in sorted(rng.sample(D[1:], 5)):
        h = scd2_apply(h, batch(), "id", "party", day, close_missing=rng.random() < 0.5)
        h = h.checkpoint()
    by_id = {}
    for r in h.collect():
        by_id.setdefault(r.id, []).append((r.valid_from, r.valid_to or dt.date.max, r.is_current, r.party))
    for versions in by_id.values():
        versions.sort()
        assert all(a < b for a, b, _, _ in versions)
        assert all(x[1] <= y[0] for x, y in zip(versions, versions[1:]))
        assert sum(v[2] for v in versions) <= 1
        # touching versions differ, or the change would not have been one
        assert all(x[3] != y[3] for x, y in zip(versions, versions[1:]) if x[1] == y[0])
