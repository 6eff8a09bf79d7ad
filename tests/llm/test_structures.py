"""Conversation repair, fingerprints and the Merkle manifest: SQL, brute force and odd input."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from martloom.llm import conversations, digests, merkle, queries  # noqa: E402
from martloom.llm.common import text_bytes  # noqa: E402
from tests.oracle import connect, difference  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op5_substrings", "op7_embeddings", "op8_jaccard", "op11_conversations", "op13_merkle"])
def test_query_agrees_with_sql(spark, name):
    con = connect(SMALL)
    assert difference(queries.QUERIES[name](spark, SMALL), con, queries.ORACLE[name]) is None
    con.close()


# --- conversations

def _all_repairs(rows, most):
    """(cost, audit) of every edit sequence of at most ``most`` insertions, by trying all."""
    best = None
    choices = []
    for initial, fault in rows:
        extra = fault == "truncated"
        options = [("D", 3, "")]
        if fault not in ("blank", "duplicate"):
            options += [("K", extra, initial), ("R", 2 + extra, "u"), ("R", 2 + extra, "a")]
        choices.append(options)
    gaps = [p for n in range(most + 1) for p in itertools.product("ua", repeat=n)]
    for picked in itertools.product(*choices):
        for fills in itertools.product(gaps, repeat=len(rows) + 1):
            if sum(map(len, fills)) > most:
                continue
            audit, roles, cost = "", "", 0
            for i, fill in enumerate(fills):
                audit, roles, cost = audit + "I" * len(fill), roles + "".join(fill), cost + 2 * len(fill)
                if i < len(rows):
                    audit, roles, cost = audit + picked[i][0], roles + picked[i][2], cost + picked[i][1]
            rest = roles[1:] if roles[:1] == "s" else roles
            if (not roles or rest) and rest == "ua" * (len(rest) // 2):
                best = min(best or (cost, audit), (cost, audit))
    return best


def test_agenda_finds_the_cheapest_and_least_of_all_repairs():
    rng = random.Random(5)
    for _ in range(25):
        rows = [(rng.choice("suuaaat"), rng.choice([None, None, "truncated", "blank", "duplicate"])) for _ in range(rng.randint(0, 3))]
        assert conversations.lightest([conversations.edits_of(*r) for r in rows]) == _all_repairs(rows, 2), rows


def _rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("audit", F.lit("x"))


def test_conversations_on_odd_input(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 5, None, None), (None, None, "user", "a."), (None, 3, "assistant", "b!"),
        (3, 0, "system", "Be."), (3, 1, "system", "Be."), (4, 0, "", "?"), (5, 0, "user", "x " * 200_000), (5, 1, "tool", "done."),
        (6, 0, "user", "same."), (6, 0, "user", "same."), (6, 7, "user", "\x85."), (7, None, "user", "\t"),
    ]
    found = {r.conv_id: r for r in conversations.repair(_rows(spark, rows)).collect()}
    assert len(found) == 8
    assert (found[1].audit, found[1].cost, found[1].gaps) == ("KK", 0, 0)
    assert (found[2].audit, found[2].blank) == ("D", 1)
    assert found[None].audit == "KK" and [t.role for t in found[None].repaired] == ["user", "assistant"]
    assert (found[3].audit, found[3].duplicate, found[3].illegal) == ("DD", 1, 1)
    assert found[4].audit == "D" and found[4].repaired == []
    assert found[5].audit == "KR" and found[5].truncated == 1 and found[5].cost == 3
    assert (found[6].duplicate, found[6].gaps, found[6].illegal) == (1, 6, 2)
    assert (found[7].blank, found[7].audit, found[7].gaps) == (1, "D", 0)
    assert conversations.repair(_rows(spark, rows).where("false")).count() == 0


def test_conversations_in_pieces_have_the_same_results(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 3)
    rng = random.Random(8)
    rows = [
        (rng.choice([None, 1, 2, 3]), rng.choice([None, *range(30)]), rng.choice(["user", "assistant", "system", "tool", None]), rng.choice(["a.", "b", "", "c!", None]))
        for _ in range(200)
    ] + [(9, 4, "user", "again.")] * 50 + [(10, 0, "user", "one"), (10, 1, "assistant", "two.")]
    frame = _rows(spark, rows)
    whole = conversations.repair(frame).withColumn("sha", F.sha2(conversations.repaired_text(F.col("repaired")), 256))
    cut = conversations.repair(frame, limit=2).withColumn("sha", F.coalesce("repaired_sha256", F.sha2(conversations.repaired_text(F.col("repaired")), 256)))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, cut.select(columns).collect()))
    assert cut.where("repaired is null").count() == 5


# --- fingerprints

def _entropies(raw):
    for i in range(len(raw) - digests.WINDOW + 1):
        c = np.unique(raw[i : i + digests.WINDOW], return_counts=True)[1] / digests.WINDOW
        yield -(c * np.log2(c)).sum() / np.log2(digests.WINDOW)


def _features(raw, ranks, all_classes):
    """Features of one text, by definition."""
    key = [(ranks[c], i) for i, c in enumerate(all_classes)]
    marks = {}
    for i in range(len(key)):
        rank, at = min(key[i : i + digests.STRETCH])
        if rank < digests.CLASSES:
            marks[at] = marks.get(at, 0) + 1
    return sorted({at for at, n in marks.items() if n >= digests.MARKS} | ({min(key)[1]} if key else set()))


def test_features_by_definition(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["".join(rng.choice(list("abcdefgh éß\n"), n)) for n in (0, 1, 63, 64, 65, 200, 900, 0, 2000)] + ["x" * 300, "ab" * 100]
    raw, offsets = text_bytes(pa.array(texts))
    ranks = digests.ranks_of(digests.class_counts(raw, offsets))
    want = []
    counts = np.zeros(digests.CLASSES, int)
    for t, text in enumerate(texts):
        own = np.frombuffer(text.encode(), np.uint8)
        found = [min(int(e * digests.CLASSES + 1e-9), digests.CLASSES - 1) for e in _entropies(own)]
        assert found == digests.classes(own).tolist()
        counts += np.bincount(np.array(found, int), minlength=digests.CLASSES)
        want += [offsets[t] + i for i in _features(own, ranks, found)]
    assert counts.tolist() == digests.class_counts(raw, offsets).tolist()
    for block in (100, 1000, 1 << 18):
        monkeypatch.setattr(digests, "BLOCK", block)
        assert digests.features(raw, offsets, ranks).tolist() == want
        assert counts.tolist() == digests.class_counts(raw, offsets).tolist()


def test_filters_chain_and_likeness_is_bounded():
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(4000)]
    texts = [" ".join(words), " ".join(words[:2600] + words[:1400][::-1]), " ".join(words[::-1]), "short", "", "short"]
    raw, offsets = text_bytes(pa.array(texts))
    ranks = digests.ranks_of(digests.class_counts(raw, offsets))
    prints = digests.fingerprints(raw, offsets, ranks)
    n, filters = prints[0]
    assert len(filters) == -(-n // digests.FULL) * digests.BITS // 8 and len(filters) > 512
    assert prints[3] == prints[5] and prints[4] == (0, b"") and digests.likeness(prints[4], prints[4]) == 1
    assert digests.likeness(prints[3], prints[4]) == 0 and digests.likeness(prints[0], prints[0]) == 1
    assert digests.likeness(prints[0], prints[1]) > 0.4 > 0.05 > digests.likeness(prints[0], prints[2])
    for a, b in itertools.combinations(prints, 2):
        assert digests.likeness(a, b) == digests.likeness(b, a) and 0 <= digests.likeness(a, b) <= 1
    assert digests.unpacked(digests.packed(prints[0])) == prints[0]
    assert digests.fingerprints(*text_bytes(pa.array([texts[0]])), ranks)[0] == prints[0]


def _expected(docs, ranks):
    """By descending id, each text edited with the next, from a list."""
    prints = [digests.fingerprints(*text_bytes(pa.array([t or ""])), ranks)[0] for _, t in docs]
    for i, (doc_id, text) in enumerate(docs):
        j = (i + 1) % len(docs)
        text, following = text or "", docs[j][1] or ""
        k = len(text) // 3
        new = text[: len(text) - k] + following[:k]
        other = digests.fingerprints(*text_bytes(pa.array([new])), ranks)[0]
        yield (
            doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), digests.packed(prints[i]), digests.packed(other),
            digests.likeness(prints[i], other), digests.likeness(prints[i], prints[j]),
        )


def test_fingerprint_query_by_brute_force(spark):
    found = queries.QUERIES["op12_fingerprints"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    ordered = [tuple(r) for r in docs.orderBy(F.desc("doc_id")).collect()]
    assert sorted(map(tuple, found)) == sorted(_expected(ordered, digests.rarity(docs)))
    near = [r.near_edited for r in found if r.n_chars > 1000]
    assert np.mean(near) > 0.5 and np.mean([r.near_next for r in found if r.n_chars > 1000]) < 0.2


def test_fingerprints_on_odd_input(spark):
    rows = [(5, "abc"), (None, "no id"), (4, None), (3, ""), (2, "word " * 100_000), (2, "word " * 100_000), (1, "日本語 😀 text " * 20), (0, "é")]
    frame = spark.createDataFrame(rows, "doc_id int, text string").withColumn("n_chars", F.lit(1)).withColumn("fingerprint", F.lit("x"))
    ranks = digests.rarity(frame)
    found = sorted(map(tuple, digests.with_next(frame, ranks).collect()), key=str)
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    assert found == sorted(_expected(order, ranks), key=str)
    assert digests.with_next(frame.where("false"), ranks).count() == 0
    alone = digests.with_next(frame.where("doc_id = 5"), ranks).first()
    assert alone.edited_sha256 == hashlib.sha256(b"aba").hexdigest() and alone.near_next == 1
    assert digests.compute(frame, ranks).count() == len(rows)


# --- Merkle

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(leaves):
    """(top, proofs) of leaves in order: each proof a list of (left, right)."""
    level, at, proofs = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for n, i in enumerate(at):
            run = runs[i // 3]
            proofs[n].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        level, at = [_h(*run) for run in runs], [i // 3 for i in at]
    return level[0], proofs


def _manifest(rows):
    """By definition, for (doc_id, source, lang, n_chars, text)."""
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0], _h(*map(text, row))))
    names = sorted(sources, key=lambda s: b"" if s is None else b"\x01" + s.encode())
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0], r[1]))
        trees[s] = _tree([leaf for _, leaf in sources[s]])
    root, upper = _tree([trees[s][0] for s in names]) if names else (None, [])
    for s, above in zip(names, upper):
        for (doc_id, leaf), proof in zip(sources[s], trees[s][1]):
            yield doc_id, s, leaf, trees[s][0], root, "".join(left + right for left, right in proof + above)


@pytest.mark.parametrize("sizes", [[], [1], [2], [3, 1], [4, 9, 10, 27, 28, 1, 100], [1] * 11])
def test_manifest_by_definition(spark, sizes):
    rows = [
        (None if i == 7 else i // 2, None if s == 2 else f"s{s}é", "en" if i % 3 else None, i, None if i % 5 == 1 else "a\nb" * (i % 4))
        for s, n in enumerate(sizes)
        for i in range(n)
    ]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    frame = frame.withColumn("tree", F.lit(1)).withColumn("digest", F.lit("x"))
    found = merkle.manifest(frame).select("*", merkle.proof_text(F.col("proof")).alias("all"), merkle.folded(F.col("leaf"), F.col("proof")).alias("fold"))
    found = found.collect()
    got = [(r.doc_id, r.source, r.leaf, r.subroot, r.root, r["all"]) for r in found]
    assert sorted(got, key=str) == sorted(_manifest(rows), key=str)
    assert all(r.fold == r.root for r in found)


def test_a_changed_row_does_not_fold_to_the_root(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    other = merkle.leaf_of("doc_id", "source", "lang", "n_chars", F.concat("text", F.lit("!")))
    for r in merkle.manifest(frame, carry={"other": other}).select("root", merkle.folded(F.col("other"), F.col("proof")).alias("fold")).collect():
        assert r.fold != r.root
