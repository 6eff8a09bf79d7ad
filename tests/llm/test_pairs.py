"""Pair operators, substrings, language model and pipeline: brute force on small fixtures."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from martloom.llm import embeddings, hmm, jaccard, queries, substrings  # noqa: E402
from martloom.llm.components import components  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


def rooted(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def copies(rng, n):
    """Texts with exact and near copies, shared passages, odd ones and nothing."""
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda k: [vocabulary[min(399, int(rng.expovariate(0.01)))] for _ in range(k)]
    passage, base, out = text(60), text(90), []
    for i in range(n):
        kind = i % 6
        own = list(base) if kind < 2 else text(rng.randrange(0, 120))
        if kind == 1:
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = "new%d" % rng.randrange(99)
        if kind == 2:
            own[len(own) // 2 : len(own) // 2] = passage
        out.append(" ".join(own))
    return out + ["", None, "a b", "A  b", "é ü é ü é ü é ü", "x" * 5000, "ab" * 3000, "x" * 5000]


@pytest.fixture(scope="module")
def corpus(spark):
    texts = copies(random.Random(6), 120)
    rows = [(i * 3, t, "s", i) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, doc string, key int").repartition(5)
    return frame, {i * 3: t for i, t in enumerate(texts)}


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    edges += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(150)]
    nodes = {n for e in edges for n in e}
    want = {n: r for n, r in rooted(nodes, edges).items() if n != r}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_jaccard_join_by_brute_force(corpus):
    frame, texts = corpus
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    ids = list(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = {(i, len(sets[i]), r) for i, r in rooted(ids, links).items()}
    assert {tuple(r) for r in jaccard.join(frame).collect()} == want
    kept = jaccard.first_of_each(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {r for _, _, r in want}


def test_jaccard_join_of_repeats_and_nothing(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (3, "A B  c d e f")]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles) for r in got) == [("1", 2), ("1", 2), ("2", 0), ("3", 2), ("None", 2)]
    assert {r.component_id for r in got if r.doc_id in (1, 3)} == {1}
    assert jaccard.join(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_rarest_shingles_are_ordered_by_class_and_whole_hash():
    rng = np.random.default_rng(5)
    for bits in (64, 10):  # with few bits many hashes agree in all but the lowest eight
        sets = [np.unique(rng.integers(0, 1 << bits, k, dtype=np.uint64, endpoint=False) if bits < 64 else rng.integers(0, 1 << 63, k, dtype=np.uint64) * 2) for k in (0, 1, 40, 0, 300)]
        offsets, hashes = np.cumsum([0, *map(len, sets)]), np.concatenate(sets)
        classes = rng.integers(0, 3, 1 << 22).astype(np.uint8)
        wanted = np.array([len(x) // 3 + (len(x) > 0) for x in sets])
        want = [sorted(x.tolist(), key=lambda v: (classes[v >> 42], v))[:k] for x, k in zip(sets, wanted)]
        assert hashes[jaccard._rarest(offsets, hashes, classes, wanted)].tolist() == [v for x in want for v in x]


def test_only_texts_with_a_wanted_mark_are_cut_again(spark):
    bits = jaccard._bitmap(spark.createDataFrame([(m,) for m in (0, 1, 32767, 32768, jaccard._MARKS - 1, 7, 7)], "mark int"))
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == [0, 1, 7, 32767, 32768, jaccard._MARKS - 1]
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text, 5), (2, text + " eight", 9), (3, text, 6)], "doc_id long, text string, mark int")
    (low, high), (_, hashes) = [int(k) for k in jaccard._keys(*jaccard.shingle_sets(pa.array([text, text + " eight"])))], jaccard.shingle_sets(pa.array([text]))
    sets = spark.createDataFrame([(low, 5), (high, 9), (low, 6)], "key long, mark int")
    pairs = spark.createDataFrame([(low, high)], "a long, b long")
    assert len(hashes) == 3 and [tuple(r) for r in jaccard._verified(pairs, docs, sets).collect()] == [(low, high)]
    # the text of the least mark stands for its set
    assert jaccard._verified(pairs, docs.where("mark != 5"), sets).count() == 0


def test_set_bounds_and_links():
    rng = np.random.default_rng(3)
    for _ in range(300):
        x = np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64))
        y = np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64))
        same, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
        assert jaccard.suffix_bound(x, y) >= same
        assert jaccard.linked(x, y) == (100 * same >= 75 * union)


def plain_repeats(texts):
    seen, out = {}, {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        covered = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if raw[k : k + 50] in seen:
                covered[k : k + 50] = b"\1" * 50
        for k in range(len(raw) - 49):
            seen.setdefault(raw[k : k + 50], i)
        out[i] = (raw, covered)
    return out


@pytest.mark.parametrize("hot", [2000, 3])
def test_removed_substrings_by_brute_force(corpus, monkeypatch, hot):
    frame, texts = corpus
    monkeypatch.setattr(substrings, "HOT", hot)
    got = {r.doc_id: (bytes(r.left), [tuple(s) for s in r.spans]) for r in substrings.find(frame).collect()}
    lost = 0
    for i, (raw, covered) in plain_repeats(texts).items():
        left = bytes(b for b, c in zip(raw, covered) if not c)
        lost += len(left) < len(raw)
        assert got.get(i, (raw, []))[0] == left
        assert (i in got) == (len(left) < len(raw))
    assert lost > 50


@pytest.mark.parametrize("hot", [2000, 1])
def test_short_windows_in_unlike_surroundings(spark, monkeypatch, hot):
    rng = random.Random(21)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [letters(n) for n in (49, 50, 50, 51, 55, 64, 70)]
    texts = {i: letters(rng.randrange(0, 40)) + rng.choice(shared) + letters(rng.randrange(0, 40)) for i in range(160)}
    texts[160] = shared[1]
    monkeypatch.setattr(substrings, "HOT", hot)
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: bytes(r.left) for r in substrings.find(frame).collect()}
    want = {i: bytes(b for b, c in zip(raw, covered) if not c) for i, (raw, covered) in plain_repeats(texts).items() if any(covered)}
    assert len(want) > 100 and got == want


def test_parts_of_texts_and_of_contexts_change_no_result(corpus, monkeypatch):
    def found():
        return {r.doc_id: [tuple(x) for x in r.spans] for r in substrings.find(corpus[0]).collect()}

    whole = found()
    monkeypatch.setattr(substrings, "PART", 1)
    monkeypatch.setattr(substrings, "CONTEXTS", 1)
    assert whole and found() == whole


def test_common_windows_are_those_of_the_plain_search():
    rng = random.Random(8)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 40))) for _ in range(30)]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    piece, place, group = substrings.common_windows(raw, offsets, 8)
    groups = {}
    for p, at, g in zip(piece.tolist(), place.tolist(), group.tolist()):
        groups.setdefault(g, set()).add(pieces[p][at : at + 8])
    found = Counter(p[k : k + 8] for p in pieces for k in range(len(p) - 7))
    assert all(len(w) == 1 for w in groups.values())
    assert {next(iter(w)) for w in groups.values()} == {w for w, n in found.items() if n > 1}


def test_substrings_of_odd_frames(spark):
    rows = [(None, "z" * 200), (1, "z" * 200), (1, "z" * 200), (2, None), (3, "short")]
    assert substrings.find(spark.createDataFrame(rows, "doc_id bigint, text string")).count() == 0
    assert substrings.find(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_contexts_that_agree_in_32_bits_of_their_hash_are_no_copies(spark):
    texts = [
        "nkmzonsppnzdqojbpkkxanqtbqcskzmgvaiahnsdakgzoyzoxzvftgdjnmyvetyubvcwrlyhwgmypkle",
        "vkobyfkusrzxnszvnaewijsakbyxtimgvaiahnsdakgzoyzoxzwwrmkbzkonqvbglikritsikpjwolku",
        "eailpnclnnwtzsycewltpmbvgfzmuamgvaiahnsdakgzoyzoxzwoftkkylxoiueywmilbnkzyrnyfbpq",
        "vmzadtrrmdrtjtgrebnnxlfqzhwomnmgvaiahnsdakgzoyzoxzsflagyfdjfwlwjkhrtmacchnbzbrwt",
    ]
    assert substrings.find(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).count() == 0


def test_embeddings_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 40)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 24))
    x = [(centres[i % 6] + rng.normal(size=24) * (0.3 if i % 6 < 4 else 2)).astype(np.float32).tolist() for i in range(300)]
    x += [x[0]] * 20 + [[0.0] * 24, None, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, None] + [1.0] * 22, [], [1.0, 2.0], [2.0, 4.0]]
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>, key int")
    good = {i: np.array(v, float) for i, v in enumerate(x) if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [
        (a, b) for a in good for b in good
        if b < a and len(good[a]) == len(good[b]) and good[a] @ good[b] / (np.linalg.norm(good[a]) * np.linalg.norm(good[b])) >= 0.9
    ]
    n, root = Counter(i for p in links for i in p), rooted(range(len(x)), links)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame).collect()}
    assert got == {i: (n[i], root[i]) for i in range(len(x))} and len(links) > 100
    assert embeddings.near_duplicates(frame.where("false")).count() == 0


def test_tiles_are_compared_without_a_shuffle(spark, monkeypatch):
    plans, plain = [], embeddings.staged
    monkeypatch.setattr(embeddings, "staged", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df))
    monkeypatch.setattr(embeddings, "TILE", 16)
    monkeypatch.setattr(embeddings, "BLOCK", 4)
    x = np.random.default_rng(7).normal(size=(90, 20))
    x[60:] = x[:30] + 0.05 * x[30:60]
    x[89] = -0.0 * x[0]
    x[88], x[87, 3] = x[0], -0.0
    x[86] = x[87] + 0.0  # equal but for the sign of a zero
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(frame).collect()}
    with np.errstate(invalid="ignore"):
        near = np.argwhere(np.tril(x @ x.T / np.linalg.norm(x, axis=1) / np.linalg.norm(x, axis=1)[:, None], -1) >= 0.9).tolist()
    n, root = Counter(i for p in near for i in p), rooted(range(90), near)
    assert got == {i: (n[i], root[i]) for i in range(90)} and len(near) > 25
    pairs = [p for p in plans if "raw_b" in p]
    assert len(pairs) == 1 and "Exchange" not in pairs[0]


# --- language model

def test_forward_and_expected_counts_by_enumeration():
    rng = np.random.default_rng(4)
    k, symbols = 3, 5
    rows = lambda *shape: (lambda m: m / m.sum(axis=-1, keepdims=True))(rng.uniform(0.1, 1, shape))
    model = hmm.Model(rows(k), rows(k), rows(k, k), rows(k, symbols).T)
    texts = [[0, 3, 4], [1], [2, 2, 1, 0]]
    seen, offsets = np.concatenate(texts), np.array([0, 3, 4, 8])
    emitted, moves, starts = hmm.expected(offsets, seen, model)
    logs = hmm.likelihood(offsets, seen, model)
    want_moves, want_starts = np.zeros((k, k)), np.zeros(k)
    for i, text in enumerate(texts):
        paths = np.array(np.meshgrid(*[range(k)] * len(text))).reshape(len(text), -1).T
        p = [model.start[q[0]] * model.emissions[text[0], q[0]] * math.prod(model.moves[a, b] * model.emissions[s, b] for a, b, s in zip(q, q[1:], text[1:])) for q in paths]
        assert np.isclose(logs[i], math.log(sum(p)))
        for q, w in zip(paths, np.array(p) / sum(p)):
            want_starts[q[0]] += w
            for a, b in zip(q, q[1:]):
                want_moves[a, b] += w
    assert np.allclose(moves, want_moves) and np.allclose(starts, want_starts) and np.allclose(emitted.sum(axis=1), 1)


def test_symbols_are_those_of_each_word():
    head = {"b": 1, "the": 0, "ü": 2}
    texts = pa.array(["The b ü été x", None, "", "xyz 日本語 b " + "q" * 300])
    offsets, seen, _, _ = hmm.symbols(texts, head)
    want = [[head.get(w, 4 + hmm.class_of(w)) for w in words(t)] + [3] for t in texts.to_pylist()]
    assert seen.tolist() == [x for row in want for x in row] and np.diff(offsets).tolist() == [len(x) for x in want]
    rare = pa.array(["été", "x", "", "日本語", "xyz"])
    assert hmm._classes(rare).tolist() == [hmm.class_of(w) for w in rare.to_pylist()]
    assert hmm._bucket_of(rare, 7).tolist() == [zlib.crc32(w.encode()) % 7 for w in rare.to_pylist()]


def test_short_words_are_hashed_side_by_side(monkeypatch):
    few = ["", "a", "été", "日本語" * 7, "q" * 63, "q" * 64, "x" * 70_000, "é" * 40]
    want, alone, plain = [zlib.crc32(w.encode()) % 97 for w in few * 50], [], zlib.crc32
    monkeypatch.setattr(hmm.zlib, "crc32", lambda data: alone.append(len(data)) or plain(data))
    assert hmm._bucket_of(pa.array(["left out", *few * 50]).slice(1), 97).tolist() == want
    assert set(alone) == {64, 80, 70_000} and len(alone) == 150  # words of 64 bytes and more


def test_known_words_are_indexed_once_for_all_slices(monkeypatch):
    lists, calls, plain = [pa.array(x, pa.string()) for x in (["b", "x"], [], ["a", "c", "b"])], [], hmm.pc.index_in
    monkeypatch.setattr(hmm.pc, "index_in", lambda *a, **b: calls.append(1) or plain(*a, **b))
    assert [x.tolist() for x in hmm._found(lists, pa.array(["a", "b", "c"]), 3)] == [[1, 3], [], [0, 2, 1]] and len(calls) == 1
    assert [x.tolist() for x in hmm._found(lists, None, 3)] == [[3, 3], [], [3, 3, 3]] and hmm._found([], pa.array(["a"]), 1) == []


@pytest.mark.parametrize("least", [1e-300, 1e-12, 1e-2])
def test_scores_scaled_now_and_then_are_those_scaled_at_each_token(least):
    rng = np.random.default_rng(8)
    k, n = 4, np.array([0, 1, 700, 33, 1, 32, 31, 0, 64])
    rows = lambda *shape: (lambda m: m / m.sum(axis=-1, keepdims=True))(rng.uniform(0.1, 1, shape))
    model = hmm.Model(rows(k), rows(k), rows(k, k), np.append(least * rng.uniform(1, 2, (5, k)), rng.uniform(0.1, 1, (5, k)), axis=0))
    offsets = np.concatenate([[0], np.cumsum(n)])
    seen = rng.integers(0, 10, offsets[-1])
    for got, a, b in zip(hmm.likelihood(offsets, seen, model), offsets, offsets[1:]):
        alpha, log = model.start, 0.0
        for i, s in enumerate(seen[a:b]):
            alpha = (alpha @ model.moves if i else alpha) * model.emissions[s]
            log, alpha = log + math.log(alpha.sum()), alpha / alpha.sum()
        assert math.isclose(got, log, rel_tol=1e-12, abs_tol=1e-12)


def test_runs_beyond_one_group_have_the_same_expected_counts(monkeypatch):
    rng = np.random.default_rng(9)
    rows = lambda *shape: (lambda m: m / m.sum(axis=-1, keepdims=True))(rng.uniform(0.1, 1, shape))
    model = hmm.Model(rows(3), rows(3), rows(3, 3), rows(3, 20).T)
    offsets = np.concatenate([[0], np.cumsum(rng.integers(0, 400, 40))])
    seen = rng.integers(0, 20, offsets[-1])
    want = hmm.expected(offsets, seen, model)
    monkeypatch.setattr(hmm, "SIDE", 7)
    got = hmm.expected(offsets, seen, model)
    assert all(np.allclose(x, y) for x, y in zip(got, want)) and np.allclose(got[0].sum(axis=1), 1)


def test_long_sequences_are_scored_whole_and_cut_only_for_training():
    rng = np.random.default_rng(4)
    seen = rng.integers(0, 4, 3 * hmm.RUN + 7)
    even = np.full(2, 0.5)
    model = hmm.Model(even, even, np.full((2, 2), 0.5), np.full((4, 2), 0.25))
    offsets = np.array([0, len(seen)])
    assert np.isclose(hmm.likelihood(offsets, seen, model)[0], len(seen) * math.log(0.25))
    emitted, _, starts = hmm.expected(offsets, seen, model)
    assert np.allclose(emitted.sum(axis=1), 1) and np.isclose(starts.sum(), 1)


def test_model_is_a_distribution_over_words(spark):
    docs = spark.createDataFrame([(i, "the cat sat on mat%d the end" % i) for i in range(40)], "doc_id bigint, text string")
    counts = hmm.count_words(docs, head=3)
    model = hmm.fit(docs, counts, states=2, start_rounds=2, rounds=1)
    assert np.allclose(model.emissions.sum(axis=0), 1) and np.allclose(model.moves.sum(axis=1), 1)
    assert np.isclose(counts.unigram.sum(), 1 + 0.5 * (hmm.CLASSES - 1) / counts.total)


def test_base_scores_by_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    held = {i for i in docs if zlib.crc32(str(i).encode()) % 5 == 1}
    tokens = {i: [*words(t), "\n"] for i, t in docs.items()}
    c = Counter(w for i, ws in tokens.items() if i not in held for w in ws)
    n, v = sum(c.values()), len(c)
    got = queries.QUERIES["op3_lm_score"](spark, SF_DIR).collect()
    for r in got:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id in held, len(tokens[r.doc_id]), sum(c[w] > 0 for w in tokens[r.doc_id]), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    assert len(got) == len(docs) and sum(r.score - r.base_score for r in got if r.held_out) > 0


def test_language_model_of_odd_frames(spark):
    rows = [(1, None, 0), (2, "", 0), (2, "", 0), (None, "word", 0), (3, "w " * 30_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row int")
    nothing = hmm.count_words(docs.where("false"))
    model = hmm.fit(docs.where("false"), nothing, start_rounds=1, rounds=1)
    scored = hmm.score(docs, nothing, model).collect()
    assert len(scored) == 5 and {r.n_known for r in scored} == {0} and {r.base_score for r in scored} == {0.0}
    assert hmm.score(docs.where("false"), nothing, model).count() == 0


def test_words_outside_the_head_have_emissions_of_their_own(spark):
    texts = ["a a a a a kzz", "b b b b b mzz"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts = hmm.count_words(docs, head=2)
    assert set(counts.head) == {"a", "b"} and hmm.class_of("kzz") == hmm.class_of("mzz")
    model = hmm.fit(docs, counts, states=2, start_rounds=3, rounds=3)
    odd = spark.createDataFrame([(1, "a a a a a kzz"), (2, "a a a a a mzz")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in hmm.score(odd, counts, model).collect()}
    assert math.isclose(got[1].base_score, got[2].base_score) and got[1].score > got[2].score + 0.01


def test_head_is_filled_among_words_of_one_count(spark):
    words = [a + b for a in "dacb" for b in "yxz"]
    docs = spark.createDataFrame([(1, " ".join(words + ["more", "more"]))], "doc_id bigint, text string")
    for head in (1, 2, 5, 8, 12, 13, 20):
        assert list(hmm.count_words(docs, head=head).head) == ["more", *sorted(words)][:head]


def test_start_rounds_cover_all_learning_documents(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "word%d and more" % i) for i in range(60)], "doc_id bigint, text string")
    seen, plain = [], hmm._round

    def spied(part, *others):
        seen.append({i for r in part.where("bucket = -1").collect() for i in r.ids})
        return plain(part, *others)

    monkeypatch.setattr(hmm, "_round", spied)
    hmm.fit(docs, hmm.count_words(docs), states=2, start_rounds=4, rounds=0)
    assert set().union(*seen) == set(range(60)) and len(seen) == 4
    assert max(len(x) for x in seen) < 60


# --- the whole

def test_pipeline_keeps_what_its_stages_decide(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert sorted(after.columns) == sorted(docs.columns), name
        docs = spark.createDataFrame(after.collect(), docs.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert set(got) == set(texts) and len(texts) > 100
    assert all(got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items())
    assert not [t for t in texts.values() if re.search(r"[a-z0-9]@[a-z]+\.", t)]


def test_every_operator_is_registered_once():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def test_extra_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", 1, 2)], "doc_id bigint, text string, key int, root int").withColumn("size", F.lit(3))
    assert jaccard.first_of_each(docs).columns == docs.columns
