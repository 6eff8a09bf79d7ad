"""Quality, licences, personal data, language, decontamination and BPE: brute force and odd input."""

import base64
import itertools
import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from martloom.llm import bpe, decontaminate, langid, licences, pii, quality, queries  # noqa: E402
from martloom.llm.common import slices, words_of  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LONG = "word " * 40_000
ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "a"), (4, "…¿ 12 €"), (5, "same text here"), (6, "same text here"),
    (6, "same text here"), (None, "no id"), (7, LONG), (8, "x" * 100_000), (9, "<|endoftext|> 日本語 😀 é"),
]


@pytest.fixture
def odd(spark):
    """Odd texts, with extra columns whose names operators use inside."""
    rows = [(i, t, "en", i) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, key bigint").withColumn("words", F.lit(1))


@pytest.fixture
def empty(odd):
    return odd.where("false")


def test_words_are_split_at_ascii_white_space_only():
    offsets, words = words_of(pa.array([" A\tb c\x0b\x0cD ", None, "", "É"]))
    assert words.to_pylist() == ["a", "b c", "d", "É"] and offsets.tolist() == [0, 3, 3, 3, 4]


# --- quality

def test_quality_on_odd_and_empty_frames(odd, empty, spark):
    stats = quality.with_statistics(odd)
    labels = spark.createDataFrame([(5, 1, 9), (6, 1, 9), (1, 0, 9), (0, 0, 9), (99, 1, 9), (3, None, 9), (4, 5, 9)], "doc_id bigint, quality int, x int")
    model = quality.fit(stats, labels)
    scored = quality.score(stats, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert quality.score(quality.with_statistics(empty), model).count() == 0
    none = quality.fit(stats, labels.where("false"))
    assert {r.score for r in quality.score(stats, none).collect()} == {0.5}
    one = quality.fit(stats, labels.where("quality = 1"))
    assert all(r.score > 0.99 for r in quality.score(stats, one).collect())
    kept = quality.keep_good(odd, model)
    assert kept.columns == odd.columns and quality.keep_good(empty, model).count() == 0


def test_discriminant_is_the_difference_of_gaussian_log_densities():
    rng = np.random.default_rng(1)
    means, covariances = rng.normal(size=(2, 3)), [np.diag([1.0, 2, 3]), np.array([[2, 0.5, 0], [0.5, 1, 0], [0, 0, 1]])]
    model = quality.Model(means, np.array([np.linalg.cholesky(c) for c in covariances]), np.array([np.log(np.linalg.det(c)) for c in covariances]), 1.0, 0.0)
    x = rng.normal(size=(20, 3))
    logs = [[-0.5 * (v - m) @ np.linalg.inv(c) @ (v - m) - 0.5 * np.log(np.linalg.det(c)) for v in x] for m, c in zip(means, covariances)]
    assert np.allclose(np.sinh(model.differences(x)), np.array(logs[1]) - logs[0])


def test_logistic_scale_takes_all_labelled_rows_in_any_order(spark):
    n = 120_000
    ids = spark.range(0, n, 1, 8)
    y = (F.col("id") >= 90_000).cast("int")  # stored by class
    x = F.array(*(F.randn(i) + (y if i < 2 else 0) for i in range(len(quality.STATISTICS))))
    stats = ids.select(F.col("id").alias("doc_id"), x.alias("x"))
    model = quality.fit(stats, ids.select(F.col("id").alias("doc_id"), y.alias("quality")))
    assert math.isclose(quality.score(stats, model).agg(F.avg("score")).first()[0], 0.25, abs_tol=1e-4)


def test_logistic_scale_is_the_least_loss_where_whole_steps_lead_away(spark):
    rng, d = np.random.default_rng(3), len(quality.STATISTICS)
    y = (rng.random(2000) < 0.86).astype(int)
    z = np.where(y == 1, -4, -7) + rng.normal(0, 0.6, 2000)
    model = quality.Model(np.eye(2, d)[::-1] * [[0], [1]], np.array([np.eye(d)] * 2), np.zeros(2), 1.0, 0.0)
    axis = int(np.flatnonzero(model.means[1])[0])
    x = np.zeros((2000, d))
    x[:, axis] = np.sinh(z) + 0.5
    assert np.allclose(model.differences(x), z)
    slope, offset = quality._logistic(spark.createDataFrame([(int(a), b) for a, b in zip(y, x.tolist())], "y int, x array<double>"), model)
    miss = 1 / (1 + np.exp(-slope * z - offset)) - y
    assert slope > 0 and abs(miss.sum() + 1e-3 * offset) < 1e-4 and abs((miss * z).sum() + 1e-3 * slope) < 1e-4


def test_quality_of_held_out_documents(spark):
    rows = queries.QUERIES["op10_quality"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)


# --- licences

def test_licences_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    import re

    for r in queries.QUERIES["op4_licences"](spark, "/root/testdata/sf0.01").collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in texts[r.doc_id])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places, labels = [], set()
        for phrase, label in licences.BASE_PHRASES.items():
            parts = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            places += at
            labels |= {label} if at else set()
        want = (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert labels <= set(r.labels.split(","))


@pytest.mark.parametrize("text, want", [
    ("MIT", (["mit"], True)),
    ("MIT OR GPL-3.0-only", (["gpl", "mit"], True)),
    ("Apache-2.0 AND (MIT OR GPL-2.0)", (["apache", "gpl", "mit"], True)),
    ("(MIT AND GPL-2.0-or-later WITH Classpath-exception-2.0)", (["gpl", "mit"], False)),
    ("MIT OR", None), ("(MIT", None), ("AND MIT", None), ("", None), ("()", None),
    ("MIT */ more text", (["mit"], True)),
])
def test_licence_expressions(text, want):
    assert licences.evaluate(text) == want


def test_licences_on_odd_and_empty_frames(odd, empty):
    found = licences.find(odd)
    assert found.count() == len(ODD) and licences.find(empty).count() == 0
    assert {r.n_words for r in found.where("doc_id = 0").collect()} == {0}
    deep = odd.sparkSession.createDataFrame([(1, "SPDX-License-Identifier: " + "(" * 5000 + "MIT" + ")" * 5000)], "doc_id int, text string")
    assert licences.find(deep).first().labels == ["mit"]


# --- personal data

def test_personal_data_equals_the_plain_patterns(spark):
    import re

    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    texts += ["a@b.c@d.e x.@y-z.co.uk. @no.de a@@b.c u@x", "1.2.3.4.5 999.1.1.1 01.002.3.255", "+1 (555) 010-9999 x +12-", "4111-1111 1111 1111 4111 1111 1111 1112"]
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    for text in texts:
        want = [("email", *m.span()) for m in email.finditer(text)]
        want += [("ip", *m.span()) for m in ip.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        want += [("card", *m.span()) for m in card.finditer(text) if 12 <= len(d := re.sub(r"\D", "", m[0])) <= 19 and pii.luhn(d)]
        want += [("phone", *m.span()) for m in phone.finditer(text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
        got = [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS]
        assert got == sorted(want, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_added_kinds_and_masks():
    text = "Bank account GB82 WEST 1234 5698 7654 32, ssn 123-45-6789" + " and so on" * 5 + ", order no 123-45-6789, mail bob@x.org"
    assert [s[0] for s in pii.spans_of(text)] == ["iban", "national_id", "email"]
    assert pii.masked(text) == "Bank account [IBAN], ssn [NATIONAL_ID]" + " and so on" * 5 + ", order no 123-45-6789, mail [EMAIL]"
    assert pii.masked(None) is None and pii.masked("") == ""
    assert pii.spans_of("GB82 WEST 1234 5698 7654 33") == []


def test_personal_data_on_odd_and_empty_frames(odd, empty):
    assert pii.find(odd).count() == len(ODD) and pii.find(empty).count() == 0
    masked = pii.redact(odd)
    assert masked.columns == odd.columns and sorted(map(str, masked.collect())) == sorted(map(str, odd.collect()))
    slow = "a" * 100_000 + " @ " + "+" + "(" * 100_000 + "1" * 100_000
    assert [s for s in pii.spans_of(slow) if s[0] == "email"] == []


# --- language

def test_forward_sums_all_segmentations():
    names = sorted(["▁", "a", "b", "ab", "ba", "▁a", "aba"])
    pieces = langid.Pieces.of(names)
    p = np.random.default_rng(2).uniform(0.05, 0.3, (2, len(names)))
    model = langid.Model(["x", "y"], pieces, p)
    words = ["a", "aba", "abab", "ba" * 20, "ac"]

    def total(text, probabilities):
        done = [1.0] + [0.0] * len(text)
        for t, k in ((t, k) for t in range(1, len(text) + 1) for k in range(1, t + 1)):
            piece = text[t - k : t]
            q = probabilities[names.index(piece)] if piece in names else langid._UNKNOWN if k == 1 else 0.0
            done[t] += done[t - k] * q
        return math.log(done[-1])

    want = [[total("▁" + w, row) for row in p] for w in words]
    assert np.allclose(model.word_scores(words), want)


def test_expected_counts_by_enumeration():
    names = sorted(["▁", "a", "b", "ab", "▁a"])
    pieces, p = langid.Pieces.of(names), np.array([0.1, 0.2, 0.3, 0.15, 0.25])
    text, ways = "▁aab", []
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
        parts = [text[a:b] for a, b in zip(at, at[1:])]
        if all(x in names for x in parts):
            ways.append((math.prod(p[names.index(x)] for x in parts), parts))
    z = sum(w for w, _ in ways)
    want = [3 * sum(w * parts.count(n) for w, parts in ways) / z for n in names]
    assert np.allclose(langid.expected_counts(["aab"], np.array([3.0]), pieces, p), want)


def test_expected_counts_of_long_words_equal_exact_fractions():
    rng = random.Random(5)
    names = sorted(["▁", "a", "b", "ab", "▁a", "abba", "bbbbbbbbbbbb"])
    p = np.array([rng.uniform(1e-4, 0.2) for _ in names])
    words, weights = ["".join(rng.choice("abbbx") for _ in range(n)) for n in (1, 70, 150, 150)], np.array([1.0, 2.0, 3.0, 4.0])
    exact = dict(zip(names, map(Fraction, p)))
    want = np.zeros(len(names))
    for word, weight in zip(words, weights):
        text = "▁" + word
        ends = [(t, t - k, text[t - k : t]) for t in range(1, len(text) + 1) for k in range(1, min(t, 12) + 1)]
        steps = [(t, s, x, exact.get(x, Fraction(langid._UNKNOWN) if t - s == 1 else 0)) for t, s, x in ends]
        ahead, behind = [Fraction(1)] + [Fraction(0)] * len(text), [Fraction(0)] * len(text) + [Fraction(1)]
        for t, s, _, q in steps:
            ahead[t] += ahead[s] * q
        for t, s, _, q in reversed(steps):
            behind[s] += behind[t] * q
        for t, s, x, q in steps:
            if x in exact:
                want[names.index(x)] += weight * float(ahead[s] * q * behind[t] / ahead[-1])
    assert np.allclose(langid.expected_counts(words, weights, langid.Pieces.of(names), p), want)


def test_all_lower_case_pieces_and_words_of_any_length_are_learned(spark):
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    names = langid.vocabulary(PIECES)
    every = (i for i in range(processor.get_piece_size()) if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)))
    assert set(names) == {x for x in map(processor.id_to_piece, every) if x == x.lower()}
    assert len(names) > 20_000 and langid.Pieces.of(names).longest == max(map(len, names))
    rows = [(1, "aa", "information" * 300), (2, "bb", "waschmaschine" * 300)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"), PIECES, rounds=2)
    tests = spark.createDataFrame([(1, "informationinformation"), (2, "maschine"), (3, "½ ² Ⅷ"), (4, "7 _ 8")], "doc_id bigint, text string")
    assert dict(langid.predict(tests, model).select("doc_id", "lang_pred").collect()) == {1: "aa", 2: "bb", 3: "und", 4: "und"}


def test_language_of_held_out_and_odd_texts(spark, odd, empty):
    rows = queries.QUERIES["op1_langid"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.where("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    model = langid.fit(odd, PIECES, rounds=1)
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(odd, model).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (4, "und"), (3, "en"), (None, "en")} <= got
    assert langid.predict(empty, model).count() == 0
    nothing = langid.fit(empty, PIECES)
    assert {r.lang_pred for r in langid.predict(odd, nothing).collect()} == {"und"}


# --- decontamination

def test_search_finds_what_plain_bm25_finds():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    words = lambda n: [vocabulary[min(299, int(rng.expovariate(0.02)))] for _ in range(n)]
    items = [(i, words(rng.randrange(6, 50))) for i in range(60)]
    texts = []
    for k in range(80):
        text = words(rng.randrange(0, 600))
        if k % 3 == 0:
            item = items[rng.randrange(60)][1]
            at = rng.randrange(len(text) + 1)
            text[at:at] = item if k % 2 else [w for w in item if rng.random() < 0.9]
        texts.append(" ".join(text))
    index = decontaminate.build_index(items)
    got = {(r, i): s for r, i, s, *_ in decontaminate.search(pa.array(texts), index)}
    n, mean = len(items), sum(len(w) for _, w in items) / len(items)
    used = {w: sum(w in x for _, x in items) for w in vocabulary}
    idf = {w: math.log(1 + (n - m + 0.5) / (m + 0.5)) for w, m in used.items()}
    length, want = decontaminate.STRIDE + max(len(w) for _, w in items), {}
    for r, text in enumerate(texts):
        t = text.split()
        for s in range(0, max(1, len(t)), decontaminate.STRIDE):
            passage = t[s : s + length]
            runs = decontaminate._runs(passage) if passage else set()
            for i, w in items:
                norm = decontaminate.K1 * (1 - decontaminate.B + decontaminate.B * len(w) / mean)
                own = {x: idf[x] * w.count(x) / (w.count(x) + norm) for x in set(w)}
                score = sum(v for x, v in own.items() if x in set(passage)) / sum(own.values())
                question, answer = decontaminate._question_and_answer(w)
                both = min(len(question & runs) / len(question), len(answer & runs) / len(answer))
                if score >= decontaminate.THRESHOLD and both >= decontaminate.OVERLAP:
                    want[r, i] = max(score, want.get((r, i), 0))
            if s + length >= len(t):
                break
    assert want and set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_decontamination_on_odd_and_empty_frames(spark, odd, empty):
    items = spark.createDataFrame([(1, "one two three four five six seven eight", 0), (1, None, 0), (2, "short", 0), (None, "a b c d e f g h", 0)], "item_id bigint, text string, score int")
    more = odd.unionByName(odd.limit(1).withColumn("doc_id", F.lit(50).cast("bigint")).withColumn("text", F.lit("Zero ONE, two three; four five six seven eight nine")))
    assert [(r.doc_id, r.item_id) for r in decontaminate.matches(more, items).collect()] == [(50, 1)]
    kept = decontaminate.clean(more, items)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    assert decontaminate.matches(empty, items).count() == 0 and decontaminate.matches(odd, items.where("false")).count() == 0
    assert decontaminate.clean(odd, items.where("false")).count() == len(ODD)


def test_matches_do_not_depend_on_the_parts_of_the_index(spark, monkeypatch):
    rng = random.Random(14)
    words = lambda n: [f"w{min(400, int(rng.expovariate(0.02)))}" for _ in range(n)]
    items = [(i, " ".join(words(rng.randrange(6, 40)))) for i in range(60)]
    texts = [(k, " ".join(words(rng.randrange(0, 300)) + items[rng.randrange(60)][1].split() + words(20))) for k in range(60)]
    docs, held = spark.createDataFrame(texts, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    found = []
    for size in (7, 20_000):
        monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", size)
        found.append(sorted(map(tuple, decontaminate.matches(docs, held).collect())))
    assert len(found[0]) >= 60 and found[0] == found[1]
    plain = decontaminate.build_index([(i, t.split()) for i, t in items])
    want = decontaminate.search(pa.array([t for _, t in texts]), plain)
    assert found[1] == sorted((texts[r][0], plain["ids"][i], *rest) for r, i, *rest in want)


def test_statistics_of_many_texts_take_little_memory_and_do_not_depend_on_slices():
    import tracemalloc

    rng = random.Random(4)
    texts = pa.array([" ".join(rng.choices(["word", "Other", "12|", "x\n", "caf\u00e9"], k=700)) for _ in range(3000)] + [None, ""])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    tracemalloc.start()
    parts = [quality.statistics(p.column(0)) for p in slices(batch, "text", quality.SLICE)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(parts) > 5 and peak < 60 << 20  # 8 MB at once took over 100 MB
    assert np.array_equal(np.concatenate(parts), quality.statistics(texts))


# --- byte-level BPE

def test_bpe_equals_the_tokenizer_library(spark, odd, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").union(odd.select(F.col("doc_id") + 10_000, "text"))
    rng = random.Random(2)
    long = ["".join(rng.choices("etaoin shrdlu"[:n], k=1500)) for n in (3, 5)] + ["日本語" * 300, "ab" * 130, "q" * 255, "q" * 256]
    docs = docs.union(spark.createDataFrame([(20_000 + i, t) for i, t in enumerate(long)], "doc_id bigint, text string"))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, block_bytes=150_000)
    rows = encoded.select("doc_id", "ids", bpe.decoded(F.col("ids"), RANKS).alias("bytes")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.bytes) == texts[r.doc_id].encode()
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_splits_each_chunk_of_a_block_once_and_as_the_pattern_does(monkeypatch):
    rng, split = random.Random(3), regex.compile(public_tokenizers.PATTERN)
    parts = ["a", "b\u00e9", " ", " ", "1", "'s", "'", "!", "\n", "\u3000", "\x1c", "\u65e5", "\t"]
    texts = ["".join(rng.choices(parts[:k], k=rng.randrange(60))) for k in (3, 4, 6, 8, 13) for _ in range(300)] + [None, "", " ", "  "]
    for limit in (1 << 20, 20):
        monkeypatch.setattr(bpe, "LONG_TEXT", limit)
        for pattern in (public_tokenizers.PATTERN, public_tokenizers.PATTERN + "|x{9}"):
            chunks = bpe._Chunks(pattern, [pa.array(texts[:100]), pa.array(texts[100:])])
            sizes, words, places = chunks.words()
            ends, found, words = np.cumsum(sizes), np.split(chunks.codes(), chunks.ends())[:-1], words.to_pylist()
            got = [[words[p] for c in codes for p in places[ends[c] - sizes[c] : ends[c]]] for codes in found]
            assert got == [split.findall(t or "") for t in texts]
    chunks = bpe._Chunks(public_tokenizers.PATTERN, [pa.array(["one two, three"] + ["two, three two,"] * 1000)])
    assert len(chunks.codes()) == 3003 and len(chunks.words()[0]) == 4  # one, two, (twice: at a begin and after a space), three


def test_bpe_decodes_what_it_encodes(spark, odd):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").union(odd.select(F.col("doc_id") + 10_000, "text"))
    rows = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decode=True).select("*", bpe.decoded(F.col("ids"), RANKS).alias("plain")).collect()
    assert len(rows) == docs.count() and all(r.decoded == r.plain for r in rows)


def test_bpe_keeps_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "Hello unfoldableword"), (None, "x"), ("a", None)], "doc_id string, text string")
    rows = bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or "", len(r.ids) > 0) for r in rows) == [("", True), ("a", False), ("a", True)]


# --- personal data: long digits and secrets

def test_a_million_digits_take_linear_time():
    import time

    start = time.time()
    assert pii.spans_of("1" * 1_000_000) == [] and pii.spans_of("12." * 300_000) is not None
    assert time.time() - start < 10


def test_addresses_are_those_of_the_plain_pattern():
    import re

    plain = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choices("12.34. x", k=30))
        assert [m.span() for m in plain.finditer(text)] == [m.span() for m in pii._IP.finditer(text)], text


def test_secrets_need_randomness_and_context():
    value = "4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e"
    found = [s[:3] for s in pii.spans_of(f'say token = "{value}" here')]
    assert found == [("secret", 13, 13 + len(value))]
    assert pii.spans_of(f"commit {value} fixed it") == [] and pii.spans_of("token = " + "1a" * 20) == []
    assert pii.masked(f"token = {value} mine") == "token = [SECRET] mine" and pii.masked(f"password:{value}") == "password:[SECRET]"


def test_no_plan_of_the_tokenizer_holds_its_rank_map(spark):
    encoded = bpe.encode(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), RANKS, public_tokenizers.PATTERN, decode=True)
    assert len(encoded._jdf.queryExecution().toString()) < 200_000  # several MB with the map as literals
