"""Benchmark decontamination: a BM25 index of test items, queried with every passage.

Documents are cut into overlapping passages, long enough that each item lies
whole in one. A passage's distinct words are a query against the inverted index of
items; an item's score is its BM25 score over the score it gets from its own
text, so 1 means all its words are there. All items at or above ``THRESHOLD`` are
retrieved, with the two bounds of block-max WAND:

* a query's terms are ordered by their largest impact; while those of the
  smallest impacts cannot reach the threshold together, items with none of the others
  are never looked at, and a passage without one is dropped;
* items are kept in blocks with each term's largest impact in them; only blocks
  whose sum reaches the threshold are scored item by item.

A retrieved pair counts only if enough three-word runs of the item's question
(its words but the last quarter) and of its answer (the last quarter) occur in the passage.

The index is broadcast in parts of ``ITEMS_AT_ONCE`` items, so its size is
bounded; documents are scanned once per part, and nothing of them is shuffled. Document frequencies, the mean length and
the length of passages are those of all items, so results don't depend on the parts.

Edge cases: items that are NULL or have fewer than ``MIN_WORDS`` words are no
evidence and match nothing; repeated items match under each id. NULL and empty
documents match nothing and are kept by ``clean``. Repeated rows are judged row by row.
Extra columns are ignored by ``matches`` and kept by ``clean``.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import coded, map_texts, plain_words_of, staged

THRESHOLD = 0.6
OVERLAP = 0.5
MIN_WORDS = 6
RUN = 3
STRIDE = 96
BLOCK_ITEMS = 4
BLOCKS_AT_ONCE = 64
ITEMS_AT_ONCE = 20_000
K1, B = 1.2, 0.75
SLICE = 2 << 20


@dataclass
class Statistics:
    """Of all items, whatever part of them an index has."""

    items: int
    mean: float
    longest: int

    @classmethod
    def of(cls, sizes: list[int]) -> Statistics:
        return cls(len(sizes), sum(sizes) / len(sizes), max(sizes))


def build_index(items: list[tuple[int, list[str]]], used: dict[str, int] | None = None, whole: Statistics | None = None) -> dict | None:
    """Postings with normalised impacts, term and block maxima, and the items' runs of words.

    ``used`` says how many of all items have each word; without it and ``whole`` these items are all.
    """
    items = sorted((i for i in items if len(i[1]) >= MIN_WORDS), key=lambda i: i[0])
    if not items:
        return None
    used = Counter(w for _, words in items for w in set(words)) if used is None else used
    whole = whole or Statistics.of([len(words) for _, words in items])
    terms = {w: i for i, w in enumerate(sorted(used))}
    idf = {w: np.log(1 + (whole.items - n + 0.5) / (n + 0.5)) for w, n in used.items()}
    term, place, impact = [], [], []
    for i, (_, words) in enumerate(items):
        norm = K1 * (1 - B + B * len(words) / whole.mean)
        own = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in Counter(words).items()}
        total = sum(own.values())
        term += [terms[w] for w in own]
        place += [i] * len(own)
        impact += [x / total for x in own.values()]
    # terms are numbered by their largest impact, so that sorting by term sorts by impact
    largest = np.zeros(len(terms))
    np.maximum.at(largest, term, impact)
    ranked = np.argsort(largest, kind="stable")
    number = np.empty(len(terms), np.int64)
    number[ranked] = np.arange(len(terms))
    names = list(terms)
    term = number[term]
    order = np.argsort(term, kind="stable")
    term, place, impact = np.array(term)[order], np.array(place)[order], np.array(impact, np.float64)[order]
    blocks = (len(items) - 1) // BLOCK_ITEMS + 1
    block_max = np.zeros((len(terms), blocks), np.float32)
    np.maximum.at(block_max, (term, place // BLOCK_ITEMS), impact.astype(np.float32) * np.float32(1.000001))
    return {
        "ids": [i for i, _ in items],
        "words": [names[i] for i in ranked],
        "starts": np.searchsorted(term, np.arange(len(terms) + 1)),
        "place": place,
        "impact": impact,
        "term_max": block_max.max(axis=1).astype(np.float64),
        "block_max": block_max,
        "longest": whole.longest,
        "runs": [_question_and_answer(words) for _, words in items],
    }


def _question_and_answer(words: list[str]) -> tuple[set[str], set[str]]:
    cut = len(words) - max(RUN, len(words) // 4)
    return _runs(words[:cut]), _runs(words[cut:])


def _runs(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + RUN]) for i in range(len(words) - RUN + 1)} or {" ".join(words)}


def search(texts: pa.Array, index: dict) -> list[tuple[int, int, float, float, float]]:
    """(row, place of item, score, question overlap, answer overlap), the best passage of each pair."""
    offsets, words = plain_words_of(pc.utf8_lower(texts))
    codes, distinct = coded(words)
    in_index = {w: i for i, w in enumerate(index["words"])}
    term_of = np.array([in_index.get(w, -1) for w in distinct.to_pylist()], np.int64)
    terms = term_of[codes] if len(codes) else codes
    length = STRIDE + index["longest"]
    n = np.diff(offsets)
    per_row = np.where(n > 0, np.maximum(0, -(-(n - index["longest"]) // STRIDE)) + (n <= index["longest"]), 0)
    row = np.repeat(np.arange(len(n)), per_row)
    number = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    start = offsets[:-1][row] + number * STRIDE
    end = np.minimum(start + length, offsets[1:][row])
    known = np.flatnonzero(terms >= 0)
    low, high = np.searchsorted(known, start), np.searchsorted(known, end)
    passage = np.repeat(np.arange(len(row)), high - low)
    at = np.arange(len(passage)) + np.repeat(low - np.cumsum(high - low) + (high - low), high - low)
    pairs = np.unique(passage * len(index["words"]) + terms[known[at]])
    # in order of impact; terms of small impact that cannot reach the threshold together are not essential
    passage, term = pairs // len(index["words"]), pairs % len(index["words"])
    added = np.cumsum(index["term_max"][term])
    first = np.searchsorted(passage, np.arange(len(row) + 1))
    before = np.concatenate([[0.0], added])[first[:-1]]
    total = np.concatenate([[0.0], added])[first[1:]] - before
    live = np.flatnonzero(total >= THRESHOLD)
    if not len(live):
        return []
    keep = (total >= THRESHOLD)[passage]
    passage, term, essential = passage[keep], term[keep], (added - before[passage])[keep] >= THRESHOLD
    new = np.searchsorted(live, passage)
    begins = np.searchsorted(new, np.arange(len(live)))
    found = {}
    for base in range(0, index["block_max"].shape[1], BLOCKS_AT_ONCE):
        maxima = index["block_max"][:, base : base + BLOCKS_AT_ONCE]
        can = np.add.reduceat(maxima[term], begins, axis=0) >= THRESHOLD
        can &= np.logical_or.reduceat((maxima[term] > 0) & essential[:, None], begins, axis=0)
        for p in np.flatnonzero(can.any(axis=1)):
            own = term[begins[p] : begins[p + 1] if p + 1 < len(live) else len(term)]
            scores = np.zeros(len(index["ids"]))
            for t in own:
                s = slice(index["starts"][t], index["starts"][t + 1])
                scores[index["place"][s]] += index["impact"][s]
            scores = np.round(scores, 9)  # sums in any order are the same
            inside = np.isin(np.arange(len(scores)) // BLOCK_ITEMS, base + np.flatnonzero(can[p]))
            hits = np.flatnonzero(inside & (scores >= THRESHOLD))
            if not len(hits):
                continue
            at_passage = live[p]
            said = _runs(words.slice(start[at_passage], end[at_passage] - start[at_passage]).to_pylist())
            for i in hits:
                question, answer = (len(r & said) / len(r) for r in index["runs"][i])
                if question >= OVERLAP and answer >= OVERLAP:
                    key = (int(row[at_passage]), int(i))
                    found[key] = max(found.get(key, (0.0, 0.0, 0.0)), (float(scores[i]), question, answer))
    return [(*k, *v) for k, v in sorted(found.items())]


def _indexes(items: DataFrame, id_col: str, text_col: str):
    """Indexes of at most ITEMS_AT_ONCE items each."""
    held = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull() & F.col("id").isNotNull())
    kind = held.schema["id"].dataType.simpleString()

    def split(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, words = plain_words_of(pc.utf8_lower(batch.column(1)))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), words.cast(pa.string()))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "words"])

    told = map_texts(held, "text", split, f"id {kind}, words array<string>").where(F.size("words") >= MIN_WORDS)
    told = staged(told.withColumn("row", F.monotonically_increasing_id()))
    n, mean, longest = told.agg(F.count("*"), F.avg(F.size("words")), F.max(F.size("words"))).first()
    each = told.select("row", F.explode(F.array_distinct("words")).alias("word"))
    used = each.join(each.groupBy("word").agg(F.count("*").alias("n")), "word")
    used = used.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("used"))
    rows, counts = [], {}
    for r in staged(told.join(used, "row")).toLocalIterator():
        rows.append((r.id, r.words))
        counts |= r.used
        if len(rows) == ITEMS_AT_ONCE:
            yield build_index(rows, counts, Statistics(n, mean, longest))
            rows, counts = [], {}
    if rows:
        yield build_index(rows, counts, Statistics(n, mean, longest))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item it contains."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind, item_kind = source.schema["doc_id"].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {item_kind}, score double, question_overlap double, answer_overlap double"
    sc = docs.sparkSession.sparkContext

    def scan(index: dict) -> DataFrame:
        shared = sc.broadcast(index)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            own = shared.value
            hits = search(batch.column(1), own)
            ids = pa.array([own["ids"][h[1]] for h in hits], batch_kind)
            parts = [pa.array([h[i] for h in hits], pa.float64()) for i in (2, 3, 4)]
            rows = pa.array([h[0] for h in hits], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0).take(rows), ids, *parts], names=names)

        return map_texts(source, "text", run, schema, SLICE)

    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
    batch_kind = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_kind]
    scans = [scan(x) for x in _indexes(items, item_id_col, item_text_col) if x]
    if not scans:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, scans)


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that contain no item, columns unchanged."""
    sc = docs.sparkSession.sparkContext
    for index in _indexes(items, item_id_col, item_text_col):
        if index is None:
            continue
        docs = map_texts(docs, text_col, _without(sc.broadcast(index), text_col), docs.schema, SLICE)
    return docs


def _without(shared, text_col: str):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = np.ones(batch.num_rows, bool)
        keep[[h[0] for h in search(batch.column(text_col), shared.value)]] = False
        return batch.filter(pa.array(keep))

    return run
