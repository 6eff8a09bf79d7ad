"""Document fingerprints: improbable-feature digests of byte windows in chained Bloom filters.

1. Entropy. Every window of ``WINDOW`` bytes of a text has the Shannon entropy of its bytes, in ``CLASSES`` classes of
   equal width. It slides: the byte that leaves and the byte that comes change the sum of c log c by a number
   that depends on how often they stand in the window, which 63 comparisons of the text with itself moved by 1 to 63 bytes count.
2. Rarity. A histogram of the classes over all windows of all texts ranks them, the rarest first; windows below
   ``LEAST`` of the greatest entropy (runs and tables) come last.
3. Features. In every stretch of ``STRETCH`` windows the one of least rank, the leftmost, is marked; windows marked by
   ``MARKS`` stretches or more are features, and so is a text's rarest window. A text shorter than a window is one feature.
4. Filters. Distinct features go, in order, into Bloom filters of ``BITS`` bits, five bits each; a filter takes ``FULL``
   features, then the next one of the chain begins.
5. Likeness. For each filter of the shorter chain, the best bit overlap with the filters of the longer one, from the
   overlap that chance gives (plus ``SLACK``) as 0 to the greatest possible as 1; the mean of these.

A fingerprint is text: the number of features, a colon, and the filters in base64. It depends on the text and the histogram only.

Texts are worked through in blocks of bytes, so memory is bounded for texts of any length. ``with_next`` gives each
text the one that follows it in an order: by range partitions, with the last of each partition joined to the first of the
next one; no partition's rows are held.

Edge cases: NULL texts are empty. Empty texts have no features and are like each other (1) and nothing else (0). Ids may be NULL
(after all others) or repeat (then in order of their texts' hashes; copies stand next to each other). A single document is
followed by itself. An empty table has no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import slices, staged, text_bytes

WINDOW = 64
STRETCH = 64  # at most WINDOW, so that no stretch reaches from a text into the next one
MARKS = 16
CLASSES = 1024
LEAST = 0.2
BITS = 2048
PICKS = 5
FULL = 160
SLACK = 0.1
# Windows ranked at once.
BLOCK = 256 << 10
# Texts taken together.
SLICE = 1 << 20

_ONE = 1 << 20
_PARTS = np.array([0] + [round(c * np.log2(c) * _ONE) for c in range(1, WINDOW + 1)], np.int64)
_GROWS = np.diff(_PARTS)  # c log c when a byte that stands c times comes once more
_MOST = int(np.log2(WINDOW) * WINDOW * _ONE)
_LAST = CLASSES  # rank of windows that are not to be chosen
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9], np.uint64)


def classes(raw: np.ndarray) -> np.ndarray:
    """The entropy class of every window of ``raw``."""
    n = len(raw) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int64)
    ahead, behind = np.zeros(len(raw), np.uint8), np.zeros(len(raw), np.uint8)
    for d in range(1, WINDOW):
        same = (raw[d:] == raw[:-d]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    # the byte at i leaves, then the byte at i + WINDOW comes; both are counted among the WINDOW - 1 bytes between
    change = _GROWS[behind[WINDOW:]] - _GROWS[ahead[: n - 1]]
    total = np.empty(n, np.int64)
    total[0] = _PARTS[np.bincount(raw[:WINDOW], minlength=256)].sum()
    np.cumsum(change, out=total[1:])
    total[1:] += total[0]
    return (_MOST - total) * CLASSES // (_MOST + 1)


def _blocks(n: int) -> Iterator[tuple[int, int]]:
    for a in range(0, n, BLOCK):
        yield a, min(n, a + BLOCK)


def _inside(offsets: np.ndarray, a: int, b: int) -> np.ndarray:
    """Which windows that begin in [a, b) end in the text they begin in."""
    at = np.arange(a, b)
    return at + WINDOW <= offsets[np.searchsorted(offsets, at, side="right").clip(max=len(offsets) - 1)]


def class_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many windows of texts laid end to end each class has."""
    counts = np.zeros(CLASSES, np.int64)
    for a, b in _blocks(len(raw)):
        found = classes(raw[a : b + WINDOW - 1])
        counts += np.bincount(found[_inside(offsets, a, a + len(found))], minlength=CLASSES)
    return counts


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """The rank of each class: 0 for the rarest; those of too little entropy share the last one."""
    ranks = np.empty(CLASSES, np.int64)
    ranks[np.lexsort((np.arange(CLASSES), counts))] = np.arange(CLASSES)
    ranks[: int(LEAST * CLASSES)] = _LAST
    return ranks


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for each i for which all of it is there."""
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def features(raw: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Where the features of texts laid end to end begin; texts shorter than a window have none here."""
    none = np.int64(1) << 62
    rarest = np.full(len(offsets) - 1, none)
    found = []
    for a, b in _blocks(len(raw)):
        # marks on [a, b) come from stretches that begin up to STRETCH - 1 before, over windows up to STRETCH - 1 after
        low, high = max(0, a - STRETCH + 1), min(len(raw), b + STRETCH - 1)
        own = classes(raw[low : high + WINDOW - 1])
        key = np.full(high - low + STRETCH - 1, none)
        keys = (ranks[own] << 40) | np.arange(low, low + len(own))
        key[: len(own)] = np.where(_inside(offsets, low, low + len(own)), keys, none)
        first, last = np.searchsorted(offsets, a, side="right") - 1, np.searchsorted(offsets, b, side="left")
        starts = np.maximum(offsets[first:last], a)
        live = starts < np.minimum(offsets[first + 1 : last + 1], b)
        if live.any():
            texts = np.arange(first, last)[live]
            rarest[texts] = np.minimum(rarest[texts], np.minimum.reduceat(key[a - low : b - low], starts[live] - a))
        best = _least(key, STRETCH)
        best = best[(key[: len(best)] < none)]  # stretches begin at windows
        place = best & ((1 << 40) - 1)
        kept = (place >= a) & (place < b) & (best >> 40 < _LAST)
        place, marks = np.unique(place[kept], return_counts=True)
        found.append(place[marks >= MARKS])
    least = rarest[rarest < none] & ((1 << 40) - 1)
    return np.unique(np.concatenate([least, *found])) if found else least


def hashes(raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """A hash of each window."""
    out = np.zeros(len(places), np.uint64)
    for a in range(0, len(places), 1 << 16):
        at = places[a : a + (1 << 16)]
        words = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[at].view("<u8")
        h = np.zeros(len(at), np.uint64)
        for word in words.T:
            h = (h ^ word) * _MIX[0]
            h ^= h >> np.uint64(32)
        h = (h ^ (h >> np.uint64(29))) * _MIX[1]
        out[a : a + (1 << 16)] = h ^ (h >> np.uint64(32))
    return out


def fingerprints(raw: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> list[tuple[int, bytes]]:
    """The number of features and the filters of each text laid end to end."""
    places = features(raw, offsets, ranks)
    text = np.searchsorted(offsets, places, side="right") - 1
    h = hashes(raw, places)
    size = np.diff(offsets)
    short = np.flatnonzero((size > 0) & (size < WINDOW))
    if len(short):
        own = [hashlib.blake2b(raw[offsets[t] : offsets[t + 1]].tobytes(), digest_size=8).digest() for t in short]
        text = np.concatenate([text, short])
        h = np.concatenate([h, np.frombuffer(b"".join(own), "<u8")])
        order = np.argsort(text, kind="stable")
        text, h = text[order], h[order]
    # a text's features, each once, at the first place
    order = np.lexsort((np.arange(len(h)), h, text))
    new = np.ones(len(h), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (h[order][1:] != h[order][:-1])
    first = np.sort(order[new])
    text, h = text[first], h[first]
    n = np.bincount(text, minlength=len(size))
    chain = -(-n // FULL)
    begin = np.concatenate([[0], np.cumsum(n)])
    row = np.concatenate([[0], np.cumsum(chain)])
    bits = np.zeros((row[-1], BITS), bool)
    at = row[text] + (np.arange(len(h)) - begin[text]) // FULL
    width = np.uint64(BITS.bit_length() - 1)
    for _ in range(PICKS):
        bits[at, (h & np.uint64(BITS - 1)).astype(np.int64)] = True
        h = h >> width
    filters = np.packbits(bits, axis=1)
    return [(int(n[t]), filters[row[t] : row[t + 1]].tobytes()) for t in range(len(size))]


def likeness(one: tuple[int, bytes], other: tuple[int, bytes]) -> float:
    """Likeness of two fingerprints, from 0 to 1; the order of the two does not matter."""
    if one == other:
        return 1.0
    if not one[0] or not other[0]:
        return 0.0
    a, b = sorted((one, other), key=lambda x: (len(x[1]), x[1]))
    a, b = (np.unpackbits(np.frombuffer(x[1], np.uint8)).reshape(-1, BITS).astype(np.float32) for x in (a, b))
    total, size_b = 0.0, b.sum(axis=1)
    for rows in np.array_split(a, -(-len(a) // 256)):
        size = rows.sum(axis=1)[:, None]
        best = np.zeros(len(rows))
        for columns, sizes in zip(np.array_split(b, -(-len(b) // 256)), np.array_split(size_b, -(-len(b) // 256))):
            most, chance = np.minimum(size, sizes), size * sizes / BITS
            floor = chance + SLACK * (most - chance)
            best = np.maximum(best, ((rows @ columns.T - floor) / (most - floor)).max(axis=1))
        total += best.sum()
    return float(min(1.0, total / len(a)))


def packed(print_: tuple[int, bytes]) -> str:
    return f"{print_[0]}:{base64.b64encode(print_[1]).decode()}"


def unpacked(text: str) -> tuple[int, bytes]:
    n, _, filters = text.partition(":")
    return int(n), base64.b64decode(filters)


def _prints(texts: pa.Array, ranks: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text", SLICE):
        yield from fingerprints(*text_bytes(part.column(0)), ranks)


def rarity(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Ranks of the entropy classes over all windows of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                counts += class_counts(*text_bytes(part.column(0)))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["class", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "class int, n bigint")
    counts = np.zeros(CLASSES, np.int64)
    for r in found.groupBy("class").agg(F.sum("n").alias("n")).collect():  # at most CLASSES rows
        counts[r["class"]] = r.n
    return ranks_of(counts)


def compute(docs: DataFrame, ranks: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of every text."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([packed(p) for p in _prints(batch.column(1), ranks)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=["doc_id", "fingerprint"])

    return source.mapInArrow(run, f"doc_id {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last third of code points replaced by the first ones of ``following``, or all it has."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_RESULT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
# Rows of the ordered pass: finished ones, and each partition's first and last text, which another partition needs.
_DONE, _FIRST, _LAST_ROW = 0, 1, 2


def _results(texts: list[str], following: list[str], prints: list, next_prints: list, ranks: np.ndarray) -> list[pa.Array]:
    """The columns of _RESULT for texts and the ones that follow them."""
    new = [edited(t, f) for t, f in zip(texts, following)]
    new_prints = list(_prints(pa.array(new, pa.large_string()), ranks))
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in new]
    return [
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array(sha, pa.string()),
        pa.array([packed(p) for p in prints], pa.string()),
        pa.array([packed(p) for p in new_prints], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(prints, new_prints)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(prints, next_prints)], pa.float64()),
    ]


def with_next(docs: DataFrame, ranks: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document, by descending id, against its text edited with the next one's, and against the next one.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The last document is
    followed by the first.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie").asc(), F.col("copy").asc()]
    ordered = source.withColumn("tie", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = f"kind int, part int, doc_id {kind}, text string, {_RESULT}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None  # the last row so far: its id (an array of one), text and fingerprint

        def alone(which: int, doc_id: pa.Array, text: str) -> pa.RecordBatch:
            nulls = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            columns = [pa.array([which], pa.int32()), pa.array([part], pa.int32()), doc_id, pa.array([text]), *nulls]
            return pa.RecordBatch.from_arrays(columns, names=names)

        names = ["kind", "part", "doc_id", "text", *(x.split()[0] for x in _RESULT.split(", "))]
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                ids, texts = piece.column(0), piece.column(1).to_pylist()
                prints = list(_prints(piece.column(1), ranks))
                if held is None:
                    yield alone(_FIRST, ids.slice(0, 1), texts[0])
                else:
                    ids = pa.concat_arrays([held[0], ids])
                    texts, prints = [held[1], *texts], [held[2], *prints]
                n = len(texts) - 1
                if n:
                    found = _results(texts[:-1], texts[1:], prints[:-1], prints[1:], ranks)
                    columns = [pa.array([_DONE] * n, pa.int32()), pa.array([part] * n, pa.int32()), ids.slice(0, n), pa.nulls(n, pa.string())]
                    yield pa.RecordBatch.from_arrays([*columns, *found], names=names)
                held = ids.slice(n, 1), texts[-1], prints[-1]
        if held is not None:
            yield alone(_LAST_ROW, held[0], held[1])

    rows = staged(ordered.mapInArrow(run, schema))
    done = rows.where(F.col("kind") == _DONE).select("doc_id", *names_of(_RESULT))

    # a row for each partition that has rows
    parts = rows.where(F.col("kind") == _FIRST).select("part")
    ends = parts.agg(F.min("part").alias("first")).first()
    if ends["first"] is None:
        return done
    follows = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.lit(ends["first"]))
    pairs = parts.select("part", follows.alias("follows"))
    last = rows.where(F.col("kind") == _LAST_ROW).select("doc_id", "text", "part")
    first = rows.where(F.col("kind") == _FIRST).select(F.col("part").alias("follows"), F.col("text").alias("following"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = batch.slice(i, 1)
                texts = [pair.column(1)[0].as_py()], [pair.column(2)[0].as_py()]
                prints = [list(_prints(pair.column(j), ranks)) for j in (1, 2)]
                yield pa.RecordBatch.from_arrays([pair.column(0), *_results(*texts, *prints, ranks)], names=["doc_id", *names_of(_RESULT)])

    met = last.join(pairs, "part").join(first, "follows").select("doc_id", "text", "following")
    return done.union(met.mapInArrow(close, f"doc_id {kind}, {_RESULT}"))


def names_of(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]
