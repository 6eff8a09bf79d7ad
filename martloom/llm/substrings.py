"""Suffix-array dedup: bytes covered by a ``LENGTH``-byte string that starts in an earlier document too.

1. Anchors. In every window of LENGTH bytes the gram of ``GRAM`` bytes with the least hash is
   its anchor, so equal windows have equal anchors at equal places. All windows of an
   anchor lie in its context, the LENGTH - GRAM bytes before it and LENGTH bytes from it on.
2. An anchor whose whole context also has a smaller document is covered at once; copies within a slice
   are settled there, so a gram sends at most one record per slice and context. Contexts of a gram are
   equal if all 64 bits of their hash are.
3. Contexts that share a gram but differ may have windows in common. Such a window has ``SIDE`` bytes before
   or ``SIDE`` bytes after the gram, so only contexts that agree there with one of another document (by hash; a
   false agreement costs only time) are searched. Each task sorts the suffixes of its contexts, takes the Burrows-Wheeler order, and extends
   intervals backward, breadth first: suffixes that share l + 1 bytes are those with the same first byte whose
   successors share l. Boundaries come out by increasing common prefix, and the
   search stops at LENGTH; what is still together then is one window, with the least document it is in.
   Grams with over ``HOT`` such contexts are split by the bytes of either side and searched in these
   groups; groups of over ``HOT`` are dealt out by the hash of each window instead, and reduced map-side.
4. Only documents with findings are shuffled with their text; a bitmap of fixed size tells which may be.

Edge cases: NULL texts are empty, have nothing removed, and the hash of no bytes. Rows with a
NULL id are never a source and lose nothing. Rows that repeat an id are not
earlier than each other; what is found in one of them is removed at its place in all (within their
length). Texts shorter than LENGTH lose nothing. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import slices, staged, text_bytes

LENGTH = 50
GRAM = 20
HOT = 10_000
SIDE = (LENGTH - GRAM) // 2
# Documents a task of the anchor shuffle takes, on average, at this much text each.
TASK_BYTES = 8 << 20
# Text hashed at once; the hashes take eight bytes a byte, several times.
SLICE = 2 << 20
# Text whose anchors are looked for together, and contexts searched together if their keys allow: little enough for a cache.
PART = 1 << 18
CONTEXTS = 2_000
_MARKS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ODD = np.uint64(0xBF58476D1CE4E5B9)
_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_BEFORE = LENGTH - GRAM
_RECORD = (("gram", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("place", "<i4"), ("left", "<u4"), ("right", "<u4"))
_REQUEST = np.dtype([("key", "<u8"), ("place", "<i4"), ("sides", "u1")])
_LEFT, _RIGHT = 1, 2
_SPANS, _WANTED, _WANTED_HOT = 1, 2, 3


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ODD
    h = (h ^ (h >> np.uint64(27))) * _BASE
    return h ^ (h >> np.uint64(31))


class _Hashes:
    """Hashes of any substrings of a run of bytes."""

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[raw] * powers[:n], dtype=np.uint64)])
        back = np.full(n + 1, _INVERSE, np.uint64)
        back[0] = 1
        self.back = np.cumprod(back, dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best(x[i : i + width]) for each i, with the last ones cut off."""
    out, size = x, 1
    while size * 2 <= width:
        out = best(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, place in the text, gram hash, context hash, hashes of SIDE bytes left and right) of every anchor of texts laid end to end.

    A side with fewer bytes has the hash 0, which no other side has.
    """
    n, width = len(raw), LENGTH - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, *[none.astype(np.uint64)] * 2, *[none.astype(np.uint32)] * 2
    end_of = np.repeat(offsets[1:], np.diff(offsets))
    hashes = _Hashes(raw)
    at = np.arange(n - GRAM + 1)
    grams = hashes.of(at, at + GRAM)
    grams[at + GRAM > end_of[: len(at)]] = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = _sliding(grams, width, np.minimum)
    start = np.arange(len(least))
    least = np.where(start + LENGTH <= end_of[: len(start)], least, np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    most = _sliding(padded, width, np.maximum)
    found = np.flatnonzero(most == grams)
    row = np.searchsorted(offsets, found, side="right") - 1
    low, high = np.maximum(offsets[row], found - _BEFORE), np.minimum(offsets[row + 1], found + LENGTH)
    context = hashes.of(low, high) ^ _mixed((found - low).astype(np.uint64))

    def side(start: np.ndarray) -> np.ndarray:
        whole = (start >= offsets[row]) & (start + SIDE <= offsets[row + 1])
        out = np.zeros(len(found), np.uint32)
        out[whole] = np.maximum(hashes.of(start[whole], start[whole] + SIDE) >> np.uint64(32), np.uint64(1))
        return out

    return row, found - offsets[row], grams[found], context, side(found - SIDE), side(found + GRAM)


def _agreeing(gram: np.ndarray, side: np.ndarray, doc: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which open records agree in gram and side with one of another document, a key of the two, and how many have it."""
    key = _mixed(gram + side * _ODD)
    size = np.zeros(len(gram), np.int64)
    at = np.flatnonzero(open_ & (side > 0))
    if not len(at):
        return size > 0, key, size
    at = at[np.argsort(key[at], kind="stable")]
    new = np.append(True, key[at[1:]] != key[at[:-1]])
    begins, group = np.flatnonzero(new), np.cumsum(new) - 1
    differ = np.minimum.reduceat(doc[at], begins) != np.maximum.reduceat(doc[at], begins)
    size[at] = np.where(differ, np.diff(np.append(begins, len(at))), 0)[group]
    return size > 0, key, size


def _packed(kind: int, doc: np.ndarray, values: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(doc, kind, bytes) with each document's values together."""
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    ids, first = np.unique(doc, return_index=True)
    return [(int(d), kind, values[a:b].tobytes()) for d, a, b in zip(ids, first, np.append(first[1:], len(doc)))]


def _span_values(place: np.ndarray) -> np.ndarray:
    return np.column_stack([np.maximum(0, place - _BEFORE), place + LENGTH]).astype("<i4")


def _merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans joined, in order."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > ends[:-1])
    first = np.flatnonzero(new)
    return np.column_stack([spans[first, 0], ends[np.append(first[1:] - 1, len(spans) - 1)]]).astype("<i4")


def _rows(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.binary())],
        names=["doc", "kind", "data"],
    )


def _findings(source: DataFrame, tasks: int) -> DataFrame:
    """(doc, kind, data): spans covered with their whole context, and contexts to be searched."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                parts = []
                for part in slices(piece, "text", PART):
                    row, *rest = anchors(*text_bytes(part.column(1)))
                    parts.append((part.column(0).to_numpy()[row], *rest))
                doc, place, gram, context, left, right = (np.concatenate(x) for x in zip(*parts))
                same = _mixed(gram + context * _ODD)  # for the order only
                order = np.argsort(same)
                doc, place, gram, context, left, right = (x[order] for x in (doc, place, gram, context, left, right))
                new = np.append(True, (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])) if len(same) else np.zeros(0, bool)
                first = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1] if len(doc) else doc
                local = doc != first
                found = []
                if local.any():
                    for d, kind, data in _packed(_SPANS, doc[local], _span_values(place[local])):
                        found.append((d % tasks, d, _merged(np.frombuffer(data, "<i4").reshape(-1, 2)).tobytes()))
                doc, place, gram, context, left, right = (x[~local] for x in (doc, place, gram, context, left, right))
                bucket = (gram >> np.uint64(40)).astype(np.int64) % tasks
                by = np.lexsort((doc, bucket))
                bucket, columns = bucket[by], [x[by] for x in (gram, context, doc, place, left, right)]
                ids, starts = np.unique(bucket, return_index=True)
                for b, a, e in zip(ids, starts, np.append(starts[1:], len(bucket))):
                    data = b"".join(c[a:e].astype(t).tobytes() for c, (_, t) in zip(columns, _RECORD))
                    found.append((int(b), None, data))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.binary())],
                    names=["bucket", "doc", "data"],
                )

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[] for _ in _RECORD]
        width = sum(np.dtype(t).itemsize for _, t in _RECORD)
        for batch in batches:
            passed = []
            for doc, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if doc is not None:
                    passed.append((doc, _SPANS, data))
                    continue
                n, at = len(data) // width, 0
                for part, (_, t) in zip(parts, _RECORD):
                    part.append(np.frombuffer(data, t, n, at))
                    at += n * np.dtype(t).itemsize
            if passed:
                yield _rows(passed)
        if not parts[0]:
            return
        columns = [np.concatenate(p) for p in parts]
        parts.clear()
        order = np.lexsort((columns[2], columns[1], columns[0]))
        gram, context, doc, place, left, right = (c[order] for c in columns)
        del columns
        new_gram = np.append(True, gram[1:] != gram[:-1])
        new = new_gram | np.append(True, context[1:] != context[:-1])
        copy = doc != doc[new][np.cumsum(new) - 1]
        sides = [_agreeing(gram, side, doc, ~copy) for side in (left, right)]
        want = sides[0][0] | sides[1][0]
        hot = (np.add.reduceat(want.astype(np.int64), np.flatnonzero(new_gram)) > HOT)[np.cumsum(new_gram) - 1]
        both = sides[0][0] * _LEFT + sides[1][0] * _RIGHT
        chosen = [(copy, _SPANS, None, both), (want & ~hot, _WANTED, gram, both)]
        for (agree, key, size), flag in zip(sides, (_LEFT, _RIGHT)):
            one = np.full(len(doc), flag)
            chosen += [(agree & hot & (size <= HOT), _WANTED, key, one), (agree & hot & (size > HOT), _WANTED_HOT, key, one)]
        for rows, kind, key, flags in chosen:
            if key is None:
                values = _span_values(place[rows])
            else:
                values = np.empty(np.count_nonzero(rows), _REQUEST)
                values["key"], values["place"], values["sides"] = key[rows], place[rows], flags[rows]
            found = _packed(kind, doc[rows], values)
            for a in range(0, len(found), 10_000):
                yield _rows(found[a : a + 10_000])

    sent = source.mapInArrow(send, "bucket int, doc bigint, data binary")
    return staged(sent.repartition(tasks, "bucket").mapInArrow(settle, "doc bigint, kind int, data binary"))


def suffix_order(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, order, rank, piece) of all suffixes of pieces, each ended by a symbol of its own.

    Prefix doubling, from seven bytes packed into one number, until ``length`` bytes are in order; suffixes that
    share so many stand together, in any order.
    """
    n, pieces = len(raw) + len(offsets) - 1, len(offsets) - 1
    piece = np.repeat(np.arange(pieces), np.diff(offsets) + 1)
    last = (offsets[1:] + np.arange(pieces))[piece]
    symbols = np.zeros(n, np.int64)
    inside = np.ones(n, bool)
    inside[offsets[1:] + np.arange(pieces)] = False
    symbols[inside] = raw.astype(np.int64) + 1
    at = np.arange(n)
    key = np.zeros(n, np.int64)
    for j in range(7):
        key = key * 257 + np.where(at + j <= last, symbols[np.minimum(at + j, n - 1)], 0)
    h = 7
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1]))
        if not n or h >= length or rank[order[-1]] == n - 1:
            rank[order] = np.arange(n)
            return symbols, order, rank, piece
        second = np.where(at + h <= last, rank[np.minimum(at + h, n - 1)] + pieces, piece)
        key = rank * (n + pieces + 1) + second
        h *= 2


def common_windows(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, place in it, group) of the suffixes that share their first ``length`` bytes with another one."""
    symbols, order, rank, piece = suffix_order(raw, offsets, length)
    n = len(order)
    first = symbols[order]
    boundary = np.append(True, (first[1:] != first[:-1]) | (first[1:] == 0))[:n]
    after = rank[np.minimum(order + 1, n - 1)].astype(np.int32)  # where the suffix without its first byte stands
    open_at = np.flatnonzero(~boundary)
    one, other = after[open_at], after[open_at - 1]
    for _ in range(1, length):
        interval = np.cumsum(boundary, dtype=np.int32)
        split = interval[one] != interval[other]
        if not split.any():  # so longer prefixes split no interval either
            break
        boundary[open_at[split]] = True
        open_at, one, other = open_at[~split], one[~split], other[~split]
    group = np.cumsum(boundary)
    shared = np.zeros(n, bool)
    shared[open_at] = True
    shared[open_at - 1] = True
    chosen = order[shared]
    return piece[chosen], chosen - (offsets[:-1] + np.arange(len(offsets) - 1))[piece[chosen]], group[shared]


def _contexts(text: bytes, requests: np.ndarray):
    """Start and bytes of each context, as far as windows that hold a side that agrees can reach."""
    before = np.where(requests["sides"] & _LEFT, _BEFORE, _BEFORE - SIDE)
    lows = np.maximum(0, requests["place"] - before).tolist()
    highs = (requests["place"] + np.where(requests["sides"] & _RIGHT, LENGTH, GRAM + SIDE)).tolist()
    for low, high in zip(lows, highs):
        yield low, text[low:high]


def _searched(held: DataFrame, tasks: int) -> DataFrame:
    """(doc, spans) of windows that different contexts of a gram have in common."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            route, docs, lows, contexts = [], [], [], []
            for doc, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = (text or "").encode()
                for data in wanted:
                    requests = np.frombuffer(data, _REQUEST)
                    for key, (low, context) in zip(requests["key"].tolist(), _contexts(raw, requests)):
                        route.append(key >> 34)
                        docs.append(doc)
                        lows.append(low)
                        contexts.append(context)
            yield pa.RecordBatch.from_arrays(
                [pa.array(route, pa.int32()), pa.array(docs, pa.int64()), pa.array(lows, pa.int32()), pa.array(contexts, pa.binary())],
                names=["route", "doc", "low", "context"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        route = rows["route"].to_numpy()
        order = np.argsort(route, kind="stable")
        # contexts with windows in common have one key, so one route
        begins = np.flatnonzero(np.append(True, np.diff(route[order]) != 0))
        docs, starts, at = [], [], 0
        while at < len(route):
            after = np.searchsorted(begins, at + CONTEXTS)
            end = int(begins[after]) if after < len(begins) else len(route)
            doc, start = covered(rows.take(pa.array(order[at:end])).combine_chunks())
            docs.append(doc)
            starts.append(start)
            at = end
        doc, start = np.concatenate(docs), np.concatenate(starts)
        found = _packed(_SPANS, doc, np.column_stack([start, start + LENGTH]).astype("<i4")) if len(doc) else []
        yield _rows([(d, k, _merged(np.frombuffer(x, "<i4").reshape(-1, 2)).tobytes()) for d, k, x in found])

    def covered(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Documents and starts of the windows that an earlier document has too."""
        doc, low = rows["doc"].to_numpy(), rows["low"].to_numpy().astype(np.int64)
        raw, offsets = text_bytes(rows["context"].chunk(0))
        piece, place, group = common_windows(raw, offsets, LENGTH)
        if not len(group):
            return doc[:0], low[:0]
        new = np.append(True, group[1:] != group[:-1])
        least = np.minimum.reduceat(doc[piece], np.flatnonzero(new))[np.cumsum(new) - 1]
        later = doc[piece] > least
        return doc[piece][later], (low[piece] + place)[later]

    sent = held.select("doc", "text", "wanted").where(F.size("wanted") > 0)
    sent = sent.mapInArrow(send, "route int, doc bigint, low int, context binary")
    return sent.repartition(tasks, "route").mapInArrow(search, "doc bigint, kind int, data binary")


def _searched_hot(held: DataFrame) -> DataFrame:
    """The same for grams with very many contexts: windows by hash, least documents map-side."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = np.frombuffer((text or "").encode(), np.uint8)
                places = np.concatenate([np.frombuffer(x, _REQUEST)["place"] for x in wanted]).astype(np.int64)
                starts = np.unique((places[:, None] + np.arange(-_BEFORE, 1)).ravel())
                starts = starts[(starts >= 0) & (starts + LENGTH <= len(raw))]
                high, low = _Hashes(raw).of(starts, starts + LENGTH), _Hashes(raw[::-1]).of(len(raw) - starts - LENGTH, len(raw) - starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(np.full(len(starts), doc)), pa.array(starts.astype(np.int32))],
                    names=["w1", "w2", "doc", "start"],
                )

    sent = held.select("doc", "text", "wanted_hot").where(F.size("wanted_hot") > 0)
    rows = staged(sent.mapInArrow(windows, "w1 bigint, w2 bigint, doc bigint, start int"))
    least = rows.groupBy("w1", "w2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    covered = rows.join(least, ["w1", "w2"]).where(F.col("doc") > F.col("least"))
    starts = covered.groupBy("doc").agg(F.collect_set("start").alias("starts"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = np.array(places)
                found.append((doc, _SPANS, _merged(np.column_stack([at, at + LENGTH]).astype("<i4")).tobytes()))
            yield _rows(found)

    return starts.mapInArrow(spans, "doc bigint, kind int, data binary")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash (xxhash64 of the text), spans and left, the bytes that stay, of documents that lose any."""
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    known = source.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    size = known.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = max(16, size // TASK_BYTES)
    findings = _findings(known, tasks)
    marks = np.zeros(_MARKS, bool)
    mark = F.col("doc").bitwiseAND(_MARKS - 1).cast("int")
    marks[findings.select(mark.alias("m")).distinct().toArrow()["m"].to_numpy()] = True  # at most _MARKS numbers
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(marks))

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(bits[batch.column(0).to_numpy() & (_MARKS - 1)]))

    kinds = ((_SPANS, "spans"), (_WANTED, "wanted"), (_WANTED_HOT, "wanted_hot"))
    per_doc = findings.groupBy("doc").agg(*(F.collect_list(F.when(F.col("kind") == k, F.col("data"))).alias(n) for k, n in kinds))
    texts = known.mapInArrow(flagged, known.schema).withColumnRenamed("doc_id", "doc")
    held = staged(texts.join(per_doc, "doc"))
    more = _searched(held, tasks).union(_searched_hot(held))
    more = more.groupBy("doc").agg(F.collect_list("data").alias("more"))
    joined = held.select("doc", F.xxhash64("text").alias("text_hash"), "text", "spans").join(more, "doc", "left")
    cut = joined.mapInArrow(_cut, "doc_id bigint, text_hash bigint, spans array<struct<start int, end int>>, left binary")
    return cut.where(F.size("spans") > 0)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's merged spans within its length, and the bytes that stay."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans_of, left = [], []
        for text, first, more in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            raw = (text or "").encode()
            parts = [np.frombuffer(x, "<i4").reshape(-1, 2) for x in [*first, *(more or [])]]
            spans = np.minimum(_merged(np.concatenate(parts)), len(raw)) if parts else np.zeros((0, 2), int)
            spans = spans[spans[:, 0] < spans[:, 1]].tolist()
            edges = [0, *(x for s in spans for x in s), len(raw)]
            spans_of.append([{"start": a, "end": b} for a, b in spans])
            left.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans_of, kind), pa.array(left, pa.binary())], names=["doc_id", "text_hash", "spans", "left"])
