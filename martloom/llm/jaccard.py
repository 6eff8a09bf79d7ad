"""N-gram Jaccard join: prefix filtering on five-word shingles, rarest first.

1. A map gives each document its set of shingles (64-bit hashes), the set's key
   and size; documents with equal sets share a key and are one set from here on. It
   also counts shingles in a fixed table of ``COUNTERS`` counters.
2. Each set's shingles are ordered by counter, then hash: a global order, rare ones first. A
   set of n goes to the join with its first n - ceil(0.75 n) + need(n) shingles, need(n) = 1 + n // 20:
   two sets that link share at least need(smaller n) of these. They are packed by hash range
   and shuffled, and only shingles that several sets share stay.
3. Prefix shingles no other set has are private: a set has at most size - private in common with any
   other. Sets that cannot link by that are dropped, which takes linear time.
4. Every set is compared with few leaders, those it shares most prefix shingles with; the leader of a
   shingle is its set with the smallest private part, the least edited of copies. That
   finds the groups of copies with ``LEADERS`` comparisons a set.
5. Pairs of different groups that pass the length, private and positional
   filters are counted up, and each is verified once. Pairs inside a group need no look: they
   are connected already, so the components are those of all links.

Verification runs on whole sets: a suffix filter (recursive halving by hash) gives up
early, then the sizes of intersection and union are compared in whole numbers.

Edge cases: NULL texts and texts without words have the empty set, are their own component and link with
nothing. Rows with NULL ids are left out of ``join`` results' components but keep their row. Repeated ids
give one row per row; the least id of a component names it. Extra columns are ignored
by ``join`` and kept by ``first_of_each``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import coded, release_memory, rows_of, slices, staged, words_of
from martloom.llm.components import components

SHINGLE = 5
AT_ONCE = 1 << 20
PERCENT = 75
COUNTERS = 1 << 22
_PARTS = 64
# Leaders each set is compared with before pairs of different groups are looked for.
LEADERS = 3
# Prefix entries a task of the join takes, on average.
ENTRIES = 250_000
# Marks of texts, and how many of them a bitmap of Spark has.
_MARKS = 1 << 24
_PART_BITS = 1 << 15
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xBF58476D1CE4E5B9)
_ENTRY = np.dtype([("shingle", "<u8"), ("key", "<i8"), ("size", "<i4"), ("place", "<i4")])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ODD
    return h ^ (h >> np.uint64(27))


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets, and the sorted distinct shingle hashes of each text."""
    offsets, words = words_of(texts)
    codes, distinct = coded(words)
    names = np.array(distinct.to_pylist() or [""], object)
    h = pd.util.hash_array(names, categorize=False).astype(np.uint64)[codes] if len(codes) else np.zeros(0, np.uint64)
    n = np.diff(offsets)
    row = rows_of(offsets)
    m = max(0, len(h) - SHINGLE + 1)
    full = np.zeros(m, np.uint64)
    for j in range(SHINGLE):
        full = full * _BASE + h[j : j + m]
    full = full[row[:m] == row[SHINGLE - 1 :]] if m else full
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    some = n[short].astype(np.uint64)
    for j in range(SHINGLE - 1):
        inside = n[short] > j
        at = np.minimum(offsets[short] + j, max(len(h) - 1, 0))
        some = np.where(inside, some * _BASE + h[at] + np.uint64(1), some) if len(short) else some
    size = np.maximum(n - SHINGLE + 1, 0)
    size[short] = 1
    ends = np.concatenate([[0], np.cumsum(size)])
    hashes = np.empty(ends[-1], np.uint64)
    long = np.ones(len(hashes), bool)
    long[ends[short]] = False
    hashes[long], hashes[ends[short]] = _mixed(full), _mixed(some)
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):  # text by text costs a tenth of one sort by text and hash
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    new[ends[:-1][size > 0]] = True
    return np.concatenate([[0], np.cumsum(new)])[ends], hashes[new]


def _sets_of(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of the column ``text``, made from ``AT_ONCE`` bytes of it at a time, whose words take many times as much."""
    parts = [shingle_sets(p.column("text")) for p in slices(piece, "text", AT_ONCE)]
    sizes = [np.diff(offsets) for offsets, _ in parts]
    return np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), np.concatenate([hashes for _, hashes in parts])


def _keys(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """64-bit keys of whole sets."""
    raw = hashes.tobytes()
    digests = b"".join(
        hashlib.blake2b(raw[8 * a : 8 * b], digest_size=8).digest() for a, b in zip(offsets[:-1], offsets[1:])
    )
    return np.frombuffer(digests, "<i8")


def need(n):
    """Prefix shingles a set of n must share with any larger set it links with."""
    return 1 + n // 20


def prefix_length(n):
    return n - (PERCENT * n + 99) // 100 + need(n)


def _rarest(offsets: np.ndarray, hashes: np.ndarray, classes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places in ``hashes`` of the first ``wanted`` of each set, in order of class and hash."""
    order = (classes[(hashes >> np.uint64(42)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
    row = rows_of(offsets)
    if ((hashes[1:] >> np.uint64(8) == hashes[:-1] >> np.uint64(8)) & (row[1:] == row[:-1])).any():  # cut off bits decide
        ranked = np.lexsort((hashes, order, row))
        return ranked[np.arange(len(hashes)) - offsets[:-1][row] < wanted[row]]
    own = [np.zeros(0, np.int64)]
    for i in np.flatnonzero(wanted).tolist():
        a, b = offsets[i], offsets[i + 1]
        own.append(a + np.argsort(order[a:b])[: wanted[i]])
    return np.concatenate(own)


def _counted(source: DataFrame, kind: str) -> DataFrame:
    """Rows (doc_id, key, size, mark), and per task rows (part, counts) with a part of the counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.uint16)
        for batch in batches:
            for piece in slices(batch, "text"):
                offsets, hashes = _sets_of(piece)
                seen, times = np.unique((hashes >> np.uint64(42)).astype(np.int64), return_counts=True)
                counters[seen] = np.minimum(65535, counters[seen].astype(np.int64) + times)
                n = piece.num_rows
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(_keys(offsets, hashes)), pa.array(np.diff(offsets).astype(np.int32)), piece.column(2), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                    names=names,
                )
        release_memory()
        if counters.any():
            parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counters, _PARTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(_PARTS, id_type), pa.nulls(_PARTS, pa.int64()), pa.nulls(_PARTS, pa.int32()), pa.nulls(_PARTS, pa.int32()), pa.array(range(_PARTS), pa.int32()), pa.array(parts)],
                names=names,
            )

    names = ["doc_id", "key", "size", "mark", "part", "counts"]
    id_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    return staged(source.mapInArrow(run, f"doc_id {kind}, key bigint, size int, mark int, part int, counts binary"))


def _frequency_classes(counted: DataFrame) -> np.ndarray:
    """A class per counter, on a logarithmic scale: what orders shingles from rare to frequent."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(zlib.decompress(packed), np.uint16).astype(np.int64)
                totals[part] = totals[part] + counts if part in totals else counts
        for part, total in totals.items():
            classes = np.minimum(255, 8 * np.log2(1 + total)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([classes.tobytes()], pa.binary())], names=["part", "classes"])

    parts = counted.where(F.col("part").isNotNull()).select("part", "counts").repartition(_PARTS, "part")
    classes = np.zeros((_PARTS, COUNTERS // _PARTS), np.uint8)
    for r in parts.mapInArrow(add, "part int, classes binary").collect():  # COUNTERS bytes
        classes[r.part] = np.frombuffer(r.classes, np.uint8)
    return classes.ravel()


def _shared_entries(source: DataFrame, classes: np.ndarray, tasks: int) -> DataFrame:
    """(shingle, key, size, place) of prefix shingles that at least two sets have."""
    order = source.sparkSession.sparkContext.broadcast(classes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # sets of this task, so that copies are sent once a task
        for batch in batches:
            for piece in slices(batch, "text"):
                offsets, hashes = _sets_of(piece)
                keys, n = _keys(offsets, hashes), np.diff(offsets)
                new = np.array([k not in done and not done.add(k) for k in keys.tolist()], bool) & (n > 0)
                wanted = np.where(new, prefix_length(n), 0)
                ranked = _rarest(offsets, hashes, order.value, wanted)
                row = np.repeat(np.arange(len(n)), wanted)
                entries = np.empty(len(ranked), _ENTRY)
                entries["shingle"], entries["place"] = hashes[ranked], np.arange(len(ranked)) - (np.cumsum(wanted) - wanted)[row]
                entries["key"], entries["size"] = keys[row], n[row]
                bucket = ((entries["shingle"] * _BASE) >> np.uint64(33)).astype(np.int64) % tasks
                by = np.argsort(bucket)
                entries, bucket = entries[by], bucket[by]
                first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
                found, ends = bucket[first], np.append(first, len(entries))[1:]
                packed = [entries[a:b].tobytes() for a, b in zip(first, ends)]
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(packed, pa.binary())], names=["bucket", "entries"])
        release_memory()

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(x, _ENTRY) for batch in batches for x in batch.column(1).to_pylist()]
        if not parts:
            return
        entries = np.concatenate(parts)
        entries = entries[np.lexsort((entries["key"], entries["shingle"]))]
        new = np.ones(len(entries), bool)
        new[1:] = (entries["shingle"][1:] != entries["shingle"][:-1]) | (entries["key"][1:] != entries["key"][:-1])
        entries = entries[new]
        same = entries["shingle"][1:] == entries["shingle"][:-1]
        several = np.append(same, False) | np.append(False, same)
        entries = entries[several]
        for a in range(0, len(entries), 100_000):
            e = entries[a : a + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(e["shingle"].view("<i8").copy()), *(pa.array(e[c].copy()) for c in ("key", "size", "place"))],
                names=["shingle", "key", "size", "place"],
            )

    packed = source.select("text").mapInArrow(pack, "bucket int, entries binary")
    return staged(packed.repartition(tasks, "bucket").mapInArrow(share, "shingle bigint, key bigint, size int, place int"))


def _able(entries: DataFrame) -> DataFrame:
    """Entries of sets that can link at all, with ``private``, their prefix shingles no other set has."""
    n = F.col("size")
    length = n - F.floor((n * PERCENT + 99) / 100) + 1 + F.floor(n / 20)
    held = entries.groupBy("key", "size").agg(F.count("*").alias("shared"))
    private = held.select("key", (length - F.col("shared")).cast("int").alias("private"), "size")
    able = private.where((n - F.col("private")) * 100 >= n * PERCENT)
    return staged(entries.join(able.select("key", "private"), "key"))


def _leader_pairs(entries: DataFrame) -> DataFrame:
    """Each set with the leaders it shares most prefix shingles with: a shingle's set with the least private part."""
    rank = F.struct((F.col("private") * 1_000_000 / F.col("size")).cast("bigint").alias("rate"), "key")
    leaders = entries.groupBy("shingle").agg(F.min(rank).alias("best"))
    votes = entries.join(leaders.select("shingle", F.col("best.key").alias("leader")), "shingle")
    votes = votes.where(F.col("key") != F.col("leader")).groupBy("key", "leader").count()
    # of leaders with equal votes the largest key goes first; any would do
    first = Window.partitionBy("key").orderBy(F.desc("count"), F.desc("leader"))
    best = votes.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= LEADERS)
    return best.select(F.col("key").alias("a"), F.col("leader").alias("b"))


def _cross_pairs(entries: DataFrame, roots: DataFrame, tasks: int) -> DataFrame:
    """Pairs of sets in different groups that share an early prefix shingle and may link."""
    labelled = entries.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    labelled = labelled.select("shingle", "key", "size", "place", "private", F.coalesce("root", "key").alias("root"))
    # only shingles whose sets are of several groups can say anything new
    spread = labelled.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    open_entries = labelled.join(spread.select("shingle"), "shingle", "left_semi")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = [pa.Table.from_batches([b]) for b in batches]
        if not frames:
            return
        rows = pa.concat_tables(frames)
        columns = [rows[c].to_numpy() for c in ("shingle", "key", "size", "place", "private", "root")]
        order = np.lexsort((columns[2], columns[0]))
        shingle, key, size, place, private, root = (x[order] for x in columns)
        common = size - private
        ends = np.searchsorted(shingle, shingle, side="right")
        reach = np.minimum(ends, _last_of_size(shingle, size, ends))
        held_a, held_b, held = [], [], 0
        step = 1
        live = np.flatnonzero(np.arange(len(key)) + step < reach)
        while len(live):
            i, j = live, live + step
            t = -(-PERCENT * (size[i].astype(np.int64) + size[j]) // (100 + PERCENT))
            most = np.minimum(place[i], place[j]) + np.minimum(size[i] - place[i], size[j] - place[j])
            good = (root[i] != root[j]) & (np.minimum(most, np.minimum(common[i], common[j])) >= t)
            # the first shingle of a linking pair stands this early in both sets
            good &= (place[i] <= size[i] - t) & (place[j] <= size[j] - t)
            i, j = i[good], j[good]
            rest = np.minimum(size[i] - place[i], size[j] - place[j]) - 1
            low = key[i] < key[j]
            held_a.append(np.column_stack([np.where(low, key[i], key[j]), np.where(low, key[j], key[i])]))
            held_b.append(rest)
            held += int(good.sum())
            if held > 500_000:
                yield _pair_counts(held_a, held_b)
                held_a, held_b, held = [], [], 0
            step += 1
            live = live[live + step < reach[live]]
        yield _pair_counts(held_a, held_b)

    dealt = open_entries.repartition(tasks, "shingle")
    counted = dealt.mapInArrow(pairs, "a bigint, b bigint, shared bigint, rest bigint")
    counted = counted.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.min("rest").alias("rest"))
    sizes = open_entries.select("key", "size").distinct()
    counted = counted.join(sizes.select(F.col("key").alias("a"), F.col("size").alias("size_a")), "a")
    counted = counted.join(sizes.select(F.col("key").alias("b"), F.col("size").alias("size_b")), "b")
    both = F.col("size_a") + F.col("size_b")
    # what is shared up to the last shingle counted, and at most all behind it
    reaches = (F.col("shared") + F.col("rest")) * (100 + PERCENT) >= both * PERCENT
    return counted.where(reaches).select("a", "b")


def _last_of_size(shingle: np.ndarray, size: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For rows ordered by shingle and size, where sizes get too large for a link."""
    out = np.empty(len(size), np.int64)
    start = 0
    while start < len(size):
        end = ends[start]
        out[start:end] = start + np.searchsorted(size[start:end], size[start:end].astype(np.int64) * 100 // PERCENT, side="right")
        start = end
    return out


def _pair_counts(pairs: list[np.ndarray], rest: list[np.ndarray]) -> pa.RecordBatch:
    """Each pair once, with its shared shingles and the least that is behind one of them."""
    names = ["a", "b", "shared", "rest"]
    if not pairs:
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, names=names)
    found, at, times = np.unique(np.concatenate(pairs), axis=0, return_inverse=True, return_counts=True)
    least = np.full(len(found), np.iinfo(np.int64).max)
    np.minimum.at(least, at.ravel(), np.concatenate(rest).astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (found[:, 0], found[:, 1], times, least)], names=names)


def suffix_bound(x: np.ndarray, y: np.ndarray, depth: int = 3) -> int:
    """The most two sorted sets can have in common, by halving both at the middle value of y."""
    if not depth or len(x) < 8 or len(y) < 8:
        return min(len(x), len(y))
    j = len(y) // 2
    i = int(np.searchsorted(x, y[j]))
    return suffix_bound(x[:i], y[:j], depth - 1) + suffix_bound(x[i:], y[j:], depth - 1)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether 100 * intersection >= PERCENT * union, for sorted distinct arrays."""
    least = -(-PERCENT * (len(x) + len(y)) // (100 + PERCENT))
    if suffix_bound(x, y) < least:
        return False
    at = np.searchsorted(y, x)
    same = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
    return 100 * same >= PERCENT * (len(x) + len(y) - same)


def _bitmap(marks: DataFrame) -> np.ndarray:
    """``_MARKS`` bits, the lowest of a byte first, with those of column ``mark`` set."""
    bit = F.col("mark") + 1  # Spark's bitmaps begin at 1
    parts = marks.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros((_MARKS // _PART_BITS, _PART_BITS // 8), np.uint8)
    for r in parts.collect():  # _MARKS bits
        out[r.part - 1] = np.frombuffer(r.bits, np.uint8)
    return out.ravel()


def _verified(pairs: DataFrame, source: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set keys whose sets link.

    Only texts that may have one of these sets, by the mark of one text of each, are cut into shingles again.
    """
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    first = sets.groupBy("key").agg(F.min("mark").alias("mark"))
    wanted = source.sparkSession.sparkContext.broadcast(_bitmap(first.join(keys, "key", "left_semi")))

    def items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, done = wanted.value, set()
        for batch in batches:
            mark = batch.column(1).to_numpy()
            for piece in slices(batch.filter(pa.array((bits[mark >> 3] >> (mark & 7)) & 1 == 1)), "text"):
                offsets, hashes = _sets_of(piece)
                own, raw, n = _keys(offsets, hashes), hashes.tobytes(), np.diff(offsets)
                rows = [i for i in np.flatnonzero(n > 0) if own[i] not in done and not done.add(own[i])]
                packed = [raw[8 * offsets[i] : 8 * offsets[i + 1]] for i in rows]
                yield pa.RecordBatch.from_arrays([pa.array(own[rows]), pa.array(packed, pa.binary())], names=["key", "items"])
        release_memory()

    held = source.select("text", "mark").mapInArrow(items, "key bigint, items binary")
    held = staged(held.join(keys, "key", "left_semi").groupBy("key").agg(F.first("items").alias("items")))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            good = [linked(np.frombuffer(x[i].as_py(), np.uint64), np.frombuffer(y[i].as_py(), np.uint64)) for i in range(batch.num_rows)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(held.select(F.col("key").alias("a"), F.col("items").alias("x")), "a")
    both = both.join(held.select(F.col("key").alias("b"), F.col("items").alias("y")), "b")
    return staged(both.select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    mark = F.xxhash64(F.col(text_col)).bitwiseAND(_MARKS - 1).cast("int")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), mark.alias("mark"))
    kind = source.schema["doc_id"].dataType.simpleString()
    counted = _counted(source, kind)
    sets = counted.where(F.col("part").isNull()).select("doc_id", "key", "size", "mark")
    n = sets.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(16, int(0.3 * n / ENTRIES))
    entries = _able(_shared_entries(source, _frequency_classes(counted), tasks))
    links = _verified(staged(_leader_pairs(entries)), source, sets)
    more = _verified(staged(_cross_pairs(entries, components(links), tasks)), source, sets)
    roots = components(links.union(more))
    full = sets.where(F.col("size") > 0)
    firsts = full.groupBy("key").agg(F.min("doc_id").alias("first"))
    rooted = firsts.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
    rooted = staged(rooted.select("key", "first", F.coalesce("root", "key").alias("root")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("key", "component")
    return sets.join(named, "key", "left").select(
        "doc_id",
        F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that name their component; columns unchanged. Rows without an id stay."""
    kept = join(docs.where(F.col(id_col).isNotNull()), id_col, text_col).where(F.col("doc_id") == F.col("component_id"))
    gone = docs.where(F.col(id_col).isNotNull()).join(kept.select(F.col("doc_id").alias(id_col)).distinct(), id_col, "left_semi")
    return gone.select(*docs.columns).union(docs.where(F.col(id_col).isNull()))
