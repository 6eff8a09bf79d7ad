"""Language-model scores: a hidden Markov model over words, trained by Baum-Welch.

Symbols. Every word of the learning documents, the end of a text, and one unknown word in each of
``CLASSES`` classes of words by their last two characters. A state emits a word with its expected count
there, mixed with b, the add-half unigram probability; unknown words have only the latter. So the
model is a proper distribution over texts of known words and one unknown word per class.

Where they are. The most frequent words, up to ``HEAD``, and the end are in the broadcast model, which
has only the sum of the others per class. The others' expected counts stay distributed. Texts are
encoded once in slices, and each word has a fixed place in the bucket of its hash. A word that
stands in one slice only keeps its expected counts there. For a word of several slices, each round
sends its counts to its bucket as numbers by place; there they are added up, and come back to the
slices of the next round. A word's counts travel as their sum (float32) and each state's part of it in
255ths, scaled back to the sum on arrival.

Training. Word counts cover all learning documents. Baum-Welch starts with
``start_rounds`` rounds, to find the states, each over another of as many hash shares of the
learning documents, which together are all of them. It ends with ``rounds`` rounds over all learning
documents. For training, and only there, texts are cut into runs of ``RUN`` tokens.

Scoring. The scaled forward recursion runs along each whole text, with expected counts and counts of the
words outside the head brought to its slice from their buckets.

Edge cases: a NULL or empty text is the end alone. Without learning documents all words are
unknown and states stay at their start. Repeated rows are scored row by row. Extra columns are
ignored. Words tied in count are ordered by their text.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from martloom.llm.common import coded, map_texts, rows_of, slices, staged, text_bytes, words_of

HEAD = 65_536
CLASSES = 256
STATES = 12
RUN = 128
# Runs whose recursions go side by side: a few MB of numbers.
SIDE = 1024
# Tokens whose emissions are gathered at once for scores.
_AT_ONCE = 1 << 16
END = "\n"
SLICE = 4 << 20
# Learning tokens for each bucket of words and each task of a round.
TASK_TOKENS = 2_000_000
# Emissions are mixed with the unigram distribution: this share of a state's tokens, and so many more.
_SHARE, _PRIOR = 0.15, 500.0


@dataclass
class Counts:
    """Counts of all learning tokens: the distributed table, its totals, and what the head and the classes have."""

    table: DataFrame
    tokens: int
    types: int
    head: dict[str, int]
    head_counts: np.ndarray
    class_mass: np.ndarray

    @property
    def total(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)

    @property
    def tasks(self) -> int:
        return max(16, self.tokens // TASK_TOKENS)

    @property
    def unigram(self) -> np.ndarray:
        """b of each symbol: head words, the end, classes."""
        return np.concatenate([self.head_counts + 0.5, self.class_mass]) / self.total


def class_of(word: str) -> int:
    return zlib.crc32(word[-2:].encode()) % CLASSES


def _classes(words: pa.Array) -> np.ndarray:
    """``class_of`` each word; few of their last two characters are distinct."""
    codes, ends = coded(pc.utf8_slice_codeunits(words, -2))
    return np.array([class_of(w) for w in ends.to_pylist()], np.int64)[codes]


def _class_column(word: Column) -> Column:
    return F.crc32(F.right(word, F.lit(2)).cast("binary")) % CLASSES


def count_words(docs: DataFrame, text_col: str = "text", head: int = HEAD) -> Counts:
    def tally(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, words = words_of(batch.column(0))
        codes, distinct = coded(words)
        n = np.bincount(codes, minlength=len(distinct)).astype(np.int64)
        ends = pa.array([batch.num_rows], pa.int64())
        names = pa.concat_arrays([distinct.cast(pa.string()), pa.array([END])])
        return pa.RecordBatch.from_arrays([names, pa.concat_arrays([pa.array(n), ends])], names=["word", "n"])

    texts = docs.select(F.col(text_col).alias("text"))
    counts = map_texts(texts, "text", tally, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    table = staged(counts)
    tokens, types = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    words = table.where(F.col("word") != END)
    most = _most_frequent(words, head)
    places = {r.word: i for i, r in enumerate(most)}
    ends = table.where(F.col("word") == END).first()
    head_counts = np.array([r.n for r in most] + [ends.n if ends else 0], float)
    mass = np.full(CLASSES, 0.5)
    for c, n, size in words.groupBy(_class_column(F.col("word"))).agg(F.sum("n"), F.count("*")).collect():
        mass[c] += n + 0.5 * size
    for word, i in places.items():
        mass[class_of(word)] -= head_counts[i] + 0.5
    return Counts(table, int(tokens), int(types), places, head_counts, np.maximum(mass, 0.5))


def _most_frequent(words: DataFrame, head: int) -> list:
    """The ``head`` rows (word, n) with the greatest counts, words of one count by their text.

    A top-k would send k rows from every task to the driver; this takes whole counts, then whole
    first characters of the count that does not fit, and so on, never over ``head`` rows at once.
    """
    least, taken, ties, n_ties = None, 0, None, 0
    for r in sorted(words.groupBy("n").count().collect(), reverse=True):
        if taken + r["count"] > head:
            ties, n_ties = words.where(F.col("n") == r.n), r["count"]
            break
        least, taken = r.n, taken + r["count"]
    found = words.where(F.col("n") >= least).collect() if taken else []
    size = 1
    while ties is not None and len(found) < head:
        if n_ties <= head:
            found += sorted(ties.collect(), key=lambda r: r.word)[: head - len(found)]
            break
        start, room, whole = F.left("word", F.lit(size)), head - len(found), None
        for r in sorted(ties.groupBy(start.alias("start")).count().collect()):
            if r["count"] > room:
                split, n_ties = r.start, r["count"]
                break
            whole, room = r.start, room - r["count"]
        if whole is not None:
            found += ties.where(start <= whole).collect()
        ties, size = ties.where(start == split), size + 1
    return sorted(found, key=lambda r: (-r.n, r.word))


@dataclass
class Model:
    start: np.ndarray
    middle: np.ndarray  # states in the middle of a text, where a training run may begin
    moves: np.ndarray
    emissions: np.ndarray  # head, end and classes x states
    scale: np.ndarray | None = None  # a word outside the head has the emission count / scale + prior x b
    prior: np.ndarray | None = None
    counts: DataFrame | None = None  # expected counts: rows of kind _ADDED for buckets, _OWN for slices
    words: DataFrame | None = None  # each bucket's words by place and their counts


def symbols(texts: pa.Array, head: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(offsets, symbols, places in the distinct words, distinct words); each text ends with the end symbol."""
    offsets, words = words_of(texts)
    codes, distinct = coded(words)
    at = pc.fill_null(pc.index_in(distinct, value_set=pa.array(list(head), distinct.type)), -1).to_numpy()
    of = np.append(np.fromiter(head.values(), np.int64, len(head)), -1)[at]  # the last one is for words that are not found
    rare = np.flatnonzero(of < 0)
    of[rare] = len(head) + 1 + _classes(distinct.take(pa.array(rare)))
    n = len(offsets) - 1
    ends = offsets[1:] + np.arange(n)
    out, places = np.empty(len(codes) + n, np.int64), np.full(len(codes) + n, -1, np.int64)
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[ends], out[inside], places[inside] = len(head), of[codes], codes
    return offsets + np.arange(n + 1), out, places, distinct


def expected(offsets: np.ndarray, seen: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected emissions (tokens x states), moves and starts, over runs of at most RUN tokens."""
    n = np.diff(offsets)
    pieces = -(-n // RUN)
    text = np.repeat(np.arange(len(n)), pieces)
    number = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = offsets[:-1][text] + number * RUN
    size = np.minimum(RUN, offsets[1:][text] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size, first = begin[order], size[order], number[order] == 0
    k, kind = len(model.start), model.emissions.dtype
    back = np.ascontiguousarray(model.moves.T)
    emitted, moves = np.empty((len(seen), k), kind), np.zeros((k, k))
    for a in range(0, len(begin), SIDE):
        at, first_here, longest = begin[a : a + SIDE], first[a : a + SIDE, None], int(size[a])
        live = _live(size[a : a + SIDE], longest)
        place = _places(at, 0, longest, len(seen))
        outs = np.take(model.emissions, seen[place], axis=0)
        alphas = np.empty_like(outs)
        for t, m in enumerate(live[:-1]):
            alpha, out = alphas[t, :m], outs[t, :m]
            if t:
                np.matmul(alphas[t - 1, :m], model.moves, out=alpha)
            else:
                alpha[:] = np.where(first_here, model.start, model.middle)
            out /= np.einsum("ij,ij->i", alpha, out)[:, None]
            alpha *= out
        beta = np.ones((len(at), k), kind)
        for t in range(longest - 1, -1, -1):
            m, after = live[t], live[t + 1]
            if after:
                ahead = outs[t + 1, :after]
                ahead *= beta[:after]
                moves += alphas[t, :after].T @ ahead
                np.matmul(ahead, back, out=beta[:after])
            alphas[t, :m] *= beta[:m]
            emitted[place[t, :m]] = alphas[t, :m]
    return emitted, moves * model.moves, emitted[begin[first]].sum(axis=0, dtype=float) if len(begin) else np.zeros(k)


def likelihood(offsets: np.ndarray, seen: np.ndarray, model: Model) -> np.ndarray:
    """Natural log probability of each whole sequence, by the scaled forward recursion."""
    n = np.diff(offsets)
    order = np.argsort(-n, kind="stable")
    begin, size = offsets[:-1][order], n[order]
    longest = int(size[0]) if len(size) else 0
    live = _live(size, longest)
    # A step takes a sum times the least emission at worst; so many steps stay far above the least double.
    least = float(model.emissions.min()) if longest else 1.0
    safe = 1 if least <= 0 else int(np.clip(250 / max(-np.log10(least), 1), 1, 32))
    out = np.zeros(len(n))
    alpha = np.tile(model.start, (live[0], 1))
    a = 0
    while a < longest:
        steps = max(1, min(safe, longest - a, _AT_ONCE // live[a]))
        emitted = np.take(model.emissions, seen[_places(begin[: live[a]], a, a + steps, len(seen))], axis=0)
        for t, (m, after) in enumerate(zip(live[a:], live[a + 1 : a + 1 + len(emitted)])):
            if a + t:
                alpha = alpha[:m] @ model.moves
            alpha *= emitted[t, :m]
            out[after:m] += np.log(alpha[after:].sum(axis=1))  # of texts that end here
        alpha = alpha[:after]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        out[:after] += np.log(scale)
        a += steps
    back = np.empty(len(n))
    back[order] = out
    return back


def _live(size: np.ndarray, longest: int) -> list[int]:
    """How many of the sequences, longest first, have a token at each place, and after the last one."""
    return np.searchsorted(-size, -np.arange(longest + 1), side="left").tolist()


def _places(begin: np.ndarray, start: int, end: int, n: int) -> np.ndarray:
    """Where the tokens ``start`` to ``end`` of each sequence are, in a row per token; beyond its end anywhere."""
    return np.minimum(begin + np.arange(start, end)[:, None], n - 1)


def _start(unigram: np.ndarray, states: int) -> Model:
    noise = np.random.default_rng(7).uniform(0.5, 1.5, (len(unigram), states))
    noise[-CLASSES:] = 1
    emissions = unigram[:, None] * noise
    even = np.full(states, 1 / states)
    moves = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    scale = emissions.sum(axis=0)
    return Model(even, even, moves, emissions / scale, np.ones(states), 1 / scale)


# Rows of the encoded texts: a slice's sequence (in bucket -1), and per slice and bucket its words outside the head.
_TEXTS = -1
# Kinds of rows that buckets get, in this order; what a slice keeps for itself; sums of a task's symbols.
_WORDS, _ADDED, _ASKED, _OWN, _TOTAL = range(5)
# Symbols whose sums are added up in one row.
_CHUNK = 1024
_PACKED = "share int, slice bigint, bucket int, ids array<{}>, words array<string>, offsets binary, seen binary, classes binary, buckets binary, sizes binary"


def _squeezed(x: np.ndarray) -> bytes:
    """Small numbers compressed, all their lowest bytes first."""
    planes = np.ascontiguousarray(x.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def _loosened(data: bytes, size: int) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(data, 4 * size, asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<i4").ravel()


# Words of so many bytes are long.
_LONG = 64
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = (_CRC >> 1) ^ np.where(_CRC & 1, np.uint32(0xEDB88320), np.uint32(0))


def _bucket_of(words: pa.Array, tasks: int) -> np.ndarray:
    """crc32 of each word's bytes, modulo the tasks: byte after byte for all words side by side, long ones each alone."""
    raw, ends = text_bytes(words)
    size = np.minimum(np.diff(ends), _LONG).astype(np.uint8)
    order = np.argsort(_LONG - size, kind="stable")
    begin, live = ends[:-1][order], _live(size[order].astype(np.int64), _LONG)
    long = live[_LONG - 1]
    crc = np.full(len(words), 0xFFFFFFFF, np.uint32)
    for i, m in enumerate(live[: _LONG - 1]):
        if m == long:
            break
        c = crc[long:m]
        c[:] = _CRC[(c ^ raw[begin[long:m] + i]) & 255] ^ (c >> 8)
    crc ^= 0xFFFFFFFF
    for i, at in enumerate(order[:long].tolist()):
        crc[i] = zlib.crc32(raw[ends[at] : ends[at + 1]])
    out = np.empty(len(words), np.int64)
    out[order] = crc % tasks
    return out


def _encoded(source: DataFrame, head, tasks: int) -> DataFrame:
    """Slices of the frame (doc_id, share, text), each in a row of its own (bucket -1) and one per bucket of its words.

    ``seen`` has places in the head, then the end, then places in the slice's other words, which are in
    order of their buckets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list[pa.RecordBatch]] = {}
        sizes: dict[int, int] = {}
        for batch in batches:
            share = batch.column(1).to_numpy()
            for own in np.unique(share).tolist():
                for part in slices(batch.filter(pa.array(share == own)), "text", SLICE):
                    held.setdefault(own, []).append(part)
                    sizes[own] = sizes.get(own, 0) + len(text_bytes(part.column(2))[0])
                    if sizes[own] >= SLICE:
                        yield pack(pa.Table.from_batches(held.pop(own)).combine_chunks().to_batches()[0], own, number)
                        number, sizes[own] = number + 1, 0
        for own, parts in held.items():
            yield pack(pa.Table.from_batches(parts).combine_chunks().to_batches()[0], own, number)
            number += 1

    def pack(part: pa.RecordBatch, share: int, number: int) -> pa.RecordBatch:
        offsets, seen, places, distinct = symbols(part.column(2), head.value)
        rare = np.flatnonzero(seen > len(head.value))
        used, local = np.unique(places[rare], return_inverse=True)
        seen_classes = seen[rare] - len(head.value) - 1
        words = distinct.take(pa.array(used)).cast(pa.string())
        bucket = _bucket_of(words, tasks)
        order = np.argsort(bucket, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        seen[rare] = len(head.value) + 1 + back[local]
        classes = np.empty(len(used), np.uint8)
        classes[local] = seen_classes
        classes = classes[order]
        buckets, first, sizes = np.unique(bucket[order], return_index=True, return_counts=True)
        n = len(buckets)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], first, [len(order)]]).astype(np.int32)), words.take(pa.array(order)))
        one = lambda x, kind: pa.array([x.astype(kind).tobytes()] + [None] * n, pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([share] * (n + 1), pa.int32()),
                pa.array([number] * (n + 1), pa.int64()),
                pa.array([_TEXTS, *buckets.tolist()], pa.int32()),
                pa.array([part.column(0).to_pylist()] + [None] * n, pa.list_(part.column(0).type)),
                lists,
                one(offsets, np.int64),
                pa.array([_squeezed(seen)] + [None] * n, pa.binary()),
                one(classes, np.uint8),
                one(buckets, np.int32),
                one(sizes, np.int32),
            ],
            names=["share", "slice", "bucket", "ids", "words", "offsets", "seen", "classes", "buckets", "sizes"],
        )

    kind = source.schema["doc_id"].dataType.simpleString()
    return staged(source.mapInArrow(run, _PACKED.format(kind)), compression="zstd")


_BUCKET_ROW = "bucket int, kind int, slice bigint, words array<string>, n binary, places binary, parts binary, sums binary"


def _bucket_rows(df: DataFrame, kind: int, **columns) -> DataFrame:
    """The frame as rows of a kind that buckets get; columns it has not are NULL."""
    have = {"kind": F.lit(kind), **columns}
    names = [c.split(" ") for c in _BUCKET_ROW.split(", ")]
    return df.select(*[have.get(n, F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in names])


def _batch(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


def _vocabulary(counts: Counts, tasks: int) -> DataFrame:
    """The table of counts in rows of a bucket."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            order = np.argsort(bucket, kind="stable")
            ids, first = np.unique(bucket[order], return_index=True)
            n = batch.column(2).to_numpy().astype("<i8")[order]
            ends = np.append(first, len(order))
            data = [n[a:b].tobytes() for a, b in zip(ends, ends[1:])]
            words = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), batch.column(1).take(pa.array(order)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), words, pa.array(data, pa.binary())], names=["bucket", "words", "n"])

    bucket = (F.crc32(F.col("word").cast("binary")) % tasks).cast("int")
    rows = counts.table.where(F.col("word") != END).select(bucket.alias("bucket"), "word", "n")
    return rows.repartition(tasks, "bucket").mapInArrow(pack, "bucket int, words array<string>, n binary")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}


def _read(row: dict, name: str, kind) -> np.ndarray:
    return np.frombuffer(row[name].as_py() or b"", kind)


def _joined(rows: list[dict], name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[name].as_py() for r in rows), kind)


_PLACED = [("share", pa.int32()), ("slice", pa.int64()), ("bucket", pa.int32()), ("words", pa.list_(pa.string())), ("n", pa.binary()), ("places", pa.binary()), ("shared", pa.binary()), ("wanted", pa.binary())]


def _placed(encoded: DataFrame, counts: Counts) -> DataFrame:
    """Places of words in their buckets, by the words' order.

    A row per bucket (slice NULL) with its words and their counts; a row per slice and bucket with the
    counts and places of the slice's words, whether other slices have them (``shared``), and the
    places of those (``wanted``).
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groupby(_rows(batches), key=lambda r: r["bucket"].as_py()):
            rows = list(rows)
            lists = [r["words"].values for r in rows]
            codes, distinct = coded(pa.concat_arrays(lists))
            order = pc.sort_indices(distinct)
            place = np.empty(len(distinct), np.int64)
            place[order.to_numpy()] = np.arange(len(distinct))
            codes = place[codes]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            n, having, asked = np.zeros(len(distinct), "<i8"), np.zeros(len(distinct), np.int32), []
            for row, a, b in zip(rows, ends, ends[1:]):
                if row["kind"].as_py() == _WORDS:
                    n[codes[a:b]] = _read(row, "n", "<i8")
                else:
                    having[codes[a:b]] += 1  # words of a slice are distinct
                    asked.append((row["share"].as_py(), row["slice"].as_py(), codes[a:b]))
            words = pa.ListArray.from_arrays(pa.array([0, len(distinct)], pa.int32()), distinct.take(order))
            yield _batch(_PLACED, [(None, None, bucket, None, n.tobytes(), None, None, None)]).set_column(3, "words", words)
            for share, number, at in asked:
                at, shared = at.astype("<i4"), having[at] > 1
                yield _batch(_PLACED, [(share, number, bucket, None, n[at].tobytes(), at.tobytes(), shared.tobytes(), at[shared].tobytes())])

    asked = encoded.where(F.col("bucket") != _TEXTS).select("bucket", F.lit(_ASKED).alias("kind"), "share", "slice", "words")
    words = _vocabulary(counts, counts.tasks).withColumn("kind", F.lit(_WORDS))
    rows = words.unionByName(asked, allowMissingColumns=True)
    dealt = rows.repartition(counts.tasks, "bucket").sortWithinPartitions("bucket", "kind", "slice")
    return staged(dealt.mapInArrow(settle, "share int, slice bigint, bucket int, words array<string>, n binary, places binary, shared binary, wanted binary"), compression="zstd")


_SLICE_COLUMNS = ("ids", "offsets", "seen", "classes", "buckets", "sizes")


def _beside(texts: DataFrame, more: list[DataFrame], tasks: int) -> DataFrame:
    """Sequences and other rows of each slice, together and in order of their buckets."""
    for rows in more:
        texts = texts.unionByName(rows, allowMissingColumns=True)
    return texts.repartition(tasks, "slice").sortWithinPartitions("slice", "bucket")


def _prepared(encoded: DataFrame, placed: DataFrame, counts: Counts) -> DataFrame:
    """A row per slice: its sequence, and the counts and places of its words outside the head; in a folder per share."""
    added = ("n", "places", "shared")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_rows(batches), key=lambda r: r["slice"].as_py()):
            text, *more = rows
            data = [pa.array([b"".join(r[name].as_py() for r in more)], pa.binary()) for name in added]
            names = ["share", "slice", "bucket", *_SLICE_COLUMNS]
            yield pa.RecordBatch.from_arrays([pa.array([text[c].as_py()], text[c].type) for c in names] + data, names=[*names, *added])

    texts = encoded.where(F.col("bucket") == _TEXTS).select("share", "slice", "bucket", *_SLICE_COLUMNS)
    own = placed.where("slice is not null").select("slice", "bucket", *added)
    kind = encoded.schema["ids"].dataType.simpleString()
    columns = f"share int, slice bigint, bucket int, ids {kind}, " + ", ".join(f"{c} binary" for c in [*_SLICE_COLUMNS[1:], *added])
    return staged(_beside(texts, [own], counts.tasks).mapInArrow(join, columns), "share", compression="zstd")


_REPLY = [("slice", pa.int64()), ("bucket", pa.int32()), ("n", pa.binary()), ("parts", pa.binary()), ("sums", pa.binary())]


def _split(c: np.ndarray) -> tuple[bytes, bytes]:
    """Expected counts (words x states) as each state's part of the sum, and the sum."""
    sums = c.sum(axis=1)
    return np.rint(c * (255 / np.maximum(sums, 1e-30))[:, None]).astype(np.uint8).tobytes(), sums.astype("<f4").tobytes()


def _whole(parts: np.ndarray, sums: np.ndarray, k: int) -> np.ndarray:
    c = parts.reshape(-1, k).astype(float)
    return c * (sums / np.maximum(c.sum(axis=1), 1))[:, None]


def _found(lists: list[pa.Array], known: pa.Array | None, missing: int) -> list[np.ndarray]:
    """Place in ``known`` of each word of the lists, or ``missing``; the known words are indexed once for all lists."""
    if known is None or not lists:
        return [np.full(len(x), missing) for x in lists]
    at = pc.fill_null(pc.index_in(pa.concat_arrays(lists), value_set=known), missing).to_numpy()
    return np.split(at, np.cumsum([len(x) for x in lists])[:-1])


def _replies(asked: DataFrame, words: DataFrame | None, model: Model, tasks: int) -> DataFrame:
    """(slice, bucket, n, parts, sums): expected counts of the words each slice asks for, by place or as strings; counts with the latter."""
    k, as_strings = len(model.start), words is not None

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groupby(_rows(batches), key=lambda r: r["bucket"].as_py()):
            rows, known, n = list(rows), None, None
            added = [(_read(r, "places", "<i4"), r) for r in rows if r["kind"].as_py() == _ADDED]
            size = 1 + max((int(at.max()) for at, _ in added if len(at)), default=-1)
            for r in rows:
                if r["kind"].as_py() == _WORDS:
                    known, n = r["words"].values, _read(r, "n", "<i8")
                    size = max(size, len(known))
            c = np.zeros((size + 1, k))  # the last one is for words that no learning document has
            for at, r in added:
                c[at] += _whole(_read(r, "parts", np.uint8), _read(r, "sums", "<f4"), k)  # words of a slice are distinct
            asking, counted = [r for r in rows if r["kind"].as_py() == _ASKED], None
            if as_strings:
                counted = np.zeros(size + 1, "<i8")
                if n is not None:
                    counted[: len(n)] = n
                places = _found([r["words"].values for r in asking], known, size)
            else:
                places = [np.minimum(_read(r, "places", "<i4"), size) for r in asking]
            for r, at in zip(asking, places):
                count = counted[at].tobytes() if as_strings else None
                yield _batch(_REPLY, [(r["slice"].as_py(), bucket, count, *_split(c[at]))])

    rows = asked
    if words is not None:
        rows = rows.unionByName(_bucket_rows(words, _WORDS))
    if model.counts is not None:
        rows = rows.unionByName(_bucket_rows(model.counts.where(F.col("kind") == _ADDED), _ADDED))
    dealt = rows.repartition(tasks, "bucket").sortWithinPartitions("bucket", "kind", "slice")
    return dealt.mapInArrow(settle, "slice bigint, bucket int, n binary, parts binary, sums binary")


_DONE = [("kind", pa.int32()), ("bucket", pa.int32()), ("slice", pa.int64()), ("places", pa.binary()), ("parts", pa.binary()), ("sums", pa.binary())]


def _round(part: DataFrame, wanted: DataFrame, counts: Counts, model: Model, tasks: int, after: str) -> Model:
    """One round of Baum-Welch over prepared slices: the model from the counts added up per symbol.

    ``after`` says who needs the expected counts outside the head: another "share", the "whole", or the
    "score", for which all of them go to the buckets.
    """
    k, unigram, head = len(model.start), counts.unigram, len(counts.head)
    size, whole, beyond = len(unigram), counts.total * unigram.sum(), counts.tasks  # no bucket has the last number
    sc = part.sparkSession.sparkContext
    plain = sc.broadcast((model.start, model.middle, model.moves, model.emissions[: head + 1], model.scale, model.prior))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, middle, moved, emissions, scale, prior = plain.value
        small = [x.astype(np.float32) for x in (start, middle, moved)]
        total = np.zeros((size + k + 2, k))
        for number, rows in groupby(_rows(batches), key=lambda r: r["slice"].as_py()):
            row, *more = rows
            offsets, classes = _read(row, "offsets", np.int64), _read(row, "classes", np.uint8).astype(np.int64)
            seen = _loosened(row["seen"].as_py(), int(offsets[-1]))
            n, places, shared = _read(row, "n", "<i8"), _read(row, "places", "<i4"), _read(row, "shared", bool)
            c = np.zeros((len(n), k))
            own = [r for r in more if r["bucket"].as_py() == beyond]
            more = [r for r in more if r["bucket"].as_py() != beyond]
            for kept, mask in ((own, ~shared), (more, shared)):
                if kept:
                    c[mask] = _whole(_joined(kept, "parts", np.uint8), _joined(kept, "sums", "<f4"), k)
            rare = c / scale + prior * ((n + 0.5) / whole)[:, None]
            emitted, moves, starts = expected(offsets, seen, Model(*small, np.concatenate([emissions.astype(np.float32), rare.astype(np.float32)])))
            per = np.column_stack([np.bincount(seen, emitted[:, s], minlength=head + 1 + len(n)) for s in range(k)])
            total[: head + 1] += per[: head + 1]
            per = per[head + 1 :]
            total[head + 1 : size] += np.column_stack([np.bincount(classes, per[:, s], minlength=CLASSES) for s in range(k)])
            total[size : size + k] += moves
            total[size + k] += starts
            total[size + k + 1] += emitted.sum(axis=0, dtype=float)
            sent = np.ones(len(n), bool) if after == "score" else shared
            ends = np.concatenate([[0], np.cumsum(_read(row, "sizes", np.int32))])
            out = []
            for bucket, a, b in zip(_read(row, "buckets", np.int32).tolist(), ends, ends[1:]):
                at = a + np.flatnonzero(sent[a:b])
                if len(at):
                    out.append((_ADDED, bucket, number, places[at].tobytes(), *_split(per[at])))
            if after == "whole":
                out.append((_OWN, beyond, number, None, *_split(per[~shared])))
            yield _batch(_DONE, out)
        task = TaskContext.get().partitionId()
        chunks = [(i, total[i : i + _CHUNK]) for i in range(0, len(total), _CHUNK)]
        yield _batch(_DONE, [(_TOTAL, i, task, None, None, x.astype("<f4").tobytes()) for i, x in chunks if x.any()])

    rows = part.select("slice", "bucket", "offsets", "seen", "classes", "buckets", "sizes", "n", "places", "shared")
    if model.counts is not None:
        replies = _replies(_bucket_rows(wanted, _ASKED), None, model, tasks).drop("n")
        own = model.counts.where(F.col("kind") == _OWN).select("slice", "bucket", "parts", "sums")
        rows = _beside(rows, [replies, own], tasks)
    done = staged(rows.mapInArrow(run, "kind int, bucket int, slice bigint, places binary, parts binary, sums binary"), compression="zstd")
    plain.destroy()
    total = np.zeros((size + k + 2, k))
    for r in _summed(done).collect():  # a row for each chunk of head, classes and states
        x = np.frombuffer(r.sums, float).reshape(-1, k)
        total[r.bucket : r.bucket + len(x)] = x
    mixed = _SHARE * total[:size].sum(axis=0) + _PRIOR
    emissions = total[:size] + mixed * (unigram / unigram.sum())[:, None]
    moves = total[size : size + k] + 0.1
    start, middle = total[size + k] + 0.1, total[size + k + 1] + 0.1
    scale = emissions.sum(axis=0)
    return Model(start / start.sum(), middle / middle.sum(), moves / moves.sum(axis=1, keepdims=True), emissions / scale, scale, mixed / scale, done)


def _summed(done: DataFrame) -> DataFrame:
    """Each chunk's sums added up over the tasks, in order of the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in groupby(_rows(batches), key=lambda r: r["bucket"].as_py()):
            total = 0.0
            for r in rows:
                total = total + _read(r, "sums", "<f4").astype(float)
            yield _batch([("bucket", pa.int32()), ("sums", pa.binary())], [(chunk, total.tobytes())])

    rows = done.where(F.col("kind") == _TOTAL).select("bucket", "slice", "sums")
    return rows.repartition("bucket").sortWithinPartitions("bucket", "slice").mapInArrow(add, "bucket int, sums binary")


def fit(docs: DataFrame, counts: Counts, id_col: str = "doc_id", text_col: str = "text", states: int = STATES, start_rounds: int = 10, rounds: int = 2) -> Model:
    spark = docs.sparkSession
    model, shares = _start(counts.unigram, states), max(1, start_rounds)
    share = F.pmod(F.xxhash64(F.col(id_col)), F.lit(shares)).cast("int")
    source = docs.select(F.col(id_col).alias("doc_id"), share.alias("share"), F.col(text_col).alias("text"))
    encoded = _encoded(source, spark.sparkContext.broadcast(counts.head), counts.tasks)
    placed = _placed(encoded, counts)
    prepared = _prepared(encoded, placed, counts)
    _drop(encoded)
    wanted = staged(placed.where("slice is not null").select("share", "slice", "bucket", F.col("wanted").alias("places")), "share", compression="zstd")
    words = staged(placed.where("slice is null").select("bucket", "words", "n"), compression="zstd")
    _drop(placed)
    of_share = lambda df, i: df.where(F.col("share") == i)
    plan = [(of_share(prepared, i), of_share(wanted, i)) for i in range(start_rounds)] + [(prepared, wanted)] * rounds
    for i, (part, asked) in enumerate(plan):
        after = "score" if i + 1 == len(plan) else "share" if i + 1 < start_rounds else "whole"
        tasks = max(16, counts.tasks // shares) if i < start_rounds else counts.tasks
        last, model = model, _round(part, asked, counts, model, tasks, after)
        if last.counts is not None:
            _drop(last.counts)
        del last
        gc.collect()
        spark._jvm.System.gc()  # Spark removes the shuffle files of frames that are gone
    _drop(prepared)
    _drop(wanted)
    model.words = words
    return model


def _drop(df: DataFrame) -> None:
    """Delete the files of a staged frame that is not read again."""
    spark = df.sparkSession
    for folder in {re.sub(r"(/share=[^/]*)?/[^/]*$", "", f) for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def score(docs: DataFrame, counts: Counts, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of every document."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.lit(0).alias("share"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    sc = docs.sparkSession.sparkContext
    encoded = _encoded(source, sc.broadcast(counts.head), counts.tasks)
    asked = _bucket_rows(encoded.where(F.col("bucket") != _TEXTS), _ASKED)
    replies = _replies(asked, model.words, model, counts.tasks)
    k, head, total, end_known = len(model.start), len(counts.head), counts.total, bool(counts.head_counts[-1] > 0)
    shared = sc.broadcast((np.log10(counts.unigram[: head + 1]), model.start, model.middle, model.moves, model.emissions[: head + 1], model.scale, model.prior))
    whole_mass = total * counts.unigram.sum()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, start, middle, moves, emissions, scale, prior = shared.value
        for _, rows in groupby(_rows(batches), key=lambda r: r["slice"].as_py()):
            row, *more = rows
            offsets = _read(row, "offsets", np.int64)
            seen = _loosened(row["seen"].as_py(), int(offsets[-1]))
            n = _joined(more, "n", "<i8")
            own = _whole(_joined(more, "parts", np.uint8), _joined(more, "sums", "<f4"), k) / scale + prior * ((n + 0.5) / whole_mass)[:, None]
            whole = likelihood(offsets, seen, Model(start, middle, moves, np.concatenate([emissions, own]))) / np.log(10)
            known = np.concatenate([np.full(head, True), [end_known], n > 0])
            base = np.concatenate([logs, np.log10((n + 0.5) / total)])
            of, size = rows_of(offsets), len(offsets) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    row["ids"].values,
                    pa.array(np.diff(offsets)),
                    pa.array(np.bincount(of[known[seen]], minlength=size)),
                    pa.array(np.bincount(of, base[seen], minlength=size)),
                    pa.array(whole),
                ],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    texts = encoded.where(F.col("bucket") == _TEXTS).select("slice", "bucket", "ids", "offsets", "seen")
    rows = _beside(texts, [replies], counts.tasks)
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")
