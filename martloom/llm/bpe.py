"""Byte-level BPE: higher-order functions fold ranked merges over the bytes of distinct words.

1. Documents are split into the matches of the tokenizer's pattern, in blocks of about ``BLOCK_BYTES`` of text (or one
   longer text). Where the pattern is known to begin a match at single spaces (``SPACED``), texts are cut there first and
   each distinct chunk of a block is split once. A match that is a piece itself has that piece's id; a block's other distinct
   words are sent to the buckets of their hashes.
2. A bucket has each of its words once for the whole corpus. Spark's ``aggregate`` folds it: the adjacent pair of lowest
   rank is merged until no pair is in the rank map, a broadcast row of two arrays (two hash positions per pair, so a
   look-up is two array reads); as literals they would stand in every description of the plan. Words of ``LONG`` bytes and more are folded as strings of one character a token, in which all
   places of the pair of lowest rank are replaced at once.
3. The ids go back to the blocks that asked, packed, and meet the block's chunks, as numbers of its words. For these the texts
   are split a second time, which costs less than storing all numbers.

Decoding looks every id up in the array of pieces and concatenates them: ``encode`` does so on request, ``decoded`` for a column
of ids. The rank map has the size of the vocabulary file.

``docs`` is read twice and must give its rows in the same order each time, as a stored table does; a block whose words
differ the second time is an error.

Edge cases: NULL and empty texts have no ids and decode to no bytes. Strings that look
like special tokens are ordinary text. Repeated rows and ids are encoded row by
row; ids may be of any type and NULL. Matches of any length are folded; the work grows with their length times the kinds
of merges in them. NULL ids decode to NULL. An empty table has no rows. Extra columns are ignored by ``encode``.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from itertools import chain, groupby, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from martloom.llm.common import coded, release_memory, rows_of, slices, text_bytes

BLOCK_BYTES = 8 << 20
# Texts above are split part by part, or match by match, without a list of all matches.
LONG_TEXT = 1 << 20
# Its white space begins a match of its own or is the first character of one, so a match begins at every space between two
# characters that are no white space, and matches beside it are the same without the other side.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Letters of which all versions of Unicode and all libraries agree that they are letters.
_LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u0391-\u03a1\u03a3-\u03f5\u0400-\u0481\u048a-\u052f\u05d0-\u05ea\u0620-\u064a\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]+$"
# Chunks whose ids are made at once, and more if one document has them.
CHUNKS = 250_000
# Text for each bucket of words and each task.
TASK_BYTES = 4 << 20
LONG = 256
# Primes: a pair's two places in the table are its key's remainders. The pairs of a file of 50,000 pieces fill about half.
_PLACES = (262139, 249989)
_SPREAD = 1_000_003


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}


def pair_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and merged ranks of every pair of pieces whose bytes together are a piece, at one of two positions."""
    pairs = [
        (ranks[piece[:i]], ranks[piece[i:]], rank)
        for piece, rank in ranks.items()
        for i in range(1, len(piece))
        if piece[:i] in ranks and piece[i:] in ranks
    ]
    size = max(_PLACES)
    keys, values = [-1] * size, [-1] * size
    for a, b, rank in pairs:
        key, prime = a * _SPREAD + b, _PLACES[0]
        for _ in range(500):
            at = key % prime
            key, keys[at] = keys[at], key
            rank, values[at] = values[at], rank
            if key < 0:
                break
            prime = _PLACES[1] if key % _PLACES[0] == at else _PLACES[0]
        else:
            raise ValueError("the rank file has too many pairs for the table")
    return np.array(keys, np.int64), np.array(values, np.int32)


def _rank_map(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """One row (keys, values): the pair table."""
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in pair_table(ranks)]
    return spark.createDataFrame(pa.table(lists, names=["keys", "values"]))


def _literal(values: list[str]) -> Column:
    """A foldable array; parsed once, when the plan is optimised."""
    return F.split(F.lit(",".join(values)), ",")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once; Spark has no let."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _rank(a: Column, b: Column, keys: Column, values: Column) -> Column:
    """The rank of the piece that two neighbours make; NULL if none."""
    key = a * F.lit(_SPREAD).cast("bigint") + b
    first, second = ((key % F.lit(p).cast("bigint")).cast("int") for p in _PLACES)
    return F.when(F.get(keys, first) == key, F.get(values, first)).when(F.get(keys, second) == key, F.get(values, second))


def merged(tokens: Column, keys: Column, values: Column) -> Column:
    """The ids of one word, from its array of byte tokens."""

    def rank(a: Column, b: Column) -> Column:
        return _rank(a, b, keys, values)

    def step(state: Column, _: Column) -> Column:
        ids, next_ranks = state["ids"], state["ranks"]

        def at(p: Column) -> Column:
            def join(best: Column) -> Column:
                left, right = rank(F.get(ids, p - 2), best), rank(best, F.get(ids, p + 1))
                # the left place of the pair is p - 1, from 0; taking out and replacing costs less than joining slices
                new_ids = F.transform(F.filter(ids, lambda _, i: i != p), lambda x, i: F.when(i == p - 1, best).otherwise(x))
                new_ranks = F.transform(
                    F.filter(next_ranks, lambda _, i: i != p), lambda x, i: F.when(i == p - 1, right).when(i == p - 2, left).otherwise(x)
                )
                return F.struct(new_ids.alias("ids"), new_ranks.alias("ranks"))

            return F.when(p.isNull(), state).otherwise(_bound(F.get(next_ranks, p - 1), join))

        return _bound(F.array_position(next_ranks, F.array_min(next_ranks)).cast("int"), at)

    ranks = F.transform(tokens, lambda a, i: rank(a, F.get(tokens, i + 1)))
    start = F.struct(tokens.alias("ids"), ranks.alias("ranks"))
    return F.aggregate(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens), F.lit(0))), start, step, lambda state: state["ids"])


def merged_long(tokens: Column, keys: Column, values: Column) -> Column:
    """The ids of one long word. A token is a character, its code the id, moved past the surrogates.

    A pair that contains a merged token ranks after the merge that made it, so all places of one pair are merged together.
    """
    gap = 0xE000 - 0xD800

    def letter(i: Column) -> Column:
        code = F.when(i < 0xD800, i).otherwise(i + gap)
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def numbers(text: Column) -> Column:
        code = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("int"))
        return F.transform(code, lambda i: F.when(i < 0xD800, i).otherwise(i - gap))

    def step(state: Column, _: Column) -> Column:
        def best(ids: Column) -> Column:
            pairs = F.transform(ids, lambda a, i: F.struct(_rank(a, F.get(ids, i + 1), keys, values).alias("rank"), a.alias("a"), F.get(ids, i + 1).alias("b")))
            return F.array_min(F.filter(pairs, lambda p: p["rank"].isNotNull()))

        def join(found: Column) -> Column:
            text = F.replace(state["text"], F.concat(letter(found["a"]), letter(found["b"])), letter(found["rank"]))
            return F.struct(F.coalesce(text, state["text"]).alias("text"), found.isNull().alias("done"))

        return F.when(state["done"], state).otherwise(_bound(_bound(numbers(state["text"]), best), join))

    start = F.struct(F.array_join(F.transform(tokens, letter), "").alias("text"), F.lit(False).alias("done"))
    return F.aggregate(tokens, start, step, lambda state: numbers(state["text"]))


_ASK = "bucket int, block bigint, sizes binary, words binary"
_NAMED = "bucket int, blocks binary, ends binary, codes binary, words array<array<int>>"
_BLOCK = "block bigint, bucket int, doc_ids array<{}>, ends binary, sizes binary, data binary"


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    decode: bool = False,
) -> DataFrame:
    """doc_id and ids, the token ids of its text; with ``decode`` also the bytes that the ids decode to."""
    spark = docs.sparkSession
    ranks = read_ranks(ranks_path)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    tasks = max(8, size // TASK_BYTES)
    table = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    shared = spark.sparkContext.broadcast(pa.array(table, pa.large_binary()))  # bounded: the vocabulary file
    width = np.uint32 if len(table) > 65_536 else np.uint16
    byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def blocks(batches: Iterator[pa.RecordBatch]):
        """(block number, doc ids, chunks of its texts)."""
        number, doc_ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0
        for part in (p for batch in batches for p in slices(batch, "text", 1 << 20)):
            size = int(text_bytes(part.column(1))[1][-1])
            if doc_ids and held + size > block_bytes:
                chunks, texts = _Chunks(pattern, texts), []
                yield number, pa.concat_arrays(doc_ids), chunks
                number, doc_ids, held, chunks = number + 1, [], 0, None
                release_memory()
            doc_ids.append(part.column(0))
            texts.append(part.column(1))
            held += size
        part = None
        if doc_ids:
            chunks, texts = _Chunks(pattern, texts), []
            yield number, pa.concat_arrays(doc_ids), chunks
            doc_ids, chunks = [], None
        release_memory()

    def unknown(words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """Ids of all words (-1 if they are no pieces), and buckets, words and places of those, by bucket."""
        own = pc.fill_null(pc.index_in(words.cast(pa.large_binary()), value_set=shared.value), -1).to_numpy()
        at = np.flatnonzero(own < 0)
        rest = words.take(pa.array(at)).cast(pa.large_binary())
        order = pc.array_sort_indices(rest).to_numpy()
        at, raw = at[order], rest.take(pa.array(order)).to_numpy(zero_copy_only=False)
        bucket = np.fromiter((zlib.crc32(w) % tasks for w in raw), np.int32, len(raw))
        order = np.argsort(bucket, kind="stable")
        return own, bucket[order], [raw[i] for i in order], at[order]

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, chunks in blocks(batches):
            _, bucket, raw, _ = unknown(chunks.words()[1])
            ids, first = np.unique(bucket, return_index=True)
            ends = np.append(first, len(raw)).tolist()
            runs = [raw[a:b] for a, b in zip(ends, ends[1:])]
            sizes = [_small(np.array([len(w) for w in own], np.int64)) for own in runs]
            data = [pa.compress(b"".join(own), codec="zstd", asbytes=True) for own in runs]
            columns = [pa.array(ids, pa.int32()), pa.array([number] * len(ids), pa.int64()), pa.array(sizes, pa.binary()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "sizes", "words"])

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per bucket: its distinct words, and of which of them each block's words are."""
        for bucket, rows in groupby(((b.column(0)[i].as_py(), b, i) for b in batches for i in range(b.num_rows)), key=lambda r: r[0]):
            numbers, lists = zip(*[(b.column(1)[i].as_py(), _strings(b.column(2)[i].as_py(), b.column(3)[i].as_py())) for _, b, i in rows])
            codes, words = coded(pa.concat_arrays(list(lists)))
            ends = np.cumsum([len(x) for x in lists])
            columns = [np.array(numbers, np.int64), ends.astype(np.int64), codes.astype(np.int32)]
            packed = [pa.array([c.tobytes()], pa.binary()) for c in columns]
            raw, offsets = text_bytes(words.cast(pa.string()))
            tokens = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(byte_ids[raw]))
            one = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), tokens)
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *packed, one], names=["bucket", "blocks", "ends", "codes", "words"])

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bucket = batch.column(0)[row].as_py()
                numbers, ends = (np.frombuffer(batch.column(j)[row].as_py(), np.int64) for j in (1, 2))
                codes = np.frombuffer(batch.column(3)[row].as_py(), np.int32)
                sizes, flat = _lists(batch.column(4)[row].values)
                for number, a, b in zip(numbers.tolist(), np.append(0, ends[:-1]), ends):
                    own = codes[a:b]
                    data = flat[_runs(sizes, own)].astype(width)
                    yield _block_row(number, bucket, None, kind_of_id, b"", _small(sizes[own]), data.tobytes())

    kind_of_id = _arrow_type(source)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row (bucket -2) of a block's documents, ids of pieces and places of other words, and one (-1) of its chunks."""
        for number, doc_ids, chunks in blocks(batches):
            sizes, words, places = chunks.words()
            own, _, _, at = unknown(words)
            yield _block_row(number, -2, doc_ids, kind_of_id, chunks.ends().tobytes(), own.astype(np.int32).tobytes(), at.astype(np.int32).tobytes())
            # places grow by one from word to word where words are new
            rise = np.diff(places, prepend=-1).astype(np.int32).tobytes()
            spans = [np.array([len(sizes), len(places)], np.int64).tobytes(), pa.compress(sizes.astype(np.int32).tobytes() + rise, codec="zstd", asbytes=True)]
            numbers = chunks.codes().astype(np.uint32)
            low, high = (numbers & 0xFFFF).astype(np.uint16).tobytes(), (numbers >> 16).astype(np.uint16).tobytes()
            yield _block_row(number, -1, None, kind_of_id, len(numbers).to_bytes(8, "little"), b"".join(spans), pa.compress(low + high, codec="zstd", asbytes=True))

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({n: b.column(j)[i] for j, n in enumerate(b.schema.names)} for b in batches for i in range(b.num_rows))
        for _, (head, body, *replies) in ((k, list(g)) for k, g in groupby(rows, key=lambda r: r["block"].as_py())):
            names = head["doc_ids"].values
            ends = np.frombuffer(head["ends"].as_py(), np.int64)
            own, at = np.frombuffer(head["sizes"].as_py(), np.int32), np.frombuffer(head["data"].as_py(), np.int32)
            told = np.concatenate([np.zeros(0, np.int64), *[_sizes(r["sizes"].as_py()) for r in replies]])
            if len(told) != len(at):
                raise ValueError("the documents were not read in the same order twice; store them before they are encoded")
            flat = np.concatenate([np.zeros(0, width), *[np.frombuffer(r["data"].as_py(), width) for r in replies]]).astype(np.int32)
            # the ids of all distinct words: pieces first, then the others in the order of the replies
            sizes, begin = np.ones(len(own), np.int64), np.zeros(len(own), np.int64)
            whole = np.flatnonzero(own >= 0)
            begin[whole] = np.arange(len(whole))
            sizes[at], begin[at] = told, len(whole) + np.cumsum(told) - told
            pool = np.concatenate([own[whole], flat])
            # the ids of all distinct chunks
            n, m = np.frombuffer(body["sizes"].as_py()[:16], np.int64).tolist()
            spans = np.frombuffer(pa.decompress(body["sizes"].as_py()[16:], 4 * (n + m), codec="zstd", asbytes=True), np.int32)
            words = np.cumsum(spans[n:], dtype=np.int64) - 1
            pool = pool[_runs(sizes, words, begin)]
            done = np.concatenate([[0], np.cumsum(sizes[words])])[np.concatenate([[0], np.cumsum(spans[:n])])]
            begin, sizes = done[:-1], np.diff(done)
            n = int.from_bytes(body["ends"].as_py(), "little")
            raw = pa.decompress(body["data"].as_py(), 4 * n, codec="zstd", asbytes=True)
            low, high = np.frombuffer(raw, np.uint16, n), np.frombuffer(raw, np.uint16, n, 2 * n)
            start = 0
            while start < len(ends):  # as many documents as have about ``CHUNKS`` chunks
                base = int(ends[start - 1]) if start else 0
                end = max(start + 1, int(np.searchsorted(ends, base + CHUNKS, side="right")))
                to = int(ends[end - 1])
                mine = low[base:to].astype(np.int64) | (high[base:to].astype(np.int64) << 16)
                ids = pool[_runs(sizes, mine, begin)]
                offsets = np.concatenate([[0], np.cumsum(sizes[mine])])[np.concatenate([[base], ends[start:end]]) - base]
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                columns = {"doc_id": names.slice(start, end - start), "ids": lists}
                if decode:
                    columns["decoded"] = _joined(shared.value.take(pa.array(ids)), offsets)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                start = end
            release_memory()

    asked = source.mapInArrow(ask, _ASK).repartition(tasks, "bucket").sortWithinPartitions("bucket", "block")
    named = asked.mapInArrow(distinct, _NAMED)
    keys, values = F.col("keys"), F.col("values")
    ids = F.transform("words", lambda t: F.when(F.size(t) < LONG, merged(t, keys, values)).otherwise(merged_long(t, keys, values)))
    # a row per bucket, so the row of the map is met as often
    ids = named.crossJoin(F.broadcast(_rank_map(spark, ranks))).select("bucket", "blocks", "ends", "codes", ids.alias("ids"))
    schema = _BLOCK.format(kind)
    met = source.mapInArrow(texts, schema).union(ids.mapInArrow(reply, schema))
    return met.repartition(tasks, "block").sortWithinPartitions("block", "bucket").mapInArrow(in_order, f"doc_id {kind}, ids array<int>" + ", decoded binary" * decode)


class _Places(dict):
    """Words in order of their first look-up."""

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        return place


class _Chunks:
    """The texts of a block as numbers of distinct chunks: matches of the pattern, or what stands between single spaces."""

    def __init__(self, pattern: str, texts: list[pa.Array]):
        self._split = regex.compile(pattern)
        self._values = []  # of each call of ``_add``: distinct words of letters and other chunks, with a space cut off before, and other ones
        self._n_values = 0
        self._matches = _Places()  # numbered downwards from -1 until all chunks are known
        self._codes, self._ends = [], []
        spaced = pattern == SPACED
        texts = pc.fill_null(pa.concat_arrays(texts).cast(pa.large_string()), "")
        sizes = np.diff(text_bytes(texts)[1])
        start = 0
        for i in [*np.flatnonzero(sizes > LONG_TEXT).tolist(), len(sizes)]:
            if start < i:
                short = texts.slice(start, i - start)
                self._add(short, np.zeros(len(short), bool)) if spaced else self._add_matches(short.to_pylist())
            if i < len(sizes):
                self._add_long(texts[i].as_py(), spaced)
            start = i + 1

    def codes(self) -> np.ndarray:
        codes = np.concatenate([np.zeros(0, np.int32), *self._codes])
        return np.where(codes < 0, self._n_values - 1 - codes, codes)

    def ends(self) -> np.ndarray:
        """The ends of the documents in ``codes``."""
        return np.cumsum(np.concatenate([np.zeros(0, np.int64), *self._ends])).astype(np.int64)

    def words(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """How many words each distinct chunk has, the distinct words, and the place of each chunk's words in them."""
        sizes, words = [np.zeros(0, np.int64)], []
        for plain, values, others in self._values:
            sizes.append(np.ones(len(plain), np.int64))
            words.append(pc.binary_join_element_wise(pa.scalar("", plain.type), plain, pa.scalar(" ", plain.type)))
            for at in range(0, len(values), 1 << 16):
                # all at once, as a match begins at each of their spaces
                part = values.slice(at, 1 << 16)
                matches = self._split.findall("".join(chain.from_iterable(zip(repeat(" "), part.to_numpy(zero_copy_only=False)))))
                ends = np.cumsum(pc.utf8_length(part).to_numpy() + 1)
                reach = np.searchsorted(np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches))), ends) + 1
                sizes.append(np.diff(reach, prepend=0))
                words.append(pa.array(matches, pa.large_string()))
            lists = [self._split.findall(v) for v in others]
            sizes.append(np.array([len(x) for x in lists], np.int64))
            words.append(pa.array(list(chain.from_iterable(lists)), pa.large_string()))
        sizes.append(np.ones(len(self._matches), np.int64))
        words.append(pa.array(list(self._matches), pa.large_string()))
        places, words = coded(pa.concat_arrays(words))
        return np.concatenate(sizes), words, places

    def _add_matches(self, texts: list[str]) -> None:
        for text in texts:
            found = self._split.findall(text)
            self._codes.append(-1 - np.fromiter(map(self._matches.__getitem__, found), np.int32, len(found)))
            self._ends.append([len(found)])

    def _add_long(self, text: str, spaced: bool) -> None:
        """One document, in parts that end at spaces between two characters that are no white space."""
        if not spaced:
            self._codes.append(-1 - np.fromiter((self._matches[m.group()] for m in self._split.finditer(text)), np.int32))
            self._ends.append([len(self._codes[-1])])
            return
        before, start, cut = len(self._ends), 0, regex.compile(r"(?<=\S) (?=\S)")
        while start < len(text):
            found = cut.search(text, start + LONG_TEXT)
            end = found.start() if found else len(text)
            # the space of a later part comes back as the begin of its first chunk
            self._add(pa.array([text[start + (start > 0) : end]], pa.large_string()), np.array([start > 0]))
            start = end
        self._ends[before:] = [[int(sum(map(sum, self._ends[before:])))]]

    def _add(self, texts: pa.Array, later: np.ndarray) -> None:
        """Documents cut at spaces; ``later`` says of which a space was cut off before. Those with other white space beside one are split whole."""
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        codes, values = coded(lists.values.slice(offsets[0], offsets[-1] - offsets[0]))
        offsets -= offsets[0]
        size = pc.binary_length(values).to_numpy()
        starts = (pc.binary_length(pc.utf8_ltrim_whitespace(values)).to_numpy() < size) | (size == 0)
        stops = (pc.binary_length(pc.utf8_rtrim_whitespace(values)).to_numpy() < size) | (size == 0)
        opens, closes = starts[codes], stops[codes]
        first, last = offsets[:-1], offsets[1:] - 1
        empty = size[codes[first]] == 0
        opens[first[~later]] = closes[last] = False
        odd, rows = empty, rows_of(offsets)
        odd[rows[opens | closes]] = True
        # a distinct chunk is a value with a space before it, or at the begin of a text
        kinds = codes
        kinds[first[~later]] += len(values)
        sizes = np.where(odd, 0, np.diff(offsets))
        if odd.any():
            kinds = kinds[~odd[rows]]
        used = np.zeros(2 * len(values), bool)
        used[kinds] = True
        loose = np.concatenate([stops, np.ones(len(values), bool)])
        tidy, others = np.flatnonzero(used & ~loose), np.flatnonzero(used & loose)
        letters = pc.match_substring_regex(values.take(pa.array(tidy)), _LETTERS).to_numpy(zero_copy_only=False)
        tidy, n_plain = np.concatenate([tidy[letters], tidy[~letters]]), int(letters.sum())
        numbers = np.zeros(2 * len(values), np.int32)
        numbers[tidy], numbers[others] = np.arange(len(tidy)), np.arange(len(tidy), len(tidy) + len(others))
        text_of = values.take(pa.array(others % len(values))).to_pylist()
        values_of = values.take(pa.array(tidy))
        self._values.append((values_of.slice(0, n_plain), values_of.slice(n_plain), [" " * (k < len(values)) + t for k, t in zip(others.tolist(), text_of)]))
        numbers = self._n_values + numbers[kinds]
        self._n_values += len(tidy) + len(others)
        ends, done = np.cumsum(sizes), 0
        for i in [*np.flatnonzero(odd).tolist(), len(texts)]:
            self._codes.append(numbers[ends[done - 1] if done else 0 : ends[i - 1] if i else 0])
            self._ends.append(sizes[done:i])
            if i < len(texts):
                self._add_matches([" " * int(later[i]) + texts[i].as_py()])
            done = i + 1


def _arrow_type(source: DataFrame) -> pa.DataType:
    return source.select("doc_id").limit(0).toArrow().schema.field(0).type


def _block_row(number: int, bucket: int, doc_ids, kind: pa.DataType, ends: bytes, sizes: bytes, data: bytes) -> pa.RecordBatch:
    lists = pa.nulls(1, pa.list_(kind)) if doc_ids is None else pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids.cast(kind))
    rest = [pa.array([x], pa.binary()) for x in (ends, sizes, data)]
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([bucket], pa.int32()), lists, *rest], names=["block", "bucket", "doc_ids", "ends", "sizes", "data"])


def _lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and values of an array of lists."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return np.diff(offsets), lists.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)


def _runs(sizes: np.ndarray, chosen: np.ndarray, begin: np.ndarray | None = None) -> np.ndarray:
    """Places of the values of the chosen lists, one after another; lists follow one another if no begins are given."""
    begin, own = np.cumsum(sizes) - sizes if begin is None else begin, sizes[chosen]
    return np.arange(own.sum()) + np.repeat(begin[chosen] - (np.cumsum(own) - own), own)


def _strings(sizes: bytes, data: bytes) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(_sizes(sizes))]).astype(np.int32)
    raw = pa.decompress(data, int(offsets[-1]), codec="zstd")
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), raw)


def _joined(pieces: pa.Array, offsets: np.ndarray) -> pa.Array:
    """The pieces between the offsets, concatenated."""
    if not len(pieces):
        return pa.array([b""] * (len(offsets) - 1), pa.binary())
    ends = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset : pieces.offset + len(pieces) + 1][offsets].astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pieces.buffers()[2]])


def _small(sizes: np.ndarray) -> bytes:
    """Sizes as bytes; those of 255 and more after them, as longs."""
    large = sizes >= 255
    return np.minimum(sizes, 255).astype(np.uint8).tobytes() + sizes[large].astype(np.int64).tobytes() + int(large.sum()).to_bytes(8, "little")


def _sizes(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[-8:], "little")
    small = np.frombuffer(data[: len(data) - 8 - 8 * n], np.uint8).astype(np.int64)
    small[small == 255] = np.frombuffer(data[len(data) - 8 - 8 * n : -8], np.int64)
    return small


def decoded(ids: Column, ranks_path: str) -> Column:
    """The bytes of an array of token ids."""
    pieces = sorted(read_ranks(ranks_path).items(), key=lambda x: x[1])
    if [rank for _, rank in pieces] != list(range(len(pieces))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    table = _literal([piece.hex() for piece, _ in pieces])
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
