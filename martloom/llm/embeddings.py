"""Embedding near-duplicates: all pairs of cosine >= 0.9, by tiles in the order of principal components.

1. The second moments of the unit vectors, added up over tasks, give an orthogonal basis,
   ordered by variance. Cosines do not change in it, and the leading coordinates say most.
2. Vectors fall into the cells of a grid over the first ``GRID`` coordinates, as wide
   as the distance of two vectors that link; a large cell is dealt out to several tiles by a hash of the vector.
   Equal vectors meet in a tile and are one vector with a weight from there on. A vector is shuffled once, in its
   own width, and stored once, in its tile; tasks read both tiles of a pair from there.
3. A tile knows the least and greatest of its leading coordinates. Two tiles are compared only if these boxes are
   as near as vectors that link.
4. A product over the leading dimensions is short of the cosine by at most the product of the vectors' suffix norms. With
   the suffix norm as one more dimension, a product in single precision is a bound on the cosine, and pairs
   whose bound is below the threshold are dropped. What is left is decided on the original components in double precision.

Each pair of tiles returns link counts per vector and the edges of its local
components, never all links, so groups of copies stay linear.

Edge cases: vectors that are NULL, zero, empty, or hold NULL or non-finite components link with nothing and are their
own component. Vectors link only with vectors of the same length. Rows that repeat an id count as vectors of
their own; a component is named by its least id. NULL ids keep their row, with no links. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import release_memory, staged
from martloom.llm.components import components
from martloom.sinks.tables import _setting

THRESHOLD = 0.9
GRID = 3
# Leading coordinates of which a tile knows the least and greatest.
BOX = 16
# Vectors of a tile, and its bytes at most, counted as doubles.
TILE = 16384
TILE_BYTES = 8 << 20
BLOCK = 1024
# Bytes of tiles that a task reads of each side.
SIDE_BYTES = 32 << 20
_STEP = 8
# Part of the pairs that may be left to the decision in double precision.
_FEW = 1e-3
# Room for rounding in bounds; decisions are exact.
_SLACK = 1e-6
# Of a dimension of a product in single precision.
_SINGLE = 2e-7


def _vectors(column: pa.Array, kind: type) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and components, by length, of the rows that can link with something."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values
    missing = flat.is_null().to_numpy(zero_copy_only=False) if flat.null_count else np.zeros(len(flat), bool)
    x = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(kind, copy=False)
    totals = lambda flags: (lambda c: c[offsets[1:]] - c[offsets[:-1]])(np.append(0, np.cumsum(flags)))
    good = (totals(missing | ~np.isfinite(x)) == 0) & (totals(x != 0) > 0)
    if column.null_count:
        good &= column.is_valid().to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    found = []
    for d in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == d))
        found.append((rows, x[offsets[rows][:, None] + np.arange(d)] + kind(0)))
    return found


def _keys(x: np.ndarray) -> np.ndarray:
    """A hash of each vector."""
    raw, width = x.tobytes(), x.shape[1] * x.itemsize
    return np.frombuffer(b"".join(hashlib.blake2b(raw[i : i + width], digest_size=8).digest() for i in range(0, len(raw), width)), np.int64)


def _cells(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The grid cell of each vector; added up dimension by dimension, so that equal vectors never differ in it."""
    width = float(np.sqrt(2 - 2 * THRESHOLD)) + 1e-9
    largest = np.abs(x).max(axis=1).astype(float)  # squares of the components themselves may overflow
    norm, lead = np.zeros(len(x)), np.zeros((min(GRID, x.shape[1]), len(x)))
    for j, column in enumerate(np.ascontiguousarray(x.T)):
        part = column / largest
        norm += part * part
        for i in range(len(lead)):
            lead[i] += part * basis[j, i]
    cell = np.zeros(len(x), np.int64)
    for row in np.floor(lead / np.sqrt(norm) / width).astype(np.int64):
        cell = cell * 64 + row + 32
    return cell.astype(np.int32)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True).astype(float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _basis(vectors: DataFrame, kind: type) -> dict[int, np.ndarray]:
    """For each length, the eigenvectors of the second moments of unit vectors, largest first."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _vectors(batch.column(0), kind):
                unit = _unit(x)
                sums[x.shape[1]] = sums.get(x.shape[1], 0) + unit.T @ unit
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(list(s))], names=["d", "i", "v"])

    rows = vectors.select("vector").mapInArrow(moments, "d int, i int, v array<double>")
    exploded = rows.select("d", "i", F.posexplode("v").alias("j", "v")).groupBy("d", "i", "j").agg(F.sum("v").alias("v")).collect()  # d * d rows
    found = {}
    for d in {r.d for r in exploded}:
        m = np.zeros((d, d))
        for r in exploded:
            if r.d == d:
                m[r.i, r.j] = r.v
        found[d] = np.ascontiguousarray(np.linalg.eigh((m + m.T) / 2)[1][:, ::-1])
    return found


def _placed(vectors: DataFrame, basis: dict[int, np.ndarray], kind: type, id_type: str) -> DataFrame:
    """(vec_id, key, d, cell) of every row; the last three NULL if it can link with nothing."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((3, batch.num_rows), np.int64)
            none = np.ones(batch.num_rows, bool)
            for rows, x in _vectors(batch.column(1), kind):
                if x.shape[1] in basis:
                    found[:, rows], none[rows] = (_keys(x), np.full(len(x), x.shape[1]), _cells(x, basis[x.shape[1]])), False
            columns = [pa.array(v, pa.int64(), mask=none) for v in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), columns[0], *(c.cast(pa.int32()) for c in columns[1:])], names=["vec_id", "key", "d", "cell"])

    # the basis is that of the vectors with an id; without one a vector links with nothing
    return staged(vectors.select("vec_id", "vector").mapInArrow(place, f"vec_id {id_type}, key bigint, d int, cell int"))


def _tile_rows(d: int) -> int:
    return max(1, min(TILE, TILE_BYTES // (8 * d)))


def _tiles(vectors: DataFrame, basis: dict[int, np.ndarray], kind: type, tiles: dict[tuple[int, int], int]) -> DataFrame:
    """(d, tile, odd, low, high, head, raw): keys and weights, and vectors, of a tile; vectors are shuffled once."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _vectors(batch.column(0), kind):
                keys, first, weights = np.unique(_keys(x), return_index=True, return_counts=True)
                x, d = np.ascontiguousarray(x[first]), x.shape[1]
                cells = _cells(x, basis[d])
                parts = keys % np.array([tiles[d, c] for c in cells.tolist()], np.int64)
                raw = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(0, x.nbytes + 1, d * x.itemsize, dtype=np.int32)), pa.py_buffer(x)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), d, np.int32)), pa.array(cells), pa.array(parts.astype(np.int32)), pa.array(keys), pa.array(weights), raw],
                    names=["d", "cell", "part", "key", "weight", "raw"],
                )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = defaultdict(list)
        for batch in batches:
            d, cell, part, keys, weights = (batch.column(i).to_numpy() for i in range(5))
            names = np.stack([d, cell, part])
            order = np.lexsort(names)
            cuts = np.flatnonzero((np.diff(names[:, order]) != 0).any(axis=0)) + 1
            for rows in np.split(order, cuts) if len(order) else ():
                raw = batch.column(5).take(pa.array(rows))
                held[tuple(int(v) for v in names[:, rows[0]])].append((keys[rows], weights[rows], b"".join(raw.to_pylist())))
        for d, cell, part in list(held):
            keys, weights, raw = zip(*held.pop((d, cell, part)))
            keys, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, place.reshape(-1), np.concatenate(weights))
            x = np.frombuffer(b"".join(raw), kind).reshape(-1, d)[first]
            lead = np.pad(_unit(x) @ basis[d][:, :BOX], ((0, 0), (0, max(0, BOX - d))))
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([v], pa.int32()) for v in (d, cell, part)),
                    *(pa.array([v.tolist()], pa.list_(pa.float64())) for v in (lead.min(axis=0), lead.max(axis=0))),
                    pa.array([np.stack([keys, total], axis=1).tobytes()], pa.binary()),
                    pa.array([x.tobytes()], pa.binary()),
                ],
                names=["d", "cell", "part", "low", "high", "head", "raw"],
            )
        release_memory()

    dealt = vectors.select("vector").mapInArrow(deal, "d int, cell int, part int, key bigint, weight bigint, raw binary")
    dealt = dealt.repartition(max(1, sum(tiles.values())), "d", "cell", "part")
    packed = staged(dealt.mapInArrow(pack, "d int, cell int, part int, low array<double>, high array<double>, head binary, raw binary"))
    tile = F.struct("cell", "part")
    return packed.select("d", tile.alias("tile"), F.xxhash64("cell", "part").bitwiseAND(F.lit(1)).alias("odd"), "low", "high", "head", "raw")


def compare(a: np.ndarray, b: np.ndarray, basis: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in a and b of the pairs with cosine >= THRESHOLD, block by block; with ``same``, each pair once."""
    ya, yb = _unit(a) @ basis, _unit(b) @ basis
    k = _dimensions(ya, yb)
    xa, xb, least = _bounding(ya, k), _bounding(yb, k), np.float32(THRESHOLD - _SLACK - _SINGLE * (k + _STEP))
    na, nb = np.linalg.norm(a.astype(float), axis=1), np.linalg.norm(b.astype(float), axis=1)
    some = max(1, 3_200_000 // a.shape[1])
    bounds, flags = np.empty(BLOCK * BLOCK, np.float32), np.empty(BLOCK * BLOCK, bool)  # written again for each block
    for t in range(0, len(b), BLOCK):
        side = np.ascontiguousarray(xb[t : t + BLOCK].T)
        for s in range(0, min(len(a), t + BLOCK) if same else len(a), BLOCK):
            part = xa[s : s + BLOCK]
            n = len(part) * side.shape[1]
            np.dot(part, side, out=bounds[:n].reshape(len(part), -1))
            i, j = np.divmod(np.flatnonzero(np.greater_equal(bounds[:n], least, out=flags[:n])), side.shape[1])
            i, j = i + s, j + t
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                good = np.concatenate([_cosines(a, b, na, nb, i[n : n + some], j[n : n + some]) >= THRESHOLD for n in range(0, len(i), some)])
                if good.any():
                    yield i[good], j[good]


def _cosines(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a[i].astype(float), b[j].astype(float)) / (na[i] * nb[j])


def _bounding(y: np.ndarray, k: int) -> np.ndarray:
    """The first k coordinates and the norm of the others, in single precision: products are bounds on those of y."""
    rest = np.sqrt((y[:, k:] ** 2).sum(axis=1, keepdims=True))
    return np.concatenate([y[:, :k], rest], axis=1).astype(np.float32)


def _dimensions(ya: np.ndarray, yb: np.ndarray) -> int:
    """As many leading dimensions as leave few of some pairs besides those that link; the result is the same with any number."""
    a, b = (y[:: max(1, len(y) // 256)] for y in (ya, yb))
    left = lambda k: (_bounding(a, k) @ _bounding(b, k).T >= THRESHOLD).mean()
    d = ya.shape[1]
    few = left(d) + _FEW
    return next((k for k in range(_STEP, d, _STEP) if left(k) <= few), d)


def _forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The least place each of n vectors reaches by the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _linked(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray, basis: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Weighted links of each vector of a, then of b, and the least place it reaches; of a alone with ``same``.

    Links of a block become the edges of its components at once, so that dense tiles do not hold all their links.
    """
    n = len(a) if same else len(a) + len(b)
    counts, edges = np.zeros(n, np.int64), []
    for i, j in compare(a, b, basis, same):
        at = j if same else j + len(a)
        np.add.at(counts, i, wb[j])
        np.add.at(counts, at, wa[i])
        places, ends = np.unique(np.concatenate([i, at]), return_inverse=True)
        ends = ends.reshape(-1)
        edges.append(np.stack([places, places[_forest(ends[: len(i)], ends[len(i) :], len(places))]]))
    both = np.concatenate([np.zeros((2, 0), np.int64), *edges], axis=1)
    return counts, _forest(*both, n)


def _links(tiles: DataFrame, basis: dict[int, np.ndarray], kind: type, n_bytes: int) -> DataFrame:
    """(key, links, other): weighted links of a vector in a pair of tiles, and edges (key, other)."""
    spark = tiles.sparkSession
    # a task reads some tiles of either side from the shared folder, without a shuffle
    some = max(int(np.ceil((4 * spark.sparkContext.defaultParallelism) ** 0.5)), -(-n_bytes // SIDE_BYTES))
    a, b = (tiles.select("d", *(F.col(c).alias(f"{c}_{s}") for c in ("tile", "odd", "low", "high", "head", "raw"))).coalesce(some) for s in "ab")
    b = b.withColumnRenamed("d", "d_b").hint("shuffle_replicate_nl")
    apart = lambda low, high: F.zip_with(low, high, lambda x, y: x - y)
    gaps = F.zip_with(apart("low_a", "high_b"), apart("low_b", "high_a"), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    near = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x) <= 2 - 2 * THRESHOLD + _SLACK
    same = F.col("tile_a") == F.col("tile_b")
    # either order of two tiles is met, by different tasks; half of the pairs are taken in each
    once = same | ((F.col("tile_a") < F.col("tile_b")) == (F.col("odd_a") == F.col("odd_b")))
    pairs = a.join(b, (F.col("d") == F.col("d_b")) & once & near).select("d", same.alias("same"), "head_a", "raw_a", "head_b", "raw_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                d, same = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                (ka, wa), (kb, wb) = (np.frombuffer(batch.column(i)[row].as_buffer(), np.int64).reshape(-1, 2).T for i in (2, 4))
                a, b = (np.frombuffer(batch.column(i)[row].as_buffer(), kind).reshape(-1, d) for i in (3, 5))
                counts, root = _linked(a, b, wa, wb, basis[d], same)
                some = np.flatnonzero(counts)
                if len(some):
                    keys = ka if same else np.concatenate([ka, kb])
                    yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(counts[some]), pa.array(keys[root[some]])], names=["key", "links", "other"])
        release_memory()

    with _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):  # a row is a pair of tiles
        return staged(pairs.mapInArrow(run, "key bigint, links bigint, other bigint"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links and component_id of every vector."""
    source = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    kind = np.float32 if isinstance(source.schema["vector"].dataType.elementType, T.FloatType) else np.float64
    named_vectors = source.where(F.col("vec_id").isNotNull())
    basis = _basis(named_vectors, kind)
    rows = _placed(source, basis, kind, source.schema["vec_id"].dataType.simpleString())
    valid = rows.where(F.col("key").isNotNull() & F.col("vec_id").isNotNull())
    distinct = staged(valid.groupBy("key", "d", "cell").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first")))
    counts = {(r.d, r.cell): r["count"] for r in distinct.groupBy("d", "cell").count().collect()}  # at most some hundred cells a length
    tiles = {(d, cell): -(-n // _tile_rows(d)) for (d, cell), n in counts.items()}
    n_bytes = sum(n * d * np.dtype(kind).itemsize for (d, _), n in counts.items())
    found = _links(_tiles(named_vectors, basis, kind, tiles), basis, kind, n_bytes)
    roots = components(found.select(F.col("key").alias("a"), F.col("other").alias("b")))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    rooted = distinct.select("key", "weight", "first").join(links, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")
    rooted = staged(rooted.select("key", "first", F.coalesce("root", "key").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("key", "n_links", "component")
    joined = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")).join(named, "key", "left")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
