"""Merkle manifest: a digest of every row, one per source, one of all, and a proof for every row.

Leaves. A row's leaf is the SHA-256 of its fields, each written as its byte count and value, so no two
different rows are written alike. Digests go into other digests as lower-case hexadecimal text and are
kept as 32 bytes otherwise.

Trees. The leaves of a source stand in order of their ids; each ``ARITY`` neighbours become their digest, and
so on until one node is left, the source's subroot. The subroots become the root in the same way. Places come
from range partitions and their offsets, so no source is ordered in one task. A level has
a third of the rows of the one below and groups at most three of them.

Proofs. Every node starts with the segment to its parent: the digests left and right of it. Then
pointers jump: a self-join of nodes with the nodes they point to concatenates their segments and
doubles the distance, so after log2(height) joins all reach the top. After a join over distance d only nodes at
every 2d-th level are pointed to by the rest, so only those are kept. Leaves stay in their runs of three and
make the last jump, from the parent they share.

Edge cases: a NULL field is written as ``-``; empty text has a count of 0. A NULL source is a source of its own,
the first; NULL ids come first. Rows that repeat an id are ordered by their digests; equal rows all get leaves. A lone
leaf is its own subroot, a lone source's subroot the root, and their proofs have no steps. An empty table has no
rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from martloom.llm.common import staged
from martloom.operators.placement import place, with_offsets

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Highest level whose width still fits a long.
_LEVELS = 39


def field_text(value: Column) -> Column:
    """A field as its byte count, a colon and its text; ``-`` for NULL."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: str | Column) -> Column:
    """The leaf (hexadecimal) of a row with these fields."""
    columns = [F.col(f) if isinstance(f, str) else f for f in fields]
    return F.sha2(F.concat(*[field_text(c) for c in columns]), 256)


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def folded(leaf: Column, proof: Column) -> Column:
    """The root (hexadecimal) that a leaf has by a proof."""
    return F.aggregate(
        proof, leaf, lambda done, step: F.sha2(F.concat(hex_text(step["left"]), done, hex_text(step["right"])), 256)
    )


def proof_text(proof: Column) -> Column:
    """The digests of a proof in hexadecimal, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: hex_text(F.concat(step["left"], step["right"]))), "")


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with ``rank``, their place in ``order`` from 0."""
    placed = with_offsets(place(rows, order), {"rows": F.count("*")})
    return placed.withColumn("rank", F.col("rows_before") + F.col("_row")).drop("_part", "_row", "rows_before", "rows_total")


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return sum((F.when(F.lit(ARITY**i) < n, 1).otherwise(0) for i in range(_LEVELS)), F.lit(0)).cast("int")


def _runs(nodes: DataFrame, level: int, payload: list[str]) -> DataFrame:
    """Runs of ``ARITY`` neighbours: their ``kids`` in order and the ``digest`` these make together."""
    kid = F.struct("index", "digest", *payload)
    grouped = nodes.where(F.col("height") > level).groupBy("tree", "height", F.expr(f"index div {ARITY}").alias("run"))
    runs = grouped.agg(F.sort_array(F.collect_list(kid)).alias("kids"))  # at most ARITY rows
    text = F.array_join(F.transform("kids", lambda k: hex_text(k["digest"])), "")
    return staged(runs.select("tree", "height", F.lit(level).alias("level"), "run", "kids", F.unhex(F.sha2(text, 256)).alias("digest")))


def _steps(place: Column, kids: Column) -> Column:
    """The segment from one of a run's kids to their parent."""

    def digests(first: int, wanted) -> Column:
        parts = [F.when(wanted(place, j), F.get(kids, F.lit(j))["digest"]) for j in range(first, first + ARITY - 1)]
        return F.concat(*[F.coalesce(p, F.expr("X''")) for p in parts])

    left, right = digests(0, lambda p, j: F.lit(j) < p), digests(1, lambda p, j: F.lit(j) > p)
    return F.array(F.struct(left.alias("left"), right.alias("right")))


def _jumped(nodes: DataFrame, height: int) -> DataFrame:
    """The nodes of level 1 with segments that reach the top of their tree."""
    distance = 1
    while distance < height - 1:
        stands = (F.col("level") - 1) % (2 * distance)
        lower = nodes.where(stands == 0)
        upper = nodes.where(stands == distance).select(
            "tree", (F.col("level") - distance).alias("level"), F.col("index").alias("ancestor"), F.col("proof").alias("more")
        )
        lower = lower.withColumn("ancestor", F.expr(f"index div {ARITY**distance}"))
        both = lower.join(upper, ["tree", "level", "ancestor"], "left")
        longer = F.when(F.col("more").isNull(), F.col("proof")).otherwise(F.concat("proof", "more"))
        nodes = staged(both.select("tree", "level", "index", longer.alias("proof")))
        distance *= 2
    return nodes.where("level = 1")


def _proved(leaves: DataFrame, payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """Leaves (tree, height, index, digest, payload) with ``proof`` up to the top of their tree, and the tops (tree, top)."""
    height = leaves.agg(F.coalesce(F.max("height"), F.lit(0))).first()[0]
    none = F.array().cast("array<struct<left: binary, right: binary>>")
    lone = leaves.where("height = 0")
    proved = lone.select("tree", "digest", none.alias("proof"), *payload)
    tops = lone.select("tree", F.col("digest").alias("top"))
    if not height:
        return proved, tops
    levels = [_runs(leaves, 0, payload)]
    for level in range(1, height):
        below = levels[-1].select("tree", "height", F.col("run").alias("index"), "digest")
        levels.append(_runs(below, level, []))
    nodes = None
    for level, runs in enumerate(levels):
        tops = tops.union(runs.where(F.col("height") == level + 1).select("tree", F.col("digest").alias("top")))
        if level:
            one = runs.select("tree", "level", "kids", F.posexplode("kids").alias("at", "kid"))
            one = one.select("tree", "level", F.col("kid.index").alias("index"), _steps(F.col("at"), F.col("kids")).alias("proof"))
            nodes = one if nodes is None else nodes.union(one)
    runs = levels[0].select("tree", "run", "kids")
    if nodes is None:
        runs = runs.withColumn("above", none)
    else:
        above = _jumped(nodes, height).select("tree", F.col("index").alias("run"), F.col("proof").alias("above"))
        runs = runs.join(above, ["tree", "run"], "left")
    kids = runs.select("tree", "kids", "above", F.posexplode("kids").alias("at", "kid"))
    steps = F.concat(_steps(F.col("at"), F.col("kids")), F.coalesce("above", none))
    rows = kids.select("tree", F.col("kid.digest").alias("digest"), steps.alias("proof"), *[F.col(f"kid.{p}").alias(p) for p in payload])
    return proved.union(rows), tops


def manifest(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    source_col: str = "source",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row: id, source, leaf, subroot, root (hexadecimal), and proof, an array of (left, right) up to the root.

    ``carry`` are columns to be worked out in the same scan and kept (``{name: column}``).
    """
    carry = carry or {}
    kept = [f"carry_{i}" for i in range(len(carry))]
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.unhex(leaf_of(*fields)).alias("digest"),
        *[c.alias(k) for k, c in zip(kept, carry.values())],
        F.monotonically_increasing_id().alias("copy"),
    )
    order = [F.col("source").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("digest").asc(), F.col("copy").asc()]
    ranked = _numbered(staged(rows), order)
    trees = ranked.groupBy("source").agg(F.min("rank").alias("tree"), F.count("*").alias("n"))
    trees = staged(trees.select(F.col("source").alias("_source"), "tree", _height(F.col("n")).alias("height")))
    placed = ranked.join(trees, F.col("source").eqNullSafe(F.col("_source")))
    payload = ["id", *kept]
    leaves = staged(placed.select("tree", "height", (F.col("rank") - F.col("tree")).alias("index"), "digest", *payload))
    proved, tops = _proved(leaves, payload)

    # the subroots are the leaves of one more tree, in the order of their sources
    roots = _numbered(staged(tops), [F.col("tree").asc()])
    n = trees.count()
    height = 0
    while ARITY**height < n:
        height += 1
    roots = roots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(height).alias("height"), F.col("rank").alias("index"), F.col("top").alias("digest"), F.col("tree").alias("of")
    )
    upper, root = _proved(staged(roots), ["of"])
    sources = upper.select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), F.col("proof").alias("above"))
    sources = staged(sources.join(trees.drop("height"), "tree"))
    top = root.first()
    joined = proved.join(sources, "tree")
    return joined.select(
        F.col("id").alias(id_col),
        F.col("_source").alias(source_col),
        hex_text(F.col("digest")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        F.lit(top.top.hex() if top else None).cast("string").alias("root"),
        F.concat("proof", "above").alias("proof"),
        *[F.col(k).alias(name) for k, name in zip(kept, carry)],
    )
