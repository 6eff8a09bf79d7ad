"""The operators as registered queries, each over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, conversations, decontaminate, digests, embeddings, hmm, jaccard, langid, licences, merkle, pii, quality, substrings
from martloom.llm.common import crc_mod, staged, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def _span_text(spans):
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def _count_of(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


# A-Z to a-z, as the contracts lower-case.
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every node's least reachable node, over links (a, b) in both directions.
_REACHED = """
    reach AS (SELECT id, id AS root FROM nodes UNION SELECT l.a, r.root FROM links l JOIN reach r ON r.id = l.b),
    components AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
"""


@query("op4_licences")
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [_count_of(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id", *counts, F.sha2(_span_text(base), 256).alias("base_sha256"), _span_text(F.col("spans")).alias("spans")
    )


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    stats = staged(quality.with_statistics(docs))
    learn = crc_mod("doc_id", 5) != 0
    model = quality.fit(stats.where(learn), labels.where(learn))
    return quality.score(stats, model).select(
        "doc_id",
        (crc_mod("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decode=True)
    text = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(text, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op1_langid")
def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(crc_mod("doc_id", 4) != 2), public_tokenizers.path("piece_bpe_32k.model"))
    predicted = langid.predict(docs, model)
    return predicted.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query("op2_decontaminate")
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_lm_score")
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn = docs.where(crc_mod("doc_id", 5) != 1)
    counts = hmm.count_words(learn)
    scored = hmm.score(docs, counts, hmm.fit(learn, counts))
    return scored.select(
        "doc_id",
        (crc_mod("doc_id", 5) == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(counts.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


@query(
    "op8_jaccard",
    """
    WITH RECURSIVE
    words AS (SELECT doc_id AS id, list_filter(regexp_split_to_array("""
    + _LOWERED
    + """, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
    nodes AS (
      SELECT id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words
    ),
    shingles AS (SELECT id, len(s) AS n, unnest(s) AS s FROM nodes),
    links AS (
      SELECT x.id AS a, y.id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id
      GROUP BY x.id, y.id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
    ),
    """
    + _REACHED
    + """
    SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM nodes JOIN components USING (id)
    """,
)
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query(
    "op5_substrings",
    """
    WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    parts AS (
      SELECT doc_id, k * 1000 AS base, substr(h, k * 2000 + 1, 2098) AS part
      FROM (SELECT doc_id, h, unnest(range(CAST(ceil(length(h) / 2000) AS BIGINT))) AS k FROM bytes)
    ),
    starts AS (
      SELECT doc_id, base + j AS i, substr(part, 2 * j + 1, 100) AS seen
      FROM (SELECT doc_id, base, part, unnest(range(greatest(0, least(1000, length(part) // 2 - 49)))) AS j FROM parts)
    ),
    covered AS (SELECT doc_id, i FROM starts QUALIFY doc_id > min(doc_id) OVER (PARTITION BY seen)),
    runs AS (
      SELECT doc_id, min(i) AS s, max(i) + 50 AS e
      FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
            FROM (SELECT doc_id, i, CASE WHEN i - lag(i, 1, -100) OVER (PARTITION BY doc_id ORDER BY i) > 50 THEN 1 ELSE 0 END AS new FROM covered))
      GROUP BY doc_id, run
    ),
    edges AS (
      SELECT doc_id, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS a, s AS b FROM runs
      UNION ALL SELECT b.doc_id, coalesce(max(e), 0), any_value(length(h)) // 2 FROM bytes b LEFT JOIN runs r USING (doc_id) GROUP BY b.doc_id
    ),
    kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM edges JOIN bytes USING (doc_id) GROUP BY doc_id)
    SELECT b.doc_id, CAST(length(b.h) // 2 AS BIGINT) AS n_bytes, CAST((length(b.h) - length(k.h)) // 2 AS BIGINT) AS n_removed,
      (SELECT count(*) FROM runs r WHERE r.doc_id = b.doc_id) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
    FROM bytes b JOIN kept k USING (doc_id)
    """,
)
def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = substrings.find(docs).select(
        "doc_id",
        "text_hash",
        F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long").alias("removed"),
        F.size("spans").cast("long").alias("spans"),
        F.sha2("left", 256).alias("left_sha256"),
    )
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole_sha256"),
    )
    joined = rows.join(found.dropDuplicates(["doc_id", "text_hash"]), ["doc_id", "text_hash"], "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("left_sha256", "whole_sha256").alias("kept_sha256"),
    )


@query(
    "op7_embeddings",
    """
    WITH RECURSIVE
    nodes AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    sound AS (
      SELECT id, v, sqrt(list_dot_product(v, v)) AS norm FROM nodes
      WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0
    ),
    links AS (SELECT a.id AS a, b.id AS b FROM sound a JOIN sound b ON a.id <> b.id AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
    """
    + _REACHED
    + """
    SELECT id AS vec_id, (SELECT count(DISTINCT b) FROM links WHERE a = n.id) AS n_links, component_id, id = component_id AS kept
    FROM nodes n JOIN components USING (id)
    """,
)
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


# crc32 as DuckDB text: the table from its rule (0xEDB88320), then a fold over the bytes of a short ASCII text.
_CRC_TABLE = """(SELECT list(v ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)))"""


@query(
    "op13_merkle",
    """
    WITH RECURSIVE
    crc AS MATERIALIZED (SELECT """
    + _CRC_TABLE
    + """ AS v),
    fields AS (
      SELECT doc_id, source, d.text AS text,
        coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
        replace(d.text, chr(10), '') AS cut,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
          lambda c, x: xor(c >> 8, v[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) % 2 = 0 AS even
      FROM documents d, crc
    ),
    leaves AS (
      SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        sha256(head || CASE WHEN text IS NULL THEN '-' WHEN even THEN strlen(cut) || ':' || cut ELSE strlen(text) || ':' || text END) AS seen
      FROM fields
    ),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
      FROM leaves
    ),
    nodes AS (
      SELECT source, 0 AS level, i, n, leaf AS h FROM placed
      UNION ALL
      SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
      FROM nodes WHERE n > 1 GROUP BY source, level, i // 3, n
    ),
    tops AS (
      SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
    ),
    upper AS (
      SELECT 0 AS level, i, n, subroot AS h FROM tops
      UNION ALL
      SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM upper WHERE n > 1 GROUP BY level, i // 3, n
    ),
    steps AS (
      SELECT a.source, a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
      FROM nodes a JOIN nodes b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.i // 3 = b.i // 3
      WHERE a.n > 1 GROUP BY ALL
    ),
    upper_steps AS (
      SELECT a.level, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
      FROM upper a JOIN upper b ON a.level = b.level AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY ALL
    ),
    paths AS (
      SELECT source, i AS of, 0 AS level, i, '' AS proof, seen AS f FROM placed
      UNION ALL
      SELECT p.source, p.of, p.level + 1, p.i // 3, proof || l || r, sha256(l || f || r)
      FROM paths p JOIN steps s ON p.source IS NOT DISTINCT FROM s.source AND p.level = s.level AND p.i = s.i
    ),
    ends AS (
      SELECT * FROM paths QUALIFY row_number() OVER (PARTITION BY source, of ORDER BY level DESC) = 1
    ),
    more AS (
      SELECT e.source, e.of, 0 AS level, t.i, e.proof, e.f FROM ends e JOIN tops t ON e.source IS NOT DISTINCT FROM t.source
      UNION ALL
      SELECT m.source, m.of, m.level + 1, m.i // 3, proof || l || r, sha256(l || f || r)
      FROM more m JOIN upper_steps s ON m.level = s.level AND m.i = s.i
    ),
    done AS (
      SELECT * FROM more QUALIFY row_number() OVER (PARTITION BY source, of ORDER BY level DESC) = 1
    )
    SELECT p.doc_id, p.leaf, t.subroot, u.h AS root, sha256(d.proof) AS proof_sha256, d.f AS folded_root, d.f = u.h AS verified
    FROM placed p JOIN done d ON p.source IS NOT DISTINCT FROM d.source AND p.i = d.of
    JOIN tops t ON p.source IS NOT DISTINCT FROM t.source JOIN upper u ON u.n = 1
    """,
)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(
        F.col("doc_id").isNotNull() & (crc_mod("doc_id", 2) == 0), F.replace("text", F.lit("\n"), F.lit(""))
    ).otherwise(F.col("text"))
    seen = merkle.leaf_of("doc_id", "source", "lang", "n_chars", tampered)
    found = merkle.manifest(table(spark, sf_dir, "documents"), carry={"seen": F.unhex(seen)})
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"),
        merkle.folded(merkle.hex_text(F.col("seen")), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op12_fingerprints")
def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digests.with_next(docs, digests.rarity(docs))


# The repair as a recursion over rows: for each state the least key, the cost in eight digits and the audit. NULL: no way there.


def _grown(key: str, cost: str, letter: str) -> str:
    return f"lpad(CAST(CAST(left({key}, 8) AS INT) + {cost} AS VARCHAR), 8, '0') || substr({key}, 9) || '{letter}'"


def _with_insertions(keys: list[str]) -> list[str]:
    """Keys of the four states when turns may be added: from 0, 1, 3 to 2, and from 2 to 3, twice round at most."""
    zero, one, two, three = keys
    user = f"least({two}, {_grown(zero, '2', 'I')}, {_grown(one, '2', 'I')}, {_grown(three, '2', 'I')})"
    assistant = f"least({three}, {_grown(two, '2', 'I')}, {_grown(_grown(zero, '2', 'I'), '2', 'I')}, {_grown(_grown(one, '2', 'I'), '2', 'I')})"
    return [zero, one, user, assistant]


def _repair_sql() -> str:
    keys = [f"k{q}" for q in range(4)]
    grown = _with_insertions(keys)
    deleted = [_grown(f"i{q}", "3", "D") for q in range(4)]
    keep = lambda q, to: f"CASE WHEN initial = '{to}' THEN {_grown(f'i{q}', 'late', 'K')} END"
    role = lambda q: _grown(f"i{q}", "2 + late", "R")
    user = ", ".join(f"{keep(q, 'u')}, {role(q)}" for q in (0, 1, 3))
    steps = [
        deleted[0],
        f"CASE WHEN forced THEN {deleted[1]} ELSE least({deleted[1]}, {keep(0, 's')}) END",
        f"CASE WHEN forced THEN {deleted[2]} ELSE least({deleted[2]}, {user}) END",
        f"CASE WHEN forced THEN {deleted[3]} ELSE least({deleted[3]}, {keep(2, 'a')}, {role(2)}) END",
    ]
    inserted = ", ".join(f"{g} AS i{q}" for q, g in enumerate(grown))
    return f"""
    WITH RECURSIVE
    crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS v),
    hit AS (
      SELECT c.*, xor(list_reduce(list_prepend(4294967295, list_transform(
          string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT))),
          lambda c, x: xor(c >> 8, v[CAST(xor(c, x) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS kind
      FROM conversations c, crc
    ),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
      FROM hit, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
    ),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i, left(role, 1) AS initial,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut
      FROM damaged
    ),
    judged AS (
      SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal,
        CASE WHEN cut = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
          WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
      FROM placed
    ),
    edits AS (
      SELECT conv_id, i, initial, coalesce(fault IN ('blank', 'duplicate'), FALSE) AS forced, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS late FROM judged
    ),
    walk AS (
      SELECT conv_id, 0 AS i, {", ".join(("'00000000'" if q == 0 else "CAST(NULL AS VARCHAR)") + f" AS k{q}" for q in range(4))}
      FROM (SELECT DISTINCT conv_id FROM conversations)
      UNION ALL
      SELECT conv_id, i, {", ".join(f"{s} AS k{q}" for q, s in enumerate(steps))}
      FROM (SELECT w.conv_id, e.i, initial, forced, late, {inserted}
            FROM walk w JOIN edits e ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = w.i + 1)
    ),
    goals AS (
      SELECT conv_id, least(i0, i3) AS k FROM (SELECT conv_id, {inserted} FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)
    ),
    letters AS (
      SELECT conv_id, j, substr(k, 8 + j, 1) AS letter FROM (SELECT conv_id, k, unnest(range(1, length(k) - 7)) AS j FROM goals)
    ),
    kept AS (
      SELECT conv_id, letter, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total, of
      FROM (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS of, j AS place FROM letters)
      WHERE letter <> 'D' WINDOW w AS (PARTITION BY conv_id ORDER BY place)
    ),
    outcome AS (
      SELECT t.conv_id, string_agg(
        CASE WHEN letter = 'K' THEN role WHEN (n + total) % 2 = 0 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY n) AS whole
      FROM kept t LEFT JOIN placed p ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.of = p.i AND letter <> 'I' GROUP BY 1
    ),
    counted AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
      FROM judged GROUP BY 1
    )
    SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(left(k, 8) AS BIGINT) AS cost, substr(k, 9) AS audit,
      sha256(coalesce(whole, '')) AS repaired_sha256
    FROM goals g LEFT JOIN counted c ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN outcome o ON g.conv_id IS NOT DISTINCT FROM o.conv_id
    """


def _damaged(rows: DataFrame) -> DataFrame:
    """The faults that the contract plants, by the checksum of conversation and turn."""
    names = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, kind = F.coalesce("text", F.lit(" ")), F.col("_kind")
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    hit = rows.select("conv_id", "turn", F.col("role"), text.alias("text"), (F.crc32(names) % 20).alias("_kind"))
    hit = hit.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies)))
    return hit.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
    )


@query("op11_conversations", _repair_sql())
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversations.repair(_damaged(rows)).withColumnRenamed("conv_id", "_conv")
    every = rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    text = F.coalesce(conversations.repaired_text(F.col("repaired")), F.lit(""))
    return every.select(
        "conv_id",
        *numbers,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(text, 256)).alias("repaired_sha256"),
    )
