"""Language identification: unigram pieces per language, all segmentations summed.

The pieces are those of a fixed public vocabulary. Every language has a
probability for each piece; the probability of a word is the sum over all ways to
cut it into pieces of any length, by a forward recursion along its characters. A text's
log probability is the sum over its words (between white space, lower-cased, with
a start mark), and the languages' posterior under equal priors gives the score.

Fit: expectation-maximisation with expected piece counts added up over tasks,
on about ``sample`` documents per language, picked by a hash of their id. That bound is the
fit's only one: every text is scored whole, and each distinct word of a slice once.

Edge cases: a NULL text or one without letters is ``und`` with score 0, as is
every text if nothing could be learned. Characters outside the vocabulary have
a small probability, the same in all languages. Ties go to the name that sorts
first. Repeated rows and ids are scored row by row; NULL ids are kept. Extra
columns are ignored. Words over ``FIT_RUN`` characters are cut into runs of so many for the fit, never for the scoring.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import coded, map_texts, rows_of, staged, words_of

UNDETERMINED = "und"
START = "▁"
FIT_RUN = 1024
# Characters whose segmentations the fit holds at once.
FIT_CELLS = 400_000
_UNKNOWN = 1e-7
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD1342543DE82EF95)
_BITS = np.uint64(44)


@dataclass
class Pieces:
    """Hash table of the vocabulary: two positions per piece, the second only where the first is taken."""

    hashes: np.ndarray
    first: np.ndarray
    second: np.ndarray
    longest: int

    @classmethod
    def of(cls, pieces: list[str]) -> Pieces:
        hashes = np.array([_hash(p) for p in pieces], np.uint64)
        first, second = np.full(1 << 20, -1, np.int32), np.full(1 << 20, -1, np.int32)
        for i, h in enumerate(hashes):
            at = int(h >> _BITS)
            if first[at] < 0:
                first[at] = i
            else:
                with np.errstate(over="ignore"):
                    at = int((h * _ODD) >> _BITS)
                if second[at] >= 0:
                    raise ValueError("two pieces share both places")
                second[at] = i
        return cls(hashes, first, second, max(map(len, pieces), default=1))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece with each hash, or -1."""
        at = self.first[h >> _BITS]
        right = (at >= 0) & (self.hashes[at] == h)
        other = self.second[(h * _ODD) >> _BITS]
        also = (other >= 0) & (self.hashes[other] == h)
        return np.where(right, at, np.where(also, other, -1))


def _hash(piece: str) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in piece:
            h = h * _BASE + (np.uint64(ord(c)) * _ODD + np.uint64(1))
    return h


@dataclass
class Model:
    languages: list[str]
    pieces: Pieces
    probabilities: np.ndarray  # languages x pieces

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, words x languages."""
        out = np.zeros((len(words), len(self.languages)))
        for chosen, points, sizes in _by_length(words):
            out[chosen] = self._forward(points, sizes)
        return out

    def _forward(self, points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        n = len(points)
        out = np.zeros((n, len(self.languages)))
        scale = np.zeros(n)
        alphas = deque([np.ones((len(self.languages), n))], maxlen=self.pieces.longest)
        for t, ids in enumerate(_piece_ids(points, self.pieces), 1):
            alpha = np.zeros((len(self.languages), n))
            for k, found in enumerate(ids, 1):
                before = alphas[-k]
                if k == 1:
                    p = np.where(found >= 0, self.probabilities[:, found], _UNKNOWN)
                    alpha += before * p
                else:
                    at = np.flatnonzero(found >= 0)
                    if len(at):
                        alpha[:, at] += before[:, at] * self.probabilities[:, found[at]]
            alphas.append(alpha)
            if t % 16 == 0:
                most = alpha.max(axis=0)
                for a in alphas:
                    a /= most
                scale += np.log(most)
            ended = np.flatnonzero(sizes == t)
            if len(ended):
                out[ended] = (np.log(np.maximum(alpha[:, ended], 1e-300)) + scale[ended]).T
        return out


def _by_length(words: list[str], rows: int = 20_000, cells: int = 4_000_000):
    """(places, code points, lengths) of words in groups of like length, each with the start mark."""
    sizes = np.array([len(w) + 1 for w in words])
    padded = np.where(sizes <= 32, sizes, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(int))
    order = np.argsort(padded, kind="stable")
    start = 0
    while start < len(order):
        length = padded[order[start]]
        limit = max(1, min(rows, cells // int(length)))
        end = start + min(limit, int(np.searchsorted(padded[order[start:]], length, side="right")))
        chosen = order[start:end]
        text = "".join((START + words[i]).ljust(length, "\0") for i in chosen)
        yield chosen, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length), sizes[chosen]
        start = end


def _piece_ids(points: np.ndarray, pieces: Pieces):
    """For each position, the pieces of 1, 2, ... characters that end there."""
    hashes: list[np.ndarray] = []
    for t in range(points.shape[1]):
        c = points[:, t].astype(np.uint64) * _ODD + np.uint64(1)
        hashes = [c, *(h * _BASE + c for h in hashes[: pieces.longest - 1])]
        yield [pieces.find(h) for h in hashes]


def vocabulary(model_path: str) -> list[str]:
    """The lower-case pieces of a sentencepiece model."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()) if not _special(processor, i))
    return sorted({p for p in pieces if p == p.lower()})


def _special(processor, i: int) -> bool:
    return processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)


def expected_counts(words: list[str], weights: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in weighted words of one language, over all their segmentations."""
    counts = np.zeros(len(p))
    for chosen, points, sizes in _by_length(words, cells=FIT_CELLS):
        for length in np.unique(sizes):
            own = np.flatnonzero(sizes == length)
            back = [np.ones(len(own))]  # the forward sum up to k characters back, over that up to one back
            ids, shares = [], []
            for found in _piece_ids(points[own][:, :length], pieces):
                use = [np.where(f >= 0, p[f], _UNKNOWN if k == 0 else 0.0) * back[k] for k, f in enumerate(found)]
                step = sum(use)
                ids.append(found)
                shares.append([u / step for u in use])  # of the ways to get here, by the length of the last piece
                back = [np.ones(len(own)), *(b / step for b in back[: pieces.longest - 1])]
            reached = [np.zeros(len(own)) for _ in range(length)] + [weights[chosen[own]].astype(float)]
            for t in range(length, 0, -1):
                for k, (f, share) in enumerate(zip(ids[t - 1], shares[t - 1]), 1):
                    use = share * reached[t]
                    reached[t - k] += use
                    at = np.flatnonzero(f >= 0)
                    np.add.at(counts, f[at], use[at])
    return counts


def fit(docs: DataFrame, model_path: str, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample: int = 1500, rounds: int = 4) -> Model:
    """Fit on documents with a language, about ``sample`` of each."""
    names = vocabulary(model_path)
    pieces = Pieces.of(names)
    known = docs.where(F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(F.col(lang_col)).count().collect()}  # one row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], pieces, np.zeros((0, len(names))))
    place = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000))
    share = F.create_map(*(F.lit(x) for lang in languages for x in (lang, min(1_000_000, sample * 1_000_000 // sizes[lang] + 1))))
    picked = known.where(place < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def tally(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, words = words_of(pc.utf8_lower(batch.column(1)), lower=False)
        lang = batch.column(0).take(pa.array(rows_of(offsets)))
        tallied = pa.table({"lang": lang, "word": words}).group_by(["lang", "word"]).aggregate([([], "count_all")])
        return pa.RecordBatch.from_arrays(
            [pa.array(tallied[c].combine_chunks().to_pylist(), t) for c, t in (("lang", pa.string()), ("word", pa.string()), ("count_all", pa.int64()))],
            names=["lang", "word", "n"],
        )

    tallies = map_texts(picked, "text", tally, "lang string, word string, n bigint")
    tallies = staged(tallies.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    sizes_of = np.array([len(x) for x in names])
    p = np.tile(0.02 ** np.minimum(sizes_of, 3) * 2.0 ** -np.maximum(sizes_of - 3, 0), (len(languages), 1))
    p /= p.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        added = tallies.mapInArrow(_counting(languages, pieces, p), "lang int, piece int, uses double")
        counts = np.zeros_like(p)
        for lang, piece, uses in added.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect():
            counts[lang, piece] = uses  # at most languages x vocabulary rows
        p = (counts + 0.02) / (counts + 0.02).sum(axis=1, keepdims=True)
    return Model(languages, pieces, p)


def _counting(languages: list[str], pieces: Pieces, p: np.ndarray):
    def run(batches):
        total = np.zeros_like(p)
        for batch in batches:
            lang = np.array([languages.index(x) for x in batch.column(0).to_pylist()], int)
            words, weights = batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
            for i in np.unique(lang):
                own = np.flatnonzero(lang == i)
                runs = [(words[j][a : a + FIT_RUN], weights[j]) for j in own for a in range(0, len(words[j]), FIT_RUN)]
                total[i] += expected_counts([r[0] for r in runs], np.array([r[1] for r in runs]), pieces, p[i])
        at, piece = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(total[at, piece])],
            names=["lang", "piece", "uses"],
        )

    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and log10 probability of the best language; a map."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    table = model.pieces
    plain = (model.languages, table.hashes, table.first, table.second, table.longest, model.probabilities)
    shared = docs.sparkSession.sparkContext.broadcast(plain)  # languages x vocabulary

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        languages, hashes, first, second, longest, probabilities = shared.value
        own, texts = Model(languages, Pieces(hashes, first, second, longest), probabilities), batch.column(1)
        n = len(own.languages)
        letters = np.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)
        names, scores, logs = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts)), np.zeros(len(texts))
        if n and letters.any():
            offsets, words = words_of(pc.utf8_lower(texts), lower=False)
            codes, distinct = coded(words)
            per_word = own.word_scores(distinct.to_pylist())
            rows = rows_of(offsets)
            total = np.column_stack([np.bincount(rows, per_word[codes, i], minlength=len(texts)) for i in range(n)])
            best = total.argmax(axis=1)
            top = total[np.arange(len(texts)), best]
            share = 1 / np.exp(np.maximum(total - top[:, None], -700)).sum(axis=1)
            names = np.where(letters, np.array(own.languages, object)[best], UNDETERMINED)
            scores, logs = np.where(letters, share, 0.0), np.where(letters, top / np.log(10), 0.0)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names.tolist(), pa.string()), pa.array(scores), pa.array(logs)],
            names=["doc_id", "lang_pred", "score", "log10_probability"],
        )

    return map_texts(source, "text", run, f"doc_id {kind}, lang_pred string, score double, log10_probability double")
