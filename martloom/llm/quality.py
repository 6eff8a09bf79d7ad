"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of the text. Its
covariance is shrunk towards its own diagonal and the pooled covariance;
the score is the difference of the two Mahalanobis log densities, taken with
Cholesky factors computed once, and put on a 0 to 1 scale by a logistic fit.

The fit sums (count, vector, outer product) per class in the tasks and adds
the sums up, then sums gradient and Hessian of each Newton step of the logistic
fit, so it takes every labelled row at any size. Scoring is a map.

Edge cases: NULL and empty texts have the statistics of a text of no words
and get a score like any other. Repeated doc_ids keep their rows. Labels
that are NULL, other than 0 or 1, or of unknown documents are left out;
repeated labels count once each. If a class has no labelled rows, the score
is the share of class 1 among the labels (0.5 without labels). Extra columns
are ignored by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import coded, counts_by_row, map_texts, rows_of, staged, text_bytes, words_of

# Text bytes whose statistics are made at once: running sums over them take 16 times as much.
SLICE = 1 << 20
STATISTICS = (
    "words",
    "word_length",
    "symbols",
    "upper",
    "digits",
    "distinct",
    "top_word",
    "symbol_words",
    "bars",
    "vowels",
    "lines",
    "repeated_lines",
)
THRESHOLD = 0.3


@dataclass
class Model:
    """Means, Cholesky factors and log determinants of class 0 and 1, and the logistic scale."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    slope: float
    offset: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * self.differences(x) + self.offset, -500, 500)
        return 1 / (1 + np.exp(-z))

    def differences(self, x: np.ndarray) -> np.ndarray:
        """Log density under class 1 minus that under class 0, damped so outliers stay finite."""
        if not len(self.means):
            return np.zeros(len(x))
        logs = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            solved = np.linalg.solve(factor, (x - mean).T)
            logs.append(-0.5 * (solved * solved).sum(axis=0) - 0.5 * log_det)
        return np.arcsinh(logs[1] - logs[0])


def _byte_class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars)] = 1
    return table


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics per text."""
    raw, offsets = text_bytes(texts)
    size = np.diff(offsets)
    letters = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
    share = {}
    for name, chars in (
        ("upper", bytes(range(65, 91))),
        ("digits", b"0123456789"),
        ("letters", letters),
        ("bars", b"|"),
        ("vowels", b"aeiouAEIOU"),
        ("symbols", bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,'-")),
        ("newlines", b"\n"),
    ):
        share[name] = counts_by_row(_byte_class(chars)[raw], offsets)
    word_offsets, words = words_of(texts)
    codes, vocabulary = coded(words)
    n = np.diff(word_offsets)
    rows = rows_of(word_offsets)
    pairs, times = np.unique(rows * max(len(vocabulary), 1) + codes, return_counts=True)
    pair_rows = pairs // max(len(vocabulary), 1)
    distinct = np.bincount(pair_rows, minlength=len(size))
    top = np.zeros(len(size))
    np.maximum.at(top, pair_rows, times)
    odd = pc.match_substring_regex(vocabulary, r"[^A-Za-z0-9\x80-\x{10FFFF}.,'-]$") if len(vocabulary) else pa.array([], pa.bool_())
    odd = odd.to_numpy(zero_copy_only=False).astype(np.int64)
    odd_words = counts_by_row(odd[codes], word_offsets)
    filled = pc.fill_null(texts, "") if texts.null_count else texts
    lines = pc.split_pattern(filled, "\n")
    line_offsets = lines.offsets.to_numpy().astype(np.int64)
    line_offsets, first = line_offsets - line_offsets[0], int(line_offsets[0])
    line_codes, kinds = coded(lines.values.slice(first, int(line_offsets[-1])))
    line_rows = rows_of(line_offsets)
    different = np.bincount(np.unique(line_rows * max(len(kinds), 1) + line_codes) // max(len(kinds), 1), minlength=len(size))
    n_lines = np.diff(line_offsets)
    part = lambda a, b, soft=1.0: np.log((a + 0.02 * soft) / (b + soft))
    return np.column_stack(
        [
            np.log1p(n),
            np.log((size + 6.0) / (n + 1.0)),
            part(share["symbols"], size, 20),
            part(share["upper"], share["letters"], 20),
            part(share["digits"], size, 20),
            (distinct + 8.0) / (n + 8.0) + 0.08 * np.log1p(n),
            part(top, n, 10),
            part(odd_words, n, 10),
            part(share["bars"], size, 20),
            part(share["vowels"], share["letters"], 20),
            part(share["newlines"], n, 10),
            part(n_lines - different, n_lines, 5),
        ]
    )


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``x``, the array of statistics."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics(batch.column(1))
        values = pa.array(x.ravel())
        lists = pa.FixedSizeListArray.from_arrays(values, x.shape[1]).cast(pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "x"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_texts(source, "text", run, f"doc_id {kind}, x array<double>", SLICE)


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", shrink: float = 0.1) -> Model:
    """Fit on frames (doc_id, x) and (doc_id, label), both with only the rows to learn from.

    ``shrink`` is the weight of the pooled and diagonal covariance. Means, covariances
    and the logistic scale take all rows.
    """
    label = F.col(label_col).cast("int")
    marks = labels.where(label.isin(0, 1)).select("doc_id", label.alias("y"))
    rows = stats.join(marks, "doc_id").select("y", "x")

    def sums(batches):
        d = len(STATISTICS)
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for c in (0, 1):
                own = x[y == c]
                total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        for c in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array([c] * total.shape[1], pa.int32()), pa.array(range(total.shape[1]), pa.int32()), pa.array(total[c])], names=["y", "i", "v"])

    added = rows.mapInArrow(sums, "y int, i int, v double").groupBy("y", "i").agg(F.sum("v").alias("v")).collect()
    d = len(STATISTICS)
    total = np.zeros((2, 1 + d + d * d))
    for r in added:
        total[r.y, r.i] = r.v
    n = total[:, 0]
    if (n < 2).any():
        share = n[1] / n.sum() if n.sum() else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros((0, d)), np.zeros((0, d, d)), np.zeros(0), 1.0, float(np.log(share / (1 - share))))
    means = total[:, 1 : 1 + d] / n[:, None]
    within = [total[c, 1 + d :].reshape(d, d) / n[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (within[0] * n[0] + within[1] * n[1]) / n.sum()
    scale = np.diag(np.maximum(np.diag(pooled), 1e-6))
    covariances = [(1 - shrink) * w + 0.5 * shrink * (pooled + np.diag(np.diag(w))) + 0.02 * scale for w in within]
    factors = np.array([np.linalg.cholesky(c) for c in covariances])
    log_dets = np.array([2 * np.log(np.diag(f)).sum() for f in factors])
    model = Model(means, factors, log_dets, 1.0, 0.0)
    model.slope, model.offset = _logistic(rows, model)
    return model


def _logistic(rows: DataFrame, model: Model, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic regression of y on the differences, by Newton steps with a small ridge, halved until the loss falls.

    Gradient and Hessian are added up over all rows (y, x), whose differences are stored once.
    """

    def differ(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.differences(x))], names=["y", "z"])

    held = staged(rows.mapInArrow(differ, "y int, z double"))

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient and Hessian, with the ridge."""
        t = F.lit(float(w[0])) * F.col("z") + F.lit(float(w[1]))
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), t))))
        loss = F.greatest(F.lit(0.0), t) + F.log1p(F.exp(-F.abs(t))) - F.col("y") * t
        miss, spread = p - F.col("y"), p * (1 - p)
        z = F.col("z")
        total, g0, g1, h00, h01, h11 = held.agg(F.sum(loss), F.sum(miss * z), F.sum(miss), F.sum(spread * z * z), F.sum(spread * z), F.sum(spread)).first()
        return total + 0.5e-3 * float(w @ w), np.array([g0, g1]) + 1e-3 * w, np.array([[h00, h01], [h01, h11]]) + 1e-3 * np.eye(2)

    w = np.zeros(2)
    loss, gradient, hessian = at(w)
    for _ in range(rounds):
        step = np.linalg.solve(hessian, gradient)
        after = at(w - step)
        while after[0] > loss * (1 + 1e-12) and np.abs(step).max() >= 1e-10:  # a whole step may lead away
            step = step / 2
            after = at(w - step)
        w, (loss, gradient, hessian) = w - step, after
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0]), float(w[1])


def score(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score for each row of statistics."""

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], names=["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches ``threshold``, columns unchanged; one pass, no shuffle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = model.scores(statistics(batch.column(text_col))) >= threshold
        return batch.filter(pa.array(good))

    return map_texts(docs, text_col, run, docs.schema, SLICE)
