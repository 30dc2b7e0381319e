"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a dozen and a half transformed statistics (lengths, shares of
kinds of characters, repetition). Each class has a Gaussian whose covariance is
shrunk towards the pooled one and the diagonal; its Cholesky factor is computed
once. The score is the difference of the Mahalanobis log densities plus the log
of the class sizes, passed through a logistic curve fitted on training rows.

Learning is sums over all labelled rows: tasks send counts, sums and products of
statistics per class. The model is a few hundred numbers, whatever the data.

Cases: null and empty texts have the statistics of an empty text and a score.
Labels that are null or neither 0 nor 1, and rows of the fold held out, do not
teach; several labels of a document each teach. With less than two labelled
rows of either class the score is the share of label 1, or one half without any.
Repeated rows are scored alike, an empty table gives an empty result, and extra
columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, materialize, slices

NAMES = (
    "log_words word_length capitals capital_starts digits exclaims marks bars stops commas newlines "
    "high_bytes different repeated_lines longest_word short_words spread top_word"
).split()
#: Least shares of the pooled covariance and of the diagonal; a class with few rows takes more.
TO_POOLED, TO_DIAGONAL = 0.1, 0.02
THRESHOLD = 0.7


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text, in the order of ``NAMES``."""
    data = (text or "").encode("utf-8", "replace")
    n = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    lines = [x for x in data.split(b"\n") if x]
    upper, lower = int(n[65:91].sum()), int(n[97:123].sum())
    w, b, letters = max(1, len(words)), max(1, len(data)), max(1, upper + lower)
    kinds: dict[bytes, int] = {}
    for x in words:
        kinds[x] = kinds.get(x, 0) + 1
    share = n[n > 0] / b
    root = lambda x: float(np.sqrt(x))
    marks = int(n[33:48].sum() + n[58:65].sum() + n[91:97].sum() + n[123:127].sum())
    plain = int(n[33] + n[44] + n[46] + n[124])
    return [
        float(np.log1p(len(words))),
        float(np.log1p(lengths.mean())) if words else 0.0,
        root(upper / letters),
        root(sum(x[:1].isupper() for x in words) / w),
        root(n[48:58].sum() / b),
        root(n[33] / w),
        root((marks - plain) / w),
        root(n[124] / w),
        root(n[46] / w),
        root(n[44] / w),
        root(n[10] / w),
        root(n[128:].sum() / b),
        float(np.log1p(len(kinds)) / np.log1p(w)),
        root(1 - len(set(lines)) / len(lines)) if lines else 0.0,
        float(np.log1p(lengths.max())) if words else 0.0,
        root((lengths <= 3).sum() / w),
        float(-(share * np.log(share)).sum()) if len(share) else 0.0,
        root(max(kinds.values(), default=0) / w),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 8 << 20):
        rows = [statistics(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "stats"]
        )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats) of every document, stored: texts are read once."""
    narrow = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return materialize(narrow.mapInArrow(_measure, "doc_id bigint, stats array<double>"), "statistics")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(NAMES) + 1
    total = {0: np.zeros((d, d)), 1: np.zeros((d, d))}
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.array(batch.column(0).to_pylist())
        x = np.hstack([np.ones((len(x), 1)), x])
        y = np.array(batch.column(1).to_pylist())
        for k in total:
            total[k] += x[y == k].T @ x[y == k]
    for k, m in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([k] * d * d), pa.array(range(d * d)), pa.array(m.ravel())], names=["label", "i", "x"]
        )


class Model:
    """Class means, Cholesky factors and the logistic curve."""

    def __init__(self, moments: dict[int, np.ndarray]):
        counts = {k: m[0, 0] for k, m in moments.items()}
        self.rest = (counts[1] / sum(counts.values())) if sum(counts.values()) else 0.5
        self.curve = (1.0, 0.0)
        self.fitted = min(counts.values()) >= 2
        if not self.fitted:
            return
        means = {k: m[0, 1:] / counts[k] for k, m in moments.items()}
        own = {k: m[1:, 1:] / counts[k] - np.outer(means[k], means[k]) for k, m in moments.items()}
        pooled = sum(counts[k] * own[k] for k in own) / sum(counts.values())
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        self.means = {k: v / self.scale for k, v in means.items()}
        self.factors, self.offsets = {}, {}
        for k, s in own.items():
            few = len(s) / (len(s) + counts[k])
            to_pooled, to_diagonal = max(TO_POOLED, few), max(TO_DIAGONAL, few / 2)
            s = ((1 - to_pooled) * s + to_pooled * pooled) / np.outer(self.scale, self.scale)
            s = (1 - to_diagonal) * s + to_diagonal * (np.diag(np.diag(s)) + np.eye(len(s))) / 2
            factor = np.linalg.cholesky(s)
            self.factors[k] = np.linalg.inv(factor)
            self.offsets[k] = np.log(counts[k]) - np.log(np.diag(factor)).sum()

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, with class sizes."""
        out = []
        for k in (1, 0):
            z = (x / self.scale - self.means[k]) @ self.factors[k].T
            out.append(self.offsets[k] - (z**2).sum(axis=1) / 2)
        return out[0] - out[1]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.rest)
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a * squash(self.margin(x)) + b, -500, 500)))


def squash(margin: np.ndarray) -> np.ndarray:
    """Margins far out grow with their logarithm only."""
    return np.sign(margin) * np.log1p(np.abs(margin))


def _apply(model, names: tuple[str, ...], f):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f(model.value, x))], names=list(names))

    return apply


def _curve(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and intercept of the logistic curve, by Newton's method on binned margins.

    The labels are smoothed to (n1 + 1) / (n1 + 2) and 1 / (n0 + 2), so that classes
    that part cleanly do not make the curve a step.
    """
    z, n1, n = (np.array(c, dtype=float) for c in zip(*rows, strict=True))
    n1 = n1 * (n1.sum() + 1) / (n1.sum() + 2) + (n - n1) / ((n - n1).sum() + 2)
    x, theta = np.vstack([z, np.ones_like(z)]), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ x, -500, 500)))
        slope = x @ (n1 - n * p) - 1e-3 * theta
        bend = (x * (n * p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        theta = theta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """Learn from the labelled rows of ``stats`` (doc_id, stats)."""
    told = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    rows = materialize(stats.join(told, "doc_id").select("stats", "label"), "labelled")
    sums = rows.mapInArrow(_sums, "label bigint, i bigint, x double").groupBy("label", "i").agg(F.sum("x")).collect()
    d = len(NAMES) + 1
    moments = {0: np.zeros((d, d)), 1: np.zeros((d, d))}
    for label, i, x in sums:
        moments[label][divmod(i, d)] = x
    model = Model(moments)
    if model.fitted:
        held = stats.sparkSession.sparkContext.broadcast(model)
        # A few hundred bins: squashed margins in steps of a twentieth.
        margins = rows.select("label", "stats").mapInArrow(
            _apply(held, ("label", "margin"), lambda m, x: squash(m.margin(x))), "label int, margin double"
        )
        bins = margins.groupBy(F.round(F.col("margin") * 20).alias("bin")).agg(F.sum("label"), F.count("label")).collect()
        model.curve = _curve([(b / 20, n1, n) for b, n1, n in bins])
    return model


def predict(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    held = stats.sparkSession.sparkContext.broadcast(model)
    return stats.select("doc_id", "stats").mapInArrow(
        _apply(held, ("doc_id", "score"), lambda m, x: m.score(x)), "doc_id bigint, score double"
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its fold, score and verdict."""
    stats = measure(docs)
    held_out = fold(F.col("doc_id"), 4) == 2
    model = fit(stats.where(~held_out), labels)
    return predict(stats, model).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
