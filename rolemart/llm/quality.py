"""Document quality by Bradley-Terry pairwise ranking.

Every training pair is a document that should rank above another one. The model is one weight per feature; the chance
that a beats b is the logistic function of the weighted difference of their features, and the weights minimise the
logistic loss over the pairs. Scores are then cut at a quantile of the training scores.

Features come from the text alone. The fit uses a sample of labelled rows of at most ``max_rows`` documents (those with
the smallest hash of their id), so what reaches the driver is bounded; scoring is one pass over all documents without a
shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import bytes_of, space_words

FEATURES = (
    "log_words", "log_word_bytes", "upper_share", "symbol_share", "exclamation_share", "pipe_share", "digit_share", "period_rate",
    "comma_rate", "line_rate", "distinct_share", "growth", "repeated_line_share", "top_word_share", "repeated_pair_share", "one_short_line",
)


def features(data: bytes) -> list[float]:
    """FEATURES of a UTF-8 text; an empty one has zeros."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = space_words(data)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    solid = int(counts.sum() - counts[32] - counts[9:14].sum())
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    frequency: dict[bytes, int] = {}
    for w in words:
        frequency[w] = frequency.get(w, 0) + 1
    pairs = len(set(zip(words, words[1:]))) if n > 1 else 0
    lines = [x for x in data.split(b"\n") if x.strip()]
    symbols = int(counts[[35, 36, 37, 38, 42, 60, 62]].sum())  # # $ % & * < >
    return [
        float(np.log1p(n)), float(np.log(solid / n)), counts[65:91].sum() / letters, symbols / solid, counts[33] / solid,
        counts[124] / solid, counts[48:58].sum() / solid, min(2.0, counts[46] / n), min(2.0, counts[44] / n), min(2.0, len(lines) / n),
        len(frequency) / n, float(np.log1p(len(frequency)) / np.log1p(n)), 1 - len(set(lines)) / len(lines), max(frequency.values()) / n,
        1 - pairs / (n - 1) if n > 1 else 0.0, float(len(lines) == 1 and n < 10),
    ]


def _features_udf():
    @F.arrow_udf("array<double>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([[float(v) for v in features(t.as_py())] for t in texts], pa.list_(pa.float64()))

    return compute


@dataclass(frozen=True)
class Ranker:
    """score = logistic(logit(cut) + weights . (features - mean) / spread - threshold): the threshold scores ``cut``."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    quantile: float
    threshold: float
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shifted = self.raw(x) - self.threshold + np.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(shifted, -30, 30)))


def preference_pairs(quality: np.ndarray, per_row: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (better, worse): each row meets ``per_row`` random rows of the other label."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(quality == 1), np.flatnonzero(quality == 0)
    if not len(good) or not len(bad):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    better = np.concatenate([np.repeat(good, per_row), rng.choice(good, len(bad) * per_row)])
    worse = np.concatenate([rng.choice(bad, len(good) * per_row), np.repeat(bad, per_row)])
    return better, worse


def fit_weights(difference: np.ndarray, ridge: float, steps: int = 30) -> np.ndarray:
    """Newton steps on the mean of log(1 + exp(-w.d)) + ridge/2 |w|^2."""
    w = np.zeros(difference.shape[1])
    for _ in range(steps if len(difference) else 0):
        p = 1 / (1 + np.exp(np.clip(difference @ w, -30, 30)))
        gradient = -(difference * p[:, None]).mean(0) + ridge * w
        curvature = (difference * (p * (1 - p))[:, None]).T @ difference / len(difference) + ridge * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(x: np.ndarray, quality: np.ndarray, cut: float, pairs_per_row: int = 4, ridge: float = 1e-3, seed: int = 7) -> Ranker:
    """Weights from pairs; the threshold is the score quantile with the fewest wrong labels."""
    width = len(FEATURES)
    if not len(x):
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 0.0, cut)
    mean, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = (x - mean) / spread
    better, worse = preference_pairs(quality, pairs_per_row, seed)
    w = fit_weights(z[better] - z[worse], ridge)
    order = np.argsort(z @ w, kind="stable")
    scores, labels = (z @ w)[order], quality[order]
    bad = (labels == 0).sum()
    if not bad or bad == len(labels):  # one label only: everything is on its side of the threshold
        return Ranker(mean, spread, w, 0.0 if not bad else 1.0, scores[0] - 1 if not bad else scores[-1] + 1, cut)
    below_bad = np.concatenate([[0], np.cumsum(labels == 0)])
    below_good = np.concatenate([[0], np.cumsum(labels == 1)])
    gain = below_bad - below_good  # right decisions won over keeping everything
    edges = np.concatenate([[scores[0] - 1], (scores[1:] + scores[:-1]) / 2, [scores[-1] + 1]])
    parted = np.concatenate([[True], scores[1:] > scores[:-1], [True]])
    ties = np.flatnonzero(parted & (gain == gain[parted].max()))
    best = int(ties[len(ties) // 2])
    return Ranker(mean, spread, w, best / len(labels), float(edges[best]), cut)


def train(docs: DataFrame, labels: DataFrame, cut: float, max_rows: int = 20_000) -> Ranker:
    """``labels``: doc_id, quality (0 or 1). Rows with NULL or other values teach nothing; of a doc_id's labels the lowest counts."""
    labelled = (
        labels.where(labels["quality"].isin(0, 1) & labels["doc_id"].isNotNull())
        .groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), bytes_of(docs).alias("text"))
    # at most max_rows ids and labels are broadcast
    rows = (
        texts.join(F.broadcast(labelled), "doc_id")
        .select("doc_id", "quality", _features_udf()("text").alias("x"))
        .groupBy("doc_id").agg(F.min_by(F.struct("quality", "x"), F.struct("x")).alias("r"))
        .orderBy("doc_id").select("r.*").toPandas()
    )
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["quality"].to_numpy(int), cut)


def _score_udf(model: Ranker):
    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = np.array([features(t.as_py()) for t in texts], float).reshape(len(texts), len(FEATURES))
            yield pa.array(model.score(x), pa.float64())

    return score.asNondeterministic()


def score(docs: DataFrame, model: Ranker) -> Column:
    """The score of the whole ``text`` of ``docs`` as a column, 0 to 1; NULL texts score as empty ones."""
    return _score_udf(model)(bytes_of(docs))


def with_quality(docs: DataFrame, labels: DataFrame, column: str, cut: float = 0.3, max_rows: int = 20_000) -> DataFrame:
    """All rows and columns of ``docs`` and, as ``column``, the quality score; the learnt quantile scores ``cut``.

    NULL and empty texts have all features zero and a score like any other. Ties and repeated rows score alike. Labels
    that are NULL, or of documents that are not there, are ignored; without labels of both kinds every document is on
    the side of the only label (of none: above the threshold). Empty tables give no rows; further columns pass through.
    """
    return docs.withColumn(column, score(docs, train(docs, labels, cut, max_rows)))
