"""Document quality by Bradley-Terry pairwise ranking.

A pair (better, worse) of labelled documents is modelled by
``P(better beats worse) = sigmoid(w . (x_better - x_worse))``; ``w`` minimises the logistic loss
on feature differences (no intercept: only order is learned).  The raw score ``w . x`` is then cut
at a quantile of the training scores, the quantile that separates the labels best, and mapped to
(0, 1) so that the cut lies at ``CUT``.

Features are shape statistics of the whole text (lengths, repetition, symbols, case, layout), so
nothing about ids, languages, sources or labels enters a score.

The fit uses a bounded, documented sample: at most ``LABEL_ROWS`` labelled documents (the smallest
by a hash of the id) and ``PAIRS_PER_ROW`` opponents for each.  Scoring covers every text in one
pass without a shuffle.

Defined results: NULL and empty texts score as the empty text; repeated rows score alike; label
rows with a NULL id or label are not used; without documents of both labels nothing can be ranked
and every score is ``CUT`` (nothing is rejected); an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import crc_mod, fresh, per_batch, raw, small_batches
from strata.llm.quality_rules import measure

LABEL_ROWS = 20_000
PAIRS_PER_ROW = 8
CUT = 0.7
_SEED = 20_240_817

FEATURES = ["log_words", "mean_length", "symbols", "upper", "dup_lines", "repeats", "variety", "digits", "stops",
            "marks", "bars", "line_length", "high", "doubled", "short_words", "empty"]


def features(text: bytes) -> list[float]:
    n_words, chars, symbols, n_lines, dup, rep, upper, lower, high, unique = measure(text)
    if not n_words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    n, letters = float(n_words), max(1, upper + lower + high)
    words = text.split()
    doubled = sum(map(bytes.__eq__, words, words[1:]))
    short = sum(1 for w in words if len(w) <= 3)
    size = len(text)
    digits = size - len(text.translate(None, b"0123456789"))
    return [min(8.0, float(np.log1p(n))), min(20.0, chars / n), min(3.0, symbols / n), upper / letters,
            dup / max(1, n_lines), rep / n, unique / n ** 0.85, digits / max(1, chars), text.count(b".") / n,
            min(3.0, (text.count(b"!") + text.count(b"?")) / n), min(2.0, text.count(b"|") / n),
            min(6.0, float(np.log1p(n / max(1, n_lines)))), high / letters, doubled / n, short / n, 0.0]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float
    quantile: float
    n_rows: int
    n_pairs: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale).clip(-6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.log(CUT / (1 - CUT)) + self.slope * (self.raw(x) - self.threshold)
        p = 1 / (1 + np.exp(-z.clip(-40, 40)))
        return np.round(p, 9)


def neutral() -> Model:
    k = len(FEATURES)
    return Model(np.zeros(k), np.ones(k), np.zeros(k), 0.0, 0.0, 0.0, 0, 0)


def newton(x: np.ndarray, y: np.ndarray, offset: float, ridge: float, rounds: int = 25) -> np.ndarray:
    """Logistic regression without intercept by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + offset).clip(-30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if float(np.abs(step).max()) < 1e-8:
            break
    return w


def fit_arrays(x: np.ndarray, y: np.ndarray, pairs_per_row: int = PAIRS_PER_ROW) -> Model:
    """Bradley-Terry fit on feature rows ``x`` with labels ``y`` (1 beats 0)."""
    good, bad = np.nonzero(y == 1)[0], np.nonzero(y == 0)[0]
    if not len(good) or not len(bad):
        return neutral()
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = ((x - mean) / scale).clip(-6, 6)
    rng = np.random.default_rng(_SEED)
    n = pairs_per_row * max(len(good), len(bad))
    a = np.resize(good, n)
    b = bad[rng.integers(0, len(bad), n)] if len(bad) < len(good) else np.resize(rng.permutation(bad), n)
    if len(good) < len(bad):
        a = good[rng.integers(0, len(good), n)]
    w = newton(z[a] - z[b], np.ones(n), 0.0, ridge=1.0)
    raw_scores = z @ w
    # the cut: among the quantiles of the training scores the one with the fewest errors weighted by
    # class; of equal ones the middle
    order = np.sort(raw_scores)
    levels = np.unique(np.concatenate([np.linspace(0.0, 1.0, 401), [float((y == 0).mean())]]))
    cuts = np.quantile(order, levels)
    gs, bs = np.sort(raw_scores[good]), np.sort(raw_scores[bad])
    lost = np.searchsorted(gs, cuts, side="left") / len(gs)
    passed = 1 - np.searchsorted(bs, cuts, side="left") / len(bs)
    # losing a good document weighs twice as much as passing a bad one
    error = 2 * lost + passed
    best = np.nonzero(error <= error.min() + 1e-12)[0]
    i = best[len(best) // 2]
    below, above = order[order < cuts[i]], order[order >= cuts[i]]
    threshold = float((below[-1] + above[0]) / 2) if len(below) and len(above) else float(cuts[i])
    slope = float(newton((raw_scores - threshold)[:, None], y.astype(float), float(np.log(CUT / (1 - CUT))), 1.0)[0])
    return Model(mean, scale, w, threshold, max(slope, 1e-3), float(levels[i]), len(y), n)


def _vectors(text_col: str) -> Column:
    def make():
        return lambda texts: pa.array([features(t) for t in texts], type=pa.list_(pa.float64()))
    return per_batch(make, "array<double>")(raw(text_col))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int = LABEL_ROWS) -> DataFrame:
    """(id, y, text) of at most ``limit`` labelled training documents, the smallest by a hash of the id.

    One row per id and label: of rows that repeat an id, the text with the smallest hash.
    """
    y = (labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y"))
         .where(F.col("_id").isNotNull() & F.col("_y").isNotNull()).where(train)
         .distinct().orderBy(F.xxhash64(F.col("_id"), F.lit(_SEED)), "_id", "_y").limit(limit))
    found = (docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
             .join(F.broadcast(y), "_id"))  # at most ``limit`` rows of two numbers
    return one_of_each(found, ["_id", "_y"], "_text")


def one_of_each(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per key, the same one in every run; a task hands on at most one row of a key."""
    order = Window.partitionBy(*keys).orderBy(F.xxhash64(text), text)
    n = fresh(df, "_nth")
    return df.withColumn(n, F.row_number().over(order)).where(F.col(n) == 1).drop(n)


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, limit: int = LABEL_ROWS) -> Model:
    """Learn from labelled documents; ``train`` is a condition over ``_id`` (default: every row but fold 2 of 4)."""
    small_batches(docs.sparkSession)
    train = (crc_mod("_id", 4) != 2) if train is None else train
    sample = labelled_sample(docs, labels, "quality", train, limit)
    rows = sample.select("_id", "_y", _vectors("_text").alias("x")).collect()
    if not rows:
        return neutral()
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    return fit_arrays(np.array([r[2] for r in rows]), np.array([r[1] for r in rows]))


def score_column(model: Model, text_col: str = "text") -> Column:
    """Score in (0, 1) of a text column."""
    def make():
        def run(texts: list[bytes]) -> pa.Array:
            if not texts:
                return pa.array([], type=pa.float64())
            return pa.array(model.score(np.array([features(t) for t in texts])), type=pa.float64())
        return run
    return per_batch(make, "double")(raw(text_col))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: ``doc_id, score, predicted``."""
    small_batches(docs.sparkSession)
    return (docs.select("doc_id", score_column(model).alias("score"))
            .withColumn("predicted", (F.col("score") >= CUT).cast("int")))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The input's rows and columns without the documents whose score lies under the cut."""
    small_batches(docs.sparkSession)
    return docs.where(score_column(model) >= CUT)
