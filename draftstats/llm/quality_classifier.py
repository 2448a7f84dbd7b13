"""Quality classifier: naive Bayes support vectors over hashed byte n-grams.

Indicators of n-grams are scaled by the log-count ratio of the two classes; a
linear model with hinge loss is fitted to them by dual coordinate descent, and
its margin is turned into a probability.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8

BITS = 16
ORDER = 3
# Levels of the share of word pairs that say the same word twice, from 1/20 up. A level is a block of
# equal indicators, so that one of them is not lost among a text's hundreds of n-grams.
_REPEAT_LEVELS = np.array([0.05, 0.1, 0.2, 0.3, 0.5, 0.7])
_BLOCK = 64
FEATURES = (1 << BITS) + len(_REPEAT_LEVELS) * _BLOCK
_MULTIPLIER = np.uint32(2654435761)
_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


@dataclass(frozen=True)
class Model:
    """weights[f] of an n-gram that occurs, to be divided by the root of the number of n-grams."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def probability(self, features: np.ndarray) -> float:
        margin = self.bias
        if len(features):
            margin += float(self.weights[features].sum()) / len(features) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def held_out(doc_id: Column) -> Column:
    """The fifth of all documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def indicators(text: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The n-gram indicators of a text's bytes, in order. `seen` is a cleared array of flags to work in.

    They are hashed byte n-grams, and levels of how many word bigrams repeat a word.
    """
    if len(text) < ORDER:
        return np.zeros(0, np.int64)
    wide = text.astype(np.uint32)
    grams = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    seen[(grams * _MULTIPLIER) >> np.uint32(32 - BITS)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    words = text.tobytes().split()
    repeated = sum(map(eq, words, islice(words, 1, None)))
    levels = int((repeated >= _REPEAT_LEVELS * max(1, len(words) - 1)).sum())
    return np.concatenate((found, np.arange(1 << BITS, (1 << BITS) + levels * _BLOCK)))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 8_000, cost: float = 1.0, epochs: int = 12
) -> Model:
    """Fit to labelled documents.

    The fit is bounded: it takes the `max_rows` rows of `labels` whose hashed ids
    come first (all, if there are fewer), at any size of the corpus. Rows with a
    null id or label take no part, nor do labels without a document. Repeated
    rows count as often as they occur; should ids repeat so often that there are
    more than 4 * `max_rows` documents, the first by hashed ids, ids, labels and
    features are taken, whatever their order in the table. Without both classes
    the model gives every text the share of label 1, smoothed.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("label_id"), F.col(label).cast("double").alias("label"))
        .filter(F.col("label_id").isNotNull() & F.col("label").isin(0.0, 1.0))
        .orderBy(F.xxhash64("label_id"), "label_id", "label")
        .limit(max_rows)
    )
    # max_rows ids and labels at most, so they can go to every task.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    found = texts.select("doc_id", "label", "text").mapInArrow(_featurised, "doc_id bigint, label double, features binary")
    first = found.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "features").limit(4 * max_rows)
    rows = sorted((r.doc_id, r.label, bytes(r.features)) for r in first.collect())
    features = [np.frombuffer(r[2], np.int32).astype(np.int64) for r in rows]
    signs = np.array([1.0 if r[1] == 1.0 else -1.0 for r in rows])
    return _fit(features, signs, cost, epochs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; score is the probability of label 1 by the text alone. Null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            scores = [model.probability(indicators(t, seen)) for t in utf8(batch.column(1))]
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(scores, pa.float64())], schema=_SCORED)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents the model does not reject, with all their columns."""
    fields, names = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            text = utf8(batch.column(names.index("text")))
            yield batch.filter(pa.array([model.probability(indicators(t, seen)) >= threshold for t in text], pa.bool_()))

    return docs.mapInArrow(run, fields)


def _featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(1 << BITS, bool)
    for batch in batches:
        packed = [indicators(t, seen).astype(np.int32).tobytes() for t in utf8(batch.column(2))]
        yield pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc_id", "label", "features"]
        )


def _fit(features: list[np.ndarray], signs: np.ndarray, cost: float, epochs: int) -> Model:
    none = np.zeros(FEATURES)
    good, bad = int((signs > 0).sum()), int((signs < 0).sum())
    if not good or not bad:
        share = (good + 1) / (good + bad + 2)
        return Model(none, 0.0, 0.0, float(np.log(share / (1 - share))))
    # Every fifth row is kept from the fit, to turn margins into probabilities.
    kept = np.arange(len(signs)) % 5 == 4
    if len(set(signs[~kept])) < 2 or len(set(signs[kept])) < 2:
        kept[:] = False
    counts = {s: np.ones(FEATURES) for s in (1.0, -1.0)}
    for found, sign in zip(features, signs, strict=True):
        counts[sign][found] += 1
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    fitted = np.flatnonzero(~kept)
    weights, bias = _dual_coordinate_descent([features[i] for i in fitted], signs[fitted], ratio, cost, epochs)
    model = Model(weights * ratio, bias, 1.0, 0.0)
    calibrated = np.flatnonzero(kept) if kept.any() else fitted
    margins = np.array([_margin(model, features[i]) for i in calibrated])
    slope, offset = _calibrate(margins, signs[calibrated])
    return Model(model.weights, bias, slope, offset)


def _margin(model: Model, found: np.ndarray) -> float:
    return model.bias + (float(model.weights[found].sum()) / len(found) ** 0.5 if len(found) else 0.0)


def _dual_coordinate_descent(
    features: list[np.ndarray], signs: np.ndarray, ratio: np.ndarray, cost: float, epochs: int
) -> tuple[np.ndarray, float]:
    """Minimise |w|^2 / 2 + cost * hinge loss, one row's dual variable at a time."""
    order = np.random.default_rng(7)
    rows = [(f, ratio[f] / max(1, len(f)) ** 0.5) for f in features]
    norms = np.array([x @ x + 1.0 for _, x in rows])
    duals = np.zeros(len(rows))
    weights, bias = np.zeros(len(ratio)), 0.0
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            found, x = rows[i]
            gradient = signs[i] * (weights[found] @ x + bias) - 1
            new = min(max(duals[i] - gradient / norms[i], 0.0), cost)
            if new != duals[i]:
                step = (new - duals[i]) * signs[i]
                weights[found] += step * x
                bias += step
                duals[i] = new
    return weights, bias


def _calibrate(margins: np.ndarray, signs: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the margin, by Newton steps, with smoothed targets."""
    good, bad = (signs > 0).sum(), (signs < 0).sum()
    target = np.where(signs > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones_like(margins)])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-6)) @ x.T + 1e-4 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hessian, x @ (target - p) - 1e-4 * beta), -2, 2)
    return float(beta[0]), float(beta[1])
