"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered: 0 toxic, 1 low quality, 2 good. One weight per hashed text feature is shared by all grades, and ordered
thresholds cut the score: ``P(grade >= k) = sigmoid(score - threshold_k)``. From it follow the expected grade and the tail
probability by which documents are selected.

The fit uses at most about ``MOST_ROWS`` labelled documents, a parameter, and every hashed feature that clears its test for a grade;
scoring covers every whole text.

Defined results: a null or empty text is scored by its shape alone; a document rated more than once counts by its lowest
grade; rows with a null rating are left out; without ratings, or with a single grade, every document gets the prior of
that grade (or is kept); repeated rows get equal scores. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.features import WIDTH, Hashed, hashed_sample, labelled_sample, minimise, sample_features, scores

GOOD = 2
MOST_ROWS = 20_000
#: A feature takes part when it is in this many rated documents and this many standard errors off the mean.
LEAST_DOCS = 5
LEAST_Z = 5.0
PENALTY = 1e-4
KEEP_FROM = 0.5
SCORES = "doc_id bigint, score double, expected_grade double, p_good double"


@dataclass(frozen=True)
class OrdinalModel:
    weights: dict[int, float]  # by bucket of features
    thresholds: tuple[float, ...]

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for k = 1, 2, ..."""
        return sigmoid(scores[:, None] - np.array(self.thresholds))

    def scores(self, texts: pa.Array) -> np.ndarray:
        place = np.full(WIDTH, -1, dtype=np.int64)
        place[list(self.weights)] = np.arange(len(self.weights))
        return scores(texts, place, np.array([*self.weights.values()]).reshape(-1, 1))[1][:, 0]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def grades(labels: DataFrame) -> DataFrame:
    """``doc_id, y`` from 0/1 ratings of toxicity and quality."""
    y: Column = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, GOOD)
    return labels.select("doc_id", y.cast("int").alias("y"))


def fit_ordinal(x, y: np.ndarray, selected: list[int], penalty: float = PENALTY) -> OrdinalModel:
    """``x``: the features of the graded documents, as :class:`features.Hashed` or as a plain matrix.

    Thresholds stay ordered because each lies a positive step above the one before.
    """
    k = GOOD
    rows, width = np.arange(len(y)), len(selected)
    if isinstance(x, np.ndarray):
        dot, transposed = x.__matmul__, x.T.__matmul__
    else:
        dot, transposed = (lambda w: x.dot(w[:, None])[:, 0]), (lambda off: x.transposed_dot(off[:, None])[:, 0])

    def parts(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps = np.exp(np.clip(w[-k + 1:], -8, 8))
        return np.concatenate([[w[-k]], w[-k] + np.cumsum(steps)]), steps

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        cuts, steps = parts(w)
        tail = np.hstack([np.ones((len(y), 1)), sigmoid(dot(w[:-k])[:, None] - cuts), np.zeros((len(y), 1))])
        upper, lower = tail[rows, y], tail[rows, y + 1]
        p = np.maximum(upper - lower, 1e-9)
        slope = tail * (1 - tail)
        # d log p / d score, and the part of each threshold in it
        by_score = (slope[rows, y] - slope[rows, y + 1]) / p
        by_cut = np.zeros((len(y), k + 2))
        by_cut[rows, y] -= slope[rows, y] / p
        by_cut[rows, y + 1] += slope[rows, y + 1] / p
        cut = by_cut[:, 1:-1].mean(axis=0)
        g = np.empty_like(w)
        g[:-k] = -transposed(by_score) / len(y) + penalty * w[:-k]
        g[-k] = -cut.sum()
        g[-k + 1:] = -np.cumsum(cut[::-1])[::-1][1:] * steps
        return -float(np.log(p).mean()) + penalty / 2 * float((w[:-k] ** 2).sum()), g
    w = minimise(loss, np.zeros(width + k))
    cuts, _ = parts(w)
    return OrdinalModel(dict(zip(selected, w[:-k].tolist(), strict=True)), tuple(cuts.tolist()))


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> OrdinalModel:
    rows = sample_features(labelled_sample(docs, grades(labels), most_rows))
    present = sorted(r[0] for r in rows.select("y").distinct().collect())
    if len(present) < 2:
        grade = present[0] if present else GOOD
        return OrdinalModel({}, tuple(-8.0 if grade >= k else 8.0 for k in range(1, GOOD + 1)))
    y, sample = hashed_sample(rows)
    x = Hashed(sample, np.eye(len(present))[[present.index(v) for v in y]], LEAST_DOCS, LEAST_Z)
    return fit_ordinal(x, np.array(y), x.selected.tolist())


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """``doc_id, score, expected_grade, p_good, kept`` of every row."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.scores(batch.column("text"))
            tails = model.tails(s)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s, pa.float64()), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])], names=[x.split()[0] for x in SCORES.split(", ")])
    return docs.select("doc_id", "text").mapInArrow(each, SCORES).withColumn("kept", F.col("p_good") >= KEEP_FROM)


def select_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, columns unchanged, that are good with a probability of at least ``KEEP_FROM``."""
    model = train(docs, labels)
    columns = docs.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.tails(model.scores(batch.column("text")))[:, -1] >= KEEP_FROM))
    return docs.select(columns).mapInArrow(each, docs.schema)
