"""Mixing to target weights with soft membership.

A softmax classifier learned from a labelled table gives each document a posterior over domains. A document of ``n`` tokens
and posterior ``p`` adds ``n * p * rate`` expected tokens to the domains. Nonnegative rates are fitted by projected gradient to
the least squares

    1/2 (total(rate) - target)' G^-1 (total(rate) - target),    G = sum_i n_i p_i p_i'

where ``G`` is the Gram matrix of the domains. A step goes from the gradient per token and is projected on the bounds,
``rate_i <- clip(rate_i - p_i . s, low, high)`` with ``s = G^-1 (total - target)``. In the metric of the tokens the curvature of that
function is a projection, so this step always descends, and where no bound is touched it meets the targets at once. Where
bounds hold many rates, the Gram matrix of the documents between them is the better preconditioner: every pass tries
steps by it, and longer ones, beside the plain step, and the lowest sum of squares is taken. Only totals and Gram matrices come to the
driver, and no rates are stored: tasks find a document's rate from its posterior and the steps so far. The fit ends where the
plain step moves no domain's total any more, or no step lowers the sum of squares, and not after a number of steps.

Defined results: a null or empty text has no tokens and keeps the posterior of its shape; with no tokens at all every rate
is 1; without labels the only domain is ``other``; domains without a target keep their natural total; targets of unknown
domains are ignored and the rest rescaled; repeated rows get equal rates. Domain labels also read ``lang``.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.llm.common import saved
from meterline.llm.features import WIDTH, Hashed, hashed_sample, labelled_sample, minimise, sample_features, scores

MOST_ROWS = 20_000
LEAST_DOCS = 5
LEAST_Z = 5.0
PENALTY = 1e-4
#: Steps end when a step moves no domain's total by more than this part of its natural total.
TOLERANCE = 1e-6
#: They also end when none lowers the sum of squares by this part of it: targets that the bounds forbid are approached slowly.
STILL = 1e-9
#: Longer plain steps that a pass tries, and the dampings and lengths of steps by the documents between their bounds.
LONGER, DAMPINGS, LENGTHS = (4, 16, 64), (1e-8, 1e-6, 1e-4, 1e-3, 1e-2, 1e-1), (1.0, 0.3)
#: A domain that ends further from its target than this part of it is logged.
NOTABLE = 0.01
POSTERIORS = "doc_id bigint, text_hash bigint, n_tokens bigint, posterior array<double>"


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    rows: dict[int, int]  # bucket of features to row
    weights: np.ndarray  # one row per bucket that says something, and the bias as the last

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words, and one row of probabilities per text."""
        words, s = scores(texts, places(self.rows), self.weights[:-1])
        s += self.weights[-1]
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return words, e / e.sum(axis=1, keepdims=True)


def places(rows: dict[int, int]) -> np.ndarray:
    place = np.full(WIDTH, -1, dtype=np.int64)
    place[list(rows)] = list(rows.values())
    return place


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DomainModel:
    """``labels``: ``doc_id, y`` with the domain's name."""
    rows = sample_features(labelled_sample(docs, labels, most_rows))
    domains = sorted(r[0] for r in rows.select("y").distinct().collect())
    if len(domains) < 2:
        return DomainModel(tuple(domains) or ("other",), {}, np.zeros((1, max(len(domains), 1))))
    y, sample = hashed_sample(rows)
    truth = np.eye(len(domains), dtype=np.float32)[[domains.index(v) for v in y]]
    x = Hashed(sample, truth, LEAST_DOCS, LEAST_Z)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        s = x.dot(w[:-1].astype(np.float32)) + w[-1].astype(np.float32)
        s -= s.max(axis=1, keepdims=True)
        e = np.exp(s)
        total = e.sum(axis=1, keepdims=True)
        off = (e / total - truth) / len(y)
        value = float((np.log(total)[:, 0].astype(float) - (s * truth).sum(axis=1)).mean()) + PENALTY / 2 * float((w[:-1] ** 2).sum())
        return value, np.vstack([x.transposed_dot(off) * x.says + PENALTY * w[:-1], off.sum(axis=0)])
    w = minimise(loss, np.zeros((len(x.selected) + 1, len(domains))))
    return DomainModel(tuple(domains), {b: i for i, b in enumerate(x.selected.tolist())}, w)


def posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, p = model.posteriors(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(words), _lists(p)], names=["doc_id", "text_hash", "n_tokens", "posterior"])
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(each, POSTERIORS)


def _lists(p: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))


def rates(p: np.ndarray, history: np.ndarray, low: float, high: float) -> np.ndarray:
    """The rates of documents with posteriors ``p`` after the steps in ``history``, one row each."""
    x = np.ones(len(p))
    for step in history:
        x = np.clip(x - p @ step, low, high)
    return x


def _sums(rows: DataFrame, history: np.ndarray, tried: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """For each step in ``tried`` after those in ``history``: totals by domain, and the Gram matrix of the documents between their bounds."""
    m, k = tried.shape
    width = k + k * k

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((m, width))
        for batch in batches:
            n, p = _arrays(batch, k)
            before = rates(p, history, low, high)
            for i in range(m):
                x = np.clip(before - p @ tried[i], low, high)
                sums[i, :k] += (n * x) @ p
                sums[i, k:] += ((p * (n * ((x > low) & (x < high)))[:, None]).T @ p).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(m * width), pa.int32()), pa.array(sums.ravel())], names=["at", "total"])
    found = rows.select("n_tokens", "posterior").mapInArrow(each, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    out = np.zeros(m * width)
    for r in found.collect():
        out[r["at"]] = r["total"]
    out = out.reshape(m, width)
    return out[:, :k], out[:, k:].reshape(m, k, k)


def _arrays(batch: pa.RecordBatch, domains: int) -> tuple[np.ndarray, np.ndarray]:
    n = batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float)
    return n, batch.column("posterior").flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)


def target_totals(natural: np.ndarray, domains: tuple[str, ...], weights: dict[str, float], grow: bool) -> np.ndarray:
    """Token totals by domain. ``grow`` asks for the least total at which no domain has to shrink; else the total stays."""
    w = np.array([weights.get(d, 0.0) for d in domains])
    known = w > 0
    if not known.any() or not natural[known].sum():
        return natural.copy()
    w = w / w.sum()
    whole = natural[known].sum()
    if grow:
        whole = (natural[known] / w[known]).max()
    return np.where(known, w * whole, natural)


def fit_rates(rows: DataFrame, domains: tuple[str, ...], weights: dict[str, float], low: float = 0.0, high: float = 1e6, grow: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The steps, one row each, the totals of the rates that they lead to, and the targets."""
    k = len(domains)
    history, none = np.zeros((0, k)), np.zeros((1, k))
    # with bounds that hold no rate, every document counts
    totals, grams = _sums(rows, history, none, -np.inf, np.inf)
    total, natural, gram = totals[0], totals[0], grams[0]
    target, base = target_totals(natural, domains, weights, grow), np.maximum(natural, 1.0)
    values, turn = np.linalg.eigh(gram)
    # directions nearly without tokens would make the matrix singular
    half = (turn / np.sqrt(np.maximum(values, max(1e-9 * values[-1], 1.0)))) @ turn.T

    def squares(t: np.ndarray) -> float:
        return float(((half @ (t - target)) ** 2).sum()) / 2
    free = gram if low < 1 < high else np.zeros((k, k))
    while True:
        off = half @ (total - target)
        plain = half @ off
        values, turn = np.linalg.eigh(half @ free @ half)
        near = [half @ (turn @ (values / (values**2 + d) * (turn.T @ off))) for d in DAMPINGS]
        tried = np.array([plain, *(a * plain for a in LONGER), *(a * s for s in near for a in LENGTHS)])
        totals, grams = _sums(rows, history, tried, low, high)
        best = min(range(len(tried)), key=lambda i: squares(totals[i]))
        lower = squares(total) - squares(totals[best])
        done = np.abs((totals[0] - total) / base).max() <= TOLERANCE or (len(history) and lower <= STILL * squares(total))
        if done and len(history):
            return history, total, target
        # the first step also takes the rates into their bounds
        history, total, free = np.vstack([history, tried[best]]), totals[best], grams[best]
        if done and lower <= 0:
            return history, total, target


def reached(spark: SparkSession, domains: tuple[str, ...], total: np.ndarray, target: np.ndarray) -> DataFrame:
    """``domain, target, total, off`` (relative to the target) of a fit, kept in the shared folder; what is far off is logged."""
    off = (total - target) / np.maximum(target, 1.0)
    for d, o in zip(domains, off.tolist(), strict=True):
        if abs(o) > NOTABLE:
            logging.getLogger(__name__).warning("mixing: the tokens of %s end %+.1f %% from their target", d, 100 * o)
    return saved(spark.createDataFrame(list(zip(domains, target.tolist(), total.tolist(), off.tolist(), strict=True)), "domain string, target double, total double, off double"), "mix-reached")


def mixed(rows: DataFrame, domains: tuple[str, ...], history: np.ndarray, low: float = 0.0, high: float = 1e6) -> DataFrame:
    """``doc_id, text_hash, n_tokens, domain, posterior, rate, copies``; ``copies`` is the rate rounded by the hash of the id."""
    k = len(domains)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, p = _arrays(batch, k)
            best = [domains[i] for i in p.argmax(axis=1)] if len(p) else []
            arrays = [*(batch.column(c) for c in ("doc_id", "text_hash", "n_tokens", "posterior")), pa.array(best, pa.string()), pa.array(rates(p, history, low, high))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_hash", "n_tokens", "posterior", "domain", "rate"])
    unit = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 30)) / float(1 << 30)
    return rows.mapInArrow(each, f"{POSTERIORS}, domain string, rate double").withColumn("copies", F.floor(F.col("rate") + unit).cast("int"))


def mix(docs: DataFrame, labels: DataFrame, weights: dict[str, float], low: float = 0.0, high: float = 1e6, grow: bool = False) -> DataFrame:
    model = train(docs, labels)
    rows = saved(posteriors(docs, model), "mix-posteriors")
    history, total, target = fit_rates(rows, model.domains, weights, low, high, grow)
    reached(docs.sparkSession, model.domains, total, target)
    return mixed(rows, model.domains, history, low, high)


def label_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, y`` of rated documents: toxic, low quality, or the language of a good one."""
    rated = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality")).withColumnRenamed("doc_id", "_id")
    y = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, F.col("lang"))
    return docs.select("doc_id", "lang").join(rated, F.col("doc_id") == F.col("_id")).select("doc_id", y.alias("y")).where("y IS NOT NULL")


def digest(mixed_rows: DataFrame) -> DataFrame:
    return mixed_rows.select("doc_id", "n_tokens", "domain", "posterior", "rate", "copies")


def repeated(docs: DataFrame, model: DomainModel, history: np.ndarray, low: float, high: float) -> DataFrame:
    """The rows of ``docs``, columns unchanged, each as often as its ``copies``."""
    return copied(with_posteriors(docs, model), docs.columns, len(model.domains), history, low, high)


def copied(scored: DataFrame, columns: list[str], n_domains: int, history: np.ndarray, low: float, high: float) -> DataFrame:
    """The rows of ``scored`` without their posteriors, each as often as its rate, rounded by the hash of the id, says."""
    unit = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 << 30)) / float(1 << 30)
    own = list(range(len(columns)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(len(columns)).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_domains)
            copies = np.floor(rates(p, history, low, high) + batch.column(len(columns) + 1).to_numpy(zero_copy_only=False)).astype(int)
            yield batch.select(own).take(pa.array(np.repeat(np.arange(len(copies)), copies), pa.int64()))
    kept = scored.select(*columns, scored.columns[-1], unit.alias("_unit"))
    return kept.mapInArrow(each, scored.select(*columns).schema)


def with_posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """``docs`` with the number of words and the posterior as the two last columns, under names of their own."""
    columns, extra = docs.columns, "_"
    while f"{extra}posterior" in columns or f"{extra}n_tokens" in columns:
        extra += "_"
    at, own = columns.index("text"), list(range(len(columns)))
    names = [*columns, f"{extra}n_tokens", f"{extra}posterior"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, p = model.posteriors(batch.column(at))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in own), pa.array(words), _lists(p)], names=names)
    schema = T.StructType([*docs.schema.fields, T.StructField(names[-2], T.LongType()), T.StructField(names[-1], T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(each, schema)


def mixed_documents(docs: DataFrame, labels: DataFrame, weights: dict[str, float], low: float = 0.0, high: float = 1e6, grow: bool = False) -> DataFrame:
    """Texts are scored once: the fit and the copies both read what the scoring wrote."""
    model = train(docs, labels)
    scored = saved(with_posteriors(docs, model), "mix-scored")
    tokens, posterior = scored.columns[-2:]
    history, total, target = fit_rates(scored.select(F.col(tokens).alias("n_tokens"), F.col(posterior).alias("posterior")), model.domains, weights, low, high, grow)
    reached(docs.sparkSession, model.domains, total, target)
    return copied(scored, docs.columns, len(model.domains), history, low, high)
