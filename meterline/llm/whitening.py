"""Whitening of embeddings with principal components.

Entries become whole numbers, so every sum over rows is exact and no order of adding changes a bit. Two passes over the
distinct vectors give the sums per dimension and the products of the entries centred at the rounded mean; what rounding left over
is taken off exactly. The covariance matrix has the size of the dimensions, whatever the rows, and is taken apart by the driver:
Householder reflections make it tridiagonal, bisection on Sturm counts finds the leading eigenvalues, inverse iteration their
vectors, made orthogonal inside clusters of close eigenvalues. The few components go to every task, which project its rows.

Defined results: rows take part as told in :func:`vectors.usable`, and if every entry, scaled, fits 62 bits; repeated rows are
fitted once and each returned; components without variance (under ``RANK`` of the largest) are not returned, so that
a table of equal vectors has no rows, like an empty one; a ``deviation`` beyond 64 bits is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import saved
from meterline.llm.vectors import matrix, usable

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
#: Eigenvalues below this part of the largest are no variance but rounding.
RANK = 1e-12
#: Eigenvalues closer than this part of the matrix norm are a cluster.
CLUSTER = 1e-3
LIMB = 31
LARGEST = float(1 << 62)
OUT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double"


@dataclass(frozen=True)
class Fit:
    n: int
    sums: tuple[int, ...]  # per dimension, over the distinct vectors
    trace: float
    values: np.ndarray  # leading eigenvalues, falling
    vectors: np.ndarray  # one column each


def whole(rows: DataFrame) -> DataFrame:
    """``vec_id, x``: entries as whole numbers."""
    scaled = F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))))
    fits = F.forall("v", lambda c: F.abs(c * F.lit(float(SCALE))) < F.lit(LARGEST))
    return usable(rows).where(fits).select("vec_id", F.transform(scaled, lambda c: c + F.lit(SHIFT)).alias("x"))


def _limbs(at: int, value: int) -> Iterator[tuple[int, int, int]]:
    """A whole number of any size as (place, limb, part) with parts that fit a sum of longs."""
    sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield at, limb, sign * (value & ((1 << LIMB) - 1))
        value, limb = value >> LIMB, limb + 1


def exact_sums(rows: DataFrame, part, width: int) -> list[int]:
    """Sums over all rows of what ``part`` makes of a batch's matrix, exact at any size: ``width`` whole numbers."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, top = np.zeros(width, dtype=object), np.zeros(width, dtype=np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            found = part(matrix(batch.column("x")))
            if found.dtype == object:
                total += found
                continue
            # longs hold the sum for as long as none can overflow
            found = found.astype(np.int64)
            top += int(np.abs(found).max())
            if top >> 62:
                total, held, top = total + held, np.zeros(width, dtype=np.int64), int(np.abs(found).max())
            held += found
        total = [int(v) for v in total + held]
        found = [limb for at, value in enumerate(total) for limb in _limbs(at, value)]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64()))], names=["at", "limb", "part"])
    out = [0] * width
    for at, limb, value in rows.select("x").mapInArrow(each, "at int, limb int, part bigint").groupBy("at", "limb").agg(F.sum("part")).collect():
        out[at] += value << (LIMB * limb)
    return out


def centred(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """``x - middle`` as whole numbers: doubles where they and the sums of their products are exact, else Python's."""
    y = x.astype(object) - middle if max(abs(int(x.max())), abs(int(x.min())), *map(abs, middle.tolist())) >> 61 else x - middle.astype(np.int64)
    top = max(abs(int(y.max())), abs(int(y.min())))
    return y.astype(float) if top * top * len(y) < 1 << 52 else y.astype(object)


def covariance(distinct: DataFrame, n: int, sums: tuple[int, ...]) -> list[list[Fraction]]:
    """Exact. Entries are centred at the whole number next to their mean before they are multiplied."""
    d = len(sums)
    middle = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=object)
    upper = np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        y = centred(x, middle)
        return (y.T @ y)[upper]
    found = exact_sums(distinct, products, len(upper[0]))
    off = [s - n * int(m) for s, m in zip(sums, middle.tolist(), strict=True)]
    out = [[Fraction(0)] * d for _ in range(d)]
    for i, j, value in zip(*(u.tolist() for u in upper), found, strict=True):
        out[i][j] = out[j][i] = Fraction(n * value - off[i] * off[j], n * n)
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, subdiagonal and Householder vectors of a symmetric matrix."""
    a, d, mirrors = a.copy(), len(a), []
    for k in range(d - 2):
        v = a[k + 1:, k].copy()
        norm = np.linalg.norm(v)
        if norm:
            v[0] += math.copysign(norm, v[0])
            v /= np.linalg.norm(v)
            block = a[k + 1:, k + 1:]
            p = block @ v
            w = p - (v @ p) * v
            block -= 2 * (np.outer(v, w) + np.outer(w, v))
            a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        mirrors.append(v)
    return a.diagonal().copy(), a.diagonal(-1).copy(), mirrors


def below(diagonal: np.ndarray, off2: np.ndarray, x: np.ndarray, least: float) -> np.ndarray:
    """Sturm count: eigenvalues under each of ``x``."""
    q, n = diagonal[0] - x, (diagonal[0] - x < 0).astype(int)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < least, -least, q)
        q = diagonal[i] - x - off2[i - 1] / q
        n += q < 0
    return n


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues of a tridiagonal matrix, falling, by bisection until no double lies between."""
    d = len(diagonal)
    reach = np.concatenate([[0], np.abs(off)]) + np.concatenate([np.abs(off), [0]])
    norm = max(float(np.abs(diagonal).max() + reach.max()), np.finfo(float).tiny)
    low, high = np.full(k, (diagonal - reach).min() - norm * 1e-15), np.full(k, (diagonal + reach).max() + norm * 1e-15)
    wanted = d - 1 - np.arange(k)  # so many eigenvalues are smaller
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            return middle
        more = below(diagonal, off * off, middle, norm * 1e-300 + np.finfo(float).tiny) > wanted
        low, high = np.where(more, low, middle), np.where(more, middle, high)


def solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solve the shifted tridiagonal system by elimination with row exchanges."""
    d = len(diagonal)
    main, up, up2, b = diagonal - shift, np.append(off, 0.0), np.zeros(d), b.copy()
    for i in range(d - 1):
        under = off[i]
        if abs(under) > abs(main[i]):
            # exchange rows i and i + 1
            main[i], under, up[i], main[i + 1] = under, main[i], main[i + 1], up[i]
            up2[i], up[i + 1] = up[i + 1], 0.0
            b[i], b[i + 1] = b[i + 1], b[i]
        main[i] = main[i] or least
        f = under / main[i]
        main[i + 1] -= f * up[i]
        up[i + 1] -= f * up2[i]
        b[i + 1] -= f * b[i]
    main[-1] = main[-1] or least
    x = np.zeros(d)
    for i in range(d - 1, -1, -1):
        x[i] = (b[i] - (up[i] * x[i + 1] if i + 1 < d else 0.0) - (up2[i] * x[i + 2] if i + 2 < d else 0.0)) / main[i]
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors as columns; those of close eigenvalues are kept orthogonal to each other."""
    d, norm = len(diagonal), max(float(np.abs(diagonal).max()), float(np.abs(off).max(initial=0)), np.finfo(float).tiny)
    draw, out = np.random.default_rng(0), np.zeros((d, len(values)))
    for k, value in enumerate(values):
        near = [j for j in range(k) if values[j] - value < CLUSTER * norm]
        x = draw.standard_normal(d)
        for _ in range(4):
            for _ in range(2):
                x -= out[:, near] @ (out[:, near].T @ x)
            x = solve(diagonal, off, value, x / np.linalg.norm(x), norm * np.finfo(float).eps)
            x /= np.abs(x).max()
        for _ in range(2):
            x -= out[:, near] @ (out[:, near].T @ x)
        out[:, k] = x / np.linalg.norm(x)
    return out


def leading_pairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    diagonal, off, mirrors = tridiagonal(a)
    values = leading_values(diagonal, off, min(k, len(a)))
    # a split matrix has exact zeros, at which a block knows nothing of the others; they are no obstacle to elimination
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(mirrors) - 1, -1, -1):
        v = mirrors[i]
        vectors[i + 1:] -= 2 * np.outer(v, v @ vectors[i + 1:])
    return values, vectors / np.linalg.norm(vectors, axis=0)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Components of a table of distinct ``x``, none without variance; nothing but sums over all rows comes to the driver."""
    head = distinct.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = head["n"], head["d"]
    if not n:
        return None
    sums = tuple(exact_sums(distinct, lambda x: (x if np.abs(x).max() * float(len(x)) < 2.0**62 else x.astype(object)).sum(axis=0), d))
    exact = covariance(distinct, n, sums)
    trace = float(sum(exact[i][i] for i in range(d)))
    if not trace:
        return None
    values, vectors = leading_pairs(np.array([[float(v) for v in row] for row in exact]), components)
    kept = values > RANK * values[0]
    return Fit(n, sums, trace, values[kept], vectors[:, kept])


def offsets(x: np.ndarray, model: Fit) -> tuple[np.ndarray, np.ndarray | list]:
    """``x - S/n`` as doubles, from the exact whole ``n*x - S``, and the sums of the squares of those."""
    middle = np.array([(2 * s + model.n) // (2 * model.n) for s in model.sums], dtype=object)
    rest = np.array([s - model.n * m for s, m in zip(model.sums, middle.tolist(), strict=True)], dtype=object)
    y = x.astype(object) - middle if max(map(abs, middle.tolist())) >> 61 or int(np.abs(x).max()) >> 61 else x - middle.astype(np.int64)
    top = max(abs(int(y.max())), abs(int(y.min()))) * model.n + max(map(abs, rest.tolist()))
    if top * top * x.shape[1] < 1 << 63:
        whole_off = y.astype(np.int64) * model.n - rest.astype(np.int64)
        return whole_off / model.n, (whole_off * whole_off).sum(axis=1).tolist()
    whole_off = y.astype(object) * model.n - rest
    squares = [v if v < 1 << 63 else None for v in (whole_off * whole_off).sum(axis=1).tolist()]
    return (whole_off / model.n).astype(float), squares


def whitened(rows: DataFrame, model: Fit) -> DataFrame:
    """One row per row of ``vec_id, x`` and component."""
    k, filters = len(model.values), model.vectors / np.sqrt(model.values)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            off, squares = offsets(matrix(batch.column("x")), model)
            again = pa.array(np.repeat(np.arange(len(off)), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(off))),
                pa.array(np.full(len(again), model.n)), pa.array(squares, pa.int64()).take(again), pa.array((off @ filters).ravel())],
                names=["vec_id", "component", "n", "deviation", "whitened"])
    return rows.mapInArrow(each, OUT)


def identity_error(distinct: DataFrame, model: Fit) -> float:
    """How far the covariance of the whitened distinct vectors is from the identity matrix, measured on them."""
    k, filters = len(model.values), model.vectors / np.sqrt(model.values)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows are centred already, before they are multiplied; the sums take off what rounding left
        sums = np.zeros(k + k * k)
        for batch in batches:
            if batch.num_rows:
                w = offsets(matrix(batch.column("x")), model)[0] @ filters
                sums += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["at", "part"])
    total = np.zeros(k + k * k)
    for at, value in distinct.select("x").mapInArrow(each, "at int, part double").groupBy("at").agg(F.sum("part")).collect():
        total[at] = value / model.n
    mean = total[:k]
    return float(np.abs(total[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    x = saved(whole(rows), "whiten-x")
    # equal vectors become one where they are read, before the shuffle
    distinct = saved(x.select("x").distinct(), "whiten-distinct")
    model = fit(distinct, components)
    if model is None:
        return x.limit(0).select(
            "vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (
                ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))])
    shares = F.array(*[F.lit(float(v)) for v in model.values / model.trace])
    return whitened(x, model).withColumns({"explained": F.element_at(shares, F.col("component")), "identity_error": F.lit(identity_error(distinct, model))})


def digest(whitened_rows: DataFrame) -> DataFrame:
    return whitened_rows.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
