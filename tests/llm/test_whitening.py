import math

import numpy as np
import pytest

from meterline.llm import whitening
from meterline.llm.common import table
from tests.llm.conftest import SF_DIR

ROWS = "vec_id bigint, embedding array<float>, x string, component string, n int, d int"


def frame(spark, vectors, kind="float"):
    rows = [(i, v, "x", "c", 1, 2) for i, v in vectors]
    return spark.createDataFrame(rows, ROWS.replace("float", kind))


def brute(vectors):
    """Numpy's own decomposition of the covariance of the distinct whole vectors."""
    x = np.floor(64 * np.array([v for _, v in vectors], dtype=np.float32).astype(float)) + 1_000_000
    d = np.unique(x, axis=0)
    values, vectors_ = np.linalg.eigh(np.cov((d - 1e6).T, bias=True))
    keep = min(16, x.shape[1])
    values, vectors_ = values[::-1][:keep], vectors_[:, ::-1][:, :keep]
    whole = [[int(v) for v in row] for row in x]
    sums = [sum(int(v) for v in d[:, j]) for j in range(d.shape[1])]
    deviation = [sum((len(d) * v - s) ** 2 for v, s in zip(row, sums)) for row in whole]
    return len(d), deviation, (x - 1e6 - (d - 1e6).mean(axis=0)) @ vectors_ / np.sqrt(values), values / np.cov((d - 1e6).T, bias=True).trace()


def check(df, vectors):
    n, deviation, white, shares = brute(vectors)
    got = whitening.digest(whitening.whiten(df)).toPandas().sort_values(["vec_id", "component"])
    k = white.shape[1]
    assert len(got) == len(vectors) * k and set(got.n) == {n} and got.component.tolist() == list(range(1, k + 1)) * len(vectors)
    order = np.argsort([i for i, _ in vectors], kind="stable")
    assert got.deviation.tolist()[::k] == [deviation[i] for i in order]
    mine = got.whitened.to_numpy().reshape(-1, k)
    sign = np.sign((mine * white[order]).sum(axis=0))
    assert np.allclose(mine * sign, white[order], atol=1e-9) and np.allclose(got.explained.to_numpy()[:k], shares, rtol=1e-10)
    assert got.identity_error.max() < 1e-9 and got.identity_error.nunique() == 1


def test_equals_numpy_on_the_table(ready):
    rows = table(ready, SF_DIR, "embeddings")
    check(rows, [(r.vec_id, r.embedding) for r in rows.collect()])


def test_repeated_rows_count_once_in_the_fit(ready):
    draw = np.random.default_rng(1)
    vectors = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((60, 5)))]
    check(frame(ready, vectors + [(100 + i, vectors[0][1]) for i in range(300)]), vectors + [(100 + i, vectors[0][1]) for i in range(300)])


@pytest.mark.parametrize("seed, d", [(0, 1), (1, 2), (2, 3), (3, 20), (4, 40)])
def test_leading_pairs(seed, d):
    """Clusters, exact repeats and zeros among the eigenvalues."""
    draw = np.random.default_rng(seed)
    basis, _ = np.linalg.qr(draw.standard_normal((d, d)))
    for values in (np.arange(d, 0, -1.0), np.ones(d), np.concatenate([[5.0] * (d // 2), 1 + 1e-13 * np.arange(d - d // 2)]), np.r_[[3.0], np.zeros(d - 1)]):
        a = (basis * values) @ basis.T
        a = (a + a.T) / 2
        got, vectors = whitening.leading_pairs(a, 16)
        k = min(16, d)
        assert np.allclose(got, np.sort(np.linalg.eigvalsh(a))[::-1][:k], atol=1e-13 * max(1, values.max()))
        assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-10)
        assert np.allclose(a @ vectors, vectors * got, atol=1e-12 * max(1.0, values.max()))
    diagonal = np.diag(np.arange(1.0, d + 1))
    got, vectors = whitening.leading_pairs(diagonal, 16)
    assert np.allclose(diagonal @ vectors, vectors * got, atol=1e-12)


def test_sums_are_exact_at_any_size(ready):
    """Entries near the limit of 62 bits, whose products pass 64 and 128 bits."""
    vectors = [(1, [2.0**55, 1.0]), (2, [-(2.0**55), 3.0]), (3, [2.0**40, -5.0]), (4, [0.5, 9.0])]
    got = {r.vec_id: r for r in whitening.whiten(frame(ready, vectors, "double")).collect() if r.component == 1}
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in vectors]
    sums = [sum(row[j] for row in x) for j in (0, 1)]
    exact = [sum((4 * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    assert [got[i].deviation for i in (1, 2, 3, 4)] == [e if e < 1 << 63 else None for e in exact]
    assert max(r.identity_error for r in got.values()) < 1e-9


def test_odd_rows(ready):
    draw = np.random.default_rng(2)
    good = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((40, 3)))]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 0.0]), (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0])]
    got = whitening.whiten(frame(ready, good + bad + [(None, good[0][1])])).collect()
    assert {r.vec_id for r in got} == {None, *range(40)}
    check(frame(ready, good + bad), good)
    assert whitening.whiten(frame(ready, bad[:5])).count() == 0 and whitening.whiten(frame(ready, [])).count() == 0
    same = whitening.whiten(frame(ready, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    assert same.count() == 0 and same.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # one direction of variance is one component
    assert {r.component for r in whitening.whiten(frame(ready, [(i, [float(i), 2.0 * i]) for i in range(9)])).collect()} == {1}
