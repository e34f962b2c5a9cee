import numpy as np
import pytest

from meterline.llm import neighbours
from meterline.llm.common import table

ROWS = "vec_id bigint, embedding array<float>, rank string, score string, shell string, cell string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "r", "s", "t", "u") for i, v in vectors], ROWS)


def brute(vectors, queries, k=20):
    out = {}
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], dtype=np.float32).astype(float)
    for i, q in queries:
        s = (x * np.asarray(q, dtype=np.float32).astype(float)).sum(axis=1)
        own = ids != i
        order = np.lexsort((ids[own], -s[own]))[:k]
        out[i] = list(zip(ids[own][order].tolist(), s[own][order].tolist()))
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("part_rows", [neighbours.PART_ROWS, 100])
def test_recall_on_the_table(ready, part_rows):
    rows = table(ready, "/root/testdata/sf0.1", "embeddings")
    vectors = [(r.vec_id, r.embedding) for r in rows.collect()]
    want = brute(vectors, [v for v in vectors if v[0] % 20 == 0])
    got = answers(neighbours.search(neighbours.build(rows, part_rows=part_rows), rows.where("vec_id % 20 = 0")))
    assert got.keys() == want.keys() and recall(got, want) >= 0.95
    for q in want:
        assert [s for _, s in got[q]] == sorted((s for _, s in got[q]), reverse=True)
        products = dict(brute(vectors, [(q, dict(vectors)[q])], len(vectors))[q])
        assert all(abs(products[i] - s) < 1e-14 for i, s in got[q])


def test_clusters_are_searched_in_part_and_found(ready):
    """Where vectors lie close together, most blocks are left out and the nearest are still found."""
    draw = np.random.default_rng(1)
    centres = draw.standard_normal((40, 32))
    v = centres[draw.integers(40, size=6000)] + 0.1 * draw.standard_normal((6000, 32))
    vectors = [(i, x.tolist()) for i, x in enumerate(v / np.linalg.norm(v, axis=1)[:, None])]
    rows = frame(ready, vectors)
    index = neighbours.build(rows, sample_rows=2000, part_rows=150)
    queries = rows.where("vec_id % 20 = 0")
    want = brute(vectors, vectors[::20])
    assert recall(answers(neighbours.search(index, queries)), want) >= 0.9
    visits = neighbours.packs(index, queries.where("vec_id % 1000 = 0"), 20).selectExpr("size(places)").first()[0]
    assert len(index.tree.low) > 20 and 0 < visits < len(index.tree.low)


def test_lengths_of_all_sizes(ready):
    """The largest products come from long vectors; short ones lie in shells of their own."""
    draw = np.random.default_rng(2)
    v = draw.standard_normal((3000, 12)) * np.exp(draw.uniform(-8, 8, (3000, 1)))
    vectors = [(i, x.tolist()) for i, x in enumerate(v)]
    got = answers(neighbours.search(neighbours.build(frame(ready, vectors), sample_rows=500, part_rows=200), frame(ready, vectors[::20])))
    assert recall(got, brute(vectors, vectors[::20])) >= 0.95


def test_ties_and_a_third_of_equal_vectors(ready):
    draw = np.random.default_rng(3)
    v = [x / np.linalg.norm(x) for x in draw.standard_normal((600, 8))]
    vectors = [(i, (v[0] if i % 3 == 0 else v[i]).tolist()) for i in range(600)]
    rows = frame(ready, vectors + vectors[:30])
    got = answers(neighbours.search(neighbours.build(rows, sample_rows=200, part_rows=50), rows.where("vec_id % 20 = 0")))
    want = brute(vectors, vectors[::20])
    # of equal products the smaller ids come first
    assert got[0] == want[0] and got[60] == want[60] and recall(got, want) >= 0.95


def test_stop_value():
    draw = np.random.default_rng(4).standard_normal((200_000, 8))
    for sure in (0.5, 0.9, 0.97):
        assert abs(((draw**2).sum(axis=1) <= neighbours.chi_square(sure, 8)).mean() - sure) < 0.005


def test_tree():
    points = np.random.default_rng(5).standard_normal((500, 3))
    points[100:300] = points[0]
    tree, leaves = neighbours.grow(points, 10)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(500)) and max(len(n) for n in leaves if len(np.unique(points[n], axis=0)) > 1) <= 10
    assert all((tree.leaf_of(points)[n] == i).all() for i, n in enumerate(leaves))
    near = tree.distances(points)
    assert (near[np.arange(500), tree.leaf_of(points)] == 0).all()
    for i, n in enumerate(leaves):
        assert (near[:, i] <= ((points[:, None] - points[n]) ** 2).sum(axis=2).min(axis=1) + 1e-12).all()


def test_odd_rows(ready):
    good = [(i, v) for i, v in enumerate(np.random.default_rng(6).standard_normal((15, 3)).astype(np.float32).tolist())]
    bad = [(20, None), (40, []), (60, [1, None, 2]), (80, [1, float("nan"), 2]), (100, [float("inf"), 0, 0]), (120, [0, 0, 0]), (140, [1, 2]), (None, [1, 2, 3])]
    rows = frame(ready, good + bad + good[:3])
    index = neighbours.build(rows)
    got = answers(neighbours.search(index, rows))
    want = brute(good, good)
    assert got.keys() == set(range(15)) and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)
    assert all(len(got[q]) == 14 for q in got)
    empty = frame(ready, [])
    assert neighbours.search(neighbours.build(empty), empty).count() == 0 and neighbours.search(index, empty).count() == 0
    assert neighbours.search(neighbours.build(empty), rows).count() == 0 and neighbours.search(neighbours.build(frame(ready, bad)), rows).count() == 0
    # two rows of one id are two queries
    two = frame(ready, [(0, good[0][1]), (0, good[1][1])])
    assert neighbours.search(index, two).count() == 28
