"""Nearest neighbours by largest inner product: stable projections in kd-trees, verified until a chi-square test stops.

Vectors are divided by the largest length of their shell (lengths within a factor of two) and filled up with one more entry to
length 1. Then the squared distance to a query of length 1 is ``2 - 2 s`` for the scaled inner product ``s``, so the nearest points
have the largest products. Projected on ``DIMENSIONS`` vectors of a normal (2-stable) distribution, a pair at distance ``t`` is at
a projected distance ``r`` with ``(r / t)^2`` chi-square distributed. Points are verified by growing projected distance; once
``chi2((r / t)^2) >= SURE`` for the distance ``t`` of the 20th best so far, a nearer point would have come up by then with
at least that chance, and the search stops.

The index deals all rows into cells, the leaves of a kd-tree over projected points (fitted on a bounded sample), and cells into
parts of a bounded number of rows. A part's rows lie in blocks, and a block has a kd-tree of its own. A query starts with the
20th best product in the sample, which bounds the final one, and is sent only to parts of cells within the distance at which
the test would stop; there it visits leaves by growing distance and its bound shrinks from block to block. Queries are
packed, so a block is read once for many. All verified products are exact sums in double precision.

Defined results: rows take part as told in :func:`vectors.usable`, if they also have an id and any entry that is not zero; a
row twice in the table counts once; a query's own id is no candidate; fewer candidates than wanted give fewer rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from meterline.llm.common import saved
from meterline.llm.vectors import matrix, usable

NEAREST = 20
DIMENSIONS = 8
#: Chance with which a nearer point would have been seen when a search stops.
SURE = 0.97
#: Rows of the sample that fits the top tree and gives the first bounds, about; by the hash of the row.
SAMPLE_ROWS = 8192
#: Rows of a part, sample rows of a cell at least, and rows of a leaf at most.
PART_ROWS, CELL_SAMPLE, LEAF_ROWS = 1 << 14, 16, 1 << 7
#: Entries of the vectors of a block and of a pack of queries at most.
BLOCK_ENTRIES, PACK_ENTRIES = 1 << 18, 1 << 15
#: Candidates whose exact products are summed at a time.
EXACT_ROWS = 1 << 16
#: Products of matrices are this close to the exact sum, relative to the lengths.
CLOSE = 1e-12
SEED = 13
BLOCK = "shell int, cell int, part string, ids binary, vectors binary, points binary"
PACKED = "pack string, places array<struct<shell:int,cell:int>>, ids binary, marks binary, vectors binary, points binary, bounds binary"


@dataclass(frozen=True)
class Tree:
    """A kd-tree: splits, children, and the boxes of its leaves."""
    axis: np.ndarray  # -1 at a leaf
    at: np.ndarray
    child: np.ndarray  # left child, the right one follows; at a leaf its number
    low: np.ndarray
    high: np.ndarray

    def leaf_of(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), dtype=np.int64)
        while len(inner := np.flatnonzero(self.axis[node] >= 0)):
            n = node[inner]
            node[inner] = self.child[n] + (p[inner, self.axis[n]] > self.at[n])
        return self.child[node]

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distances of points to the boxes, one row per point."""
        out = np.zeros((len(q), len(self.low)))
        for d in range(q.shape[1]):
            gap = np.maximum(np.maximum(self.low[:, d] - q[:, d, None], q[:, d, None] - self.high[:, d]), 0.0)
            out += gap * gap
        return out


def grow(points: np.ndarray, most: int) -> tuple[Tree, list[np.ndarray]]:
    """Split at medians of the widest axis until a leaf has at most ``most`` points or only equal ones; the points of each leaf.

    The boxes share out the whole space, so that other points have a leaf, too.
    """
    m = points.shape[1]
    axis, at, child, leaves, boxes = [-1], [0.0], [0], [], []
    todo = [(0, np.arange(len(points)), np.full(m, -np.inf), np.full(m, np.inf))]
    while todo:
        node, own, low, high = todo.pop()
        spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(m)
        d = int(spread.argmax())
        if len(own) <= most or not spread[d]:
            child[node] = len(leaves)
            leaves.append(own)
            boxes.append((low, high))
            continue
        values = points[own, d]
        cut = float(np.median(values))
        if cut >= values.max():
            cut = float(values[values < cut].max())
        axis[node], at[node], child[node] = d, cut, len(axis)
        axis += [-1, -1]
        at += [0.0, 0.0]
        child += [0, 0]
        below, above = high.copy(), low.copy()
        below[d] = above[d] = cut
        right = values > cut
        todo += [(child[node], own[~right], low, below), (child[node] + 1, own[right], above, high)]
    low, high = (np.array([b[i] for b in boxes]) for i in (0, 1))
    return Tree(np.array(axis), np.array(at), np.array(child), low, high), leaves


def chi_square(sure: float, dimensions: int) -> float:
    """Where the chi-square distribution of an even number of degrees of freedom reaches ``sure``."""
    def rest(x: float) -> float:
        return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dimensions // 2))
    low, high = 0.0, 1e3
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if rest(middle) > 1 - sure else (low, middle)
    return high


def lengths(v: np.ndarray) -> np.ndarray:
    top = np.abs(v).max(axis=1, initial=0.0)
    return top * np.sqrt(((v / np.where(top, top, 1)[:, None]) ** 2).sum(axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of equal rows, each added in the same order, so that equal vectors have equal products."""
    return np.concatenate([(a[i: i + EXACT_ROWS] * b[i: i + EXACT_ROWS]).sum(axis=1) for i in range(0, len(a), EXACT_ROWS)] or [np.zeros(0)])


@dataclass(frozen=True)
class Index:
    blocks: DataFrame  # every row of the table, packed
    d: int
    projection: np.ndarray
    longest: dict[int, float]  # by shell
    tree: Tree  # of cells
    sample_ids: np.ndarray
    sample: np.ndarray
    stop: float  # chi-square value at which a search stops

    def radius2(self, bound: np.ndarray, length: np.ndarray, shell: int) -> np.ndarray:
        """Squared projected distance at which the test stops a search; negative where no point of the shell is as near."""
        t2 = 2 - 2 * bound / (length * self.longest[shell])
        return np.where(t2 < -CLOSE, -1.0, np.maximum(t2, 0) * self.stop + CLOSE)


def take_part(rows: DataFrame, d: int | None = None) -> DataFrame:
    """``vec_id, v`` of the rows that take part, each once."""
    return usable(rows, d=d).where(F.col("vec_id").isNotNull() & F.exists("v", lambda c: c != 0)).dropDuplicates(["vec_id", "v"])


def shelled(rows: DataFrame) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = lengths(matrix(batch.column("v")))
                shell = np.floor(np.log2(n) + 0.5).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shell), pa.array(n)], names=["vec_id", "v", "shell", "length"])
    return rows.mapInArrow(each, "vec_id bigint, v array<double>, shell int, length double")


def placed(v: np.ndarray, shells: np.ndarray, longest: dict[int, float], projection: np.ndarray) -> np.ndarray:
    """Projections of vectors, scaled by their shell and filled up to length 1."""
    scaled = v / np.array([longest[s] for s in shells.tolist()])[:, None]
    rest = np.sqrt(np.maximum(1 - lengths(scaled) ** 2, 0.0))
    return scaled @ projection[:-1] + rest[:, None] * projection[-1]


def build(rows: DataFrame, sample_rows: int = SAMPLE_ROWS, part_rows: int = PART_ROWS, dimensions: int = DIMENSIONS, sure: float = SURE) -> Index:
    table = saved(shelled(take_part(rows)), "ann-rows")
    by_shell = table.groupBy("shell").agg(F.max("length").alias("longest"), F.count("*").alias("n"), F.max(F.size("v")).alias("d")).collect()
    longest, n, d = {r["shell"]: r["longest"] for r in by_shell}, sum(r["n"] for r in by_shell), max((r["d"] for r in by_shell), default=0)
    share = min(1.0, sample_rows / max(n, 1))
    picked = table.where(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1_000_000)) < int(share * 1_000_000)).toArrow()
    projection = np.random.default_rng(SEED).standard_normal((d + 1, dimensions))
    sample = matrix(picked.column("v").combine_chunks()) if picked.num_rows else np.zeros((0, d))
    points = placed(sample, picked.column("shell").to_numpy(), longest, projection) if picked.num_rows else np.zeros((0, dimensions))
    tree, _ = grow(points, max(CELL_SAMPLE, math.ceil(len(sample) * part_rows / max(n, 1))))

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = placed(matrix(batch.column("v")), batch.column("shell").to_numpy(), longest, projection)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("vec_id", "v", "shell")), pa.array(tree.leaf_of(p).astype(np.int32)), pa.array(list(p), pa.list_(pa.float64()))],
                    names=["vec_id", "v", "shell", "cell", "p"])
    cells = table.mapInArrow(to_cells, "vec_id bigint, v array<double>, shell int, cell int, p array<double>").withColumn("salt", F.xxhash64("vec_id", "v"))
    in_order = cells.repartitionByRange("shell", "cell", "salt").sortWithinPartitions("shell", "cell", "salt", "vec_id")
    block_rows = max(1, BLOCK_ENTRIES // max(d, 1))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (shell, cell, run) in enumerate(runs(batches, ("shell", "cell"), block_rows)):
            part = f"{task()}-{shell}-{cell}-{number * block_rows // part_rows}"
            yield pa.RecordBatch.from_arrays([
                pa.array([shell], pa.int32()), pa.array([cell], pa.int32()), pa.array([part]), *(pa.array([b]) for b in (
                    run["vec_id"].to_numpy().tobytes(), matrix(run["v"]).tobytes(), matrix(run["p"]).tobytes()))],
                names=["shell", "cell", "part", "ids", "vectors", "points"])
    blocks = saved(in_order.mapInArrow(pack, BLOCK), "ann-blocks")
    return Index(blocks, d, projection, longest, tree, picked.column("vec_id").to_numpy(), sample, chi_square(sure, dimensions))


def task() -> int:
    from pyspark import TaskContext
    context = TaskContext.get()
    return context.partitionId() if context else 0


def runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], most: int) -> Iterator[tuple]:
    """Rows with equal keys that follow each other, ``most`` at a time, as (keys..., columns by name)."""
    held, held_key, size = [], None, 0

    def out() -> tuple:
        whole = pa.Table.from_batches(held).combine_chunks()
        return (*held_key, {c: whole.column(c).combine_chunks() for c in whole.column_names})
    for batch in batches:
        found = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in found], axis=0)) + 1 if batch.num_rows > 1 else []
        edges = [0, *new, batch.num_rows]
        for start, end in zip(edges, edges[1:], strict=False):
            at = start
            while at < end:
                key = tuple(int(k[at]) for k in found)
                if held and (key != held_key or size >= most):
                    yield out()
                    held, size = [], 0
                take = min(end - at, most - size)
                held.append(batch.slice(at, take))
                held_key, size, at = key, size + take, at + take
    if held:
        yield out()


def first_bounds(index: Index, ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th best product of every query in the sample, less what rounding may do."""
    if len(index.sample) <= k:
        return np.full(len(q), -np.inf)
    s = q @ index.sample.T
    s[ids[:, None] == index.sample_ids] = -np.inf
    best = np.partition(s, len(index.sample) - k, axis=1)[:, len(index.sample) - k]
    return best - CLOSE * lengths(q) * max(index.longest.values())


def packs(index: Index, queries: DataFrame, k: int) -> DataFrame:
    """Queries by nearness in packs, each with the cells that any of its queries has to visit."""
    most = max(1, PACK_ENTRIES // max(index.d, 1))
    frame = take_part(queries, index.d)
    # the sample and the tree are bounded by their parameters; the table of blocks stays behind
    plain = Index(None, index.d, index.projection, index.longest, index.tree, index.sample_ids, index.sample, index.stop)

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                q = matrix(batch.column("v"))
                p = (q / lengths(q)[:, None]) @ plain.projection[:-1]
                ids = batch.column("vec_id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(plain.tree.leaf_of(p).astype(np.int32)), pa.array(list(p), pa.list_(pa.float64())), pa.array(first_bounds(plain, ids, q, k))],
                    names=["vec_id", "v", "cell", "p", "bound"])
    known = frame.mapInArrow(bounds, "vec_id bigint, v array<double>, cell int, p array<double>, bound double")
    # neighbours share packs: their cells are much the same
    in_order = known.withColumn("salt", F.xxhash64("vec_id", "v")).repartitionByRange("cell", "salt").sortWithinPartitions("cell", "salt", "vec_id").withColumn("one", F.lit(0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (_, run) in enumerate(runs(batches, ("one",), most)):
            q, p, bound = matrix(run["v"]), matrix(run["p"]), run["bound"].to_numpy()
            near, length = plain.tree.distances(p), lengths(q)
            places = [{"shell": s, "cell": int(c)} for s in plain.longest for c in np.flatnonzero((near <= plain.radius2(bound, length, s)[:, None]).any(axis=0))]
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{task()}-{number}"]), pa.array([places], pa.list_(pa.struct([("shell", pa.int32()), ("cell", pa.int32())]))),
                *(pa.array([b]) for b in (run["vec_id"].to_numpy().tobytes(), run["salt"].to_numpy().tobytes(), q.tobytes(), p.tobytes(), bound.tobytes()))],
                names=["pack", "places", "ids", "marks", "vectors", "points", "bounds"])
    return saved(in_order.mapInArrow(pack, PACKED), "ann-packs")


class Search:
    """A pack of queries on its way through blocks: bounds that shrink, and the best so far."""

    def __init__(self, index: Index, ids: np.ndarray, marks: np.ndarray, q: np.ndarray, p: np.ndarray, bound: np.ndarray, k: int):
        self.index, self.ids, self.marks, self.q, self.p, self.bound, self.k = index, ids, marks, q, p, bound.copy(), k
        self.length = lengths(q)
        self.slack = CLOSE * self.length * max(index.longest.values())
        self.top = np.full((len(q), k), -np.inf)
        self.found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))  # query, id, product

    def visit(self, shell: int, ids: np.ndarray, v: np.ndarray, tree: Tree, leaves: list[np.ndarray]) -> None:
        """Verify the leaves of a block in order of distance, each query until its test stops it."""
        near = tree.distances(self.p)
        order = np.argsort(near, axis=1, kind="stable")
        seen = []
        for turn in range(len(leaves)):
            leaf = order[:, turn]
            going = near[np.arange(len(leaf)), leaf] <= self.index.radius2(self.bound, self.length, shell)
            if not going.any():
                break
            got = np.full((len(leaf), max(map(len, leaves))), -np.inf)
            rows = np.zeros(got.shape, dtype=np.int64)
            for n in np.unique(leaf[going]):
                who, own = np.flatnonzero(going & (leaf == n)), leaves[n]
                s = self.q[who] @ v[own].T
                s[self.ids[who][:, None] == ids[own]] = -np.inf
                got[who, : len(own)], rows[who, : len(own)] = s, own
            whole = np.concatenate([self.top, got], axis=1)
            self.top = np.partition(whole, whole.shape[1] - self.k, axis=1)[:, -self.k:]
            self.bound = np.maximum(self.bound, self.top.min(axis=1) - self.slack)
            who, at = np.nonzero(got >= np.maximum(self.bound, -np.finfo(float).max)[:, None])
            seen.append((who, rows[who, at], got[who, at]))
        who, at, s = (np.concatenate([part[i] for part in seen]) if seen else np.zeros(0, np.int64) for i in range(3))
        still = s >= self.bound[who]
        who, at = who[still], at[still]
        exact = np.concatenate([products(self.q[who[i: i + EXACT_ROWS]], v[at[i: i + EXACT_ROWS]]) for i in range(0, len(who), EXACT_ROWS)] or [np.zeros(0)])
        self._keep(who, ids[at], exact)

    def _keep(self, who: np.ndarray, ids: np.ndarray, s: np.ndarray) -> None:
        who, ids, s = (np.concatenate(pair) for pair in zip(self.found, (who, ids, s), strict=True))
        order = np.lexsort((ids, -s, who))
        who, ids, s = who[order], ids[order], s[order]
        first = np.searchsorted(who, np.arange(len(self.q)))
        best = np.arange(len(who)) - first[who] < self.k
        self.found = who[best], ids[best], s[best]


def search(index: Index, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of every query."""
    packed = packs(index, queries, k)
    parts = index.blocks.select("shell", "cell", "part").distinct()
    visits = packed.select("pack", F.inline("places")).join(parts, ["shell", "cell"]).select("pack", "part")
    pairs = visits.join(packed.drop("places"), "pack").join(index.blocks.select("shell", "part", *[F.col(c).alias(f"b_{c}") for c in ("ids", "vectors", "points")]), "part")
    plain = Index(None, index.d, index.projection[:0], index.longest, index.tree, index.sample_ids[:0], index.sample[:0], index.stop)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the blocks of a part follow each other for one pack after the other; whatever comes otherwise is only found with wider bounds
        now, state, trees, tree_part = None, None, {}, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["pack"] != now or row["part"] != tree_part:
                    if state:
                        yield results(state)
                    now = row["pack"]
                    ids, marks, bound = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["marks"], np.int64), np.frombuffer(row["bounds"])
                    state = Search(plain, ids, marks, *(np.frombuffer(row[c]).reshape(len(ids), -1) for c in ("vectors", "points")), bound, k)
                if row["part"] != tree_part:
                    trees, tree_part = {}, row["part"]
                b_ids, points = np.frombuffer(row["b_ids"], np.int64), row["b_points"]
                v, p = (np.frombuffer(b).reshape(len(b_ids), -1) for b in (row["b_vectors"], points))
                key = (len(b_ids), int(b_ids[0]), int(b_ids[-1]), points[:64])
                if key not in trees:
                    trees[key] = grow(p, LEAF_ROWS)
                tree, leaves = trees[key]
                state.visit(row["shell"], b_ids, v, tree, [np.asarray(n) for n in leaves])
        if state:
            yield results(state)

    def results(state: Search) -> pa.RecordBatch:
        who, ids, s = state.found
        return pa.RecordBatch.from_arrays([pa.array(state.ids[who]), pa.array(state.marks[who]), pa.array(ids), pa.array(s)], names=["query_id", "mark", "vec_id", "score"])
    found = pairs.mapInArrow(verify, "query_id bigint, mark bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
