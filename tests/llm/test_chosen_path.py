from collections import Counter, defaultdict

import numpy as np
import pytest

from meterline.llm import chosen_path as cp
from meterline.llm.common import WordHashes, saved
from meterline.llm.graph import components


def brute(rows):
    """Links and smallest member of the class of each row, by comparing all pairs that share a shingle."""
    sets = []
    for _, text in rows:
        w = (text or "").split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    posting = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            posting[g].append(i)
    links, up = Counter(), list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in posting[g] if j > i).items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        lowest[root(i)] = min(lowest.get(root(i), doc_id), doc_id)
    return sorted((doc_id, links[i], lowest[root(i)]) for i, (doc_id, _) in enumerate(rows))


def compare(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted((r.doc_id, r.n_links, r.class_id) for r in cp.near_duplicates(docs).collect())
    assert got == brute(rows)
    return rows


def test_equals_brute_force(docs):
    compare(docs)


@pytest.fixture(scope="module")
def crowd(ready):
    """A large group of near copies in a chain of edits, a common passage, and copies."""
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(260):
        w = list(base)
        for p in rng.integers(0, 120, rng.integers(0, 3)):
            w[p] = f"x{i}_{p}"
        rows.append(" ".join(w))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [f"{passage} " + " ".join(f"u{i}_{j}" for j in range(60)) for i in range(120)]
    rows += [rows[0]] * 40 + ["few words", "few words", "few  words", "other words"]
    return ready.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")


def test_large_groups_and_common_passages(crowd):
    compare(crowd)


def test_large_buckets_split_and_lose_nothing(crowd, monkeypatch):
    monkeypatch.setattr(cp, "LEAF", 40)
    monkeypatch.setattr(cp, "CHUNK", 16)
    compare(crowd)


@pytest.fixture(scope="module")
def contained(ready):
    """Pairs at a similarity of exactly 0.8, one text inside the other; half of them also share a passage with all others."""
    rows = []
    for i in range(300):
        w = [f"s{j}" for j in range(40 * (i % 2))] + [f"t{i}_{j}" for j in range(104)]
        rows += [" ".join(w[:104]), " ".join(w[:84])]
    return ready.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")


@pytest.mark.parametrize("leaf", [2000, 40])
def test_contained_texts_at_the_threshold_are_all_found(contained, monkeypatch, leaf):
    """With small leaves the buckets of the passage are split at every level."""
    monkeypatch.setattr(cp, "LEAF", leaf)
    got = {r.doc_id: (r.n_links, r.class_id) for r in cp.near_duplicates(contained).collect()}
    assert got == {i: (1, i - i % 2) for i in range(600)}


def test_runs_reach_the_recall():
    assert cp.runs_needed() == 8 and cp.runs_needed(0.9) == 2 and cp.runs_needed(levels=0) == 5
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(4000):
        tokens = rng.permutation(180)
        a, b = set(tokens[:90]) | set(tokens[90:100]), set(tokens[:90]) | set(tokens[100:112])
        order = rng.permutation(180)
        missed += not set(sorted(a, key=lambda t: order[t])[:cp.PICKS]) & set(sorted(b, key=lambda t: order[t])[:cp.PICKS])
    assert missed / 4000 < 0.04


def test_contained_sets_and_sketches_meet_as_often_as_claimed():
    rng = np.random.default_rng(2)
    n, apart, sketched = 6000, 0, 0
    for _ in range(n):
        whole = rng.permutation(1000)
        part = whole[whole < 800]
        apart += not set(whole[:cp.PICKS]) & set(part[:cp.PICKS])
        a, b = whole[:cp.SKETCH], part[:cp.SKETCH]
        again = rng.permutation(1000)
        sketched += not set(sorted(a, key=again.item)[:cp.PICKS]) & set(sorted(b, key=again.item)[:cp.PICKS])
    assert abs(sketched / n - cp.missed(1 / 6, 1 / 6)) < 0.015
    assert abs(cp.missed(0.2, 0.0) - 0.04) < 1e-12


def test_shingles_are_sets_of_five_words():
    cache = WordHashes()
    assert len(cp.shingles("a b c d e f", cache)) == 2 and len(cp.shingles("a b", cache)) == 1 and not len(cp.shingles(None, cache))
    assert (cp.shingles("a b c d e a b c d e", cache) == cp.shingles("a b c d e a b c d e a b c d e", cache)).all()


def test_components_of_a_path(ready):
    edges = saved(ready.range(60).selectExpr("id as a", "id + 1 as b").where("a <> 30"), "path")
    got = {r.v: r.label for r in components(edges).collect()}
    assert got == {v: 0 if v <= 30 else 31 for v in range(61)}


def test_odd_rows(odd, none):
    rows = cp.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert (by_id[1].n_links, by_id[2].class_id, by_id[3].keeper) == (0, 2, True)
    assert by_id[5].class_id == 4 and by_id[4].n_links == 1 and by_id[6].n_links == 1 and by_id[7].n_links == 1
    kept = cp.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "2", "3", "4", "6", "8", "None"]
    assert cp.near_duplicates(none).count() == 0 and cp.one_of_each(none).count() == 0
