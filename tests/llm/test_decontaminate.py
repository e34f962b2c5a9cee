import hashlib
import re

import pytest

from meterline.llm import decontaminate as dc
from meterline.llm.common import table
from tests.llm.conftest import LONG, SF_DIR

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    """Hit words and items, window by window."""
    w = words(text)
    hit, found = set(), set()
    for item_id, item in items:
        v = words(item)
        n = min(10, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item_id)
    ids = ",".join(sorted(map(str, found)))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def compare(docs, items, benchmark):
    got = sorted(dc.digest(dc.decontaminate(docs, benchmark)).collect(), key=str)
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    want = sorted(((r.doc_id, *brute(r.text, items)) for r in rows), key=str)
    assert sorted(map(str, (tuple(g) for g in got))) == sorted(map(str, want))


def test_equals_brute_force_on_the_tables(ready, docs):
    benchmark = table(ready, SF_DIR, "benchmark")
    items = [tuple(r) for r in benchmark.select("item_id", "text").collect()]
    compare(docs, items, benchmark)
    assert dc.clean(docs, benchmark).columns == docs.columns
    bad = {r.doc_id for r in docs.collect() if brute(r.text, items)[4]}
    assert bad and {r.doc_id for r in dc.clean(docs, benchmark).collect()} == {r.doc_id for r in docs.collect()} - bad


@pytest.fixture(scope="module")
def tricky(ready):
    base = "The quick brown fox jumps over the lazy dog and then it sleeps for a long while under the old tree"
    items = [(1, base), (2, "tiny item"), (3, "tiny item"), (4, None), (5, "..."), (6, "same same same same same same same same same same same same"), (7, "Ünïcode wörds count too")]
    docs = [
        (1, base.upper()), (2, "x " + base[:45] + " y"), (3, "a TINY, item; tiny item"), (4, "same " * 40), (5, None), (6, ""), (7, "nothing here"),
        (8, " ".join(base.split()[3:13])), (9, " ".join(base.split()[3:12])), (10, "x ünïcode wörds count too y"), (10, "x ünïcode wörds count too y"), (11, LONG + " " + base),
        (None, base), (12, base + " " + base),
    ]
    return ready.createDataFrame(docs, "doc_id bigint, text string"), items, ready.createDataFrame(items, "item_id bigint, text string")


def test_overlaps_short_items_and_repeats(tricky):
    compare(*tricky)


def test_every_shared_window_shares_a_fingerprint(ready):
    """Any window of the item, in other surroundings, is found."""
    item = " ".join(f"w{i}" for i in range(40))
    docs = ready.createDataFrame([(i, f"p{i} q{i} r{i} " + " ".join(f"w{j}" for j in range(i, i + 10)) + f" s{i} t{i}") for i in range(31)], "doc_id bigint, text string")
    found = dc.decontaminate(docs, ready.createDataFrame([(1, item)], "item_id bigint, text string"))
    assert [r.n_hit for r in found.collect()] == [10] * 31


def test_odd_rows(ready, odd, none):
    empty = ready.createDataFrame([], "item_id bigint, text string")
    assert {r.contaminated for r in dc.decontaminate(odd, empty).collect()} == {False}
    assert dc.clean(odd, empty).count() == odd.count() and dc.decontaminate(none, empty).count() == 0
    compare(odd, [(1, LONG[:300])], ready.createDataFrame([(1, LONG[:300])], "item_id bigint, text string"))


def test_a_passage_that_many_items_share(ready):
    """No row of the work holds the items of a window; each document gets all of them once."""
    passage = " ".join(f"w{i}" for i in range(12))
    items = [(i, f"start{i} {passage}") for i in range(2000)]
    docs = ready.createDataFrame([(1, f"a b {passage} c {passage}"), (2, passage), (3, "start5 " + passage), (4, "w1 w2 w3")], "doc_id bigint, text string")
    benchmark = ready.createDataFrame(items, "item_id bigint, text string")
    assert not [f for f in dc.item_windows(benchmark).schema.fields if f.dataType.typeName() == "array"]
    compare(docs, items, benchmark)
