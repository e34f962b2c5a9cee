import hashlib
import re

import pytest
from pyspark.sql import functions as F

from meterline.llm import sanitise
from tests.llm.conftest import SF_DIR  # noqa: F401

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        worth = [sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(worth) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def compare(docs):
    got = sanitise.digest(sanitise.find(docs)).collect()
    rows = docs.select("doc_id", "text").collect()
    want = []
    for r in rows:
        base = brute(r.text)
        counts = [sum(b.startswith(k + ":") for b in base) for k in PATTERNS]
        want.append(str((r.doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest())))
    assert sorted(str(tuple(g[:6])) for g in got) == sorted(want)
    assert all(g.spans.startswith(",".join(b)) for g in got for r in rows for b in [brute(r.text)] if r.doc_id == g.doc_id and g.doc_id is not None)
    return got


def test_equals_brute_force(docs):
    compare(docs)


def test_hard_cases(ready):
    texts = [
        "a@b.c_d@e.f x@y..z @@ a@b.c@d.e", "1.2.3.4.5.6.7.8 999.1.2.3.4 0001.02.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
        "+1 (017) 555-7713 +1+2 3456789012 +49.....1 +1234567890123456", "é😀 a.b+c%d@ex-am.ple.com ß 10.0.0.1", "x" * 50_000 + "@a.b " + "1" * 50_000 + " " + "1 " * 20_000,
        " ".join(f"user{i}@mail.example.org" for i in range(2_000)), None, "", "+1" + "(" * 5_000,
    ]
    compare(ready.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


@pytest.fixture(scope="module")
def telling(ready):
    """A term that always goes with one address, one that goes with it often, and one that is everywhere."""
    rows = [(i, f"common word{i} boss@corp.example.com nickname{'' if i else ' extra'} mostly") for i in range(4)]
    rows += [(10 + i, f"common mostly other{i}") for i in range(2)] + [(20 + i, f"common text{i}") for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(50)]
    return ready.createDataFrame(rows, "doc_id bigint, text string")


def test_terms_that_disclose_are_found(telling):
    found = sanitise.find(telling)
    got = {r.doc_id: {t.value: t.treatment for t in r.terms} for r in found.collect()}
    assert got[1] == {"nickname": "remove", "mostly": "generalise"} and got[10] == {} and got[20] == {}
    clean = {r.doc_id: r.text for r in sanitise.sanitise(telling, found).collect()}
    assert clean[1] == "common word1 [EMAIL]  [TERM]" and clean[20] == "common text0"
    spans = {r.doc_id: r.spans for r in sanitise.digest(found).collect()}
    assert spans[1] == "email:13:34,term:35:43,term:44:50"


def test_terms_to_remove_are_marked_without_their_entity(ready):
    """PMI / IC is log(100 / 11) / log(100 / 10) = 0.958: the term is removed, and stands alone once."""
    rows = [(i, f"word{i} boss@corp.example.com Nickname") for i in range(10)] + [(10, "Here nickname stands alone")]
    docs = ready.createDataFrame(rows + [(20 + i, f"text{i}" if i else None) for i in range(89)], "doc_id bigint, text string")
    found = sanitise.find(docs)
    assert docs.count() == 100 and found.count() == 100
    assert {r.doc_id: [(t.value, t.start, t.treatment) for t in r.terms] for r in found.collect()}[10] == [("nickname", 5, "remove")]
    assert {r.doc_id: r.text for r in sanitise.sanitise(docs, found).collect()}[10] == "Here  stands alone"


def test_copies_alone_prove_nothing(ready):
    rows = [(i, "the same secret@corp.example.com text") for i in range(30)] + [(50 + i, f"other {i}") for i in range(30)]
    found = sanitise.find(ready.createDataFrame(rows, "doc_id bigint, text string"))
    assert found.where(F.size("terms") > 0).isEmpty()


def test_odd_rows(odd, none):
    assert len(compare(odd)) == odd.count()
    assert sanitise.find(none).count() == 0


def test_prefix_sums_cross_blocks(ready):
    n = sanitise.BLOCK * 2 + 7
    row = ready.range(1).select(sanitise.prefix_sums(F.sequence(F.lit(1), F.lit(n))).alias("s")).first()
    assert row.s == [i * (i + 1) // 2 for i in range(1, n + 1)]
