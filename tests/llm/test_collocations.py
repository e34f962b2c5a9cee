import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from meterline.llm import collocations
from meterline.llm.collocations import collocations as mine
from tests.llm.conftest import LONG


def brute(rows, least=10, top=2000):
    """Straight from the definition, with Python's whole numbers."""
    f = defaultdict(Counter)
    for lang, text in rows:
        small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", small):
            w = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f[lang or "und", k].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang in {lang for lang, _ in f}:
        count = {p: n for k in (1, 2, 3) for p, n in f[lang, k].items()}
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        swallowed = {p[i: i + 2] for p, a in candidates.items() if len(p) == 3 for i in (0, 1) if 100 * a >= 50 * candidates[p[i: i + 2]]}
        scored = []
        for p, a in candidates.items():
            if p not in swallowed:
                score, _, l, r = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        n = sum(f[lang, 1].values())
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_equals_brute_force_on_the_table(docs):
    rows = [(r.lang, r.text) for r in docs.collect()]
    want = brute(rows)
    assert rows_of(mine(docs)) == want and len(want) > 100


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


def test_ties_cuts_and_swallowed_phrases(ready):
    """Random words over a small vocabulary give ties of all kinds."""
    draw = np.random.default_rng(3)
    rows = [(("en", None, "und")[i % 3], " ".join(draw.choice(["a", "B", "b", "ç", "Ç", "c.", "d,e", "\tf", "g\x00"], 30))) for i in range(300)]
    got = rows_of(mine(frame(ready, rows)))
    assert got == brute(rows) and {r[0] for r in got} == {"en", "und"}
    # a pair that nearly always has the same third word leaves, one that seldom has it stays
    rows = [("x", "new york city")] * 10 + [("x", "new york. york city")] * 10 + [("x", "york city")] * 30
    assert {r[2] for r in mine(frame(ready, rows)).collect()} == {"new york city", "york city"} == {r[2] for r in brute(rows)}


def test_small_flushes_and_cut_pieces_change_nothing(ready, monkeypatch):
    draw = np.random.default_rng(4)
    words = [f"w{i}" for i in range(12)]
    rows = [("en", "  ".join(draw.choice(words, 500))) for _ in range(20)] + [("de", ". ".join(" ".join(draw.choice(words, 7)) for _ in range(300)))]
    monkeypatch.setattr(collocations, "FLUSH", 64)
    monkeypatch.setattr(collocations, "CHUNK", 32)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 100)
    assert rows_of(mine(frame(ready, rows))) == brute(rows)
    monkeypatch.setattr(collocations, "FILTER_BITS", 1 << 15)
    assert rows_of(mine(frame(ready, rows), top=7)) == brute(rows, top=7)


def test_counts_beyond_64_bits(ready):
    """Products of counts are exact where they pass a long."""
    one = ready.createDataFrame([(3_000_000_000, 4_000_000_001, 3_000_000_007)], "a bigint, l1 bigint, r1 bigint")
    a, l, r = one.first()
    assert one.select(collocations._score("l1", "r1")).first()[0] == 1_000_000 * a * a // (l * r)


def test_odd_rows(odd, none):
    assert mine(none).count() == 0 and mine(odd.where("doc_id <= 3")).count() == 0
    rows = [(r.lang, r.text) for r in odd.collect()] * 9
    many = odd.sparkSession.createDataFrame(rows, "lang string, text string")
    assert rows_of(mine(many, top=50)) == brute(rows, top=50) and len(LONG) > 400_000


@pytest.mark.parametrize("text", ["", " \t ", "one", "one, two", "one\x0btwo\x0cthree\rfour", "a  b\t\tc"])
def test_pieces(ready, text):
    rows = [("en", text)] * 12
    assert rows_of(mine(frame(ready, rows))) == brute(rows)
