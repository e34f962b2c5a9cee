from collections import defaultdict

from meterline.llm import line_runs
from tests.llm.conftest import LONG


def brute(rows, least=50):
    """Lines inside a run of at least ``least`` words that occurs before, in the order of ``rows``."""
    seq, owner, ids = [], [], {}
    for i, text in rows:
        for k, line in enumerate(text.split("\n")):
            seq.append(ids.setdefault(line, len(ids)))
            owner.append((i, k, max(1, len(line.split()))))
        seq.append(-1 - len(seq))
        owner.append(None)
    seen, gone = defaultdict(list), defaultdict(set)
    for p, line in enumerate(seq):
        if owner[p] is None:
            continue
        best = 0
        for q in seen[line]:
            n = 0
            while owner[p + n] is not None and seq[p + n] == seq[q + n]:
                n += 1
            best = max(best, n)
        if sum(owner[p + j][2] for j in range(best)) >= least:
            gone[owner[p][0]] |= {owner[p + j][1] for j in range(best)}
        seen[line].append(p)
    return gone


def compare(docs):
    rows = docs.select("doc_id", "text").collect()
    gone = brute([(r.doc_id, r.text) for r in rows])
    got = {r.doc_id: r for r in line_runs.without_runs(docs).collect()}
    assert len(got) == len(rows)
    for r in rows:
        lines = r.text.split("\n")
        want = gone.get(r.doc_id, set())
        assert got[r.doc_id].gone == (",".join(map(str, sorted(want))) if want else None)
        assert got[r.doc_id].text == ("\n".join(x for i, x in enumerate(lines) if i not in want) if want else r.text)
        assert (got[r.doc_id].n_lines, got[r.doc_id].n_deleted) == (len(lines), len(want))


def test_equals_brute_force(docs):
    compare(docs.coalesce(1))


def test_runs_of_many_shapes(ready):
    def lines(*spec):
        return "\n".join(" ".join([w] * n) for w, n in spec)
    run = [(f"r{i}", 9 + i % 4) for i in range(12)]
    texts = [
        lines(("a", 3), *run, ("b", 3)), lines(("c", 3), *run[2:9], ("d", 3)), lines(*run[:4]), lines(*run[:6], *run[5:]), lines(("once", 60)), lines(("once", 60), ("e", 2)),
        lines(*[("over", 1)] * 130), lines(*[("lap", 20)] * 7), "\n" * 120, "\n" * 120, lines(("short", 10)), lines(("short", 10)), lines(*run[6:], *run[:6]),
    ]
    compare(ready.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1))


def test_odd_rows(odd, none):
    got = line_runs.without_runs(odd.coalesce(1)).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text is None and by_id[2].text == "" and by_id[6].text is not None
    # the second very long text is a copy of one line of the first
    assert by_id[4].text == LONG and by_id[5].text == "" and by_id[5].n_deleted == 1
    assert line_runs.without_runs(none).count() == 0
