import re
from collections import Counter

from meterline.llm import rules
from meterline.llm.common import table
from tests.llm.conftest import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    counts = Counter(windows)
    repeated = {p for i, x in enumerate(windows) if counts[x] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed


def compare(docs):
    got = rules.digest(rules.apply_policy(rules.ledger(docs))).collect()
    rows = docs.select("doc_id", "text").collect()
    want = sorted(str((r.doc_id, *brute(r.text))) for r in rows)
    assert sorted(str((g.doc_id, g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed)) for g in got) == want
    assert not any(g.kept for g in got if g.base_failed)
    return got


def test_equals_brute_force(docs):
    compare(docs)


def test_odd_rows(ready, odd, none):
    compare(odd)
    more = ready.createDataFrame([(1, "a b c d e f g h " * 3), (2, "a b c d e f g h a b c d e f g h x"), (3, "l\nl\n \nl\n" + " ".join(map(str, range(40)))), (4, "ÄÖ " * 5)], "doc_id bigint, text string")
    compare(more)
    assert rules.ledger(none).count() == 0 and rules.ablations(rules.ledger(none)).count() == 0


def test_junk_is_rejected_and_good_text_kept(ready):
    docs, labels = (table(ready, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    judged = rules.apply_policy(rules.ledger(docs)).join(labels, "doc_id")
    counts = {(r.quality, r.kept, r.base_failed): r["count"] for r in judged.groupBy("quality", "kept", "base_failed").count().collect()}
    assert counts.get((0, True, False), 0) == 0
    assert counts.get((1, False, False), 0) == 0


def test_policies_and_ablations_use_the_ledger_alone(odd):
    rows = rules.ledger(odd)
    judged = {p: {r.doc_id: r.kept for r in rules.apply_policy(rows, p).collect()} for p in rules.POLICIES}
    assert all(judged["v1"][k] or not judged["v3"][k] for k in judged["v1"])
    failed = [r.failed for r in rows.collect()]
    for r in rules.ablations(rows).collect():
        m = rules.POLICIES["v3"]
        assert r.failed == sum(f & rules.BIT[r.rule] != 0 for f in failed)
        assert r.failed_alone == sum(f & m == rules.BIT[r.rule] for f in failed)
