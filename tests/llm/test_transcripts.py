import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import transcripts as tr
from meterline.llm.common import saved, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def parsed(ready):
    raw = saved(tr.raw_lines(table(ready, SF, "conversations")), "raw")
    model = tr.train(tr.known_part(raw))
    return raw, model, saved(tr.label_lines(raw, model), "labelled")


def test_held_out_roles(parsed):
    raw, _, labelled = parsed
    both = labelled.alias("a").join(raw.alias("b"), ["conv_id", "line_no"]).where(F.pmod(F.xxhash64("conv_id", F.lit("known")), F.lit(5)) != 0)
    n = both.count()
    assert labelled.count() == raw.count()
    assert both.where("a.role = b.role").count() > 0.94 * n and both.where("a.begins = b.begins").count() > 0.94 * n


def viterbi(model, lines):
    """Over the whole conversation at once."""
    best, back = model.start + model.emission(lines[0], None), []
    for before, line in zip(lines, lines[1:]):
        ways = best[:, None] + model.move
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + model.emission(line, before)
    path = [int(best.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_chains_equal_one_pass(parsed):
    """Chunk matrices chained and solved apart give the path of one pass; chunk borders hide the line before."""
    _, model, _ = parsed
    lines = ["User: hello there?", "more", "", "Assistant: well", "text", "", "Human: x?", "AI: y", "z"] * 4
    chunks = [lines[i:i + 7] for i in range(0, len(lines), 7)]
    total = model.chain(chunks[0])[-1]
    for c in chunks[1:]:
        total = (total[:, None] + model.chain(c)[:-1]).max(axis=0)
    path = []
    for i, c in enumerate(chunks):
        ends = model.chain(c)
        assert ends.shape == (len(model.states) + 1, len(model.states))
        path += model.solve(c, len(model.states) if not i else path[-1], int(ends[len(model.states) if not i else path[-1]].argmax()))
    assert len(path) == len(lines)
    whole = viterbi(model, lines[:7])
    assert model.solve(lines[:7], len(model.states), whole[-1]) == whole
    assert np.isclose(model.chain(lines[:7])[-1].max(), model.chain(lines[:7])[-1][whole[-1]])


def test_long_conversation_in_chunks(ready, parsed):
    """Turns over several chunks, in one conversation, are numbered without gaps."""
    _, model, _ = parsed
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"text {t}" + ("?" if t % 2 == 0 else ".")) for t in range(300)]
    raw = tr.raw_lines(ready.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert raw.select(F.shiftright("line_no", tr.CHUNK_BITS)).distinct().count() == 5
    got = tr.turns(tr.label_lines(raw, model)).orderBy("turn_no").collect()
    assert [r.turn_no for r in got] == list(range(len(got))) and len(got) > 270
    assert sum(r.text.startswith("text ") for r in got) > 0.9 * len(got)


def test_rendering(parsed):
    _, _, labelled = parsed
    r = tr.turns(labelled).where("conv_id = 0 and turn_no = 0").first()
    assert r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>"


def test_markers():
    assert tr.marker("**Q:** hi") == ("q", 7) and tr.marker("### User") == ("user", 8) and tr.marker("[System] be") == ("system", 9)
    assert tr.marker("plain text") == (tr.NONE, 0) and tr.marker("") == (tr.NONE, 0)


def test_odd_rows(ready, parsed):
    _, model, _ = parsed
    rows = [(None, 0, None, None), (1, None, "user", ""), (1, None, "user", ""), (2, 0, "narrator", "x"), (3, 0, "user", "long " * 50_000), (3, 1, None, "a\n\n\nb")]
    turns = ready.createDataFrame([(*r, "clash") for r in rows], "conv_id bigint, turn bigint, role string, text string, line string")
    got = tr.turns(tr.label_lines(tr.raw_lines(turns), model)).collect()
    assert {r.conv_id for r in got} == {None, 1, 2, 3}
    nothing = turns.limit(0)
    assert tr.turns(tr.label_lines(tr.raw_lines(nothing), model)).count() == 0
    untrained = tr.train(tr.raw_lines(nothing))
    assert {r.role for r in tr.turns(tr.label_lines(tr.raw_lines(turns), untrained)).collect()} == {"unknown"}
