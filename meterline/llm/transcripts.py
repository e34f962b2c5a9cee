"""Transcript parsing: a hidden Markov model recovers who speaks, then turns are rendered in one canonical form.

States are a role and whether a line begins a turn. A line shows its speaker marker, its length class, whether it asks,
and whether the line before was blank. Starts, transitions and emissions are counted on transcripts with known roles;
Viterbi finds the likeliest states of the others.

A conversation may be long without bound, so Viterbi works in chunks of lines. Each chunk gives the best log-probability
from every state before it to every state at its end; these small matrices are chained along the conversation; then
each chunk is solved alone between its two known states. The result equals Viterbi over the whole conversation.

Defined results: a null or empty line counts as blank; lines with a null conversation form one conversation; lines of equal
number are ordered by their text; without known roles every conversation is one turn of role ``unknown``; an empty table
gives an empty result. Only ``conv_id, line_no, line`` (and ``role, begins`` for training) are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.chosen_path import grouped
from meterline.llm.common import saved

#: Low bits of a line number inside one chunk: 64 units of ``LINE_BITS`` bits.
LINE_BITS = 20
CHUNK_BITS = LINE_BITS + 6
LEAST_MARKER = 3
#: Weight, in lines, of what all roles share against what a role shows itself.
LEAN = 2.0
LENGTHS = (40, 120, 400)
WITH_COLON = re.compile(r"^\W{0,4}([A-Za-z]{1,14})\W{0,2}:[*_\s]*")
WITH_FRAME = re.compile(r"^\s*(?:#{1,6}\s*|\[|<\|)([A-Za-z]{1,14})(?:\]|\|>)?\s*")
NONE, OTHER = "-", "?"


def marker(line: str) -> tuple[str, int]:
    """Speaker marker in lower case (``-``: none) and where the text after it begins."""
    m = WITH_COLON.match(line) or WITH_FRAME.match(line)
    return (m.group(1).lower(), m.end()) if m else (NONE, 0)


def signs(line: str, before: str | None) -> dict[str, str]:
    """Observed features; ``before`` is None where a chunk begins."""
    text = line.strip()
    found = {"marker": marker(line)[0], "length": "blank" if not text else str(sum(len(text) > x for x in LENGTHS)), "asks": str(text.endswith("?"))}
    if before is not None:
        found["after_blank"] = str(not before.strip())
    return found


@dataclass(frozen=True)
class Hmm:
    states: tuple[tuple[str, bool], ...]
    start: np.ndarray
    move: np.ndarray
    emit: dict[tuple[str, str], np.ndarray]
    unseen: dict[str, np.ndarray]

    def emission(self, line: str, before: str | None) -> np.ndarray:
        return sum((self.emit.get(x, self.unseen[x[0]]) for x in signs(line, before).items()), np.zeros(len(self.states)))

    def chain(self, lines: list[str]) -> np.ndarray:
        """Best log-probability from the state before the lines (row; the last row is the start) to the last state."""
        best = np.vstack([self.move, self.start])
        for i, line in enumerate(lines):
            if i:
                best = (best[:, :, None] + self.move[None]).max(axis=1)
            best = best + self.emission(line, lines[i - 1] if i else None)
        return best

    def solve(self, lines: list[str], before: int, end: int) -> list[int]:
        """Best states of the lines between the state before and the state of the last line."""
        best, back = np.vstack([self.move, self.start])[before], []
        for i, line in enumerate(lines):
            if i:
                ways = best[:, None] + self.move
                back.append(ways.argmax(axis=0))
                best = ways.max(axis=0)
            best = best + self.emission(line, lines[i - 1] if i else None)
        path = [end]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def chunked(lines: DataFrame) -> DataFrame:
    """``conv, chunk``, and the line; the order inside a chunk is by number and text."""
    return lines.select(
        F.coalesce("conv_id", F.lit(-1)).alias("conv"), "conv_id", F.shiftright(F.coalesce("line_no", F.lit(0)), CHUNK_BITS).alias("chunk"),
        F.coalesce("line_no", F.lit(0)).alias("line_no"), F.coalesce("line", F.lit("")).alias("line"),
        *[c for c in ("role", "begins") if c in lines.columns])


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per line of known role: state, state before, and features as ``name=value``."""
    def rows(batch: pa.RecordBatch) -> list[tuple]:
        return list(zip(*[batch.column(c).to_pylist() for c in ("conv", "chunk", "line", "role", "begins")], strict=True))
    last = None
    for batch in batches:
        out: list[tuple[str, str | None, list[str]]] = []
        for conv, chunk, line, role, begins in rows(batch):
            state = f"{role}/{int(begins)}"
            same = last is not None and last[:2] == (conv, chunk)
            out.append((state, last[3] if same else None, [f"{k}={v}" for k, v in signs(line, last[2] if same else None).items()]))
            last = (conv, chunk, line, state)
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.list_(pa.string()))], names=["state", "before", "signs"])


def train(known: DataFrame) -> Hmm:
    """Count on lines with ``role`` and ``begins``; what reaches the driver is a table of states and features."""
    rows = chunked(known.where("role IS NOT NULL")).repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "line_no", "line")
    seen = saved(rows.mapInArrow(_observed, "state string, before string, signs array<string>"), "hmm-counts")
    moves = seen.groupBy("state", "before").agg(F.count("*").alias("n")).collect()
    names = sorted({r["state"] for r in moves})
    if not names:
        return Hmm((("unknown", True), ("unknown", False)), np.array([0.0, -30.0]), np.array([[-30.0, 0.0], [-30.0, 0.0]]), {}, {k: np.zeros(2) for k in ("marker", "length", "asks", "after_blank")})
    at = {s: i for i, s in enumerate(names)}
    n = len(names)
    start, move = np.full(n, 0.1), np.full((n, n), 0.1)
    for r in moves:
        if r["before"] is None:
            start[at[r["state"]]] += r["n"]
        else:
            move[at[r["before"]], at[r["state"]]] += r["n"]
    # a conversation begins with the beginning of a turn
    start *= [1.0 if s.endswith("/1") else 1e-6 for s in names]
    counts = seen.select("state", F.explode("signs").alias("sign")).groupBy("state", "sign").agg(F.count("*").alias("n"))
    # markers are an open set: rare ones count as "other"
    total = counts.groupBy("sign").agg(F.sum("n").alias("all"))
    rare = F.col("sign").startswith("marker=") & (F.col("all") < LEAST_MARKER)
    common = counts.join(total, "sign").withColumn("sign", F.when(rare, f"marker={OTHER}").otherwise(F.col("sign"))).groupBy("state", "sign").agg(F.sum("n").alias("n")).collect()
    table: dict[tuple[str, str], np.ndarray] = {}
    for r in common:
        name, _, value = r["sign"].partition("=")
        table.setdefault((name, value), np.zeros(n))[at[r["state"]]] = r["n"]
    # a rare role knows few values: it leans on all lines that begin a turn, or on all that do not
    kin = np.array([[a.rpartition("/")[2] == b.rpartition("/")[2] for b in names] for a in names], dtype=float)
    emit, unseen = {}, {}
    for name in ("marker", "length", "asks", "after_blank"):
        own = {k: v for k, v in table.items() if k[0] == name}
        whole = sum(own.values(), np.zeros(n))
        shared = {k: (kin @ v + 0.5) / (kin @ whole + 0.5 * (len(own) + 1)) for k, v in own.items()}
        emit |= {k: np.log((v + LEAN * shared[k]) / (whole + LEAN)) for k, v in own.items()}
        unseen[name] = emit.get((name, OTHER), np.log(LEAN * 0.5 / (kin @ whole + 0.5 * (len(own) + 1)) / (whole + LEAN)))
    states = tuple((s.rpartition("/")[0], s.endswith("/1")) for s in names)
    return Hmm(states, np.log(start / start.sum()), np.log(move / move.sum(axis=1, keepdims=True)), emit, unseen)


def label_lines(lines: DataFrame, model: Hmm) -> DataFrame:
    """``conv_id, chunk, line_no, line, role, begins, body`` of every line; ``body`` is the line without its marker."""
    rows = saved(chunked(lines.select("conv_id", "line_no", "line")).repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "line_no", "line"), "transcript-lines")
    size = len(model.states)

    def read(batch: pa.RecordBatch) -> Iterator[tuple]:
        return zip(*[batch.column(c).to_pylist() for c in ("conv", "chunk", "line_no", "line", "conv_id")], strict=True)

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _chunks(batches, read):
            m = model.chain([g[3] for g in group])
            yield pa.RecordBatch.from_arrays([pa.array([group[0][0]], pa.int64()), pa.array([group[0][1]], pa.int64()), pa.array([m.ravel().tolist()], pa.list_(pa.float64()))], names=["conv", "chunk", "chain"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Along each conversation: the states before and at the end of each chunk. Small matrices only."""
        def small(batch: pa.RecordBatch) -> Iterator[tuple]:
            return zip(batch.column("chunk").to_pylist(), batch.column("chain").to_pylist(), strict=True)
        for conv, group in grouped(batches, "conv", small):
            best, back = None, []
            for _, flat in group:
                m = np.array(flat).reshape(size + 1, size)
                if best is None:
                    best = m[-1]
                    back.append(None)
                else:
                    ways = best[:, None] + m[:-1]
                    back.append(ways.argmax(axis=0).astype(np.int16))
                    best = ways.max(axis=0)
            state, out = int(best.argmax()), []
            for (chunk, _), b in zip(reversed(group), reversed(back), strict=True):
                before = size if b is None else int(b[state])
                out.append((conv, chunk, before, state))
                state = before
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["conv", "chunk", "before", "end"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def placed(batch: pa.RecordBatch) -> Iterator[tuple]:
            return zip(*[batch.column(c).to_pylist() for c in ("conv", "chunk", "line_no", "line", "conv_id", "before", "end")], strict=True)
        for group in _chunks(batches, placed):
            path = [model.states[s] for s in model.solve([g[3] for g in group], group[0][5], group[0][6])]
            n = len(group)
            arrays = [
                pa.array([g[4] for g in group], pa.int64()), pa.array([g[0] for g in group], pa.int64()), pa.array([g[1] for g in group], pa.int64()), pa.array([g[2] for g in group], pa.int64()), pa.array(range(n), pa.int32()),
                pa.array([g[3] for g in group], pa.string()), pa.array([s[0] for s in path], pa.string()), pa.array([s[1] for s in path], pa.bool_()),
                pa.array([g[3][marker(g[3])[1]:] if s[1] else g[3] for g, s in zip(group, path, strict=True)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "conv", "chunk", "line_no", "place", "line", "role", "begins", "body"])
    matrices = rows.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "line_no", "line").mapInArrow(chains, "conv bigint, chunk bigint, chain array<double>")
    bounds = saved(matrices.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(ends, "conv bigint, chunk bigint, before int, end int"), "transcript-bounds")
    joined = rows.join(bounds, ["conv", "chunk"]).repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "line_no", "line")
    return joined.select("conv", "chunk", "line_no", "line", "conv_id", "before", "end").mapInArrow(solve, "conv_id bigint, conv bigint, chunk bigint, line_no bigint, place int, line string, role string, begins boolean, body string")


def _chunks(batches: Iterator[pa.RecordBatch], read) -> Iterator[list[tuple]]:
    """Rows of one conversation and chunk, which follow one another."""
    group: list[tuple] = []
    for batch in batches:
        for row in read(batch):
            if group and group[0][:2] != row[:2]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def turns(labelled: DataFrame) -> DataFrame:
    """``conv_id, turn_no, role, text, rendered``: one row per recovered turn, in canonical form."""
    labelled = saved(labelled, "transcript-states")
    # turns are numbered within a chunk, and each chunk starts where those before it end
    counts = labelled.groupBy("conv", "chunk").agg(F.sum(F.col("begins").cast("int")).alias("n"))
    order = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("conv", "chunk", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv", "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    numbered = labelled.withColumn("k", F.sum(F.col("begins").cast("int")).over(inside)).join(base, ["conv", "chunk"])
    number: Column = F.greatest(F.col("base") + F.col("k") - 1, F.lit(0))
    rows = numbered.select("conv_id", "conv", number.alias("turn_no"), "role", "chunk", "place", "body")
    joined = rows.groupBy("conv", "turn_no").agg(F.first("conv_id").alias("conv_id"), F.min_by("role", F.struct("chunk", "place")).alias("role"), F.array_sort(F.collect_list(F.struct("chunk", "place", "body"))).alias("lines"))
    text = F.regexp_replace(F.array_join(F.transform("lines", lambda x: x["body"]), "\n"), r"^\n+|\n+$", "")
    return joined.select("conv_id", "turn_no", "role", text.alias("text")).withColumn("rendered", F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>")))


# Marker styles of raw transcripts, by role.
STYLES = (
    {"user": "User: ", "assistant": "Assistant: ", "system": "System: "},
    {"user": "Human: ", "assistant": "AI: ", "system": "Instructions: "},
    {"user": "**Q:** ", "assistant": "**A:** ", "system": "[System] "},
    {"user": "### User\n", "assistant": "### Response\n", "system": "### System\n"},
)


def raw_lines(conversations: DataFrame) -> DataFrame:
    """Raw transcripts of a table of turns: ``conv_id, line_no, line`` with the true ``role, begins`` for training and tests.

    The style of a conversation follows from its id; every sixth turn has lost its marker and only a blank line is left.
    """
    role = F.coalesce("role", F.lit("user"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    mark = F.lit("")
    for i, marks in enumerate(STYLES):
        for name, value in marks.items():
            mark = F.when((style == i) & (role == name), value).otherwise(mark)
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6)) == 0
    blank = lost | (style < 2)
    text = F.concat(F.when(lost, "").otherwise(mark), F.coalesce("text", F.lit("")), F.when(blank, "\n").otherwise(""))
    lines = conversations.select("conv_id", F.coalesce("turn", F.lit(0)).alias("turn"), role.alias("role"), F.posexplode(F.split(text, "\n")).alias("i", "line"))
    return lines.select("conv_id", (F.col("turn") * (1 << LINE_BITS) + F.col("i")).alias("line_no"), "line", "role", (F.col("i") == 0).alias("begins"))


def known_part(lines: DataFrame) -> DataFrame:
    """The fifth of the conversations whose roles are given to the fit."""
    return lines.where(F.pmod(F.xxhash64("conv_id", F.lit("known")), F.lit(5)) == 0)


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("conv_id", "turn_no", "role", "rendered")
