"""Conversation structure repair by a parallel Viterbi search (operator 12).

The turns of a conversation should be an optional system turn and then pairs
of user and assistant, or nothing at all. Each turn can be kept, given another
role or deleted, and empty turns can be inserted anywhere; the cheapest edits
are a shortest path over four states (nothing yet, after system, after user,
after assistant), one step a row.

A conversation is cut into chunks of rows that tasks solve side by side. What
a state still costs at the right end of a chunk is unknown, so chunks start
from a speculative cost vector. In fix-up passes a chunk takes the vector its
right neighbour has found; where it differs from the one it used by more than
a constant, the chunk is solved again. Paths merge within a few rows, so one
or two passes are enough as a rule; chunks that still change after
FIXUPS passes (rows that only shift or swap the states) are composed
by doubling from their (min, +) matrices, so the number of passes never
follows the length of a conversation. With the stitched costs each chunk
traces its edits from every state; the states at the chunks' left ends follow
by doubling, and the trace from the right state counts.

Costs: keep 0, new role 3, delete 4, insert 3, and 3 more for a truncated turn
that is not deleted; blank and duplicate turns must be deleted. Of several
cheapest audits the least string counts (D < I < K < R); the next letter
decides the next state, so it is found letter by letter.

Results in special cases: a null role or text reads as one space; a turn whose
role starts with none of s, u, a cannot keep it; null turns stand first; rows
with equal turns are ordered by role, then by the hash of the text; a null
conversation id is a conversation of its own.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import part_offsets, written

#: Rows of a chunk, chunks that one numpy step handles, fix-up passes before chunks are composed.
CHUNK_ROWS, LANES, FIXUPS = 256, 2048, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: Costs of the edits, and one that no path has.
RENAME, DELETE, INSERT, TRUNCATED, NEVER = 3, 4, 3, 3, 1 << 40
#: Initials of roles as numbers, and faults (whole, to be deleted, truncated): a row's code is 4 * fault + initial.
INITIALS, WHOLE, GONE, CUT, PAD = "sua", 0, 1, 2, 12
#: The state after an inserted or renamed turn, and after a kept one (-1: not allowed).
GIVEN = np.array([USER, USER, ASSISTANT, USER])
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: What a blank text consists of.
SPACES = " \t\n\x0b\x0c\r"
#: Adjacent initials su, ua and au as 4 * left + right.
LEGAL = (1, 6, 9)


class Repaired(NamedTuple):
    """What `repair` returns: repaired turns (conversation, place, role, text), the report on every
    conversation, and the audits in pieces (conversation, chunk, edits)."""

    turns: DataFrame
    report: DataFrame
    edits: DataFrame


@functools.cache
def steps() -> tuple[np.ndarray, np.ndarray]:
    """Per code the cost from state to state of one row without insertions, and with insertions before it."""
    plain = np.full((PAD + 1, 4, 4), NEVER)
    for code in range(PAD):
        fault, initial = divmod(code, 4)
        extra = TRUNCATED if fault == CUT else 0
        for s in range(4):
            plain[code, s, s] = DELETE
            if fault != GONE:
                plain[code, s, GIVEN[s]] = min(plain[code, s, GIVEN[s]], RENAME + extra)
                if KEPT[s, initial] >= 0:
                    plain[code, s, KEPT[s, initial]] = extra
    plain[PAD] = np.where(np.eye(4, dtype=bool), 0, NEVER)
    return plain, np.stack([*(with_insertions(m) for m in plain[:PAD]), plain[PAD]])


def with_insertions(cost: np.ndarray) -> np.ndarray:
    """Costs (state first) when turns may be inserted before: three suffice to reach every state."""
    for _ in range(3):
        cost = np.minimum(cost, INSERT + cost[GIVEN])
    return cost


#: What each state costs after the last row.
END = with_insertions(np.array([0, NEVER, NEVER, 0]))


def _codes(column: pa.Array) -> np.ndarray:
    """Chunks of codes as rows of one matrix, padded at the left."""
    rows = [np.frombuffer(c, np.uint8) for c in column.to_pylist()]
    out = np.full((len(rows), max(map(len, rows))), PAD, np.uint8)
    for i, r in enumerate(rows):
        out[i, out.shape[1] - len(r):] = r
    return out


def backward(codes: np.ndarray, right: np.ndarray) -> np.ndarray:
    """What every state costs before each row, and after the last: (rows + 1, chunks, 4)."""
    out = np.empty((codes.shape[1] + 1, *right.shape), np.int64)
    out[-1] = right
    for t in range(codes.shape[1] - 1, -1, -1):
        out[t] = np.minimum((steps()[1][codes[:, t]] + out[t + 1][:, None, :]).min(axis=2), NEVER)
    return out


def matrices(codes: np.ndarray) -> np.ndarray:
    """Per chunk the cost from each state before it to each state after it."""
    lanes = np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, NEVER), (len(codes), 4, 4))
    return np.stack([backward(codes, lanes[:, :, s])[0] for s in range(4)], axis=2)


def trace(codes: np.ndarray, costs: np.ndarray, entry: np.ndarray, last: np.ndarray) -> tuple[list[bytearray], np.ndarray, np.ndarray]:
    """(edits, cost, state after the chunk) from the entry states; `last` marks chunks that end a conversation."""
    state, spent, lanes = entry.copy(), np.zeros(len(entry), np.int64), np.arange(len(entry))
    edits = [bytearray() for _ in entry]

    def insert(t: int, open_: np.ndarray) -> None:
        """Insertions before row t where the row itself is on no cheapest path, or only with a later letter."""
        for _ in range(3):
            here = costs[t][lanes, state]
            if t < codes.shape[1]:
                after = costs[t + 1]
                deleted = DELETE + after[lanes, state] == here
                wanted = open_ & (codes[:, t] != PAD) & ~deleted
            else:
                wanted = open_ & (here > 0)
            wanted = wanted & (INSERT + costs[t][lanes, GIVEN[state]] == here)
            for i in np.flatnonzero(wanted).tolist():
                edits[i] += b"I"
            spent[wanted] += INSERT
            state[wanted] = GIVEN[state[wanted]]

    everywhere = np.ones(len(entry), bool)
    for t in range(codes.shape[1]):
        insert(t, everywhere)
        code, here, after = codes[:, t], costs[t][lanes, state], costs[t + 1]
        fault, initial = code // 4, code % 4
        extra = np.where(fault == CUT, TRUNCATED, 0)
        keeps, gives = KEPT[state, initial], GIVEN[state]
        deleted = DELETE + after[lanes, state] == here
        kept = ~deleted & (fault != GONE) & (keeps >= 0) & (extra + after[lanes, keeps] == here)
        renamed = ~deleted & ~kept
        real = code != PAD
        for letter, chosen in ((b"D", deleted), (b"K", kept), (b"R", renamed)):
            for i in np.flatnonzero(chosen & real).tolist():
                edits[i] += letter
        spent += np.where(real, np.where(deleted, DELETE, extra + np.where(renamed, RENAME, 0)), 0)
        state = np.where(real, np.where(deleted, state, np.where(kept, keeps, gives)), state)
    insert(codes.shape[1], last)
    return edits, spent, state


def role_initial(role: Column) -> Column:
    """0 to 2 for s, u, a; 3 for every other role."""
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def ordered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, at, turn, role, text, initial, fault) of every row; `at` counts a conversation's rows from 0.

    Rows are sorted over all tasks at once and numbered from each task's
    counts, so a conversation of any length is in no single task. `fault` is
    the first of blank, duplicate, truncated, or null; a duplicate is found
    from the first place of each different (role, text), and blank rows, whose
    texts are alike, are not looked up.
    """
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                        F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    hashed = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)).withColumn("u", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest", "u")]
    n = F.monotonically_increasing_id()
    stored = written(hashed.repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "conv", "turn", "role", "text", "digest", F.shiftright(n, 33).cast("int").alias("_part"), n.bitwiseAND(F.lit((1 << 33) - 1)).alias("row")), "turns")
    counts = stored.groupBy("_part", "conv").agg(F.count("*").alias("_n"), F.min("row").alias("first"))
    before = part_offsets(counts, ["_part", "conv"])
    start = counts.alias("c").join(before.alias("b"), (F.col("c._part") == F.col("b._part")) & F.col("c.conv").eqNullSafe(F.col("b.conv"))).select(
        F.col("c._part").alias("p"), F.col("c.conv").alias("c"), (F.col("_before") - F.col("first")).alias("shift"))
    placed = stored.join(start, (F.col("_part") == F.col("p")) & F.col("conv").eqNullSafe(F.col("c"))).select(
        "conv", (F.col("row") + F.col("shift")).alias("at"), "turn", "role", "text", "digest")
    solid = F.rtrim("text", F.lit(SPACES))
    marked = written(placed.select("*", (F.length(solid) == 0).alias("blank"),
                                   (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut")), "turn-places")
    first = (marked.filter("NOT blank").groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n"))
             .filter("n > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    named = marked.filter("NOT blank").join(first, same, "left").unionByName(marked.filter("blank"), allowMissingColumns=True)
    fault = F.when(F.col("blank"), "blank").when(F.col("at") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
    return written(named.select("conv", "at", "turn", "role", "text", role_initial(F.col("role")).alias("initial"), fault.alias("fault")), "turn-faults")


def chunked(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(conv, chunk, codes, head, tail, illegal): the rows' codes in order, at most `chunk_rows` in a chunk,
    its first and last initial, and its adjacent initials that are not legal."""
    kind = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", CUT).otherwise(WHOLE)
    code = (4 * kind + F.col("initial")).cast("int")
    grouped = (rows.select("conv", F.floor(F.col("at") / chunk_rows).alias("chunk"), F.struct("at", code.alias("code")).alias("c"))
               .groupBy("conv", "chunk").agg(F.array_sort(F.collect_list("c")).alias("cs")))
    text = F.array_join(F.transform("cs", lambda c: F.lpad(F.hex(c["code"]), 2, "0")), "")
    initials = F.transform("cs", lambda c: c["code"] % 4)
    return grouped.withColumn("i", initials).select(
        "conv", "chunk", F.unhex(text).alias("codes"), F.get("i", F.lit(0)).alias("head"), F.element_at("i", -1).alias("tail"),
        F.aggregate(F.zip_with(F.slice("i", 1, F.size("i") - 1), F.slice("i", 2, F.size("i") - 1), wrong_pair), F.lit(0), lambda a, b: a + b).alias("illegal"))


def wrong_pair(left: Column, right: Column) -> Column:
    """1 where two adjacent initials are not legal, else 0."""
    return (~(4 * left + right).isin(*LEGAL)).cast("int")


def _solve(chunks: DataFrame) -> DataFrame:
    """Adds `left`: the costs before the chunk, from those after it (`right`), less the smallest one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, LANES):
                part = batch.slice(lo, LANES)
                right = np.array(part.column(3).to_pylist(), np.int64)
                left = backward(_codes(part.column(2)), right)[0]
                left -= left.min(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(left.tolist(), pa.list_(pa.int64()))],
                                                 ["conv", "chunk", "codes", "right", "left"])

    kind = chunks.schema["conv"].dataType.simpleString()
    return chunks.select("conv", "chunk", "codes", "right").mapInArrow(
        run, f"conv {kind}, chunk long, codes binary, right array<long>, left array<long>")


def _neighbour(chunks: DataFrame, column: str, step: int) -> DataFrame:
    """All columns plus `near`: the column's value in the chunk `step` places on (null: none)."""
    near = chunks.select(F.col("conv").alias("c"), (F.col("chunk") - step).alias("k"), F.col(column).alias("near"))
    return chunks.join(near, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")), "left").drop("c", "k")


def _compose(a: Column, b: Column) -> Column:
    """(min, +) product of two 4 x 4 matrices given as 16 numbers."""
    cell = lambda i: F.array_min(F.array(*[F.get(a, F.lit(i // 4 * 4 + k)) + F.get(b, F.lit(4 * k + i % 4)) for k in range(4)]))
    return F.array(*[F.least(cell(i), F.lit(NEVER)) for i in range(16)])


def _matrices(chunks: DataFrame) -> DataFrame:
    """(conv, chunk, m): the chunk's cost matrix as 16 numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, LANES):
                part = batch.slice(lo, LANES)
                m = matrices(_codes(part.column(2))).reshape(-1, 16)
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(m.tolist(), pa.list_(pa.int64()))], ["conv", "chunk", "m"])

    kind = chunks.schema["conv"].dataType.simpleString()
    return chunks.select("conv", "chunk", "codes").mapInArrow(run, f"conv {kind}, chunk long, m array<long>")


def stitched_costs(chunks: DataFrame, most: int) -> DataFrame:
    """Chunks with `right` and `left`, the costs of the four states after and before them but for a constant.

    `most` is the number of the last chunk of the longest conversation.
    """
    end = F.array(*[F.lit(int(x)) for x in END])
    solved = _solve(chunks.withColumn("right", end.cast("array<long>")))
    if not most:
        return solved
    solved = written(solved, "chunk-costs")
    for _ in range(FIXUPS):
        near = written(_neighbour(solved, "left", 1), "chunk-neighbours")
        moved = F.col("near").isNotNull() & (F.col("near") != F.col("right"))
        if near.filter(moved).isEmpty():
            return solved
        solved = written(near.filter(~moved | F.col("near").isNull()).drop("near").unionByName(
            _solve(near.filter(moved).withColumn("right", F.col("near")).drop("near", "left"))), "chunk-costs")
    return _by_doubling(chunks, most, end)


def _by_doubling(chunks: DataFrame, most: int, end: Column) -> DataFrame:
    """The same from products of the chunks' matrices over ever longer stretches to the right."""
    tails = written(_matrices(chunks), "chunk-matrices")
    step = 1
    while step <= most:
        tails = written(_neighbour(tails, "m", step).select(
            "conv", "chunk", F.when(F.col("near").isNull(), F.col("m")).otherwise(_compose(F.col("m"), F.col("near"))).alias("m")), "chunk-tails")
        step *= 2
    cost = lambda s: F.array_min(F.array(*[F.get("m", F.lit(4 * s + k)) + F.get(end, F.lit(k)) for k in range(4)]))
    ends = tails.withColumn("v", F.array(*[cost(s) for s in range(4)]))
    ends = ends.select("conv", "chunk", F.transform("v", lambda x: x - F.array_min("v")).alias("v"))
    right = _neighbour(ends, "v", 1).select(F.col("conv").alias("c"), F.col("chunk").alias("k"),
                                            F.coalesce("near", end.cast("array<long>")).alias("right"))
    return _solve(chunks.join(right, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))))


def _traced(solved: DataFrame, most: int) -> DataFrame:
    """(conv, chunk, codes, edits, cost): every chunk's edits, traced from the state its predecessors end in."""
    kind = solved.schema["conv"].dataType.simpleString()
    lasts = solved.groupBy("conv").agg(F.max("chunk").alias("last"))
    marked = solved.join(lasts.withColumnRenamed("conv", "c"), F.col("conv").eqNullSafe(F.col("c"))).select(
        "conv", "chunk", "codes", "right", (F.col("chunk") == F.col("last")).alias("last"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, LANES):
                part = batch.slice(lo, LANES)
                codes, last = _codes(part.column(2)), np.array(part.column(4).to_pylist(), bool)
                costs = backward(codes, np.array(part.column(3).to_pylist(), np.int64))
                paths = [trace(codes, costs, np.full(len(codes), s), last) for s in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([[bytes(p[0][i]).decode() for p in paths] for i in range(len(codes))], pa.list_(pa.string())),
                     pa.array([[int(p[1][i]) for p in paths] for i in range(len(codes))], pa.list_(pa.int64())),
                     pa.array([[int(p[2][i]) for p in paths] for i in range(len(codes))], pa.list_(pa.int32()))],
                    ["conv", "chunk", "codes", "edits", "cost", "exit"])

    paths = marked.mapInArrow(run, f"conv {kind}, chunk long, codes binary, edits array<string>, cost array<long>, exit array<int>")
    if not most:
        return paths.select("conv", "chunk", "codes", F.get("edits", F.lit(START)).alias("edits"),
                            F.get("cost", F.lit(START)).alias("cost"), F.lit(START).alias("entry"))
    paths = written(paths, "chunk-paths")
    # exit states over ever longer stretches to the left: the state after a chunk, from each state at the stretch's start
    maps, step = paths.select("conv", "chunk", F.col("exit").alias("m")), 1
    while step <= most:
        maps = written(_neighbour(maps, "m", -step).select(
            "conv", "chunk", F.when(F.col("near").isNull(), F.col("m"))
            .otherwise(F.transform("near", lambda s: F.get("m", s))).alias("m")), "chunk-exits")
        step *= 2
    entry = _neighbour(maps, "m", -1).select(F.col("conv").alias("c"), F.col("chunk").alias("k"),
                                             F.coalesce(F.get("near", F.lit(START)), F.lit(START)).alias("entry"))
    at = F.col("entry")
    return paths.join(entry, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))).select(
        "conv", "chunk", "codes", F.get("edits", at).alias("edits"), F.get("cost", at).alias("cost"), "entry")


def _turns_of(codes: bytes, edits: str, entry: int) -> Iterator[tuple[int, str | None]]:
    """(row, new role) of a chunk's repaired turns in order; row -1 for an inserted one, null role for a kept one."""
    row, state = 0, entry
    for letter in edits:
        if letter == "I":
            state = int(GIVEN[state])
            yield -1, ROLES[state]
            continue
        if letter == "K":
            state = int(KEPT[state, codes[row] % 4])
            yield row, None
        elif letter == "R":
            state = int(GIVEN[state])
            yield row, ROLES[state]
        row += 1


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           chunk_rows: int = CHUNK_ROWS) -> Repaired:
    """The cheapest legal form of every conversation of `turns`.

    Turns are ordered by `place`, which may have gaps; edits are ordered by
    `chunk`. The report has one row per conversation: gaps (turn numbers
    missing between the least and the greatest), blank, duplicate and
    truncated (rows by their first fault), illegal (adjacent role initials
    other than su, ua, au), and cost. A conversation that is deleted as a whole
    has no turns, but a report and edits.
    """
    rows = ordered_turns(turns, conv, turn, role, text)
    chunks = written(chunked(rows, chunk_rows), "turn-chunks")
    most = chunks.agg(F.coalesce(F.max("chunk"), F.lit(0))).first()[0]
    traced = written(_traced(stitched_costs(chunks.select("conv", "chunk", "codes"), most), most), "turn-edits")
    kind = traced.schema["conv"].dataType.simpleString()
    places = 4 * chunk_rows + 4  # a chunk has no more turns than this, inserted ones included

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, codes, edits, entry = (batch.column(c)[i].as_py() for c in (1, 2, 3, 4))
                made = list(_turns_of(codes, edits, entry))
                if made:
                    at = [None if r < 0 else chunk * chunk_rows + r for r, _ in made]
                    yield pa.RecordBatch.from_arrays(
                        [pa.concat_arrays([batch.column(0).slice(i, 1)] * len(made)),
                         pa.array([chunk * places + j for j in range(len(made))], pa.int64()),
                         pa.array(at, pa.int64()), pa.array([r for _, r in made], pa.string())], ["conv", "place", "row", "given"])

    plan = traced.select("conv", "chunk", "codes", "edits", "entry").mapInArrow(run, f"conv {kind}, place long, row long, given string")
    kept = plan.filter("row IS NOT NULL").join(
        rows.select(F.col("conv").alias("c"), "at", "role", "text"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("row") == F.col("at")))
    out = (kept.select("conv", "place", F.coalesce("given", "role").alias("role"), "text")
           .unionByName(plan.filter("row IS NULL").select("conv", "place", F.col("given").alias("role"), F.lit("").alias("text"))))
    return Repaired(out.withColumnRenamed("conv", conv), _report(rows, chunks, traced).withColumnRenamed("conv", conv),
                    traced.select(F.col("conv").alias(conv), "chunk", "edits"))


def _report(rows: DataFrame, chunks: DataFrame, traced: DataFrame) -> DataFrame:
    names = ("blank", "duplicate", "truncated")
    by_turn = rows.groupBy("conv", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in names])
    faults = by_turn.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"), *[F.sum(f).alias(f) for f in names])
    across = F.coalesce(wrong_pair(F.col("tail"), F.col("near")), F.lit(0))
    pairs = _neighbour(chunks.drop("codes"), "head", 1).groupBy("conv").agg(F.sum(F.col("illegal") + across).alias("illegal"))
    costs = traced.groupBy("conv").agg(F.sum("cost").alias("cost"))
    same = lambda other: F.col("f.conv").eqNullSafe(F.col(f"{other}.conv"))
    return (faults.alias("f").join(pairs.alias("p"), same("p")).join(costs.alias("k"), same("k"))
            .select("f.conv", "gaps", *names, "illegal", "cost"))


def conversation_digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conversation, repaired_sha256): the hash of `role:text` of every turn by `place`, joined by newlines.

    A hash is a matter of order, so a conversation's turns stream through one
    task; it holds no more than the hash.
    """
    kind = turns.schema[conv].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            ids, digests = [], []
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if state is not None and key == current:
                    state.update(b"\n" + line.encode())
                    continue
                if state is not None:
                    ids.append(current)
                    digests.append(state.hexdigest())
                current, state = key, hashlib.sha256(line.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, key_type), pa.array(digests, pa.string())], [conv, "repaired_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current], key_type), pa.array([state.hexdigest()], pa.string())], [conv, "repaired_sha256"])

    key_type = to_arrow_type(turns.schema[conv].dataType)
    lines = turns.select(conv, F.concat("role", F.lit(":"), "text").alias("line"), "place")
    return (lines.repartition(conv).sortWithinPartitions(conv, "place").select(conv, "line")
            .mapInArrow(run, f"{conv} {kind}, repaired_sha256 string"))
