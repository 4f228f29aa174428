"""Conversations with their roles repaired at the least cost, rendered as one text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.ordering import ROW_BITS, in_order, range_of
from tidegrid.session import materialize

ROLES = ("system", "user", "assistant")
START = 3
#: Legal successors: a conversation is [system] (user assistant)+; state 3 is its beginning.
FOLLOWS = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
LAST = 2
MERGE, RELABEL, NAME, INSERT = 2, 3, 1, 4
#: Input turns of a conversation that go into one row of the result.
PART_TURNS = 1024
OPEN, CLOSE, GLUE = "<|{}|>\n", "<|end|>\n", "\n\n"
NEVER = 1 << 40


def role_class(role: str | None) -> int:
    """Place of a role in ``ROLES``, in any case and with spaces around; 3 if it is none of them."""
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES else len(ROLES)


def _paths() -> dict[tuple[int, int], tuple[int, ...]]:
    """Shortest legal chains of turns from a state to one before each role: what must be inserted."""
    paths = {}
    for source in FOLLOWS:
        seen, edge = {source: ()}, [source]
        while edge:
            nodes, edge = edge, []
            for node in nodes:
                for to in FOLLOWS[node]:
                    if (source, to) not in paths:
                        paths[source, to] = seen[node]
                    if to not in seen:
                        seen[to] = (*seen[node], to)
                        edge.append(to)
    return paths


PATHS = _paths()


def _moves() -> tuple[np.ndarray, dict]:
    """Cost of taking a turn of a class from one state to another, and the cheapest way to do it.

    A way is (inserted roles, whether the turn is merged into the one before). Of equally cheap ways
    merging comes first.
    """
    cost = np.full((len(ROLES) + 1, 4, 4), NEVER, dtype=np.int64)
    ways = {}
    for kind in range(len(ROLES) + 1):
        for state in range(4):
            for to in range(len(ROLES)):
                change = 0 if kind == to else NAME if kind == len(ROLES) else RELABEL
                options = [(INSERT * len(PATHS[state, to]) + change, 1, PATHS[state, to], False)] if (state, to) in PATHS else []
                if state == to:
                    options.append((MERGE + change, 0, (), True))
                if options:
                    best = min(options)
                    cost[kind, state, to] = best[0]
                    ways[kind, state, to] = best[2:]
    return cost, ways


COST, WAYS = _moves()
#: Cost of ending after each state, and the turns that must be inserted for it.
END = {s: () if s == LAST else (*PATHS[s, LAST], LAST) for s in FOLLOWS}
END_COST = np.array([INSERT * len(END[s]) for s in range(4)])


def forward(kinds: list[int], entry: np.ndarray) -> np.ndarray:
    """Least cost of each state after the turns, from the costs of the states before them."""
    for kind in kinds:
        entry = np.minimum((entry[:, None] + COST[kind]).min(axis=0), NEVER)
    return entry


BEGINNING = np.array([NEVER, NEVER, NEVER, 0])


def repair(kinds: list[int], entry: np.ndarray, leave: int | None) -> list[int]:
    """States before the first and after each turn on a cheapest path, from the costs of the states
    before them to ``leave``; if that is None, to the state of least cost with that of ending there.
    Ties go to the state that comes first in ``ROLES``, from the end on."""
    costs = [entry]
    for kind in kinds:
        costs.append(forward([kind], costs[-1]))
    state = int((costs[-1] + END_COST).argmin()) if leave is None else leave
    states = [state]
    for i in range(len(kinds), 0, -1):
        state = int((costs[i - 1] + COST[kinds[i - 1]][:, state]).argmin())
        states.append(state)
    return states[::-1]


def fragments(kinds: list[int], texts: list[str | None], entry: np.ndarray = BEGINNING, leave: int | None = None):
    """For every turn (rendered piece, cost, merges, relabels, inserts, turns begun).

    The pieces of a conversation in order are its rendered text; the last one closes it.
    """
    out, states = [], repair(kinds, entry, leave)
    for i, (kind, text) in enumerate(zip(kinds, texts, strict=True)):
        state, to = states[i], states[i + 1]
        inserted, joined = WAYS[kind, state, to]
        begun = [*inserted, *(() if joined else (to,))]
        ending = END[to] if leave is None and i == len(kinds) - 1 else ()
        piece = [GLUE] if joined else []
        for role in begun:
            piece.append((CLOSE if state != START else "") + OPEN.format(ROLES[role]))
            state = role
        piece.append(text or "")
        piece += [CLOSE + OPEN.format(ROLES[role]) for role in ending]
        if leave is None and i == len(kinds) - 1:
            piece.append(CLOSE)
        cost = int(COST[kind, states[i], to]) + INSERT * len(ending)
        out.append(("".join(piece), cost, int(joined), int(kind != to), len(inserted) + len(ending), len(begun) + len(ending)))
    return out


def _stretches(batches: Iterator[pa.RecordBatch]):
    """Consecutive rows of one conversation in one range: (range, key, first place, kinds, texts)."""
    held = None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            key = (row[0] >> ROW_BITS, row[1])
            if held is None or held[0] != key:
                if held:
                    yield held
                held = (key, row[0], [], [])
            held[2].append(role_class(row[2]))
            held[3].append(row[3] if len(row) > 3 else None)
    if held:
        yield held


def render_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Repaired conversations: one row for each ``PART_TURNS`` input turns of a conversation.

    Columns: the conversation, ``part`` (from 0), ``n_turns`` (input turns), ``n_rendered`` (turns begun),
    ``cost``, ``merges``, ``relabels``, ``inserts`` and ``text``. The texts of the parts in order are the
    rendered conversation; most conversations have one part.

    A rendered conversation is an optional system turn and then pairs of a user and an assistant
    turn. Turns are merged into the one before (cost 2), relabelled (3; 1 for a role that is none
    of the three) or completed by empty turns (4 each); the sum is the least possible. Roles count
    in any case and with spaces around them. No turn is dropped: a null text is empty, a null role an
    unknown one. Turns come by number (null first), then role, then text; repeated rows are turns
    of their own. Null conversations are one conversation. Other columns are ignored.

    Conversations may span many tasks: the least costs between any two states over a stretch of
    turns form a small matrix, and the matrices of its stretches decide in which state each is
    entered and left.
    """
    key = F.col("conv")
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    ordered = in_order(rows, [key, F.col("turn"), F.col("role"), F.col("text")], "_at")
    bounds = _bounds(ordered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (stretch, conv), _, kinds, texts in _stretches(batches):
            before, entry, leave = bounds.get((stretch, conv), (0, BEGINNING, None))
            pieces = fragments(kinds, texts, entry, leave)
            for part in range(before // PART_TURNS, (before + len(pieces) - 1) // PART_TURNS + 1):
                lo, hi = max(part * PART_TURNS - before, 0), min((part + 1) * PART_TURNS - before, len(pieces))
                mine = pieces[lo:hi]
                begins = (before + lo) % PART_TURNS == 0
                ends = (before + hi) % PART_TURNS == 0 or (hi == len(pieces) and leave is None)
                sums = [sum(p[i] for p in mine) for i in range(1, 6)]
                out.append((conv, part, stretch, begins and ends, len(mine), *sums, "".join(p[0] for p in mine)))
            if len(out) >= 1000:
                yield to_batch(out)
                out = []
        yield to_batch(out)

    names = ["part", "stretch", "whole", "n_turns", "cost", "merges", "relabels", "inserts", "n_rendered", "text"]
    counts = ", ".join(f"{n} long" for n in names[3:-1])
    schema = rows.select("conv").schema
    for column in f"part long, stretch long, whole boolean, {counts}, text string".split(", "):
        schema = schema.add(*column.split(" "))
    conv_type = _arrow_type(rows.select("conv"))
    kinds = [conv_type, pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string()]

    def to_batch(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * len(kinds)
        arrays = [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["conv", *names])

    dealt = ordered.withColumn("_range", range_of("_at")).repartition("_range").sortWithinPartitions("_at")
    parts = materialize(dealt.select("_at", "conv", "role", "text").mapInArrow(run, schema), "chats")
    sums = [F.sum(c).alias(c) for c in names[3:-1]]
    in_turn = F.transform(F.array_sort(F.collect_list(F.struct("stretch", "text"))), lambda x: x["text"])
    glued = parts.where("NOT whole").groupBy("conv", "part").agg(*sums, F.array_join(in_turn, "").alias("text"))
    whole = parts.where("whole").drop("stretch", "whole")
    wanted = ["part", "n_turns", "n_rendered", "cost", "merges", "relabels", "inserts", "text"]
    return whole.unionByName(glued).select(F.col("conv").alias(conv_col), *wanted)


def _arrow_type(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[0].dataType)


def _bounds(ordered: DataFrame) -> dict:
    """For each stretch of a conversation that spans ranges: turns before it, entry state, exit state.

    An edge between two ranges cuts one conversation at most, so that there are at most twice as
    many such stretches as there are ranges.
    """
    ends = ordered.groupBy(range_of("_at").alias("_range")).agg(
        F.min(F.struct("_at", "conv")).alias("first"), F.max(F.struct("_at", "conv")).alias("last")
    )
    edges = sorted(ends.select("_range", F.col("first.conv").alias("a"), F.col("last.conv").alias("b")).collect())
    cut = {left.b for left, right in zip(edges, edges[1:], strict=False) if left.b == right.a}
    if not cut:
        return {}
    kind = ordered.select("conv").schema[0].dataType.simpleString()
    convs = list(cut)
    chosen = ordered.sparkSession.createDataFrame(list(enumerate(convs)), f"_index long, _cut {kind}")
    slim = ordered.join(F.broadcast(chosen), F.col("conv").eqNullSafe(F.col("_cut")))
    dealt = slim.withColumn("_range", range_of("_at")).repartition("_range").sortWithinPartitions("_at")
    dealt = dealt.select("_at", "_index", "role")

    def over_stretches(solve) -> list:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (stretch, index), _, kinds, _ in _stretches(batches):
                row = {"conv": index, "stretch": stretch, "n": len(kinds), "found": solve(stretch, index, kinds)}
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("conv", pa.int64()), ("stretch", pa.int64()), ("n", pa.int64()), ("found", pa.list_(pa.int64()))]))

        return sorted(dealt.mapInArrow(run, "conv long, stretch long, n long, found array<long>").collect())

    only = np.where(np.eye(4, dtype=bool), 0, NEVER)
    matrices = over_stretches(lambda _, __, kinds: [int(c) for state in only for c in forward(kinds, state)])
    before, entries, last = {}, {}, {}
    for r in matrices:
        key = (r.stretch, r.conv)
        n, vector = last.get(r.conv, (0, BEGINNING))
        before[key], entries[key] = n, vector
        table = np.array(r.found).reshape(4, 4)
        last[r.conv] = n + r.n, np.minimum((vector[:, None] + table).min(axis=0), NEVER)
    # The state in which a stretch must be entered, by the one in which it is left.
    ways = over_stretches(lambda stretch, index, kinds: [repair(kinds, entries[stretch, index], s)[0] for s in range(4)])
    bounds, leave = {}, {}
    for r in reversed(ways):
        state = leave.get(r.conv)
        bounds[r.stretch, convs[r.conv]] = before[r.stretch, r.conv], entries[r.stretch, r.conv], state
        at = int((last[r.conv][1] + END_COST).argmin()) if state is None else state
        leave[r.conv] = r.found[at]
    return bounds
