"""Records of JSON files, cut out of text that Spark deals to many tasks.

A file holds an array of records, indented or not, or one record after another. Records may hold
anything that JSON allows: nested objects and arrays, and braces, quotes and line ends inside texts.

What a byte means depends on two things: whether it stands inside a text, and how many objects and
arrays are open. Each stretch of text maps the state before it to the state behind it, whatever the former may be:
the quotes of a stretch say whether a text is open behind it, and there are two ways to count its brackets, one for each answer to
the question whether a text was open before. Such maps are worked out side by side and then
put together in the order of the file, so that each stretch knows its state exactly; nothing is guessed from its contents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import broadcast_if_small, materialize

#: A stretch ends at the first closing brace after so many bytes, or with its split of the file.
STRETCH_BYTES = 1 << 20

QUOTE, OPEN_BRACE, OPEN_BRACKET = 0x22, 0x7B, 0x5B
_SIGN = np.zeros(256, dtype=np.int64)
_SIGN[[OPEN_BRACE, OPEN_BRACKET]] = 1
_SIGN[[0x7D, 0x5D]] = -1
_MARKED = _SIGN != 0
_MARKED[QUOTE] = True
_BETWEEN = np.zeros(256, dtype=bool)
_BETWEEN[list(b" \t\r\n,[]")] = True
_ESCAPE = re.compile(rb"\\.", re.DOTALL)
_BOM = b"\xef\xbb\xbf"
#: Stands for text between records that is not JSON; it is no record.
STRAY = b"?"

RECORD, EDGE, STRETCH = 0, 1, 2
LANDED = (
    "shot_dir string, file string, source_block bigint, seq int, kind int, text binary, base int, "
    "text0 int, depth0 bigint, low0 bigint, text1 int, depth1 bigint, low1 bigint"
)
_NAMES = [c.split()[0] for c in LANDED.split(", ")]
_TYPES = [{"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]] for c in LANDED.split(", ")]


@dataclass
class State:
    """Where a stretch begins: inside a text or not, what is open, and how much is open between records."""

    in_text: int = 0
    depth: int = 0
    base: int | None = None

    @property
    def in_record(self) -> bool:
        return self.base is not None and self.depth > self.base


class Marks:
    """Quotes and brackets of a stretch, which does not begin behind a backslash."""

    def __init__(self, data: bytes):
        self.data = data
        self.bytes = np.frombuffer(_ESCAPE.sub(b"__", data) if b"\\" in data else data, dtype=np.uint8)
        self.at = np.flatnonzero(_MARKED[self.bytes])
        self.sign = _SIGN[self.bytes[self.at]]
        quotes = self.sign == 0
        self.quoted = (np.cumsum(quotes) - quotes) & 1  # inside a text, if none was open before
        self.quotes = int(quotes.sum())

    def brackets(self, in_text: int) -> tuple[np.ndarray, np.ndarray]:
        """Place and sign of the brackets outside of texts."""
        real = (self.sign != 0) & (self.quoted == in_text)
        return self.at[real], self.sign[real]

    def map(self, in_text: int) -> tuple[int, int, int]:
        """Whether a text is open behind the stretch; how the depth changes, and its lowest change on the way."""
        change = np.cumsum(self.brackets(in_text)[1])
        return (in_text + self.quotes) & 1, int(change[-1]) if len(change) else 0, int(change.min(initial=0))


@dataclass
class Cut:
    """Parts of a stretch: the rest of a record begun before it, whole records, the start of one that goes on."""

    head: bytes | None
    records: list[bytes]
    tail: bytes | None
    after: State


def cut(data: bytes, before: State) -> Cut:
    """Cut a stretch at its records. ``head`` is all of it if the record goes on behind it, too (then
    ``after`` is still in a record and there is no tail). Anything but space, commas and brackets between records gives a stray one."""
    if before.base is None:
        start = data.lstrip()[:1]
        if not start:
            return Cut(None, [], None, before)
        before = State(before.in_text, before.depth, int(start == b"["))
    marks, base = Marks(data), before.base
    at, sign = marks.brackets(before.in_text)
    depth = before.depth + np.cumsum(sign)
    begins = at[(sign > 0) & (depth == base + 1)]
    ends = at[(sign < 0) & (depth == base)] + 1
    after = State((before.in_text + marks.quotes) & 1, int(depth[-1]) if len(depth) else before.depth, base)
    head = tail = None
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    if before.in_record:
        if not len(ends):
            return Cut(data, [], None, after)
        head, ends = data[: ends[0]], ends[1:]
        inside[0] += 1
        inside[len(head)] -= 1
    if after.in_record:
        tail, begins = data[begins[-1] :], begins[:-1]
        inside[len(data) - len(tail)] += 1
    records = [data[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
    np.add.at(inside, begins, 1)
    np.add.at(inside, ends, -1)
    outside = marks.bytes[np.cumsum(inside[:-1]) == 0]
    if not _BETWEEN[outside].all() or (len(depth) and depth.min() < 0):
        records.append(STRAY)
    return Cut(head, records, tail, after)


def finished(data: bytes, before: State) -> tuple[bytes, list[bytes]]:
    """The last stretch of a file, with the brace that the reader of lines took from its end, and what is wrong with the file.

    Whether that brace was there can't be told, so that one too few or too many as the last byte
    of a file of records one after another goes unnoticed.
    """
    after = cut(data, before).after
    if after == State(0, 1, 0):
        data, after = data + b"}", State(0, 0, 0)
    return data, [STRAY] if after.in_text or after.depth else []


class _Split:
    """One split of one file: records right away if it is the first, else stretches with their maps."""

    def __init__(self, shot_dir: str, file: str, block: int, whole: bool):
        self.key, self.block, self.whole = (shot_dir, file, block), block, whole
        self.pieces: list[bytes] = []
        self.size = self.seq = 0
        self.state, self.held = State(), []

    def add(self, piece: bytes) -> list[tuple]:
        """Each piece follows a closing brace, but for the first one of the file."""
        if self.block == 0 and not self.pieces and not self.seq:
            piece = piece.removeprefix(_BOM)
        else:
            self.pieces.append(b"}")
        self.pieces.append(piece)
        self.size += len(piece) + 1
        return self.flush() if self.size >= STRETCH_BYTES else []

    def flush(self, last: bool = False) -> list[tuple]:
        data, self.pieces, self.size, seq = b"".join(self.pieces), [], 0, self.seq
        self.seq += 1
        if self.block:
            marks = Marks(data)
            return [(*self.key, seq, STRETCH, data, None, *marks.map(0), *marks.map(1))] if data else []
        wrong = []
        if last and self.whole:
            data, wrong = finished(data, self.state)
        parts = cut(data, self.state)
        self.state, records = parts.after, parts.records
        if parts.head is not None:
            self.held.append(parts.head)
            if parts.tail is not None or not self.state.in_record:
                records, self.held = [b"".join(self.held), *records], []
        if parts.tail is not None:
            self.held = [parts.tail]
        nothing = (None,) * 7
        rows = [(*self.key, seq, RECORD, r, *nothing) for r in [*records, *wrong]]
        if last and not self.whole:
            s = self.state
            rows.append((*self.key, seq, EDGE, b"".join(self.held), s.base, s.in_text, s.depth, 0, 0, 0, 0))
        return rows


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    split, key = None, None
    for batch in batches:
        rows = []
        for *at, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != key:
                rows += split.flush(last=True) if split else []
                split, key = _Split(*at), at
            rows += split.add(piece)
        yield _batch(rows, _NAMES, _TYPES)
    if split:
        yield _batch(split.flush(last=True), _NAMES, _TYPES)


STATES = "file string, source_block bigint, seq int, in_text int, depth bigint, base int, owner_block bigint, owner_seq int, last boolean"
_STATE_NAMES = [c.split()[0] for c in STATES.split(", ")]
_STATE_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the maps of a file together, stretch by stretch: the state before each one, and which
    stretch began the record that is open there. Rows come in the order of the file."""
    held, file, state, owner = None, None, State(), (None, None)
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["file"] != file:
                if held:
                    out.append((*held, True))
                held, file, state, owner = None, row["file"], State(base=0), (None, None)
            if held:
                out.append((*held, False))
            here = (row["source_block"], row["seq"])
            held = (file, *here, state.in_text, state.depth, state.base, *owner)
            if row["kind"] == EDGE:
                state = State(row["text0"], row["depth0"], row["base"] or 0)
                owner = here if state.in_record else (None, None)
                continue
            in_text, change, low = (row[f"{c}{state.in_text}"] for c in ("text", "depth", "low"))
            same = state.in_record and state.depth + low > state.base
            state = State(in_text, state.depth + change, state.base)
            owner = (owner if same else here) if state.in_record else (None, None)
        yield _batch(out, _STATE_NAMES, _STATE_TYPES)
    if held:
        yield _batch([(*held, True)], _STATE_NAMES, _STATE_TYPES)


PARTS = (
    "shot_dir string, file string, source_block bigint, source_row bigint, "
    "owner_block bigint, owner_seq int, place bigint, text binary"
)
_PART_NAMES = [c.split()[0] for c in PARTS.split(", ")]
_PART_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
_ROW_BITS, _TASK_BITS = 33, 17


def _source_row(at: int, ordinal: int) -> int:
    """Rises with the place in the split: task, stretch, record."""
    task, row = at >> _ROW_BITS, at & ((1 << _ROW_BITS) - 1)
    return (((task << _TASK_BITS) | row) << 24) | ordinal


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and parts of those that go over the edge of a stretch with the one that began it."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            key, data, at = (row["shot_dir"], row["file"], row["source_block"]), row["text"], row["at"]
            own, none = (row["source_block"], row["seq"]), (None, None)
            if row["kind"] == EDGE:
                state = State(row["text0"], row["depth0"], row["base"])
                closing, wrong = finished(b" ", state) if row["last"] else (b" ", [])
                if state.in_record:
                    out.append((*key, at, *own, at, data + closing[1:]))
                out += [(*key, at, *none, at, r) for r in wrong]
                continue
            before = State(row["in_text"], row["depth"], row["state_base"])
            wrong = []
            if row["last"]:
                data, wrong = finished(data, before)
            parts = cut(data, before)
            if parts.head is not None:
                out.append((*key, at, row["owner_block"], row["owner_seq"], at, parts.head))
            for i, record in enumerate([*parts.records, *wrong]):
                out.append((*key, _source_row(at, i), *none, at, record))
            if parts.tail is not None:
                out.append((*key, _source_row(at, len(parts.records)), *own, at, parts.tail))
        yield _batch(out, _PART_NAMES, _PART_TYPES)


def read_records(text: DataFrame) -> DataFrame:
    """``(shot_dir, source_block, source_row, record)``: every record as a map of texts.

    ``text`` has the columns ``shot_dir``, ``file``, ``source_block`` (first byte of the split),
    ``whole`` (whether the split is the whole file) and ``value``, the text between closing braces in
    the order of the file; each file is read once. Nested values are texts of JSON. What is no record comes as a null one.
    Only stretches behind the first split of a large file are written and read again to be cut.
    """
    pieces = text.select("shot_dir", "file", "source_block", "whole", F.col("value").cast("binary").alias("value"))
    landed = materialize(pieces.mapInArrow(_scan, LANDED).withColumn("at", F.monotonically_increasing_id()), "records")
    columns = ["shot_dir", "source_block", "source_row", "text"]
    records = landed.where(f"kind = {RECORD}").withColumn("source_row", F.col("at")).select(columns)
    later = landed.where(f"kind > {RECORD}")
    if not later.isEmpty():
        records = records.unionByName(materialize(_joined(later), "joined").select(columns))
    strict = {"allowSingleQuotes": "false"}
    return records.withColumn("record", F.from_json(F.col("text").cast("string"), "map<string,string>", strict)).drop("text")


def _joined(later: DataFrame) -> DataFrame:
    """Records of the splits behind the first one of a file, and of those that reach into them."""
    maps = later.drop("shot_dir", "text", "at").repartition("file")
    states = maps.sortWithinPartitions("file", "source_block", "seq").mapInArrow(_states, STATES)
    states = states.withColumnRenamed("base", "state_base")
    states, _ = broadcast_if_small(materialize(states, "states"))
    known = later.join(states, ["file", "source_block", "seq"])
    parts = materialize(known.mapInArrow(_parts, PARTS), "parts")
    whole = parts.where("owner_seq is null")
    pieces = F.array_sort(F.collect_list(F.struct("source_block", "place", "source_row", "text")))
    first = F.get("pieces", F.lit(0))
    glued = (
        parts.where("owner_seq is not null")
        .groupBy("shot_dir", "file", "owner_block", "owner_seq")
        .agg(pieces.alias("pieces"))
        .select(
            "shot_dir", first["source_block"].alias("source_block"), first["source_row"].alias("source_row"),
            F.expr("aggregate(pieces, X'', (all, p) -> all || p.text)").alias("text"),
        )
    )
    columns = ["shot_dir", "source_block", "source_row", "text"]
    return whole.select(columns).unionByName(glued.select(columns))
