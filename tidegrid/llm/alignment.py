"""Which tokens of two tokenizers stand for the same bytes of a text, and how often they do.

A document's bytes are cut wherever a token of both tokenizers ends. Between two cuts lies a group:
some tokens of the left one and some of the right one that cover the same bytes. Every left token
of a group is linked to every right one. Over all documents each pair of ids has a count, the
number of documents that hold it linked; the best partners of a left id are those of the highest count.

Documents go through Arrow tables in blocks of about three quarters of a megabyte of text; a longer one is a block of
its own. Only what a block needs of the corpus-wide counts comes back to it: one number for each of its
pairs, however often and in however many of its documents they are linked.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.text import slabs, text_bytes
from tidegrid.llm.units import UnitEncoder, together, units_at
from tidegrid.session import materialize

SPACE, MARK = 0x20, "▁"
#: Bits of an id in a pair of ids, and of a byte's place in a text.
ID_BITS, END_BITS = 20, 32
#: Bits of a number of documents in what is sent back to a block for each of its pairs, and of a block's
#: documents in its list of pairs (each that counts has a byte of text or more).
COUNT_BITS, HELD_BITS = 36, 23
#: Bytes of text in a block, and characters of the units that a task remembers.
BLOCK_BYTES = 3 << 18
MEMO_CHARS = 2 << 20


@dataclass(frozen=True)
class Side:
    """One tokenizer: ``kind`` is a key of ``KINDS``, ``path`` its file."""

    kind: str
    path: str


def _byte_level(path: str) -> tuple[Callable, list[bytes]]:
    """A byte-level vocabulary: each character of an entry stands for one byte.

    Printable bytes stand for themselves, the others for the characters from 256 on, in their order.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    names = [tokenizer.id_to_token(i) or "" for i in range(size)]
    spelled = [bytes(byte_of[c] for c in n) if all(c in byte_of for c in n) else n.encode() for n in names]
    return (lambda units: [e.ids for e in tokenizer.encode_batch_fast(units, add_special_tokens=False)]), spelled


def _pieces(path: str) -> tuple[Callable, list[bytes]]:
    """A vocabulary of pieces that adds the space in front of a text by itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    mark = [model.piece_to_id(MARK)]

    def encode(units: list[str]) -> list[list[int]]:
        found = model.encode([u[1:] for u in units], num_threads=1)
        return [ids if len(u) > 1 else mark for u, ids in zip(units, found)]  # nothing is added to nothing

    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    single = [re.fullmatch(r"<0x([0-9A-F]{2})>", n) for n in names]
    spelled = [bytes([int(m[1], 16)]) if m else n.replace(MARK, " ").encode() for n, m in zip(names, single)]
    return encode, spelled


KINDS = {"byte_level": _byte_level, "pieces": _pieces}


@dataclass(frozen=True)
class Loaded:
    """Encodes units, all of which begin with a space; the bytes of each id, their number, and the id as text."""

    encode: Callable
    spelled: pa.Array
    sizes: pa.Array
    names: pa.Array


@lru_cache(maxsize=4)
def load(side: Side) -> Loaded:
    """A tokenizer, read once in a process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encode, spelled = KINDS[side.kind](side.path)
    if len(spelled) >= 1 << ID_BITS:
        raise ValueError(f"vocabulary too large: {side.path}")
    lengths = np.array([len(b) for b in spelled])

    def cut(ids: np.ndarray, units: list[str]) -> np.ndarray | None:
        """Where the bytes that the ids spell reach the end of each unit."""
        ends, last = np.cumsum(lengths[ids]), np.cumsum([len(u) if u.isascii() else len(u.encode()) for u in units])
        at = np.searchsorted(ends, last)
        exact = len(ends) and ends[-1] == last[-1] and (ends[at] == last).all()
        return at + 1 if exact else None

    names = pa.array([str(i) for i in range(len(spelled))])
    return Loaded(together(encode, cut), pa.array(spelled, pa.large_binary()), pa.array(lengths), names)


@lru_cache(maxsize=2)
def encoder_of(left: Side, right: Side) -> UnitEncoder:
    return UnitEncoder(load(left).encode, load(right).encode, memo_chars=MEMO_CHARS)


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the units of rows begin that start with a space: a place where both tokenizers end a token.

    A unit begins before each space that does not follow white space: neither tokenizer has a token
    with a space behind anything but white space. Characters that end like a wide space count as white space.
    """
    before = data[:-1]
    solid = (before > SPACE) & (before != 0x7F)
    wide = np.zeros(len(before), dtype=bool)
    wide[1:] |= (data[:-2] == 0xC2) & np.isin(before[1:], (0x85, 0xA0))
    wide[2:] |= (data[:-3] == 0xE2) & np.isin(data[1:-2], (0x80, 0x81))
    wide[2:] |= (data[:-3] == 0xE1) & (data[1:-2] == 0x9A)
    wide[2:] |= (data[:-3] == 0xE3) & (data[1:-2] == 0x80)
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = (data[1:] == SPACE) & solid & ~wide
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins)


def with_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows with a space in front of each one that is not empty."""
    filled = offsets[1:] > offsets[:-1]
    out = np.insert(data, offsets[:-1][filled], SPACE)
    return out, offsets + np.concatenate([[0], np.cumsum(filled)])


def _lists(coded: pa.DictionaryArray, distinct: pa.ListArray, bounds: np.ndarray) -> pa.ListArray:
    """Token ids of each row; ``bounds`` are the rows' first units."""
    every = distinct.take(coded.indices)
    starts = every.offsets.to_numpy()
    return pa.ListArray.from_arrays(pa.array(starts[bounds], pa.int32()), every.flatten())


def _raw(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all cells (large binary, none null) one after another, and where each cell's begin."""
    _, offsets, data = cells.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[cells.offset : cells.offset + len(cells) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _spelled(lists: pa.ListArray, spelled: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that the lists of ids spell, one after another, and where each list's begin."""
    data, offsets = _raw(spelled.take(lists.flatten()))
    return data, offsets[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


def _spells(lists: pa.ListArray, spelled: pa.Array, units: pa.Array) -> np.ndarray:
    """Which lists of ids spell their unit."""
    (have, at), (want, ends) = _spelled(lists, spelled), _raw(units.view(pa.large_binary()))
    good = np.diff(at) == np.diff(ends)
    if not good.all():
        same = pa.array(good)
        good[good] = _spells(lists.filter(same), spelled, units.filter(same))
        return good
    wrong = np.flatnonzero(have != want)
    good[np.unique(np.searchsorted(ends, wrong, "right") - 1)] = False
    return good


def _valid(coded: pa.DictionaryArray, bounds: np.ndarray, rows: pa.Array, sides: list) -> np.ndarray:
    """Rows whose tokens, on both sides, spell the row. A row is spelled out itself if a unit of it is not."""
    good = np.ones(len(coded.dictionary), dtype=bool)
    for distinct, _, spelled in sides:
        good &= _spells(distinct, spelled, coded.dictionary)
    bad = np.concatenate([[0], np.cumsum(~good[coded.indices.to_numpy()])])
    valid = np.diff(bounds) > 0
    doubted = np.flatnonzero(np.diff(bad[bounds]))
    for _, lists, spelled in sides:
        valid[doubted] &= _spells(lists.take(doubted), spelled, rows.take(doubted))
    return valid


def token_table(lists: pa.ListArray, sizes: pa.Array) -> pa.Table:
    """One row a token: its document (index), id, and the byte of the document after it."""
    doc, ids = pc.list_parent_indices(lists), pc.list_flatten(lists)
    total = pc.cumulative_sum(sizes.take(ids))
    starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    base = np.concatenate([[0], total.to_numpy()])[starts[:-1]]
    end = pc.subtract(total, pa.array(base).take(doc))
    return pa.table({"doc": doc, "end": end, "id": ids, "at": pa.array(np.arange(len(ids)))})


def common_ends(left: pa.Table, right: pa.Table) -> pa.Table:
    """Places where a token of both sides ends in the same document at the same byte, in order."""
    sides = []
    for table, name in ((left, "left"), (right, "right")):
        key = pc.bit_wise_or(pc.shift_left(table["doc"].cast(pa.int64()), END_BITS), table["end"])
        sides.append(pa.table({"key": key, name: table["at"]}))
    both = sides[0].join(sides[1], "key", join_type="inner", use_threads=False)
    # A place in the left table has one partner at most, so that rows are put in order without a sort.
    partner = np.full(left.num_rows, -1, dtype=np.int64)
    partner[both["left"].to_numpy()] = both["right"].to_numpy()
    at = np.flatnonzero(partner >= 0)
    return pa.table({"left": at, "right": partner[at], "doc": left["doc"].to_numpy()[at].astype(np.int64)})


def _grouped(tokens: pa.Table, ends: pa.ChunkedArray) -> pa.Table:
    """The tokens of each (group, id) and their number; groups count the common ends before a token."""
    is_end = np.zeros(tokens.num_rows, dtype=np.int64)
    is_end[ends.to_numpy()] = 1
    group = pc.subtract(pc.cumulative_sum(pa.array(is_end)), pa.array(is_end))
    key = pc.bit_wise_or(pc.shift_left(group, ID_BITS), tokens["id"].cast(pa.int64()))
    counted = pa.table({"key": key}).group_by("key", use_threads=False).aggregate([([], "count_all")])
    group, ids = pc.shift_right(counted["key"], ID_BITS), pc.bit_wise_and(counted["key"], (1 << ID_BITS) - 1)
    return pa.table({"group": group, "id": ids, "n": counted["count_all"]})


def links_of(left: pa.Table, right: pa.Table, ends: pa.Table) -> pa.Table:
    """``(doc, pair, n)``, by document: pairs of ids linked in a document and the number of their links."""
    a, b = _grouped(left, ends["left"]), _grouped(right, ends["right"])
    both = a.join(b, "group", join_type="inner", right_suffix="_right", use_threads=False)
    pair = pc.bit_wise_or(pc.shift_left(both["id"], ID_BITS), both["id_right"])
    doc = ends["doc"].take(both["group"])
    key = pc.bit_wise_or(pc.shift_left(doc, 2 * ID_BITS), pair)
    rows = pa.table({"key": key, "n": pc.multiply(both["n"], both["n_right"])})
    summed = rows.group_by("key", use_threads=False).aggregate([("n", "sum")]).sort_by("key").combine_chunks()
    doc, pair = pc.shift_right(summed["key"], 2 * ID_BITS), pc.bit_wise_and(summed["key"], (1 << 2 * ID_BITS) - 1)
    return pa.table({"doc": doc, "pair": pair, "n": summed["n_sum"]})


def _joined(parts: pa.Array, bounds: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), parts), by)


def written_groups(left: pa.Table, right: pa.Table, ends: pa.Table, names: list[pa.Array], rows: int) -> pa.Array:
    """The groups of each document as text: ids of a group ``a1,a2|b1``, groups apart by ``;``."""
    sides = []
    for tokens, side, texts in zip((left, right), ("left", "right"), names):
        bounds = np.concatenate([[0], ends[side].to_numpy() + 1])
        sides.append(_joined(texts.take(tokens["id"].combine_chunks()), bounds, ","))
    groups = pc.binary_join_element_wise(*sides, "|")
    return _joined(groups, np.searchsorted(ends["doc"].to_numpy(), np.arange(rows + 1)), ";")


def align_slab(data: np.ndarray, offsets: np.ndarray, left: Side, right: Side) -> tuple[dict[str, np.ndarray | pa.Array], pa.Table]:
    """Counts and groups of each row of a slab of texts, and the links ``(doc, pair, n)`` of them."""
    sides = [load(left), load(right)]
    data, offsets = with_space(data, offsets)
    starts = unit_starts(data, offsets)
    coded, bounds = units_at(data, starts).dictionary_encode(), np.searchsorted(starts, offsets)
    found = encoder_of(left, right).ids(coded.dictionary.to_pylist())
    listed = [(distinct, _lists(coded, distinct, bounds), side.spelled) for distinct, side in zip(found, sides)]
    valid = _valid(coded, bounds, units_at(data, offsets[:-1]), listed)
    tables = []
    for (_, rows, _), side in zip(listed, sides):
        if not valid.all():
            rows = pc.if_else(pa.array(valid), rows, pa.scalar([], rows.type))
        tables.append(token_table(rows, side.sizes))
    a, b = tables
    ends, rows = common_ends(a, b), len(offsets) - 1
    links = links_of(a, b, ends)
    per_doc = {
        "n_a": np.bincount(a["doc"], minlength=rows), "n_b": np.bincount(b["doc"], minlength=rows),
        "n_groups": np.bincount(ends["doc"], minlength=rows), "n_links": sums_by(links["doc"], links["n"], rows),
        "groups": written_groups(a, b, ends, [s.names for s in sides], rows),
    }
    return per_doc, links


def sums_by(doc: pa.ChunkedArray, n: pa.ChunkedArray, rows: int) -> np.ndarray:
    """Sum of ``n`` for each of the documents 0 to ``rows - 1``, in whose order its rows are."""
    so_far = np.concatenate([[0], np.cumsum(n.to_numpy(), dtype=np.int64)])
    return np.diff(so_far[np.searchsorted(doc.to_numpy(), np.arange(rows + 1))])


DOC = "struct<id: {id}, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups: string>"
BLOCK = "docs array<{doc}>, n_pairs array<int>, links binary, pairs array<bigint>"


def _planes(numbers: np.ndarray) -> np.ndarray:
    """The first bytes of all numbers, then all second ones and so on, most of which are zeros."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T.ravel()


def _numbers(planes: np.ndarray, kind: type, size: int) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, size).T).view(kind).ravel()


def pack_links(place: np.ndarray, n: np.ndarray) -> bytes:
    """Links as compressed bytes: as lists, a row of more than a megabyte, they take Spark several times their size.

    A document's places in the list of pairs rise, so that most of their steps are small (at the next document they wrap).
    """
    steps = np.diff(place.astype(np.uint32), prepend=np.uint32(0))
    return pa.compress(np.concatenate([_planes(steps), _planes(n.astype(np.int64))]), "zstd", asbytes=True)


def unpack_links(packed: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(packed, 12 * size, "zstd"), np.uint8)
    steps, n = _numbers(raw[: 4 * size], np.uint32, size), _numbers(raw[4 * size :], np.int64, size)
    return np.cumsum(steps, dtype=np.uint32), n


def _row(values: list[pa.Array]) -> list[pa.Array]:
    """Each array as the one cell of a column of lists."""
    return [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values]


def _block(ids: pa.Array, per_doc: dict, links: pa.Table) -> pa.RecordBatch:
    """A block as one row: its documents, how many pairs each has, these by place in a list of pairs, and that list.

    The list is in order; each entry also tells how many of the documents hold the pair.
    """
    coded = links["pair"].combine_chunks().dictionary_encode()
    found, of = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(found)
    place = np.empty(len(found), dtype=np.uint32)
    place[order] = np.arange(len(found), dtype=np.uint32)
    held = found[order] << HELD_BITS | np.bincount(of, minlength=len(found))[order]
    names = ["n_a", "n_b", "n_groups", "n_links"]
    docs = pa.StructArray.from_arrays(
        [ids, *[pa.array(per_doc[n].astype(np.int64)) for n in names], per_doc["groups"]], ["id", *names, "groups"]
    )
    sizes = pa.array(np.bincount(links["doc"], minlength=len(ids)).astype(np.int32))
    docs, sizes, pairs = _row([docs, sizes, pa.array(held, pa.int64())])
    packed = pa.array([pack_links(place[of], links["n"].to_numpy())], pa.binary())
    return pa.RecordBatch.from_arrays([docs, sizes, packed, pairs], names=["docs", "n_pairs", "links", "pairs"])


def _pair(a: str, b: str) -> Column:
    """Two ids as one number, as in a block's list of pairs."""
    return F.shiftleft(F.col(a).cast("long"), ID_BITS).bitwiseOR(F.col(b).cast("long"))


@dataclass
class Alignment:
    """``pair_counts``: ``(a, b, n_docs, best)``, one row for each pair of ids linked anywhere.

    ``documents()``: one row a document with its counts and its groups.
    """

    blocks: DataFrame
    pair_counts: DataFrame
    id_col: str

    def documents(self) -> DataFrame:
        """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` for every document."""
        pairs = self.blocks.select("block", F.posexplode("pairs").alias("place", "held"))
        pairs = pairs.select("block", "place", F.shiftright("held", HELD_BITS).alias("pair"))
        counts = self.pair_counts.select(_pair("a", "b").alias("pair"), "n_docs", "best")
        packed = (
            F.shiftleft(F.col("place").cast("long"), COUNT_BITS + 1)
            + F.shiftleft("n_docs", 1)
            + F.col("best").cast("long")
        )
        of_block = pairs.join(counts, "pair").groupBy("block").agg(F.sort_array(F.collect_list(packed)).alias("counts"))
        id_type = self.blocks.schema["docs"].dataType.elementType["id"].dataType
        out = T.StructType([T.StructField("id", id_type)])
        for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
            out = out.add(name, "long")
        rows = self.blocks.drop("pairs").join(of_block, "block", "left").drop("block")
        return rows.mapInArrow(_documents, out.add("groups", "string")).withColumnRenamed("id", self.id_col)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums up, for each document of a block, what the counts of its pairs say about its links."""
    for batch in batches:
        for i in range(batch.num_rows):
            docs, sizes, counts = (batch.column(c)[i].values for c in ("docs", "n_pairs", "counts"))
            place, n = unpack_links(batch.column("links")[i].as_py(), pc.sum(sizes).as_py())
            rows = len(docs)
            doc = pa.array(np.repeat(np.arange(rows), sizes))
            sums = [np.zeros(rows, dtype=np.int64)] * 2
            if len(place):
                packed = counts.to_numpy()[place]
                n_docs = packed >> 1 & (1 << COUNT_BITS) - 1
                sums = [sums_by(doc, pa.array(n * x), rows) for x in (packed & 1, n_docs)]
            columns = [docs.field(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
            columns += [pa.array(sums[0]), pa.array(sums[1]), docs.field("groups")]
            yield pa.RecordBatch.from_arrays(
                columns, names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
            )


def align(
    docs: DataFrame, left: Side, right: Side, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> Alignment:
    """Align the tokens of two tokenizers over every whole text, a space in front of it.

    Tokens of special strings count as plain text. A null or empty text, and one whose tokens do not
    spell it on both sides, has no tokens: zeros and empty groups. Repeated rows are documents of their own, and null ids
    stay. An empty table gives empty results; other columns are ignored, whatever their names. With ``digest``
    the groups are given as the lower-case hex of their SHA-256 (empty, if there are none).

    A text is held whole with its tokens by one task. Links within a group are counted by pairs of
    ids, so that a long run of one token costs no more than one.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = BLOCK.format(doc=DOC.format(id=rows.schema["id"].dataType.simpleString()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slabs(offsets, BLOCK_BYTES):
                at = offsets[lo : hi + 1]
                per_doc, links = align_slab(data[at[0] : at[-1]], at - at[0], left, right)
                if digest:
                    hashed = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in per_doc["groups"].to_pylist()]
                    per_doc["groups"] = pa.array(hashed, pa.string())
                yield _block(batch.column(0).slice(lo, hi - lo), per_doc, links)
        encoder_of(left, right).forget()
        pa.default_memory_pool().release_unused()

    made = rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())
    blocks = materialize(made, "aligned")
    held = blocks.select(F.explode("pairs").alias("held")).select(
        F.shiftright("held", HELD_BITS).alias("pair"), F.col("held").bitwiseAND(F.lit((1 << HELD_BITS) - 1)).alias("n")
    )
    counts = held.groupBy("pair").agg(F.sum("n").alias("n_docs")).select(
        F.shiftright("pair", ID_BITS).cast("int").alias("a"),
        F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)).cast("int").alias("b"), "n_docs",
    )
    of_left = Window.partitionBy("a")  # no more rows than the right vocabulary has entries
    counts = counts.withColumn("best", F.col("n_docs") == F.max("n_docs").over(of_left))
    return Alignment(blocks, materialize(counts, "pairs"), id_col)
