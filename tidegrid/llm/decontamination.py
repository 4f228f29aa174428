"""Benchmark items found in documents by fingerprints of item-sized windows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidegrid.llm import text as T
from tidegrid.llm.ordering import wrapped

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Each distinct shingle of a text has one vote in its fingerprint. A window at the least similarity to an item
#: that repeats none has at most a ninth of its shingles more and a ninth less, so that the two sets are at an angle of
#: 27 degrees and each of 64 bits differs with probability 0.15: 9.7 bits on average, with a deviation of 2.9.
RADIUS = 19
#: Items with a larger share of repeated shingles weigh so little by their distinct ones that fingerprints say nothing
#: (blanks, rules of tables); they are the exception that is found by counting, ``Items._counted``. Up to that share
#: the angle is at most 29 degrees.
REPEATED = 0.1
BLOCKS = 4
BITS = 64
#: Items are taken in blocks of so many and so many bytes of text, each for one pass over the documents.
BLOCK_ITEMS = 1000
BLOCK_BYTES = 4 << 20
FILTER_BITS = 20
STEP = np.uint64(0xD6E8FEB86659FD93)
MATCH = "item_id long, start_word long, n_words long, distance int, similarity double"


def shingles(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words."""
    n = len(word_hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    total = word_hashes[:n].copy()
    for i in range(1, size):
        total = total * STEP + word_hashes[i : i + n]
    return T.mix(total)


def bit_votes(hashes: np.ndarray) -> np.ndarray:
    """Bits of each hash as a row of 64 votes, +1 or -1."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def fingerprint(hashes: np.ndarray) -> np.uint64:
    """Fingerprint of a set of shingles; ties between votes give 0."""
    distinct, votes = np.unique(hashes), np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(distinct), 1 << 14):
        votes += bit_votes(distinct[at : at + (1 << 14)]).sum(axis=0)
    return simhash(votes)


def earlier(hashes: np.ndarray) -> np.ndarray:
    """For each place the last one before it with the same hash, or -1."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    out = np.full(len(hashes), -1, dtype=np.int64)
    out[order[1:][same]] = order[:-1][same]
    return out


def simhash(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=-1).view(">u8")[..., 0].astype(np.uint64)


class Items:
    """Some benchmark items, their fingerprints and a multi-index over blocks of these.

    Fingerprints within ``radius`` bits differ in at most ``radius // blocks`` bits in one of the blocks.
    Each block has a table of the items by all values that are that near to theirs.
    """

    def __init__(self, rows: list[tuple[int, str]], shingle: int, radius: int, blocks: int, similarity: float):
        self.shingle, self.radius, self.similarity = shingle, radius, similarity
        self.ids, self.sizes, self.counts, prints, repeated = [], [], [], [], []
        by_size: dict[int, list[np.ndarray]] = {}
        for item, text in rows:
            data = np.frombuffer((text or "").encode(), dtype=np.uint8)
            data, offsets = T.LOWER[data], np.array([0, len(data)])
            starts, ends, _ = T.words(data, offsets)
            if not len(starts):
                continue
            size = min(shingle, len(starts))
            own = shingles(T.span_hashes(data, starts, ends), size)
            by_size.setdefault(size, []).append(np.unique(own))
            self.ids.append(item)
            self.sizes.append(len(starts))
            self.counts.append(np.unique(own, return_counts=True))
            prints.append(fingerprint(own))
            repeated.append(len(own) - len(self.counts[-1][0]) > REPEATED * len(own))
        self.repeated = np.array(repeated, dtype=bool)
        self.sizes = np.array(self.sizes, dtype=np.int64)
        self.prints = np.array(prints, dtype=np.uint64)
        self.known, self.filters, self.holders = {}, {}, {}
        for size, lists in by_size.items():
            self.known[size] = np.unique(np.concatenate(lists))
            self.filters[size] = np.zeros(1 << FILTER_BITS, dtype=bool)
            self.filters[size][self.known[size] >> np.uint64(64 - FILTER_BITS)] = True
            holds = [[] for _ in self.known[size]]
            for i, n in enumerate(self.sizes):
                if min(shingle, n) == size:
                    for at in np.searchsorted(self.known[size], self.counts[i][0]):
                        holds[at].append(int(n))
            self.holders[size] = [sorted(set(h)) for h in holds]
        self.postings = {size: self._postings(size) for size in by_size}
        self.blocks, self._tables = blocks, None

    def _postings(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each known shingle's items of many repeats begin, the items, and how often each has the shingle."""
        items = np.flatnonzero((np.minimum(self.sizes, self.shingle) == size) & self.repeated)
        none = [np.zeros(0, dtype=np.int64)]
        at = np.searchsorted(self.known[size], np.concatenate([self.counts[i][0] for i in items] or none))
        order = np.argsort(at, kind="stable")
        owner = np.repeat(items, [len(self.counts[i][0]) for i in items])
        weight = np.concatenate([self.counts[i][1] for i in items] or none)
        return np.searchsorted(at[order], np.arange(len(self.known[size]) + 1)), owner[order], weight[order]

    def __getstate__(self):
        return self.__dict__ | {"_tables": None}

    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block, the items by value, and where each value's items begin."""
        if self._tables is None:
            self._tables = self._build()
        return self._tables

    def _build(self) -> list[tuple[np.ndarray, np.ndarray]]:
        width, radius = BITS // self.blocks, self.radius // self.blocks
        near = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]
        near = np.array(near, dtype=np.uint64)
        tables = []
        for shift, low in self.cuts():
            values = (((self.prints >> shift) & low)[:, None] ^ near).astype(np.int64).ravel()
            order = np.argsort(values, kind="stable")
            items = np.repeat(np.arange(len(self.prints), dtype=np.int32), len(near))[order]
            edges = np.searchsorted(values[order], np.arange((1 << width) + 1))
            tables.append((items, edges))
        return tables

    def cuts(self) -> list[tuple[np.uint64, np.uint64]]:
        width = BITS // self.blocks
        return [(np.uint64(width * b), np.uint64((1 << width) - 1)) for b in range(self.blocks)]

    def within_radius(self, prints: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (window, item, distance) within the radius whose item fills a window of that size."""
        found = []
        for (shift, low), (items, edges) in zip(self.cuts(), self.tables(), strict=True):
            value = ((prints >> shift) & low).astype(np.int64)
            n = edges[value + 1] - edges[value]
            window = np.repeat(np.arange(len(prints)), n)
            item = items[np.repeat(edges[value] - (np.cumsum(n) - n), n) + np.arange(len(window))]
            fits = self.sizes[item] == sizes[window]
            window, item = window[fits], item[fits]
            distance = np.bitwise_count(prints[window] ^ self.prints[item])
            near = distance <= self.radius
            found.append(np.stack([window[near], item[near], distance[near]]))
        found = np.concatenate(found, axis=1)
        return tuple(np.unique(found, axis=1) if found.size else found)

    def similarity_to(self, item: int, window: np.ndarray) -> float:
        """Weighted similarity of the shingles: sum of the smaller counts over sum of the larger."""
        own, weight = self.counts[item]
        there, times = np.unique(window, return_counts=True)
        _, i, j = np.intersect1d(own, there, assume_unique=True, return_indices=True)
        both = int(np.minimum(weight[i], times[j]).sum())
        return both / (int(weight.sum()) + len(window) - both)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple]:
        """Best match of every row and item: (row, item id, first word, words, distance, similarity)."""
        data = T.LOWER[data]
        starts, ends, firsts = T.words(data, offsets)
        hashes = T.span_hashes(data, starts, ends)
        found = []
        for size, known in self.known.items():
            own = shingles(hashes, size)
            maybe = np.flatnonzero(self.filters[size][own >> np.uint64(64 - FILTER_BITS)])
            at = np.minimum(np.searchsorted(known, own[maybe]), len(known) - 1)
            is_hit = known[at] == own[maybe]
            hit, at = maybe[is_hit], at[is_hit]
            row = np.searchsorted(firsts, hit, "right") - 1
            inside = hit + size <= firsts[row + 1]
            hit, at, row = hit[inside], at[inside], row[inside]
            edges = [*np.flatnonzero(np.diff(row, prepend=-1)), len(row)]
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                r = int(row[s])
                lo, hi = int(firsts[r]), int(firsts[r + 1])
                found += [(r, *m) for m in self._in_row(own[lo : hi - size + 1], hit[s:e] - lo, at[s:e], size)]
        return found

    def _in_row(self, own: np.ndarray, hits: np.ndarray, at: np.ndarray, size: int) -> list[tuple]:
        """``own``: shingles of the row; ``hits``: places of those that some item has."""
        words = len(own) + size - 1
        by_size: dict[int, list[int]] = {}
        for h, a in zip(hits.tolist(), at.tolist(), strict=True):
            for n in self.holders[size][a]:
                by_size.setdefault(n, []).append(h)
        best: dict[int, tuple] = {}
        before = earlier(own)
        for n, places in by_size.items():
            span = min(n, words) - size + 1  # shingles in a window
            places = np.array(places)
            # Windows without a shared shingle have similarity 0; only the others are looked at.
            delta = np.zeros(len(own) + 1, dtype=np.int64)
            np.add.at(delta, np.maximum(places - span + 1, 0), 1)
            np.add.at(delta, places + 1, -1)
            window = np.flatnonzero(np.cumsum(delta)[: len(own) - span + 1] > 0)
            for part in np.split(window, np.flatnonzero(np.diff(window) > span) + 1):
                for k in range(0, len(part), 1 << 14):
                    self._in_windows(own, before, part[k : k + (1 << 14)], span, n, best)
        if self.repeated.any():
            self._counted(own, hits, at, size, best)
        return [
            (self.ids[i], start, int(min(self.sizes[i], words)), distance, -worse)
            for i, (worse, start, distance) in best.items()
        ]

    def _counted(self, own: np.ndarray, hits: np.ndarray, at: np.ndarray, size: int, best: dict) -> None:
        """The best window of every item of many repeats that is similar enough, whatever its fingerprint is.

        A place counts in the windows that hold it and fewer later places of its shingle than the item
        has, so the shared shingles of all windows are the running sum of one step up and one down.
        """
        words = len(own) + size - 1
        edges, items, weights = self.postings[size]
        places = hits[np.argsort(at, kind="stable")]
        present, begins, times = np.unique(np.sort(at), return_index=True, return_counts=True)
        n = edges[present + 1] - edges[present]
        which = np.repeat(np.arange(len(present)), n)
        posting = np.repeat(edges[present] - (np.cumsum(n) - n), n) + np.arange(len(which))
        order = np.argsort(items[posting], kind="stable")
        which, who, weight = which[order], items[posting][order], weights[posting][order]
        # No window shares more than the whole row does.
        most = np.bincount(who, np.minimum(weight, times[which]), len(self.ids))
        for i in np.flatnonzero(most).tolist():
            full, span = int(self.sizes[i]) - size + 1, min(int(self.sizes[i]), words) - size + 1
            if most[i] / (full + span - most[i]) < self.similarity:
                continue
            lo, hi = np.searchsorted(who, [i, i + 1])
            mine, limit = which[lo:hi], np.repeat(weight[lo:hi], times[which[lo:hi]])
            count = times[mine]
            rank = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            flat = np.repeat(begins[mine], count) + rank
            later = places[np.minimum(flat + limit, len(places) - 1)]
            later = np.where(rank + limit < np.repeat(count, count), later, len(own))
            first, last = np.maximum(places[flat] - span + 1, 0), np.minimum(places[flat], later - span)
            inside = first <= last
            steps = np.concatenate([first[inside], last[inside] + 1])
            signs = np.repeat([1, -1], int(inside.sum()))
            starts, step = np.unique(steps, return_inverse=True)
            shared = np.cumsum(np.bincount(step, signs)).astype(np.int64)
            start, both = int(starts[shared.argmax()]), int(shared.max())
            similarity = both / (full + span - both)
            if similarity >= self.similarity:
                window = fingerprint(own[start : start + span])
                entry = (-similarity, start, int(np.bitwise_count(window ^ self.prints[i])))
                best[i] = min(best.get(i, entry), entry)

    def _in_windows(self, own: np.ndarray, before: np.ndarray, window: np.ndarray, span: int, n: int, best: dict) -> None:
        """Items near to the windows that begin at ``window``, by their fingerprints, then by exact similarity.

        A shingle votes in the windows in which it is the first of its kind: those that begin behind the
        one before it. So the votes of all windows are the running sum of one step up and one down for each shingle.
        """
        first, last = int(window[0]), int(window[-1]) + span
        place = np.arange(first, last)
        begin = np.maximum(np.maximum(before[first:last] + 1, place - span + 1), first) - first
        begin = np.minimum(begin, place + 1 - first)  # up and down at once: it has no vote
        steps = np.zeros((last - first + 1, BITS), dtype=np.int32)
        votes = bit_votes(own[first:last])
        np.add.at(steps, begin, votes)
        steps[1:] -= votes
        np.cumsum(steps, axis=0, out=steps)
        prints = simhash(steps[window - first])
        for w, item, distance in zip(*self.within_radius(prints, np.full(len(prints), n)), strict=True):
            start = int(window[w])
            similarity = self.similarity_to(int(item), own[start : start + span])
            if similarity >= self.similarity:
                entry = (-similarity, start, int(distance))
                best[int(item)] = min(best.get(int(item), entry), entry)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    for item, text in benchmark.select(id_col, text_col).toLocalIterator():
        block.append((item, text))
        size += len(text or "")
        if len(block) == BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _find(docs: DataFrame, text_col: str, items: Items, keep: list[str]) -> DataFrame:
    source = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)
    schema = source.drop("_text").schema.add("_matches", ArrayType(StructType.fromDDL(MATCH)))
    kind = pa.list_(
        pa.struct([("item_id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("distance", pa.int32()), ("similarity", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.text_bytes(batch.column(0))
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for lo, hi in T.slabs(offsets):
                for row, *match in items.matches(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                    found[lo + row].append(dict(zip(("item_id", "start_word", "n_words", "distance", "similarity"), match, strict=True)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found, kind)], names=[*batch.schema.names[1:], "_matches"]
            )

    return source.mapInArrow(run, schema)


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """One row for each document and benchmark item found in it, with the most similar window.

    A window has as many words as the item (the whole text, if that has fewer). Its weighted
    similarity (repeated shingles count) must be at least ``similarity``; ties go to the earliest window.
    Windows are found by their fingerprint, which is within ``radius`` bits of the item's but for about 3 in
    10,000 of those right at the least similarity (own trial), and fewer above; only items of more than a tenth of
    repeated shingles are found by counting shared ones, so that their ``distance`` may be above ``radius``. Item ids are whole numbers. Letters A to Z are lowered; an item shorter than a shingle is one shingle. Null and empty texts and items match nothing.
    Repeated rows of either table give repeated matches. Other columns are ignored.
    The items are read to the driver in bounded blocks, each with a pass over the documents.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    passes = [
        _find(rows, "_text", Items(block, shingle, radius, blocks, similarity), ["_id"])
        .select(F.col("_id").alias(id_col), F.explode("_matches").alias("_match"))
        .select(id_col, "_match.*")
        for block in _blocks(benchmark, item_col, item_text_col)
    ]
    if not passes:
        return docs.limit(0).select(id_col, *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in MATCH.split(", ")])
    return reduce(DataFrame.unionAll, passes)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
) -> DataFrame:
    """``docs`` without the rows in which :func:`find_items` finds an item; all columns stay."""
    for block in _blocks(benchmark, item_col, item_text_col):
        rows = docs.select(F.col(text_col).alias("_text"), wrapped(docs))
        found = _find(rows, "_text", Items(block, shingle, radius, blocks, similarity), ["_doc"])
        docs = found.where(F.size("_matches") == 0).select("_doc.*")
    return docs
