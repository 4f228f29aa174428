"""Near duplicates by word-shingle fingerprints and pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import text as T
from tidegrid.llm.graph import components
from tidegrid.llm.ordering import wrapped
from tidegrid.session import materialize

BITS = 64
SHINGLE_WORDS = 3
DISTANCE = 3
SEGMENTS = 8
SEED = 42
#: Longer runs of fingerprints with one key are resolved by neighbourhoods instead of comparisons.
RUN_LIMIT = 1 << 15
#: Runs up to this length are compared pair by pair, longer ones by breadth-first search.
PAIRS_LIMIT = 64
CHUNK = 100_000


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprint of each row: a bit is set if over half of the shingle hashes have it."""
    rows = len(offsets) - 1
    data = T.LOWER[data]
    starts, ends, firsts = T.words(data, offsets)
    buffer, starts, ends = T.joined(data, starts, ends)
    counts = np.diff(firsts)
    per_row = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    row = np.repeat(np.arange(rows), per_row)
    first = firsts[row] + np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    last = np.minimum(first + shingle, firsts[row + 1]) - 1 if len(row) else first
    lo, hi = starts[first], ends[last]
    set_bits = np.zeros((rows, BITS), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(row), CHUNK):
        spans = zip(lo[k : k + CHUNK].tolist(), hi[k : k + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(buffer[s:e], SEED) for s, e in spans], dtype=">u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        here = row[k : k + CHUNK]
        edges = np.flatnonzero(np.diff(here, prepend=-1))
        for s, e in zip(edges, [*edges[1:], len(here)], strict=True):
            set_bits[here[s]] += bits[s:e].sum(axis=0, dtype=np.int64)
    over = 2 * set_bits > per_row[:, None]
    return np.packbits(over, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(df: DataFrame, text: str, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``df`` (all columns but the text) with a long column ``_fp``; null and empty texts get 0."""
    kept = [c for c in df.columns if c != text]
    source = df.select(F.col(text).cast("string").alias("_text"), *[F.col(f"`{c}`") for c in kept])
    schema = source.drop("_text").schema.add("_fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.text_bytes(batch.column(0))
            found = [
                fingerprints_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], shingle)
                for lo, hi in T.slabs(offsets)
            ]
            prints = np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(prints)], names=[*batch.schema.names[1:], "_fp"]
            )

    return source.mapInArrow(run, schema)


class Ring:
    """Segments of a fingerprint on a ring, and the budgets of chains of them.

    If two fingerprints differ in at most ``distance`` bits, then from some segment on every chain
    of ``l`` consecutive segments differs in at most ``l * distance / segments`` bits in all
    (strong pigeonring principle). The first segments of such a chain must be equal, and the
    ones that follow, while their budget is one, differ in at most one bit together: hence in at
    most one segment. A key is what remains when that segment is left out.
    """

    def __init__(self, distance: int, segments: int):
        if not 0 < distance < segments <= BITS:
            raise ValueError("distance must be positive and smaller than the number of segments")
        cuts = [BITS * i // segments for i in range(segments + 1)]
        self.distance, self.segments = distance, segments
        self.masks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:], strict=False)]
        self.budgets = [n * distance // segments for n in range(1, segments + 1)]
        equal, reach = self.budgets.count(0), sum(b <= 1 for b in self.budgets)
        self.keys = []  # (first segment of the chain, bits that must be equal)
        for start in range(segments):
            for left_out in range(equal, reach) or [reach]:
                ring = [j for j in range(reach) if j != left_out]
                self.keys.append((start, sum(self.masks[(start + j) % segments] for j in ring)))

    def signed_masks(self) -> list[int]:
        return [m - (1 << BITS) if m >> (BITS - 1) else m for _, m in self.keys]

    def linked(self, key: int, differ: np.ndarray) -> np.ndarray:
        """Whether pairs with these differing bits pass the chain of ``key`` and the full check."""
        start = self.keys[key][0]
        alive = np.arange(len(differ))
        total = np.zeros(len(differ), dtype=np.int64)
        for n, budget in enumerate(self.budgets):
            mask = np.uint64(self.masks[(start + n) % self.segments])
            total = total + np.bitwise_count(differ[alive] & mask)
            passed = total <= budget
            alive, total = alive[passed], total[passed]
        out = np.zeros(len(differ), dtype=bool)
        out[alive] = np.bitwise_count(differ[alive]) <= self.distance
        return out


def _pairs(ring: Ring, key: np.ndarray, value: np.ndarray, prints: np.ndarray):
    """Linked pairs in sorted runs of equal (key, value), each under the first key that finds it."""
    shift, left = 1, np.arange(len(prints))
    while True:
        left = left[left + shift < len(prints)]
        left = left[(key[left] == key[left + shift]) & (value[left] == value[left + shift])]
        if not len(left):
            return
        for k in np.unique(key[left]):
            at = left[key[left] == k]
            differ = prints[at] ^ prints[at + shift]
            found = ring.linked(int(k), differ)
            at, differ = at[found], differ[found]
            for earlier, (_, mask) in enumerate(ring.keys[: int(k)]):
                there = (differ & np.uint64(mask)) == 0
                there[there] = ring.linked(earlier, differ[there])
                at, differ = at[~there], differ[~there]
            yield prints[at], prints[at + shift]
        shift += 1


def _forest(ring: Ring, key: int, prints: np.ndarray):
    """Enough linked pairs of one run to connect what its linked pairs connect."""
    rest, queue = prints, []
    while len(rest) or queue:
        if not queue:
            queue, rest = [rest[0]], rest[1:]
        at = queue.pop()
        found = ring.linked(key, rest ^ at)
        if found.any():
            near = rest[found]
            yield np.full(len(near), at), near
            queue.extend(near)
            rest = rest[~found]


def _links_in_runs(ring: Ring, batches: Iterator[pa.RecordBatch], limit: int):
    """``(a, b)`` for linked fingerprints; ``(fingerprint, null)`` for those of overlong runs."""

    def out(a, b=None):
        a = np.asarray(a, np.uint64).view(np.int64)
        ends = pa.nulls(len(a), pa.int64()) if b is None else pa.array(np.asarray(b, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a), ends], names=["a", "b"])

    def solve(key, value, prints):
        if not len(prints):
            return
        edges = np.flatnonzero((np.diff(key, prepend=-1) != 0) | (np.diff(value, prepend=value[0] ^ 1) != 0))
        lengths = np.diff([*edges, len(prints)])
        long = lengths > PAIRS_LIMIT
        short = ~np.repeat(long, lengths)
        for a, b in _pairs(ring, key[short], value[short], prints[short]):
            yield out(a, b)
        for s, n in zip(edges[long], lengths[long], strict=True):
            for a, b in _forest(ring, int(key[s]), prints[s : s + n]):
                yield out(a, b)

    held = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64))
    hot = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(3)]
        new = (columns[0].astype(np.int64), columns[1], columns[2].view(np.uint64))
        key, value, prints = (np.concatenate(x) for x in zip(held, new, strict=True))
        if hot is not None:
            same = (key == hot[0]) & (value == hot[1])
            yield out(prints[same])
            key, value, prints = key[~same], value[~same], prints[~same]
            if not len(key):
                held = (key, value, prints)
                continue
            hot = None
        last = (key[-1], value[-1])
        open_run = (key == last[0]) & (value == last[1])
        yield from solve(key[~open_run], value[~open_run], prints[~open_run])
        held = (key[open_run], value[open_run], prints[open_run])
        if len(held[0]) > limit:
            hot = last
            yield out(held[2])
            held = tuple(x[:0] for x in held)
    yield from solve(*held)


def links(prints: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS, run_limit: int = RUN_LIMIT) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``_fp`` within ``distance`` bits.

    Every pair within the distance is connected by a path of links, and every link is such a pair.
    """
    ring = Ring(distance, segments)
    masked = F.array(*[F.col("_fp").bitwiseAND(F.lit(m).cast("long")) for m in ring.signed_masks()])
    keyed = (
        prints.select(F.posexplode(masked).alias("_key", "_value"), "_fp")
        .repartition("_key", "_value")
        .sortWithinPartitions("_key", "_value", "_fp")
    )
    found = materialize(
        keyed.mapInArrow(lambda batches: _links_in_runs(ring, batches, run_limit), "a long, b long"), "links"
    )
    pairs = found.where("b is not null").distinct()
    hot = found.where("b is null").select("a").distinct()
    if hot.isEmpty():
        return pairs
    return pairs.union(_neighbourhood_links(hot, distance))


def _neighbourhood_links(prints: DataFrame, distance: int) -> DataFrame:
    """The same for fingerprints ``a`` of any number, without comparing pairs.

    Two fingerprints within the distance meet in a value that differs from the one in
    ``distance // 2`` bits at most and from the other in the remaining ones. All that reach a
    value are linked with the smallest that reaches it within the smaller number of bits.
    """
    near, far = distance // 2, distance - distance // 2
    flips = [1 << i for i in range(BITS)]

    def balls(batches):
        from itertools import combinations

        masks = [(r, sum(c)) for r in range(far + 1) for c in combinations(flips, r)]
        reach = np.array([r for r, _ in masks])
        bits = np.array([m for _, m in masks], dtype=np.uint64)
        for batch in batches:
            for x in batch.column(0).to_numpy().view(np.uint64):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((bits ^ x).view(np.int64)),
                        pa.array(np.full(len(bits), x).view(np.int64)),
                        pa.array(reach <= near),
                    ],
                    names=["z", "a", "close"],
                )

    reached = prints.mapInArrow(balls, "z long, a long, close boolean")
    centre = reached.where("close").groupBy("z").agg(F.min("a").alias("b"))
    return reached.join(centre, "z").where("a <> b").select("a", "b").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    segments: int = SEGMENTS,
    run_limit: int = RUN_LIMIT,
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (hexadecimal), ``component_id``, ``text_hash``, ``stays``.

    Letters A to Z are lowered; words are runs of anything but space, tab and line ends. A text
    of fewer than ``shingle`` words is one shingle, a null or empty one has fingerprint zero
    and is linked like any other. ``component_id`` is the smallest id reachable over links of at
    most ``distance`` differing bits (null ids count last; null if there is no other).
    ``stays`` marks the documents with the id and the text of the group's first one; repeated rows
    of it are all marked. Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    hashed = rows.withColumn("_hash", F.xxhash64("_text"))
    prints = materialize(fingerprints(hashed, "_text", shingle), "fingerprints")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash")))
    nodes = prints.groupBy("_fp").agg(first.alias("first"))
    roots = components(links(nodes.select("_fp"), distance, segments, run_limit))
    member = nodes.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_fp", "first", F.coalesce("root", "_fp").alias("root")
    )
    member = materialize(member, "members")
    group = member.groupBy("root").agg(F.min("first").alias("group"))
    classes = member.join(group, "root").select(F.col("_fp"), "group")
    joined = prints.join(classes, "_fp")
    stays = F.col("_id").eqNullSafe(F.col("group.id")) & (F.col("_hash") == F.col("group.hash"))
    return joined.select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("group.id").alias("component_id"),
        F.col("_hash").alias("text_hash"),
        stays.alias("stays"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The first document of each group, with all its columns; repeated rows of it count once."""
    first = (
        near_duplicates(docs, id_col, text_col, **options)
        .where("stays")
        .select(F.col(id_col).alias("_first_id"), F.col("text_hash").alias("_first_hash"))
        .distinct()
    )
    rows = docs.select(
        wrapped(docs), F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col).cast("string")).alias("_hash")
    )
    same = F.col("_id").eqNullSafe(F.col("_first_id")) & (F.col("_hash") == F.col("_first_hash"))
    return rows.join(first, same, "left_semi").dropDuplicates(["_id", "_hash"]).select("_doc.*")
