"""Long repeated byte strings: maximal repeats of an enhanced suffix array, and their removal.

A suffix array of all positions of a corpus would move many times the corpus. Here one position
in thirty-five stands for its neighbourhood, and only neighbourhoods that can repeat are sorted:

1. Every string of ``min_bytes`` has one *anchor*: among the runs of ``CORE`` bytes in it, the first
   of the smallest hash, its *core*. Equal strings have equal cores at equal places. All the strings
   of a document that share an anchor overlap to one stretch of bytes, the anchor's *context*.
2. A core that stands nowhere else has no repeats. Equal contexts of the others are gathered in
   classes; only the first position of a class goes on, the others repeat it as a whole.
3. The suffixes of the contexts that have a core in common with another one are sorted. A stack
   scan over the longest common prefixes gives the tree of intervals; those of ``min_bytes`` or
   more whose occurrences differ in the byte to the left are the maximal repeats.

Repeats longer than a context come in overlapping parts, one for each anchor within them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import text as T
from tidegrid.llm.ordering import in_order, row_numbers
from tidegrid.session import materialize, scratch_dir

MIN_BYTES = 100
CORE = 32
#: Cores in more classes than this are resolved by counting strings instead of sorting suffixes.
SORT_LIMIT = 4096
#: Window starts that are looked at together; a longer text is taken in ranges of so many.
RANGE = 1 << 20
PLACE_BITS = np.uint64(24)
#: Contexts sorted together, if their cores allow.
CONTEXTS = 1 << 11
BROKEN = 256  # a left neighbour that is not known, and so differs from any other


def anchors_of(data: np.ndarray, offsets: np.ndarray, min_bytes: int, core: int):
    """(row, place, first window, last window, core hash, context hash) of all anchors, as arrays."""
    n, width = len(data), min_bytes - core + 1
    if n < min_bytes:
        return [np.empty(0, np.int64)] * 4 + [np.empty(0, np.uint64)] * 2
    at = np.arange(n - core + 1)
    cores = T.span_hashes(data, at, at + core)
    least = (cores >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    rest = width - reach
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    inside = np.zeros(n + 1, dtype=np.int64)
    whole = np.diff(offsets) >= min_bytes
    np.add.at(inside, offsets[:-1][whole], 1)
    np.add.at(inside, offsets[1:][whole] - min_bytes + 1, -1)
    window = np.flatnonzero(np.cumsum(inside)[: len(least)])
    place = (least[window] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    row = np.searchsorted(offsets, window, "right") - 1
    new = (np.diff(place, prepend=-1) != 0) | (np.diff(row, prepend=-1) != 0)
    edges = np.flatnonzero(new)
    first, last = window[edges], window[np.append(edges[1:], len(window)) - 1] if len(edges) else edges
    place, row = place[edges], row[edges]
    context = T.span_hashes(data, first, last + min_bytes)
    start = offsets[row]
    return row, place - start, first - start, last - start, cores[place], context


def _pack(place, first, last):
    """Place and the distances of the first window before it and of the last after the first."""
    return place << 16 | (place - first) << 8 | (last - first)


def _unpack(packed):
    place = packed >> 16
    first = place - (packed >> 8 & 255)
    return place, first, first + (packed & 255)


def _anchor_batches(batches: Iterator[pa.RecordBatch], min_bytes: int, core: int, with_context: bool):
    names = ["core", "context", "tid", "packed"] if with_context else ["core"]
    for batch in batches:
        tid = batch.column(0).to_numpy()
        data, offsets = T.text_bytes(batch.column(1))
        for lo, hi in T.slabs(offsets):
            end = int(offsets[hi])
            for s in range(int(offsets[lo]), max(end, int(offsets[lo]) + 1), RANGE):
                one = hi == lo + 1
                e = min(end, s + RANGE + min_bytes - 1) if one else end
                local = np.array([0, e - s]) if one else offsets[lo : hi + 1] - offsets[lo]
                row, place, first, last, cores, contexts = anchors_of(data[s:e], local, min_bytes, core)
                shift = s - int(offsets[lo])
                columns = [pa.array(cores.view(np.int64))]
                if with_context:
                    packed = _pack(place + shift, first + shift, last + shift)
                    columns += [pa.array(contexts.view(np.int64)), pa.array(tid[lo + row]), pa.array(packed)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                if not one:
                    break


def suffix_intervals(contexts: list[bytes], min_bytes: int):
    """Maximal repeats of ``min_bytes`` or more among byte strings, from the intervals of equal prefixes.

    Yields ``(length, members)`` with the suffixes that share that many bytes, in children-first
    order, and returns through the arrays ``owner`` and ``start`` which suffix is which: the first
    value yielded is ``(owner, start)``.
    """
    lengths = np.array([len(c) for c in contexts], dtype=np.int64)
    counts = np.maximum(lengths - min_bytes + 1, 0)
    owner = np.repeat(np.arange(len(contexts)), counts)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    yield owner, start
    if not len(owner):
        return
    longest = int(lengths.max())
    flat = np.frombuffer(b"".join(contexts) + bytes(longest), dtype=np.uint8).copy()
    flat[: lengths.sum()][flat[: lengths.sum()] == 0] = 255  # zero ends a suffix; no UTF-8 text has a byte 255
    base = np.cumsum(lengths) - lengths
    begin, left_over = base[owner] + start, lengths[owner] - start
    table = np.lib.stride_tricks.sliding_window_view(flat, longest)[begin]
    table[np.arange(longest) >= left_over[:, None]] = 0
    order = np.argsort(table.view(f"S{longest}").ravel(), kind="stable")
    table, left_over = table[order], left_over[order]
    differs = table[1:] != table[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), longest)
    common = np.minimum(common, np.minimum(left_over[1:], left_over[:-1]))
    left = np.where(start == 0, BROKEN, flat[begin - 1].astype(np.int64))[order]
    changes = np.zeros(len(left), dtype=np.int64)
    changes[1:] = np.cumsum((left[1:] != left[:-1]) | (left[1:] == BROKEN))
    near = np.flatnonzero(common >= min_bytes)
    if not len(near):
        return
    for part in np.split(near, np.flatnonzero(np.diff(near) > 1) + 1):
        stack: list[tuple[int, int]] = []
        for i in [*part.tolist(), None]:
            depth = 0 if i is None else int(common[i])
            at = begins = int(part[-1]) + 1 if i is None else i
            while stack and stack[-1][0] > depth:
                length, begins = stack.pop()
                if changes[at] > changes[begins]:
                    yield length, order[begins : at + 1]
            if depth and (not stack or stack[-1][0] < depth):
                stack.append((depth, begins))


def _groups_of_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows sorted by core in chunks that never divide a core."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if len(held) >= CONTEXTS and row[0] != held[-1][0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _maximal_repeats(batches, min_bytes: int):
    """(repeat, length, core, tid, start) of the class members of every maximal repeat."""
    for rows in _groups_of_cores(batches):
        found = suffix_intervals([r[1] for r in rows], min_bytes)
        owner, start = next(found)
        tid = np.array([r[2] for r in rows], dtype=np.int64)
        first = np.array([r[3] for r in rows], dtype=np.int64)
        for length, members in found:
            who = owner[members]
            yield length, rows, who, tid[who], first[who] + start[members]


def _removed_spans(batches, min_bytes: int):
    """(tid, start, end) that the first occurrence of some maximal repeat makes superfluous."""
    for rows in _groups_of_cores(batches):
        found = suffix_intervals([r[1] for r in rows], min_bytes)
        owner, start = next(found)
        tid = np.array([r[2] for r in rows], dtype=np.int64)[owner]
        place = np.array([r[3] for r in rows], dtype=np.int64)[owner] + start
        rank = np.empty(len(owner), dtype=np.int64)
        rank[np.lexsort((place, tid))] = np.arange(len(owner))
        covers = np.zeros(len(owner), dtype=np.int64)
        for length, members in found:
            first = members[rank[members].argmin()]
            before = covers[first]
            covers[members] = np.maximum(covers[members], length)
            covers[first] = before
        hit = np.flatnonzero(covers)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tid[hit]), pa.array(place[hit]), pa.array(place[hit] + covers[hit])], names=["tid", "start", "end"]
        )


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted (start, end) pairs with those that overlap or touch made one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > ends[:-1])
    edges = np.flatnonzero(new)
    return np.stack([spans[edges, 0], ends[np.append(edges[1:], len(spans)) - 1]], axis=1)


class Corpus:
    """Distinct texts of a table, in the order of their first document, and their repeated contexts.

    Null texts are empty. Documents come by id, null ids last; documents with one id by a hash
    of their text. Rows with the same id and text are one document.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = MIN_BYTES, core: int = CORE, sort_limit: int = SORT_LIMIT):
        if not 0 < core <= min_bytes <= core + 127:
            raise ValueError("the core must be at most 127 bytes shorter than the repeats")
        self.min_bytes, self.core, self.sort_limit = min_bytes, core, sort_limit
        raw = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
        binary = raw.cast("binary")
        rows = docs.select(
            F.col(id_col).alias("id"), raw.alias("text"), F.octet_length(binary).cast("long").alias("n"),
            F.xxhash64(raw).alias("h1"), F.crc32(binary).alias("h2"),
            F.when(F.octet_length(binary) < min_bytes, F.sha2(binary, 256)).alias("short"),
        ).withColumn("k", F.xxhash64("id", "h1", "h2", "n"))
        self.rows = materialize(rows.drop("text"), "rows")
        texts = self.rows.groupBy("h1", "h2", "n").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"))).alias("first")
        )
        order = [F.col("first.none"), F.col("first.id"), F.col("h1"), F.col("h2"), F.col("n")]
        numbered, _ = row_numbers(in_order(texts, order, "_at"), "_at", "tid")
        numbered = numbered.withColumn("k", F.xxhash64("first.id", "h1", "h2", "n"))
        self.firsts = materialize(numbered.select("tid", "k", "h1", "h2", "n", "first"), "texts")
        source = rows.select("k", "text")
        if self.rows.groupBy("k").count().where("count > 1").limit(1).count():
            source = source.dropDuplicates(["k"])
        self.texts = self._bucketed(source.join(self.firsts.select("k", "tid"), "k"))
        self._candidates()

    def _bucketed(self, texts: DataFrame) -> DataFrame:
        """The texts in buckets of ``k``, so that no later join moves them again."""
        spark = texts.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        name = f"texts_{uuid.uuid4().hex}"
        path = scratch_dir(spark, "bucketed")
        writer = texts.write.bucketBy(buckets, "k").sortBy("k")
        writer.option("path", path).format("parquet").saveAsTable(name)
        return spark.table(name)

    def _anchors(self, with_context: bool) -> DataFrame:
        schema = "core long, context long, tid long, packed long" if with_context else "core long"
        long_enough = self.texts.select("tid", "text").where(F.octet_length("text") >= self.min_bytes)
        min_bytes, core = self.min_bytes, self.core
        return long_enough.mapInArrow(lambda b: _anchor_batches(b, min_bytes, core, with_context), schema)

    def _candidates(self) -> None:
        # Written first: Spark splits a crowded core only where it joins two tables as they are.
        repeated = self._anchors(False).groupBy("core").count().where("count > 1").select("core")
        repeated = materialize(repeated, "cores")
        self.candidates = materialize(self._anchors(True).join(repeated, "core", "left_semi"), "candidates")
        first = F.min(F.struct("tid", "packed")).alias("first")
        classes = self.candidates.groupBy("core", "context").agg(first, F.count("*").alias("members"))
        self.classes = materialize(classes, "classes")

    def mixed(self) -> DataFrame:
        """First positions of the contexts whose core is in another one as well."""
        several = self.classes.groupBy("core").agg(F.count("*").alias("classes")).where("classes > 1")
        several = materialize(several, "several")
        return self.classes.join(several, "core").select("core", "first.tid", "first.packed", "classes")

    def contexts(self) -> DataFrame:
        """``(core, bytes, tid, start, classes)`` of all mixed contexts."""
        by_text = self.mixed().groupBy("tid").agg(F.collect_list(F.struct("core", "packed", "classes")).alias("anchors"))
        keyed = by_text.join(self.firsts.select("tid", "k"), "tid").select("k", "anchors")
        joined = self.texts.join(keyed, "k").select("tid", "text", "anchors")
        min_bytes = self.min_bytes

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = T.text_bytes(batch.column(1))
                raw = data.tobytes()
                tids, lists = batch.column(0).to_pylist(), batch.column(2)
                for i in range(batch.num_rows):
                    anchors = lists[i].values.flatten() if lists[i].values is not None else None
                    core, packed, classes = (a.to_numpy() for a in anchors)
                    _, first, last = _unpack(packed)
                    base = int(offsets[i])
                    pieces = [raw[base + f : base + e] for f, e in zip(first.tolist(), (last + min_bytes).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(core), pa.array(pieces, pa.binary()), pa.array([tids[i]] * len(core), pa.int64()), pa.array(first), pa.array(classes)],
                        names=["core", "bytes", "tid", "start", "classes"],
                    )

        return joined.mapInArrow(cut, "core long, bytes binary, tid long, start long, classes long")

    def _sorted(self, contexts: DataFrame) -> DataFrame:
        few = contexts.where(F.col("classes") <= self.sort_limit).select("core", "bytes", "tid", "start")
        return few.repartition("core").sortWithinPartitions("core")

    def _windows(self, contexts: DataFrame) -> DataFrame:
        """All strings of ``min_bytes`` in the contexts of cores that are in very many classes."""
        many = contexts.where(F.col("classes") > self.sort_limit)
        at = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - self.min_bytes)).alias("i")
        window = F.substring(F.col("bytes"), F.col("i") + 1, F.lit(self.min_bytes))
        return many.select("bytes", "tid", "start", at).select(
            F.unhex(F.md5(window)).alias("string"), "tid", (F.col("start") + F.col("i")).alias("start")
        )

    def _counted_repeats(self, contexts: DataFrame) -> DataFrame:
        """What ``_maximal_repeats`` finds, for the cores that are in very many classes.

        An interval of the suffix array is a prefix of several suffixes that do not all go on with the
        same byte. Here the prefixes are counted, so that no task holds all suffixes of a core.
        """
        size = self.min_bytes

        def byte(at: Column) -> Column:
            return F.conv(F.hex(F.substring(F.col("bytes"), at, F.lit(1))), 16, 10).cast("int")

        many = contexts.where(F.col("classes") > self.sort_limit)
        at = F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - size)).alias("i")
        suffixes = many.select("bytes", "tid", F.col("start").alias("begin"), at).withColumn(
            "string", F.unhex(F.md5(F.substring(F.col("bytes"), F.col("i") + 1, F.lit(size))))
        )
        often = suffixes.groupBy("string").count().where("count > 1").select("string")
        suffixes = materialize(suffixes.join(often, "string", "left_semi").drop("string"), "suffixes")
        n_bytes = F.explode(F.sequence(F.lit(size), F.octet_length("bytes") - F.col("i"))).alias("n_bytes")
        prefixes = suffixes.select("*", n_bytes).select(
            F.unhex(F.md5(F.substring(F.col("bytes"), F.col("i") + 1, F.col("n_bytes")))).alias("string"),
            "n_bytes", "tid", "begin", (F.col("begin") + F.col("i")).alias("start"),
            # The ends of a context have unknown neighbours, which differ from any other.
            F.when(F.col("i") > 0, byte(F.col("i"))).alias("left"),
            F.when(F.col("i") + F.col("n_bytes") < F.octet_length("bytes"), byte(F.col("i") + F.col("n_bytes") + 1)).alias("right"),
        )
        differs = [F.max(F.col(c).isNull()) | (F.min(c) < F.max(c)) for c in ("left", "right")]
        counted = prefixes.groupBy("string", "n_bytes").agg(F.count("*").alias("n"), (differs[0] & differs[1]).alias("maximal"))
        repeats = counted.where("n > 1 AND maximal").select("string", "n_bytes")
        return prefixes.join(repeats, ["string", "n_bytes"]).select(
            F.lower(F.hex("string")).alias("repeat"), F.col("n_bytes").cast("long"), "tid", "start", "begin"
        )

    def superfluous(self) -> DataFrame:
        """Spans ``(tid, start, end)`` of strings that also stand earlier; they may overlap."""
        same = self.candidates.join(self.classes, ["core", "context"]).where("struct(tid, packed) <> first")
        place = F.shiftright("packed", 16)
        begin = place - F.shiftright("packed", 8).bitwiseAND(F.lit(255))
        later = same.select("tid", begin.alias("start"), (begin + F.col("packed").bitwiseAND(F.lit(255)) + self.min_bytes).alias("end"))
        contexts, min_bytes = materialize(self.contexts(), "contexts"), self.min_bytes
        sorted_out = self._sorted(contexts).mapInArrow(lambda b: _removed_spans(b, min_bytes), "tid long, start long, end long")
        spans = later.unionAll(sorted_out)
        if self.classes.groupBy("core").count().where(F.col("count") > self.sort_limit).isEmpty():
            return spans
        windows = materialize(self._windows(contexts), "windows")
        first = windows.groupBy("string").agg(F.min(F.struct("tid", "start")).alias("first"))
        counted = windows.join(first, "string").where("struct(tid, start) <> first")
        return spans.unionAll(counted.select("tid", "start", (F.col("start") + min_bytes).alias("end")))

    def repeat_groups(self) -> DataFrame:
        """Maximal repeats: ``(repeat, n_bytes, tid, start)``, one row for each occurrence.

        ``repeat`` is the same for all occurrences of one string within one context, of which the
        repeat is the longest part that all of them share and that no byte to the left extends.
        Cores in very many classes have the same repeats, found by counting instead of sorting.
        """
        member = self.candidates.join(self.classes, ["core", "context"])
        begin = F.shiftright("packed", 16) - F.shiftright("packed", 8).bitwiseAND(F.lit(255))
        n_bytes = F.col("packed").bitwiseAND(F.lit(255)) + self.min_bytes
        whole = member.where("members > 1").select(
            F.concat_ws("/", "core", "context").alias("repeat"), n_bytes.alias("n_bytes"), "tid", begin.alias("start")
        )
        contexts, min_bytes = materialize(self.contexts(), "contexts"), self.min_bytes

        def scan(batches):
            for length, rows, who, tid, start in _maximal_repeats(batches, min_bytes):
                data = rows[who[0]][1][start[0] - rows[who[0]][3] :][:length]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.md5(data).hexdigest()] * len(tid)), pa.array([length] * len(tid), pa.int64()),
                        pa.array(tid), pa.array(start), pa.array([rows[w][3] for w in who], pa.int64()),
                    ],
                    names=["repeat", "n_bytes", "tid", "start", "begin"],
                )

        parts = self._sorted(contexts).mapInArrow(scan, "repeat string, n_bytes long, tid long, start long, begin long")
        if not self.classes.groupBy("core").count().where(F.col("count") > self.sort_limit).isEmpty():
            parts = parts.unionAll(self._counted_repeats(contexts))
        # The members of a class stand for its first one.
        first = member.select(F.col("first.tid").alias("tid"), F.struct("first.packed").alias("f"), "packed", F.col("tid").alias("own"))
        first_begin = F.shiftright("f.packed", 16) - F.shiftright("f.packed", 8).bitwiseAND(F.lit(255))
        stands = first.select("tid", first_begin.alias("begin"), begin.alias("own_begin"), "own")
        spread = parts.join(stands, ["tid", "begin"]).select(
            "repeat", "n_bytes", F.col("own").alias("tid"), (F.col("own_begin") + F.col("start") - F.col("begin")).alias("start")
        )
        return whole.unionAll(spread)

    def cleaned(self, keep_text: bool = False) -> DataFrame:
        """One row for each row of the table; see :func:`remove_repeats`."""
        spans = self.superfluous().groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        keyed = spans.join(self.firsts.select("tid", "k"), "tid").select("k", "spans")
        joined = self.texts.join(keyed, "k", "left").select("k", "text", "spans")
        names = ["k", "removed", "runs", "digest", *["kept"] * keep_text]

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = T.text_bytes(batch.column(1))
                lists = batch.column(2)
                removed, runs, digest, kept = [], [], [], []
                for i in range(batch.num_rows):
                    whole = data[offsets[i] : offsets[i + 1]].tobytes()
                    found = lists[i].values
                    gone = [] if found is None else merged(np.stack([c.to_numpy() for c in found.flatten()], axis=1)).tolist()
                    parts, at = [], 0
                    for start, end in gone:
                        parts.append(whole[at:start])
                        at = end
                    left = b"".join([*parts, whole[at:]])
                    removed.append(len(whole) - len(left))
                    runs.append(len(gone))
                    digest.append(hashlib.sha256(left).hexdigest())
                    if keep_text:
                        kept.append(left)
                columns = [pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())]
                columns += [pa.array(kept, pa.binary())] * keep_text
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

        schema = "k long, removed long, runs long, digest string" + ", kept binary" * keep_text
        firsts = joined.mapInArrow(cut, schema)
        copy = F.col("digest").isNull()
        goes = F.col("n") >= self.min_bytes
        return self.rows.join(firsts, "k", "left").select(
            "id",
            F.col("n").alias("n_bytes"),
            F.when(copy, F.when(goes, F.col("n")).otherwise(0)).otherwise(F.col("removed")).alias("n_removed"),
            F.when(copy, F.when(goes, 1).otherwise(0)).otherwise(F.col("runs")).cast("long").alias("n_spans"),
            F.when(copy, F.coalesce("short", F.sha2(F.lit(b""), 256))).otherwise(F.col("digest")).alias("kept_sha256"),
            *[F.when(copy & goes, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] * keep_text,
        )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False, **options
) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256)`` for each row: what goes from its text.

    Every byte goes that is covered by a string of ``min_bytes`` bytes that also starts earlier: in
    a document before, or earlier in the same one. Strings overlap, and are judged on the input.
    ``n_spans`` counts the maximal runs removed, ``kept_sha256`` is the digest of the rest (as is
    ``kept``, on request, the rest itself; null for a copy shorter than ``min_bytes``, of which nothing goes).

    Documents come by id, null ids last, those with one id by a hash of the text. Repeated rows of
    one id and text are one document and get the same result. Null texts are empty. Other columns
    are ignored. An empty table gives an empty result.
    """
    return Corpus(docs, id_col, text_col, **options).cleaned(keep_text).withColumnRenamed("id", id_col)
