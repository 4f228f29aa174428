"""Token ids of all documents in binary files with compressed document boundaries.

A folder holds, for each part of the documents in ascending order of their ids, two files:

* ``*.ids``: the token ids of the part's documents one after another, each as a little-endian
  unsigned number of 2 bytes (4, if the vocabulary needs them), nothing between them;
* ``*.idx``: a header (magic ``TGEF``, version, bytes an id, documents, documents without an id,
  least document id) and two Elias-Fano sequences: where each document begins (and where the last one
  ends), and the document ids less the least one.

``manifest`` is a table with one row for each part. It names the files that count: a task that
is run again writes files of new names, so that readers never see those of a lost attempt.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.elias_fano import EliasFano
from tidegrid.llm.text import joined, slabs, text_bytes, words
from tidegrid.llm.units import UnitEncoder, one_by_one, together, units_at

IDX_HEADER = struct.Struct("<4sBBxxqqq")
MAGIC, VERSION = b"TGEF", 1
MANIFEST = "part long, file string, docs long, tokens long, width int"
#: Documents for a part on average, and for a row of the reading job.
PART_DOCS = 250_000
READ_DOCS = 4_096
#: Bytes of text that are encoded at a time.
WRITE_BYTES = 4 << 20
_LONG_MIN = -(1 << 63)


def storage(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that tasks reach by Arrow (local, HDFS, S3, GCS)."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


#: Words of these letters alone stay one word of the tokenizer, whatever stands around them.
_LETTERS = re.compile("[a-zA-ZÀ-ÖØ-öø-įı-ɏ]+ ")
#: A word may be cut before these, behind a plain letter; no special string holds one.
_STOPS = np.isin(np.arange(256), list(b".,;:!?"))
_PLAIN = np.isin(np.arange(256) | 0x20, list(range(0x61, 0x7B)))


@lru_cache(maxsize=4)
def word_encoder(path: str) -> UnitEncoder:
    """Encodes words by the tokenizer in a file whose tokens never reach over ASCII white space.

    Words of letters are encoded many at a time, with spaces between them, if the vocabulary marks the end
    of a word: then the marked ids tell the words apart.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return UnitEncoder(one_by_one(encode))
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    ends = np.array([(tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)])

    def cut(ids: np.ndarray, units: list[str]) -> np.ndarray | None:
        found = np.flatnonzero(ends[ids]) + 1
        return found if len(found) == len(units) and found[-1] == len(ids) else None

    def mixed(texts: list[str]):
        plain = [t for t in texts if _LETTERS.fullmatch(t)]
        yield from together(encode, cut)(plain)
        yield from one_by_one(encode)([t for t in texts if not _LETTERS.fullmatch(t)])

    return UnitEncoder(mixed)


def described(path: str) -> tuple[int, bool]:
    """Size of a tokenizer's vocabulary, and whether it takes all text in lower case."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    lower = tokenizer.normalizer is not None and tokenizer.normalizer.normalize_str("ABC XYZ") == "abc xyz"
    return tokenizer.get_vocab_size(with_added_tokens=True), lower


def lower_plain(data: np.ndarray) -> np.ndarray:
    """``data`` with A-Z in lower case, but for letters that a combining character may follow."""
    alone = np.append(data[1:] < 0x80, True)
    return np.where(alone & (data >= 0x41) & (data <= 0x5A), data + np.uint8(0x20), data)


def encode_texts(data: np.ndarray, offsets: np.ndarray, encoder: UnitEncoder, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows one after another, and the number of each row's ids.

    A unit is a word, or the part of one before or behind a full stop or the like, and a space. With ``lower``
    the tokenizer takes capitals for small letters, and so may we where no special string can begin.
    """
    starts, ends, firsts = words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
    text, begins, _ = joined(data, starts, ends)
    plain = np.frombuffer(text, dtype=np.uint8)
    stops = np.flatnonzero(_STOPS[plain[1:]] & _PLAIN[plain[:-1]]) + 1
    cuts = np.sort(np.concatenate([begins, stops]), kind="stable")
    if lower and b"<" not in text:
        plain = lower_plain(plain)
    spaced, at = np.insert(plain, stops, 0x20), cuts + np.searchsorted(stops, cuts, "right")
    coded = units_at(spaced, at).dictionary_encode()
    (lists,) = encoder.ids(coded.dictionary.to_pylist())
    sizes = np.diff(lists.offsets.to_numpy())[coded.indices.to_numpy()]
    total = np.concatenate([[0], np.cumsum(sizes)])
    words_at = np.append(begins, len(plain))[firsts]
    return lists.take(coded.indices).flatten().to_numpy(), np.diff(total[np.searchsorted(cuts, words_at)])


class PartWriter:
    """Writes the files of one part as its documents come, in order; holds one number a document."""

    def __init__(self, folder: str, part: int, width: int):
        self.fs, self.path = storage(folder)
        self.file, self.part, self.width = f"part-{part:06d}-{uuid.uuid4().hex}", part, width
        self.ids = self.fs.open_output_stream(f"{self.path}/{self.file}.ids")
        self.lengths: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.null_docs = 0

    def write(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.ids.write(ids.astype(f"<u{self.width}").tobytes())
        self.lengths.append(counts.astype(np.int64))
        self.null_docs += doc_ids.null_count
        self.docs.append(doc_ids.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))

    def close(self) -> dict:
        self.ids.close()
        lengths, docs = np.concatenate(self.lengths), np.concatenate(self.docs)
        least = int(docs[0]) if len(docs) else 0
        begins = EliasFano.encode(np.concatenate([[0], np.cumsum(lengths)]))
        above = EliasFano.encode(docs.view(np.uint64) - np.array([least], np.int64).view(np.uint64))
        head = IDX_HEADER.pack(MAGIC, VERSION, self.width, len(lengths), self.null_docs, least)
        with self.fs.open_output_stream(f"{self.path}/{self.file}.idx") as out:
            out.write(head + begins.to_bytes() + above.to_bytes())
        return {
            "part": self.part, "file": self.file, "docs": len(lengths),
            "tokens": int(lengths.sum()), "width": self.width,
        }


class PartReader:
    """Any documents of one part, read by their place in it."""

    def __init__(self, folder: str, file: str):
        self.fs, path = storage(folder)
        self.path = f"{path}/{file}.ids"
        with self.fs.open_input_stream(f"{path}/{file}.idx") as source:
            data = source.read()
        magic, version, self.width, self.n, self.null_docs, self.least = IDX_HEADER.unpack_from(data)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError(f"not an index of token files: {file}")
        self.begins, at = EliasFano.from_bytes(data, IDX_HEADER.size)
        self.above, _ = EliasFano.from_bytes(data, at)

    def bounds(self, lo: int, hi: int) -> np.ndarray:
        """Where documents ``lo`` to ``hi - 1`` begin, and where the last of them ends."""
        return self.begins.select_range(lo, hi + 1).astype(np.int64)

    def doc_ids(self, lo: int, hi: int) -> pa.Array:
        """Ids of documents ``lo`` to ``hi - 1``; those without one come first."""
        nulls = min(max(self.null_docs - lo, 0), hi - lo)
        known = self.above.select_range(max(lo - self.null_docs, 0), max(hi - self.null_docs, 0))
        known = (known + np.array([self.least], np.int64).view(np.uint64)).view(np.int64)
        return pa.concat_arrays([pa.nulls(nulls, pa.int64()), pa.array(known, pa.int64())])

    def tokens(self, begin: int, end: int) -> np.ndarray:
        """Token ids from place ``begin`` to ``end - 1`` of the part, by one ranged read."""
        with self.fs.open_input_file(self.path) as source:
            raw = source.read_at((end - begin) * self.width, begin * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}")


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the ids of every whole text, ``end_id`` behind each, into ``folder``; returns its manifest.

    Documents stand in ascending order of ``id_col`` (whole numbers; rows without one first),
    those of equal ids in the order of a hash of their texts; repeated rows are written as often
    as they come. Null and empty texts have the end id alone. A task passes its rows on slab by slab, so a very
    long text is held once, with its ids. An empty table gives an empty manifest. Other columns
    are ignored. ``docs`` must be a table or a written result: rows equal in id and text are dealt by the task that read
    them. ``tokenizer`` is a file of the ``tokenizers`` library whose tokens never span white space.
    """
    spark = docs.sparkSession
    size, lower = described(tokenizer)
    width = 2 if max(end_id, size - 1) < 1 << 16 else 4
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // PART_DOCS))
    keys = ["id", "hash", "task"]
    keyed = rows.withColumn("hash", F.xxhash64("text")).withColumn("task", F.spark_partition_id())
    dealt = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("id", "text")
    target, path = storage(folder)
    target.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer = word_encoder(tokenizer), None
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for lo, hi in slabs(offsets, WRITE_BYTES):
                if writer is None:
                    writer = PartWriter(folder, TaskContext.get().partitionId(), width)
                at = offsets[lo : hi + 1]
                ids, counts = encode_texts(data[at[0] : at[-1]], at - at[0], encoder, lower)
                ends = np.cumsum(counts)
                writer.write(batch.column(0).slice(lo, hi - lo), np.insert(ids, ends, end_id), counts + 1)
        if writer is not None:
            yield pa.RecordBatch.from_pylist([writer.close()], schema=PART_SCHEMA)

    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


PART_SCHEMA = pa.schema(
    [("part", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("width", pa.int32())]
)


def read_tokens(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids)`` of every document in the files of ``folder``.

    ``start`` counts the ids of all documents before it, ``ids`` holds the document's own as
    little-endian unsigned 32-bit numbers. Each task reads the index of a part and the ranges of its documents that the select
    structure names. The driver sees the manifest only, one row a part.
    """
    parts = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").orderBy("part").collect()
    known, before = [], 0
    for p in parts:
        known.append((p["file"], p["docs"], before))
        before += p["tokens"]
    listed = spark.createDataFrame(known, "file string, docs long, base long")
    first, step = F.lit(0).cast("long"), F.lit(READ_DOCS).cast("long")
    blocks = listed.withColumn("lo", F.explode(F.sequence(first, F.col("docs") - 1, step)))
    tasks = max(1, sum(-(-p["docs"] // READ_DOCS) for p in parts))
    limit = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(min(tasks, max(limit, tasks // 64)), "file", "lo")
    schema = "id long, start long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = lru_cache(maxsize=2)(lambda file: PartReader(folder, file))
        for batch in batches:
            for block in batch.to_pylist():
                part, end = reader(block["file"]), min(block["lo"] + READ_DOCS, block["docs"])
                yield from read_block(part, block["lo"], end, block["base"])

    return spread.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def read_block(part: PartReader, lo: int, hi: int, base: int, read_ids: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Documents ``lo`` to ``hi - 1``, about ``read_ids`` token ids at a time (a longer one alone)."""
    bounds, ids = part.bounds(lo, hi), part.doc_ids(lo, hi)
    for first, last in slabs(bounds, read_ids):
        at = bounds[first : last + 1]
        raw = part.tokens(int(at[0]), int(at[-1])).astype("<u4")
        cells = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), last - first, [None, pa.py_buffer((at - at[0]) * 4), pa.py_buffer(raw)]
        )
        columns = [
            ids.slice(first, last - first), pa.array(at[:-1] + base), pa.array(np.diff(at)), cells.cast(pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n_tokens", "ids"])
