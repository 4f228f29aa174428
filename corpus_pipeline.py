"""A corpus from raw documents to shards: each stage reads what the one before has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import decontamination, mixing, near_dedup, quality, sharding
from tidegrid.llm.ordering import wrapped
from tidegrid.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit(docs, labels))


def first_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return near_dedup.deduplicate(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def with_place(docs: DataFrame) -> DataFrame:
    """``docs`` as one column, and the file and row that each document is read from.

    Rows of a table that is not read from Parquet are written first.
    """
    try:
        place = docs.metadataColumn("_metadata")
        return docs.select(wrapped(docs), place["file_path"].alias("_file"), place["row_index"].alias("_row"))
    except AnalysisException:
        return with_place(materialize(docs, "docs"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it. Only sizes and places are sorted, not the texts."""
    placed, text = with_place(docs), F.col("_doc.text")
    sized = placed.select(
        "_file", "_row", "_doc.doc_id", "_doc.source", mixing.word_count(text).alias("size"), F.xxhash64(text).alias("hash")
    )
    copies = mixing.mix_sources(sized, ["doc_id", "hash"], inclusion=mixing.by_length(F.col("size")))
    taken = copies.where("copies > 0").select("_file", "_row", "copies")
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return placed.join(taken, ["_file", "_row"]).select("_doc", times).select("_doc.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with a shard and a slot."""
    return sharding.shard_rows(docs, [F.col("doc_id"), F.xxhash64("text")])


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("near_dedup", first_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The classifier, fingerprints and permutation are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of each is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
