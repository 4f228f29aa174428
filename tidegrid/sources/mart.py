"""Reading the mart back."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidegrid.config import SIGNAL_COLUMNS, TIME_COLUMN
from tidegrid.files import existing, first_directory
from tidegrid.sinks.mart import MANIFEST, METADATA, QUARANTINE, SHARED_DIRECTORY, SIGNALS, read_current, read_files

# Up to this many directories of a mart without a list of files are looked up one by one.
LISTED_DIRECTORIES = 1000


@dataclass(frozen=True)
class Facts:
    """The fact table: its root, partition column, ids per directory and schema, and the list of its files, if there is one."""

    root: str
    directory: str
    span: int
    schema: StructType
    files: DataFrame | None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema if f.name not in ("shot_id", self.directory)]

    def read(self, spark: SparkSession, paths: list[str]) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).option("basePath", self.root).parquet(*paths)


def read_metadata(spark: SparkSession, mart_dir: str) -> DataFrame:
    return _read_part(spark, mart_dir, METADATA)


def read_errors(spark: SparkSession, mart_dir: str) -> DataFrame:
    """The recordings that were kept out when the mart was built, with the reasons."""
    return _read_part(spark, mart_dir, QUARANTINE)


def _read_part(spark: SparkSession, mart_dir: str, part: str) -> DataFrame:
    current = read_current(spark, mart_dir)
    if current is None:
        return spark.read.parquet(f"{mart_dir}/{part}")
    return spark.read.parquet(*_paths(mart_dir, read_files(spark, mart_dir, current, part)))


def _paths(mart_dir: str, files: DataFrame) -> list[str]:
    return sorted(f"{mart_dir.rstrip('/')}/{r.file}" for r in files.select("file").collect())


def read_signals(
    spark: SparkSession,
    mart_dir: str,
    shot_ids: Sequence[int] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The facts of all recordings, or of those listed; only their files are read.

    All columns of the files are returned, or those named, which must be there. The mart's list of
    files tells which of them hold the ids, so that no directory is listed. Where there is none, a
    short list of directories is looked up, or Spark lists the tree and prunes it.
    """
    facts = _facts(spark, mart_dir)
    out = facts.columns if columns is None else list(columns)
    out.append("shot_id")
    ids = None if shot_ids is None else sorted({int(i) for i in shot_ids})
    if ids is None:
        paths = [facts.root] if facts.files is None else _paths(mart_dir, facts.files)
        return facts.read(spark, paths).select(out)
    wanted = sorted({abs(i) // facts.span * (1 if i >= 0 else -1) for i in ids})  # rounds like div
    if facts.files is not None:
        paths = _paths(mart_dir, _holding(spark, facts.files, ids, wanted))
    elif len(wanted) <= LISTED_DIRECTORIES:
        paths = existing(spark, [f"{facts.root}/{facts.directory}={d}" for d in wanted])
    else:
        paths = [facts.root]
    chosen = F.col("shot_id").isin(ids) & F.col(facts.directory).isin(wanted)
    return facts.read(spark, paths).where(chosen).select(out)


def _holding(spark: SparkSession, files: DataFrame, ids: list[int], directories: list[int]) -> DataFrame:
    """The files whose directory and range of ids hold one of ``ids``."""
    named = spark.createDataFrame([(i,) for i in ids], "_id bigint")
    of = spark.createDataFrame([(d,) for d in directories], "directory bigint")
    inside = F.col("_id").between(F.col("min_id"), F.col("max_id"))
    if len(directories) == len(ids):  # one id a directory
        return files.join(F.broadcast(of), "directory", "left_semi")
    return files.join(F.broadcast(of), "directory", "left_semi").join(F.broadcast(named), inside, "left_semi")


def select_signals(spark: SparkSession, mart_dir: str, condition: str | Column) -> DataFrame:
    """The facts of the recordings whose metadata meet ``condition``.

    Spark prunes the fact partitions at run time if it takes the condition for selective, which it
    does for comparisons only; hence the one that every id meets.
    """
    table = _facts(spark, mart_dir)
    facts = table.read(spark, [table.root] if table.files is None else _paths(mart_dir, table.files))
    chosen = read_metadata(spark, mart_dir).where(condition).where(F.col("shot_id") >= -(2**63)).select("shot_id")
    if table.span > 1:
        chosen = chosen.withColumn(table.directory, F.expr(f"shot_id div {table.span}"))
    keys = [*dict.fromkeys([table.directory, "shot_id"])]
    return facts.join(chosen, keys, "left_semi").select(*table.columns, "shot_id")


def _facts(spark: SparkSession, mart_dir: str) -> Facts:
    root, current = f"{mart_dir.rstrip('/')}/{SIGNALS}", read_current(spark, mart_dir)
    files = read_files(spark, mart_dir, current, SIGNALS) if current else None
    if current and current["layout"]:
        layout = current["layout"]
        return Facts(root, layout["directory"], layout["span"], _with_keys(StructType.fromJson(layout["schema"]), layout["directory"]), files)
    found = first_directory(spark, root)
    directory = (found or "shot_id=").split("=")[0]
    schema = StructType([StructField(c, DoubleType()) for c in (TIME_COLUMN, *SIGNAL_COLUMNS)])
    if found:
        schema = spark.read.parquet(f"{root}/{found}").schema
    span = 1 if directory == "shot_id" else int(directory[len(SHARED_DIRECTORY):])
    return Facts(root, directory, span, _with_keys(schema, directory), files)


def _with_keys(schema: StructType, directory: str) -> StructType:
    for name in dict.fromkeys(["shot_id", directory]):
        schema = StructType([f for f in schema if f.name != name]).add(name, LongType())
    return schema


def read_manifest(spark: SparkSession, mart_dir: str) -> dict:
    current = read_current(spark, mart_dir)
    if current and current["card"]:
        return current["card"]
    return json.loads(spark.read.text(f"{mart_dir}/{MANIFEST}", wholetext=True).first().value)


def mart_size_mb(spark: SparkSession, mart_dir: str) -> float:
    """Size of all Parquet files that count; only lists of files are read, not contents."""
    current = read_current(spark, mart_dir)
    if current:
        files = read_files(spark, mart_dir, current).select("bytes")
    else:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(mart_dir)
            .select(F.col("length").alias("bytes"))
        )
    return (files.agg(F.sum("bytes")).first()[0] or 0) / 1024**2


def register_views(spark: SparkSession, mart_dir: str) -> None:
    """Make the mart available to Spark SQL as ``metadata`` and ``signals``."""
    read_metadata(spark, mart_dir).createOrReplaceTempView("metadata")
    read_signals(spark, mart_dir).createOrReplaceTempView("signals")
