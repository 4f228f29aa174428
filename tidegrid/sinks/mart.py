"""Writing the mart: dimension table, partitioned fact table and manifest."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from tidegrid.config import FILE_ROWS, PIPELINE_VERSION, SIGNAL_COLUMNS, TIME_COLUMN, MartConfig
from tidegrid.files import delete, delete_all, existing, exists, first_directory, read_text, replace_text
from tidegrid.functions.numeric import round_exactly
from tidegrid.operators.enrich import utc_now
from tidegrid.operators.series import split_series
from tidegrid.session import materialize, scratch_scope

METADATA, SIGNALS, MANIFEST = "metadata.parquet", "signals", "dataset_manifest.json"
QUARANTINE = "quarantine.parquet"
# Directories of several recordings are named after the number of ids each one spans.
SHARED_DIRECTORY = "shots_by_"
# What the mart holds at the moment, and where its lists of files are.
CURRENT, FILE_LISTS = "_current.json", "file_lists"
LISTED = "part string, file string, directory bigint, min_id bigint, max_id bigint, n_rows bigint, bytes bigint"


class MartChange:
    """New files of a mart that readers see all at once, or never.

    New files go beside those of the parts they replace, under names of their own. A list of the files that
    count, with their ids and sizes, is written next; then one small file is replaced, which
    names that list. Before that, readers see the old mart whole; after it, the new one. Files
    that no longer count are deleted last. One change at a time may be made to a mart.
    """

    def __init__(self, spark: SparkSession, config: MartConfig):
        self.spark, self.config, self.root = spark, config, config.output_dir.rstrip("/")
        self.prefix = f"part-{uuid.uuid4().hex}"
        before = read_current(spark, self.root)
        self.now: dict = before or {"files": None, "layout": None, "card": None}
        self.old = read_files(spark, self.root, before) if before else self._untracked()
        self.new: dict[str, DataFrame] = {}
        self.kept = self.old

    @property
    def span(self) -> int:
        """Recordings per directory of the fact table."""
        return self.now["layout"]["span"] if self.now["layout"] else self.config.shots_per_directory

    def _untracked(self) -> DataFrame:
        """The files of a mart that was written without a list."""
        files = self.spark.createDataFrame([], LISTED)
        for part in (METADATA, SIGNALS, QUARANTINE):
            path = f"{self.root}/{part}"
            by = (first_directory(self.spark, path) or "").split("=")[0]
            files = files.unionByName(self._listed(part, by, "*.parquet"))
        return files

    def write(self, part: str, table: DataFrame, by: str | None = None, keep: bool = False) -> None:
        """Write ``table`` as a part; ``by`` names the column of its directories. With ``keep`` only directories with new
        files are replaced, else the whole part."""
        writer = table.write.mode("append").option("compression", self.config.compression)
        writer = writer.option("mapreduce.output.basename", self.prefix)
        (writer.partitionBy(by) if by else writer).parquet(f"{self.root}/{part}")
        self.new[part] = self._listed(part, by, f"{self.prefix}*")
        if keep:
            taken = self.new[part].select(F.lit(part).alias("part"), "directory").distinct()
            self.kept = self.kept.join(taken, ["part", "directory"], "left_anti")
        else:
            self.kept = self.kept.where(F.col("part") != part)

    def _listed(self, part: str, by: str | None, pattern: str) -> DataFrame:
        """Files of a part; their rows and ids are taken from footers and directories."""
        spark, path = self.spark, f"{self.root}/{part}"
        if not exists(spark, path):
            return spark.createDataFrame([], LISTED)
        reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        found = reader.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
        ids = spark.createDataFrame([], "file string, min_id bigint, max_id bigint, n_rows bigint")
        if by and not found.where(F.col("file").contains(f"/{by}=")).isEmpty():
            schema = ", ".join(f"{c} bigint" for c in dict.fromkeys(["shot_id", by]))
            # Directories of another layout, which the change replaces, may still be there.
            rows = spark.read.schema(schema).option("basePath", path).option("pathGlobFilter", pattern).parquet(f"{path}/{by}=*")
            ids = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
                F.min("shot_id").alias("min_id"), F.max("shot_id").alias("max_id"), F.count("*").alias("n_rows")
            )
        directory = F.regexp_extract("file", f"/{by}=(-?[0-9]+)/", 1) if by else F.lit(None).cast("string")
        listed = found.join(ids, "file", "left").select(
            F.lit(part).alias("part"), F.regexp_extract("file", f"^.*/({part}/.*)$", 1).alias("file"),
            directory.try_cast("long").alias("directory"), "min_id", "max_id", "n_rows", "bytes",
        )
        return materialize(listed, "files")

    def commit(self) -> None:
        """Let readers see the change, then delete what no longer counts."""
        spark, columns = self.spark, [c.split()[0] for c in LISTED.split(", ")]
        listed = self.kept.select(columns)
        for files in self.new.values():
            listed = listed.unionByName(files)
        name = f"{FILE_LISTS}/{self.prefix}"
        listed.coalesce(1).write.parquet(f"{self.root}/{name}")
        gone = self.old.join(self.kept.select("file"), "file", "left_anti").select("file", "directory").collect()
        folders = {r.file.rsplit("/", 1)[0] for r in gone if r.directory is not None}
        if folders:
            live = spark.read.schema(LISTED).parquet(f"{self.root}/{name}")
            live = live.select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct()
            folders -= {r.folder for r in live.toLocalIterator()}
        old_list, self.now["files"] = self.now["files"], name
        replace_text(spark, f"{self.root}/{CURRENT}", json.dumps(self.now, ensure_ascii=False))
        if self.now["card"]:
            replace_text(spark, f"{self.root}/{MANIFEST}", json.dumps(self.now["card"], indent=2, ensure_ascii=False))
        delete_all(spark, [f"{self.root}/{r.file}" for r in gone])
        delete_all(spark, [f"{self.root}/{f}" for f in sorted(folders)])
        if old_list:
            delete(spark, f"{self.root}/{old_list}")


def read_current(spark: SparkSession, mart_dir: str) -> dict | None:
    """What the mart holds at the moment; nothing if it was written without a list of files."""
    text = read_text(spark, f"{mart_dir.rstrip('/')}/{CURRENT}")
    return json.loads(text) if text else None


def read_files(spark: SparkSession, mart_dir: str, current: dict, part: str | None = None) -> DataFrame:
    """The files that count, with ids, rows and bytes."""
    files = spark.read.schema(LISTED).parquet(f"{mart_dir.rstrip('/')}/{current['files']}")
    return files.where(F.col("part") == part) if part else files


def vacuum(spark: SparkSession, config: MartConfig) -> int:
    """Delete what changes that were never finished have left in a mart; returns the number of files."""
    root = config.output_dir.rstrip("/")
    current = read_current(spark, root)
    if current is None:
        return 0
    parts = [f"{root}/{p}" for p in (METADATA, SIGNALS, QUARANTINE)]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*")
    found = files.load(existing(spark, parts)).select(F.col("_metadata.file_path").alias("path"))
    relative = F.regexp_extract("path", f"/((?:{METADATA}|{SIGNALS}|{QUARANTINE})/.*)$", 1)
    stray = found.withColumn("file", relative).join(read_files(spark, root, current), "file", "left_anti")
    paths = [f"{root}/{r.file}" for r in stray.select("file").toLocalIterator()]
    delete_all(spark, paths)
    return len(paths)


def write_metadata(table: DataFrame, config: MartConfig) -> str:
    """The dimension table, sorted by ``shot_id``; always replaced as a whole.

    Range-partitioned files keep it readable by id; a small table ends up in one file.
    """
    with scratch_scope(table.sparkSession):
        change = MartChange(table.sparkSession, config)
        _add_metadata(change, table)
        change.commit()
    return f"{config.output_dir}/{METADATA}"


def _add_metadata(change: MartChange, table: DataFrame) -> None:
    change.write(METADATA, table.orderBy("shot_id") if "shot_id" in table.columns else table)


def write_signals(signals: DataFrame, config: MartConfig, index: str | None = None) -> str:
    """The fact table, one directory per ``shot_id``, sorted by time inside each file.

    A recording is written by one task, into one file, unless it is long: then every ``file_rows``
    rows in a row go to a task and a file of their own. They are told apart by the row number
    ``index``, if there is one, else by time. More than ``max_directories`` recordings share
    directories by ranges of their ids, as a file and a directory for each would take far longer than the rows.
    ``overwrite`` replaces the whole tree; without it only the recordings being written are replaced: by their
    directories, or, where directories are shared, by writing the others in them once more.
    """
    with scratch_scope(signals.sparkSession):
        change = MartChange(signals.sparkSession, config)
        _add_signals(change, signals, index)
        change.commit()
    return f"{config.output_dir}/{SIGNALS}"


def _add_signals(change: MartChange, signals: DataFrame, index: str | None) -> None:
    config, n = change.config, change.config.shots_per_directory
    if n > 1 and not config.overwrite:
        raise ValueError("replacing single recordings needs one directory per recording")
    span, directory = n, "shot_id"
    if n == 1 and isinstance(signals.schema["shot_id"].dataType, IntegralType):
        ids = materialize(signals.select(F.col("shot_id").cast("long")).distinct(), "ids")
        span = (None if config.overwrite else _span_of_old(change)) or _span(ids, config.max_directories)
    if span > 1:
        directory = f"{SHARED_DIRECTORY}{span}"
        signals = signals.withColumn("shot_id", F.col("shot_id").cast("long"))
    if span > 1 and not config.overwrite:
        signals, index = _with_neighbours(change, signals, ids, directory, span), None
    if index:
        signals, blocks = signals.withColumn("_file", F.expr(f"{index} div {config.file_rows}")), ["_file"]
    else:
        signals, blocks = split_series(signals, ["shot_id"], [TIME_COLUMN], config.file_rows)
    helpers = [c for c in signals.columns if c.startswith("_")]
    if span > 1:
        signals = signals.withColumn(directory, F.expr(f"shot_id div {span}"))
    tasks = int(signals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges of ids may differ much in size, so that rows are dealt evenly and not by directory.
    deal = signals.repartitionByRange if span > n else signals.repartition
    dealt = (
        deal(tasks, *dict.fromkeys([directory, *(["shot_id"] if span > n else []), *blocks]))
        .sortWithinPartitions(*dict.fromkeys([directory, "shot_id", TIME_COLUMN]))
        .drop(*helpers)
    )
    change.write(SIGNALS, dealt, directory, keep=not config.overwrite)
    change.now["layout"] = {"directory": directory, "span": span, "schema": json.loads(dealt.schema.json())}


def _span(ids: DataFrame, max_directories: int) -> int:
    """Ids per directory: one, unless there are more recordings than directories may be."""
    n, least, most = ids.agg(F.count("shot_id"), F.min("shot_id"), F.max("shot_id")).first()
    return 1 if n <= max_directories else max(2, -(-(most - least + 1) // max_directories))


def _span_of_old(change: MartChange) -> int | None:
    """Ids per directory of the fact table that is there, if there is one."""
    if change.now["layout"]:
        return change.now["layout"]["span"]
    found = first_directory(change.spark, f"{change.root}/{SIGNALS}")
    if found is None:
        return None
    shared = found.startswith(SHARED_DIRECTORY)
    return int(found.split("=")[0][len(SHARED_DIRECTORY):]) if shared else 1


def _with_neighbours(change: MartChange, signals: DataFrame, ids: DataFrame, directory: str, span: int) -> DataFrame:
    """``signals`` and the old rows of the other recordings in the directories that are replaced."""
    signals = signals.drop(*[c for c in signals.columns if c.startswith("_")])
    touched = ids.select(F.expr(f"shot_id div {span}").alias("directory")).distinct()
    files = change.old.where(F.col("part") == SIGNALS).join(touched, "directory", "left_semi").select("file").collect()
    if not files:
        return signals
    root, schema = f"{change.root}/{SIGNALS}", StructType([*signals.schema.fields, StructField(directory, LongType())])
    old = change.spark.read.schema(schema).option("basePath", root).parquet(*[f"{change.root}/{r.file}" for r in files])
    return signals.unionByName(old.drop(directory).join(ids, "shot_id", "left_anti").select(signals.columns))


def manifest_statistics(table: DataFrame) -> DataFrame:
    """One row of data set statistics; NULL where the table lacks the column or has no rows."""
    def mean(name):
        if name not in table.columns:
            return F.lit(None).cast("double")
        return F.avg(F.col(name).cast("double"))

    digits = {"disruption_rate_declared": 3, "disruption_rate_detected": 3, "mean_completeness": 4}
    means = table.agg(
        F.count(F.lit(1)).alias("total_shots"),
        mean("declared_disruption").alias("disruption_rate_declared"),
        mean("disruption_detected").alias("disruption_rate_detected"),
        mean("overall_completeness").alias("mean_completeness"),
    )
    return means.selectExpr("total_shots", *[f"{round_exactly(c, n)} AS {c}" for c, n in digits.items()])


def flag_counts(table: DataFrame) -> DataFrame:
    """Number of recordings of every quality flag."""
    return table.where("quality_flag is not null").groupBy("quality_flag").agg(F.count("*").alias("n_shots"))


def manifest(
    table: DataFrame,
    created_at: str | None = None,
    name: str = "recordings-mart",
    shots_per_directory: int = 1,
) -> dict:
    """The data card. Only aggregates reach the driver: one row, and one for each kind of flag."""
    statistics = manifest_statistics(table).first().asDict()
    flags = {}
    if "quality_flag" in table.columns:
        rows = flag_counts(table).orderBy(F.desc("n_shots"), "quality_flag").collect()
        flags = {r.quality_flag: r.n_shots for r in rows}
    n = statistics["total_shots"]
    return {
        "name": name,
        "description": "Cleaned multi-sensor recordings with one metadata row each.",
        "pipeline_version": PIPELINE_VERSION,
        "created_at_utc": created_at or utc_now(),
        "tables": {
            "metadata": {
                "path": METADATA,
                "rows": n,
                "columns": table.columns if n else [],
                "description": "Dimension table: one row per recording.",
            },
            "signals": {
                "path": f"{SIGNALS}/",
                "partitioning": (
                    "shot_id"
                    if shots_per_directory == 1
                    else f"{SHARED_DIRECTORY}{shots_per_directory}"
                ),
                "description": "Fact table: cleaned series, one partition per recording.",
                "canonical_columns": [TIME_COLUMN, *SIGNAL_COLUMNS],
            },
        },
        "statistics": {"total_shots": n, "quality_flags": flags, **statistics},
        "usage": {
            "load_metadata": "read_metadata(spark, mart_dir)",
            "load_one_shot": "read_signals(spark, mart_dir, [1])",
            "load_filtered_signals": "select_signals(spark, mart_dir, \"quality_flag = 'OK'\")",
        },
    }


def write_manifest(table: DataFrame, config: MartConfig, created_at: str | None = None) -> str:
    with scratch_scope(table.sparkSession):
        change = MartChange(table.sparkSession, config)
        change.now["card"] = manifest(table, created_at, shots_per_directory=change.span)
        change.commit()
    return f"{config.output_dir}/{MANIFEST}"


def write_mart(
    table: DataFrame,
    signals: DataFrame,
    config: MartConfig = MartConfig(),
    created_at: str | None = None,
    index: str | None = None,
    errors: DataFrame | None = None,
) -> dict[str, str]:
    """Write all parts and return their paths; readers see all of them change at once.

    ``table`` is read several times; pass a written one if it is costly to compute. ``errors``, if
    there are any, are kept beside the mart.
    """
    with scratch_scope(table.sparkSession):
        change = MartChange(table.sparkSession, config)
        _add_metadata(change, table)
        _add_signals(change, signals, index)
        if errors is not None:
            change.write(QUARANTINE, errors)
        change.now["card"] = manifest(table, created_at, shots_per_directory=change.span)
        change.commit()
    names = {"metadata_table": METADATA, "signals_dir": SIGNALS, "manifest": MANIFEST}
    return {key: f"{config.output_dir}/{name}" for key, name in names.items()}
