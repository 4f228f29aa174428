"""Single files and folders on shared storage: by Arrow where it knows the store, else by Spark's own file systems.

Tables are read and written by Spark; this is for the few small things around them.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyarrow import fs
from pyspark.sql import SparkSession

#: Stores that Arrow reaches by itself, in tasks as on the driver.
ARROW_STORES = ("file", "s3", "s3a", "gs", "abfs", "abfss")
#: Stores in which writing an object replaces it at once.
OBJECT_STORES = ("s3", "gcs", "abfs")
_AT_ONCE = 16


def scheme_of(path: str) -> str:
    found = re.match(r"([a-z][a-z0-9+.-]*):", path)
    return found[1] if found else "file"


def arrow_reaches(path: str) -> bool:
    return scheme_of(path) in ARROW_STORES


def arrow_path(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path; for tasks, too."""
    scheme = scheme_of(path)
    if scheme == "file":
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", path)
    return fs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    if arrow_reaches(path):
        store, name = arrow_path(path)
        return store.get_file_info(name).type != fs.FileType.NotFound
    store, p = _hadoop(spark, path)
    return store.exists(p)


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` that exist, asked for side by side."""
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        found = list(pool.map(lambda p: exists(spark, p), paths))
    return [p for p, there in zip(paths, found) if there]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    if not arrow_reaches(path):
        store, p = _hadoop(spark, path)
        store.delete(p, True)
        return
    store, name = arrow_path(path)
    kind = store.get_file_info(name).type
    if kind == fs.FileType.Directory:
        store.delete_dir(name)
    elif kind == fs.FileType.File:
        store.delete_file(name)


def delete_all(spark: SparkSession, paths: list[str]) -> None:
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        list(pool.map(lambda p: delete(spark, p), paths))


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or nothing if there is none."""
    if not exists(spark, path):
        return None
    if arrow_reaches(path):
        store, name = arrow_path(path)
        with store.open_input_stream(name) as source:
            return source.read().decode()
    return spark.read.text(path, wholetext=True).first().value


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see either the old one or the new one, whole."""
    beside = f"{path}.{uuid.uuid4().hex}"
    if arrow_reaches(path):
        store, name = arrow_path(path)
        at_once = store.type_name in OBJECT_STORES
        aside = name if at_once else arrow_path(beside)[1]
        store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(aside) as out:
            out.write(text.encode())
        if not at_once:
            store.move(aside, name)
        return
    jvm = spark._jvm
    store, p = _hadoop(spark, path)
    out = store.create(jvm.org.apache.hadoop.fs.Path(beside))
    out.write(bytearray(text.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = rename
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(jvm.org.apache.hadoop.fs.Path(beside), p, options)


def first_directory(spark: SparkSession, path: str) -> str | None:
    """Name of one ``key=value`` folder in ``path``."""
    if arrow_reaches(path):
        store, name = arrow_path(path)
        listed = store.get_file_info(fs.FileSelector(name, allow_not_found=True))
        return min((i.base_name for i in listed if i.type == fs.FileType.Directory and "=" in i.base_name), default=None)
    store, p = _hadoop(spark, path)
    entries = store.listStatusIterator(p)
    while entries.hasNext():
        entry = entries.next()
        if entry.isDirectory() and "=" in entry.getPath().getName():
            return entry.getPath().getName()
    return None
