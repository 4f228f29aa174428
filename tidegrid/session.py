"""Where a job may keep intermediate tables, and for how long."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import BROADCAST_BYTES, BROADCAST_ROWS
from tidegrid.files import arrow_reaches, delete, delete_all

#: Folders of the innermost scope, and of the process for whatever is made outside of any scope.
_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)
_unscoped: list[str] = []
_own_process = os.getpid()


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Without that setting a machine-local folder is used, which only a local master can share. The
    folder is deleted with the scope it is made in, else when the application's process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidegrid-")
        _unscoped.append(base)
    path = f"{base.rstrip('/')}/tidegrid-{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    (_unscoped if scope is None else scope).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Owns the scratch folders made inside and deletes them on the way out, after an error, too.

    Nothing that is read after the scope may depend on them: write results elsewhere before.
    """
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        delete_all(spark, made)


@atexit.register
def _delete_unscoped() -> None:
    """Tables of lazy results have to outlive the call that made them, but not the application."""
    if os.getpid() != _own_process:
        return
    for path in _unscoped:
        if arrow_reaches(path):  # other stores need the session, which is gone by now
            try:
                delete(None, path)
            except OSError:
                pass


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to a new table in the scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, int | None]:
    """List a small table on the driver and broadcast it; leave a larger one to a shuffle join.

    Returns the table and its row count, or ``None`` for the count when it exceeds ``max_rows`` rows or
    ``max_bytes`` bytes of text. Reading stops at the limit.
    """
    rows, size = [], 0
    for row in df.limit(max_rows + 1).toLocalIterator():
        rows.append(row)
        size += len(repr(row))
        if len(rows) > max_rows or size > max_bytes:
            return df, None
    local = df.sparkSession.createDataFrame(rows, df.schema)
    return F.broadcast(local), len(rows)
