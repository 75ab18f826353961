"""Session helpers: materialising a table in the shared folder and broadcasting tables of checked size."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import BROADCAST_ROWS


def ship_code() -> None:
    """Send this package's Python functions to the executors by value, so they need no installed copy."""
    import shardstream

    cloudpickle.register_pickle_by_value(shardstream)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one is set only in local mode and only if none is."""
    context = spark.sparkContext
    configured = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="shardstream-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


_scopes = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder, or below that of the open :func:`scratch_scope`."""
    open_scopes = getattr(_scopes, "folders", [])
    base = open_scopes[-1] if open_scopes else ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4()}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can reach it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialised inside are gone when it ends: for work whose results are written elsewhere by then."""
    folder = scratch_path(spark, "scope")
    _scopes.folders = [*getattr(_scopes, "folders", []), folder]
    try:
        yield
    finally:
        _scopes.folders = _scopes.folders[:-1]
        remove_folder(spark, folder)


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared checkpoint folder and read on from there.

    Rows that two branches of a query must see alike, or that a driver loop builds on, go through
    here: the lineage is cut, a lost executor costs a re-read, not another evaluation, and later
    steps read only the columns they need.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the table has at most ``max_rows`` rows; otherwise leave the join to Spark.

    For stored dimension tables, where counting is cheap. Spark's adaptive skew handling splits hot
    keys when the join ends up shuffled.
    """
    if df.isStreaming:
        return df
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def small_result(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Like :func:`broadcast_checked` for a table computed from a large one: evaluate it once, then check."""
    return broadcast_checked(materialize(df), max_rows)
