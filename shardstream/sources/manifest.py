"""Landing files in the record log once, and the manifest that says what each landed file holds.

A commit writes its files below ``_staged``, where no reader looks, then its manifest, then moves the files to where
readers do. The complete manifest is what decides: before it, a commit that is given up or run again has landed nothing;
after it, whoever comes next finishes moving its files.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.positions import SHARD, position
from ..session import broadcast_checked, remove_folder

STAGED, MANIFEST, DONE = "_staged", "_manifest", "_SUCCESS"

_AT = "struct<width:int,sequence_number:string,sub_sequence_number:bigint>"
ENTRY = (
    f"commit string, file string, stream_name string, shard_id string, n_records long, least {_AT}, greatest {_AT},"
    " first_arrival timestamp_ntz, last_arrival timestamp_ntz"
)

# Folders of single commits that are read before they are put together into one.
COMPACT_COMMITS = 100


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _files(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(where)) if files.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether a table was written to its end."""
    return exists(spark, f"{folder}/{DONE}")


def stage(df: DataFrame, path: str, commit: str) -> None:
    """Write a commit's records aside. What an earlier try of it left there is overwritten."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", commit):
        raise ValueError(f"a commit is named by letters, digits, dots and dashes, not {commit!r}")
    df.write.mode("overwrite").partitionBy("stream_name").parquet(f"{path}/{STAGED}/{commit}")


def land(spark: SparkSession, path: str, commit: str, schema: T.StructType) -> None:
    """Make a staged commit visible, once: the manifest of its files first, then the files themselves."""
    if not committed(spark, path, commit):
        staged = f"{path}/{STAGED}/{commit}"
        # the path of a file is URL-encoded, with a plus as it is
        whole = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        inside = F.substring_index(whole, f"/{STAGED}/{commit}/", -1)
        rows = spark.read.schema(schema).parquet(staged)
        held = rows.groupBy(inside.alias("file"), *SHARD).agg(
            F.count("*").alias("n_records"), F.min(position()).alias("least"), F.max(position()).alias("greatest"),
            F.min("arrival").alias("first_arrival"), F.max("arrival").alias("last_arrival"),
        )
        entries = held.withColumn("commit", F.lit(commit)).select(*T.StructType.fromDDL(ENTRY).names)
        entries.coalesce(1 + len(_names(spark, staged)) // 1000).write.mode("overwrite").parquet(f"{path}/{MANIFEST}/{commit}")
    _move(spark, path, commit)


def committed(spark: SparkSession, path: str, commit: str) -> bool:
    """Whether a commit has landed, by a folder of its own or in one that holds several."""
    if complete(spark, f"{path}/{MANIFEST}/{commit}"):
        return True
    return any(n.startswith("together-") for n in _names(spark, f"{path}/{MANIFEST}")) and not read_manifest(spark, path).filter(F.col("commit") == commit).isEmpty()


def _move(spark: SparkSession, path: str, commit: str) -> None:
    """Move what is still staged of a committed commit. Files that were moved before are not there any more."""
    files, staged = _files(spark, f"{path}/{STAGED}/{commit}")
    if not files.exists(staged):
        return
    for folder in files.listStatus(staged):
        if not folder.isDirectory() or folder.getPath().getName().startswith("_"):
            continue
        name = folder.getPath().getName()
        target = spark._jvm.org.apache.hadoop.fs.Path(files.makeQualified(_files(spark, path)[1]), name)
        files.mkdirs(target)
        for status in files.listStatus(folder.getPath()):
            to = spark._jvm.org.apache.hadoop.fs.Path(target, status.getPath().getName())
            if not files.rename(status.getPath(), to) and not files.exists(to):  # another may have moved it just now
                raise OSError(f"{status.getPath()} could not be moved to {to}")
    files.delete(staged, True)


def recover(spark: SparkSession, path: str) -> None:
    """Finish commits that were decided but whose files were not all moved. Others stay staged: they may be under way."""
    for commit in _names(spark, f"{path}/{STAGED}"):
        if complete(spark, f"{path}/{MANIFEST}/{commit}"):
            _move(spark, path, commit)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """What the files of a log hold: a row for each file and shard. Files of several commits may have gone into one folder; none counts twice."""
    recover(spark, path)
    folders = [f"{path}/{MANIFEST}/{n}" for n in _names(spark, f"{path}/{MANIFEST}") if complete(spark, f"{path}/{MANIFEST}/{n}")]
    if not folders:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(*folders).dropDuplicates(["file", *SHARD])


def compact(spark: SparkSession, path: str, most: int = COMPACT_COMMITS) -> None:
    """Put the folders of the manifest together once there are more than ``most``. The older ones go when the new one is complete."""
    names = [n for n in _names(spark, f"{path}/{MANIFEST}") if complete(spark, f"{path}/{MANIFEST}/{n}")]
    if len(names) <= most:
        return
    folder = f"{path}/{MANIFEST}/together-{uuid.uuid4()}"
    entries = read_manifest(spark, path)
    entries.hint("rebalance").write.parquet(folder)
    for name in names:
        remove_folder(spark, f"{path}/{MANIFEST}/{name}")


def needed(entries: DataFrame, starts: DataFrame) -> DataFrame:
    """Add ``needed``: a file's records of the shard go on past the shard's start (see ``sources.starts``)."""
    start = broadcast_checked(starts.select(*SHARD, _start().alias("__start"), F.col("since").alias("__since")))
    joined = entries.join(start, SHARD, "left")
    past = F.when(F.col("__start").isNotNull(), F.col("greatest") > F.col("__start")).when(
        F.col("__since").isNotNull(), F.col("last_arrival") >= F.col("__since")
    )
    return joined.withColumn("needed", F.coalesce(past, F.lit(True))).drop("__start", "__since")


def _start() -> Column:
    return F.when(F.col("sequence_number").isNotNull(), position())


def needed_files(spark: SparkSession, path: str, starts: DataFrame) -> list[str]:
    """The files of a log that hold records past the starts. A name a file, as many as a listing of the log's rest would give."""
    files = needed(read_manifest(spark, path), starts).filter("needed").select("file").distinct()
    return [f"{path}/{r['file']}" for r in files.collect()]


def read_files(spark: SparkSession, path: str, files: list[str], schema: T.StructType) -> DataFrame:
    """The records of some files of a log."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files)


def log_tips(spark: SparkSession, path: str) -> DataFrame:
    """The newest position of each shard, from the manifest: no record is read."""
    tips = read_manifest(spark, path).groupBy(*SHARD).agg(F.max("greatest").alias("__at"))
    return tips.select(*SHARD, F.col("__at.sequence_number").alias("sequence_number"), F.col("__at.sub_sequence_number").alias("sub_sequence_number"))


def read_table_or(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A stored table with a known schema; without rows if it, or any file of it, is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
