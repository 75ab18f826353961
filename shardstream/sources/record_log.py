"""The landed record log: Parquet partitioned by stream, read from a position, for one or many streams."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Position
from ..operators.checkpoints import after_checkpoint, checkpoints
from ..operators.produce import ENTRY
from ..session import broadcast_checked, materialize
from . import manifest

CHECKPOINT = "stream_name string, shard_id string, sequence_number string, sub_sequence_number long"

CONSUMER_RECORD = T.StructType(
    [
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("sub_sequence_number", T.LongType()),
        T.StructField("arrival", T.TimestampNTZType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("encryption_type", T.StringType()),
        T.StructField("explicit_hash_key", T.StringType()),
        T.StructField("stream_name", T.StringType()),
    ]
)


def write_record_log(df: DataFrame, path: str, mode: str = "append", commit: str | None = None) -> None:
    """Land consumer records, once for each ``commit`` name: a name that has landed before lands nothing more.

    One directory per stream; shards stay columns, since a stream may have thousands. Rows are rebalanced by shard before:
    small shards share a task, a hot one is split over many, files come out evenly sized and hold few shards. The
    manifest notes for each file and shard the positions and arrivals it holds, so that a consumer reads only files it needs.
    """
    spark, commit = df.sparkSession, commit or str(uuid.uuid4())
    if mode == "overwrite":
        manifest.remove_folder(spark, path)
    manifest.recover(spark, path)
    if manifest.committed(spark, path, commit):
        return
    stage_records(df, path, commit)
    manifest.land(spark, path, commit, CONSUMER_RECORD)
    manifest.compact(spark, path)


def stage_records(df: DataFrame, path: str, commit: str) -> None:
    """Write records aside, to be landed by their commit's name."""
    rows = df.select(*[f.name for f in CONSUMER_RECORD.fields])
    manifest.stage(rows.hint("rebalance", "stream_name", "shard_id"), path, commit)


def read_record_log(
    spark: SparkSession,
    path: str,
    position: Position | None = None,
    streaming: bool = False,
    stream_name: str | None = None,
    tips: DataFrame | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """All records of a log, or of one stream of it, from a position on; as a table or as a stream.

    ``files_per_trigger`` bounds how much a streaming query takes at once.
    """
    if streaming:
        reader = spark.readStream.schema(CONSUMER_RECORD)
        if files_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = spark.read.schema(CONSUMER_RECORD)
    log = reader.parquet(path)
    if stream_name is not None:
        log = log.filter(F.col("stream_name") == stream_name)  # prunes partitions
    return log if position is None else from_position(log, position, tips)


def shard_tips(log: DataFrame, store: str | None = None) -> DataFrame:
    """The newest position of each shard now, for a consumer that starts at LATEST: written out, so that it stays what it was.

    With a ``store`` the tips are captured once and read from there ever after, also by a consumer that starts again. A store that a
    crash left incomplete is captured anew.
    """
    if store is None:
        return materialize(checkpoints(log))
    spark = log.sparkSession
    if not manifest.complete(spark, store):
        checkpoints(log).write.mode("overwrite").parquet(store)
    return spark.read.schema(CHECKPOINT).parquet(store)


def from_position(df: DataFrame, position: Position, tips: DataFrame | None = None) -> DataFrame:
    """Records from the initial position: all, those after the captured tips, or those arrived since a time."""
    if position.kind == "TRIM_HORIZON":
        return df
    if position.kind == "AT_TIMESTAMP":
        return df.filter(F.col("arrival") >= F.lit(position.at))
    if position.kind == "LATEST":
        if tips is None:
            raise ValueError("LATEST needs the shard tips captured when the consumer started")
        return after_checkpoint(df, tips)
    raise ValueError(f"unknown position {position.kind}")


def select_many(log: DataFrame, positions: dict[str, Position], tips: DataFrame | None = None) -> DataFrame:
    """The configured streams of a log, each from its own position. One scan, whatever the number of streams."""
    wanted = log.filter(F.col("stream_name").isin(sorted(positions)))
    since = [(name, p.at) for name, p in positions.items() if p.kind == "AT_TIMESTAMP"]
    if since:
        spark = log.sparkSession
        kind = log.schema["arrival"].dataType
        starts = spark.createDataFrame(
            since, T.StructType([T.StructField("stream_name", T.StringType()), T.StructField("__since", kind)])
        )
        wanted = wanted.join(broadcast_checked(starts), "stream_name", "left")
        wanted = wanted.filter(F.col("__since").isNull() | (F.col("arrival") >= F.col("__since"))).drop("__since")
    latest = sorted(name for name, p in positions.items() if p.kind == "LATEST")
    if latest:
        if tips is None:
            raise ValueError("LATEST needs the shard tips captured when the consumer started")
        wanted = after_checkpoint(wanted, tips.filter(F.col("stream_name").isin(latest)))
    return wanted


def read_many(
    spark: SparkSession, path: str, positions: dict[str, Position], tips: DataFrame | None = None, streaming: bool = False
) -> DataFrame:
    return select_many(read_record_log(spark, path, streaming=streaming), positions, tips)


def with_stream_identifier(df: DataFrame, streams: DataFrame) -> DataFrame:
    """Add ``stream_identifier``, account:stream:creation epoch in milliseconds, from a stream catalog.

    ``streams`` has stream_name, account_id and created_ms.
    """
    identity = F.concat_ws(":", "account_id", "stream_name", F.col("created_ms").cast("string"))
    known = streams.select("stream_name", identity.alias("stream_identifier"))
    return df.join(broadcast_checked(known), "stream_name", "left")


def sequence_number() -> F.Column:
    """56 digits that order the entries of a shard by put, attempt, batch and place in the request; no part can outgrow its digits."""
    part = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    return F.concat(part("put_id", 19), part("attempt", 10), part("batch_no", 19), part("request_index", 8))


class LandingPut:
    """A put function that lands every entry in a record log and reports success.

    The entries of an attempt are staged when it is called, and land when the put takes their responses (``commit``): an
    attempt that raises an error after writing lands nothing. ``name`` tells the puts of a log apart; an attempt of a
    put that runs again, as a stream's batch may after a crash, lands nothing that it had landed before. Without a name each
    of these objects is a put of its own.
    """

    def __init__(self, path: str, arrival: dt.datetime, name: str | None = None):
        self.path, self.arrival, self.name = path, arrival, name or str(uuid.uuid4())

    def for_batch(self, batch_id: int) -> LandingPut:
        """The put function of one micro-batch of a stream."""
        return LandingPut(self.path, self.arrival, f"{self.name}.{batch_id}")

    def __call__(self, entries: DataFrame) -> DataFrame:
        landed = entries.select(
            "stream_name",
            "shard_id",
            sequence_number().alias("sequence_number"),
            F.lit(None).cast("bigint").alias("sub_sequence_number"),
            F.lit(self.arrival).cast("timestamp_ntz").alias("arrival"),
            "data",
            "partition_key",
            F.lit("NONE").alias("encryption_type"),
            "explicit_hash_key",
        )
        attempt = entries.agg(F.max("attempt")).first()[0]
        if attempt is not None and not manifest.committed(entries.sparkSession, self.path, self._commit(attempt)):
            stage_records(landed, self.path, self._commit(attempt))
        return entries.select(
            *ENTRY,
            F.lit(None).cast("string").alias("error_code"),
            F.lit(None).cast("string").alias("error_message"),
            F.lit(None).cast("double").alias("duration_s"),
        )

    def _commit(self, attempt: int) -> str:
        return f"{self.name}.{attempt}"

    def commit(self, spark: SparkSession, attempt: int) -> None:
        """Land an attempt's staged entries, once."""
        if manifest.exists(spark, f"{self.path}/{manifest.STAGED}/{self._commit(attempt)}"):
            manifest.land(spark, self.path, self._commit(attempt), CONSUMER_RECORD)


def landing_put_fn(path: str, arrival: dt.datetime, name: str | None = None) -> LandingPut:
    return LandingPut(path, arrival, name)
