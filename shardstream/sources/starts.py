"""Where a consumer starts in each shard: its checkpoint, else its initial position, captured once."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Position
from ..functions.positions import SHARD, position
from ..session import broadcast_checked
from .manifest import complete, log_tips, needed_files, read_files, read_table_or
from .record_log import CONSUMER_RECORD, read_record_log

# A start is after a position if it has one, else from an arrival time on if it has one, else at the shard's first record.
START = "stream_name string, shard_id string, sequence_number string, sub_sequence_number long, since timestamp_ntz"

Positions = Position | Mapping[str, Position]


def _by_stream(positions: Positions, make: Callable[[Position], Column], none: Column) -> Column:
    """A value for each stream's position; ``none`` for streams without one."""
    if isinstance(positions, Position):
        return make(positions)
    value = none
    for name, at in positions.items():
        value = F.when(F.col("stream_name") == name, make(at)).otherwise(value)
    return value


def _since(positions: Positions) -> Column:
    none = F.lit(None).cast("timestamp_ntz")
    return _by_stream(positions, lambda p: F.lit(p.at).cast("timestamp_ntz") if p.kind == "AT_TIMESTAMP" else none, none)


def initial_starts(tips: DataFrame, positions: Positions) -> DataFrame:
    """The initial position of each shard there is, given the newest position of each now."""
    latest = _by_stream(positions, lambda p: F.lit(p.kind == "LATEST"), F.lit(False))
    wanted = _by_stream(positions, lambda p: F.lit(True), F.lit(False))
    at = lambda c: F.when(latest, F.col(c)).alias(c)
    return tips.filter(wanted).select(*SHARD, at("sequence_number"), at("sub_sequence_number"), _since(positions).alias("since"))


def captured_starts(spark: SparkSession, path: str, positions: Positions, store: str) -> DataFrame:
    """The initial starts of a log's shards when this was first called for ``store``; from then on what was stored then.

    A folder that a crash left without all of its rows counts as not stored.
    """
    if not complete(spark, store):
        initial_starts(log_tips(spark, path), positions).write.mode("overwrite").parquet(store)
    return spark.read.schema(START).parquet(store)


def plan_starts(captured: DataFrame, stored: DataFrame) -> DataFrame:
    """Each shard's checkpoint if it has one, else its captured initial start."""
    after = stored.select(*SHARD, "sequence_number", "sub_sequence_number", F.lit(None).cast("timestamp_ntz").alias("since"))
    first = captured.join(stored.select(*SHARD), SHARD, "left_anti")
    return after.unionByName(first)


def from_starts(df: DataFrame, starts: DataFrame, positions: Positions) -> DataFrame:
    """The records of the configured streams past the start of their shard; works on tables and on streams.

    A shard without a start appeared after the starts were captured: nothing of it was there before, so all of it is read, but for
    records that arrived before their stream's AT_TIMESTAMP.
    """
    at = F.when(F.col("sequence_number").isNotNull(), position())
    plan = starts.select(*SHARD, at.alias("__at"), F.col("since").alias("__since"), F.lit(True).alias("__known"))
    joined = df.join(broadcast_checked(plan), SHARD, "left")
    since = F.when(F.col("__known"), F.col("__since")).otherwise(_since(positions))
    ahead = F.when(F.col("__at").isNotNull(), position() > F.col("__at")).when(since.isNotNull(), F.col("arrival") >= since).otherwise(True)
    wanted = _by_stream(positions, lambda p: F.lit(True), F.lit(False))
    return joined.filter(ahead & wanted).select(*df.columns)


def read_from_starts(spark: SparkSession, path: str, starts: DataFrame, positions: Positions) -> DataFrame:
    """The records past the starts, from those files only that the manifest says hold some."""
    return from_starts(read_files(spark, path, needed_files(spark, path, starts), CONSUMER_RECORD), starts, positions)


def resume_stream(
    spark: SparkSession, path: str, positions: Positions, captured: str, checkpoints: DataFrame | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """A log as a stream from where its consumer has to start: after ``checkpoints``, else from the initial positions captured below ``captured``.

    For a consumer that has lost its progress, or a new one that takes over. One that still has its progress goes on from there, and
    reads what it read before with the same starts.
    """
    starts = captured_starts(spark, path, positions, captured)
    if checkpoints is not None:
        starts = plan_starts(starts, checkpoints)
    return from_starts(read_record_log(spark, path, streaming=True, files_per_trigger=files_per_trigger), starts, positions)


def stored_starts(spark: SparkSession, captured: str) -> DataFrame:
    """The captured starts; none before they were captured."""
    return read_table_or(spark, captured, START)
