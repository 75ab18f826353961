"""Checkpoints per shard: the furthest committed position, who may commit, and whether a shard is done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.positions import SHARD, position
from ..session import broadcast_checked, small_result

# Processor states in which a commit is allowed.
COMMIT_STATES = ("Processing", "ShardEnded")


def checkpoints(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The newest position per shard, or per shard of each chunk named by ``by``. No rows in, no rows out."""
    keys = [*SHARD, *by]
    flags = [c for c in ("is_last_in_shard",) if c in df.columns]
    newest = df.groupBy(*keys).agg(
        F.max(position()).alias("__at"), *[F.max_by(c, position()).alias(c) for c in flags]
    )
    at = F.col("__at")
    return newest.select(
        *keys,
        at["sequence_number"].alias("sequence_number"),
        at["sub_sequence_number"].alias("sub_sequence_number"),
        *flags,
    )


def merge_checkpoints(current: DataFrame, new: DataFrame) -> DataFrame:
    """The further of the stored and the new position of every shard: a checkpoint never moves back."""
    columns = [*SHARD, "sequence_number", "sub_sequence_number"]
    return checkpoints(current.select(*columns).unionByName(new.select(*columns)))


def can_checkpoint(df: DataFrame, states: DataFrame) -> DataFrame:
    """Add ``can_checkpoint``: the shard's processor is in a state that may commit."""
    allowed = broadcast_checked(states.select(*SHARD, F.col("state").isin(*COMMIT_STATES).alias("can_checkpoint")))
    return df.join(allowed, SHARD, "left").withColumn("can_checkpoint", F.coalesce("can_checkpoint", F.lit(False)))


def gated_checkpoints(df: DataFrame, states: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Checkpoints of the shards that may commit; aggregates first, so only a row per shard meets the states."""
    return can_checkpoint(checkpoints(df, by), states).filter("can_checkpoint").drop("can_checkpoint")


def after_checkpoint(df: DataFrame, stored: DataFrame) -> DataFrame:
    """Records strictly after their shard's checkpoint; a shard without one keeps everything."""
    resume = broadcast_checked(stored.select(*SHARD, position().alias("__resume")))
    ahead = F.col("__resume").isNull() | (position() > F.col("__resume"))
    return df.join(resume, SHARD, "left").filter(ahead).drop("__resume")


def mark_last_in_shard(df: DataFrame, ended: DataFrame) -> DataFrame:
    """Add ``is_last_in_shard``: true for the newest record of each shard listed in ``ended``."""
    of_ended = df.join(broadcast_checked(ended.select(*SHARD)), SHARD, "left_semi")
    ends = of_ended.groupBy(*SHARD).agg(F.max(position()).alias("__end"))
    marked = df.join(small_result(ends), SHARD, "left")
    return marked.withColumn("is_last_in_shard", F.coalesce(position() == F.col("__end"), F.lit(False))).drop("__end")


def shard_end_status(log: DataFrame, stored: DataFrame, ended: DataFrame, timeout_us: int | None, now) -> DataFrame:
    """State of each ended shard: 'complete' once its last record is committed, else 'waiting' or 'timed_out'.

    ``ended`` has the shard and ``ended_at``. Without a timeout a shard waits for ever. An ended shard
    without records has nothing to wait for. ``final_checkpoint`` says whether the end may be recorded:
    after a timeout it is, and whether that is an error is the caller's choice.
    """
    now = F.lit(now) if not hasattr(now, "_jc") else now
    last = log.join(broadcast_checked(ended.select(*SHARD)), SHARD, "left_semi")
    last = last.groupBy(*SHARD).agg(F.max(position()).alias("__end"))
    committed = stored.select(*SHARD, position().alias("__done"))
    joined = ended.join(last, SHARD, "left").join(committed, SHARD, "left")
    done = F.col("__end").isNull() | F.coalesce(F.col("__done") >= F.col("__end"), F.lit(False))
    overdue = F.lit(False) if timeout_us is None else F.timestamp_diff("MICROSECOND", F.col("ended_at"), now) >= timeout_us
    status = F.when(done, "complete").when(overdue, "timed_out").otherwise("waiting")
    return joined.select(*SHARD, status.alias("status")).withColumn("final_checkpoint", F.col("status") != "waiting")


def latest_state(lifecycle: DataFrame) -> DataFrame:
    """The last lifecycle state of each shard and the worker that reported it."""
    newest = F.max_by(F.struct("worker", "state"), F.struct("ts", "state"))
    last = lifecycle.groupBy(*SHARD).agg(newest.alias("__last"), F.max("ts").alias("ts"))
    return last.select(*SHARD, F.col("__last.worker").alias("worker"), F.col("__last.state").alias("state"), "ts")


def workers_started(worker_events: DataFrame) -> DataFrame:
    """Per worker: its last reported state, and whether it is ready (STARTED)."""
    last = worker_events.groupBy("worker").agg(F.max_by("state", F.struct("ts", "state")).alias("state"))
    return last.withColumn("started", F.col("state") == "STARTED")

