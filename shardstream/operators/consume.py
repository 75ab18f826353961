"""Consumer-side questions: what a consumer still has to read, what it lost, which checkpoints are stale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.positions import SHARD, position
from ..session import broadcast_checked


def former_checkpoints(
    stored: DataFrame, streams: DataFrame | None, mode: str, wait_us: int, now
) -> DataFrame:
    """Checkpoints to delete because their stream is no longer consumed.

    ``mode`` 'none' selects nothing; 'detect' selects streams missing from ``streams``; 'provided'
    selects the streams listed in it. Either way only after ``wait_us`` since the last update.
    """
    if mode == "none":
        return stored.limit(0)
    if mode not in ("detect", "provided"):
        raise ValueError("mode is 'none', 'detect' or 'provided'")
    now = F.lit(now) if not hasattr(now, "_jc") else now
    waited = stored.filter(F.timestamp_diff("MICROSECOND", F.col("updated"), now) >= wait_us)
    names = broadcast_checked(streams.select("stream_name").distinct())
    return waited.join(names, "stream_name", "left_anti" if mode == "detect" else "left_semi")


def reconcile(produced: DataFrame, consumed: DataFrame, keys: list[str], data: str = "data") -> DataFrame:
    """Compare what was produced with what was consumed, key by key.

    Each key is 'ok', 'lost' (consumed less often than produced), 'duplicated' (more often), 'foreign'
    (never produced) or 'differs' (equal counts, other payload). Only keys and digests are shuffled,
    and both sides meet in one aggregation.
    """

    def side(df, is_produced):
        one = F.lit(1).cast("bigint")
        return df.select(
            *keys,
            F.md5(data).alias("__digest"),
            (one if is_produced else one * 0).alias("__p"),
            (one * 0 if is_produced else one).alias("__c"),
        )

    both = side(produced, True).unionByName(side(consumed, False))
    # digests with their counts on both sides first, so that keys with many rows stay small
    per_payload = both.groupBy(*keys, "__digest").agg(F.sum("__p").alias("__p"), F.sum("__c").alias("__c"))
    per_key = per_payload.groupBy(*keys).agg(
        F.sum("__p").alias("n_produced"),
        F.sum("__c").alias("n_consumed"),
        F.max(F.abs(F.col("__p") - F.col("__c"))).alias("__off"),
    )
    return per_key.select(*keys, "n_produced", "n_consumed", _status(F.col("__off") > 0).alias("status"))


def _status(unlike: Column) -> Column:
    p, c = F.col("n_produced"), F.col("n_consumed")
    return F.when(p == 0, "foreign").when(c < p, "lost").when(c > p, "duplicated").when(unlike, "differs").otherwise("ok")


def reconcile_stream(produced: DataFrame, consumed: DataFrame, keys: list[str], time: str, wait: str, data: str = "data") -> DataFrame:
    """Compare two streams key by key while they run: a row for each key once nothing has come for it for ``wait``.

    The same statuses as :func:`reconcile`, which lost and foreign keys get when their time is up, in append mode. A key is a
    session: its counts, and the sum of its payloads' hashes, produced ones up and consumed ones down, which is zero if the payloads are the
    same. State lasts for ``wait``; what is consumed later than that is reported as lost first and as foreign then. ``time`` is a
    timestamp column of both.
    """

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, F.col(time).alias("__at"), F.lit(sign).alias("__sign"), F.xxhash64(F.md5(data)).cast("decimal(38,0)").alias("__hash"))

    both = side(produced, 1).unionByName(side(consumed, -1)).withWatermark("__at", "0 seconds")
    per_key = both.groupBy(*keys, F.session_window("__at", wait).alias("__open")).agg(
        F.count_if(F.col("__sign") > 0).alias("n_produced"),
        F.count_if(F.col("__sign") < 0).alias("n_consumed"),
        F.sum(F.col("__hash") * F.col("__sign")).alias("__off"),
    )
    return per_key.select(*keys, "n_produced", "n_consumed", _status(F.col("__off") != 0).alias("status"))


def reconcile_summary(compared: DataFrame) -> DataFrame:
    return compared.groupBy("status").agg(
        F.count("*").alias("n_keys"), F.sum("n_produced").alias("n_produced"), F.sum("n_consumed").alias("n_consumed")
    )


def consumer_lag(log: DataFrame, stored: DataFrame, now) -> DataFrame:
    """Per shard: records after the checkpoint and milliseconds behind the tip.

    Caught up is 0; otherwise the age at ``now`` of the last record read, or of the shard's first
    record if none was read yet.
    """
    now = F.lit(now) if not hasattr(now, "_jc") else now
    resume = broadcast_checked(stored.select(*SHARD, position().alias("__resume")))
    read = F.coalesce(position() <= F.col("__resume"), F.lit(False))
    shards = (
        log.join(resume, SHARD, "left")
        .groupBy(*SHARD)
        .agg(
            F.count_if(~read).alias("n_behind"),
            F.max(F.when(read, F.col("arrival"))).alias("__read"),
            F.min("arrival").alias("__first"),
        )
    )
    age = F.timestamp_diff("MILLISECOND", F.coalesce("__read", "__first"), now)
    return shards.select(
        *SHARD,
        "n_behind",
        F.when(F.col("n_behind") == 0, F.lit(0).cast("bigint")).otherwise(age).alias("millis_behind_latest"),
    )
