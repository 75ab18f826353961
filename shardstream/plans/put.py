"""The put of a table of records: validate, route, pack, batch, send, account; and the loop that retries failures."""

from __future__ import annotations

import logging
from collections.abc import Callable
from itertools import count

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..config import GROUP_ROWS, Limits
from ..functions import records as R
from ..functions.retry import Policy, plan_retries
from ..operators.batching import assign_batches
from ..operators.ordering import largest_group
from ..operators.packing import pack_records
from ..operators.produce import ENTRY, PUT, put_outcomes
from ..operators.routing import lookup_table, predict_shard
from ..session import materialize, scratch_path

# A put function gets the request entries and returns one response row per entry: ENTRY columns,
# error_code, error_message, duration_s.
PutFn = Callable[[DataFrame], DataFrame]

# What the entries of an attempt get whose put function raised an error.
PUT_RAISED = "PutRaised"

log = logging.getLogger(__name__)

RECORD = ["data", "partition_key", "explicit_hash_key"]

OUTCOME = [*ENTRY, "seq_in_put", "n_bytes", "n_records", "invalid_reason", "error_code", "error_message", "duration_s"]


def _count_of(condition) -> F.Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def _metrics() -> list:
    """What is observed of an attempt while its outcomes are written: requests, entries and records sent, failures, invalid records."""
    sent, first = F.col("batch_no").isNotNull(), F.col("request_index") == 0
    of = lambda c, when=sent: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    took = F.when(first, F.col("duration_s"))
    return [
        _count_of(first).alias("n_requests"), _count_of(sent).alias("n_entries"), of("n_records").alias("n_records"), of("n_bytes").alias("n_bytes"),
        _count_of(F.col("error_code").isNotNull()).alias("n_failed"), _count_of(F.col("invalid_reason").isNotNull()).alias("n_invalid"),
        F.count(took).alias("duration_count"), F.min(took).alias("duration_min"), F.max(took).alias("duration_max"), F.sum(took).alias("duration_sum"),
    ]


# An attempt's report; of the records that a put received there is one with each first attempt.
REPORT = (
    "attempt int, n_received long, received_bytes long, n_requests long, n_entries long, n_records long, n_bytes long, n_failed long, n_invalid long,"
    " duration_count long, duration_min double, duration_max double, duration_sum double"
)


class PutFailed(Exception):
    """Raised on request when a put ends with invalid or failed records."""


def prepare(
    records: DataFrame, shards, limits: Limits = Limits(), attempt: int = 0, largest: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Entries ready to send and the invalid records. Packs on the first attempt only; routes always.

    The records of each put are counted before any work is done on them, unless a bound is given: the
    count bounds its packs and its entries as well.
    """
    largest = largest_group(records, PUT) if largest is None else largest
    checked = R.validate(R.with_payload_size(records), limits)
    invalid = checked.filter("invalid_reason IS NOT NULL")
    valid = checked.filter("invalid_reason IS NULL").drop("invalid_reason")
    routed = predict_shard(valid.drop("shard_id"), shards)
    if attempt:
        batched = assign_batches(routed, limits, order=("last_batch", "last_shard", "last_index"), largest=largest)
    elif limits.aggregate:
        packed = pack_records(routed, limits, largest=largest).withColumnRenamed("first_seq", "seq_in_put")
        if largest > GROUP_ROWS:
            packed = materialize(packed)
        batched = assign_batches(packed, limits, order=("partition_key", "pack_no"), largest=largest)
    else:
        routed = routed.withColumn("n_records", F.lit(1).cast("bigint"))
        batched = assign_batches(routed, limits, largest=largest)
    return batched.withColumn("attempt", F.lit(attempt)), invalid.withColumn("attempt", F.lit(attempt))


def send(
    records: DataFrame, shards, limits: Limits, put_fn: PutFn, attempt: int = 0, largest: int | None = None,
    keep_errors: bool = False, folder: str | None = None, on_attempt: Callable[[dict], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One attempt. Returns the entries with their payload, and the outcomes.

    Entries and outcomes, with the invalid records, are written out (to ``folder``, if given): what was sent must not change when it is
    read again. With ``keep_errors`` an error that the put function raises, at once or when its responses are read, is
    the outcome of all entries of the attempt; otherwise it ends the job. A put function with a method ``commit`` is told when
    the responses of an attempt are stored. ``on_attempt`` gets what the attempt came to, observed while its outcomes
    are written.
    """
    spark = records.sparkSession
    entries, invalid = prepare(records, shards, limits, attempt, largest)
    if not attempt:
        entries = entries.withColumn("waited_ns", F.lit(0).cast("bigint"))
    entries = materialize(entries.select(*ENTRY, *RECORD, "seq_in_put", "n_bytes", "n_records", "waited_ns"))
    refused = invalid.select(*PUT, "attempt", "seq_in_put", "n_bytes", "invalid_reason")
    folder = folder or scratch_path(spark, "outcomes")

    def store(responses: DataFrame) -> tuple[DataFrame, dict]:
        answered = put_outcomes(entries.drop(*RECORD), responses).withColumn("invalid_reason", F.lit(None).cast("string"))
        # records were validated at the first attempt
        both = answered if attempt else answered.unionByName(refused, allowMissingColumns=True)
        seen = Observation()
        both.observe(seen, *_metrics()).write.mode("overwrite").parquet(folder)
        return spark.read.schema(both.schema).parquet(folder), seen.get

    try:
        outcomes, seen = store(put_fn(R.to_put_entries(entries)))
        if hasattr(put_fn, "commit"):
            put_fn.commit(spark, attempt)
    except Exception as problem:
        if not keep_errors:
            raise
        log.exception("the put function raised an error at attempt %d", attempt)
        said = F.lit(f"{type(problem).__name__}: {problem}")
        outcomes, seen = store(
            entries.select(*ENTRY, F.lit(PUT_RAISED).alias("error_code"), said.alias("error_message"), F.lit(None).cast("double").alias("duration_s"))
        )
    if on_attempt is not None:
        on_attempt({"attempt": attempt, **seen})
    return entries, outcomes


def put(records: DataFrame, shards, limits: Limits, put_fn: PutFn) -> DataFrame:
    """Put once, without retries; returns the outcome of every record."""
    return send(records, shards, limits, put_fn)[1].select(*OUTCOME)


def _received(records: DataFrame) -> tuple[int, int, int]:
    """The records of the largest put, and records and bytes of all: one pass that counts by put first."""
    per_put = R.with_payload_size(records).groupBy(*PUT).agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    return tuple(v or 0 for v in per_put.agg(F.max("n"), F.sum("n"), F.sum("bytes")).first())


def put_until_done(
    records: DataFrame,
    shards,
    limits: Limits,
    policy: Policy,
    put_fn: PutFn,
    raise_on_failures: bool = False,
    sleep: Callable[[float], None] | None = None,
    on_attempt: Callable[[dict], None] | None = None,
) -> DataFrame:
    """Put, then put the failed records again until none fail or the policy gives up on them.

    Every put keeps its own retry status, so puts give up independently. Each attempt is one round of
    Spark jobs over the records still failing; its outcomes are written, as one more folder of one table, before the next.
    Outcomes of all attempts are returned, every attempt once. Only the policy ends the rounds: one that never gives up goes
    on while records fail. An error that the put function raises fails all entries of its attempt, with the code
    PUT_RAISED and the whole message, and is retried like any failure; what had landed by then may land again, unless the put function
    lands when it is told to commit, as ``sources.record_log.LandingPut`` does. ``on_attempt`` gets a dict (REPORT) after each attempt,
    from the jobs that were run anyway.
    """
    lookup = lookup_table(shards)
    largest, received, received_bytes = _received(records)  # retried puts only get smaller
    pending, folder = records, scratch_path(records.sparkSession, "outcomes")

    def report(seen: dict) -> None:
        first = not seen["attempt"]
        on_attempt({**seen, "n_received": received * first, "received_bytes": received_bytes * first})

    for attempt in count():
        entries, outcomes = send(
            pending, lookup, limits, put_fn, attempt, largest, keep_errors=True, folder=f"{folder}/r{attempt}", on_attempt=on_attempt and report
        )
        failed = outcomes.filter("error_code IS NOT NULL").withColumnRenamed("waited_ns", "cumulative_ns")
        planned = plan_retries(failed.withColumn("retries_so_far", F.col("attempt")), policy).filter("decision = 'retry'")
        longest = planned.agg(F.max("delay_ns")).first()[0]
        if longest is None:
            break
        again = planned.select(*ENTRY, F.col("next_cumulative_ns").alias("waited_ns"))
        last = {"batch_no": "last_batch", "shard_id": "last_shard", "request_index": "last_index"}
        retried = entries.drop("waited_ns").join(again, ENTRY).withColumnsRenamed(last)
        pending = materialize(retried.drop("attempt", "n_bytes"))
        if sleep is not None and longest:
            sleep(longest / 1e9)
    # one scan, however many rounds there were
    everything = records.sparkSession.read.schema(outcomes.schema).option("recursiveFileLookup", "true").parquet(folder).select(*OUTCOME)
    if raise_on_failures:
        in_error = F.col("invalid_reason").isNotNull() | F.col("error_code").isNotNull()
        ends = everything.groupBy(*PUT).agg(
            F.max("attempt").alias("last"), F.max(F.when(in_error, F.col("attempt"))).alias("last_error")
        )
        ended_badly = ends.filter("last = last_error").count()
        if ended_badly:
            raise PutFailed(f"{ended_badly} puts ended with invalid or failed records")
    return everything
