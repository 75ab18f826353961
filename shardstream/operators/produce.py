"""Accounting of puts: matching responses to entries, errors, summaries and messages per put."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batching import PUT

REQUEST = [*PUT, "attempt", "batch_no", "shard_id"]
ENTRY = [*REQUEST, "request_index"]

# Error code under which all invalid records are counted.
INVALID = "InvalidRecord"


def failed_records(entries: DataFrame, responses: DataFrame) -> DataFrame:
    """Entries whose response carries an error code. Responses match entries by position in the request."""
    errors = responses.filter("error_code IS NOT NULL").select(*ENTRY, "error_code", "error_message")
    return entries.join(errors, ENTRY)


def put_outcomes(entries: DataFrame, responses: DataFrame) -> DataFrame:
    """Every entry with its response's error, if any, and the request's duration."""
    answered = responses.select(*ENTRY, "error_code", "error_message", "duration_s")
    return entries.join(answered, ENTRY, "left")


def error_counts(outcomes: DataFrame) -> DataFrame:
    """Errors per code, over all attempts; invalid records count under one code."""
    code = F.when(F.col("invalid_reason").isNotNull(), INVALID).otherwise(F.col("error_code"))
    return (
        outcomes.select("stream_name", code.alias("error_code"))
        .filter("error_code IS NOT NULL")
        .groupBy("stream_name", "error_code")
        .agg(F.count("*").alias("n_errors"))
    )


def merge_attempts(outcomes: DataFrame) -> DataFrame:
    """Outcomes over all attempts of a put: successes and invalid records add up, failures count last attempt only.

    Only failures are joined with their put's last attempt; all other rows stay where they are.
    """
    last = outcomes.groupBy(*PUT).agg(F.max("attempt").alias("attempt"))
    failed = outcomes.filter("error_code IS NOT NULL").join(last, [*PUT, "attempt"], "left_semi")
    return outcomes.filter("error_code IS NULL").unionByName(failed)


def put_summary(outcomes: DataFrame) -> DataFrame:
    """One row per put: responses received, invalid and failed records, and the flags derived from them.

    A response counts as successful even if some of its records failed. Failures are those of the
    last attempt. Counted per attempt first, so a put of any size is combined map-side.
    """
    per_attempt = outcomes.groupBy(*PUT, "attempt").agg(
        F.count_if(F.col("request_index") == 0).alias("n"),
        F.count_if(F.col("invalid_reason").isNotNull()).alias("bad"),
        F.count_if(F.col("error_code").isNotNull()).alias("failed"),
    )
    counts = per_attempt.groupBy(*PUT).agg(
        F.count("*").alias("n_attempts"),
        F.sum("n").alias("n_successful"),
        F.sum("bad").alias("n_invalid"),
        F.max_by("failed", "attempt").alias("n_failed"),
    )
    some, errors = F.col("n_successful") > 0, (F.col("n_invalid") + F.col("n_failed")) > 0
    return counts.withColumns(
        {
            "has_successful": some,
            "has_errors": errors,
            "is_successful": some & ~errors,
            "is_partially_successful": some & errors,
        }
    )


def error_messages(outcomes: DataFrame) -> DataFrame:
    """The error message of each put with errors, in parts ordered by ``part_no``.

    Part 0 counts the invalid records by kind and the failures; part n+1 lists the failures of batch n
    of the last attempt, one line each. Joining the parts gives the whole message. A part covers at
    most one batch, so its size is bounded however many records a put has. Two passes: one counts, by put and attempt
    first, the other lists the failures.
    """
    count = lambda c, name: F.count_if(c).alias(name)
    reason, failing = F.col("invalid_reason"), F.col("error_code").isNotNull()
    kinds = {"too large": "RecordTooLarge", "bad partition key": "InvalidPartitionKey", "bad explicit hash key": "InvalidExplicitHashKey"}
    per_attempt = outcomes.groupBy(*PUT, "attempt").agg(
        count(reason.isNotNull(), "invalid"),
        *[count(reason == name, name) for name in kinds.values()],
        count(failing, "failed"),
        F.min(F.when(failing, F.col("batch_no"))).alias("first_batch"),
    )
    puts = per_attempt.groupBy(*PUT).agg(
        *[F.sum(c).alias(c) for c in ("invalid", *kinds.values())],
        *[F.max_by(c, "attempt").alias(c) for c in ("failed", "first_batch")],
        F.max("attempt").alias("attempt"),
    )
    parts = [F.when(F.col(name) > 0, F.concat(F.lit(f"{text}: "), F.col(name).cast("string"))) for text, name in kinds.items()]
    invalid = F.when(F.col("invalid") > 0, F.concat(F.lit("invalid records: "), F.col("invalid").cast("string"), F.lit(" ("), F.concat_ws(", ", *parts), F.lit(")")))
    failed = F.when(F.col("failed") > 0, F.concat(F.lit("failed records: "), F.col("failed").cast("string")))
    head = F.concat_ws("; ", invalid, failed)
    line = F.concat(F.lit("\n  "), "error_code", F.lit(": "), F.coalesce("error_message", F.lit("")))
    listed = outcomes.filter(failing).groupBy(*PUT, "attempt", "batch_no").agg(
        F.sort_array(F.collect_list(F.struct("shard_id", "request_index", line.alias("line")))).alias("lines")
    )
    both = puts.filter("invalid + failed > 0").join(listed, [*PUT, "attempt"], "left")
    part = lambda number, message: F.struct(number.cast("bigint").alias("part_no"), message.alias("message"))
    leads = F.col("batch_no").eqNullSafe(F.col("first_batch"))  # the put's first row also brings its head
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    rows = F.array_compact(F.array(F.when(leads, part(F.lit(0), head)), F.when(F.col("lines").isNotNull(), part(F.col("batch_no") + 1, text))))
    return both.select(*PUT, F.inline(rows))


def requests(outcomes: DataFrame) -> DataFrame:
    """One row per request sent: its records, bytes and duration."""
    sent = outcomes.filter("batch_no IS NOT NULL")
    return sent.groupBy(*REQUEST).agg(
        F.count("*").alias("n_records"), F.sum("n_bytes").alias("n_bytes"), F.max("duration_s").alias("duration_s")
    )
