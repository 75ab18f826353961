"""Queries over put outcomes: failures, summaries, messages, retries."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...config import Limits
from ...functions.records import validate, with_payload_size
from ...functions.retry import LONGEST, Policy, plan_retries
from ...operators import produce, routing
from ..put import put_until_done
from ..testtables import listing, records
from .registry import RECORDS, query, ranges_sql
from .routing_queries import FOUR, LOOKUP

THROTTLED, INTERNAL = "ProvisionedThroughputExceededException", "InternalFailure"


def sent(spark, sf_dir):
    """Events as entries of three attempts: attempt 1 repeats every 7th event, attempt 2 every 49th.

    Each put is one batch; a user's events share a shard. Invalid records are kept aside.
    """
    checked = validate(with_payload_size(records(spark, sf_dir)))
    tries = F.when(F.col("event_id") % 49 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).when(
        F.col("event_id") % 7 == 0, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    entries = (
        checked.filter("invalid_reason IS NULL")
        .withColumn("shard_id", F.format_string("shardId-%012d", F.col("partition_key").cast("int") % 4))
        .withColumn("batch_no", F.lit(0).cast("bigint"))
        .withColumn("attempt", F.explode(tries))
    )
    place = Window.partitionBy(*produce.REQUEST).orderBy("seq_in_put")
    return entries.withColumn("request_index", F.row_number().over(place).cast("bigint") - 1), checked.filter(
        "invalid_reason IS NOT NULL"
    ).withColumn("attempt", F.lit(0))


def responses(entries):
    """Every 7th event fails at attempt 0, every 49th again, every 343rd for good."""
    failing = F.col("event_id") % F.pow(F.lit(7), F.col("attempt") + 1).cast("bigint") == 0
    code = F.when(failing, F.when(F.col("event_id") % 2 == 0, THROTTLED).otherwise(INTERNAL))
    return entries.select(
        *produce.ENTRY,
        code.alias("error_code"),
        F.when(failing, F.lit("slow down")).alias("error_message"),
        ((F.col("put_id") % 10 + 1) / 8).alias("duration_s"),
    )


def outcomes(spark, sf_dir):
    entries, invalid = sent(spark, sf_dir)
    answered = produce.put_outcomes(entries, responses(entries))
    return answered.unionByName(invalid, allowMissingColumns=True)


OUTCOMES = f"""WITH {RECORDS},
tries AS (SELECT * FROM (VALUES (0), (1), (2)) t(attempt)),
sent AS (SELECT v.*, attempt, 'shardId-' || lpad((user_id % 4)::VARCHAR, 12, '0') AS shard_id, 0::BIGINT AS batch_no,
                event_id % (7 ** (attempt + 1))::BIGINT = 0 AS failing
         FROM valid v, tries WHERE attempt = 0 OR event_id % (7 ** attempt)::BIGINT = 0),
outcomes AS (
  SELECT stream_name, put_id, attempt, batch_no, shard_id, event_id, n_bytes, NULL AS invalid_reason,
         row_number() OVER (PARTITION BY stream_name, put_id, attempt, shard_id ORDER BY seq_in_put) - 1 AS request_index,
         CASE WHEN failing THEN CASE WHEN event_id % 2 = 0 THEN '{THROTTLED}' ELSE '{INTERNAL}' END END AS error_code,
         CASE WHEN failing THEN 'slow down' END AS error_message, (put_id % 10 + 1) / 8 AS duration_s
  FROM sent
  UNION ALL
  SELECT stream_name, put_id, 0, NULL, NULL, event_id, n_bytes, invalid_reason, NULL, NULL, NULL, NULL
  FROM checked WHERE invalid_reason IS NOT NULL),
ends AS (SELECT stream_name, put_id, max(attempt) AS last FROM outcomes GROUP BY ALL),
merged AS (SELECT o.*, last FROM outcomes o JOIN ends USING (stream_name, put_id) WHERE error_code IS NULL OR attempt = last)"""


@query(
    "failed_records",
    f"{OUTCOMES} SELECT event_id, attempt, request_index, error_code FROM outcomes WHERE error_code IS NOT NULL",
)
def failed_records(spark, sf_dir):
    entries, _ = sent(spark, sf_dir)
    return produce.failed_records(entries, responses(entries)).select("event_id", "attempt", "request_index", "error_code")


@query(
    "error_counts",
    f"""{OUTCOMES} SELECT stream_name, coalesce(CASE WHEN invalid_reason IS NOT NULL THEN 'InvalidRecord' END, error_code) AS error_code,
          count(*) AS n_errors FROM outcomes WHERE invalid_reason IS NOT NULL OR error_code IS NOT NULL GROUP BY ALL""",
)
def error_counts(spark, sf_dir):
    return produce.error_counts(outcomes(spark, sf_dir))


@query(
    "put_summary",
    f"""{OUTCOMES}, counts AS (
          SELECT stream_name, put_id, count(DISTINCT attempt) AS n_attempts,
                 count(DISTINCT CASE WHEN shard_id IS NOT NULL THEN attempt || '/' || shard_id END) AS n_successful,
                 count(invalid_reason) AS n_invalid,
                 count(CASE WHEN attempt = last THEN error_code END) AS n_failed
          FROM outcomes JOIN ends USING (stream_name, put_id) GROUP BY ALL)
        SELECT *, n_successful > 0 AS has_successful, n_invalid + n_failed > 0 AS has_errors,
               n_successful > 0 AND n_invalid + n_failed = 0 AS is_successful,
               n_successful > 0 AND n_invalid + n_failed > 0 AS is_partially_successful FROM counts""",
)
def put_summary(spark, sf_dir):
    return produce.put_summary(outcomes(spark, sf_dir))


@query("merge_attempts", f"{OUTCOMES} SELECT event_id, attempt, invalid_reason, error_code FROM merged")
def merge_attempts(spark, sf_dir):
    merged = produce.merge_attempts(outcomes(spark, sf_dir))
    return merged.select("event_id", "attempt", "invalid_reason", "error_code")


@query(
    "error_messages",
    f"""{OUTCOMES}, counts AS (
          SELECT stream_name, put_id, count(invalid_reason) AS invalid, count(error_code) AS failed FROM merged GROUP BY ALL)
        SELECT stream_name, put_id, 0::BIGINT AS part_no, concat_ws('; ',
            CASE WHEN invalid > 0 THEN 'invalid records: ' || invalid::VARCHAR || ' (bad explicit hash key: ' || invalid::VARCHAR || ')' END,
            CASE WHEN failed > 0 THEN 'failed records: ' || failed::VARCHAR END) AS message
        FROM counts WHERE invalid + failed > 0
        UNION ALL
        SELECT stream_name, put_id, 1::BIGINT, string_agg(chr(10) || '  ' || error_code || ': slow down', ''
            ORDER BY shard_id, request_index) FROM merged WHERE error_code IS NOT NULL GROUP BY ALL""",
)
def error_messages(spark, sf_dir):
    return produce.error_messages(outcomes(spark, sf_dir))


@query(
    "put_requests",
    f"""{OUTCOMES} SELECT stream_name, put_id, attempt, batch_no, shard_id, count(*) AS n_records,
          CAST(sum(n_bytes) AS BIGINT) AS n_bytes, max(duration_s) AS duration_s FROM outcomes WHERE batch_no IS NOT NULL GROUP BY ALL""",
)
def put_requests(spark, sf_dir):
    return produce.requests(outcomes(spark, sf_dir))


# ---- retry policies -------------------------------------------------------------------------

BASE = 10_000_000


def retried(spark, sf_dir):
    """Every event as a failed record: up to 11 retries so far, up to 4 seconds waited."""
    return records(spark, sf_dir).select(
        "stream_name",
        "put_id",
        "event_id",
        F.expr("CAST(event_id % 12 AS INT)").alias("retries_so_far"),
        (F.col("event_id") % 5 * 1_000_000_000).alias("cumulative_ns"),
    )


_FIB = ", ".join(f"({n}, {f})" for n, f in enumerate([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144]))
_EXPONENTIAL = f"({BASE} * 2 ** tried.n)::BIGINT"


def _plan(name, policy, delay):
    @query(
        f"retry_plan_{name}",
        f"""WITH fib(n, f) AS (VALUES {_FIB}), tried AS (SELECT event_id, event_id % 12 AS n, event_id % 5 * 1000000000 AS waited FROM events),
            planned AS (SELECT event_id, tried.n, waited, CAST({delay} AS BIGINT) AS delay_ns FROM tried JOIN fib ON fib.n = tried.n)
            SELECT event_id, delay_ns, CASE WHEN delay_ns IS NULL THEN 'give_up' ELSE 'retry' END AS decision,
                   CAST(n + CASE WHEN delay_ns IS NULL THEN 0 ELSE 1 END AS INTEGER) AS next_retries,
                   CAST(waited + coalesce(delay_ns, 0) AS BIGINT) AS next_cumulative_ns FROM planned""",
    )
    def planned(spark, sf_dir):
        plan = plan_retries(retried(spark, sf_dir), policy())
        return plan.select("event_id", "delay_ns", "decision", "next_retries", "next_cumulative_ns")


_plan("always_give_up", Policy.always_give_up, "NULL")
_plan("constant_delay", lambda: Policy.constant_delay(BASE), f"{BASE}")
_plan("exponential_backoff", lambda: Policy.exponential_backoff(BASE), _EXPONENTIAL)
_plan("fibonacci_backoff", lambda: Policy.fibonacci_backoff(BASE), f"{BASE} * f")
_plan("limit_retries", lambda: Policy.limit_retries(5), "CASE WHEN tried.n < 5 THEN 0 END")
_plan("cap_delay", lambda: Policy.exponential_backoff(BASE).cap_delay(20 * BASE), f"least({_EXPONENTIAL}, {20 * BASE})")
_plan(
    "limit_by_delay",
    lambda: Policy.fibonacci_backoff(BASE).limit_by_delay(21 * BASE),
    f"CASE WHEN f <= 21 THEN {BASE} * f END",
)
_plan(
    "limit_by_cumulative_delay",
    lambda: Policy.fibonacci_backoff(BASE).limit_by_cumulative_delay(3_000_000_000),
    f"CASE WHEN waited + {BASE} * f < 3000000000 THEN {BASE} * f END",
)
_plan(
    "join",
    lambda: Policy.limit_retries(8).join(Policy.constant_delay(BASE)),
    f"CASE WHEN tried.n < 8 THEN {BASE} END",
)
_plan(
    "meet",
    lambda: Policy.limit_retries(4).meet(Policy.fibonacci_backoff(BASE)),
    f"CASE WHEN tried.n < 4 THEN 0 ELSE {BASE} * f END",
)
_plan(
    "followed_by",
    lambda: Policy.limit_retries(3).followed_by(Policy.constant_delay(BASE)),
    f"CASE WHEN tried.n < 3 THEN 0 ELSE {BASE} END",
)
_plan(
    "map_delay",
    lambda: Policy.limit_retries(6).join(Policy.fibonacci_backoff(BASE)).map_delay(lambda d: d + 1),
    f"CASE WHEN tried.n < 6 THEN {BASE} * f + 1 END",
)
_plan(
    "from_expr",
    lambda: Policy.from_expr(lambda retries, waited: F.when(waited < 2_000_000_000, waited + retries)),
    "CASE WHEN waited < 2000000000 THEN waited + tried.n END",
)


@query(
    "retry_plan_full_jitter",
    # the draws of one retry count must lie below the exponential delay and fill its range
    f"""SELECT event_id % 12 AS retries, least({BASE}::DOUBLE * 2 ** (event_id % 12), {LONGEST}::DOUBLE) AS ceiling, count(*) AS n,
               TRUE AS in_bounds, TRUE AS spread FROM events GROUP BY ALL""",
)
def full_jitter(spark, sf_dir):
    """By retry count: the exponential delay, whether all delays lie below it, and whether their mean is near its half."""
    ceiling = F.least(F.lit(float(BASE)) * F.pow(F.lit(2.0), F.col("retries")), F.lit(float(LONGEST))).alias("ceiling")
    policy = Policy.full_jitter(BASE, seed=7, by=("event_id",))
    drawn = plan_retries(retried(spark, sf_dir), policy).select(F.col("retries_so_far").cast("bigint").alias("retries"), "delay_ns")
    drawn = drawn.select("retries", ceiling, "delay_ns")
    part = F.col("delay_ns") / F.col("ceiling")
    sure = 3 / F.sqrt(12 * F.count("*"))  # three standard errors of a uniform mean, with a little room
    return drawn.groupBy("retries", "ceiling").agg(
        F.count("*").alias("n"), F.every((part >= 0) & (part < 1)).alias("in_bounds"), (F.abs(F.avg(part) - 0.5) <= sure + 0.01).alias("spread")
    )


# ---- the retry loop -------------------------------------------------------------------------


def fails_user_mod_4_times(entries):
    """A responder that refuses a key's records as many times as the user number mod 4 says."""
    failing = F.col("attempt") < F.col("partition_key").cast("int") % 4
    return entries.select(
        *produce.ENTRY,
        F.when(failing, THROTTLED).alias("error_code"),
        F.when(failing, F.lit("slow down")).alias("error_message"),
        F.lit(0.5).alias("duration_s"),
    )


@query(
    "put_until_done",
    f"""WITH {RECORDS}, {ranges_sql(FOUR)}, {LOOKUP},
        tries AS (SELECT * FROM (VALUES (0), (1), (2)) t(attempt)),
        entries AS (SELECT DISTINCT stream_name, put_id, attempt, shard_id, user_id % 4 AS refusals, partition_key
                    FROM routed, tries WHERE invalid_reason IS NULL AND user_id % 4 >= attempt),
        sent AS (SELECT stream_name, put_id, count(DISTINCT attempt) AS n_attempts, count(DISTINCT (attempt, shard_id)) AS n_successful,
                        count(*) FILTER (attempt = 2 AND refusals = 3) AS n_failed FROM entries GROUP BY ALL),
        bad AS (SELECT stream_name, put_id, count(*) AS n_invalid FROM checked WHERE invalid_reason IS NOT NULL GROUP BY ALL)
        SELECT stream_name, put_id, n_attempts, n_successful, coalesce(n_invalid, 0) AS n_invalid, n_failed,
               n_successful > 0 AS has_successful, coalesce(n_invalid, 0) + n_failed > 0 AS has_errors,
               coalesce(n_invalid, 0) + n_failed = 0 AS is_successful, coalesce(n_invalid, 0) + n_failed > 0 AS is_partially_successful
        FROM sent LEFT JOIN bad USING (stream_name, put_id)""".replace("FROM sized z", "FROM checked z"),
)
def until_done(spark, sf_dir):
    """Packed puts, refused up to three times, with two retries: one row per put."""
    shards = routing.shard_map(listing(spark, sf_dir, FOUR))
    done = put_until_done(
        records(spark, sf_dir).drop("event_id"), shards, Limits(), Policy.limit_retries(2), fails_user_mod_4_times
    )
    return produce.put_summary(done)


@query(
    "put_after_errors",
    f"""WITH {RECORDS}, {ranges_sql(FOUR)}, {LOOKUP},
        sent AS (SELECT DISTINCT stream_name, put_id, partition_key FROM routed WHERE invalid_reason IS NULL)
        SELECT attempt, CASE WHEN attempt < 2 THEN 'PutRaised' END AS error_code, count(*) AS n_entries, count(DISTINCT (stream_name, put_id)) AS n_puts
        FROM sent, (VALUES (0), (1), (2)) t(attempt) GROUP BY ALL
        UNION ALL SELECT 0, 'InvalidRecord', count(*), count(DISTINCT (stream_name, put_id)) FROM checked WHERE invalid_reason IS NOT NULL""".replace("FROM sized z", "FROM checked z"),
)
def after_errors(spark, sf_dir):
    """A put function that raises an error at attempts 0 and 1 and then lands all: outcomes by attempt."""
    shards = routing.shard_map(listing(spark, sf_dir, FOUR))
    calls = []

    def put_fn(entries):
        calls.append(len(calls))
        if len(calls) <= 2:
            raise ConnectionError("the service is not there")
        nothing = F.lit(None).cast("string")
        return entries.select(*produce.ENTRY, nothing.alias("error_code"), nothing.alias("error_message"), F.lit(0.5).alias("duration_s"))

    done = put_until_done(records(spark, sf_dir).drop("event_id"), shards, Limits(), Policy.constant_delay(0), put_fn)
    code = F.coalesce("error_code", F.when(F.col("invalid_reason").isNotNull(), "InvalidRecord"))
    return done.groupBy("attempt", code.alias("error_code")).agg(F.count("*").alias("n_entries"), F.count_distinct("stream_name", "put_id").alias("n_puts"))
