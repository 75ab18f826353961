import datetime as dt

import pytest
from pyspark.sql import functions as F

from shardstream import Limits
from shardstream.functions.retry import LONGEST, Policy, plan_retries
from shardstream.operators import produce
from shardstream.operators.packing import unpack_records
from shardstream.plans.put import PutFailed, put, put_until_done
from shardstream.sources.record_log import landing_put_fn, read_record_log

THROTTLED = "ProvisionedThroughputExceededException"
PLAIN = Limits(aggregate=False)


@pytest.fixture
def no_shards(spark):
    """An empty range, so that every key misses."""
    row = ("s", "1", 0, f"{100:032x}", f"{1:032x}", "100".zfill(39), "1".zfill(39), dt.datetime(2024, 1, 1))
    schema = "stream_name string, shard_id string, pos int, lo_hex string, hi_hex string, lo_dec string, hi_dec string, last_updated timestamp"
    return spark.createDataFrame([row], schema)


def accept_first(entries):
    """Only the first record of each request succeeds."""
    failing = F.col("request_index") > 0
    return entries.select(
        *produce.ENTRY,
        F.when(failing, THROTTLED).alias("error_code"),
        F.when(failing, "slow down").alias("error_message"),
        F.lit(0.1).alias("duration_s"),
    )


def refuse_packs_once(entries):
    failing = F.col("attempt") == 0
    return accept_first(entries).withColumns(
        {"error_code": F.when(failing, THROTTLED), "error_message": F.when(failing, "slow down")}
    )


def five(records):
    return records([(0, i, str(i + 1), b"x" * 50) for i in range(5)])


def test_five_attempts_land_five_records(records, no_shards):
    done = put_until_done(five(records), no_shards, PLAIN, Policy.limit_retries(5), accept_first)
    by_attempt = {r.attempt: r["count"] for r in done.groupBy("attempt").count().collect()}
    assert by_attempt == {0: 5, 1: 4, 2: 3, 3: 2, 4: 1}
    assert {r.shard_id for r in done.select("shard_id").distinct().collect()} == {"DEFAULT"}
    summary = produce.put_summary(done).first()
    assert (summary.n_attempts, summary.n_successful, summary.n_failed) == (5, 5, 0)
    assert summary.is_successful and not summary.has_errors
    landed = done.filter("error_code IS NULL").orderBy("attempt").collect()
    assert [r.seq_in_put for r in landed] == [0, 1, 2, 3, 4]


def test_giving_up_reports_the_last_failures_once(records, no_shards):
    done = put_until_done(five(records), no_shards, PLAIN, Policy.always_give_up(), accept_first)
    summary = produce.put_summary(done).first()
    assert (summary.n_attempts, summary.n_successful, summary.n_failed) == (1, 1, 4)
    assert summary.is_partially_successful
    assert produce.error_counts(done).first().n_errors == 4
    with pytest.raises(PutFailed):
        put_until_done(five(records), no_shards, PLAIN, Policy.limit_retries(2), accept_first, raise_on_failures=True)


def test_packed_records_are_sent_again_as_they_are(records, no_shards):
    rows = records([(0, 0, "1", b"record 1"), (0, 1, "2", b"record 2")])
    done = put_until_done(rows, no_shards, Limits(), Policy.limit_retries(5), refuse_packs_once)
    sizes = {(r.attempt, r.n_bytes) for r in done.collect()}
    assert {a for a, _ in sizes} == {0, 1}
    assert {s for a, s in sizes if a == 0} == {s for a, s in sizes if a == 1}


def test_invalid_records_are_not_retried(records, no_shards):
    rows = records([(0, i, "", b"x") for i in range(3)])
    done = put_until_done(rows, no_shards, PLAIN, Policy.limit_retries(5), accept_first)
    assert [r.invalid_reason for r in done.collect()] == ["InvalidPartitionKey"] * 3
    assert produce.put_summary(done).first().n_attempts == 1
    with pytest.raises(PutFailed):
        put_until_done(rows, no_shards, PLAIN, Policy.limit_retries(5), accept_first, raise_on_failures=True)


def test_messages(records, no_shards):
    rows = records([(0, 0, "a", b"x"), (0, 1, "b", b"x"), (0, 2, "", b"x"), (0, 3, "c", b"x", "zzz")])
    parts = produce.error_messages(put(rows, no_shards, PLAIN, accept_first)).orderBy("part_no").collect()
    whole = "".join(p.message for p in parts)
    assert whole == (
        "invalid records: 2 (bad partition key: 1, bad explicit hash key: 1); failed records: 1"
        f"\n  {THROTTLED}: slow down"
    )


def test_put_to_a_log_and_read_back(spark, records, no_shards, tmp_path):
    rows = [(0, i, "k" + str(i % 3), bytes([i])) for i in range(20)]
    put_fn = landing_put_fn(str(tmp_path / "log"), dt.datetime(2024, 1, 1))
    done = put(records(rows), no_shards, Limits(), put_fn)
    assert done.filter("error_code IS NOT NULL").count() == 0
    opened = unpack_records(read_record_log(spark, str(tmp_path / "log")))
    assert sorted((r.partition_key, bytes(r.data)) for r in opened.collect()) == sorted((k, d) for _, _, k, d in rows)


def delays(spark, policy, retries, waited=0):
    df = spark.createDataFrame([("s", 0, r, waited) for r in retries], "stream_name string, put_id long, retries_so_far int, cumulative_ns long")
    return [r.delay_ns for r in plan_retries(df, policy).orderBy("retries_so_far").collect()]


def test_backoff_saturates(spark):
    assert delays(spark, Policy.exponential_backoff(3), [0, 1, 10, 61, 62, 63, 500]) == [3, 6, 3072, 3 << 61, LONGEST, LONGEST, LONGEST]
    assert delays(spark, Policy.exponential_backoff(0), [0, 70]) == [0, 0]
    assert delays(spark, Policy.fibonacci_backoff(10), [0, 1, 2, 3, 4, 5, 200]) == [10, 10, 20, 30, 50, 80, LONGEST]
    assert delays(spark, Policy.fibonacci_backoff(1), [90, 91, 92])[:2] == [4660046610375530309, 7540113804746346429]


def test_limits_and_combinators(spark):
    give_up, five = Policy.always_give_up(), Policy.constant_delay(5)
    three = [0, 1, 2]
    assert delays(spark, Policy.limit_retries(2), three) == [0, 0, None]
    assert delays(spark, five.join(Policy.limit_retries(1)), three) == [5, None, None]
    assert delays(spark, give_up.meet(five), three) == [5, 5, 5]
    assert delays(spark, Policy.limit_retries(1).followed_by(five), three) == [0, 5, 5]
    assert delays(spark, five.map_delay(lambda d: d * 2), three) == [10, 10, 10]
    assert delays(spark, give_up.cap_delay(7), three) == [7, 7, 7]
    assert delays(spark, Policy.exponential_backoff(4).limit_by_delay(8), three) == [4, 8, None]
    assert delays(spark, five.limit_by_cumulative_delay(10), [0], waited=4) == [5]
    assert delays(spark, five.limit_by_cumulative_delay(10), [0], waited=5) == [None]
    assert delays(spark, five.limit_by_cumulative_delay(10), [0], waited=LONGEST) == [None]


def test_jitter_is_one_draw_per_put(spark):
    rows = [("s", p, r, 0) for p in range(200) for r in (3, 3)]
    df = spark.createDataFrame(rows, "stream_name string, put_id long, retries_so_far int, cumulative_ns long")
    drawn = plan_retries(df, Policy.full_jitter(1000)).groupBy("put_id").agg(F.min("delay_ns").alias("a"), F.max("delay_ns").alias("b"))
    rows = drawn.collect()
    assert all(r.a == r.b and 0 <= r.a < 8000 for r in rows)
    assert len({r.a for r in rows}) > 100


def test_sleeps_for_the_longest_delay(records, no_shards):
    slept = []
    put_until_done(five(records), no_shards, PLAIN, Policy.constant_delay(2_000_000_000).join(Policy.limit_retries(3)), accept_first, sleep=slept.append)
    assert slept == [2.0, 2.0, 2.0][: len(slept)] and len(slept) >= 2


@pytest.mark.parametrize("late", [False, True])
def test_errors_of_the_put_function_are_retried(records, no_shards, late):
    calls = []

    def put_fn(entries):
        calls.append(1)
        if len(calls) > 2:
            return accept_first(entries)
        if not late:
            raise ConnectionError("not there")
        return accept_first(entries).withColumn("duration_s", F.raise_error(F.lit("not there")).cast("double"))

    done = put_until_done(five(records), no_shards, PLAIN, Policy.constant_delay(0), put_fn)
    by_attempt = {r.attempt: r["count"] for r in done.groupBy("attempt").count().collect()}
    assert by_attempt == {0: 5, 1: 5, 2: 5, 3: 4, 4: 3, 5: 2, 6: 1}
    raised = done.filter("error_code = 'PutRaised'").groupBy("attempt").count().collect()
    assert sorted((r.attempt, r["count"]) for r in raised) == [(0, 5), (1, 5)]
    assert done.filter("error_code = 'PutRaised' AND error_message LIKE '%not there%'").count() == 10


def test_errors_end_with_the_policy(records, no_shards):
    def put_fn(entries):
        raise ConnectionError("not there")

    done = put_until_done(five(records), no_shards, PLAIN, Policy.limit_retries(1), put_fn)
    assert sorted(r.attempt for r in done.collect()) == [0] * 5 + [1] * 5
    with pytest.raises(PutFailed):
        put_until_done(five(records), no_shards, PLAIN, Policy.always_give_up(), put_fn, raise_on_failures=True)
    with pytest.raises(ConnectionError):
        put(five(records), no_shards, PLAIN, put_fn)


def test_no_delay_stays_no_delay(spark):
    assert delays(spark, Policy.fibonacci_backoff(0), [0, 91, 92, 500]) == [0] * 4
