import datetime as dt

import pytest
from pyspark.sql import functions as F

from shardstream.operators import routing

TOP = 1 << 128


@pytest.fixture
def listing(spark):
    def make(ranges, listed_at=dt.datetime(2024, 1, 1), ok=True, closed=()):
        rows = [("s", n, i, str(lo), str(hi), "5" if n in closed else None, listed_at, ok) for i, (n, lo, hi) in enumerate(ranges)]
        return spark.createDataFrame(
            rows,
            "stream_name string, shard_id string, pos int, starting_hash_key string, ending_hash_key string,"
            " ending_sequence_number string, listed_at timestamp_ntz, ok boolean",
        )

    return make


def route(spark, shards, keys):
    df = spark.createDataFrame([("s", k) for k in keys], "stream_name string, partition_key string")
    return {r.partition_key: r.shard_id for r in routing.predict_shard(df, shards).collect()}


def expected(ranges, keys):
    import hashlib

    found = {}
    for k in keys:
        h = int.from_bytes(hashlib.md5(k.encode()).digest(), "big")
        found[k] = next((n for n, lo, hi in ranges if lo <= h <= hi), "DEFAULT")
    return found


KEYS = [str(i) for i in range(400)]


@pytest.mark.parametrize(
    "ranges",
    [
        [("a", 0, TOP - 1)],
        [("a", 0, TOP // 2 - 1), ("b", TOP // 2, TOP - 1)],
        [("a", 0, TOP // 3), ("b", TOP // 2, TOP - 1)],
        [("b", TOP // 4, TOP // 2), ("a", 0, TOP - 1), ("c", TOP // 3, 3 * TOP // 4)],
        [("wide", TOP // 8, TOP // 2), ("a", 0, TOP // 3), ("b", TOP // 4, TOP - 2)],
        [("empty", TOP - 1, 0)],
    ],
)
def test_first_listed_shard_wins_and_misses_are_default(spark, listing, ranges):
    assert route(spark, routing.shard_map(listing(ranges)), KEYS) == expected(ranges, KEYS)


def test_bounds_are_inclusive(spark, listing):
    h = 229609063533823256041787889330700985560
    for ranges, shard in [([("a", h, h)], "a"), ([("a", 0, h - 1), ("b", h + 1, TOP - 1)], "DEFAULT"), ([("a", 0, h), ("b", h + 1, TOP - 1)], "a")]:
        assert route(spark, routing.shard_map(listing(ranges)), ["foo"]) == {"foo": shard}


def test_hex_bounds(spark, listing):
    numbers = [0, 1, 2**64 - 1, 2**64, 2**64 + 1, 10**38 - 1, 10**38, 10**26, 10**13, TOP - 1, TOP // 3]
    rows = routing.shard_map(listing([(str(i), n, n) for i, n in enumerate(numbers)])).orderBy("pos").collect()
    assert [r.lo_hex for r in rows] == [f"{n:032x}" for n in numbers]
    assert [r.lo_dec for r in rows] == [f"{n:039d}" for n in numbers]


def test_closed_shards_are_left_out(listing):
    shards = routing.shard_map(listing([("a", 0, 5), ("b", 6, 9)], closed=("a",)))
    assert [r.shard_id for r in shards.collect()] == ["b"]


def test_refresh_keeps_the_last_good_map(listing):
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    history = listing([("a", 0, TOP - 1)], day(1)).unionByName(listing([("b", 0, TOP - 1)], day(2), ok=False))
    history = history.unionByName(listing([("c", 0, TOP - 1)], day(3)))
    as_of = lambda t: [(r.shard_id, r.stale) for r in routing.shard_map_as_of(history, F.lit(t).cast("timestamp_ntz")).collect()]
    assert as_of(dt.datetime(2023, 12, 31)) == []
    assert as_of(day(1)) == [("a", False)]
    assert as_of(day(2, 5)) == [("a", True)]
    assert as_of(day(3)) == [("c", False)]


def test_routing_needs_no_shuffle_of_the_records(spark, listing, tmp_path):
    spark.range(1000).select(F.lit("s").alias("stream_name"), F.col("id").cast("string").alias("partition_key"), F.lit(0).alias("unused")).write.parquet(str(tmp_path / "r"))
    df = spark.read.parquet(str(tmp_path / "r"))
    shards = routing.shard_map(listing([("a", 0, TOP // 2 - 1), ("b", TOP // 2, TOP - 1)]))
    routed = routing.predict_shard(df, shards).select("partition_key", "shard_id")
    routed.collect()
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    assert "Exchange hashpartitioning" not in plan
    assert "unused" not in plan


def test_report(spark, listing):
    df = spark.createDataFrame([("s", k, 1) for k in KEYS], "stream_name string, partition_key string, n_bytes int")
    report = routing.routing_report(routing.predict_shard(df, routing.shard_map(listing([("a", 0, TOP // 2)]))))
    rows = {r.shard_id: r for r in report.collect()}
    assert rows["DEFAULT"].missed and not rows["a"].missed
    assert rows["a"].share + rows["DEFAULT"].share == pytest.approx(1)


def test_map_supplier_and_lookup_table(spark, listing):
    shards = routing.shard_map(listing([("a", 0, TOP - 1)]))
    assert route(spark, lambda: shards, ["x"]) == {"x": "a"}
    lookup = routing.lookup_table(shards)
    assert lookup.digits == 1
    assert route(spark, lookup, ["x"]) == {"x": "a"}


def test_many_shards_use_more_buckets(spark, listing):
    ranges = [(f"n{i}", (i << 128) // 300, ((i + 1) << 128) // 300 - 1) for i in range(300)]
    lookup = routing.lookup_table(routing.shard_map(listing(ranges)))
    assert lookup.digits == 3
    assert route(spark, lookup, KEYS) == expected(ranges, KEYS)
