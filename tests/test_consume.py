import datetime as dt

import pytest
from pyspark.sql import functions as F

from shardstream import Position
from shardstream.functions.positions import order_by_position
from shardstream.operators import checkpoints as C
from shardstream.operators import consume
from shardstream.sources import catalog, lambda_events, record_log

DAY = dt.datetime(2024, 1, 1)


@pytest.fixture
def log(spark):
    def make(rows):
        full = [("s", shard, seq, sub, DAY + dt.timedelta(hours=i), bytearray(b"x"), "k", None, None) for i, (shard, seq, sub) in enumerate(rows)]
        schema = (
            "stream_name string, shard_id string, sequence_number string, sub_sequence_number long, arrival timestamp_ntz,"
            " data binary, partition_key string, encryption_type string, explicit_hash_key string"
        )
        return spark.createDataFrame(full, schema)

    return make


def at(df):
    return sorted((r.shard_id, r.sequence_number, r.sub_sequence_number) for r in df.collect())


def test_sequence_numbers_of_different_width(log):
    df = log([("a", "9", None), ("a", "10", None), ("b", "10", 3), ("b", "10", 12)])
    assert at(C.checkpoints(df)) == [("a", "10", 0), ("b", "10", 12)]
    assert [r.sequence_number for r in order_by_position(df).collect()] == ["9", "10", "10", "10"]


def test_no_records_no_checkpoint(log):
    assert C.checkpoints(log([("a", "1", None)]).limit(0)).count() == 0


def test_checkpoints_never_move_back(log):
    old, new = C.checkpoints(log([("a", "12", 5), ("b", "7", None)])), C.checkpoints(log([("a", "12", 2), ("b", "11", None), ("c", "1", None)]))
    assert at(C.merge_checkpoints(old, new)) == [("a", "12", 5), ("b", "11", 0), ("c", "1", 0)]


def test_resume_is_strictly_after_the_checkpoint(log):
    df = log([("a", "9", None), ("a", "10", 0), ("a", "10", 1), ("b", "1", None)])
    stored = C.checkpoints(log([("a", "10", 0)]))
    assert at(C.after_checkpoint(df, stored)) == [("a", "10", 1), ("b", "1", None)]


def test_only_the_newest_record_is_last(spark, log):
    df = log([("a", "9", None), ("a", "10", None), ("b", "1", None)])
    ended = spark.createDataFrame([("s", "a")], "stream_name string, shard_id string")
    marked = C.mark_last_in_shard(df, ended)
    assert at(marked.filter("is_last_in_shard")) == [("a", "10", None)]
    kept = {r.shard_id: r.is_last_in_shard for r in C.checkpoints(marked).collect()}
    assert kept == {"a": True, "b": False}


def test_gate(spark, log):
    df = log([("a", "1", None), ("b", "1", None), ("c", "1", None), ("d", "1", None)])
    states = spark.createDataFrame(
        [("s", "a", "Processing"), ("s", "b", "ShardEnded"), ("s", "c", "LeaseLost")], "stream_name string, shard_id string, state string"
    )
    assert [x[0] for x in at(C.gated_checkpoints(df, states))] == ["a", "b"]


def test_shard_end(spark, log):
    df = log([("a", "1", None), ("a", "2", None), ("b", "1", None), ("c", "5", None)])
    stored = C.checkpoints(log([("a", "2", None), ("b", "0", None)]))
    ended = spark.createDataFrame(
        [("s", "a", DAY), ("s", "b", DAY), ("s", "c", DAY + dt.timedelta(days=2)), ("s", "empty", DAY)],
        "stream_name string, shard_id string, ended_at timestamp_ntz",
    )
    now = F.lit(DAY + dt.timedelta(days=2)).cast("timestamp_ntz")
    status = {r.shard_id: r.status for r in C.shard_end_status(df, stored, ended, 3600 * 10**6, now).collect()}
    assert status == {"a": "complete", "b": "timed_out", "c": "waiting", "empty": "complete"}
    forever = {r.shard_id: r.status for r in C.shard_end_status(df, stored, ended, None, now).collect()}
    assert forever["b"] == "waiting"


def test_positions(log):
    df = log([("a", str(i), None) for i in range(5)])
    later = Position.at_timestamp(DAY + dt.timedelta(hours=3))
    assert record_log.from_position(df, later).count() == 2
    tips = record_log.shard_tips(df.filter("sequence_number < '3'"))
    assert record_log.from_position(df, Position.latest(), tips).count() == 2
    assert record_log.from_position(df, Position.trim_horizon()).count() == 5
    with pytest.raises(ValueError):
        record_log.from_position(df, Position.latest())


def test_two_streams_from_one_log(spark, log, tmp_path):
    df = log([("a", str(i), None) for i in range(5)])
    both = df.unionByName(df.withColumn("stream_name", F.lit("t"))).unionByName(df.withColumn("stream_name", F.lit("u")))
    record_log.write_record_log(both, str(tmp_path))
    read = record_log.read_many(spark, str(tmp_path), {"s": Position.trim_horizon(), "t": Position.trim_horizon()})
    assert read.count() == 10
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "stream_name" in plan.split("PartitionFilters: [")[1].split("]")[0]
    mixed = record_log.read_many(spark, str(tmp_path), {"s": Position.at_timestamp(DAY + dt.timedelta(hours=4)), "t": Position.trim_horizon()})
    assert mixed.count() == 6


def test_former_checkpoints(spark):
    stored = spark.createDataFrame([("old", "a", DAY), ("new", "a", DAY)], "stream_name string, shard_id string, updated timestamp_ntz")
    streams = spark.createDataFrame([("new",)], "stream_name string")
    find = lambda mode, hours: [r.stream_name for r in consume.former_checkpoints(stored, streams, mode, 3600 * 10**6, F.lit(DAY + dt.timedelta(hours=hours)).cast("timestamp_ntz")).collect()]
    assert (find("none", 5), find("detect", 5), find("provided", 5), find("detect", 0)) == ([], ["old"], ["new"], [])


def test_reconcile(spark):
    frame = lambda rows: spark.createDataFrame([(k, bytearray(d)) for k, d in rows], "k string, data binary")
    produced = frame([("same", b"1"), ("lost", b"1"), ("twice", b"1"), ("changed", b"1"), ("pair", b"1"), ("pair", b"2")])
    got = frame([("same", b"1"), ("twice", b"1"), ("twice", b"1"), ("changed", b"2"), ("foreign", b"1"), ("pair", b"2"), ("pair", b"2")])
    status = {r.k: r.status for r in consume.reconcile(produced, got, ["k"]).collect()}
    assert status == {"same": "ok", "lost": "lost", "twice": "duplicated", "changed": "differs", "foreign": "foreign", "pair": "differs"}


def test_lag(log):
    df = log([("a", "1", None), ("a", "2", None), ("b", "3", None)])
    stored = C.checkpoints(log([("a", "1", None)]).unionByName(log([("b", "3", None)])))
    rows = {r.shard_id: (r.n_behind, r.millis_behind_latest) for r in consume.consumer_lag(df, stored, F.lit(DAY + dt.timedelta(hours=5)).cast("timestamp_ntz")).collect()}
    assert rows == {"a": (1, 5 * 3600 * 1000), "b": (0, 0)}


EVENT = (
    '{"Records":[{"awsRegion":"us-east-1","eventID":"shardId-000000000000:1","eventName":"aws:kinesis:record",'
    '"eventSource":"aws:kinesis","eventSourceARN":"arn:aws:kinesis:us-east-1:123456789012:stream/s","eventVersion":"1.0",'
    '"invokeIdentityArn":"arn:aws:iam::123456789012:role/r","kinesis":{"approximateArrivalTimestamp":1723739794.987,'
    '"data":"SGVsbG8sIHRoaXMgaXMgYSB0ZXN0Lg==","kinesisSchemaVersion":"1.0","partitionKey":"1",'
    '"sequenceNumber":"49590338271490256608559692538361571095921575989136588898"}}]}'
)


def test_event_round_trip(spark):
    df = spark.createDataFrame([("e", EVENT)], "name string, event string")
    row = lambda_events.read_lambda_events(df).first()
    assert bytes(row.data) == b"Hello, this is a test."
    assert row.arrival == dt.datetime(2024, 8, 15, 16, 36, 34, 987000)
    assert row.encryption_type is None and row.sub_sequence_number is None
    assert row.sequence_number == "49590338271490256608559692538361571095921575989136588898"
    read = lambda_events.read_lambda_events(df).withColumn("ms", F.unix_millis("arrival"))
    written = lambda_events.to_lambda_events(read, ["name"], ["record_index"], "ms")
    again = lambda_events.read_lambda_events(written.drop("event_no")).first()
    assert again == row


@pytest.mark.parametrize(
    "old, new",
    [
        ('"partitionKey":"1",', ""),
        ('"data":"SGV', '"data":"%SGV'),
        ('"partitionKey":"1"', '"partitionKey":"1","encryptionType":"ROT13"'),
        ('{"Records"', '{"records"'),
        ("}}]}", ""),
    ],
)
def test_malformed_events(spark, old, new):
    df = spark.createDataFrame([("bad", EVENT.replace(old, new)), ("good", EVENT)], "name string, event string")
    assert [r.name for r in lambda_events.malformed_events(df).collect()] == ["bad"]
    assert [r.name for r in lambda_events.read_lambda_events(df, on_error="skip").collect()] == ["good"]
    with pytest.raises(Exception, match="malformed event"):
        lambda_events.read_lambda_events(df).collect()


def test_events_are_cut_in_order(spark):
    read = lambda_events.read_lambda_events(spark.createDataFrame([(str(i), EVENT) for i in range(7)], "name string, event string"))
    one = read.withColumns({"all": F.lit(1), "ms": F.lit(1000), "partition_key": F.col("name")})
    events = lambda_events.to_lambda_events(one, ["all"], ["name"], "ms", records_per_event=3)
    keys = [[r["kinesis"]["partitionKey"] for r in __import__("json").loads(e.event)["Records"]] for e in events.orderBy("event_no").collect()]
    assert keys == [["0", "1", "2"], ["3", "4", "5"], ["6"]]


def test_arns(spark):
    good = "arn:aws:kinesis:us-east-1:123456789012:stream/s"
    rows = [good, "arn:aws:kinesis:mars:1:stream/s", "arn:aws:kinesis:us-east-1:1:stream", "x/y", "arn:aws-iso-b:kinesis:us-isob-east-1:9:stream/t"]
    parsed = catalog.parse_stream_arns(spark.createDataFrame([(r,) for r in rows], "stream_arn string")).collect()
    assert [p.stream_name for p in parsed] == ["s", None, None, None, "t"]
    assert [bool(p.arn_error) for p in parsed] == [False, True, True, True, False]
    df = spark.createDataFrame([(good + "/consumer/c:1700000000",), (good + "/consumer/c:soon",)], "consumer_arn string")
    first, second = catalog.parse_consumer_arns(df).collect()
    assert (first.stream_name, first.consumer_name, first.created_s) == ("s", "c", 1_700_000_000)
    assert second.arn_error == "creation time is no number"
    assert catalog.format_consumer_arns(catalog.parse_consumer_arns(df.limit(1)), "text").first().text == good + "/consumer/c:1700000000"
    assert sum(len(r) for r in catalog.REGIONS.values()) == 28
