"""Live operators: errors and odd orders that the queries do not show."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shardstream.operators import consume
from shardstream.streaming.chunks import drain, group_within_event_time
from shardstream.streaming.ends import end_shards, shard_end_stream
from shardstream.streaming.metrics import outstanding_stream
from shardstream.streaming.process import keep_rates, known_states, read_checkpoints, read_rates, route_rates, write_batch

ONCE = {"availableNow": True}
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


class Feed:
    """A table that grows, read as a stream."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema
        self.add([])

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.path)


def run(sdf, path, mode="append"):
    writer = sdf.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/p").outputMode(mode)
    writer.trigger(**ONCE).start().awaitTermination(120)
    return sdf.sparkSession.read.schema(sdf.schema).parquet(f"{path}/out").collect()


POSITIONS = "stream_name string, shard_id string, sequence_number string, sub_sequence_number long, at timestamp"


def test_shard_ends_wait_time_out_and_complete(spark, tmp_path):
    records, commits = (Feed(spark, tmp_path / n, POSITIONS) for n in ("records", "commits"))
    ends = Feed(spark, tmp_path / "ends", "stream_name string, shard_id string, at timestamp")
    records.add([("s", "a", "9", None, at(0)), ("s", "a", "10", 3, at(1)), ("s", "b", "5", None, at(1)), ("s", "c", "7", None, at(1))])
    commits.add([("s", "a", "10", 2, at(2)), ("s", "c", "7", 0, at(2))])
    ends.add([("s", "a", at(3)), ("s", "b", at(3)), ("s", "c", at(3)), ("s", "empty", at(3))])

    def go(raise_on_timeout):
        statuses = shard_end_stream(records.stream(), commits.stream(), ends.stream(), 10 * 60_000)
        query = end_shards(statuses, str(tmp_path / "out"), str(tmp_path / "store"), str(tmp_path / "p"), raise_on_timeout, ONCE)
        query.awaitTermination(120)
        said = spark.read.parquet(str(tmp_path / "out")).groupBy("shard_id").agg(F.max(F.struct("step", "status"))).collect()
        return {r[0]: (r[1]["step"], r[1]["status"]) for r in said}

    assert go(True) == {"a": (1, "waiting"), "b": (1, "waiting"), "c": (1, "complete"), "empty": (1, "complete")}
    commits.add([("s", "a", "10", 3, at(9))])
    assert go(True)["a"] == (2, "complete")
    records.add([("t", "other", "1", None, at(60))])  # time goes on
    with pytest.raises(Exception, match="not committed in time: s/b"):
        go(True)
    assert {r.shard_id for r in read_checkpoints(spark, str(tmp_path / "store")).collect()} == {"a", "c"}
    assert go(False)["b"] == (2, "timed_out")  # the batch that was stopped runs again
    assert {(r.shard_id, r.sequence_number) for r in read_checkpoints(spark, str(tmp_path / "store")).collect()} == {("a", "10"), ("b", "5"), ("c", "7")}
    commits.add([("s", "b", "5", 0, at(61))])
    assert go(False)["b"] == (3, "complete")


def test_outstanding_across_batches(spark, tmp_path):
    schema = "stream_name string, id long, at timestamp"
    feeds = [Feed(spark, tmp_path / n, schema) for n in ("in", "done")]

    def go():
        return {r[0:4] for r in map(tuple, run(outstanding_stream(*[f.stream() for f in feeds], ["id"], "at", 600_000), tmp_path))}

    start = int(T0.timestamp() * 1000)
    feeds[0].add([("s", i, at(i)) for i in range(5)] + [("s", 50, at(1))])
    feeds[1].add([("s", 0, at(3)), ("s", 2, at(4)), ("s", 99, at(4)), ("s", 50, at(1))])
    assert go() == set()  # the tick is still under way
    feeds[1].add([("s", 1, at(11)), ("s", 1, at(11)), ("s", 3, at(21))])
    assert go() == {("s", start + 600_000, 3, 540_000), ("s", start + 1_200_000, 2, 1_200_000 - 180_000)}
    feeds[1].add([("s", 4, at(22))])
    feeds[0].add([("t", 7, at(60))])
    assert ("s", start + 1_800_000, 0, None) in go()


def test_event_time_chunks_over_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "k string, id long, at timestamp")
    closed = []
    for ids in (range(0, 7), range(7, 9), range(30, 31), range(90, 91)):
        feed.add([("k", i, at(i)) for i in reversed(ids)])
        closed = run(group_within_event_time(feed.stream(), 4, 10 * 60_000_000, ["k"], "at", ["id"], closes=True), tmp_path)
    rows = sorted((r.chunk_no, r.place_in_chunk, r.id) for r in closed if r.closed_by is None)
    assert rows == [(0, i, i) for i in range(4)] + [(1, i - 4, i) for i in range(4, 8)] + [(2, 0, 8), (3, 0, 30), (4, 0, 90)]
    assert sorted((r.chunk_no, r.place_in_chunk, r.closed_by, r.k) for r in closed if r.closed_by) == [
        (0, 4, "count", "k"), (1, 4, "count", "k"), (2, 1, "time", "k"), (3, 1, "time", "k")
    ]


def test_states_as_of_a_batch(spark, tmp_path):
    path, schema = str(tmp_path / "states"), "stream_name string, shard_id string, worker string, state string, ts timestamp"
    from shardstream.operators.checkpoints import latest_state

    for batch, state in enumerate(["Created", "Processing", "LeaseLost"]):
        write_batch(spark.createDataFrame([("s", "a", "w", state, at(batch))], schema), path, batch, latest_state)
    seen = [known_states(spark, path, b).first() for b in range(3)]
    assert [r.state for r in seen] == ["Created", "Processing", "LeaseLost"]


def test_rates_of_open_windows(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "stream_name string, shard_id string, n_bytes long, at timestamp")
    for minutes in ((0, 30), (50, 70), (100,)):
        feed.add([("s", "a", 2, at(m)) for m in minutes])
        keep_rates(route_rates(feed.stream(), "at", "1 hour", "1 hour"), str(tmp_path / "rates"), str(tmp_path / "p"), ONCE).awaitTermination(60)
    rates = read_rates(spark, str(tmp_path / "rates")).orderBy("window_start").collect()
    assert [(r.n_records, r.n_bytes) for r in rates] == [(3, 6), (2, 4)]


def test_a_late_consumer_is_told_twice(spark, tmp_path):
    feeds = [Feed(spark, tmp_path / n, "id long, data binary, at timestamp") for n in ("produced", "consumed")]
    feeds[0].add([(1, b"a", at(0)), (2, b"b", at(0)), (2, b"c", at(1)), (3, b"d", at(1))])
    feeds[1].add([(2, b"c", at(2)), (2, b"b", at(3)), (3, b"x", at(4))])
    compared = lambda: {(r.id, r.n_produced, r.n_consumed, r.status) for r in run(consume.reconcile_stream(*[f.stream() for f in feeds], ["id"], "at", "30 minutes"), tmp_path)}
    assert compared() == set()
    feeds[1].add([(1, b"a", at(100)), (9, b"z", at(400))])
    assert compared() == {(1, 1, 0, "lost"), (1, 0, 1, "foreign"), (2, 2, 2, "ok"), (3, 1, 1, "differs")}


def test_a_bounded_drain_leaves_the_rest(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in", "id long")
    for i in range(30):
        feed.add([(i,)])
    reader = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(feed.path)
    query = reader.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "p")).trigger(processingTime="500 milliseconds").start()
    assert drain(query, 1.0) is False and not query.isActive
    assert isinstance(pd.DataFrame(query.recentProgress), pd.DataFrame)
