import datetime as dt

import pytest
from pyspark.sql import functions as F

from shardstream import Limits, Position
from shardstream.functions.retry import Policy
from shardstream.operators import produce, routing
from shardstream.sources.record_log import read_record_log, write_record_log
from shardstream.streaming.chunks import drain, group_within_stream
from shardstream.streaming.process import commit_records, process_stream, read_checkpoints
from shardstream.streaming.put import put_stream, refreshing

ONCE = {"availableNow": True}


@pytest.fixture
def land(spark, tmp_path):
    path = str(tmp_path / "log")

    def write(start, stop):
        rows = [("s", f"shard-{i % 2}", str(i), None, dt.datetime(2024, 1, 1), bytearray(b"d%d" % i), f"k{i}", None, None) for i in range(start, stop)]
        df = spark.createDataFrame(
            rows,
            "stream_name string, shard_id string, sequence_number string, sub_sequence_number long, arrival timestamp_ntz,"
            " data binary, partition_key string, encryption_type string, explicit_hash_key string",
        )
        write_record_log(df, path)
        return path

    return write


def stops(spark, store):
    return sorted((r.shard_id, r.sequence_number) for r in read_checkpoints(spark, store).collect())


def test_commit_and_restart(spark, land, tmp_path):
    out, store, progress = (str(tmp_path / n) for n in ("out", "store", "progress"))

    def run():
        log = read_record_log(spark, land.path, Position.trim_horizon(), streaming=True)
        commit_records(log, out, store, progress, trigger=ONCE).awaitTermination(60)

    land.path = land(0, 8)
    run()
    assert stops(spark, store) == [("shard-0", "6"), ("shard-1", "7")]
    land(8, 13)
    run()
    assert stops(spark, store) == [("shard-0", "12"), ("shard-1", "11")]
    assert spark.read.parquet(out).count() == 13


def test_callback_then_commit(spark, land, tmp_path):
    seen = []
    log = read_record_log(spark, land(0, 6), streaming=True)
    fn = lambda batch: seen.extend(r.sequence_number for r in batch.collect())
    process_stream(log, fn, str(tmp_path / "p"), store=str(tmp_path / "s")).awaitTermination(60)
    assert sorted(seen) == [str(i) for i in range(6)]
    assert stops(spark, str(tmp_path / "s")) == [("shard-0", "4"), ("shard-1", "5")]


def test_error_stops_the_stream_and_commits_nothing(spark, land, tmp_path):
    def refuse(batch):
        raise ValueError("no")

    log = read_record_log(spark, land(0, 4), streaming=True)
    with pytest.raises(Exception, match="no"):
        process_stream(log, refuse, str(tmp_path / "p"), store=str(tmp_path / "s")).awaitTermination(60)
    assert not (tmp_path / "s").exists()
    process_stream(
        log, refuse, str(tmp_path / "q"), store=str(tmp_path / "s"), raise_on_error=False, quarantine=str(tmp_path / "aside")
    ).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "aside")).count() == 4
    assert not (tmp_path / "s").exists()


@pytest.mark.parametrize("call_on_empty", [True, False])
def test_empty_batches(spark, land, tmp_path, call_on_empty):
    calls = []
    log = read_record_log(spark, land(0, 4), streaming=True).filter("shard_id = 'none'")
    process_stream(log, lambda batch: calls.append(1), str(tmp_path / "p"), call_on_empty=call_on_empty).awaitTermination(60)
    assert bool(calls) is call_on_empty


def test_no_checkpoints_before_the_first_commit(spark, tmp_path):
    assert read_checkpoints(spark, str(tmp_path / "none")).count() == 0


def test_chunks_by_count_go_on_after_a_restart(spark, land, tmp_path):
    out = str(tmp_path / "o")

    def run(path):
        log = read_record_log(spark, path, streaming=True).select("stream_name", "shard_id", "sequence_number")
        chunked = group_within_stream(log, 10, 600_000, ["stream_name", "shard_id"])
        writer = chunked.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "p"))
        drain(writer.trigger(processingTime="100 milliseconds").start())
        rows = spark.read.parquet(out).groupBy("shard_id", "chunk_no").agg(F.count("*").alias("n"), F.max("place_in_chunk").alias("m"))
        return sorted((r.shard_id, r.chunk_no, r.n, r.m) for r in rows.collect())

    shards = ("shard-0", "shard-1")
    assert run(land(0, 50)) == [(s, c, *((10, 9) if c < 2 else (5, 4))) for s in shards for c in range(3)]
    assert run(land(50, 70)) == [(s, c, *((10, 9) if c < 3 else (5, 4))) for s in shards for c in range(4)]


def test_chunks_by_time(spark, land, tmp_path):
    """With no time to wait, what arrives later opens a new chunk."""
    out = str(tmp_path / "o")
    for start, stop in ((0, 4), (4, 8)):
        log = read_record_log(spark, land(start, stop), streaming=True).select("stream_name", "sequence_number")
        chunked = group_within_stream(log, 100, 1, ["stream_name"])
        writer = chunked.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "p"))
        drain(writer.trigger(processingTime="100 milliseconds").start())
    sizes = [r["count"] for r in spark.read.parquet(out).groupBy("chunk_no").count().orderBy("chunk_no").collect()]
    assert sum(sizes) == 8 and len(sizes) >= 2


def test_put_stream(spark, land, tmp_path):
    source = read_record_log(spark, land(0, 6), streaming=True).select(
        "stream_name",
        F.lit(0).cast("bigint").alias("put_id"),
        F.col("sequence_number").cast("int").alias("seq_in_put"),
        "data",
        "partition_key",
        "explicit_hash_key",
    )
    row = ("s", "all", 0, "0", str(2**128 - 1), None, dt.datetime(2024, 1, 1))
    listing = spark.createDataFrame(
        [row],
        "stream_name string, shard_id string, pos int, starting_hash_key string, ending_hash_key string,"
        " ending_sequence_number string, listed_at timestamp_ntz",
    )

    def accept(entries):
        null = F.lit(None)
        return entries.select(
            *produce.ENTRY, null.cast("string").alias("error_code"), null.cast("string").alias("error_message"), F.lit(0.1).alias("duration_s")
        )

    put_stream(
        source, lambda: routing.shard_map(listing), Limits(), accept, str(tmp_path / "o"), str(tmp_path / "p"), Policy.limit_retries(1), ONCE
    ).awaitTermination(90)
    done = spark.read.parquet(str(tmp_path / "o"))
    assert done.agg(F.sum("n_records")).first()[0] == 6
    assert [r.shard_id for r in done.select("shard_id").distinct().collect()] == ["all"]


def test_refresh_keeps_the_map_when_loading_fails():
    now, loads = [0.0], iter([1, 2, RuntimeError("down"), 4])

    def load():
        value = next(loads)
        if isinstance(value, Exception):
            raise value
        return value

    current = refreshing(load, ttl_s=10, clock=lambda: now[0])
    seen = []
    for t in (0, 5, 10, 21, 25, 32):
        now[0] = t
        seen.append(current())
    assert seen == [1, 1, 2, 2, 2, 4]


def test_empty_map_before_the_first_success():
    def down():
        raise RuntimeError("down")

    assert refreshing(down, empty="nothing")() == "nothing"
    with pytest.raises(RuntimeError):
        refreshing(down)()


def test_draining_an_empty_source_ends(spark, tmp_path):
    (tmp_path / "log").mkdir()
    log = read_record_log(spark, str(tmp_path / "log"), streaming=True).select("stream_name", "sequence_number")
    writer = group_within_stream(log, 10, 1, ["stream_name"]).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "p"))
    query = writer.trigger(processingTime="100 milliseconds").start()
    drain(query)
    assert not query.isActive


def test_the_store_is_put_together(spark, tmp_path, monkeypatch):
    from shardstream.streaming import process

    monkeypatch.setattr(process, "COMPACT_BATCHES", 3)
    store, schema = str(tmp_path / "store"), process.STORED
    for batch in [0, 1, 2, 3, 3, 4, 5, 6, 7]:
        rows = [("s", "a", str(batch), 0), ("s", f"b{batch}", "1", 0)]
        process.write_checkpoints(spark.createDataFrame(rows, schema), store, batch)
    assert process._folders(spark, store) == [6, 7]
    kept = {(r.shard_id, r.sequence_number) for r in read_checkpoints(spark, store).collect()}
    assert kept == {("a", "7"), *((f"b{i}", "1") for i in range(8))}


def test_tips_stay_what_they_were(spark, land, tmp_path):
    from shardstream.config import Position
    from shardstream.sources.record_log import from_position, shard_tips

    log = read_record_log(spark, land(0, 6))
    store = str(tmp_path / "tips")
    now, stored = shard_tips(log), shard_tips(log, store)
    later = read_record_log(spark, land(6, 10))
    assert from_position(later, Position.latest(), now).count() == from_position(later, Position.latest(), stored).count() > 0
    assert shard_tips(later, store).exceptAll(stored).isEmpty()


def test_scratch_goes_with_its_scope(spark):
    from shardstream.session import materialize, scratch_path, scratch_scope

    with scratch_scope(spark):
        outer = materialize(spark.range(3)).inputFiles()[0].removeprefix("file:")
        assert scratch_path(spark, "x").split("/")[-2].startswith("scope-")
    from pathlib import Path

    assert not Path(outer).exists() and not Path(outer).parent.parent.exists()
    assert not scratch_path(spark, "x").split("/")[-2].startswith("scope-")
