"""The log's manifest: commits that land once, files skipped, starts; puts that land once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shardstream import Limits, Position
from shardstream.functions.retry import Policy
from shardstream.operators.checkpoints import checkpoints
from shardstream.plans.put import PUT_RAISED, put_until_done
from shardstream.sources import manifest, record_log, starts
from shardstream.streaming.process import process_stream, read_checkpoints

SCHEMA = (
    "stream_name string, shard_id string, sequence_number string, sub_sequence_number long, arrival timestamp_ntz,"
    " data binary, partition_key string, encryption_type string, explicit_hash_key string"
)


def rows(spark, numbers, stream="s", shards=2):
    made = [
        (stream, f"shard-{i % shards}", str(i), None, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), bytearray(b"d%d" % i), f"k{i}", None, None) for i in numbers
    ]
    return spark.createDataFrame(made, SCHEMA)


def numbers(df):
    return sorted(int(r.sequence_number) for r in df.select("sequence_number").collect())


def test_a_commit_lands_once(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):
        record_log.write_record_log(rows(spark, range(5)), path, commit="one")
    record_log.write_record_log(rows(spark, range(5, 7)), path, commit="two")
    assert numbers(record_log.read_record_log(spark, path)) == list(range(7))
    assert manifest.read_manifest(spark, path).agg(F.sum("n_records")).first()[0] == 7
    with pytest.raises(ValueError, match="named"):
        record_log.write_record_log(rows(spark, range(2)), path, commit="a/b")


def test_what_is_staged_is_not_there(spark, tmp_path):
    path = str(tmp_path / "log")
    record_log.write_record_log(rows(spark, range(3)), path)
    record_log.stage_records(rows(spark, range(3, 9)), path, "given-up")
    assert numbers(record_log.read_record_log(spark, path)) == list(range(3))
    assert manifest.read_manifest(spark, path).agg(F.sum("n_records")).first()[0] == 3
    record_log.write_record_log(rows(spark, range(3, 5)), path, commit="given-up")  # run again, with other rows
    assert numbers(record_log.read_record_log(spark, path)) == list(range(5))


def test_a_decided_commit_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")

    def crash(*_):
        raise OSError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(manifest, "_move", crash)
        with pytest.raises(OSError):
            record_log.write_record_log(rows(spark, range(4)), path, commit="one")
    assert manifest.committed(spark, path, "one")
    assert manifest.read_manifest(spark, path).agg(F.sum("n_records")).first()[0] == 4
    assert numbers(record_log.read_record_log(spark, path)) == list(range(4))
    record_log.write_record_log(rows(spark, range(4)), path, commit="one")
    assert numbers(record_log.read_record_log(spark, path)) == list(range(4))


def test_odd_stream_names(spark, tmp_path):
    path, names = str(tmp_path / "a log"), ["a b", "x+y", "50%", "é=ü", "q?#", None]
    for i, name in enumerate(names):
        record_log.write_record_log(rows(spark, range(10 * i, 10 * i + 3), name), path)
    files = [f"{path}/{r.file}" for r in manifest.read_manifest(spark, path).select("file").distinct().collect()]
    assert numbers(manifest.read_files(spark, path, files, record_log.CONSUMER_RECORD)) == [10 * i + j for i in range(6) for j in range(3)]
    held = {r.stream_name for r in manifest.read_files(spark, path, files, record_log.CONSUMER_RECORD).collect()}
    assert held == set(names)


def test_the_manifest_is_put_together(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    monkeypatch.setattr(manifest, "COMPACT_COMMITS", 3)
    monkeypatch.setattr(manifest.compact, "__defaults__", (3,))
    for i in range(6):
        record_log.write_record_log(rows(spark, range(10 * i, 10 * i + 2)), path, commit=f"c{i}")
    assert len(manifest._names(spark, f"{path}/_manifest")) < 6
    assert manifest.read_manifest(spark, path).agg(F.sum("n_records")).first()[0] == 12
    record_log.write_record_log(rows(spark, range(2)), path, commit="c0")
    assert len(numbers(record_log.read_record_log(spark, path))) == 12


def test_resume_reads_only_files_past_the_checkpoints(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in range(5):
        record_log.write_record_log(rows(spark, range(100 * i, 100 * i + 100)), path)
    log = record_log.read_record_log(spark, path)
    plan = starts.plan_starts(spark.createDataFrame([], starts.START), checkpoints(log.filter("CAST(sequence_number AS INT) < 330")))
    read = manifest.needed_files(spark, path, plan)
    assert 0 < len(read) <= manifest.read_manifest(spark, path).select("file").distinct().count() * 2 // 5
    assert numbers(starts.read_from_starts(spark, path, plan, Position.trim_horizon())) == list(range(330, 500))
    at = Position.at_timestamp(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=450))
    first = starts.initial_starts(manifest.log_tips(spark, path), at)
    assert numbers(starts.read_from_starts(spark, path, first, at)) == list(range(450, 500))
    done = starts.initial_starts(manifest.log_tips(spark, path), Position.latest())
    assert manifest.needed_files(spark, path, done) == [] and numbers(starts.read_from_starts(spark, path, done, Position.latest())) == []


def test_an_empty_log(spark, tmp_path):
    path = str(tmp_path / "log")
    record_log.write_record_log(rows(spark, range(3)).limit(0), path)
    assert manifest.read_manifest(spark, path).count() == manifest.log_tips(spark, path).count() == 0
    nothing = spark.createDataFrame([], starts.START)
    assert starts.read_from_starts(spark, path, nothing, Position.latest()).count() == 0


def test_starts_are_captured_once(spark, tmp_path):
    path, store = str(tmp_path / "log"), str(tmp_path / "starts")
    record_log.write_record_log(rows(spark, range(4)), path)
    first = starts.captured_starts(spark, path, Position.latest(), store)
    record_log.write_record_log(rows(spark, range(4, 10), shards=3), path)
    again = starts.captured_starts(spark, path, Position.latest(), store)
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()
    log = record_log.read_record_log(spark, path)
    # shard 2 was not there when the starts were captured: all of it
    assert numbers(starts.from_starts(log, again, Position.latest())) == [4, 5, 6, 7, 8, 9]
    (tmp_path / "starts" / "_SUCCESS").unlink()  # as a crash leaves it
    assert starts.captured_starts(spark, path, Position.latest(), store).count() == 3


def test_stores_after_a_crash(spark, tmp_path):
    (tmp_path / "store" / "batch=0" / "_temporary").mkdir(parents=True)
    assert read_checkpoints(spark, str(tmp_path / "store")).count() == 0
    (tmp_path / "tips" / "_temporary").mkdir(parents=True)
    assert record_log.shard_tips(rows(spark, range(4)), str(tmp_path / "tips")).count() == 2


def test_a_failed_commit_is_no_failed_batch(spark, tmp_path, monkeypatch):
    from shardstream.streaming import process

    path, aside = str(tmp_path / "log"), tmp_path / "aside"
    record_log.write_record_log(rows(spark, range(4)), path)

    def down(*_):
        raise OSError("store is down")

    monkeypatch.setattr(process, "write_checkpoints", down)
    log, seen = record_log.read_record_log(spark, path, streaming=True), []
    query = process_stream(
        log, lambda batch: seen.append(batch.count()), str(tmp_path / "p"), store=str(tmp_path / "s"), raise_on_error=False, quarantine=str(aside)
    )
    with pytest.raises(Exception, match="store is down"):
        query.awaitTermination(60)
    assert seen == [4] and not aside.exists()


@pytest.fixture
def no_shards(spark):
    """An empty range, so that every key misses."""
    row = ("s", "1", 0, f"{100:032x}", f"{1:032x}", "100".zfill(39), "1".zfill(39), dt.datetime(2024, 1, 1))
    schema = "stream_name string, shard_id string, pos int, lo_hex string, hi_hex string, lo_dec string, hi_dec string, last_updated timestamp"
    return spark.createDataFrame([row], schema)


class Flaky:
    def __init__(self, landing, failures, message="lost"):
        self.landing, self.failures, self.message = landing, failures, message

    def __call__(self, entries):
        responses = self.landing(entries)
        if self.failures:
            self.failures -= 1
            raise ConnectionError(self.message)
        return responses

    def commit(self, spark, attempt):
        self.landing.commit(spark, attempt)


def test_an_attempt_that_raised_lands_nothing(spark, records, no_shards, tmp_path):
    path = str(tmp_path / "log")
    made, reports = records([(0, i, "k" + str(i), bytes([i])) for i in range(9)] + [(0, 9, "", b"x")]), []
    long = "lost " * 900
    for name in ("a", "a"):  # the same put run again after a crash
        put_fn = Flaky(record_log.landing_put_fn(path, dt.datetime(2024, 1, 1), name), 2 if not reports else 0, long)
        done = put_until_done(made, no_shards, Limits(aggregate=False), Policy.constant_delay(0), put_fn, on_attempt=reports.append)
    assert record_log.read_record_log(spark, path).count() == 18  # attempt 2 of the first run, attempt 0 of the second
    assert done.filter("error_code IS NOT NULL").count() == 0
    assert [(r["attempt"], r["n_received"], r["n_entries"], r["n_failed"], r["n_invalid"]) for r in reports] == [
        (0, 10, 9, 9, 1), (1, 0, 9, 9, 0), (2, 0, 9, 0, 0), (0, 10, 9, 0, 1)
    ]
    again = Flaky(record_log.landing_put_fn(path, dt.datetime(2024, 1, 1), "a"), 0)
    put_until_done(made, no_shards, Limits(aggregate=False), Policy.constant_delay(0), again)
    assert record_log.read_record_log(spark, path).count() == 18


def test_messages_are_whole(records, no_shards):

    def refuse(entries):
        raise ValueError("why " * 1000)

    done = put_until_done(records([(0, 0, "k", b"x")]), no_shards, Limits(), Policy.always_give_up(), refuse)
    row = done.first()
    assert row.error_code == PUT_RAISED and row.error_message == "ValueError: " + "why " * 1000
