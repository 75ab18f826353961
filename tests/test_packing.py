import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shardstream import Limits
from shardstream.functions.wire import FRAME_BYTES, decimal_hash, decode_pack, encode_pack
from shardstream.operators.packing import OpenPack, pack_records, unpack_records
from shardstream.operators.scan import next_starts

FOO, WAZZLE = ("foo", b"\x01" * 500), ("wazzle", b"\x01" * 500)


def test_golden_sizes():
    one = encode_pack("foo", [(decimal_hash("foo"), FOO[1])])
    assert len(one) == 576
    assert one[:4].hex() == "f3899ac2" and one[-16:] == hashlib.md5(one[4:-16]).digest()


def test_two_key_pack_of_the_published_format_is_read():
    """A pack whose table holds two partition keys (written by others) opens too."""
    from shardstream.functions.wire import _field, _varint

    hashes = [decimal_hash("foo"), decimal_hash("wazzle")]
    body = _field(1, b"foo") + _field(1, b"wazzle") + b"".join(_field(2, h.encode()) for h in hashes)
    for i in range(2):
        body += _field(3, b"\x08" + _varint(i) + b"\x10" + _varint(i) + _field(3, b"\x01" * 500))
    data = bytes.fromhex("f3899ac2") + body + hashlib.md5(body).digest()
    assert len(data) == 1134
    assert data[:23].hex() == "f3899ac20a03666f6f0a0677617a7a6c6512273232393630"[:46]
    assert data[-16:].hex() == "f279fe31b52019b437b918320920bd83"
    assert decode_pack(data) == [("foo", hashes[0], FOO[1]), ("wazzle", hashes[1], WAZZLE[1])]


@given(st.text(min_size=1, max_size=5), st.lists(st.tuples(st.integers(0, 400).map(str), st.binary(max_size=300)), min_size=1, max_size=300))
@settings(max_examples=40, deadline=None)
def test_encode_decode_and_size(key, records):
    chunk = OpenPack(Limits())
    chunk.start((key,))
    for hash_key, data in records:
        chunk.push((hash_key, len(data)))
    packed = encode_pack(key, records)
    assert len(packed) == chunk.size
    assert decode_pack(packed) == [(key, h, d) for h, d in records]


def brute_force(rows, limit, start=0):
    """Sizes of the packs of ``rows`` from ``start`` on, by encoding every candidate."""
    packs, held = [], []
    for h, n in rows[start:]:
        grown = held + [(decimal_hash("k") if h is None else h, b"\0" * n)]
        if held and len(encode_pack("k", grown)) > limit:
            packs.append(len(held))
            grown = grown[-1:]
        held = grown
    return packs + [len(held)]


hash_keys = st.one_of(st.none(), st.integers(0, 3).map(str), st.integers(0, 10**6).map(str))


@given(st.lists(st.tuples(hash_keys, st.integers(0, 40)), min_size=1, max_size=80), st.integers(80, 900))
@settings(max_examples=60, deadline=None)
def test_next_pack_start_from_every_row(rows, limit):
    chunk = OpenPack(Limits(max_record_bytes=limit))
    chunk.start(("k",))
    starts = next_starts(rows, len(rows), chunk)
    assert [s - i for i, s in enumerate(starts)] == [brute_force(rows, limit, i)[0] for i in range(len(rows))]


def test_next_pack_start_with_more_than_128_hash_keys():
    rows = [(None if i % 5 == 0 else str(10**6 + i), i % 3) for i in range(420)]
    limit = 6_000
    chunk = OpenPack(Limits(max_record_bytes=limit))
    chunk.start(("k",))
    starts = next_starts(rows, len(rows), chunk)
    for i in range(0, len(rows), 23):
        assert starts[i] - i == brute_force(rows, limit, i)[0]


def packs(df):
    return [(r.partition_key, r.pack_no, r.n_records, r.size_bytes) for r in df.orderBy("put_id", "partition_key", "pack_no").collect()]


def with_shard(df):
    return df.withColumn("shard_id", F.lit("shard-1"))


def test_pack_is_full_at_the_limit(records):
    rows = [(0, i, "foo", b"\x01" * 349_524) for i in range(3)]
    assert [p[2] for p in packs(pack_records(with_shard(records(rows))))] == [2, 1]


def test_near_limit_record_is_sent_unpacked(records):
    payload = b"x" * (1024 * 1024 - 1)
    row = pack_records(with_shard(records([(0, 0, "k", payload, "7")]))).first()
    assert row.oversize and bytes(row.data) == payload and row.explicit_hash_key == "7" and row.n_bytes == 1024 * 1024


@pytest.mark.parametrize("group_rows", [None, 1])
def test_packs_equal_brute_force(records, group_rows):
    rows = [(0, i, "k", b"\0" * (i % 37), None if i % 4 else str(i // 8)) for i in range(300)]
    limits = Limits(max_record_bytes=700)
    expected = brute_force([(r[4], len(r[3])) for r in rows], 700)
    found = packs(pack_records(with_shard(records(rows)), limits, group_rows=group_rows))
    assert [p[2] for p in found] == expected
    assert max(p[3] for p in found) <= 700


def consumed(df):
    return df.withColumns({"sequence_number": F.lit("foo"), "sub_sequence_number": F.lit(None).cast("bigint")})


def test_unpack_round_trip(records):
    rows = [(0, i, "k" + str(i % 3), bytes([i] * i), str(i) if i % 2 else None) for i in range(40)]
    opened = unpack_records(consumed(pack_records(with_shard(records(rows)))), verify_digest=True)
    got = {(r.partition_key, bytes(r.data), r.explicit_hash_key) for r in opened.collect()}
    assert got == {(k, d, h or decimal_hash(k)) for _, _, k, d, h in rows}
    order = opened.filter("partition_key = 'k1'").orderBy("sub_sequence_number").collect()
    assert [bytes(r.data) for r in order] == [r[3] for r in rows if r[2] == "k1"]
    assert [r.sub_sequence_number for r in order] == list(range(len(order)))


def test_only_packed_data_leaves_the_jvm(spark, records, tmp_path):
    plain = consumed(records([(0, i, "foo", b"foo") for i in range(10)]))
    plain.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    opened = unpack_records(log)
    assert sorted(opened.collect()) == sorted(log.collect())
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "MapInArrow" not in plan
    assert "ArrowEvalPython" in plan


def test_pack_without_records_leaves_nothing(spark):
    empty = encode_pack("foo", [])
    assert unpack_records(broken(spark, empty)).count() == 0


def broken(spark, data):
    schema = "data binary, partition_key string, explicit_hash_key string, sub_sequence_number long"
    return spark.createDataFrame([(bytearray(data), "k", None, None)], schema)


@pytest.mark.parametrize("damage", [lambda d: d[:4] + b"\xff" * 20 + d[24:], lambda d: d[:30] + d[-16:]])
def test_malformed_packs(spark, damage):
    data = damage(encode_pack("foo", [("1", b"abc" * 20)]))
    with pytest.raises(Exception, match="truncated|unknown|overlong|utf"):
        unpack_records(broken(spark, data)).collect()
    row = unpack_records(broken(spark, data), on_error="quarantine").first()
    assert bytes(row.data) == data and row.unpack_error


def test_digest_is_checked_only_on_request(spark):
    data = encode_pack("foo", [("1", b"abc")])
    wrong = data[:-1] + bytes([data[-1] ^ 1])
    assert unpack_records(broken(spark, wrong)).first().partition_key == "foo"
    row = unpack_records(broken(spark, wrong), on_error="quarantine", verify_digest=True).first()
    assert row.unpack_error == "digest does not match"


def test_short_frame_is_not_a_pack(spark):
    data = bytes.fromhex("f3899ac2") + b"0" * 15
    assert len(data) < FRAME_BYTES
    assert bytes(unpack_records(broken(spark, data)).first().data) == data


def ends(rows, limit):
    """Where a pack from each row on ends, from what it would be on the wire."""
    default, out = decimal_hash("foo"), []
    for at in range(len(rows)):
        end = at + 1
        while end < len(rows) and len(encode_pack("foo", [(h or default, b"x" * n) for h, n in rows[at : end + 1]])) <= limit:
            end += 1
        out.append(end)
    return out


@settings(deadline=None, max_examples=25)
@given(st.integers(0, 10**6), st.sampled_from([2, 140, 300]), st.sampled_from([500, 2500]))
def test_pack_ends_are_those_on_the_wire(seed, keys, limit):
    import random

    made = random.Random(seed)
    own = [None, decimal_hash("foo"), *map(str, range(keys))]
    rows = [(made.choice(own), made.choice([0, 1, 9, 120, 126])) for _ in range(260)]
    pack = OpenPack(Limits(max_record_bytes=limit))
    pack.start(("s", 1, "foo"))
    assert next_starts(rows, len(rows), pack) == ends(rows, limit)


def test_a_hot_key_with_distinct_hash_keys():
    import time

    rows = [(str(10**38 + i), 10) for i in range(100_000)]
    pack = OpenPack(Limits())
    pack.start(("s", 1, "foo"))
    began = time.monotonic()
    assert len(next_starts(rows, len(rows), pack)) == len(rows)
    assert time.monotonic() - began < 60


def test_a_null_hash_key_is_the_key_s_own():
    pack = OpenPack(Limits())
    pack.start(("s", 1, "foo"))
    for row in ((None, 5), (decimal_hash("foo"), 5)):
        pack.push(row)
    assert pack.size == len(encode_pack("foo", [(decimal_hash("foo"), b"x" * 5)] * 2))
