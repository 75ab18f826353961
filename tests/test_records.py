import pytest
from pyspark.sql import functions as F

from shardstream import Limits
from shardstream.functions import records as R
from shardstream.functions.wire import decimal_hash, field_len, record_len


def reasons(df, limits=Limits()):
    return [row.invalid_reason for row in R.validate(df, limits).orderBy("seq_in_put").collect()]


def test_first_failing_check_wins(records):
    big = b"x" * 101
    rows = [
        (0, 0, "k", b"x"),
        (0, 1, "", big, "-1"),
        (0, 2, "", b"x", "-1"),
        (0, 3, "k", b"x", "-1"),
        (0, 4, "k", b"x" * 99),
        (0, 5, "k", b"x" * 100),
    ]
    expected = [None, "RecordTooLarge", "InvalidPartitionKey", "InvalidExplicitHashKey", None, "RecordTooLarge"]
    assert reasons(records(rows), Limits(max_record_bytes=100)) == expected


@pytest.mark.parametrize(
    "key, ok",
    [
        (None, True),
        ("0", True),
        ("+5", True),
        ("-0", True),
        ("007", True),
        (str(2**128 - 1), True),
        ("000" + str(2**128 - 1), True),
        (str(2**128), False),
        ("9" * 60, False),
        ("-1", False),
        ("", False),
        ("abc", False),
        ("1e3", False),
        (" 1", False),
    ],
)
def test_explicit_hash_keys(records, key, ok):
    assert records([(0, 0, "k", b"x", key)]).select(R.is_valid_explicit_hash_key()).first()[0] is ok


def test_key_length_counts_bytes(records):
    rows = [(0, i, k, b"x") for i, k in enumerate(["é" * 128, "é" * 129, "k" * 256, "k" * 257, ""])]
    found = reasons(records(rows))
    assert found == [None, "InvalidPartitionKey", None, "InvalidPartitionKey", "InvalidPartitionKey"]
    assert records([(0, 0, "é", b"xyz")]).select(R.payload_size()).first()[0] == 5


def test_hash_keys(records):
    df = R.with_hash_key(records([(0, 0, "foo", b""), (0, 1, "123", b"")])).orderBy("seq_in_put")
    assert [r.hash_key for r in df.collect()] == ["acbd18db4cc2f85cedef654fccc4a4d8", "202cb962ac59075b964b07152d234b70"]
    assert decimal_hash("foo") == "229609063533823256041787889330700985560"
    digits = df.select(R.decimal_digits(F.col("hash_key")).alias("n")).collect()
    assert [d.n for d in digits] == [39, 38]


def test_packed_size_alone_is_the_size_formula(records):
    rows = [(0, i, "k" * (1 + i), b"x" * n, h) for i, (n, h) in enumerate([(0, None), (121, "5"), (122, None), (130, "77"), (20_000, None)])]
    found = records(rows).select("partition_key", "data", "explicit_hash_key", R.packed_size_alone().alias("size")).collect()
    for row in found:
        hash_key = row.explicit_hash_key or decimal_hash(row.partition_key)
        expected = field_len(len(row.partition_key)) + field_len(len(hash_key)) + record_len(0, len(row.data))
        assert row.size == expected


def test_views_and_labels(spark, records):
    df = records([(0, 0, "k", b"a" * 100)])
    text, encoded = df.select(R.data_text(), R.data_base64()).first()
    assert text == "a" * 100 and "\n" not in encoded and len(encoded) == 136
    names = spark.createDataFrame([("n", "a"), (None, "a"), (None, None)], "stream_name string, stream_arn string")
    assert [r[0] for r in names.select(R.stream_label()).collect()] == ["n", "a", ""]


def test_audit_json_sorts_keys_and_leaves_out_nulls(spark):
    df = spark.createDataFrame([("p", None, bytearray(b"hi"))], "z string, m string, a binary")
    assert R.to_audit_json(df).first()[0] == '{"a":"aGk=","z":"p"}'


def test_entries_drop_the_ordering_number(records):
    df = records([(0, 0, "k", b"x")]).withColumn("sequence_number_for_ordering", F.lit("1"))
    assert R.to_put_entries(df).columns == ["stream_name", "put_id", "data", "partition_key", "explicit_hash_key"]


def test_text_of_any_bytes(spark):
    df = spark.createDataFrame([(bytes.fromhex("fffe61"),), (None,), (b"",)], "data binary")
    assert [r[0] for r in df.select(R.data_text()).collect()] == ["��a", None, ""]
