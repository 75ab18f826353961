"""Column expressions over records: sizes, hash keys, validity, payload views. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Limits

# The largest 128-bit number in decimal and the magic bytes that open a packed record.
MAX_HASH_KEY_DECIMAL = "340282366920938463463374607431768211455"
MAGIC = bytes([0xF3, 0x89, 0x9A, 0xC2])
DIGEST_BYTES = 16
FRAME_BYTES = len(MAGIC) + DIGEST_BYTES

RECORD_TOO_LARGE = "RecordTooLarge"
INVALID_PARTITION_KEY = "InvalidPartitionKey"
INVALID_EXPLICIT_HASH_KEY = "InvalidExplicitHashKey"


def payload_size(partition_key: str = "partition_key", data: str = "data") -> Column:
    """UTF-8 bytes of the partition key plus bytes of the data."""
    return (F.octet_length(partition_key) + F.octet_length(data)).cast("bigint")


def with_payload_size(df: DataFrame, name: str = "n_bytes") -> DataFrame:
    return df.withColumn(name, payload_size())


def hash_key(partition_key: str = "partition_key") -> Column:
    """MD5 of the key as 32 lower-case hex digits: string order is the order of the 128-bit number."""
    return F.md5(F.col(partition_key).cast("binary"))


def with_hash_key(df: DataFrame, name: str = "hash_key") -> DataFrame:
    return df.withColumn(name, hash_key())


def decimal_digits(hex_key: Column) -> Column:
    """Number of decimal digits of a 32-digit hex number, by comparing with the powers of ten."""
    powers = [F.lit(f"{10**k:032x}") for k in range(1, 39)]
    return sum(((hex_key >= p).cast("int") for p in powers), F.lit(1))


def padded_hash_key(explicit_hash_key: Column) -> Column:
    """A decimal hash key as 39 digits, so that string order is numeric order; null if not such a number."""
    digits = F.regexp_replace(explicit_hash_key, r"^\+?0*", "")
    return (
        F.when(
            explicit_hash_key.rlike(r"^\+?[0-9]+$") & (F.length(digits) <= 39),
            F.lpad(digits, 39, "0"),
        )
        .when(explicit_hash_key.rlike(r"^-0+$"), F.lit("0" * 39))
    )


def is_valid_size(limits: Limits = Limits()) -> Column:
    return payload_size() <= limits.max_record_bytes


def is_valid_partition_key(limits: Limits = Limits(), partition_key: str = "partition_key") -> Column:
    return F.octet_length(partition_key).between(limits.min_key_bytes, limits.max_key_bytes)


def is_valid_explicit_hash_key(explicit_hash_key: str = "explicit_hash_key") -> Column:
    key = F.col(explicit_hash_key)
    return key.isNull() | F.coalesce(padded_hash_key(key) <= MAX_HASH_KEY_DECIMAL, F.lit(False))


def invalid_reason(limits: Limits = Limits()) -> Column:
    """Why a record cannot be put: the first check that fails, or null."""
    return (
        F.when(~is_valid_size(limits), RECORD_TOO_LARGE)
        .when(~is_valid_partition_key(limits), INVALID_PARTITION_KEY)
        .when(~is_valid_explicit_hash_key(), INVALID_EXPLICIT_HASH_KEY)
    )


def validate(df: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Mark each record with its ``invalid_reason``; one narrow pass, callers filter."""
    return df.withColumn("invalid_reason", invalid_reason(limits))


def is_aggregated(data: str = "data") -> Column:
    """True for a packed record: long enough for the frame and opened by the magic bytes."""
    return (F.octet_length(data) >= FRAME_BYTES) & (F.substring(data, 1, len(MAGIC)) == F.lit(bytearray(MAGIC)))


def varint_size(value: Column) -> Column:
    """Bytes of a non-negative int as a base-128 varint."""
    return (
        F.when(value < 1 << 7, 1).when(value < 1 << 14, 2).when(value < 1 << 21, 3).when(value < 1 << 28, 4).otherwise(5)
    )


def packed_size_alone() -> Column:
    """Serialized bytes of a record as the first of a pack (frame not counted).

    Without an explicit hash key the pack carries the decimal text of the key's hash.
    """
    key_bytes = F.octet_length("partition_key")
    hash_bytes = F.coalesce(F.octet_length("explicit_hash_key"), decimal_digits(hash_key()))
    data_bytes = F.octet_length("data")
    # both table indices are 0 here: one tag byte and one varint byte each
    record_bytes = 4 + 1 + varint_size(data_bytes) + data_bytes
    entry = lambda n: 1 + varint_size(n) + n
    return (entry(key_bytes) + entry(hash_bytes) + entry(record_bytes)).cast("bigint")


def records_equal(left: str, right: str) -> Column:
    """Equality of two record structs over data, keys and ordering number, nulls being equal."""
    fields = ["data", "explicit_hash_key", "partition_key", "sequence_number_for_ordering"]
    same = F.lit(True)
    for field in fields:
        same = same & F.col(f"{left}.{field}").eqNullSafe(F.col(f"{right}.{field}"))
    return same


def to_put_entries(df: DataFrame) -> DataFrame:
    """What a request entry sends: data, partition key and, if present, the explicit hash key.

    The ordering number stays behind. Columns that place the record in its request are kept.
    """
    place = ["stream_name", "put_id", "attempt", "batch_no", "shard_id", "request_index"]
    kept = [c for c in place if c in df.columns]
    return df.select(*kept, "data", "partition_key", "explicit_hash_key")


def data_text(data: str = "data") -> Column:
    """The payload as text; bytes that are no UTF-8 become replacement characters."""
    return F.make_valid_utf8(F.col(data).cast("string"))


def data_base64(data: str = "data") -> Column:
    """Base64 on one line (Spark's own function breaks lines after 76 characters)."""
    return F.regexp_replace(F.base64(data), r"\r\n", "")


def stream_label(stream_name: str = "stream_name", stream_arn: str = "stream_arn") -> Column:
    """The stream's name for metrics: its name, else its ARN, else the empty string."""
    return F.coalesce(F.col(stream_name), F.col(stream_arn), F.lit(""))


def to_audit_json(df: DataFrame, name: str = "audit") -> DataFrame:
    """One JSON text per row: keys sorted, absent values left out, binary as base64."""
    columns = [
        data_base64(f.name).alias(f.name) if f.dataType.typeName() == "binary" else F.col(f.name)
        for f in sorted(df.schema.fields, key=lambda f: f.name)
    ]
    return df.select(F.to_json(F.struct(*columns)).alias(name))
