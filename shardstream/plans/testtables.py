"""The generated test tables read as record streams; used by the registered queries, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Limits

# Limits scaled down so that the documents table reaches every one of them.
DOCUMENT_LIMITS = Limits(
    max_request_records=50,
    max_request_bytes=131_072,
    max_record_bytes=8_192,
    max_shard_bytes=65_536,
    max_shard_records=40,
)

PUT_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as producer records: five streams, one partition key per user."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("stream-"), "event_type").alias("stream_name"),
        F.expr(f"event_id div {PUT_ROWS}").alias("put_id"),
        F.expr(f"CAST(event_id % {PUT_ROWS} AS INT)").alias("seq_in_put"),
        F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props").cast("binary").alias("data"),
        F.col("user_id").cast("string").alias("partition_key"),
        F.expr(
            "CASE WHEN event_id % 997 = 0 THEN '-1' WHEN event_id % 10 = 0 THEN concat(event_id, '7777777777') END"
        ).alias("explicit_hash_key"),
        F.lit(None).cast("string").alias("sequence_number_for_ordering"),
        "event_id",
    )


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as one stream of large records, in puts of 500."""
    return table(spark, sf_dir, "documents").select(
        F.lit("documents").alias("stream_name"),
        F.expr(f"doc_id div {PUT_ROWS}").alias("put_id"),
        F.expr(f"CAST(doc_id % {PUT_ROWS} AS INT)").alias("seq_in_put"),
        F.col("text").cast("binary").alias("data"),
        F.col("source").alias("partition_key"),
        F.lit(None).cast("string").alias("explicit_hash_key"),
        F.lit(None).cast("string").alias("sequence_number_for_ordering"),
        "doc_id",
    )


def micros(ts: str) -> F.Column:
    """Microseconds since the epoch of a timestamp without time zone, whatever the session's zone is."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))


def consumer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a landed record log: four shards per stream, sequence numbers in event order."""
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("stream-"), "event_type").alias("stream_name"),
        F.format_string("shardId-%012d", F.col("user_id") % 4).alias("shard_id"),
        F.lpad(F.col("event_id").cast("string"), 56, "0").alias("sequence_number"),
        F.lit(None).cast("bigint").alias("sub_sequence_number"),
        F.col("ts").alias("arrival"),
        F.concat_ws("|", F.col("event_id").cast("string"), "event_type", "props").cast("binary").alias("data"),
        F.col("user_id").cast("string").alias("partition_key"),
        F.lit(None).cast("string").alias("encryption_type"),
        F.lit(None).cast("string").alias("explicit_hash_key"),
    )


def even_ranges(n_shards: int) -> list[tuple[int, int, int]]:
    """(position, first, last hash key) of shards that divide the hash-key space evenly."""
    edge = lambda i: (i << 128) // n_shards
    return [(i, edge(i), edge(i + 1) - 1) for i in range(n_shards)]


def shard_name(i) -> str:
    return f"shardId-{i:012d}"


def listing(spark: SparkSession, sf_dir: str, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """A shard listing with the given ranges for each stream of ``events``."""
    shards = F.array(
        *[
            F.struct(
                F.lit(shard_name(i)).alias("shard_id"),
                F.lit(i).alias("pos"),
                F.lit(str(lo)).alias("starting_hash_key"),
                F.lit(str(hi)).alias("ending_hash_key"),
            )
            for i, lo, hi in ranges
        ]
    )
    streams = table(spark, sf_dir, "events").select(F.concat(F.lit("stream-"), "event_type").alias("stream_name")).distinct()
    return streams.select("stream_name", F.inline(shards)).withColumns(
        {
            "ending_sequence_number": F.lit(None).cast("string"),
            "listed_at": F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
        }
    )
