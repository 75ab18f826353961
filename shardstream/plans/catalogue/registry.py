"""The registered queries, each with the SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


# The test tables as records, in SQL; the same mapping as in testtables.py.
RECORDS = """
rec AS (
  SELECT 'stream-' || event_type AS stream_name, event_id // 500 AS put_id, CAST(event_id % 500 AS INTEGER) AS seq_in_put,
         event_id::VARCHAR || '|' || event_type || '|' || props AS data_text, user_id::VARCHAR AS partition_key,
         CASE WHEN event_id % 997 = 0 THEN '-1' WHEN event_id % 10 = 0 THEN event_id::VARCHAR || '7777777777' END
           AS explicit_hash_key,
         event_id, user_id, ts
  FROM events),
sized AS (SELECT *, CAST(strlen(data_text) + strlen(partition_key) AS BIGINT) AS n_bytes, md5(partition_key) AS hash_key
          FROM rec),
checked AS (
  SELECT *, CASE WHEN n_bytes > 1048576 THEN 'RecordTooLarge'
                 WHEN strlen(partition_key) NOT BETWEEN 1 AND 256 THEN 'InvalidPartitionKey'
                 WHEN explicit_hash_key IS NOT NULL AND TRY_CAST(explicit_hash_key AS UHUGEINT) IS NULL
                   THEN 'InvalidExplicitHashKey' END AS invalid_reason
  FROM sized),
valid AS (SELECT * FROM checked WHERE invalid_reason IS NULL)"""

DOCUMENTS = """
rec AS (
  SELECT doc_id // 500 AS put_id, CAST(doc_id % 500 AS INTEGER) AS seq_in_put, text AS data_text, source AS partition_key,
         doc_id, CAST(strlen(text) + strlen(source) AS BIGINT) AS n_bytes, md5(source) AS hash_key
  FROM documents),
valid AS (SELECT * FROM rec WHERE n_bytes <= 8192)"""

LOG = """
log AS (
  SELECT 'stream-' || event_type AS stream_name, 'shardId-' || lpad((user_id % 4)::VARCHAR, 12, '0') AS shard_id,
         lpad(event_id::VARCHAR, 56, '0') AS sequence_number, ts AS arrival, event_id, user_id,
         event_id::VARCHAR || '|' || event_type || '|' || props AS data_text, user_id::VARCHAR AS partition_key
  FROM events)"""

# 128-bit value of a 32-digit hex text
HEX_VALUE = "(('0x' || substr({0}, 1, 16))::UBIGINT::UHUGEINT * 18446744073709551616::UHUGEINT + ('0x' || substr({0}, 17, 16))::UBIGINT::UHUGEINT)"


def ranges_sql(ranges: list[tuple[int, int, int]]) -> str:
    """A shard map as an SQL table of hex bounds."""
    rows = ", ".join(f"('shardId-{i:012d}', {i}, '{lo:032x}', '{hi:032x}')" for i, lo, hi in ranges)
    return f"shards(shard_id, pos, lo, hi) AS (VALUES {rows})"
