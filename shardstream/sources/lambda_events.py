"""Function-invocation events: JSON texts with a list of base64 records, read and written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import with_ordinal
from ..operators.packing import unpack_records

# The event's JSON fields.
EVENT_SCHEMA = """
    Records array<struct<
        awsRegion: string, eventID: string, eventName: string, eventSource: string, eventSourceARN: string,
        eventVersion: string, invokeIdentityArn: string,
        kinesis: struct<
            approximateArrivalTimestamp: decimal(20,9), data: string, kinesisSchemaVersion: string,
            partitionKey: string, encryptionType: string, sequenceNumber: string>>>
"""
ENVELOPE = ["awsRegion", "eventID", "eventName", "eventSource", "eventSourceARN", "eventVersion", "invokeIdentityArn"]
PAYLOAD = ["approximateArrivalTimestamp", "data", "kinesisSchemaVersion", "partitionKey", "sequenceNumber"]
ENCRYPTION_TYPES = ["NONE", "KMS"]


def _well_formed(record: F.Column) -> F.Column:
    kinesis = record["kinesis"]
    ok = F.try_to_binary(kinesis["data"], F.lit("base64")).isNotNull()
    for field in ENVELOPE:
        ok = ok & record[field].isNotNull()
    for field in PAYLOAD:
        ok = ok & kinesis[field].isNotNull()
    return ok & (kinesis["encryptionType"].isNull() | kinesis["encryptionType"].isin(*ENCRYPTION_TYPES))


def _parse(df, json_col):
    """The rows with their event parsed, the event's records, and whether all of them are well formed."""
    parsed = df.withColumn("__event", F.from_json(json_col, EVENT_SCHEMA))
    records = F.col("__event.Records")
    good = records.isNotNull() & F.forall(records, lambda r: F.coalesce(_well_formed(r), F.lit(False)))
    return parsed, records, F.coalesce(good, F.lit(False))


def malformed_events(df: DataFrame, json_col: str = "event") -> DataFrame:
    """The rows whose event cannot be read because of any of its records."""
    parsed, _, good = _parse(df, json_col)
    return parsed.filter(~good).select(*df.columns)


def read_lambda_events(df: DataFrame, json_col: str = "event", on_error: str = "fail") -> DataFrame:
    """One consumer record per record of each event; the other columns of ``df`` are kept.

    The arrival time, decimal epoch seconds, is cut to microseconds. A malformed event fails the query
    or, with ``on_error='skip'``, yields no rows (:func:`malformed_events` returns them).
    """
    if on_error not in ("fail", "skip"):
        raise ValueError("on_error is 'fail' or 'skip'")
    kept = [c for c in df.columns if c != json_col]
    parsed, records, good = _parse(df, json_col)
    if on_error == "fail":
        message = F.concat(F.lit("malformed event: "), F.coalesce(F.col(json_col), F.lit("null")))
        usable = F.when(good, records).otherwise(F.raise_error(message))
    else:
        usable = F.when(good, records)
    exploded = parsed.select(*kept, F.posexplode(usable).alias("record_index", "__r"))
    record, kinesis = F.col("__r"), F.col("__r.kinesis")
    seconds = kinesis["approximateArrivalTimestamp"]
    return exploded.select(
        *kept,
        "record_index",
        record["awsRegion"].alias("aws_region"),
        record["eventID"].alias("event_id"),
        record["eventName"].alias("event_name"),
        record["eventSource"].alias("event_source"),
        record["eventSourceARN"].alias("event_source_arn"),
        record["eventVersion"].alias("event_version"),
        record["invokeIdentityArn"].alias("invoke_identity_arn"),
        kinesis["kinesisSchemaVersion"].alias("schema_version"),
        kinesis["sequenceNumber"].alias("sequence_number"),
        F.timestamp_micros((seconds * 1_000_000).cast("bigint")).alias("arrival"),
        F.unbase64(kinesis["data"]).alias("data"),
        kinesis["partitionKey"].alias("partition_key"),
        kinesis["encryptionType"].alias("encryption_type"),
        F.lit(None).cast("bigint").alias("sub_sequence_number"),
        F.lit(None).cast("string").alias("explicit_hash_key"),
    )


def unpack_lambda_events(df: DataFrame, json_col: str = "event", on_error: str = "fail") -> DataFrame:
    """Events to records, packed records opened."""
    return unpack_records(read_lambda_events(df, json_col, on_error))


def to_lambda_events(
    df: DataFrame, keys: list[str], order: list[str], arrival_ms: str, records_per_event: int = 100
) -> DataFrame:
    """Consumer records as event texts: ``keys``, ``event_no`` and ``event``.

    Each group named by ``keys`` is cut, in order, into events of ``records_per_event``, so no event
    grows with its group. ``df`` has the columns :func:`read_lambda_events` yields, and ``arrival_ms``,
    epoch milliseconds, is written as decimal seconds.
    """
    millis = F.col(arrival_ms).cast("decimal(17,0)")
    kinesis = F.struct(
        (millis / 1000).cast("decimal(20,3)").alias("approximateArrivalTimestamp"),
        F.regexp_replace(F.base64("data"), r"\r\n", "").alias("data"),
        F.col("schema_version").alias("kinesisSchemaVersion"),
        F.col("partition_key").alias("partitionKey"),
        F.col("encryption_type").alias("encryptionType"),
        F.col("sequence_number").alias("sequenceNumber"),
    )
    record = F.struct(
        F.col("aws_region").alias("awsRegion"),
        F.col("event_id").alias("eventID"),
        F.col("event_name").alias("eventName"),
        F.col("event_source").alias("eventSource"),
        F.col("event_source_arn").alias("eventSourceARN"),
        F.col("event_version").alias("eventVersion"),
        F.col("invoke_identity_arn").alias("invokeIdentityArn"),
        kinesis.alias("kinesis"),
    )
    numbered = with_ordinal(df, keys, order, "__at")
    gathered = (
        numbered.select(*keys, "__at", record.alias("__record"))
        .groupBy(*keys, F.expr(f"__at div {records_per_event}").alias("event_no"))
        .agg(F.sort_array(F.collect_list(F.struct("__at", "__record"))).alias("__rows"))
    )
    event = F.struct(F.transform("__rows", lambda r: r["__record"]).alias("Records"))
    return gathered.select(*keys, "event_no", F.to_json(event, {"ignoreNullFields": "false"}).alias("event"))
