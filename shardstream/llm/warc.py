"""A content-addressed archive of WARC records: payload bytes once by digest, exact headers apart, records by joining the two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .words import text_bytes

# Payloads of fewer bytes are always kept as responses of their own.
REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"

# The names and texts of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTENT_TYPE = "text/html; charset=utf-8"
RESPONSE, REVISIT = "response", "revisit"

END = "\r\n"


def _record_id(page: Column, row: Column) -> Column:
    """A URN made from the page's id and its row, so that rows that repeat an id have ids of their own."""
    hexed = F.md5(F.concat_ws(":", F.coalesce(page.cast("string"), F.lit("none")), row.cast("string")))
    parts = [F.substring(hexed, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _in_one_line(value: Column) -> Column:
    """Line ends and other control characters percent-encoded: a field can't end early or begin another."""
    encoded = value
    for code in [*range(32), 127]:
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(F.regexp_like(value, F.lit("[\\x00-\\x1F\\x7F]")), encoded).otherwise(value)


def _headers(date: str) -> Column:
    """The header block of a record, up to and with the empty line; a field without a value is left out."""
    first = F.col("first")
    revisits = F.col("revisits")

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(END))  # null if the value is

    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    fields = [
        field("WARC-Type", F.when(revisits, REVISIT).otherwise(RESPONSE)),
        field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("row"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", _in_one_line(F.col("url"))),
        field("WARC-Payload-Digest", digest),
        field("WARC-Refers-To", F.when(revisits, _record_id(first["page_id"], first["row"]))),
        field("WARC-Profile", F.when(revisits, F.lit(PROFILE))),
        field("X-Page-ID", F.col("page_id").cast("string")),
        field("X-Refers-To-Page-ID", F.when(revisits, first["page_id"].cast("string"))),
        field("X-Payload-Length", F.col("size").cast("string")),
        field("Content-Type", F.lit(CONTENT_TYPE)),
        field("Content-Length", F.when(revisits, F.lit("0")).otherwise(F.col("size").cast("string"))),
    ]
    return F.concat(F.lit(VERSION + END), *[F.coalesce(f, F.lit("")) for f in fields], F.lit(END))


def write_archive(pages: DataFrame, path: str, least: int = REVISIT_BYTES, date: str = DATE) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) below ``path``, in two tables.

    ``payloads``: digest, size, payload, one row for each distinct payload. ``headers``: row, digest, header, one
    row for each record, the header byte for byte as it stands in a WARC file. The payload is the html in UTF-8;
    a null html is an empty payload. Of the records with equal payloads of at least ``least`` bytes the one with
    the least page_id is the response and the others revisit it; rows that repeat that id are revisits but for
    one, and rows without an id come last. A null url gives no target field; control characters in a url are
    percent-encoded. No rows, two empty tables. Other columns are not looked at.

    Equal digests are proved to be of equal payloads: size and a second, independent hash have to agree for all
    records of a digest, or the job ends with an error. Only page ids, urls and digests are shuffled for
    the headers; payloads are reduced to one a digest in each task before they are shuffled, so that a payload that
    a third of the pages share goes over the wire once a task.
    """
    spark = pages.sparkSession
    payload = text_bytes("html")
    slim = materialize(
        pages.select(
            "page_id", "url", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"),
            F.xxhash64(payload).alias("check"), F.monotonically_increasing_id().alias("row"),
        )
    )
    order = F.struct(F.col("page_id").isNull().alias("without"), "page_id", "row")
    groups = slim.groupBy("digest").agg(
        F.min(order).alias("first"), F.count("*").alias("n"),
        ((F.min("check") == F.max("check")) & (F.min("size") == F.max("size"))).alias("same"),
    )
    unlike = F.raise_error(F.concat(F.lit("different payloads have the digest "), F.col("digest"))).cast("boolean")
    shared = groups.filter(F.when(F.col("same"), F.col("n") > 1).otherwise(unlike)).select("digest", "first")
    several = F.col("first").isNotNull() & (F.col("size") >= least)
    records = slim.join(shared, "digest", "left").withColumn("revisits", several & (F.col("row") != F.col("first.row")))
    records.select("row", "digest", _headers(date).cast("binary").alias("header")).write.parquet(f"{path}/headers")
    whole = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload")).dropDuplicates(["digest"])
    whole.select("digest", F.octet_length("payload").cast("long").alias("size"), "payload").write.parquet(f"{path}/payloads")


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads, with ``sound``: their bytes have the digest and the size they are stored by."""
    stored = spark.read.schema("digest string, size long, payload binary").parquet(f"{path}/payloads")
    sound = (F.sha2("payload", 256) == F.col("digest")) & (F.octet_length("payload") == F.col("size"))
    return stored.withColumn("sound", sound)


def _field(name: str) -> Column:
    """The value of a header field; null if the header has none."""
    found = F.regexp_extract(F.col("header").cast("string"), f"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(F.contains(F.col("header").cast("string"), F.lit(f"\r\n{name}: ")), found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive, one row each, with what their headers say and the payload they stand for.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to (the page_id of the response, for revisits), url,
    record_id, header, payload. A revisit has the payload of the record it refers to. A header whose payload is missing, or
    a payload whose bytes do not have its header's digest and length, ends the job with an error. A digest that a third of the
    records share is a hot join key of slim rows, which adaptive execution splits.
    """
    headers = spark.read.schema("row long, digest string, header binary").parquet(f"{path}/headers")
    joined = headers.join(verified_payloads(spark, path), "digest", "left")
    stated = F.substring_index(_field("WARC-Payload-Digest"), ":", -1)
    sound = F.coalesce(F.col("sound") & (stated == F.col("digest")) & (_field("X-Payload-Length").cast("long") == F.col("size")), F.lit(False))
    checked = F.when(sound, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("no sound payload for "), F.col("digest"))).cast("string"))
    return joined.select(
        _field("X-Page-ID").cast("long").alias("page_id"), F.col("size").alias("payload_bytes"), checked.alias("payload_digest"),
        _field("WARC-Type").alias("record_type"), _field("X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        _field("WARC-Target-URI").alias("url"), _field("WARC-Record-ID").alias("record_id"), "header", "payload",
    )


def record_bytes() -> Column:
    """A record of :func:`read_archive` byte for byte as in a WARC file: header, block, two line ends. A revisit's block is empty."""
    block = F.when(F.col("record_type") == REVISIT, F.lit(b"")).otherwise(F.col("payload"))
    return F.concat(F.col("header"), block, F.lit((END + END).encode()))


def original_bytes() -> Column:
    """The record as it was fetched: a revisit gets its payload back behind its header."""
    return F.concat(F.col("header"), F.col("payload"), F.lit((END + END).encode()))
