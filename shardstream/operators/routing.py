"""Shard maps and routing: which shard's hash-key range holds a record's 128-bit hash key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_SHARD
from ..functions.records import hash_key
from ..session import materialize

SHARD_MAP = ["stream_name", "shard_id", "pos", "lo_hex", "hi_hex", "lo_dec", "hi_dec", "last_updated"]

# rows a lookup may have to be broadcast (each holds two texts of 32 digits and two names)
LOOKUP_ROWS = 500_000


@dataclass(frozen=True)
class Lookup:
    """A shard map made ready for routing: its ranges by the leading hex digits of the hash keys they hold."""

    pieces: DataFrame
    digits: int


def _hex(decimal: F.Column) -> F.Column:
    """A decimal number below 2^128 as 32 hex digits: long division by 2^64 in steps of 13 digits."""
    digits = F.lpad(decimal, 39, "0")
    high, middle, low = (F.substring(digits, at, 13).cast("decimal(38,0)") for at in (1, 14, 27))
    step, word = F.lit(10**13).cast("decimal(14,0)"), F.lit(Decimal(1 << 64)).cast("decimal(20,0)")
    first = high * step + middle
    rest = (first % word) * step + low
    quotient = lambda x: ((x - x % word) / word).cast("decimal(20,0)")
    upper = quotient(first) * step + quotient(rest)
    part = lambda x: F.lpad(F.lower(F.conv(x.cast("decimal(20,0)").cast("string"), 10, 16)), 16, "0")
    return F.concat(part(upper), part(rest % word))


def shard_map(listing: DataFrame) -> DataFrame:
    """The open shards of a shard listing, with both (inclusive) bounds as comparable texts.

    ``listing`` has stream_name, shard_id, pos (order in the listing), starting_hash_key and
    ending_hash_key (decimal), ending_sequence_number (null while open) and listed_at.
    """
    start, end = F.col("starting_hash_key"), F.col("ending_hash_key")
    return listing.filter("ending_sequence_number IS NULL").select(
        "stream_name",
        "shard_id",
        "pos",
        _hex(start).alias("lo_hex"),
        _hex(end).alias("hi_hex"),
        F.lpad(start, 39, "0").alias("lo_dec"),
        F.lpad(end, 39, "0").alias("hi_dec"),
        F.col("listed_at").alias("last_updated"),
    )


def shard_map_as_of(listings: DataFrame, now, ttl_us: int = 3_600_000_000) -> DataFrame:
    """The map in use at ``now``, with a ``stale`` flag: a refresh is due.

    ``listings`` is the history of refreshes: listing rows plus ``ok``. A failed refresh keeps the
    older map; before the first success the map is empty.
    """
    now = F.lit(now) if not hasattr(now, "_jc") else now
    past = listings.filter(F.col("ok") & (F.col("listed_at") <= now))
    newest = past.groupBy("stream_name").agg(F.max("listed_at").alias("listed_at"))
    current = shard_map(past.join(newest, ["stream_name", "listed_at"], "left_semi"))
    age = F.timestamp_diff("MICROSECOND", F.col("last_updated"), now)
    return current.withColumn("stale", age >= ttl_us)


def _cut_overlaps(shards: DataFrame) -> DataFrame:
    """Cut each stream's ranges so that a hash key lies in at most one: the first listed shard wins.

    Runs on the shard map, stream by stream, never on records.
    """

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf.lo <= pdf.before]
        edges = sorted({*pdf.lo, *pdf.before})
        starts = {edge: [] for edge in edges}
        for row in pdf.itertuples(index=False):
            starts[row.lo].append((row.pos, row.before, row.shard_id))
        pieces, live = [], []
        for lo, before in zip(edges, edges[1:]):
            live = sorted(shard for shard in live + starts[lo] if shard[1] > lo)
            if live:
                pieces.append((pdf.stream_name.iloc[0], live[0][2], lo, before))
        return pd.DataFrame(pieces, columns=["stream_name", "shard_id", "lo", "before"])

    return shards.groupBy("stream_name").applyInPandas(cut, "stream_name string, shard_id string, lo string, before string")


def lookup_table(shards: DataFrame | Callable[[], DataFrame]) -> Lookup:
    """Prepare a shard map for :func:`predict_shard`; worth keeping when records are routed repeatedly.

    There are at least as many buckets as a stream has shards, so a bucket holds few ranges if the
    shards are of similar width. The table is broadcast if a bound on its rows is small.
    """
    shards = materialize(shards() if callable(shards) else shards)
    below = Window.partitionBy("stream_name").orderBy("lo_hex", "pos").rowsBetween(Window.unboundedPreceding, -1)
    ranges = shards.filter("lo_hex <= hi_hex")
    checked = ranges.select("stream_name", (F.max("hi_hex").over(below) >= F.col("lo_hex")).alias("overlaps"))
    per_stream = checked.groupBy("stream_name").agg(F.count("*").alias("n"), F.max("overlaps").alias("overlaps"))
    most, total, streams, overlaps = per_stream.agg(
        F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.max("overlaps")
    ).first()
    # half-open texts: one that continues hi_hex sorts after it and before the next hex number
    ranges = ranges.select("stream_name", "shard_id", "pos", F.col("lo_hex").alias("lo"), F.concat("hi_hex", F.lit("g")).alias("before"))
    disjoint = _cut_overlaps(ranges) if overlaps else ranges
    digits = 1 if most <= 16 else 2 if most <= 256 else 3
    bucket = lambda c: F.conv(F.substring(c, 1, digits), 16, 10).cast("int")
    # a cut may lie right behind a bucket's last number; the range test makes a spare bucket harmless
    pieces = disjoint.select(
        F.col("stream_name").alias("__stream"),
        F.col("shard_id").alias("__shard"),
        "lo",
        "before",
        F.explode(F.sequence(bucket("lo"), bucket("before"))).alias("__bucket"),
    )
    most_rows = 2 * total + streams * 16**digits
    return Lookup(F.broadcast(pieces) if most_rows <= LOOKUP_ROWS else pieces, digits)


def predict_shard(df: DataFrame, shards: DataFrame | Lookup | Callable[[], DataFrame], name: str = "shard_id") -> DataFrame:
    """Add the shard whose range holds the record's hash key; a miss goes to the default shard.

    ``shards`` is a shard map, a function that gives one, or a lookup made from one. Only the partition
    key decides; an explicit hash key does not. The lookup is an equi-join on the bucket with a range
    test on what is left, and every record keeps exactly one row.
    """
    lookup = shards if isinstance(shards, Lookup) else lookup_table(shards)
    keyed = df.withColumn("__hash", hash_key())
    match = (
        (F.col("stream_name") == F.col("__stream"))
        & (F.conv(F.substring("__hash", 1, lookup.digits), 16, 10).cast("int") == F.col("__bucket"))
        & (F.col("__hash") >= F.col("lo"))
        & (F.col("__hash") < F.col("before"))
    )
    routed = keyed.join(lookup.pieces, match, "left")
    return routed.select(*df.columns, F.coalesce("__shard", F.lit(DEFAULT_SHARD)).alias(name))


def routing_report(routed: DataFrame) -> DataFrame:
    """Records, bytes and share of the stream's records per shard; ``missed`` marks the default shard."""
    per_shard = routed.groupBy("stream_name", "shard_id").agg(
        F.count("*").alias("n_records"), F.sum("n_bytes").alias("n_bytes")
    )
    total = F.sum("n_records").over(Window.partitionBy("stream_name"))  # over one row per shard
    return per_shard.select(
        "stream_name",
        "shard_id",
        "n_records",
        "n_bytes",
        (F.col("n_records") / total).alias("share"),
        (F.col("shard_id") == DEFAULT_SHARD).alias("missed"),
    )
