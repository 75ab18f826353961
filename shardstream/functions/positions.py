"""Order of records inside a shard: by sequence number, then by sub-sequence number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD = ["stream_name", "shard_id"]


def position(sequence: str = "sequence_number", sub: str = "sub_sequence_number") -> Column:
    """A comparable struct. Sequence numbers exceed any numeric type, so they compare by length, then text.

    Records that never were part of a pack count as sub-sequence 0.
    """
    return F.struct(
        F.length(sequence).alias("width"),
        F.col(sequence).alias("sequence_number"),
        F.coalesce(F.col(sub), F.lit(0)).cast("bigint").alias("sub_sequence_number"),
    )


def order_by_position(df: DataFrame) -> DataFrame:
    """Records of each shard in order. A range sort: a hot shard is spread over many partitions."""
    where = position()
    return df.orderBy(*SHARD, where["width"], where["sequence_number"], where["sub_sequence_number"])
