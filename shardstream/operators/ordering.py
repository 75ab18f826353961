"""Dense row numbers per group that hold for groups of any size."""

from __future__ import annotations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import GROUP_ROWS
from ..session import broadcast_checked, materialize


def largest_group(df: DataFrame, keys: list[str]) -> int:
    """Rows of the largest group; counted with map-side combine over the key columns only."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def with_ordinal(
    df: DataFrame, keys: list[str], order: list[str], name: str = "ordinal", group_rows: int = GROUP_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Number the rows of each group from 0 in the given order.

    Groups of at most ``group_rows`` rows are numbered by a window function. If any group is larger,
    the rows are range-sorted by group and order, which spreads a hot group over many partitions:
    each task numbers the rows it holds, and adds how many rows of the group lie in earlier tasks.
    ``largest``, a known bound on the rows of a group, saves counting them.
    """
    if (largest_group(df, keys) if largest is None else largest) <= group_rows:
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn(name, ranked.cast("bigint") - 1)

    schema = T.StructType(df.schema.fields + [T.StructField("__part", T.IntegerType()), T.StructField("__at", T.LongType())])
    spread = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    # the sampled range bounds must not move between the two uses below
    local = materialize(spread.mapInArrow(lambda batches: _number_locally(batches, keys), schema))
    runs = local.groupBy(*keys, "__part").agg((F.max("__at") + 1).alias("__rows"))
    per_group = Window.partitionBy(*keys)
    earlier = per_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    # only groups that cross a partition border: at most two rows per partition
    crossing = (
        runs.withColumn("__parts", F.count("*").over(per_group))
        .withColumn("__before", F.sum("__rows").over(earlier))
        .filter("__parts > 1 AND __before IS NOT NULL")
    )
    crossing = crossing.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__part").alias("__p"), "__before")
    same = F.col("__part") == F.col("__p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    joined = local.join(broadcast_checked(crossing), same, "left")
    return joined.select(*df.columns, (F.col("__at") + F.coalesce("__before", F.lit(0))).alias(name))


def _number_locally(batches, keys):
    part = TaskContext.get().partitionId()
    current, at = None, -1
    for batch in batches:
        numbers = []
        for key in zip(*(batch.column(k).to_pylist() for k in keys)):
            at = at + 1 if key == current else 0
            current = key
            numbers.append(at)
        added = [pa.array([part] * len(numbers), pa.int32()), pa.array(numbers, pa.int64())]
        yield pa.RecordBatch.from_arrays(batch.columns + added, names=batch.schema.names + ["__part", "__at"])
