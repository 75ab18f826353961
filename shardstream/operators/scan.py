"""Greedy chunking of ordered groups.

Batching, packing and grouping by count or time all walk a group in order and close the open chunk
when the next row does not fit. Where a chunk starts depends on where the last one did, which no
window function can express, so the walk is done in Python over Arrow batches. Spark does the rest:
partitioning, sorting and, for groups too large for one task, the parallel composition below.

An operator supplies a *chunk* object with

    start(key)     a new group begins
    clear()        the open chunk is closed, the next one is empty
    fits(row)      may the row join the (non-empty) open chunk?
    push(row)      add it; returns its position among the open chunk's rows that share ``place_by``
    drop_first()   forget the oldest row; returns how many rows are still held

A group larger than ``group_rows`` is cut into blocks of consecutive rows. The end of a chunk that
starts at row i depends only on rows i, i+1, ... so every block can work out, for each place its
first chunk might start, where the next block's first chunk then starts (a few rows of the next
block are looked at for this). Following these small maps from block to block gives each block its
true start, and then all blocks are chunked in parallel. Payloads are not read for the maps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import GROUP_ROWS
from .ordering import largest_group, with_ordinal


def gather(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Bring groups together, sorted, one or more groups per task.

    The number of partitions is the session's shuffle setting: what follows is Python, bound by
    rows and not by bytes, so partitions must not be merged for being small in bytes.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys, *order)


def assign_chunks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    row_columns: list[str],
    make_chunk: Callable[[], object],
    longest: int,
    number: str,
    place: str,
    place_by: list[str],
    group_rows: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Add ``number`` (chunk number in the group, from 0) and ``place`` (position in the chunk).

    ``longest`` bounds the rows of a chunk, ``order`` must be unique in a group. ``largest``, a known
    bound on the rows of a group, saves counting them; what it says decides only how the work is split.
    """
    limit = GROUP_ROWS if group_rows is None else group_rows
    largest = largest_group(df, keys) if largest is None else largest
    if largest <= limit:
        fields = [T.StructField(number, T.LongType()), T.StructField(place, T.LongType())]
        walk = lambda batches: chunk_batches(batches, keys, row_columns, make_chunk, number, place)
        return gather(df, keys, order).mapInArrow(walk, T.StructType(df.schema.fields + fields))
    blocks = assign_in_blocks(df, keys, order, row_columns, make_chunk, longest, number, limit, largest)
    in_chunk = Window.partitionBy(*keys, number, *place_by).orderBy(*order)  # at most ``longest`` rows
    return blocks.withColumn(place, F.row_number().over(in_chunk).cast("bigint") - 1)


def chunk_batches(batches, keys, row_columns, make_chunk, number, place) -> Iterator[pa.RecordBatch]:
    """Walk a sorted partition and append the chunk number and place of every row."""
    chunk = make_chunk()
    current, open_number = None, 0
    for batch in batches:
        numbers, places = [], []
        for key, row in zip(_tuples(batch, keys), _tuples(batch, row_columns)):
            if key != current:
                current, open_number = key, 0
                chunk.start(key)
            elif not chunk.fits(row):
                open_number += 1
                chunk.clear()
            places.append(chunk.push(row))
            numbers.append(open_number)
        yield _append(batch, {number: numbers, place: places})


def assign_in_blocks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    row_columns: list[str],
    make_chunk: Callable[[], object],
    longest: int,
    number: str,
    block_rows: int,
    largest: int,
) -> DataFrame:
    """Add the chunk number, with every group cut into blocks that are walked in parallel."""
    block_rows = max(block_rows, longest)
    numbered = with_ordinal(df, keys, order, "__ordinal", block_rows, largest)
    numbered = numbered.withColumn("__block", F.expr(f"__ordinal div {block_rows}"))
    slim = numbered.select(*dict.fromkeys([*keys, "__block", "__ordinal", *row_columns]))

    # every block with the rows at the start of the next one that its last chunk may reach
    own_or_ahead = F.when(
        (F.col("__block") > 0) & (F.expr(f"__ordinal % {block_rows}") <= longest),
        F.array(F.col("__block"), F.col("__block") - 1),
    ).otherwise(F.array("__block"))
    seen = slim.withColumn("__block", F.explode(own_or_ahead))
    group_fields = [df.schema[k] for k in keys] + [T.StructField("__block", T.LongType())]
    ints = T.ArrayType(T.IntegerType())
    map_schema = T.StructType(group_fields + [T.StructField("exits", ints), T.StructField("counts", ints)])
    maps = (
        gather(seen, [*keys, "__block"], ["__ordinal"])
        .mapInArrow(
            lambda batches: _block_maps(batches, keys, row_columns, make_chunk, block_rows, longest, map_schema.names),
            map_schema,
        )
    )
    start_schema = T.StructType(
        group_fields + [T.StructField("__entry", T.LongType()), T.StructField("__first", T.LongType())]
    )
    starts = (
        gather(maps, keys, ["__block"])
        .mapInArrow(lambda batches: _follow(batches, keys, start_schema.names), start_schema)
    )
    # a block's start travels as a row ahead of the block: one shuffle and no join
    rows = numbered.withColumns({"__entry": F.lit(None).cast("bigint"), "__first": F.lit(None).cast("bigint")})
    headed = rows.unionByName(starts.withColumn("__ordinal", F.lit(-1).cast("bigint")), allowMissingColumns=True)
    out = T.StructType(
        [T.StructField(f.name, f.dataType) for f in headed.schema.fields]
        + [T.StructField(number, T.LongType())]
    )
    walked = (
        gather(headed, [*keys, "__block"], ["__ordinal"])
        .mapInArrow(lambda batches: _chunk_blocks(batches, keys, row_columns, make_chunk, number), out)
    )
    return walked.select(*df.columns, number)


def next_starts(rows: list, size: int, chunk) -> list[int]:
    """For each of the first ``size`` rows: where the next chunk starts if a chunk starts there."""
    starts, end = [], 0
    chunk.clear()
    for at in range(size):
        if end == at:
            chunk.push(rows[at])
            end += 1
        while end < len(rows) and chunk.fits(rows[end]):
            chunk.push(rows[end])
            end += 1
        starts.append(end)
        end = at + 1 + chunk.drop_first()
    return starts


def _block_maps(batches, keys, row_columns, make_chunk, block_rows, longest, names):
    chunk = make_chunk()

    def finish(key, rows):
        chunk.start(key[:-1])
        size = min(block_rows, len(rows))
        starts = next_starts(rows, size, chunk)
        exits, counts = [0] * size, [0] * size
        for at in range(size - 1, -1, -1):
            after = starts[at]
            exits[at], counts[at] = (after - size, 1) if after >= size else (exits[after], counts[after] + 1)
        entries = longest if key[-1] else 1
        columns = [[k] for k in key] + [[exits[:entries]], [counts[:entries]]]
        return _batch(columns, names, [*batch_types, pa.list_(pa.int32()), pa.list_(pa.int32())])

    current, rows, batch_types = None, [], None
    for batch in batches:
        if batch_types is None:
            batch_types = [batch.schema.field(k).type for k in [*keys, "__block"]]
        for key, row in zip(_tuples(batch, [*keys, "__block"]), _tuples(batch, row_columns)):
            if key != current:
                if rows:
                    yield finish(current, rows)
                current, rows = key, []
            rows.append(row)
    if rows:
        yield finish(current, rows)


def _follow(batches, keys, names):
    current, entry, first = None, 0, 0
    for batch in batches:
        entries, firsts = [], []
        exits, counts = batch.column("exits"), batch.column("counts")
        for i, key in enumerate(_tuples(batch, keys)):
            if key != current:
                current, entry, first = key, 0, 0
            entries.append(entry)
            firsts.append(first)
            if entry < len(exits[i]):
                entry, first = exits[i][entry].as_py(), first + counts[i][entry].as_py()
            else:  # the open chunk runs over the group's whole last block
                entry = 0
        kept = [batch.column(k) for k in [*keys, "__block"]]
        yield pa.RecordBatch.from_arrays(kept + [pa.array(entries, pa.int64()), pa.array(firsts, pa.int64())], names=names)


def _chunk_blocks(batches, keys, row_columns, make_chunk, number):
    chunk = make_chunk()
    current, before, open_number, fresh = None, 0, 0, True
    for batch in batches:
        numbers, kept = [], []
        entries, firsts = batch.column("__entry").to_pylist(), batch.column("__first").to_pylist()
        keyed = zip(_tuples(batch, [*keys, "__block"]), _tuples(batch, row_columns), entries, firsts)
        for key, row, entry, first in keyed:
            if key != current:
                current, before, open_number, fresh = key, 0, 0, True
                chunk.start(key[:-1])
            kept.append(entry is None)
            if entry is not None:
                before, open_number = entry, first
            elif before:
                before -= 1
                numbers.append(open_number - 1)
            else:
                if not fresh and not chunk.fits(row):
                    open_number += 1
                    chunk.clear()
                fresh = False
                chunk.push(row)
                numbers.append(open_number)
        yield _append(batch.filter(pa.array(kept, pa.bool_())), {number: numbers})


def _tuples(batch: pa.RecordBatch, columns: list[str]):
    return zip(*(batch.column(c).to_pylist() for c in columns))


def _batch(columns, names, types):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _append(batch, columns):
    added = [pa.array(values, pa.int64()) for values in columns.values()]
    return pa.RecordBatch.from_arrays(batch.columns + added, names=batch.schema.names + list(columns))
