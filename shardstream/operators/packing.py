"""Packing many records of one partition key into one wire record, and unpacking them again."""

from __future__ import annotations

from bisect import bisect_left
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import GROUP_ROWS, Limits
from ..functions import records as R
from ..functions.wire import FRAME_BYTES, decimal_hash, decode_pack, encode_pack, field_len, record_len
from .batching import PUT
from .ordering import largest_group
from .scan import assign_chunks, assign_in_blocks, chunk_batches, gather

# Fewest bytes a record adds to a pack (no data, hash key already listed).
SMALLEST_ENTRY = record_len(0, 0)


class OpenPack:
    """The open pack of a (put, partition key): its serialized size and the hash keys it lists.

    A record without a hash key of its own has its partition key's. Hash keys are listed as first met, and
    a record is sized by the index its hash key has, or would get, in that list. Dropping the first record
    moves indices; only keys that cross an index of 128 or 16,384 then change the size of their records, so
    for each key the sum of what its records gain there is kept, and a step costs little however many keys there are.
    """

    # indices below EDGES[0] take one byte, those below EDGES[1] two
    EDGES = (1 << 7, 1 << 14)

    def __init__(self, limits: Limits):
        self.limit = limits.max_record_bytes

    def start(self, key):
        self.empty_size = FRAME_BYTES + field_len(len(key[-1].encode()))
        self.default_hash = decimal_hash(key[-1])
        self.clear()

    def clear(self):
        self.rows, self.first = deque(), 0
        self.listed: list[str] = []  # hash keys as first met
        self.places: dict[str, deque] = {}  # where the records of a hash key are
        self.gains: dict[str, list[int]] = {}  # what they gain at each edge
        self.size = self.empty_size

    def _hash(self, row):
        return self.default_hash if row[0] is None else row[0]

    def _index(self, hash_key):
        """Where a hash key stands in the list, or would stand: keys are ordered by the place of their first record."""
        at = self.places[hash_key][0]
        return bisect_left(self.listed, at, key=lambda k: self.places[k][0])

    def _added(self, row):
        hash_key = self._hash(row)
        if hash_key in self.places:
            return record_len(self._index(hash_key), row[1])
        return field_len(len(hash_key.encode())) + record_len(len(self.listed), row[1])

    def _gain(self, n_data):
        lengths = [record_len(index, n_data) for index in (0, *self.EDGES)]
        return lengths[1] - lengths[0], lengths[2] - lengths[1]

    def fits(self, row):
        return self.size + self._added(row) <= self.limit

    def push(self, row):
        self.size += self._added(row)
        hash_key = self._hash(row)
        if hash_key not in self.places:
            self.listed.append(hash_key)
            self.places[hash_key], self.gains[hash_key] = deque(), [0, 0]
        self.places[hash_key].append(self.first + len(self.rows))
        for edge, gain in enumerate(self._gain(row[1])):
            self.gains[hash_key][edge] += gain
        self.rows.append(row)
        return len(self.rows) - 1

    def drop_first(self):
        """Take the first record away; returns how many of the others still fit."""
        row = self.rows.popleft()
        hash_key = self.listed.pop(0)
        self.first += 1
        self.size -= record_len(0, row[1])
        self._forget(hash_key, row, first=True)
        index = len(self.listed)
        if hash_key in self.places:
            index = self._index(hash_key)
            self.listed.insert(index, hash_key)
        for edge, start in enumerate(self.EDGES):
            # the key at the edge moved below it, unless the dropped one's key took a place further down
            if index >= start:
                self.size -= self.gains[self.listed[start - 1]][edge] if len(self.listed) >= start else 0
                self.size += self.gains[hash_key][edge] if hash_key in self.places else 0
        while self.size > self.limit and len(self.rows) > 1:
            self._drop_last()
        return len(self.rows)

    def _drop_last(self):
        row = self.rows.pop()
        hash_key = self._hash(row)
        self.size -= record_len(self._index(hash_key), row[1])
        self._forget(hash_key, row, first=False)
        if hash_key not in self.places:
            self.listed.pop()

    def _forget(self, hash_key, row, first):
        places = self.places[hash_key]
        places.popleft() if first else places.pop()
        if not places:
            del self.places[hash_key], self.gains[hash_key]
            self.size -= field_len(len(hash_key.encode()))
            return
        for edge, gain in enumerate(self._gain(row[1])):
            self.gains[hash_key][edge] -= gain


def pack_records(
    df: DataFrame,
    limits: Limits = Limits(),
    order: str = "seq_in_put",
    group_rows: int | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Pack the records of each (put, partition key) greedily into wire records of at most the record limit.

    One row per packed record: its key and shard, ``pack_no`` within the key, ``first_seq``,
    ``n_records``, ``n_bytes`` (key and data, as for any record), ``size_bytes`` (the data), ``data``.
    A record that does not fit even alone in its frame is passed on unpacked and flagged ``oversize``.
    """
    keys = [*PUT, "partition_key"]
    slim = df.select(*keys, "shard_id", F.col(order).alias("seq_in_put"), "explicit_hash_key", "data")
    sized = slim.withColumn("__n_data", F.octet_length("data"))
    out = T.StructType(
        [
            *(df.schema[k] for k in keys),
            T.StructField("shard_id", T.StringType()),
            T.StructField("pack_no", T.LongType()),
            T.StructField("first_seq", df.schema[order].dataType),
            T.StructField("n_records", T.LongType()),
            T.StructField("size_bytes", T.LongType()),
            T.StructField("oversize", T.BooleanType()),
            T.StructField("explicit_hash_key", T.StringType()),
            T.StructField("data", T.BinaryType()),
        ]
    )
    pack, row_columns = [*keys, "pack_no"], ["explicit_hash_key", "__n_data"]
    make_chunk = lambda: OpenPack(limits)
    limit = GROUP_ROWS if group_rows is None else group_rows
    largest = largest_group(df, keys) if largest is None else largest
    if largest <= limit:  # number and build in one pass over the sorted groups

        def build(batches):
            numbered = chunk_batches(batches, keys, row_columns, make_chunk, "pack_no", "__place")
            return _build_packs(numbered, pack, limits.max_record_bytes, out.names)

        return R.with_payload_size(gather(sized, keys, ["seq_in_put"]).mapInArrow(build, out))
    longest = limits.max_record_bytes // SMALLEST_ENTRY + 1
    numbered = assign_in_blocks(sized, keys, ["seq_in_put"], row_columns, make_chunk, longest, "pack_no", limit, largest)
    together = gather(numbered, pack, ["seq_in_put"])  # a pack may begin in one block and end in the next
    packed = together.mapInArrow(lambda batches: _build_packs(batches, pack, limits.max_record_bytes, out.names), out)
    return R.with_payload_size(packed)


def packed_sizes(
    df: DataFrame, limits: Limits = Limits(), order: str = "seq_in_put", group_rows: int | None = None
) -> DataFrame:
    """Add to each record its ``pack_no`` and ``packed_size``: the bytes it adds to its pack.

    The first record of a pack also pays for the partition key; each hash key is paid for once.
    """
    keys, row_columns = [*PUT, "partition_key"], ["explicit_hash_key", "__n_data"]
    sized = df.withColumn("__n_data", F.octet_length("data"))
    numbered = assign_chunks(
        sized,
        keys,
        [order],
        row_columns,
        lambda: OpenPack(limits),
        longest=limits.max_record_bytes // SMALLEST_ENTRY + 1,
        number="pack_no",
        place="__place",
        place_by=[],
        group_rows=group_rows,
    ).drop("__place")
    pack = [*keys, "pack_no"]
    schema = T.StructType([*numbered.schema.fields, T.StructField("packed_size", T.LongType())])
    measured = gather(numbered, pack, [order]).mapInArrow(lambda batches: _measure(batches, pack, row_columns, limits), schema)
    return measured.drop("__n_data")


def _measure(batches, pack, row_columns, limits):
    chunk, current = OpenPack(limits), None
    for batch in batches:
        sizes = []
        keys = zip(*(batch.column(c).to_pylist() for c in pack))
        for key, row in zip(keys, zip(*(batch.column(c).to_pylist() for c in row_columns))):
            before = chunk.size if key == current else FRAME_BYTES
            if key != current:
                current = key
                chunk.start(key[:-1])
            chunk.push(row)
            sizes.append(chunk.size - before)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "packed_size"])


def _build_packs(batches, pack, limit, names):
    current, shard, first, records, types = None, None, None, [], None

    def finish():
        *key, pack_no = current
        partition_key = key[-1]
        default = decimal_hash(partition_key)
        data = encode_pack(partition_key, [(default if h is None else h, d) for h, d in records])
        oversize, explicit_hash = len(data) > limit, None
        if oversize:
            explicit_hash, data = records[0]
        values = [*key, shard, pack_no, first, len(records), len(data), oversize, explicit_hash, data]
        return values

    def flush(rows):
        arrays = [pa.array(column, t) for column, t in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    done, done_bytes = [], 0
    for batch in batches:
        if types is None:
            key_types = [batch.schema.field(k).type for k in pack[:-1]]
            seq_type = batch.schema.field("seq_in_put").type
            types = [*key_types, pa.string(), pa.int64(), seq_type, pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.binary()]
        columns = [batch.column(c).to_pylist() for c in ["shard_id", "seq_in_put", "explicit_hash_key"]]
        data = batch.column("data")
        for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in pack))):
            if key != current:
                if records:
                    done.append(finish())
                    done_bytes += done[-1][-4] if done[-1][-4] else 0
                current, shard, first, records = key, columns[0][i], columns[1][i], []
            records.append((columns[2][i], data[i].as_py()))
            if len(done) >= 1000 or done_bytes > 8 << 20:
                yield flush(done)
                done, done_bytes = [], 0
    if records:
        done.append(finish())
    if done:
        yield flush(done)


OPENED = T.StructType(
    [
        T.StructField("error", T.StringType()),
        T.StructField(
            "records",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("partition_key", T.StringType()),
                        T.StructField("explicit_hash_key", T.StringType()),
                        T.StructField("data", T.BinaryType()),
                    ]
                )
            ),
        ),
    ]
)


def unpack_records(df: DataFrame, on_error: str = "fail", verify_digest: bool = False) -> DataFrame:
    """Packed consumer records become one row per inner record; all other records pass unchanged.

    Inner records inherit every other column and are numbered by ``sub_sequence_number``. The rows are
    read once; only the data of packed ones leaves the JVM. A malformed pack fails the query, or with
    ``on_error='quarantine'`` stays as it is with the reason in ``unpack_error``. The digest is checked
    only if asked.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error is 'fail' or 'quarantine'")
    quarantine = on_error == "quarantine"
    packed = R.is_aggregated()
    if verify_digest:
        body = F.expr(f"substring(data, {len(R.MAGIC) + 1}, octet_length(data) - {FRAME_BYTES})")
        digest = F.lower(F.hex(F.substring("data", -R.DIGEST_BYTES, R.DIGEST_BYTES)))
        intact = F.when(packed, F.md5(body) == digest)
    else:
        intact = F.lit(True)
    decode = F.arrow_udf(lambda data, good: _open_packs(data, good, quarantine), OPENED)
    opened = df.withColumn("__opened", decode(F.when(packed, F.col("data")), intact))
    rows = opened.select("*", F.posexplode_outer("__opened.records").alias("__sub", "__inner"))
    is_inner, error = F.col("__inner").isNotNull(), F.col("__opened.error")
    # a pack may hold no records at all; then nothing is left of it
    rows = rows.filter(is_inner | F.col("__opened").isNull() | error.isNotNull())
    fresh = {
        "data": F.col("__inner.data"),
        "partition_key": F.col("__inner.partition_key"),
        "explicit_hash_key": F.col("__inner.explicit_hash_key"),
        "sub_sequence_number": F.col("__sub").cast(df.schema["sub_sequence_number"].dataType),
    }
    columns = [F.when(is_inner, fresh[c]).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c) for c in df.columns]
    return rows.select(*columns, *([error.alias("unpack_error")] if quarantine else []))


def _open_packs(data: pa.Array, intact: pa.Array, quarantine: bool) -> pa.Array:
    """The records of each packed value; null stays null."""
    opened = []
    for value, good in zip(data, intact.to_pylist()):
        if not value.is_valid:
            opened.append(None)
            continue
        try:
            if not good:
                raise ValueError("digest does not match")
            names = ("partition_key", "explicit_hash_key", "data")
            opened.append({"error": None, "records": [dict(zip(names, record)) for record in decode_pack(value.as_py())]})
        except ValueError as problem:
            if not quarantine:
                raise
            opened.append({"error": str(problem), "records": None})
    inner = pa.struct([("partition_key", pa.string()), ("explicit_hash_key", pa.string()), ("data", pa.binary())])
    return pa.array(opened, pa.struct([("error", pa.string()), ("records", pa.list_(inner))]))
