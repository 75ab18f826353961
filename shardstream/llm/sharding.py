"""Sharding by minimax contiguous partition: the smallest feasible capacity over ordered atomic groups, then cuts there."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_checked, materialize
from .words import text_bytes

ROW_BYTES = 8
# The line of group hashes is first seen as 2**LINE_BITS cells; cells near a cut are split into 2**PART_BITS, again and again.
LINE_BITS = 14
PART_BITS = 8
# A cell of several groups that holds more than this part of a shard is split before anything else.
COARSE = 64
# Rows of a shard that one task numbers.
RUN_ROWS = 20_000


class Cells:
    """Cells of a line in order: (first place, bits of places it spans, size, whether it is one atomic group)."""

    def __init__(self, cells: list[tuple[int, int, int, bool]]):
        self.cells = sorted(cells)
        self.ends = [0]
        for _, _, size, _ in self.cells:
            self.ends.append(self.ends[-1] + size)

    def reach(self, start: int, capacity: int, whole: bool) -> tuple[int, int]:
        """How far a shard gets that begins at offset ``start``, and the cell in which it ends.

        ``whole`` keeps every cell in one piece; otherwise a cell of several groups is cut anywhere,
        which no real cut can beat.
        """
        most = start + capacity
        at = bisect_right(self.ends, most) - 1
        if at == len(self.cells):
            return self.ends[-1], at
        if whole or self.cells[at][3]:
            return max(self.ends[at], start), at
        return most, at

    def greedy(self, capacity: int, shards: int, whole: bool) -> list[int] | None:
        """The ends of the shards when each takes as much as fits, or None if that leaves a rest."""
        start, ends = 0, []
        for _ in range(shards):
            start, _ = self.reach(start, capacity, whole)
            ends.append(start)
        return ends if start == self.ends[-1] else None

    def least(self, shards: int, whole: bool) -> int:
        """The smallest feasible capacity, by binary search with the greedy check."""
        low, high = -(-self.ends[-1] // shards) - 1, self.ends[-1]
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if self.greedy(middle, shards, whole) else (middle, high)
        return high

    def in_doubt(self, shards: int) -> list[int]:
        """Cells of several groups that may hold a cut of the best partition; none if that is already known.

        The capacity with cells cut anywhere and the one with cells kept whole enclose the true one, and
        so do the places that the greedy check reaches with them.
        """
        low = self.least(shards, False)
        coarse = [i for i, c in enumerate(self.cells) if not c[3] and c[2] * COARSE > low]
        if coarse:
            return coarse
        high, near, far, found = self.least(shards, True), 0, 0, set()
        for _ in range(shards):
            near, first = self.reach(near, low, True)
            far, last = self.reach(far, high, False)
            found.update(i for i in range(first, min(last + 1, len(self.cells))) if not self.cells[i][3])
        return sorted(found)


def minimax_cuts(groups: DataFrame, shards: int) -> list[int]:
    """The first places of shards 1, 2, ... that make the largest shard least.

    ``groups`` has one row per atomic group: place (a signed 64-bit hash, distinct) and size. The groups
    stay in Spark; the driver sees sums over cells, at first 2**LINE_BITS, then finer ones near the cuts.
    """

    def seen(rows: DataFrame, bits: int) -> list[tuple[int, int, int, bool]]:
        sums = rows.groupBy(F.shiftright("place", bits).alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        return [(r["cell"] << bits, bits, r["size"], r["n"] == 1) for r in sums.collect()]

    line = Cells(seen(groups, 64 - LINE_BITS))
    while split := set(line.in_doubt(shards)):
        finer = [c for i, c in enumerate(line.cells) if i not in split]
        for bits in {line.cells[i][1] for i in split}:
            wanted = [line.cells[i][0] >> bits for i in split if line.cells[i][1] == bits]
            finer += seen(groups.filter(F.shiftright("place", bits).isin(wanted)), max(bits - PART_BITS, 0))
        line = Cells(finer)
    ends = line.greedy(line.least(shards, True), shards, True)
    starts = dict(zip(line.ends, (c[0] for c in line.cells)))
    return [starts[end] for end in ends[:-1] if end in starts]


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """Documents in contiguous shards of near equal bytes: doc_id, size, text_crc32, place, shard, slot.

    The atomic groups are documents of equal text, ordered by a 64-bit hash of the text (two texts of
    one hash would only share a group). A size is the UTF-8 bytes of the text plus ROW_BYTES. Slots
    number the rows of a shard from 0 without gaps. Null texts are one group of size ROW_BYTES a row,
    apart from that of empty texts; repeated rows get slots of their own; a group larger than a fair share
    fills a shard and later shards may stay empty; an empty table gives no rows; a text of any length is one number in all that
    follows; other columns are not read. The text is read once;
    all else works on six numbers a row. Rows of a shard are numbered in runs dealt by a hash of the
    row's stored number, so that a hot group, also of rows that are all the same, is spread over many tasks.
    """
    place = F.when(F.col("text").isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64("text"))
    rows = materialize(docs.select(
        "doc_id", (F.length(text_bytes()) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text_bytes()).alias("text_crc32"), place.alias("place"), F.monotonically_increasing_id().alias("row"),
    ))
    groups = materialize(rows.groupBy("place").agg(F.sum("size").alias("size"), F.count("*").alias("rows")))
    total = groups.agg(F.sum("rows")).first()[0] or 0
    shard = sum((F.col("place") >= F.lit(cut)).cast("int") for cut in (minimax_cuts(groups, shards) if total else []))
    runs = max(1, -(-total // (shards * RUN_ROWS)))
    run = F.pmod(F.xxhash64("row"), F.lit(runs))
    dealt = rows.withColumn("shard", F.lit(0) if isinstance(shard, int) else shard).withColumn("run", run)
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "run").count().select("shard", "run", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    within = F.row_number().over(Window.partitionBy("shard", "run").orderBy("row")) - 1
    numbered = dealt.withColumn("within", within).join(broadcast_checked(materialize(starts)), ["shard", "run"])
    return numbered.select("doc_id", "size", "text_crc32", "place", "shard", (F.col("first") + F.col("within")).alias("slot"))
