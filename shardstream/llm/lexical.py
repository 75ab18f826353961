"""Exact ranked lexical search over an index whose documents are grouped by their length normaliser."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .words import WORDS, alnum_words, pass_over, some_at_a_time, text_bytes

K = 10
# Parts of the normaliser in hundredths, and the scales of weights and of impacts.
FLAT, SLOPE = 25, 75
WEIGHT, IMPACT, TF, NORM = 1000, 1_000_000_000, 1000, 8

# Items whose texts come to more bytes than this are searched in several passes over the documents.
SLICE_BYTES = 4 << 20
# Documents of one block of a stratum, and bytes of a text that are split into words at once.
BLOCK_DOCS, CHUNK_BYTES = 2048, 4 << 20
# Blocks that are searched first for each item, those with the highest bounds, to learn a score that the others have to reach.
FIRST_BLOCKS = 4


class Queries:
    """A slice of the items: their distinct terms are numbered; each item is a list of term numbers with repeats as factors."""

    def __init__(self, items: list[tuple]):
        self.ids, self.number, self.terms, self.times = [], {}, [], []
        for item_id, data in items:
            counted = Counter(alnum_words(data))
            if counted:
                self.ids.append(item_id)
                self.terms.append(np.array([self.number.setdefault(t, len(self.number)) for t in counted], np.int64))
                self.times.append(np.array(list(counted.values()), np.int64))

    def weigh(self, documents: int, holding: dict[int, int]) -> None:
        """Weights of all terms, from the numbers of documents with a term at all and of those that hold each."""
        weights = np.zeros(len(self.number), np.int64)
        for term in range(len(weights)):
            weights[term] = math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * holding.get(term, 0) + 1)))
        self.weights = [times * weights[terms] for terms, times in zip(self.terms, self.times)]
        self.flat = np.concatenate(self.terms), np.concatenate(self.weights)
        self.starts = np.concatenate([[0], np.cumsum([len(t) for t in self.terms])[:-1]])


def _slices(items: DataFrame, item_id: str, slice_bytes: int) -> Iterator[Queries]:
    """The distinct items, in slices of about ``slice_bytes`` of text."""
    narrow = materialize(items.select(F.col(item_id).alias("item"), text_bytes().alias("data")).distinct())
    parts = max(-(-(narrow.agg(F.sum(F.length("data"))).first()[0] or 0) // slice_bytes), 1)
    at = F.pmod(F.xxhash64("item", "data"), F.lit(parts))
    for part in range(parts):
        yield Queries([(r[0], bytes(r[1])) for r in narrow.filter(at == part).orderBy("item", "data").collect()])


def _split(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some MB at a time; a term is never cut."""
    data = data.translate(WORDS)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + CHUNK_BYTES)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _counted(docs: DataFrame, doc_id: str, number: dict[bytes, int]) -> DataFrame:
    """For each document its row, number of terms, and which numbered terms it holds how often."""

    def run(parts: Iterable[dict]) -> Iterator[dict]:
        get, size = number.get, len(number)
        row = TaskContext.get().partitionId() << 40
        for part in parts:
            for datas, ids in some_at_a_time(part["data"], part["doc_id"]):
                lengths, owners, codes = [], [], []
                for at, data in enumerate(datas):
                    n = 0
                    for words in _split(data):
                        n += len(words)
                        found = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                        codes.append(found[found >= 0])
                        owners.append(np.full(len(codes[-1]), at, np.int64))
                    lengths.append(n)
                places = np.concatenate([*owners, np.empty(0, np.int64)]) * size + np.concatenate([*codes, np.empty(0, np.int64)])
                places, times = np.unique(places, return_counts=True)
                owner = places // max(size, 1)
                cuts = np.searchsorted(owner, np.arange(len(datas) + 1)) * 4
                terms, times = (places % max(size, 1)).astype("<u4").tobytes(), times.astype("<u4").tobytes()
                yield {
                    "doc_id": pa.array(ids, part["doc_id"].type), "row": range(row, row + len(datas)), "n": lengths,
                    "terms": [terms[a:b] for a, b in zip(cuts, cuts[1:])], "times": [times[a:b] for a, b in zip(cuts, cuts[1:])],
                }
                row += len(datas)

    columns = {"doc_id": F.col(doc_id), "data": text_bytes()}
    return pass_over(docs, columns, "doc_id void, row long, n long, terms binary, times binary", run)


def _holding(counted: DataFrame, size: int) -> dict[int, int]:
    """For each numbered term the documents that hold it; summed in each task first."""

    def run(parts: Iterable[dict]) -> Iterator[dict]:
        total = np.zeros(size, np.int64)
        for part in parts:
            terms = np.frombuffer(b"".join(part["terms"].to_pylist()), "<u4")
            total += np.bincount(terms, minlength=size)
        held = np.flatnonzero(total)
        yield {"term": held, "n": total[held]}

    sums = pass_over(counted, {"terms": F.col("terms")}, "term long, n long", run).groupBy("term").agg(F.sum("n"))
    return {term: n for term, n in sums.collect()}  # a row for each term of the slice at most


def _indexed(counted: DataFrame, documents: int, terms: int) -> DataFrame:
    """The index: blocks of documents with one normaliser m, each with its postings by term and frequency.

    ``terms``, ``tfs``, ``sizes`` say what each group of postings is and how long, ``places`` are the documents, by their place in
    ``docs``, which is sorted. A stratum of many documents is cut into blocks, over as many tasks as its share.
    """
    kind = counted.schema["doc_id"].dataType
    norm = F.expr(f"{FLAT}L + ({SLOPE}L * n * {documents}L) div {max(terms, 1)}L")
    held = counted.filter("length(terms) > 0").select("doc_id", "row", norm.alias("m"), "terms", "times")
    ordered = held.repartitionByRange("m", "row").sortWithinPartitions("m", "row")
    schema = T.StructType.fromDDL("m long, block long, docs array<long>, terms binary, tfs binary, sizes binary, places binary")
    schema = T.StructType([T.StructField("docs", T.ArrayType(kind)) if f.name == "docs" else f for f in schema.fields])

    def block(m: int, number: int, ids: list, terms: list[bytes], times: list[bytes]) -> dict:
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))
        place = np.repeat(np.arange(len(ids)), [len(terms[i]) // 4 for i in order])
        term, tf = (np.frombuffer(b"".join(x[i] for i in order), "<u4") for x in (terms, times))
        by = np.lexsort((place, tf, term))
        place, term, tf = place[by], term[by], tf[by]
        starts = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])]))
        sizes = np.diff(np.append(starts, len(term)))
        return {
            "m": m, "block": number, "docs": [ids[i] for i in order], "terms": term[starts].tobytes(), "tfs": tf[starts].tobytes(),
            "sizes": sizes.astype("<u4").tobytes(), "places": place.astype("<u2").tobytes(),
        }

    def run(parts: Iterable[dict]) -> Iterator[dict]:
        number, m, held, size, done = TaskContext.get().partitionId() << 40, None, ([], [], []), 0, []
        for part in parts:
            for row in zip(*[part[c].to_pylist() for c in ("m", "doc_id", "terms", "times")]):
                if held[0] and (row[0] != m or len(held[0]) == BLOCK_DOCS or size > CHUNK_BYTES):
                    done.append(block(m, number, *held))
                    number, held, size = number + 1, ([], [], []), 0
                m = row[0]
                for column, value in zip(held, row[1:]):
                    column.append(value)
                size += len(row[2])
            if done:
                yield {name: [d[name] for d in done] for name in done[0]}
                done = []
        if held[0]:
            done.append(block(m, number, *held))
            yield {name: [d[name] for d in done] for name in done[0]}

    return pass_over(ordered, {c: F.col(c) for c in ("m", "doc_id", "terms", "times")}, schema, run)


class Block:
    """A block of the index as its visitors read it; the impact of a frequency is computed once."""

    def __init__(self, m: int, terms: bytes, tfs: bytes, size: int):
        self.term, tf = np.frombuffer(terms, "<u4"), np.frombuffer(tfs, "<u4")
        kinds, which = np.unique(tf, return_inverse=True)
        kinds = kinds.astype(np.int64)
        self.impact = ((IMPACT * kinds) // (TF * kinds + NORM * m))[which]
        # frequencies ascend within a term, and impacts with them: the last group of a term bounds it
        last = np.append(self.term[1:] != self.term[:-1], True)
        self.best = np.zeros(size, np.int64)
        self.best[self.term[last]] = self.impact[last]

    def bounds(self, queries: Queries) -> np.ndarray:
        """For each item the highest score that a document of the block might have."""
        terms, weights = queries.flat
        return np.add.reduceat(weights * self.best[terms], queries.starts)

    def load(self, sizes: bytes, places: bytes, docs: int) -> None:
        sizes = np.frombuffer(sizes, "<u4")
        self.places, self.docs = np.frombuffer(places, "<u2"), docs
        self.each = np.repeat(self.impact, sizes)
        ends, groups = np.cumsum(sizes, dtype=np.int64), np.searchsorted(self.term, np.arange(len(self.best) + 1))
        edges = np.concatenate([[0], ends])[groups]
        self.begin, self.end = edges[:-1], edges[1:]

    def scores(self, terms: np.ndarray, weights: np.ndarray, floor: int) -> np.ndarray | None:
        """Scores of the block's documents, or None once no document can reach ``floor``.

        Terms go by what they can add at most; as soon as the best sum and all that is left come to less, the block is left.
        """
        gains = weights * self.best[terms]
        order = np.argsort(-gains)
        left = int(gains.sum())
        total = np.zeros(self.docs, np.int64)
        for step, at in enumerate(order.tolist()):
            if gains[at] == 0:
                break
            if step and step % 4 == 0 and int(total.max()) + left < floor:
                return None
            begin, end = self.begin[terms[at]], self.end[terms[at]]
            total[self.places[begin:end]] += weights[at] * self.each[begin:end]
            left -= int(gains[at])
        return total


class Best:
    """The best documents of each item so far, and the score that another one has to reach."""

    def __init__(self, items: int, k: int, floors: list[int]):
        self.k, self.rows, self.floors = k, [[] for _ in range(items)], list(floors)

    def take(self, item: int, scores: np.ndarray, docs: list) -> None:
        good = np.flatnonzero(scores >= self.floors[item])
        if len(good) > self.k:  # places are in the order of ids, so a stable sort keeps the smaller of equal scores
            good = good[np.argsort(-scores[good], kind="stable")[: self.k]]
        rows = self.rows[item] + [(-int(scores[i]), docs[i] is None, docs[i]) for i in good.tolist()]
        rows.sort(key=lambda r: r if not r[1] else r[:2])
        self.rows[item] = rows[: self.k]
        if len(self.rows[item]) == self.k:
            self.floors[item] = max(self.floors[item], -self.rows[item][-1][0])


def _searched(index: DataFrame, queries: Queries, k: int, floors: list[int], chosen: dict[int, list[int]] | None = None) -> DataFrame:
    """The best documents of each task: item_no, doc_id, score. With ``chosen`` only those blocks are visited, for those items.

    Blocks come a batch at a time; the items visit a batch's blocks in the order of their bounds, and leave out those below their floor.
    """
    kind = index.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("item_no", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def run(parts: Iterable[dict]) -> Iterator[dict]:
        best, everyone = Best(len(queries.ids), k, floors), range(len(queries.ids))
        for part in parts:
            blocks, visits = [], []
            for at, (m, number, terms, tfs) in enumerate(zip(*[part[c].to_pylist() for c in ("m", "block", "terms", "tfs")])):
                blocks.append(Block(m, terms, tfs, len(queries.number)))
                bounds = blocks[-1].bounds(queries).tolist()
                items = everyone if chosen is None else chosen[number]
                visits += [(-bounds[i], at, i) for i in items if bounds[i] >= best.floors[i]]
            visits.sort()
            for bound, at, item in visits:
                if -bound < best.floors[item]:
                    continue
                block = blocks[at]
                if not hasattr(block, "each"):
                    block.load(part["sizes"][at].as_py(), part["places"][at].as_py(), len(part["docs"][at]))
                    block.ids = part["docs"][at].as_py()
                scores = block.scores(queries.terms[item], queries.weights[item], best.floors[item])
                if scores is not None:
                    best.take(item, scores, block.ids)
        rows = [(item, doc, -score) for item in everyone for score, _, doc in best.rows[item]]
        yield {"item_no": [r[0] for r in rows], "doc_id": [r[1] for r in rows], "score": [r[2] for r in rows]}

    return pass_over(index, {c: F.col(c) for c in index.columns}, schema, run)


def _first_blocks(index: DataFrame, queries: Queries) -> dict[int, list[int]]:
    """The blocks with the highest bounds of each item: {block: items}. Each task names its own; only their bounds are read."""

    def run(parts: Iterable[dict]) -> Iterator[dict]:
        top: list[list[tuple[int, int]]] = [[] for _ in queries.ids]
        for part in parts:
            for m, number, terms, tfs in zip(*[part[c].to_pylist() for c in ("m", "block", "terms", "tfs")]):
                for item, bound in enumerate(Block(m, terms, tfs, len(queries.number)).bounds(queries).tolist()):
                    held = top[item]
                    if len(held) < FIRST_BLOCKS or bound > held[-1][0]:
                        held.append((bound, number))
                        held.sort(reverse=True)
                        del held[FIRST_BLOCKS:]
        rows = [(item, bound, number) for item, held in enumerate(top) for bound, number in held]
        yield {"item_no": [r[0] for r in rows], "bound": [r[1] for r in rows], "block": [r[2] for r in rows]}

    named = pass_over(index, {c: F.col(c) for c in ("m", "block", "terms", "tfs")}, "item_no int, bound long, block long", run)
    by = Window.partitionBy("item_no").orderBy(F.desc("bound"), "block")
    rows = named.withColumn("at", F.row_number().over(by)).filter(F.col("at") <= FIRST_BLOCKS).collect()
    chosen: dict[int, list[int]] = {}
    for r in rows:
        chosen.setdefault(r["block"], []).append(r["item_no"])
    return chosen


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", item_id: str = "item_id", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank (from 1), doc_id, score; equal scores by ascending doc_id.

    Terms are lower-cased (A-Z) runs of letters, digits and non-ASCII characters of whole texts, which are read in parts if they are
    long. Scores are integers: the sum over an item's terms of weight times impact. Exact: what is left out is proved to be
    below the score of the k-th. Every row is a document, also rows with equal ids; documents without an id come last among equal
    scores. Equal rows of ``items`` are one item; an id with several texts is ranked for each. Null or empty texts have no terms:
    such documents are never found, such items find nothing. Empty tables give no rows. Other columns are not looked at.

    The index holds the terms of the items only. Its strata are the documents of one normaliser, in blocks of at most
    BLOCK_DOCS; a block's postings stand by term and frequency. For each item the FIRST_BLOCKS blocks with the highest bounds are
    searched first; the k-th score found there goes along to all others, most of which end early by their bounds. Items are shared with
    the tasks in slices of about ``slice_bytes`` of text; more slices, more passes over the documents.
    """
    spark, whole = docs.sparkSession, None
    out = T.StructType(
        [T.StructField("item_id", items.schema[item_id].dataType), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("score", T.LongType())]
    )
    for queries in _slices(items, item_id, slice_bytes):
        counted = materialize(_counted(docs, doc_id, queries.number))
        documents, terms = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not queries.ids or not documents:
            continue
        queries.weigh(documents, _holding(counted, len(queries.number)))
        index = materialize(_indexed(counted, documents, terms))
        floors = [1] * len(queries.ids)
        chosen = _first_blocks(index, queries)
        near = _ranked(_searched(index.filter(F.col("block").isin(list(chosen))), queries, k, floors, chosen), k)
        for r in near.filter(F.col("rank") == k).select("item_no", "score").collect():
            floors[r["item_no"]] = max(r["score"], 1)
        best = _ranked(_searched(index, queries, k, floors), k)
        names = spark.createDataFrame(list(enumerate(queries.ids)), T.StructType([T.StructField("item_no", T.IntegerType()), out.fields[0]]))
        best = best.join(F.broadcast(names), "item_no").select(*out.names)  # items of one slice
        whole = best if whole is None else whole.unionByName(best)
    return spark.createDataFrame([], out) if whole is None else whole
