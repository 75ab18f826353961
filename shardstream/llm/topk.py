"""Exact top-k search by inner product: a ball tree per shard, branch and bound with a shared k-th score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

K = 20
LEAF = 256
# Vectors in a shard and queries in a block: what one task holds.
SHARD_ROWS = 8192
BLOCK_ROWS = 1024
# Blocks of queries that one task gets with its shard.
TASK_BLOCKS = 64


class BallTree:
    """Balls over integer vectors. Node n has children 2n+1 and 2n+2; the leaves are slices of the reordered rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.depth = max(0, int(np.ceil(np.log2(max(1, len(ids) / LEAF)))))
        order = np.arange(len(ids))
        spans = [(0, len(ids))]
        for _ in range(self.depth):
            spans = [half for span in spans for half in self._halves(vectors, order, *span)]
        self.spans = spans
        self.ids, self.vectors = ids[order], vectors[order]
        floats, nodes = self.vectors.astype(np.float64), (1 << (self.depth + 1)) - 1
        self.centers, self.radii = np.zeros((nodes, vectors.shape[1])), np.full(nodes, -np.inf)
        level = spans
        for d in range(self.depth, -1, -1):
            for i, (a, b) in enumerate(level):
                if b > a:
                    node = (1 << d) - 1 + i
                    self.centers[node] = floats[a:b].mean(0)
                    self.radii[node] = np.sqrt(((floats[a:b] - self.centers[node]) ** 2).sum(1).max())
            level = [(level[i][0], level[i + 1][1]) for i in range(0, len(level), 2)] if d else level

    @staticmethod
    def _halves(vectors, order, a, b):
        middle = (a + b) // 2
        if b - a > 1:
            part = vectors[order[a:b]].astype(np.float64)
            far = ((part - part.mean(0)) ** 2).sum(1).argmax()
            other = ((part - part[far]) ** 2).sum(1).argmax()
            order[a:b] = order[a:b][np.argsort(part @ (part[other] - part[far]), kind="stable")]
        return (a, middle), (middle, b)

    def bounds(self, queries: np.ndarray, norms: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """No row below the nodes scores higher with the queries; the slack covers rounding."""
        bound = queries @ self.centers[nodes].T + norms[:, None] * self.radii[nodes]
        return bound + 1e-9 * (np.abs(bound) + norms[:, None] + 1)

    def search(self, own: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, ids) of each query among rows not its own; those below ``floor`` may be left out.

        Each query goes down only where the bound reaches its current k-th score, from the best leaf on.
        """
        n, none = len(queries), np.iinfo(np.int64).min
        floats = queries.astype(np.float64)
        norms = np.sqrt((floats**2).sum(1))
        scores, ids = np.full((n, k), none), np.full((n, k), np.iinfo(np.int64).max)
        kth = np.maximum(floor.astype(np.float64), -np.inf)
        alive = np.ones((n, 1), bool)
        for d in range(self.depth + 1):  # subtrees whose bound is below the floor go with all that is in them
            nodes = np.arange((1 << d) - 1, (1 << (d + 1)) - 1)
            bound = np.where(alive if d == 0 else np.repeat(alive, 2, axis=1), self.bounds(floats, norms, nodes), -np.inf)
            alive = bound >= kth[:, None]
        order = np.argsort(-bound, axis=1, kind="stable")
        exact = np.abs(self.vectors).max(initial=0) * float(np.abs(queries).max(initial=0)) * max(1, queries.shape[1]) < 2.0**53
        for turn in range(order.shape[1]):
            leaf = order[:, turn]
            going = np.flatnonzero((bound[np.arange(n), leaf] >= kth) & np.isfinite(bound[np.arange(n), leaf]))
            if not len(going):
                break
            for one in np.unique(leaf[going]):
                who, (a, b) = going[leaf[going] == one], self.spans[one]
                if exact:
                    got = (floats[who] @ self.vectors[a:b].T.astype(np.float64)).astype(np.int64)
                else:
                    got = queries[who] @ self.vectors[a:b].T
                mine = self.ids[a:b][None, :] == own[who][:, None]
                useful = ((got >= kth[who][:, None]) & ~mine).any(1)
                if not useful.any():
                    continue
                who, got, mine = who[useful], got[useful], mine[useful]
                got, at = np.where(mine, none, got), np.where(mine, np.iinfo(np.int64).max, self.ids[a:b][None, :])
                scores[who], ids[who] = best(np.hstack([scores[who], got]), np.hstack([ids[who], at]), k)
                kth[who] = np.maximum(kth[who], np.where(scores[who, k - 1] == none, -np.inf, scores[who, k - 1].astype(np.float64)))
        return scores, ids


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores of each row, ties to smaller ids."""
    by_id = np.argsort(ids, axis=1, kind="stable")
    by_score = np.argsort(~np.take_along_axis(scores, by_id, 1), axis=1, kind="stable")  # ~x falls as x grows, without overflow
    order = np.take_along_axis(by_id, by_score, 1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def lattice(vector: str = "embedding"):
    """Each component x as floor(64 x), x as double; null for vectors that take no part."""
    usable = F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * 64).cast("bigint")))


def top_k(vectors: DataFrame, is_query, k: int = K, vector: str = "embedding") -> DataFrame:
    """The k rows of highest integer inner product for each query: query_id, rank, vec_id, score.

    ``is_query`` is a column that marks the queries; candidates are all rows but the query's own, ties go to the
    smaller vec_id. Null vectors, vectors with null or non-finite components and rows without vec_id take no part; of
    rows that repeat a vec_id the smallest vector counts; vectors are only compared with vectors of their length; scores
    are 64-bit, so components are expected below 2**31. With fewer than k candidates all are returned; an empty table
    gives no rows. Columns but ``is_query``'s, vec_id and the vector are not read.

    The rows are dealt into shards by a hash of their id, the queries into blocks. A block first searches one shard of
    its own, and the k-th scores found there go with it as floors to all other shards, where they prune from the
    start. A task holds one shard and at most TASK_BLOCKS blocks; beyond that the shard goes to several tasks.
    """
    spark = vectors.sparkSession
    usable = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), lattice(vector).alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    once = usable.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("size", F.size("v")).withColumn("query", is_query)
    rows = materialize(once)
    counts = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("query"), 1)).alias("q")).first()
    shards, blocks = max(1, -(-counts["n"] // SHARD_ROWS)), max(1, -(-counts["q"] // BLOCK_ROWS))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    tree_rows = dealt.select("size", "shard", "vec_id", "v")
    asked = rows.filter("query").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    home = asked.select("size", F.pmod("block", F.lit(shards)).alias("shard"), "block", F.col("vec_id").alias("query_id"), "v", F.lit(None).cast("bigint").alias("floor"))
    first = materialize(_searched(tree_rows, home, blocks, k))
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = first.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") == k).select("query_id", F.col("score").alias("floor"))
    others = (
        home.drop("floor").withColumnRenamed("shard", "home").join(floors, "query_id", "left")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter("shard != home")
    )
    rest = _searched(tree_rows, others, blocks, k)
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _searched(rows: DataFrame, queries: DataFrame, blocks: int, k: int) -> DataFrame:
    """The best k of a shard for each query sent to it: query_id, vec_id, score."""

    def search(shard: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if shard.num_rows and asked.num_rows:
            tree = BallTree(shard["vec_id"].to_numpy(), _matrix(shard, "v"))
            ids, vectors = asked["query_id"].to_numpy(), _matrix(asked, "q_v")
            floors = asked["floor"].to_pandas().astype("Float64").fillna(-np.inf).to_numpy(np.float64)
            for at in range(0, len(ids), BLOCK_ROWS):
                part = slice(at, at + BLOCK_ROWS)
                scores, found = tree.search(ids[part], vectors[part], floors[part], k)
                real = scores != np.iinfo(np.int64).min
                out["query_id"].append(np.repeat(ids[part], real.sum(1)))
                out["vec_id"].append(found[real])
                out["score"].append(scores[real])
        return pa.table({c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in out.items()})

    part = F.floor(F.col("block") / TASK_BLOCKS).cast("int")
    queries = queries.select(F.col("size").alias("q_size"), F.col("shard").alias("q_shard"), part.alias("q_part"), "query_id", F.col("v").alias("q_v"), "floor")
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // TASK_BLOCKS))))
    return rows.groupBy("size", "shard", "part").cogroup(queries.groupBy("q_size", "q_shard", "q_part")).applyInArrow(search, "query_id long, vec_id long, score long")


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    flat = table[column].combine_chunks()
    return np.asarray(flat.flatten()).reshape(table.num_rows, -1)
