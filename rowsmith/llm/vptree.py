"""Operator 4: nearest neighbours by inner product, with a vantage-point tree per shard.

Rows are dealt into shards by a hash of their id; a shard is indexed once and
written as one packed row. With M the largest norm of a shard, every vector x
becomes (x, sqrt(M^2 - |x|^2)) and a query q becomes (q, 0); then
|q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the nearest points are those of the largest
inner product, and the triangle inequality holds for pruning.

A node's vantage point splits the rest by distance into halves. With d the query's
distance to it and r the distance of its k-th best so far, the near half can be left
out when d - f r is beyond its farthest point, the far half when d + f r falls short
of its nearest. The factor f tunes it: 1 is exact search, less prunes more. Queries
come in blocks, also packed; a task searches one shard for one block, all queries
still alive at a node in one numpy step. Every (shard, block) pair is one task's
work: no key gathers more. The k best of each shard meet in a window with a partial
top-k before its shuffle.

Scores of those returned are worked out again on the original vectors, in double
precision and one order of summation, so equal vectors tie exactly.

Defined results: a vector that is null, empty, zero, or holds a null or non-finite
component takes no part, nor does a null id; of rows with one id the least vector
counts, once; a query meets vectors of its own length only; fewer than k candidates
are all returned; ties go to the smaller id; an empty table gives an empty result;
other input columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tables

K = 20
FACTOR = 1.0
SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF = 64


# -- one shard --------------------------------------------------------------------


class Shard:
    """A vantage-point tree over the rows of a matrix, kept in tree order.

    A node is a range [lo, hi): row lo is its vantage point, [lo + 1, mid) the near
    half and [mid, hi) the far half. ``near[lo]`` is the farthest distance in the near
    half, ``far[lo]`` the nearest in the far half. Ranges of up to LEAF rows are leaves.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, near: np.ndarray | None = None, far: np.ndarray | None = None):
        self.ids, self.x = ids, vectors
        square = (vectors * vectors).sum(axis=1)
        self.most = square.max(initial=0.0)
        self.near, self.far = near, far
        if near is None:
            self._build(np.sqrt(np.maximum(self.most - square, 0)))

    def _build(self, lift: np.ndarray) -> None:
        n = len(self.ids)
        full, order = np.concatenate([self.x, lift[:, None]], axis=1), np.arange(n)
        self.near, self.far = np.zeros(n), np.zeros(n)
        rng, todo = np.random.default_rng(n), [(0, n)]
        while todo:
            lo, hi = todo.pop()
            if hi - lo <= LEAF:
                continue
            v = int(rng.integers(lo, hi))
            order[[lo, v]] = order[[v, lo]]
            d = np.sqrt(((full[order[lo + 1 : hi]] - full[order[lo]]) ** 2).sum(axis=1))
            rank = np.argsort(d, kind="stable")
            order[lo + 1 : hi] = order[lo + 1 : hi][rank]
            mid = self.mid(lo, hi)
            self.near[lo], self.far[lo] = d[rank[mid - lo - 2]], d[rank[mid - lo - 1]]
            todo += [(lo + 1, mid), (mid, hi)]
        self.ids, self.x = self.ids[order], self.x[order]

    @staticmethod
    def mid(lo: int, hi: int) -> int:
        return lo + 1 + (hi - lo) // 2

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int = K, factor: float = FACTOR) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of each query's k best (id -1 where there are fewer), best first."""
        run = _Search(self, ids, queries, k, factor)
        run.descend(0, len(self.ids), np.arange(len(ids)))
        run.visit(0, len(self.ids), np.arange(len(ids)))
        return run.best_ids, run.best


class _Search:
    def __init__(self, shard: Shard, ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.s, self.ids, self.q, self.k, self.factor = shard, ids, queries, k, factor
        self.square = (queries * queries).sum(axis=1)
        self.scale = np.sqrt(self.square) * np.sqrt(shard.most) + 1e-300
        self.best = np.full((len(ids), k), -np.inf)
        self.best_ids = np.full((len(ids), k), -1, np.int64)
        self.first = np.full(len(ids), -1)  # the leaf seen on the way down

    def distance(self, rows: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.square[rows] + self.s.most - 2 * scores, 0))

    def offer(self, rows: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Scores points [lo, hi) for the queries ``rows`` and keeps the best."""
        scores = self.q[rows] @ self.s.x[lo:hi].T
        worth = scores >= (self.best[rows, -1] - 1e-9 * self.scale[rows])[:, None]
        i, j = np.nonzero(worth)
        own, point = rows[i], lo + j
        other = self.s.ids[point] != self.ids[own]
        own, point = own[other], point[other]
        if len(own):
            exact = (self.q[own] * self.s.x[point]).sum(axis=1)
            hit = np.unique(own)
            owner = np.concatenate([np.repeat(hit, self.k), own])
            score = np.concatenate([self.best[hit].ravel(), exact])
            name = np.concatenate([self.best_ids[hit].ravel(), self.s.ids[point]])
            order = np.lexsort((name, -score, owner))
            start = np.searchsorted(owner[order], hit)
            take = order[(start[:, None] + np.arange(self.k)).ravel()]
            self.best[hit], self.best_ids[hit] = score[take].reshape(-1, self.k), name[take].reshape(-1, self.k)
        return scores

    def descend(self, lo: int, hi: int, rows: np.ndarray) -> None:
        """Every query down to one leaf, for a first bound."""
        if not len(rows):
            return
        if hi - lo <= LEAF:
            self.first[rows] = lo
            self.offer(rows, lo, hi)
            return
        d, mid = self.distance(rows, self.q[rows] @ self.s.x[lo]), self.s.mid(lo, hi)
        near = d <= (self.s.near[lo] + self.s.far[lo]) / 2
        self.descend(lo + 1, mid, rows[near])
        self.descend(mid, hi, rows[~near])

    def visit(self, lo: int, hi: int, rows: np.ndarray) -> None:
        """All of the tree that the bounds leave in."""
        if not len(rows):
            return
        if hi - lo <= LEAF:
            self.offer(rows[self.first[rows] != lo], lo, hi)
            return
        d, mid = self.distance(rows, self.offer(rows, lo, lo + 1)[:, 0]), self.s.mid(lo, hi)
        # Rounding must not prune: distances lose half the digits in the square root.
        slack = 1e-6 * (np.sqrt(self.square[rows]) + np.sqrt(self.s.most))
        reach = self.factor * self.distance(rows, np.maximum(self.best[rows, -1], -1e300)) + slack
        self.visit(lo + 1, mid, rows[d - reach <= self.s.near[lo]])
        reach = self.factor * self.distance(rows, np.maximum(self.best[rows, -1], -1e300)) + slack
        self.visit(mid, hi, rows[d + reach >= self.s.far[lo]])


# -- the jobs ----------------------------------------------------------------------


def usable(vectors: DataFrame, key_col: str, vector_col: str) -> DataFrame:
    """``vec_id, dim, vector`` (doubles) of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(key_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)).select(
        "vec_id", F.size("vector").alias("dim"), "vector"
    )


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their vectors; of rows with one id the least vector."""
    ids = table.column("vec_id").combine_chunks().to_numpy()
    column = table.column("vector").combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    order = np.lexsort((*x.T[::-1], ids))
    ids, x = ids[order], x[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]])
    return ids[first], x[first]


def packed(rows: DataFrame, parts: int, tree: bool) -> DataFrame:
    """One row for each (``dim``, ``part``): ids, vectors, and with ``tree`` the bounds of its nodes."""

    def pack(table: pa.Table) -> pa.Table:
        ids, x = _matrix(table)
        near = far = np.empty(0)
        if tree:
            shard = Shard(ids, x)
            ids, x, near, far = shard.ids, shard.x, shard.near, shard.far
        cells = [table.column("dim")[0].as_py(), table.column("part")[0].as_py(), ids.tobytes(), x.tobytes(), near.tobytes(), far.tobytes()]
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.Table.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], ["dim", "part", "ids", "vectors", "near", "far"])

    dealt = rows.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
    return dealt.groupBy("dim", "part").applyInArrow(pack, "dim int, part int, ids binary, vectors binary, near binary, far binary")


def nearest(
    vectors: DataFrame, is_query, k: int = K, factor: float = FACTOR, key_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for the rows where ``is_query`` (a Column over ``vec_id``) holds, the k nearest others."""
    rows = usable(vectors, key_col, vector_col)
    n, q = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-q // block_rows))
    index = tables.written(packed(rows, shards, tree=True), "vp-shards").withColumnRenamed("part", "shard")
    asked = packed(rows.where(is_query), blocks, tree=False).select("dim", F.col("part").alias("block"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    asked = tables.written(asked, "query-blocks")
    # Packed rows meet by (length, shard, block): a stated query set against all rows, in blocks.
    left = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    met = left.join(right, ["dim", "shard", "block"]).select("dim", "ids", "vectors", "near", "far", "q_ids", "q_vectors")

    def search(batches):
        for b in batches:
            for dim, *cells in zip(*(c for c in b.columns)):
                ids, x, near, far, q_ids, q = (np.frombuffer(c.as_buffer(), t) for c, t in zip(cells, ("i8", "f8", "f8", "f8", "i8", "f8")))
                dim = dim.as_py()
                found, score = Shard(ids, x.reshape(-1, dim), near, far).search(q_ids, q.reshape(-1, dim), k, factor)
                at, nth = np.nonzero(found >= 0) if (ids >= 0).all() else np.nonzero(np.isfinite(score))
                columns = [pa.array(q_ids[at]), pa.array(found[at, nth]), pa.array(score[at, nth])]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    found = met.mapInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(tables.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


SQL_OP4 = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e) AS score FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= {K}
"""
