"""Exact top-k by inner product: sorted lists are read in order, bounds decide when no outsider can qualify."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import stage
from .hard_negatives import products, whole

_CELLS = 1 << 22


class Lists:
    """The sorted lists of a block, one a dimension, read in step from both ends: queries with a positive component read a
    dimension from its largest value on, others from its smallest."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, self.ordered = vectors, np.sort(vectors, axis=0)
        self.ranks = np.argsort(np.argsort(vectors, axis=0, kind="stable"), axis=0)

    def read(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries ``start`` to ``stop`` of every list, from the top and from the bottom, at their vectors; else zero."""
        n = len(self.vectors)
        top = (self.ranks < n - start) & (self.ranks >= n - stop)
        bottom = (self.ranks >= start) & (self.ranks < stop)
        return np.where(top, self.vectors, 0.0), np.where(bottom, self.vectors, 0.0)

    def unread(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        return self.ranks < len(self.vectors) - depth, self.ranks >= depth

    def bounds(self, depth: int) -> tuple[np.ndarray, ...]:
        """The last values read from the top and from the bottom, and the values at the ends of the lists."""
        n = len(self.vectors)
        return self.ordered[n - depth], self.ordered[depth - 1], self.ordered[0], self.ordered[-1]


def search_block(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray, k: int, first: float = 1 / 64):
    """Rows (query, vector, score) that hold the k best vectors of every query, ties included, and the depth each query read.

    Lists are read in step, never by row, ``first`` of them to begin with and twice as far each time. What was read adds
    to a partial score; components not read yet lie between the last value read and the end of their list, which gives each
    vector an upper and a lower bound. A query stops once at most 4 k vectors have an upper bound that reaches its
    k-th largest lower bound, or its lists end; only these few are scored. ``own[q]`` is the query's own vector, or -1.
    """
    n = len(vectors)
    lists = Lists(vectors)
    up, down = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
    waiting, out, depths = np.arange(len(queries)), [], np.zeros(len(queries), np.int64)
    partial, at, depth = np.zeros((len(queries), n)), 0, min(n, max(1, math.ceil(n * first)))
    while len(waiting):
        p, m = up[waiting], down[waiting]
        top, bottom = lists.read(at, depth)
        partial += p @ top.T + m @ bottom.T
        if depth < n:
            last_top, last_bottom, least, most = lists.bounds(depth)
            not_top, not_bottom = (x.astype(np.float64).T for x in lists.unread(depth))
            high = partial + (p * last_top) @ not_top + (m * last_bottom) @ not_bottom
            low = partial + (p * least) @ not_top + (m * most) @ not_bottom
        else:
            high, low = partial.copy(), partial.copy()
        mine = own[waiting]
        held = np.flatnonzero(mine >= 0)
        low[held, mine[held]] = high[held, mine[held]] = -np.inf
        kth = np.partition(low, n - k, axis=1)[:, n - k] if n > k else np.full(len(waiting), -np.inf)
        alive = (high >= kth[:, None]) & (high > -np.inf)
        done = (alive.sum(axis=1) <= 4 * k) | (depth >= n)
        q, v = np.nonzero(alive & done[:, None])
        out.append((waiting[q], v, np.einsum("ij,ij->i", queries[waiting[q]], vectors[v])))
        depths[waiting[done]] = depth
        waiting, partial = waiting[~done], partial[~done]
        at, depth = depth, min(n, 2 * depth)
    return *(np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)), depths


def _scored(queries: np.ndarray, vectors: np.ndarray, own: np.ndarray, k: int, first: float):
    """``search_block`` for some queries at a time; integers beyond doubles are scored outright."""
    step = max(1, _CELLS // len(vectors))
    for start in range(0, len(queries), step):
        part = slice(start, start + step)
        if queries.dtype == object or vectors.dtype == object:
            scores = products(queries[part], vectors)
            q, v = np.nonzero(own[part][:, None] != np.arange(len(vectors))[None, :])
            yield q + start, v, scores[q, v].astype(np.int64), np.full(len(q), len(vectors))
        else:
            q, v, score, depths = search_block(queries[part], vectors, own[part], k, first)
            yield q + start, v, score.astype(np.int64), depths[q]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", vec_id: str = "vec_id",
          scale: int = 256, block_vectors: int = 8192, block_queries: int = 1024, first: float = 1 / 64) -> DataFrame:
    """(query_id, rank, vec_id, score, depth): the k largest integer inner products of each query row with the other rows.

    Components become floor(scale * x). Queries and vectors are dealt into blocks, and every block of queries meets
    every block of vectors in a task of bounded size, which answers by ``search_block``; its k rows a query meet the
    other blocks' in a window. Scores are exact integers. ``depth`` is the largest number of entries of a list that the
    query read in any block; it tells how early the bounds stopped it, and depends on the blocks.

    Rows of repeated ids are rows of their own, as queries and as candidates; only the row itself is left out. Rows are compared
    within equal vector lengths. Null and empty vectors and those with null, NaN or infinite components take no part. A null id
    is no query, and comes last among ties, which go to the smaller id; with fewer than k others all are returned; an empty table
    gives an empty result. Scores beyond 64 bits count as the nearest 64-bit integer. Other columns are not read, so none can clash.
    """
    x = F.col(vector)
    good = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), x.cast("array<double>").alias("v"), good.alias("good"),
                          F.coalesce(is_query & F.col(vec_id).isNotNull(), F.lit(False)).alias("asks"))
    every = stage(rows.where("good").drop("good").withColumns({"width": F.size("v"), "row": F.monotonically_increasing_id()}), "vectors")
    asked = stage(every.where("asks"), "queries")
    v_blocks = max(1, math.ceil(every.count() / block_vectors))
    q_blocks = max(1, math.ceil(asked.count() / block_queries))

    def dealt(df, own, blocks, other, others):
        mine = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias(own)
        return df.select("width", "row", "id", "v", mine, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    types = {"q": pa.int64(), "query_id": pa.int64(), "row": pa.int64(), "id": pa.int64(), "score": pa.int64(), "depth": pa.int64()}

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({n: pa.array([], t) for n, t in types.items()})
        read = lambda t: whole(np.asarray(t.column("v").combine_chunks().flatten(), np.float64).reshape(len(t), -1), scale)
        q_rows, v_rows = left.column("row").to_numpy(), right.column("row").to_numpy()
        ids = right.column("id").combine_chunks()
        v_ids, no_id = np.asarray(ids.fill_null(0)), np.asarray(ids.is_null())
        place = {r: i for i, r in enumerate(v_rows.tolist())}
        own = np.array([place.get(r, -1) for r in q_rows.tolist()])
        parts = []
        for q, v, score, depth in _scored(read(left), read(right), own, k, first):
            order = np.lexsort((v_rows[v], v_ids[v], no_id[v], ~score, q))
            q, v, score, depth = q[order], v[order], score[order], depth[order]
            starts = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, int)
            best = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q)))) < k
            parts.append((q[best], v[best], score[best], depth[best]))
        q, v, score, depth = (np.concatenate([p[i] for p in parts]) for i in range(4))
        return pa.table({"q": q_rows[q], "query_id": left.column("id").to_numpy()[q], "row": v_rows[v],
                         "id": ids.take(pa.array(v, pa.int64())), "score": pa.array(score, pa.int64()), "depth": pa.array(depth, pa.int64())})

    keys = ["width", "qb", "vb"]
    pairs = (dealt(asked, "qb", q_blocks, "vb", v_blocks).groupBy(*keys)
             .cogroup(dealt(every, "vb", v_blocks, "qb", q_blocks).groupBy(*keys))
             .applyInArrow(answer, "q long, query_id long, row long, id long, score long, depth long"))
    ranked = pairs.select("query_id", F.expr("row_number() OVER (PARTITION BY q ORDER BY score DESC, id NULLS LAST, row)").alias("rank"),
                          F.col("id").alias("vec_id"), "score", F.expr("max(depth) OVER (PARTITION BY q)").alias("depth"))
    return ranked.where(F.col("rank") <= k)
