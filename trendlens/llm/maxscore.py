"""Exact top-k inner-product search by MaxScore over shards of integer vectors.

A term is a dimension; its posting for a vector is the component floor(256 x). For one query and one shard,
a term's upper bound is the largest product that any posting of the shard can give (never below 0: a vector
may be absent). Terms are taken in order of their bounds. Those whose bounds together can't lift a vector
over the query's k-th best score so far are non-essential: a vector that only they could help needn't be
looked at. The essential postings are traversed first for all vectors of a block; what is still competitive
(partial score + bounds of the rest) is probed in the other terms, a few at a time, and dropped as soon as it
can't make the top k. The threshold rises from block to block; equal scores stay competitive, so that ties go
to the smaller vec_id. Shards return k rows a query, and a merge keeps the k best.

Partitioning: vectors are hashed to shards of bounded size, queries to blocks of bounded size; a task gets one
shard and one block. Neither all queries nor all vectors meet anywhere. Every vector is sent once per query
block and every query once per shard, as a stated query set against all rows needs.

Vectors that are null or hold null or non-finite components take no part. Shorter vectors count as padded
with zeros; an empty one scores 0. Rows that repeat a vec_id are candidates of their own, but not for a query
of that id; repeated queries are asked once (the first by components). Scores that pass 64 bits are cut off
at the limits of long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import cut_lineage

EXACT = float(1 << 53)


def integer_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v array<double> of whole numbers) of the rows that take part."""
    v = F.col("embedding")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return vectors.where(fine & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), whole.alias("v"))


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(column.value_lengths())
    out = np.zeros((len(column), dims))
    if len(column) and lengths.min() == lengths.max() == dims:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = row
    return out


def shard_top_k(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, k: int, block: int = 1024, probe: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) of one shard for one query; ``ids`` must be sorted. Scores are exact whole numbers."""
    return _Shard(ids, vectors, block).search(query_id, query, k, probe)


class _Shard:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int = 1024):
        self.ids, self.vectors, self.block = ids, vectors, block
        self.most, self.least = vectors.max(axis=0), vectors.min(axis=0)
        self.columns = np.ascontiguousarray(vectors.T)  # postings by term
        self.largest = max(self.most.max(initial=0.0), -self.least.min(initial=0.0))

    def search(self, query_id: int, query: np.ndarray, k: int, probe: int = 8) -> tuple[np.ndarray, np.ndarray]:
        if np.abs(query).sum() * self.largest >= EXACT:
            return self._wide(query_id, query, k)
        bound = np.maximum(np.where(query > 0, query * self.most, query * self.least), 0.0)
        order = np.argsort(-bound, kind="stable")
        left = np.concatenate((np.cumsum(bound[order][::-1])[::-1], [0.0]))  # bounds of the terms from here on
        top_ids, top = np.zeros(0, np.int64), np.zeros(0)
        bar = -np.inf
        for at in range(0, len(self.ids), self.block):
            own = self.ids[at : at + self.block]
            # essential: the terms before the first place from which the rest can't reach the bar
            cut = len(order) if bar == -np.inf else int(np.searchsorted(-left, -bar, side="right"))
            terms = order[: min(cut, len(order))]
            part = query[terms] @ self.columns[terms, at : at + self.block]
            alive = np.flatnonzero(own != query_id)
            alive = alive[part[alive] + left[len(terms)] >= bar]
            score = part[alive]
            done = len(terms)
            while done < len(order) and len(alive):
                terms = order[done : done + probe]
                score = score + query[terms] @ self.columns[terms][:, at + alive]
                done += len(terms)
                keep = score + left[done] >= bar
                alive, score = alive[keep], score[keep]
            if not len(alive):
                continue
            top_ids, top = np.concatenate((top_ids, own[alive])), np.concatenate((top, score))
            best = np.lexsort((top_ids, -top))[:k]
            top_ids, top = top_ids[best], top[best]
            bar = top[-1] if len(top) == k else -np.inf
        return top_ids, top

    def _wide(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers beyond 2^53: the same scores in Python integers."""
        q = [int(x) for x in query]
        found = sorted((-sum(a * int(b) for a, b in zip(q, v, strict=True)), i) for i, v in zip(self.ids.tolist(), self.vectors, strict=True) if i != query_id)[:k]
        clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
        return np.array([i for _, i in found], np.int64), np.array([clip(-s) for s, _ in found], object)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192, query_rows: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score) for ``queries`` (vec_id, v) against ``vectors`` (vec_id, v)."""
    vectors, queries = cut_lineage(vectors), cut_lineage(queries.groupBy("vec_id").agg(F.min("v").alias("v")))
    n, dims = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    m, wide = queries.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    dims, shards, blocks = max(1, dims, wide), max(1, -(-n // shard_rows)), max(1, -(-m // query_rows))
    deal = lambda seed, parts: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = vectors.select("vec_id", "v", deal(1, shards).alias("shard"), every(blocks).alias("block"))
    right = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), every(shards).alias("shard"), deal(2, blocks).alias("block"))

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if own.num_rows and asked.num_rows:
            ids = own.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            shard = _Shard(ids[order], _matrix(own.column("v"), dims)[order])
            for qid, q in zip(asked.column("query_id").to_pylist(), _matrix(asked.column("q"), dims), strict=True):
                best, scores = shard.search(qid, q, k)
                out["query_id"] += [qid] * len(best)
                out["vec_id"] += best.tolist()
                out["score"] += [int(s) for s in scores]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(run, "query_id long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_every_nth(vectors: DataFrame, nth: int = 50, k: int = 5, **options) -> DataFrame:
    """Queries: the rows whose vec_id is divisible by ``nth``."""
    whole = integer_vectors(vectors)
    return top_k(whole, whole.where(F.col("vec_id") % nth == 0), k, **options)
