"""Exact top-k inner products with an impact-ordered, score-at-a-time index.

Each block of vectors is indexed by posting segments: a segment holds the
vectors of the block whose value in one dimension falls in one quantised
level, with the level's lowest and highest value.  For a query, segments are
processed in rounds of falling impact (the most a segment can add to a score,
over the least its dimension can add).  After each round every vector has a
proven upper bound of its score: what its processed segments add at most, and
at most the next segment's impact for each dimension not
seen yet.  The leaders of the round, scored exactly, prove a lower bound of the
k-th best score; a vector stays a possible member while its upper bound
reaches it.  Processing stops when that proof leaves few enough
possible members, or at the last segment.  The possible members are rescored
exactly in integers.

Defined results: vectors that are null, hold null or non-finite components, or
have no id take no part; missing trailing components count as 0; repeated
(id, vector) rows count once; ties go to the smaller id, then to the smaller
vector; a vector with the query's id is the query's own row; an id repeated
with different vectors is one candidate (and one query) each, ranked apart;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class SegmentIndex:
    """Posting segments of one block: vectors ``mat`` (rows x dims, int64)."""

    def __init__(self, mat: np.ndarray, levels: int = 32):
        n, dims = mat.shape
        self.mat, self.n, self.dims = mat, n, dims
        order = np.argsort(mat, axis=0, kind="stable")
        cut = np.unique(np.linspace(0, n, min(levels, n) + 1).astype(np.int64))
        ranked = np.take_along_axis(mat, order, axis=0)
        s, e = cut[:-1], cut[1:]
        self.ids = np.ascontiguousarray(order.T)                    # dims x n, by value
        self.start, self.end = s, e                                 # the same cuts in each dimension
        self.low = np.ascontiguousarray(ranked[s].T)                # dims x segments
        self.high = np.ascontiguousarray(ranked[e - 1].T)

    def search(self, q: np.ndarray, k: int, enough: int = 512,
               rounds: tuple[float, ...] = (0.5, 0.6, 0.7, 0.8, 0.9, 1.0)) -> tuple[np.ndarray, np.ndarray, int]:
        """Row numbers and exact scores of every vector that may be among the
        k best of the block, and the number of postings processed."""
        a, b = q[:, None] * self.low, q[:, None] * self.high
        most, least = np.maximum(a, b), np.minimum(a, b)            # dims x segments
        base = least.min(axis=1, keepdims=True)
        most, least = (most - base).ravel(), (least - base).ravel()  # >= 0: gain over the dimension's least
        order = np.argsort(-most, kind="stable")
        width = self.end - self.start
        nseg = len(width)
        size = width[order % nseg]
        steps = np.searchsorted(np.cumsum(size), np.array(rounds) * size.sum()) + 1
        gain_lo, gain_hi, seen = np.zeros(self.n), np.zeros(self.n), np.zeros(self.n)
        done, used = 0, 0
        for stop in np.minimum(steps, len(order)):
            segs = order[done:stop]
            done = int(stop)
            if len(segs):
                ids = np.concatenate([self.ids[g // nseg, self.start[g % nseg]:self.end[g % nseg]] for g in segs])
                w = width[segs % nseg]
                used += len(ids)
                gain_lo += np.bincount(ids, np.repeat(least[segs], w), self.n)
                gain_hi += np.bincount(ids, np.repeat(most[segs], w), self.n)
                seen += np.bincount(ids, minlength=self.n)
            # a dimension not seen yet adds 0 at least and the next segment's impact at most
            next_impact = most[order[done]] if done < len(order) else 0
            upper = gain_hi + next_impact * (self.dims - seen)
            # the exact scores of the leaders so far prove how good the k-th best is at least
            if self.n > 4 * k:
                lead = np.argpartition(gain_lo, self.n - 4 * k)[self.n - 4 * k:]
                kth = np.partition(self.mat[lead] @ q, 3 * k)[3 * k] - base.sum()
            else:
                kth = -1.0
            may = np.flatnonzero(upper >= kth)
            if len(may) <= max(enough, 2 * k) or done == len(order):
                break
        return may, self.mat[may] @ q, used


def quantised(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, x as double; null if any component
    is null or not finite, or the vector is null."""
    x = F.transform(embedding, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(embedding.isNotNull() & ~F.coalesce(bad, F.lit(False)),
                  F.transform(x, lambda v: F.floor(v * scale).cast("long")))


def _pack(rows: DataFrame, block: str, per: int, prefix: str) -> DataFrame:
    """(id, vec) -> one row per block of about ``per`` rows: ids and vectors."""
    n = max(1, -(-rows.count() // per))
    return (rows.withColumn(block, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
            .groupBy(block).agg(F.collect_list(F.struct("id", "vec")).alias(prefix)))


OUT = "query_id long, query_vec array<long>, vec_id long, vec array<long>, score long"


def _matrix(rows, dims: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([r["id"] for r in rows], dtype=np.int64)
    mat = np.zeros((len(rows), dims), dtype=np.int64)
    for i, r in enumerate(rows):
        mat[i, :len(r["vec"])] = r["vec"]
    return ids, mat


def _search_blocks(k: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                dims = max(len(r["vec"]) for r in row["base"] + row["asked"])
                ids, mat = _matrix(row["base"], dims)
                index = SegmentIndex(mat, levels)
                out = []
                for q in row["asked"]:
                    v = np.zeros(dims, dtype=np.int64)
                    v[:len(q["vec"])] = q["vec"]
                    # rows with the query's own id are not candidates: ask for that many more
                    own = int((ids == q["id"]).sum())
                    may, score, _ = index.search(v, min(k + own, len(ids)))
                    keep = ids[may] != q["id"]
                    may, score = may[keep], score[keep]
                    best = np.lexsort((ids[may], -score))
                    if len(best) > k:  # all ties of the last place stay: the vector decides
                        last = best[k - 1]
                        best = [i for i in best if score[i] > score[last]
                                or (score[i] == score[last] and ids[may[i]] <= ids[may[last]])]
                    out += [(q["id"], q["vec"], int(ids[may[i]]), row["base"][may[i]]["vec"], int(score[i]))
                            for i in best]
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(out, columns=["query_id", "query_vec", "vec_id", "vec", "score"]),
                    schema=pa.schema([("query_id", pa.int64()), ("query_vec", pa.list_(pa.int64())),
                                      ("vec_id", pa.int64()), ("vec", pa.list_(pa.int64())),
                                      ("score", pa.int64())]), preserve_index=False)
    return run


def top_k(vectors: DataFrame, asked: DataFrame, k: int = 10, base_rows: int = 4096,
          query_rows: int = 4096, levels: int = 32) -> DataFrame:
    """Vectors (id, vec) and queries (id, vec), integers -> query_id,
    query_vec, rank, vec_id, score: each query's ``k`` best vectors.

    Every block of queries meets every block of vectors once (a stated query
    set against all rows, in blocks); each meeting returns k rows a query, and
    the best k of those are the result.  Block sizes bound a task's memory.
    The blocks meet by a shuffle: the queries repeated for every block of
    vectors are more than their size before the repeat tells a broadcast.
    """
    base = _pack(vectors.distinct(), "bb", base_rows, "base")
    ask = _pack(asked.distinct(), "qb", query_rows, "asked")
    blocks = max(1, -(-vectors.count() // base_rows))
    pairs = (ask.withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(blocks, "bb")
             .hint("merge").join(base.repartition(blocks, "bb"), "bb").select("base", "asked"))
    part = pairs.mapInArrow(_search_blocks(k, levels), OUT)
    order = Window.partitionBy("query_id", "query_vec").orderBy(F.desc("score"), "vec_id", "vec")
    return (part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "query_vec", "rank", "vec_id", "score"))


def search(embeddings: DataFrame, k: int = 10, every: int = 100, scale: int = 1024) -> DataFrame:
    """All vectors; queries are the rows whose vec_id is divisible by ``every``."""
    v = (embeddings.select(F.col("vec_id").cast("long").alias("id"),
                           quantised(F.col("embedding"), scale).alias("vec"))
         .where(F.col("id").isNotNull() & F.col("vec").isNotNull()))
    return top_k(v, v.where(F.col("id") % every == 0), k).select("query_id", "rank", "vec_id", "score")
