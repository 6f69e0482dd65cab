"""Exact top-k inner-product search with multi-resolution segment statistics.

A vector is cut into segments, 1, 4, 16, ... of them; each segment keeps its
mean and its deviation. For a pair, the squared distance of two segments of
length L is at least L ((m - m')^2 + (s - s')^2), so the sum over segments is a
lower bound of the squared distance, and finer cuts give larger bounds. With
the norms known this bounds the inner product from above. A block of queries
meets a block of candidates in one task: the coarsest bounds pick the first
candidates, whose exact scores give each query's threshold; the levels then
discard, coarse to fine, all pairs that cannot reach it; the survivors are
scored exactly. Ties at the threshold survive, so the result is exact.

Queries and candidates meet in blocks of bounded size (every pair of blocks
once); each block pair hands on k rows a query.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, nor do rows with null id. Rows that repeat an id count
once, with the largest vector in array order. Vectors of different lengths do
not meet. Scores beyond the range of a long are cut to it. Fewer than k
candidates give fewer rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusmill.llm.common import stage

SCALE = 256
QUERY_BLOCK, ROW_BLOCK = 1024, 8192
_STEP = 128  # queries whose bounds are held at once
_EXACT = float(1 << 53)
_SPARSE, _PAIRS = 0.02, 1 << 17  # below this share of pairs, survivors are scored one by one


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """(id, v array<double>) with v = floor(scale * x); whole numbers kept as
    doubles, since a finite float times 256 need not fit a long."""
    x = F.col(embedding).cast("array<double>")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), x.alias(embedding)).filter(
        F.col("id").isNotNull() & (F.size(embedding) > 0) & fine)
    # floor() of a double is a long in Spark; far outside its range the value is whole already
    whole = F.transform(embedding, lambda c: F.when(F.abs(c * scale) < _EXACT, F.floor(c * scale).cast("double")).otherwise(c * scale))
    return rows.groupBy("id").agg(F.max(embedding).alias(embedding)).select("id", whole.alias("v"))


def _levels(d: int) -> list[np.ndarray]:
    """Segment borders of each resolution, coarse to fine."""
    cuts, n = [], 1
    while n < d:
        cuts.append(np.unique(np.linspace(0, d, n + 1).astype(int)))
        n = n * 4 if n * 4 < d else max(n + 1, d // 2) if n < d // 2 else d
    return cuts


def _segments(v: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Segment means and deviations, weighted so that a dot product of two rows
    sums L (m m' + s s') over the segments."""
    n = np.diff(borders)
    mean = np.add.reduceat(v, borders[:-1], axis=1) / n
    square = np.add.reduceat(v * v, borders[:-1], axis=1) / n
    dev = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean * np.sqrt(n), dev * np.sqrt(n)], axis=1)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise exact inner products; products and sums below 2^53 are exact in doubles."""
    return np.einsum("ij,ij->i", a, b)


def block_top_k(qid, q, cid, c, k: int, stats: dict | None = None):
    """[(query id, candidate id, score)]: the k best of the block for each query."""
    safe = q.shape[1] * max(1.0, np.abs(q).max()) * max(1.0, np.abs(c).max()) < _EXACT
    if not safe:
        return _block_big(qid, q, cid, c, k)
    order = np.argsort(cid, kind="stable")
    cid, c = cid[order], c[order]
    cuts = _levels(q.shape[1])
    qs, cs = [_segments(q, b) for b in cuts], [_segments(c, b) for b in cuts]
    out = []
    for lo in range(0, len(qid), _STEP):
        ids = qid[lo : lo + _STEP]
        own = ids[:, None] == cid[None, :]
        alive, least = ~own, np.full((len(ids), 1), -np.inf)
        first = min(2 * k + 1, len(cid))
        for level, (a, b) in enumerate(zip(qs, cs, strict=True)):
            bound = a[lo : lo + _STEP] @ b.T
            if level in (0, len(qs) - 1) and first >= k:
                # the highest bounds are scored and raise the thresholds
                seeds = np.argpartition(bound, len(cid) - first, axis=1)[:, len(cid) - first :]
                exact = np.einsum("ij,ikj->ik", q[lo : lo + _STEP], c[seeds])
                exact[np.take_along_axis(own, seeds, 1)] = -np.inf
                exact.sort(axis=1)
                least = np.maximum(least, exact[:, -k, None])
            size = np.abs(least, where=np.isfinite(least), out=np.zeros_like(least)) + np.abs(bound).max()
            alive &= bound >= least - 1e-9 * size - 1e-6
            if alive.mean() < _SPARSE:
                break
        if alive.mean() < _SPARSE:
            i, j = np.nonzero(alive)
            score = np.concatenate(
                [_scores(q[lo + i[at : at + _PAIRS]], c[j[at : at + _PAIRS]]) for at in range(0, i.size, _PAIRS)] or [np.zeros(0)])
        else:
            full = q[lo : lo + _STEP] @ c.T
            i, j = np.nonzero(alive & (full >= least))
            score = full[i, j]
        if stats is not None:
            stats["pairs"] = stats.get("pairs", 0) + own.size
            stats["scored"] = stats.get("scored", 0) + int(alive.sum())
        best = np.lexsort((j, -score, i))
        i, j, score = i[best], j[best], score[best]
        rank = np.arange(i.size) - np.searchsorted(i, i, "left")
        top = rank < k
        out.append((ids[i[top]], cid[j[top]], score[top].astype(np.int64)))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3


def _block_big(qid, q, cid, c, k):
    """The same for huge components, in Python's whole numbers."""
    low, high = -(1 << 63), (1 << 63) - 1
    rows = []
    whole = [[int(x) for x in r] for r in c]
    for i, r in zip(qid, q, strict=True):
        r = [int(x) for x in r]
        s = [(-min(high, max(low, sum(x * y for x, y in zip(r, w, strict=True)))), int(j)) for j, w in zip(cid, whole, strict=True) if j != i]
        rows += [(i, j, -x) for x, j in sorted(s)[:k]]
    return [np.array(x, dtype=np.int64) for x in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 3


def top_k(vectors: DataFrame, k: int, every: int, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``every``, its k best others by integer inner product, ties to smaller ids."""
    rows = stage(integer_vectors(vectors, vec_id, embedding, scale).withColumn("d", F.size("v")), "vectors")
    asks = rows.filter(F.col("id") % every == 0)
    n, m = rows.count(), asks.count()
    n_blocks, m_blocks = max(1, math.ceil(n / ROW_BLOCK)), max(1, math.ceil(m / QUERY_BLOCK))
    n_blocks = max(n_blocks, min(math.ceil(n / 512), 32))  # enough tasks for small tables too
    part = lambda seed, blocks: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(blocks))
    spread = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    left = asks.select("d", part(1, m_blocks).alias("qb"), spread(n_blocks).alias("cb"), "id", "v")
    right = rows.select("d", spread(m_blocks).alias("qb"), part(2, n_blocks).alias("cb"), "id", "v")

    def run(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if len(q) == 0 or len(c) == 0:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        a = block_top_k(q["id"].to_numpy(), np.stack(q["v"].to_numpy()), c["id"].to_numpy(), np.stack(c["v"].to_numpy()), k)
        return pd.DataFrame({"query_id": a[0], "vec_id": a[1], "score": a[2]})

    met = left.groupBy("d", "qb", "cb").cogroup(right.groupBy("d", "qb", "cb")).applyInPandas(run, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
