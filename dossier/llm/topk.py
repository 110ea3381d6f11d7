"""Exact top-k search by integer inner product, with MaxScore pruning in every shard.

Vectors are dealt into shards and queries into blocks by hashes of their ids; each (shard, block) cell is one
bounded piece of work that meets every vector with every query once.  Within a cell a dimension is a query term
and a shard's column its posting list.  A term's bound is the most it can add with the shard's extremes.  The
terms with the smallest bounds are non-essential as long as they cannot lift a vector over the k-th score found
so far: essential postings are traversed for all vectors, and the rest is probed only for vectors that are still
competitive.  The k best of each shard are merged per query.

Edge cases: vectors (or ids) that are null, and vectors with null or non-finite components, take no part;
an id that repeats counts once, with its smallest vector (compared as a list); shorter vectors count as padded with
zeros; other columns are ignored.  Scores are exact, and ties decided, up to 2^43 (2^53 over the rows of a strip).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
SHARD_ROWS, BLOCK_ROWS, STRIP_ROWS = 4096, 4096, 1024


def matrix(vectors: pd.Series) -> np.ndarray:
    """floor(SCALE * x) of all vectors, as float64 rows padded with zeros."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return np.floor(SCALE * out)


def max_score(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(vector ids, scores) of the k best vectors of one shard for each query, -inf where there are fewer; ``x_ids``
    ascend, so equal scores prefer earlier rows."""
    width = max(q.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, x))
    top, low = x.max(0), x.min(0)
    bounds = np.maximum(q * top, q * low)  # what each term can add at most
    order = np.argsort(np.abs(bounds).max(0))  # one order of terms for the block: smallest bounds first
    best = np.full((len(q), k), -np.inf)
    best_id = np.zeros((len(q), k), np.int64)
    for at in range(0, len(x), STRIP_ROWS):
        strip, ids = x[at:at + STRIP_ROWS], x_ids[at:at + STRIP_ROWS]
        floor = best[:, -1]
        # non-essential: the most terms whose bounds together reach no query's k-th score
        sums = np.cumsum(bounds[:, order], axis=1)
        split = int(np.argmax(np.append((sums >= floor[:, None]).any(0), True))) if np.isfinite(floor).all() else 0
        rest, essential = order[:split], order[split:]
        scores = q[:, essential] @ strip[:, essential].T
        if split:
            open_ = scores + sums[:, split - 1][:, None] >= floor[:, None]
            if open_.mean() > 0.1:
                scores = np.where(open_, scores + q[:, rest] @ strip[:, rest].T, -np.inf)
            else:
                i, j = np.nonzero(open_)
                probed = scores[i, j] + np.einsum("nd,nd->n", q[np.ix_(i, rest)], strip[np.ix_(j, rest)])
                scores = np.full_like(scores, -np.inf)
                scores[i, j] = probed
        scores[q_ids[:, None] == ids[None, :]] = -np.inf
        keys = scores * len(ids) - np.arange(len(ids))  # ties: the smaller id
        n = min(k, len(ids))
        cand = np.argpartition(-keys, n - 1, axis=1)[:, :n]
        cand = np.take_along_axis(cand, np.argsort(-np.take_along_axis(keys, cand, 1), axis=1, kind="stable"), 1)
        both = np.hstack([best, np.take_along_axis(scores, cand, 1)])
        both_id = np.hstack([best_id, ids[cand]])
        keep = np.argsort(-both, axis=1, kind="stable")[:, :k]
        best, best_id = np.take_along_axis(both, keep, 1), np.take_along_axis(both_id, keep, 1)
    return best_id, best


def search(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for each row that ``is_query`` selects, itself left out."""
    finite = F.forall(embedding, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf)))
    usable = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & finite)
    rows = usable.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"),
                         F.coalesce(is_query, F.lit(False)).alias("q"))
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("m")).collect()[0]
    shards, blocks = max(1, -(-sizes["n"] // SHARD_ROWS)), max(1, -(-sizes["m"] // BLOCK_ROWS))
    deal = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("vec_id", "v", deal(1, shards).alias("shard"), all_of(blocks).alias("block"))
    right = rows.where("q").select("vec_id", "v", deal(2, blocks).alias("block"), all_of(shards).alias("shard"))

    def once(d: pd.DataFrame) -> pd.DataFrame:
        """One row for each id, ids ascending; an id's rows are all in one cell."""
        again = d["vec_id"].duplicated(keep=False)
        if again.any():
            least = d[again].assign(v=d["v"][again].map(tuple)).sort_values(["vec_id", "v"]).drop_duplicates("vec_id")
            d = pd.concat([d[~again], least])
        return d.sort_values("vec_id")

    def cell(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        x, q = (once(d) for d in (x, q))
        if not len(x) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        ids, scores = max_score(matrix(q["v"]), q["vec_id"].to_numpy(), matrix(x["v"]), x["vec_id"].to_numpy(), k)
        found = np.isfinite(scores)
        return pd.DataFrame({"query_id": np.repeat(q["vec_id"].to_numpy(), found.sum(1)), "vec_id": ids[found],
                             "score": scores[found].astype(np.int64)})

    best = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(
        cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
