"""Exact top-k by inner product: columnar branch and bound.

Queries and candidates are dealt into blocks of bounded size, and each pair of blocks is one group of
work. A group holds its candidates by columns (one row of the matrix a dimension). For a query, scores
are summed one block of dimensions after the other; what the rest can still add is at most the product
of the two vectors' remaining lengths, and at least its negative. The k-th best lower bound so far is
the threshold: candidates whose upper bound is below it leave, and the survivors are compacted.

Vectors that are null or hold a null or a number that isn't finite take no part. Of rows with one id
only the least vector counts, so repeated rows count once. Vectors of other lengths than the query's
are no candidates. Without vectors the result is empty.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 20
SCALE = 64
CANDIDATES = 4096
QUERIES = 2048
DIMENSIONS = 8
EXACT = 2.0**53
FOUND = "query_id bigint, vec_id bigint, score bigint"


def integer_vectors(vectors: DataFrame, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and floor(scale * x) for each x, as doubles, without the rows that take no part."""
    x = F.col(vector)
    sound = F.forall(x, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    ints = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("double"))
    rows = vectors.filter(x.isNotNull() & sound & F.col(vec_id).isNotNull())
    return rows.select(F.col(vec_id).alias("vec_id"), ints.alias("vector")).groupBy("vec_id").agg(
        F.min("vector").alias("vector")
    )


def rest_norms(columns: np.ndarray, step: int) -> np.ndarray:
    """Row b: each vector's length over the dimensions after block b."""
    squares = np.add.reduceat(columns**2, np.arange(0, len(columns), step), axis=0)
    after = np.cumsum(squares[::-1], axis=0)[::-1]
    return np.sqrt(np.vstack([after[1:], np.zeros((1, columns.shape[1]))]))


def best_of(
    queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, k: int = K,
    step: int = DIMENSIONS,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query up to k (query id, candidate id, score), highest scores and then least ids."""
    if candidates.shape[1] == 0:  # empty vectors: all scores are 0
        step, candidates, queries = 1, np.zeros((len(candidates), 1)), np.zeros((len(queries), 1))
    largest = np.abs(candidates).max(initial=0) * np.abs(queries).max(initial=0) * candidates.shape[1]
    if largest >= EXACT:
        candidates, queries = candidates.astype(object), queries.astype(object)
        candidates = np.vectorize(int, otypes=[object])(candidates)
        queries = np.vectorize(int, otypes=[object])(queries)
        step = candidates.shape[1]
    order = np.argsort(ids, kind="stable")
    ids, columns = ids[order], np.ascontiguousarray(candidates[order].T)
    dims = len(columns)
    blocks = [slice(at, min(at + step, dims)) for at in range(0, dims, step)]
    if step < dims:
        own = np.argsort(-np.abs(columns).mean(axis=1), kind="stable")  # heavy dimensions first
        columns, queries = np.ascontiguousarray(columns[own]), queries[:, own]
        norms, query_norms = rest_norms(columns, step), rest_norms(np.ascontiguousarray(queries.T), step)
    out_q, out_c, out_s = [], [], []
    for q, (query, query_id) in enumerate(zip(queries, query_ids, strict=True)):
        at = np.searchsorted(ids, query_id)
        mine = at if at < len(ids) and ids[at] == query_id else -1
        alive = None  # all
        scores = query[blocks[0]] @ columns[blocks[0]]
        if mine >= 0:
            alive = np.delete(np.arange(len(ids)), mine)
            scores = scores[alive]
        for b, block in enumerate(blocks):
            if b:
                part = columns[block] if alive is None else columns[block][:, alive]
                scores = scores + query[block] @ part
            if b < len(blocks) - 1 and len(scores) > k:
                # Bounds are widened by one, far more than the norms' rounding.
                slack = query_norms[b, q] * (norms[b] if alive is None else norms[b, alive]) + 1
                least = np.partition(scores - slack, len(scores) - k)[len(scores) - k]
                keep = np.flatnonzero(scores + slack >= least)
                if len(keep) < 0.8 * len(scores):
                    alive = keep if alive is None else alive[keep]
                    scores = scores[keep]
        if len(scores) > k and scores.dtype != object:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = np.flatnonzero(scores >= least)
            alive, scores = keep if alive is None else alive[keep], scores[keep]
        # Candidates are in order of their ids, which a stable sort keeps among equals.
        top = np.argsort(-scores, kind="stable")[:k]
        out_q.append(np.full(len(top), query_id))
        out_c.append(ids[top if alive is None else alive[top]])
        out_s.append(scores[top])
    join = lambda parts: np.concatenate(parts) if parts else np.array([], np.int64)
    return join(out_q), join(out_c), join(out_s)


def top_k(
    vectors: DataFrame, is_query, k: int = K, candidates_a_block: int = CANDIDATES, queries_a_block: int = QUERIES
) -> DataFrame:
    """query_id, rank, vec_id and score; `vectors` as integer_vectors gives them, `is_query` a
    condition on vec_id."""
    total = vectors.count()
    blocks = max(1, math.ceil(total / candidates_a_block))
    sides = max(1, math.ceil(vectors.filter(is_query).count() / queries_a_block))
    rows = vectors.withColumn("_dim", F.size("vector"))
    own = F.xxhash64("vec_id")
    candidates = rows.withColumn("_c", F.pmod(own, F.lit(blocks)).cast("int")).withColumn(
        "_q", F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))
    )
    queries = rows.filter(is_query).withColumn("_q", F.pmod(own, F.lit(sides)).cast("int")).withColumn(
        "_c", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        q, c, s = best_of(
            np.stack(left["vector"].to_list()), left["vec_id"].to_numpy(),
            np.stack(right["vector"].to_list()), right["vec_id"].to_numpy(), k,
        )
        return pd.DataFrame({"query_id": q, "vec_id": c, "score": [int(x) for x in s]}, dtype="int64")

    key = ["_dim", "_q", "_c"]
    found = queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(search, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
