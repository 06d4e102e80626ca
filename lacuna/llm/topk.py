"""Exact top-k search by inner product over impact-ordered posting segments.

The index holds, for a block of vectors and each quantised impact level (the bit length of a
component's absolute value), the postings whose component has that level. A block of queries adds
one level's segments at a time to its scores, in descending order of impact. The components that are
still to come can change a score by at most |query| * |rest of the vector|, so after each level the
k-th best lower bound proves which vectors can't be among the k best. Once few can, the search stops
and those are rescored exactly; else it ends with the lowest level, where scores are exact.

Every block of queries meets every block of vectors in a task of its own; both sides are dealt to
blocks of bounded size by a hash of vec_id, and each pair of blocks returns k rows for a query.

Rows: vectors that are null or hold a null or non-finite component take no part. Shorter vectors
count as padded with zeros. Of rows with equal vec_id the one with the smallest vector counts, rows
without vec_id take no part. Ties go to the smaller vec_id. Scores beyond a long raise an error.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lacuna.session import cut_lineage

VECTORS, QUERIES = 4096, 1024  # of a block
FEW = 0.02  # stop once this share of all pairs is still possible


def quantised(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(64 * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def levels(vectors: np.ndarray):
    """(postings of a level as a matrix, norms of what is left below it), by descending level."""
    level = np.frexp(np.abs(vectors).astype(np.float64))[1]
    left = vectors.astype(np.float64)
    for at in np.unique(level[vectors != 0])[::-1]:
        here = level == at
        left = np.where(here, 0, left)
        yield np.where(here, vectors, 0), np.sqrt((left * left).sum(1))


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """(query's row, vector's row, score) of the k best vectors for each query, by score, then id; not its own."""
    top = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1])
    if top >= 1 << 62:
        raise ArithmeticError("scores beyond a long")
    kind = np.float32 if top < 1 << 23 else np.float64 if top < 1 << 52 else np.int64
    q, own = queries.astype(kind), query_ids[:, None] == ids[None, :]
    scores, norms = np.zeros((len(q), len(ids)), kind), np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    need, possible, exact = min(k, len(ids)), ~own, True
    for segment, rest in levels(vectors):
        scores += q @ segment.astype(kind).T
        exact = not rest.any()
        if kind is np.int64 or exact:
            continue
        slack = norms[:, None] * rest[None, :] * (1 + 1e-6) + 1e-6
        low = np.where(own, -np.inf, scores - slack)
        least = np.partition(low, -need, axis=1)[:, -need] if need else np.zeros(len(q))
        possible = ~own & (scores + slack >= least[:, None])
        if possible.mean() <= FEW:
            break
    if exact:
        possible = ~own
    for i in range(len(q)):
        at = np.nonzero(possible[i])[0]
        score = scores[i, at].astype(np.int64) if exact else vectors[at].astype(np.int64) @ queries[i].astype(np.int64)
        if len(at) > k:
            least = np.partition(score, -k)[-k]
            at, score = at[score >= least], score[score >= least]
        best = np.lexsort((ids[at], -score))[:k]
        yield i, at[best], score[best]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out, lists = np.zeros((len(column), width), np.int64), column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy()
    return out


def _width(column: pa.ChunkedArray) -> int:
    return int(np.diff(column.combine_chunks().offsets.to_numpy()).max(initial=0)) if len(column) else 0


def top_k(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all rows of ``vectors`` (vec_id, embedding) for
    the rows whose vec_id is divisible by ``every``."""
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    rows = cut_lineage(rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(quantised(F.col("embedding"))).alias("v")))
    asked = rows.filter(F.col("vec_id") % every == 0)
    n, m = rows.count(), asked.count()
    blocks, groups = max(1, -(-n // VECTORS)), max(1, -(-m // QUERIES))
    block = lambda salt, count: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(count)).cast("int")
    every_ = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = rows.select("vec_id", "v", block(1, blocks).alias("block"), every_(groups).alias("group"))
    right = asked.select("vec_id", "v", block(2, groups).alias("group"), every_(blocks).alias("block"))

    def run(these: pa.Table, those: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 3
        if len(these) and len(those):
            width = max(_width(these["v"]), _width(those["v"]))
            ids, query_ids = these["vec_id"].to_numpy(), those["vec_id"].to_numpy()
            best = list(search(ids, _matrix(these["v"], width), query_ids, _matrix(those["v"], width), k))
            found = [np.concatenate([np.full(len(at), query_ids[i]) for i, at, _ in best]),
                     np.concatenate([ids[at] for _, at, _ in best]), np.concatenate([s for _, _, s in best])]
        return pa.table(found, names=["query_id", "vec_id", "score"])

    near = (left.groupBy("block", "group").cogroup(right.groupBy("block", "group"))
            .applyInArrow(run, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
