"""Operator 4: exact top-k inner product by pivot-table elimination.

Vectors are turned into integers, floor(scale * x). A table of distances from
every vector to a few pivots (farthest-first picks from a bounded sample) is
computed beforehand. For a query q, candidate x and pivot p,
|d(q,p) - d(x,p)| <= d(q,x), so the largest such value over all pivots is a
lower bound of the distance and (|q|^2 + |x|^2 - bound^2) / 2 an upper bound
of the inner product. Within a block of candidates each query evaluates them
in the order of that bound and stops as soon as its k-th best score exceeds
the next bound: whatever follows cannot enter, so the result is exact.

Spark deals candidates into blocks of bounded size and sends every query, in
blocks of its own, to each candidate block; per-block winners (k a query) meet
in a window. No task holds more than one block of either side.

Defined cases: vectors that are null, hold null or non-finite components, or
have no id take no part; rows repeating an id count once (their smallest
vector); a query sees only vectors of its own length; ties go to the smaller
id; fewer than k candidates give fewer rows; an empty table gives none; scores
must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

BLOCK = 4096        # candidates a block, about
QUERY_BLOCK = 2048  # queries a block, about
PIVOTS = 24
PIVOT_SAMPLE = 1024  # vectors the pivots are chosen from (fit only)
STEP = 128          # candidates evaluated between two looks at the bound

RESULT = "query_id long, vec_id long, score long"


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, dim, vec array<long>) of the rows that take part."""
    v = F.col(vec_col)
    fine = (F.col(id_col).isNotNull() & v.isNotNull()
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    ints = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return (df.where(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("bigint").alias("vec_id"), ints.alias("vec"))
            .groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec")))


def fit_pivots(vectors: DataFrame, n: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> dict:
    """Farthest-first pivots per dimension, from the ``sample`` vectors with
    the smallest id hashes. Pivots only decide how much work is saved."""
    rows = (vectors.select("dim", "vec", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id")
            .limit(sample).collect())
    out = {}
    for dim in {r.dim for r in rows}:
        own = [r.vec for r in rows if r.dim == dim]
        x = np.array(own, np.float64).reshape(len(own), dim)
        chosen, near = [0], np.full(len(x), np.inf)
        while len(chosen) < min(n, len(x)):
            near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(1))
            chosen.append(int(near.argmax()))
        out[dim] = x[chosen]
    return out


def _distances(x: np.ndarray, pivots: dict) -> np.ndarray:
    p, x = pivots.get(x.shape[1]), x.astype(np.float64)
    if p is None:
        return np.zeros((len(x), 1))
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (p * p).sum(1)[None] - 2.0 * x @ p.T, 0.0))


def block_top(qid, q, qd, xid, x, xd, k: int):
    """The k best (scores, ids; smaller id first among ties) of every query in
    one block; integer vectors, so scores are exact."""
    qn, xn = ((v.astype(np.float64) ** 2).sum(1) for v in (q, x))
    out = []
    for i in range(len(q)):
        low = np.abs(xd - qd[i]).max(1)
        high = (qn[i] + xn - low * low) / 2.0
        high += 1e-6 * (1.0 + np.abs(high) + qn[i] + xn)     # rounding only ever widens the bound
        own = xid == qid[i]
        high[own] = -np.inf
        order = np.argsort(-high, kind="stable")
        n = len(order) - int(own.sum())
        best_s = best_i = np.zeros(0, np.int64)
        a = 0
        while a < n and (len(best_s) < k or high[order[a]] >= best_s[-1]):
            take = order[a:min(a + STEP, n)]
            best_s = np.concatenate([best_s, x[take] @ q[i]])
            best_i = np.concatenate([best_i, xid[take]])
            keep = np.lexsort((best_i, -best_s))[:k]
            best_s, best_i = best_s[keep], best_i[keep]
            a += len(take)
        out.append((best_s, best_i))
    return out


def top_k(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of every row
    for which ``is_query`` (an expression over ``vec_id``) holds."""
    from .common import stored
    vectors = stored(integer_vectors(df, id_col, vec_col, scale), "vectors")
    pivots = fit_pivots(vectors)
    sides = vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n_vec"),
                                       F.sum(is_query.cast("int")).alias("n_query")).where(F.col("n_query") > 0)
    dealt = vectors.join(sides, "dim")
    blocks = F.ceil(F.col("n_vec") / BLOCK).cast("int")
    q_blocks = F.ceil(F.col("n_query") / QUERY_BLOCK).cast("int")
    spread = F.xxhash64("vec_id")
    cand = dealt.select("dim", F.pmod(spread, blocks).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), q_blocks - 1)).alias("q_block"), "vec_id", "vec")
    asked = dealt.where(is_query).select(
        F.col("dim").alias("q_dim"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("q_at"),
        F.pmod(spread, q_blocks).cast("int").alias("q_part"), F.col("vec_id").alias("q_id"), F.col("vec").alias("q_vec"))

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        x, q = (np.array(v.tolist(), np.int64).reshape(len(v), int(key[0])) for v in (left.vec, right.q_vec))
        xid, qid = left.vec_id.to_numpy(np.int64), right.q_id.to_numpy(np.int64)
        best = block_top(qid, q, _distances(q, pivots), xid, x, _distances(x, pivots), k)
        n = [len(ids) for _, ids in best]
        return pd.DataFrame({"query_id": np.repeat(qid, n), "vec_id": np.concatenate([ids for _, ids in best]),
                             "score": np.concatenate([s for s, _ in best])})

    best = (cand.groupBy("dim", "block", "q_block").cogroup(asked.groupBy("q_dim", "q_at", "q_part"))
            .applyInPandas(search, RESULT))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (best.withColumn("rank", F.row_number().over(w).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
