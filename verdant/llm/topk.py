"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Vectors become integers, floor(256 * x).  Queries (ids divisible by 50) meet all
candidates in a grid: candidates in blocks of about ``BLOCK`` rows, queries in
blocks of about ``QUERIES``; a task holds one block of each, whatever the table's
size, and nothing is broadcast.  Rows that repeat both id and vector are counted first and
stand at most k times, for more of them cannot show; rows are dealt by id and vector, so
that an id which many vectors share is spread.  A task sorts its candidates once per dimension.
For each query it reads the lists in the order that favours the query, deeper and
deeper; what the lists have shown is scored in full; it stops when the bound at
that depth (the inner product with the list values there) is below the k-th best
score, for then nothing unseen can reach it, not even as a tie.  The k best of
each block are ranked once more over all blocks.

Defined cases: null vectors and vectors with a null or non-finite component take
no part; fewer than k candidates give all; ties go to the smaller id; null ids
take no part; vectors of another length than the query's are not comparable and
give no row; repeated ids are separate candidates (but never the query's own id);
an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read

K = 5
EVERY = 50
BLOCK = 8192
QUERIES = 2048
FIRST_DEPTH = 16


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & v.isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x * 256).cast("long")).alias("v"),
        F.size(v).alias("dims"))


def threshold_search(query: np.ndarray, vectors: np.ndarray, order: np.ndarray, ids: np.ndarray, own: int, k: int):
    """(indices, scores) of the k best rows for one query; ``order`` sorts each dimension ascending."""
    n = len(vectors)
    down = query >= 0
    seen = np.zeros(n, dtype=bool)
    found, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    depth, at = FIRST_DEPTH, 0
    dims = np.arange(len(query))
    while True:
        depth = min(depth, n)
        shown = np.where(down[:, None], order[:, n - depth:n - at], order[:, at:depth]).ravel() if len(dims) else np.arange(n)
        new = np.unique(shown[~seen[shown]])
        seen[new] = True
        new = new[ids[new] != own]
        found, scores = np.concatenate((found, new)), np.concatenate((scores, vectors[new] @ query))
        if len(found) > k:
            best = np.lexsort((ids[found], -scores))[:k]
            found, scores = found[best], scores[best]
        if depth == n or not len(dims):
            break
        edge = np.where(down, order[:, n - depth], order[:, depth - 1])
        if len(found) == k and vectors[edge, dims] @ query < scores.min():
            break
        at, depth = depth, depth * 2
    rank = np.lexsort((ids[found], -scores))
    return found[rank], scores[rank]


def _block(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(queries) and len(candidates):
            vectors = np.stack(candidates["v"].to_numpy()).astype(np.int64)
            ids = candidates["vec_id"].to_numpy()
            order = np.argsort(vectors, axis=0, kind="stable").T
            for own, q in zip(queries["vec_id"].to_numpy(), queries["v"]):
                found, scores = threshold_search(np.asarray(q, dtype=np.int64), vectors, order, ids, own, k)
                rows.append((np.full(len(found), own), ids[found], scores))
        if not rows:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*rows)))))
    return run


def top_k(vectors: DataFrame, is_query, k: int = K, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``integer_vectors`` that ``is_query`` selects."""
    v = vectors.groupBy("vec_id", "v", "dims").agg(F.count(F.lit(1)).alias("n"))
    v = cut(v.select("vec_id", "v", "dims", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))).alias("copy")))
    counts = v.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()  # one row
    rows, columns = max(1, math.ceil(counts["n"] / block)), max(1, math.ceil(counts["q"] / queries))
    spread = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "v", "copy"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = v.filter(is_query).select("vec_id", "v", "dims", spread(1, columns).alias("c")).withColumn("r", each(rows))
    right = v.select("vec_id", "v", "dims", spread(2, rows).alias("r")).withColumn("c", each(columns))
    key = ["dims", "r", "c"]
    best = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_block(k), "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(integer_vectors(read(spark, sf_dir, "embeddings")), F.col("vec_id") % EVERY == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
