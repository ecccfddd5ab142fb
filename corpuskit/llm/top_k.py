"""Exact top-k search by inner product, pruned block by block."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.tables import load
from .workers import ship

# Vectors and queries that meet in one task, and the vectors of a block.
SHARD = 4096
QUERIES_AT_ONCE = 4096
BLOCK = 256


def quantised(vector: str | Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, in double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    rows = column.combine_chunks()
    lengths = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = rows.flatten().to_numpy()
    return out


def _in_ranges(matrix: np.ndarray, block: int) -> np.ndarray:
    """An order of the rows that keeps similar ones in the same block: halves by the widest component."""
    todo, done = [np.arange(len(matrix))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= block:
            done.append(rows)
            continue
        values = matrix[rows]
        widest = np.argmax(values.max(0) - values.min(0))
        half = len(rows) // 2 // block * block or block
        rows = rows[np.argsort(values[:, widest], kind="stable")]
        todo += [rows[half:], rows[:half]]
    return np.concatenate(done)


def best(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int = BLOCK
) -> list[tuple[int, int, int]]:
    """(query id, id, score) of each query's k best vectors but its own, ties to the smaller id.

    A block's bound is the sum over components of what its largest or smallest
    value there can add. Each query takes the blocks from the highest bound
    down, scores all vectors of a block, and stops when the bound is below its
    k-th best score.
    """
    if len(vectors) and len(queries):
        reach = np.abs(queries.astype(float)).max() * np.abs(vectors.astype(float)).max() * vectors.shape[1]
        if reach >= 2.0**62:  # too large for 64 bits
            queries, vectors = queries.astype(object), vectors.astype(object)
    order = _in_ranges(vectors, block) if len(vectors) else np.zeros(0, np.int64)
    ids, vectors = ids[order], vectors[order]
    firsts = np.arange(0, len(ids), block)
    if not len(firsts):
        return []
    high = np.maximum.reduceat(vectors, firsts)
    low = np.minimum.reduceat(vectors, firsts)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    out = []
    for q, (query, bound) in enumerate(zip(queries, bounds, strict=True)):
        own_ids, own_scores, kth = np.zeros(0, np.int64), np.zeros(0, vectors.dtype), None
        for b in np.argsort(-bound, kind="stable"):
            if kth is not None and bound[b] < kth:
                break
            rows = slice(firsts[b], firsts[b] + block)
            scores = vectors[rows] @ query
            take = ids[rows] != query_ids[q]
            if kth is not None:
                take &= scores >= kth
            if not take.any():
                continue
            own_ids = np.concatenate([own_ids, ids[rows][take]])
            own_scores = np.concatenate([own_scores, scores[take]])
            top = sorted(range(len(own_ids)), key=lambda i: (-own_scores[i], own_ids[i]))[:k]
            own_ids, own_scores = own_ids[top], own_scores[top]
            if len(top) == k:
                kth = own_scores[-1]
        scores = (min(max(int(s), -(2**63)), 2**63 - 1) for s in own_scores)
        out += [(int(query_ids[q]), int(i), s) for i, s in zip(own_ids, scores, strict=True)]
    return out


def top_k(
    df: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    shard: int = SHARD,
    queries_at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all rows for each row for which `is_query` holds.

    Scores are inner products of integers, see `quantised`. Rows without key and
    vectors that are null or have null or infinite components take no part;
    missing components count as zero; of rows that share a key the smallest
    vector counts; scores beyond 64 bits are given as the nearest number. Queries and vectors are dealt into groups of bounded size by a
    hash of the key; each pair of groups is one call of `best`, and the best of
    all groups are put together per query. Nothing is broadcast.
    """
    spark = df.sparkSession
    ship(spark)
    own = df.filter(F.col(key).isNotNull() & _usable(vector))
    own = own.select(F.col(key).cast("bigint").alias("id"), quantised(vector).alias("v"), is_query.alias("asks"))
    rows = own.groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    n, n_queries, width = own.agg(
        F.count(F.lit(1)), F.count_if("asks"), F.coalesce(F.max(F.size("v")), F.lit(0))
    ).first()
    n_shards, n_groups = (max(1, math.ceil(x / size)) for x, size in ((n, shard), (n_queries, queries_at_once)))
    each = lambda count, name: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    mine = lambda count, name: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int").alias(name)
    vectors = rows.select("id", "v", mine(n_shards, "shard"), each(n_groups, "asked"))
    queries = rows.filter("asks").select("id", "v", mine(n_groups, "asked"), each(n_shards, "shard"))

    def run(asking: pa.Table, asked: pa.Table) -> pa.Table:
        found = best(
            asking["id"].to_numpy(),
            _matrix(asking["v"], width),
            asked["id"].to_numpy(),
            _matrix(asked["v"], width),
            k,
        )
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    meeting = queries.groupBy("shard", "asked").cogroup(vectors.groupBy("shard", "asked"))
    found = meeting.applyInArrow(run, "query_id bigint, vec_id bigint, score bigint")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best vectors for every vector whose id is divisible by 50."""
    return top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {"op5_top_k": op5_top_k}

ORACLES = {
    "op5_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM flat q JOIN flat c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5"""
}
