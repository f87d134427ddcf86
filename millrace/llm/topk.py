"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

BLOCK = 4096        # candidates with lists of their own
QUERY_BLOCK = 2048
STRIDE = 16         # list entries read at a time, in every dimension
FOUND = "query_id bigint, vec_id bigint, score bigint"


class SortedLists:
    """A block of vectors, with its vectors in order of each component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.falling = np.argsort(-self.vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(self.vectors, self.falling, axis=0)

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors but the query's own, best first, ties to the smaller id.

        A dimension's list is read from its large end where the query is
        positive there, else from its small end.  Nothing unread can score more
        than the product of the query with the values read last; once that is
        below the k-th score, the rest is left.
        """
        n = len(self.ids)
        dims = np.flatnonzero(query)
        up = query[dims] > 0
        seen = np.zeros(n, bool)
        own = np.searchsorted(self.ids, [query_id, query_id + 1])
        seen[own[0]:own[1]] = True
        best, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, max(n, 1), STRIDE):
            until = min(at + STRIDE, n)
            places = np.arange(at, until)[:, None]
            read = self.falling[np.where(up, places, n - 1 - places), dims]
            new = np.zeros(n, bool)
            new[read.ravel() if len(dims) else places.ravel()] = True
            fresh = np.flatnonzero(new & ~seen)
            seen[fresh] = True
            best = np.concatenate([best, fresh])
            scores = np.concatenate([scores, self.vectors[fresh] @ query])
            if len(best) > k:
                kept = np.lexsort((best, -scores))[:k]
                best, scores = best[kept], scores[kept]
            edge = self.values[np.where(up, until - 1, n - until), dims]
            if len(best) == k and scores.min() > int(edge @ query[dims]) or seen.all():
                break
        kept = np.lexsort((best, -scores))[:k]
        return self.ids[best[kept]], scores[kept]


def scaled(vectors: DataFrame, key: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, v): floor(scale * x) of every component as long; rows that hold a null or non-finite one are left out."""
    x = F.transform(vector, lambda c: c.cast("double"))
    sound = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    return vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(key).alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("bigint")).alias("v"))


def top_inner_products(vectors: DataFrame, k: int, queries: str, key: str = "vec_id", vector: str = "embedding",
                       scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query, ties to the smaller id.

    Queries are the rows for which the SQL condition ``queries`` holds;
    candidates are all rows with another key and as many components.  Of several
    rows with one key the smallest vector counts.  Blocks of candidates meet
    blocks of queries; every pair of blocks gives at most k rows per query.
    """
    rows = scaled(vectors, key, vector, scale).groupBy("id").agg(F.min("v").alias("v"))
    rows = rows.withColumn("dims", F.size("v"))
    asking = rows.filter(queries.replace(key, "id"))
    n, asked = rows.count(), asking.count()
    blocks, query_blocks = -(-max(n, 1) // BLOCK), -(-max(asked, 1) // QUERY_BLOCK)
    # Each row goes to every block of the other side: as many copies as there are blocks.
    left = rows.select("dims", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"), "id", "v")
    right = asking.select("dims", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1))).alias("block"),
                          F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int").alias("query_block"),
                          "id", "v")
    by = ["dims", "block", "query_block"]

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ids = table.column("id").to_numpy()
        return ids.astype(np.int64), flat.astype(np.int64).reshape(len(ids), -1)

    def search(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if candidates.num_rows and asked.num_rows:
            lists = SortedLists(*matrix(candidates))
            for query_id, query in zip(*matrix(asked)):
                ids, scores = lists.top(int(query_id), query, k)
                found.append((np.full(len(ids), query_id), ids, scores))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(search, FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def top_sql(k: int, queries: str, scale: int = 256) -> str:
    """The same rows as SQL over ``embeddings``."""
    return f"""
WITH sound AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     rows AS (SELECT vec_id, min(list_transform(x, lambda c: floor({scale} * c)::BIGINT)) AS v FROM sound GROUP BY 1),
     scores AS (SELECT q.vec_id AS query_id, c.vec_id,
                       list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
                FROM rows q JOIN rows c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.{queries})
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scores QUALIFY rank <= {k}"""
