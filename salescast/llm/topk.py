"""Exact top-k inner-product search by no-random-access aggregation over sorted lists.

Candidates are dealt into blocks by a hash of their id, queries too; a cell is a block of each. In a cell every dimension
is one sorted list of codes. A query reads the lists it weighs sequentially, from the end that serves its sign, to a common
depth; every candidate then has a lower bound (what is unread counts as the list's worst) and an upper bound (what is unread
counts as the last one read). Reading to a depth is the same for a whole batch of queries, so the bounds of a batch are
matrix products with the lists as read: each code where it has been read, the last code read (or the worst) where not.
Outsiders are those whose upper bound is below the k-th lower bound of the query, from this cell or carried in from the
cell of its first candidates; when the lists have been read to the depth at which few others are left, those are resolved
to their scores. At full depth both bounds are the score. A cell gives k rows a query, and a window over a query's cells
picks the best.

Cases: a null vector, one with null or non-finite components, and a null id take no part; equal rows count once; where an
id has several vectors each is a candidate and the least one is the query; a query's own id is never its answer; only
vectors of the same length are compared; ties go to the smaller id; an empty table gives no rows. Scores are 64-bit
integers: vectors whose product could need more raise; bounds are doubles while they are exact (below 2^53), else every
score is resolved in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.common import finite, stage

SCALE, K, QUERY_STEP = 64, 20, 20
CANDIDATES_A_BLOCK, QUERIES_A_BLOCK, QUERIES_AT_ONCE = 8192, 4096, 256
#: Shares of the lists that are read; share of a batch's candidates left at which reading stops.
DEPTHS, FEW = (0.125, 0.5, 1.0), 0.05


class Lists:
    """A block of candidates and, by dimension, its codes in order: what has been read to a depth from either end."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        at = np.argsort(ids, kind="stable")
        self.ids, self.codes = ids[at], codes[at]
        self.exact = self.codes.astype(np.float64)
        self.sorted = np.sort(self.exact, axis=0)
        self.read: dict[float, tuple[np.ndarray, ...]] = {}

    def to_depth(self, share: float) -> tuple[np.ndarray, ...]:
        """(upper from the top, upper from the bottom, lower from the top, lower from the bottom) of every code."""
        got = self.read.get(share)
        if got is None:
            n = len(self.ids)
            depth = max(1, int(np.ceil(n * share)))
            high, low = self.sorted[n - depth], self.sorted[depth - 1]  # the last ones read
            x = self.exact
            got = self.read[share] = (np.maximum(x, high), np.minimum(x, low), np.where(x >= high, x, self.sorted[0]), np.where(x <= low, x, self.sorted[-1]))
        return got

    def search(self, own: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best of each query; least: scores that k candidates elsewhere reach."""
        most = int(np.abs(queries).max(initial=0)) * int(np.abs(self.codes).max(initial=0)) * queries.shape[1]
        if most >= 2**63:
            raise OverflowError("a score needs more than 64 bits")
        n = len(self.ids)
        up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
        alive = self.ids[None, :] != own[:, None]
        kth = least.astype(np.float64)
        scores = None
        for share in DEPTHS if most < 2**53 and n > 8 * k else ():
            if share == 1.0:  # all is read: the bounds are the score
                scores = queries.astype(np.float64) @ self.exact.T
                break
            top, bottom, worst_top, worst_bottom = self.to_depth(share)
            lower = up @ worst_top.T + down @ worst_bottom.T
            lower[self.ids[None, :] == own[:, None]] = -np.inf
            kth = np.maximum(kth, np.partition(lower, n - k, axis=1)[:, n - k])
            alive &= up @ top.T + down @ bottom.T >= kth[:, None]
            if alive.sum() <= FEW * alive.size:
                break
        out = []
        for i in range(len(own)):
            some = np.flatnonzero(alive[i])
            if scores is None:
                values = self.codes[some] @ queries[i]
            else:
                some = some[scores[i, some] >= kth[i]]
                values = scores[i, some].astype(np.int64)
            if len(some) > k:
                keep = values >= np.partition(values, len(values) - k)[len(values) - k]
                some, values = some[keep], values[keep]
            best = np.lexsort((self.ids[some], -values))
            out.append((self.ids[some][best], values[best]))
        return out


def exact_topk(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """vectors(id, codes array<long>), queries(id, codes) -> query_id, rank, vec_id, score."""
    vectors, queries = stage(vectors, "topk-vectors"), stage(queries, "topk-queries")
    cb = -(-vectors.count() // CANDIDATES_A_BLOCK) or 1
    qb = -(-queries.count() // QUERIES_A_BLOCK) or 1
    left = queries.select("id", "codes", F.pmod(F.xxhash64("id"), F.lit(qb)).cast("int").alias("qi"), F.size("codes").alias("dim"))
    right = vectors.select("id", "codes", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(cb)).cast("int").alias("ci"), F.size("codes").alias("dim"))

    def cell(q: pa.Table, c: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if q.num_rows and c.num_rows:
            matrix = lambda t: t.column("codes").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            own, codes, least = q.column("id").to_numpy(), matrix(q), q.column("least").to_numpy()
            lists = Lists(c.column("id").to_numpy(), matrix(c))
            for a in range(0, len(own), QUERIES_AT_ONCE):
                some = slice(a, a + QUERIES_AT_ONCE)
                found += [(int(i), *r) for i, r in zip(own[some], lists.search(own[some], codes[some], least[some], k), strict=True)]
        joined = lambda at, kind: np.concatenate([f[at] for f in found]) if found else np.zeros(0, kind)
        ids = np.repeat(np.array([f[0] for f in found], dtype=np.int64), [len(f[1]) for f in found]) if found else np.zeros(0, np.int64)
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(joined(1, np.int64), pa.int64()), "score": pa.array(joined(2, np.int64), pa.int64())})

    def cells(asked: DataFrame, candidates: DataFrame, first: int, last: int) -> DataFrame:
        """The answers of candidate blocks first..last-1; a vector goes to each block of queries, a query to each of candidates."""
        numbers = lambda a, b: F.explode(F.sequence(F.lit(a), F.lit(b - 1)))
        x = asked.select("id", "codes", "least", "dim", "qi", numbers(first, last).alias("ci"))
        y = candidates.where(F.col("ci").between(first, last - 1)).select("id", "codes", F.col("dim").alias("dim2"), F.col("ci").alias("ci2"), numbers(0, qb).alias("qi2"))
        return x.groupBy("dim", "qi", "ci").cogroup(y.groupBy("dim2", "qi2", "ci2")).applyInArrow(cell, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # an id of several vectors counts once
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    none = F.lit(-(1 << 62)).alias("least")
    found = cells(left.select("*", none), right, 0, 1)
    if cb > 1:  # what the first block gives carries into the others: there, only better or equal ones count
        found = stage(found, "topk-first")
        reached = ranked(found).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("reached"))
        carried = left.join(reached, "id", "left").select("id", "codes", "dim", "qi", F.coalesce("reached", none).alias("least"))
        found = found.union(cells(carried, right, 1, cb))
    return ranked(found)


def topk_query(embeddings: DataFrame) -> DataFrame:
    codes = F.transform("embedding", lambda x: F.floor(SCALE * x.cast("double")).cast("long"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & finite("embedding")).select(F.col("vec_id").cast("long").alias("id"), codes.alias("codes")).where("size(codes) > 0").distinct()
    queries = rows.where(F.col("id") % QUERY_STEP == 0).groupBy("id").agg(F.min("codes").alias("codes"))
    return exact_topk(rows, queries)


SQL = f"""
WITH v AS (
  SELECT DISTINCT CAST(vec_id AS BIGINT) AS id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), q AS (SELECT id, min(e) AS e FROM v WHERE id % {QUERY_STEP} = 0 GROUP BY id),
s AS (
  SELECT q.id AS query_id, v.id AS vec_id, max(CAST(list_inner_product(q.e, v.e) AS BIGINT)) AS score
  FROM q JOIN v ON v.id <> q.id AND len(v.e) = len(q.e) GROUP BY 1, 2
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {K}
"""
