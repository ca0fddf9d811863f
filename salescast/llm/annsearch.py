"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The largest inner product becomes the least distance by one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and
0 for a query. A bounded sample of the vectors (FIT_ROWS) is split by k-means into up to BRANCH children a node until a node
has its share of LEAVES; every row of the table then goes down the tree to its leaf. A query walks the tree by a priority
queue: the nearest open node comes next, an inner node opens its children, a leaf is a visit. How many leaves are visited is
calibrated: CALIBRATION queries are also answered by brute force over all rows, and visits widen leaf by leaf until their
mean recall reaches TARGET; at all leaves the search is exact.

The leaves are packed, in tree order, into bins of some BIN_ROWS rows, and queries into blocks by their first leaf; a leaf
or block that is larger is dealt by a hash of the id. A cell is a block of queries with a bin that one of them visits; it
scores only visited leaves and gives k rows a query, of which a window picks the best. Cases: vectors that are null, empty,
zero or hold null or non-finite components, and null ids, take no part; equal rows count once; where an id has several
vectors each is a candidate, the best one counts, and the least one is the query; a query's own id is never its answer; only
vectors of the same length are compared; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.common import finite, stage

K, QUERY_STEP = 20, 20
#: Rows that the tree is fitted on, at most; children of a node; rows of a leaf that are aimed at; leaves at most.
FIT_ROWS, BRANCH, LEAF_ROWS, LEAVES = 32_768, 16, 512, 2_048
#: Queries whose recall is measured by brute force, and the mean recall at which visits stop widening.
CALIBRATION, TARGET = 256, 0.95
BIN_ROWS, BLOCK_QUERIES, AT_ONCE = 8_192, 4_096, 256
#: Part of a score by which the order of a sum may change it.
SLACK = 1e-9


@dataclass
class Tree:
    """Nodes in depth-first order: node i's children are kids[i], its leaf number leaf[i] (-1: an inner node)."""

    scale: float
    norm: float  # the largest squared norm of scaled vectors
    centers: np.ndarray
    kids: list[np.ndarray]
    leaf: list[int]

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def lift(self, rows: np.ndarray) -> np.ndarray:
        """Rows with the coordinate that makes the largest inner product the least distance."""
        rows = rows / self.scale
        return np.column_stack((rows, np.sqrt(np.maximum(self.norm - (rows * rows).sum(axis=1), 0.0))))

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: down the tree by the nearest child."""
        x, out = self.lift(rows), np.empty(len(rows), dtype=np.int32)
        open_nodes = [(0, np.arange(len(rows)))]
        while open_nodes:
            node, at = open_nodes.pop()
            if self.leaf[node] >= 0:
                out[at] = self.leaf[node]
                continue
            child = nearest(x[at], self.centers[self.kids[node]])
            open_nodes += [(int(k), at[child == j]) for j, k in enumerate(self.kids[node]) if (child == j).any()]
        return out

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first `most` leaves that best-bin-first traversal comes to."""
        q = np.append(query / self.scale, 0.0)
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                continue
            gap = self.centers[self.kids[node]] - q
            for d, k in zip(np.einsum("ij,ij->i", gap, gap).tolist(), self.kids[node].tolist(), strict=True):
                heapq.heappush(queue, (d, k))
        return out


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers * centers).sum(axis=1) - 2 * (x @ centers.T)).argmin(axis=1)


def grow(sample: np.ndarray, scale: float, norm: float, leaves: int, seed: int = 13) -> Tree:
    """Hierarchical k-means over the sample, in at most some `leaves` leaves."""
    rng = np.random.default_rng(seed)
    tree = Tree(scale, norm, np.zeros((0, 0)), [], [])
    x = tree.lift(sample)
    share = max(1.0, len(x) / max(1, leaves))
    centers: list[np.ndarray] = []
    n_leaves = 0

    def add(at: np.ndarray) -> int:
        nonlocal n_leaves
        node = len(centers)
        centers.append(x[at].mean(axis=0))
        tree.kids.append(np.zeros(0, dtype=np.int64))
        tree.leaf.append(-1)
        parts: list[np.ndarray] = []
        if len(at) > share * 1.5:
            k = int(min(BRANCH, max(2, np.ceil(len(at) / share))))
            mid = x[rng.choice(at, k, replace=False)]
            for _ in range(8):
                child = nearest(x[at], mid)
                mid = np.array([x[at[child == j]].mean(axis=0) for j in range(len(mid)) if (child == j).any()])
            child = nearest(x[at], mid)
            parts = [at[child == j] for j in range(len(mid)) if (child == j).any()]
        if len(parts) > 1:
            tree.kids[node] = np.array([add(p) for p in parts])
        else:
            tree.leaf[node], n_leaves = n_leaves, n_leaves + 1
        return node

    add(np.arange(len(x)))
    tree.centers = np.array(centers)
    return tree


def matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.ascontiguousarray(flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1), dtype=np.float64)


def best(ids: np.ndarray, rows: np.ndarray, query: np.ndarray, own: int, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of the candidates; rough: their scores but for rounding, -inf where not visited.

    Scores are summed anew in one fixed order, so that equal vectors tie whatever their place.
    """
    alive = np.flatnonzero((ids != own) & (rough > -np.inf))
    reach = k
    while len(alive):
        kth = np.partition(rough[alive], len(alive) - reach)[len(alive) - reach] if len(alive) > reach else -np.inf
        near = alive[rough[alive] >= kth - SLACK * (1 + abs(kth))] if kth > -np.inf else alive
        scores = (rows[near] * query).sum(axis=1)
        order = np.lexsort((ids[near], -scores))
        _, first = np.unique(ids[near][order], return_index=True)  # an id's best row
        first.sort()
        if len(first) >= k or len(near) == len(alive):
            order = order[first[:k]]
            return ids[near][order], scores[order]
        reach += k - len(first)  # repeated ids among the k: look further
    return ids[:0], np.zeros(0)


def answers(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    ids = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    scores = np.concatenate([f[2] for f in found]) if found else np.zeros(0)
    queries = np.repeat(np.array([f[0] for f in found], dtype=np.int64), [len(f[1]) for f in found]) if found else ids
    return pa.table({"query_id": pa.array(queries, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(scores, pa.float64())})


def ranked(found: DataFrame, k: int) -> DataFrame:
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Exact answers of a few queries, over all rows(id, vec): each task gives its own best ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                own, x = b.column(0).to_numpy(), matrix(b.column(1), b.num_rows)
                rough = queries @ x.T
                yield from answers([(int(i), *best(own, x, q, i, r, k)) for i, q, r in zip(ids, queries, rough, strict=True)]).to_batches()

    return ranked(rows.select("id", "vec").mapInArrow(run, "query_id long, vec_id long, score double"), k)


def placed(rows: DataFrame, tree: Tree) -> DataFrame:
    """rows(id, vec) with the column leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.place(matrix(b.column(1), b.num_rows)) if b.num_rows else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaf, pa.int32())], names=["id", "vec", "leaf"])

    return rows.select("id", "vec").mapInArrow(run, "id long, vec array<double>, leaf int")


def routed(queries: DataFrame, tree: Tree, most: int) -> DataFrame:
    """queries(id, vec) with the leaves they visit, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            visits = [tree.visits(q, most) for q in matrix(b.column(1), b.num_rows)] if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(visits, pa.list_(pa.int32()))], names=["id", "vec", "leaves"])

    return queries.select("id", "vec").mapInArrow(run, "id long, vec array<double>, leaves array<int>")


def packs(sizes: dict[int, int], groups: int, most: int) -> tuple[list[int], list[int]]:
    """(first pack, number of packs) of each group: neighbours share a pack, a group of over `most` rows has its own."""
    first, many, pack, held = [], [], 0, 0
    for g in range(groups):
        n = sizes.get(g, 0)
        own = -(-n // most)
        if held and (own > 1 or held + n > most):
            pack, held = pack + 1, 0
        first.append(pack)
        many.append(max(1, own))
        if own > 1:
            pack, held = pack + own, 0
        else:
            held += n
    return first, many


def dealt(group: str, by: str, first: list[int], many: list[int]):
    """Column: the pack of a row."""
    at = F.col(group) + 1
    return F.element_at(F.lit(first), at) + F.pmod(F.xxhash64(by), F.element_at(F.lit(many), at)).cast("int")


def search(rows: DataFrame, queries: DataFrame, k: int = K, target: float = TARGET, note: dict | None = None) -> DataFrame:
    """Staged rows(id, vec) of one length, staged queries(id, vec) -> query_id, rank, vec_id, score.

    note: gets the leaves, the visits of a query and the calibration queries' recall.
    """
    n, n_queries = rows.count(), queries.count()
    if not n or not n_queries:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    scale = rows.agg(F.max(F.array_max(F.transform("vec", F.abs)))).first()[0]
    norm = rows.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale)))).first()[0]

    def some(df: DataFrame, total: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        share = min(1.0, most / total)
        part = df.where(F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1_000_003)) < F.lit(share * 1_000_003)).orderBy("id", "vec").limit(most).toArrow()
        return part.column("id").to_numpy(), matrix(part.column("vec"), part.num_rows) if part.num_rows else np.zeros((0, 0))

    _, sample = some(rows, n, FIT_ROWS)
    if not len(sample):
        _, sample = some(rows, 1, FIT_ROWS)  # a table of few ids
    tree = grow(sample, scale, norm, min(LEAVES, -(-n // LEAF_ROWS)))
    index = stage(placed(rows, tree), "ann-index")

    test_ids, test = some(queries, n_queries, CALIBRATION)
    if not len(test_ids):
        test_ids, test = some(queries, 1, CALIBRATION)
    truth = brute_force(rows, test_ids, test, k).join(index.select(F.col("id").alias("vec_id"), "leaf"), "vec_id").select("query_id", "leaf").collect()  # k rows a calibration query
    order = {int(i): {leaf: at for at, leaf in enumerate(tree.visits(q, tree.leaves))} for i, q in zip(test_ids, test, strict=True)}
    reached = np.sort([order[r["query_id"]][r["leaf"]] for r in truth])
    most = int(reached[max(0, int(np.ceil(target * len(reached))) - 1)]) + 1 if len(reached) else tree.leaves
    if note is not None:
        note.update(leaves=tree.leaves, visits=most, recall=float(np.mean(reached < most)) if len(reached) else 1.0)

    sizes = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}  # a row for each leaf
    bin_at, bins = packs(sizes, tree.leaves, BIN_ROWS)
    routes = stage(routed(queries, tree, most).withColumn("home", F.col("leaves")[0]), "ann-routes")
    homes = {r["home"]: r["count"] for r in routes.groupBy("home").count().collect()}
    block_at, block_n = packs(homes, tree.leaves, BLOCK_QUERIES)

    visits = routes.select("id", "vec", dealt("home", "id", block_at, block_n).alias("qi"), F.explode("leaves").alias("leaf"))
    leaf_bins = F.sequence(F.element_at(F.lit(bin_at), F.col("leaf") + 1), F.element_at(F.lit(bin_at), F.col("leaf") + 1) + F.element_at(F.lit(bins), F.col("leaf") + 1) - 1)
    left = visits.select("id", "vec", "qi", "leaf", F.explode(leaf_bins).alias("ci")).groupBy("qi", "ci", "id", "vec").agg(F.collect_list("leaf").alias("leaves"))  # at most the leaves of a bin
    left = stage(left, "ann-visits")
    cells = left.select(F.col("qi").alias("block"), F.col("ci").alias("bin")).distinct()
    right = index.withColumn("bin", dealt("leaf", "id", bin_at, bins)).join(cells, "bin")

    def cell(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            return answers([])
        c = c.sort_by([("leaf", "ascending"), ("id", "ascending")])
        ids, x, leaf = c.column("id").to_numpy(), matrix(c.column("vec"), c.num_rows), c.column("leaf").to_numpy()
        parts = {int(f): (np.searchsorted(leaf, f), np.searchsorted(leaf, f, "right")) for f in np.unique(leaf)}
        own, vec, leaves = q.column("id").to_numpy(), matrix(q.column("vec"), q.num_rows), q.column("leaves").to_pylist()
        out = []
        for a in range(0, len(own), AT_ONCE):
            some = vec[a : a + AT_ONCE]
            rough = np.full((len(some), len(ids)), -np.inf)
            by: dict[int, list[int]] = {}
            for i, visited in enumerate(leaves[a : a + AT_ONCE]):
                for f in visited:
                    by.setdefault(f, []).append(i)
            for f, at in by.items():
                if f in parts:
                    rough[at, slice(*parts[f])] = some[at] @ x[slice(*parts[f])].T
            out += [(int(i), *best(ids, x, v, i, r, k)) for i, v, r in zip(own[a : a + AT_ONCE], some, rough, strict=True)]
        return answers(out)

    found = left.groupBy("qi", "ci").cogroup(right.groupBy("block", "bin")).applyInArrow(cell, "query_id long, vec_id long, score double")
    return ranked(found, k)


def ann_query(embeddings: DataFrame, note: dict | None = None) -> DataFrame:
    """The contract's rows: queries are the rows whose vec_id is divisible by 20."""
    vec = F.transform("embedding", lambda c: c.cast("double") + F.lit(0.0))
    rows = embeddings.where(F.col("vec_id").isNotNull() & finite("embedding")).where(F.exists("embedding", lambda c: c != 0))
    rows = stage(rows.select(F.col("vec_id").cast("long").alias("id"), vec.alias("vec")).distinct(), "ann-rows")
    out = None
    for length in sorted(r[0] for r in rows.select(F.size("vec")).distinct().collect()):  # one length as a rule
        part = stage(rows.where(F.size("vec") == length), "ann-part") if out is not None or rows.where(F.size("vec") != length).limit(1).count() else rows
        queries = stage(part.where(F.col("id") % QUERY_STEP == 0).groupBy("id").agg(F.min("vec").alias("vec")), "ann-queries")
        found = search(part, queries, note=note)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
