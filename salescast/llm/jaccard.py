"""n-gram Jaccard join by signature trees: exact links and their connected groups.

A document is its set of distinct word shingles (64-bit hashes). Equal sets form a class, of which one stands for all.

1. Co-location. Two sets with similarity t or more differ in at most k elements, k following from their size class; if
   the hash space is cut into m > k parts, some part is the same in both. Classes meet only where a part's content is
   equal. Parts that are empty are left out where at least one other must be equal (see Params.keys).
2. Signature trees. Where classes meet, a tree is built over their bitmaps: a node holds the OR of its bitmaps, the
   range of set sizes and the least number of bits. A dual traversal prunes node pairs whose largest possible overlap is
   below what the similarity needs. What it leaves connects clusters of possible links.
3. Verification. The texts of each cluster's classes are brought together in blocks of bounded size, and the same
   traversal runs over exact sets; pairs that are already connected are skipped. Blocks are joined along a ring first, and
   only blocks that hold more than one group after that meet pairwise.

Nothing of a text is cut, no partner is dropped: of very many classes that share a key in one task, one keeps the key and
the others get unpruned edges to it. The key travels marked as hot, and all classes that meet on it, from any task, are
connected by unpruned edges too, so a cluster holds all of the key's classes. Cases: null or empty texts and texts without
words have empty sets and link with nothing; a text of fewer words than a shingle is one shingle; repeated rows and
copies fall in one class; a null doc_id never becomes a group's id unless all are null; an empty table gives no rows;
other columns are not read. A group's id is its smallest doc_id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm.chunks import CACHE_CHARS, strings
from salescast.llm.common import connected, fresh, hand_back, lean, small_side, stage, texts

K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
#: Classes of one key in one task beyond which one stands for the others by unpruned edges.
HOT_KEY = 64
#: Classes of one key, from all tasks, beyond which its unpruned edges are a star and no tree is built.
HOT_MEETING = 2048
#: Classes of a cluster that one task verifies against each other.
BLOCK = 1000
#: Keys that one co-location task is dealt, about.
KEYS_A_BUCKET = 500_000
FANOUT = 8


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Params:
    """Words of a shingle; the least similarity in hundredths."""

    words: int = 4
    percent: int = 85

    def linked(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.percent * (a + b - both)

    @property
    def bounds(self) -> np.ndarray:
        """Least sizes of the size classes: linked sets are of the same or of neighbouring classes."""
        return _bounds(self.percent)

    def role(self, c: int) -> tuple[int, int]:
        """(k, m) for pairs whose smaller set is of class c: most differing elements, and number of parts."""
        top = int(self.bounds[c + 1]) - 1
        total = top + top * 100 // self.percent
        k = total * (100 - self.percent) // (100 + self.percent)
        return k, 1 if k == 0 else k + 1 + -(-(k + 1) // 20)

    def keys(self, s: np.ndarray) -> np.ndarray:
        """Keys of a sorted set; linked unequal sets share one. With k = 0 only equal sets link, which are one class.

        Of the m parts at least m - k are equal in linked sets. If either set has fewer than m - k empty parts, one of
        those is not empty; only a set with more of them gives keys for empty parts too.
        """
        c = int(np.searchsorted(self.bounds, len(s), side="right")) - 1
        out = []
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(s ^ K[4]))))
        for r in (c, c - 1):
            if r < 0 or (km := self.role(r))[0] == 0:
                continue
            k, m = km
            part = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            cut = np.searchsorted(part, np.arange(m + 1))
            key = mix((sums[cut[1:]] - sums[cut[:-1]]) * K[0] + np.uint64(r * int(K[1]) & (1 << 64) - 1) + np.arange(m, dtype=np.uint64) * K[2])
            some = cut[1:] > cut[:-1]
            out.append(key[some] if (~some).sum() < m - k else key)
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


@lru_cache(maxsize=8)
def _bounds(percent: int) -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    return np.array(out)


class Shingler:
    """Sets of texts; the dictionary of word hashes is a cache and starts anew when large."""

    def __init__(self, params: Params):
        self.n, self.words, self.held = params.words, {}, 0
        self.factors = mix(np.arange(params.words, dtype=np.uint64) * K[1] + K[3]) | np.uint64(1)

    def set_of(self, text: str) -> np.ndarray:
        """Sorted distinct shingle hashes of a text: A-Z lower-cased, words between ASCII white space."""
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.n:
            return np.array([xxhash.xxh3_64_intdigest(b"%d " % len(words) + b" ".join(words))], np.uint64)
        known = self.words
        if len(known) > 300_000 or self.held > CACHE_CHARS:
            known.clear()
            self.held = 0
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
            self.held += len(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = len(h) - self.n + 1
        s = h[:n] * self.factors[0]
        for i in range(1, self.n):
            s = s + h[i : i + n] * self.factors[i]
        return np.unique(mix(s))


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def bits_for(n: int) -> int:
    return max(64, 1 << max(0, int(n) - 1).bit_length())


def signature(s: np.ndarray, bits: int) -> np.ndarray:
    flags = np.zeros(bits, bool)
    flags[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little")


def fold(sig: np.ndarray, size: int) -> np.ndarray:
    """A longer bitmap (a power of two bytes) as one of `size` bytes."""
    while len(sig) > size:
        sig = sig[: len(sig) // 2] | sig[len(sig) // 2 :]
    return sig


class Groups:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.up[max(a, b)] = min(a, b)

    def labels(self) -> np.ndarray:
        up = self.up
        while not np.array_equal(up, up[up]):
            up = up[up]
        self.up = up
        return up


def tree_join(sizes: np.ndarray, sigs: np.ndarray, params: Params, verify: Callable[[int, int], bool] | None, groups: Groups) -> None:
    """Connect in `groups` what a dual traversal of the signature tree leaves and `verify` confirms.

    sizes: set sizes; sigs: bitmaps as rows of bytes. A traversal goes level by level over arrays of node pairs.
    """
    n = len(sizes)
    order = np.lexsort((sigs[:, 0], sizes))
    level = [(sigs[order], sizes[order], sizes[order], np.bitwise_count(sigs[order]).sum(axis=1, dtype=np.int64))]
    while len(level[-1][0]) > 1:
        s, lo, hi, pop = level[-1]
        at = np.arange(0, len(s), FANOUT)
        level.append((np.bitwise_or.reduceat(s, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.minimum.reduceat(pop, at)))
    need = lambda a, b: -(-params.percent * (a + b) // (100 + params.percent))

    def able(depth: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        s, lo, hi, pop = level[depth]
        keep = np.zeros(len(p), bool)
        for a in range(0, len(p), 20_000):
            x, y = p[a : a + 20_000], q[a : a + 20_000]
            both = np.bitwise_count(s[x] & s[y]).sum(axis=1, dtype=np.int64)
            most = np.minimum(hi[x] - np.maximum(pop[x] - both, 0), hi[y] - np.maximum(pop[y] - both, 0))
            fit = (100 * hi[x] >= params.percent * lo[y]) & (100 * hi[y] >= params.percent * lo[x])
            keep[a : a + 20_000] = fit & (most >= need(lo[x], lo[y]))
        return keep

    pairs = [(len(level) - 1, np.zeros(1, int), np.zeros(1, int))]
    while pairs:  # depth first, so that later pairs find what earlier ones have connected
        depth, p, q = pairs.pop()
        if depth == 0:
            i, j = order[p], order[q]
            labels = groups.labels()
            apart = labels[i] != labels[j]
            for a, b in zip(i[apart].tolist(), j[apart].tolist(), strict=True):
                if groups.find(a) != groups.find(b) and (verify is None or verify(a, b)):
                    groups.join(a, b)
            continue
        width = len(level[depth - 1][0])
        x = (p[:, None, None] * FANOUT + np.arange(FANOUT)[None, :, None]).repeat(FANOUT, axis=2).ravel()
        y = (q[:, None, None] * FANOUT + np.arange(FANOUT)[None, None, :]).repeat(FANOUT, axis=1).ravel()
        ok = (x < width) & (y < width) & ((x <= y) if depth > 1 else (x < y))
        x, y = x[ok], y[ok]
        ok = able(depth - 1, x, y)
        x, y = x[ok], y[ok]
        for a in range(0, len(x), 4096):
            pairs.append((depth - 1, x[a : a + 4096], y[a : a + 4096]))


def runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Complete runs of equal leading `keys` columns of a stream that is sorted by them, many runs at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        last = [table.column(i)[-1] for i in range(keys)]
        cut = table.num_rows - 1
        while cut > 0 and all(table.column(i)[cut - 1] == last[i] for i in range(keys)):
            cut -= 1
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def hashed(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, text."""
    return texts(docs).select("doc_id", F.xxhash64("text").alias("hash"), "text")


def class_rows(docs: DataFrame, params: Params) -> DataFrame:
    """doc_id, n_shingles, node (the class, null for an empty set), its bitmap and the text's hash, staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        shingler = Shingler(params)
        for batch in batches:
            for a, b, words in strings(batch.column(2), 8_000_000):
                sets = [shingler.set_of(t) for t in words]
                nodes = [digest(s) if len(s) else None for s in sets]
                sigs = [signature(s, bits_for(len(s))).tobytes() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary()), batch.column(1).slice(a, b - a)], names=["doc_id", "n_shingles", "node", "sig", "hash"])
        del shingler
        hand_back()

    return stage(hashed(docs).mapInArrow(run, "doc_id long, n_shingles long, node binary, sig binary, hash long"), "jaccard-rows")


def meetings(docs: DataFrame, params: Params, buckets: int) -> DataFrame:
    """(gid, node, peer): classes that share a key have one gid; where peer is set, it is an unpruned edge of a hot key."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        shingler, sent = Shingler(params), set()
        for batch in batches:
            for _, _, words in strings(batch.column(1), 8_000_000):
                nodes, keys = [], []
                for t in words:
                    s = shingler.set_of(t)
                    node = digest(s) if len(s) else b""
                    if node and node not in sent:
                        sent.add(node)
                        nodes.append(node)
                        keys.append(params.keys(s))
                if len(sent) > 400_000:
                    sent.clear()
                if not nodes:
                    continue
                key, who = np.concatenate(keys), np.repeat(np.arange(len(nodes), dtype=np.uint32), [len(k) for k in keys])
                order = np.argsort(key, kind="stable")
                key, who = key[order], who[order]
                begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, int)
                size = np.diff(np.append(begin, len(key)))
                hot = {}
                drop, flag = np.zeros(len(key), bool), np.zeros(len(key), bool)
                flag[begin[size > HOT_KEY]] = True
                for s0, n in zip(begin[size > HOT_KEY], size[size > HOT_KEY], strict=True):
                    drop[s0 + 1 : s0 + n] = True
                    hot.update({(int(w), int(who[s0])): None for w in who[s0 + 1 : s0 + n]})
                key, who, flag = key[~drop], who[~drop], flag[~drop]
                bucket = (key % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                key, who, flag, bucket = key[order], who[order], flag[order], bucket[order]
                cut = np.searchsorted(bucket, np.arange(buckets + 1))
                raw = np.frombuffer(b"".join(nodes), "V16")
                rows: list[tuple] = []
                for i in np.flatnonzero(cut[1:] > cut[:-1]):
                    used, local = np.unique(who[cut[i] : cut[i + 1]], return_inverse=True)
                    mine = key[cut[i] : cut[i + 1]]
                    rows.append((int(i), mine.tobytes(), local.astype(np.uint32).tobytes(), raw[used].tobytes(), mine[flag[cut[i] : cut[i + 1]]].tobytes(), None, None))
                for u, v in hot:
                    rows.append((int.from_bytes(nodes[u][:4], "little") % buckets, b"", b"", b"", b"", nodes[u], nodes[v]))
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
                for c in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows[c : c + 2000], strict=True), kinds, strict=True)], names=["bucket", "keys", "who", "nodes", "hot", "u", "v"])
        del shingler, sent
        hand_back()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(gid: np.ndarray, node: list[bytes], peer: list[bytes | None]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(gid, pa.int64()), pa.array(node, pa.binary()), pa.array(peer, pa.binary())], names=["gid", "node", "peer"])

        lean()
        for table in runs_of(batches, 1):
            of = np.array(table.column("bucket").to_pylist())
            rows = table.select(["keys", "who", "nodes", "hot", "u", "v"]).to_pylist()
            edges = [(r["u"], r["v"]) for r in rows if r["u"] is not None]
            if edges:
                yield out(np.zeros(len(edges), np.int64), [e[0] for e in edges], [e[1] for e in edges])
            for b in np.unique(of):
                mine = [r for r, x in zip(rows, of == b, strict=True) if x and r["keys"]]
                if not mine:
                    continue
                key = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in mine])
                sizes = [len(r["nodes"]) // 16 for r in mine]
                shift = np.cumsum([0, *sizes[:-1]])
                who = np.concatenate([np.frombuffer(r["who"], np.uint32).astype(np.int64) + s for r, s in zip(mine, shift, strict=True)])
                nodes, same = np.unique(np.frombuffer(b"".join(r["nodes"] for r in mine), np.dtype([("a", ">u8"), ("b", ">u8")])), return_inverse=True)
                who = same[who]
                order = np.lexsort((who, key))
                key, who = key[order], who[order]
                first = np.concatenate(([True], (key[1:] != key[:-1]) | (who[1:] != who[:-1])))
                key, who = key[first], who[first]
                begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                size = np.diff(np.append(begin, len(key)))
                if not (size > 1).any():
                    continue
                raw = [x.tobytes() for x in nodes]
                # a hot key's holder stands for classes that aren't here: nothing that meets it may be pruned; and a key
                # that very many classes bring from many tasks is hot too, since one tree would hold them all
                hot = np.isin(key[begin], np.concatenate([np.frombuffer(r["hot"], np.uint64) for r in mine])) | (size > HOT_MEETING)
                star = np.repeat(hot & (size > 1), size)
                pair = np.unique(np.stack((np.repeat(who[begin], size)[star], who[star])), axis=1)
                pair = pair[:, pair[0] != pair[1]]
                for c in range(0, pair.shape[1], 100_000):
                    u, v = pair[:, c : c + 100_000]
                    yield out(np.zeros(len(u), np.int64), [raw[i] for i in u], [raw[i] for i in v])
                many = np.repeat((size > 1) & ~hot, size)
                if not many.any():
                    continue
                ids = mix(nodes["a"].astype(np.uint64) ^ mix(nodes["b"].astype(np.uint64)))
                total = np.add.reduceat(ids[who], begin)  # the same members have the same gid, whatever the key
                gid = np.repeat(mix(total + size.astype(np.uint64)), size)[many].view(np.int64)
                who = who[many]
                order = np.lexsort((who, gid))
                gid, who = gid[order], who[order]
                first = np.concatenate(([True], (gid[1:] != gid[:-1]) | (who[1:] != who[:-1])))
                gid, who = gid[first], who[first]
                for c in range(0, len(gid), 100_000):
                    yield out(gid[c : c + 100_000], [raw[i] for i in who[c : c + 100_000]], [None] * len(gid[c : c + 100_000]))
        hand_back()

    sent = texts(docs).mapInArrow(send, "bucket int, keys binary, who binary, nodes binary, hot binary, u binary, v binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "gid long, node binary, peer binary")


def _star(groups: Groups, nodes: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    labels = groups.labels()
    away = np.flatnonzero(labels != np.arange(len(labels)))
    return [nodes[i] for i in away], [nodes[labels[i]] for i in away]


def possible_edges(meet: DataFrame, classes: DataFrame, params: Params) -> DataFrame:
    """(u, v): what the signature trees of the meeting classes leave, as a forest of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for table in runs_of(batches, 1):
            gid = table.column("gid").to_numpy()
            cut = np.append(np.flatnonzero(np.concatenate(([True], gid[1:] != gid[:-1]))), len(gid))
            nodes, sizes, raw = table.column("node").to_pylist(), table.column("n").to_numpy(), table.column("sig").to_pylist()
            u: list[bytes] = []
            v: list[bytes] = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b - a < 2:
                    continue
                sigs = [np.frombuffer(x, np.uint8) for x in raw[a:b]]
                least = min(map(len, sigs))
                groups = Groups(int(b - a))
                tree_join(sizes[a:b], np.stack([fold(s, least) for s in sigs]), params, None, groups)
                x, y = _star(groups, nodes[a:b])
                u += x
                v += y
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])
        hand_back()

    met = meet.where("peer is null").select("gid", "node").distinct().join(classes.select("node", "n", "sig"), "node")
    tree = met.select("gid", "node", "n", "sig").repartition("gid").sortWithinPartitions("gid").mapInArrow(run, "u binary, v binary")
    return tree.union(meet.where("peer is not null").select("node", "peer")).where("u <> v").distinct()


def verified_edges(cells: DataFrame, params: Params) -> DataFrame:
    """cells(cell, node, label, text) -> (u, v): a forest of each cell's links between classes of different labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        shingler = Shingler(params)
        for table in runs_of(batches, 1):
            cell = np.array(table.column("cell").to_pylist())
            cut = np.append(np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))), len(cell))
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                rows = {r["node"]: r for r in table.slice(a, b - a).to_pylist()}
                sets = {k: shingler.set_of(r["text"]) for k, r in rows.items()}
                nodes = [k for k, s in sets.items() if digest(s) == k]  # another text of a repeated doc_id doesn't count
                if len(nodes) < 2:
                    continue
                sets = [sets[k] for k in nodes]
                sizes = np.array([len(s) for s in sets])
                bits = bits_for(int(np.median(sizes)))
                groups, first = Groups(len(nodes)), {}
                for i, k in enumerate(nodes):
                    if rows[k]["label"] is not None:
                        groups.join(i, first.setdefault(rows[k]["label"], i))

                def linked(i: int, j: int, sets=sets) -> bool:
                    x, y = sets[i], sets[j]
                    at = np.searchsorted(y, x)
                    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                    return params.linked(both, len(x), len(y))

                tree_join(sizes, np.stack([signature(s, bits) for s in sets]), params, linked, groups)
                x, y = _star(groups, nodes)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["u", "v"])
        del shingler
        hand_back()

    return cells.select("cell", "node", "label", "text").repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "u binary, v binary")


def link_classes(docs: DataFrame, rows: DataFrame, params: Params) -> DataFrame:
    """(node, root): connected classes, for classes that are linked with another one."""
    classes = stage(rows.where("node is not null").groupBy("node").agg(F.min("n_shingles").alias("n"), F.min(F.struct("doc_id", "hash")).alias("held_by"), F.first("sig").alias("sig")), "jaccard-classes")
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(16, 1 << int(total * 2 * (100 - params.percent) / 100 // KEYS_A_BUCKET).bit_length())
    meet = stage(meetings(docs, params, buckets), "jaccard-meet")
    clusters = stage(connected(possible_edges(meet, classes, params), "jaccard-possible"), "jaccard-clusters")
    members = clusters.union(clusters.select(F.col("root").alias("node"), "root")).distinct()
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = stage(
        members.join(sizes, "root").join(classes.select("node", "held_by"), "node")
        .select("node", F.col("root").alias("cluster"), "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), F.col("held_by.doc_id").alias("d2"), F.col("held_by.hash").alias("h2")),
        "jaccard-placed",
    )
    # by id and text: rows that share an id, or have none, don't meet each other's classes
    held = stage(hashed(docs).join(small_side(placed), F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("hash") == F.col("h2"))).select("node", "cluster", "blocks", "block", "text"), "jaccard-texts")
    if held.count() > placed.count():  # rows that repeat in full
        held = stage(held.groupBy("node", "cluster", "blocks", "block").agg(F.first("text").alias("text")), "jaccard-texts-once")
    name = lambda i, j: F.concat_ws(":", F.hex("cluster"), i, j)
    ring = F.array_distinct(F.array(F.col("block"), F.pmod(F.col("block") - 1, F.col("blocks"))))
    around = held.select("node", "text", F.lit(None).cast("binary").alias("label"), "cluster", F.explode(ring).alias("c")).withColumn("cell", name(F.col("c"), F.lit("r")))
    edges = stage(verified_edges(around, params), "jaccard-ring")
    links = stage(connected(edges, "jaccard-links"), "jaccard-linked")
    wide = held.where("blocks > 3")
    if wide.isEmpty():  # every pair of blocks is on the ring
        return links
    label = wide.drop("text").distinct().join(links, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    open_ = label.groupBy("cluster").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("cluster")
    blocks = label.join(open_, "cluster").groupBy("cluster", "block").agg(F.min("label").alias("a"), F.max("label").alias("b"))
    x, y = blocks.alias("x"), blocks.alias("y")
    apart = x.join(y, (F.col("x.cluster") == F.col("y.cluster")) & (F.col("x.block") + 1 < F.col("y.block")) & ~((F.col("x.a") == F.col("y.b")) & (F.col("x.b") == F.col("y.a"))))
    cells = stage(apart.select("x.cluster", F.col("x.block").alias("i"), F.col("y.block").alias("j")), "jaccard-cells")
    ends = cells.select("cluster", "i", "j", F.explode(F.array("i", "j")).alias("block"))
    more = label.join(wide.select("node", "text"), "node").join(ends, ["cluster", "block"]).withColumn("cell", name(F.col("i"), F.col("j")))
    rest = stage(verified_edges(more, params), "jaccard-rest")
    return connected(links.select(F.col("node").alias("u"), F.col("root").alias("v")).union(rest), "jaccard-all")


def _grouped(docs: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """class_rows, and (node, root) of all classes."""
    rows = class_rows(docs, params)
    links = stage(link_classes(docs, rows, params), "jaccard-final")
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    return rows, nodes.join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))


def jaccard_groups(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, in one row per input row."""
    rows, nodes = _grouped(docs, params or Params())
    ids = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(ids, "root").select(F.col("node").alias("n2"), "component_id")
    return rows.join(named, rows["node"] == named["n2"], "left").select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """docs with all columns and one row of each group: the smallest doc_id (nulls last), then the smallest text hash.

    Rows without shingles all stay.
    """
    rows, nodes = _grouped(docs, params or Params())
    names = nodes.select(F.col("node").alias("n2"), "root")
    placed = rows.join(names, rows["node"] == names["n2"]).select("root", F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash")
    first = placed.groupBy("root").agg(F.min(F.struct("no_id", "doc_id", "hash")).alias("f"))
    repeated = placed.groupBy("root", "no_id", "doc_id", "hash").agg(F.count(F.lit(1)).alias("copies"))
    state = repeated.join(first, "root").select(F.col("doc_id").alias("d2"), F.col("hash").alias("h2"), (F.struct("no_id", "doc_id", "hash") == F.col("f")).alias("stays"), "copies")
    d2, h2, stays, hold = (fresh(docs, f"__{c}") for c in ("d2", "h2", "stays", "hash"))
    # What goes, and the kept rows that repeat in full: few next to the documents.
    odd = stage(state.where("not stays or copies > 1").select(F.col("d2").alias(d2), F.col("h2").alias(h2), F.col("stays").alias(stays)), "jaccard-odd")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumn(hold, F.xxhash64(text)).join(small_side(odd), F.col("doc_id").cast("long").eqNullSafe(F.col(d2)) & (F.col(hold) == F.col(h2)), "left")
    single = marked.where(F.col(stays).isNull()).select(*docs.columns)
    if odd.where(stays).isEmpty():
        return single
    return single.unionByName(marked.where(stays).dropDuplicates(["doc_id", hold]).select(*docs.columns))
