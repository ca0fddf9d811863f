"""Byte-level BPE by merge replay over the distinct words of a block of the corpus.

A task takes its block's texts, finds the distinct words, and replays the merges on many of them at once: an inverted
index from token pairs, by their rank, to positions in all words, visited in rank order, some ranks at a time for short
words and one at a time for long ones, where a merge touches only its two neighbours. Words never merge with each other, so blocks are independent and the result is that of the whole corpus;
nothing is shuffled and a lost block is simply done again. Cases: a null text is empty (no ids, empty bytes); null
doc_ids and repeated rows are kept; an empty table gives no rows; `encode` keeps all other columns.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm.chunks import AT_ONCE, CACHE_CHARS, SLICE_CHARS, ChunkCoder, Codes, columns, gather, slices
from salescast.llm.common import fresh, hand_back, lean

DEFAULT_RANKS = "byte_bpe_multi_50k.tiktoken"
#: Places of a rank from which they are merged at once.
MANY = 24
#: Places whose pairs are looked up at a time.
PLACES = 1 << 16
#: Bytes of a word from which its ranks are visited one at a time.
LONG = 64
#: Bytes of shorter words that are merged together, and the places whose ranks are visited together.
TOGETHER, VISITED = 1 << 18, 1 << 14
#: The rank of no pair.
NO_RANK = np.int32(2**31 - 1)


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_RANKS)


@dataclass(frozen=True)
class Bounds:
    """What a worker holds: entries after which its caches start anew, and the new chunks and the characters that it works on at a time.

    Results don't depend on them.
    """

    chunks: int = 300_000
    words: int = 50_000
    new: int = AT_ONCE
    chars: int = SLICE_CHARS


#: For a job whose earlier stages have filled the executors: half the memory beside the vocabulary, for more time.
LEAN = Bounds(chunks=100_000, words=20_000, new=25_000, chars=500_000)


class PairTable:
    """Rank of a pair of token ids, for arrays of pairs: an open-addressing table of all pairs that make a token."""

    EMPTY = np.int64(-1)

    def __init__(self, ranks: dict[bytes, int]):
        found: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    found[a << 32 | b] = rank
        self.found = found
        size = 1 << max(10, (4 * len(found)).bit_length())
        self.mask = size - 1
        self.keys, self.ranks = np.full(size, self.EMPTY), np.full(size, -1, dtype=np.int32)
        keys, values = np.array(list(found), dtype=np.int64), np.array(list(found.values()), dtype=np.int32)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # each round, one key takes each free slot; the others go on
            free = self.keys[at[left]] == self.EMPTY
            slots, first = np.unique(at[left[free]], return_index=True)
            taken = left[free][first]
            self.keys[slots], self.ranks[slots] = keys[taken], values[taken]
            left = np.setdiff1d(left, taken, assume_unique=True)
            at[left] = (at[left] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h >> np.uint64(32)) & np.uint64(self.mask)).astype(np.int64)

    def of(self, a: np.ndarray | int, b: np.ndarray | int) -> np.ndarray:
        """Ranks of the pairs, -1 where they make no token or an id is negative."""
        keys = np.left_shift(a, 32, dtype=np.int64) | np.asarray(b, dtype=np.int64)
        keys[(np.asarray(a) < 0) | (np.asarray(b) < 0)] = -2  # no pair, and no empty slot
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.ranks[at], np.int32(-1))
        left = np.flatnonzero((seen != keys) & (seen != self.EMPTY))
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            seen = self.keys[at]
            hit = seen == keys[left]
            out[left[hit]] = self.ranks[at[hit]]
            go = ~hit & (seen != self.EMPTY)
            left, at = left[go], at[go]
        return out


def ascending(places: np.ndarray) -> np.ndarray:
    """The distinct places in order."""
    out = np.sort(places)
    return out[np.diff(out, prepend=-1) > 0]


class MergeReplay:
    """Ranks of a vocabulary and the replay of its merges on many words."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, bounds: Bounds = Bounds()):  # noqa: B008
        self.bounds, self.ranks, self.pattern = bounds, ranks, regex.compile(pattern)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.table = PairTable(ranks)
        self.forget()
        self.coder = ChunkCoder(self.chunks, bounds.chunks, self.spaced, bounds.new)
        flat = b"".join(self.bytes_of[r] for r in sorted(self.bytes_of))
        size = max(self.bytes_of) + 1
        self.token_lens = np.array([len(self.bytes_of.get(r, b"")) for r in range(size)], dtype=np.int64)
        self.token_starts = np.concatenate(([0], np.cumsum(self.token_lens)[:-1]))
        self.token_bytes = np.frombuffer(flat, dtype=np.uint8)

    def clear(self) -> None:
        """Drop the caches: the worker lives on and serves other stages."""
        self.coder.clear()
        self.forget()

    def forget(self) -> None:
        """Start the cache of words anew: their numbers, and by number where their ids stand."""
        self.words, self.word_chars = Codes(), 0
        self.starts, self.lens, self.flat = array("q"), array("q"), array("i")

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word."""
        ids, counts = self.merged(words)
        ends = np.cumsum(counts).tolist()
        return [ids[b - n : b].tolist() for b, n in zip(ends, counts.tolist(), strict=True)]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, number of ids of each)."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ids, places, counts = [np.zeros(0, np.int32)], [], np.zeros(len(words), np.int64)
        short = np.flatnonzero(sizes < LONG)
        parts = np.split(short, np.flatnonzero(np.diff(np.cumsum(sizes[short]) // TOGETHER)) + 1)
        for merge, where in [(self._merge_short, x) for x in parts] + [(self._merge_long, np.flatnonzero(sizes >= LONG))]:
            if len(where):
                got, counts[where] = merge([words[i] for i in where.tolist()])
                ids.append(got)
                places.append(where)
        if len(places) < 2:
            return ids[-1], counts
        order = np.concatenate(places)  # the words in the order in which their ids stand
        starts = np.empty(len(words), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return gather(np.concatenate(ids), starts, counts), counts

    def _merge_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """`merged` for words of few bytes.

        The index lists places by the rank of their pair. Its ranks are visited in order, those of about VISITED places
        at a time: in each step, every word that has such places merges its lowest, the leftmost of equal ones, and new
        pairs of these ranks or lower are merged in the next steps; those of higher ranks go into the index. Since words
        never merge with each other, each goes through its merges in the same order as if alone.
        """
        raw = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", dtype=np.uint8)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        n = len(raw)
        sym = self.byte_id[raw]
        sym[np.concatenate(([0], np.cumsum(sizes + 1)))] = -1  # between words: no pair reaches over it
        word = np.repeat(np.arange(-1, len(words), dtype=np.int32), np.concatenate(([1], sizes + 1)))
        nxt, prv = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        rank = np.full(n, NO_RANK)  # of the pair that begins at a place
        for a in range(0, n - 1, PLACES):
            rank[a : a + PLACES][: n - 1 - a] = self._ranks(sym[a : a + PLACES][: n - 1 - a], sym[a + 1 : a + 1 + PLACES])
        at = np.flatnonzero(rank < NO_RANK).astype(np.int32)
        at = at[np.argsort(rank[at], kind="stable")]
        first = rank[at]
        later = np.zeros(0, np.int32)  # places that merges have brought into the index
        done = 0
        while done < len(at) or len(later):
            high = NO_RANK  # the ranks below are visited
            if done + VISITED < len(at):
                high = max(first[done + VISITED], first[done] + np.int32(1))
            upto = np.searchsorted(first, high)
            # a place whose pair has changed since stands in the index again, by its new rank
            soon = rank[later] < high
            p, later, done = np.concatenate((at[done:upto], later[soon])), later[~soon], upto
            p = ascending(p[rank[p] < high])
            posted = [later]
            while len(p):
                head = np.flatnonzero(np.diff(word[p], prepend=-2))
                lowest = np.minimum.reduceat(rank[p].astype(np.int64) << 32 | p, head)
                r, m = (lowest >> 32).astype(np.int32), (lowest & 0xFFFFFFFF).astype(np.int32)
                gone, left = nxt[m], prv[m]
                after = nxt[gone]
                sym[m], sym[gone], rank[gone] = r, -2, NO_RANK
                nxt[m], prv[after] = after, m
                rank[m], rank[left] = self._ranks(r, sym[after]), self._ranks(sym[left], r)
                both = np.concatenate((m, left))
                new = rank[both]
                posted.append(both[(new >= high) & (new < NO_RANK)])
                p, again = p[rank[p] < high], left[rank[left] < high]
                if len(again):
                    p = ascending(np.concatenate((p, again)))
            later = np.concatenate(posted)
            if high == NO_RANK:
                break
        alive = sym >= 0
        return sym[alive], np.bincount(word[alive], minlength=len(words))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, NO_RANK where they make no token."""
        found = self.table.of(a, b)
        found[found < 0] = NO_RANK
        return found

    def _merge_long(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """`merged`, one rank at a time.

        The index holds, by the rank of a pair, the positions where the pair stands in any of the words. Ranks are
        applied in order: all places of a rank at once where there are many, else one by one; a merge looks only at its
        two neighbours, whose new pairs go into the index.
        """
        raw = np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        begin = np.concatenate(([0], ends[:-1] + 1))
        n = len(raw)
        symbols, following, before = array("i", bytes(4 * n)), array("i", bytes(4 * n)), array("i", bytes(4 * n))
        sym, nxt, prv = (np.frombuffer(x, dtype=np.int32) for x in (symbols, following, before))
        sym[:] = self.byte_id[raw]
        sym[ends] = -1  # a word's end: no pair reaches over it
        nxt[:], prv[:] = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        nxt[-1] = n - 1
        prv[0] = 0  # the first place has none before it
        mark = np.zeros(n, dtype=np.int8)
        first = np.empty(n - 1, dtype=np.int32)
        for a in range(0, n - 1, PLACES):
            first[a : a + PLACES] = self.table.of(sym[a : a + PLACES][: n - 1 - a], sym[a + 1 : a + 1 + PLACES])
        at = np.flatnonzero(first >= 0).astype(np.int32)
        at = at[np.argsort(first[at], kind="stable")]
        ranks, cut = np.unique(first[at], return_index=True)
        cuts = array("q", [*cut.tolist(), len(at)])
        given = {r: k for k, r in enumerate(ranks.tolist())}  # first places of a rank: at[cuts[k] : cuts[k + 1]], listed when its turn comes
        index: dict[int, list[int]] = {}
        heap = list(given)
        heapq.heapify(heap)
        known = self.table.found.get

        def post(rank: int, place: int) -> None:
            got = index.get(rank)
            if got is None:
                index[rank] = [place]
                heapq.heappush(heap, rank)
            else:
                got.append(place)

        while heap:
            r = heapq.heappop(heap)
            places, k = index.pop(r, None), given.pop(r, None)
            if k is not None:
                places = at[cuts[k] : cuts[k + 1]].tolist() + (places or [])
            if places is None:
                continue
            if len(places) >= MANY and self._merge_many(r, places, sym, nxt, prv, mark, post):
                continue
            places.sort()
            for k, p in enumerate(places):
                q = following[p]
                a, b = symbols[p], symbols[q]
                if a < 0 or b < 0 or known(a << 32 | b) != r:
                    continue  # a neighbour has been merged since
                symbols[p], symbols[q] = r, -2
                after, left = following[q], before[p]
                following[p], before[after] = after, p
                lower = False
                if left != p and symbols[left] >= 0 and (x := known(symbols[left] << 32 | r)) is not None:
                    post(x, left)
                    lower = x < r
                if symbols[after] >= 0 and (x := known(r << 32 | symbols[after])) is not None:
                    post(x, p)
                    lower = lower or x < r
                if lower and k + 1 < len(places):  # a merge of lower rank comes first; this rank goes on after it
                    index.setdefault(r, []).extend(places[k + 1 :])
                    heapq.heappush(heap, r)
                    break
        alive = np.flatnonzero(sym >= 0)
        return sym[alive], np.diff(np.searchsorted(alive, np.append(begin, n)))

    def _merge_many(self, r: int, places: list[int], sym: np.ndarray, nxt: np.ndarray, prv: np.ndarray, mark: np.ndarray, post: Callable[[int, int], None]) -> bool:
        """Apply rank r at all its places; False, with nothing done, if a merge makes a pair of lower rank."""
        p = np.array(places, dtype=np.int32)
        p.sort()
        p = p[np.concatenate(([True], p[1:] != p[:-1]))]
        q = nxt[p]
        fit = self.table.of(sym[p], sym[q]) == r
        p, q = p[fit], q[fit]
        if not len(p):
            return True
        chained = np.concatenate(([False], q[:-1] == p[1:]))  # as in a run of one symbol: every other place, from the left
        if chained.any():
            start = np.maximum.accumulate(np.where(chained, 0, np.arange(len(p))))
            p = p[(np.arange(len(p)) - start) % 2 == 0]
            q = nxt[p]
        after, left = nxt[q], prv[p]
        # what stands beside each place once all are merged
        mark[q], mark[p] = 1, 2
        lefts, rights = np.where(mark[left] == 1, r, sym[left]), np.where(mark[after] == 2, r, sym[after])
        lefts[left == p] = -1
        mark[q] = mark[p] = 0
        x, y = self.table.of(lefts, r), self.table.of(r, rights)
        if ((x >= 0) & (x < r)).any() or ((y >= 0) & (y < r)).any():
            return False
        sym[p], sym[q] = r, -2
        nxt[p], prv[after] = after, p
        for rank, place in zip(x[x >= 0].tolist(), prv[p][x >= 0].tolist(), strict=True):
            post(rank, place)
        for rank, place in zip(y[y >= 0].tolist(), p[y >= 0].tolist(), strict=True):
            post(rank, place)
        return True

    def _matches(self, found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all matches of the pattern in a row, number of ids of each, whether it begins with a space)."""
        if not found:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, bool)
        if len(self.words) > self.bounds.words or self.word_chars > CACHE_CHARS:
            self.forget()
        coded = pa.array(found, pa.string()).dictionary_encode()
        at, distinct = coded.indices.to_numpy(), coded.dictionary
        codes, new = self.words.of(distinct.to_numpy(zero_copy_only=False).tolist())
        raw = list(map(str.encode, new))
        known = np.fromiter(map(self.ranks.get, raw, repeat(-1)), dtype=np.int32, count=len(raw))
        rest = np.flatnonzero(known < 0)
        ids, counts = self.merged([raw[i] for i in rest.tolist()])
        lens, starts = np.ones(len(new), np.int64), np.arange(len(new), dtype=np.int64)  # a word that is a token
        lens[rest], starts[rest] = counts, len(new) + np.cumsum(counts) - counts
        self.starts.frombytes((starts + len(self.flat)).tobytes())
        self.lens.frombytes(lens.tobytes())
        self.flat.frombytes(known.tobytes() + ids.astype(np.int32, copy=False).tobytes())
        self.word_chars += sum(map(len, new))
        codes = codes[at]
        lens, starts = np.frombuffer(self.lens, dtype=np.int64)[codes], np.frombuffer(self.starts, dtype=np.int64)[codes]
        return gather(np.frombuffer(self.flat, dtype=np.int32), starts, lens), lens, pc.starts_with(distinct, " ").to_numpy(zero_copy_only=False)[at]

    def _apart(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in a row, number of ids of each), whatever they hold."""
        found = [self.pattern.findall(c) for c in chunks]
        ids, lens, _ = self._matches(list(chain.from_iterable(found)))
        sums, ends = np.concatenate(([0], np.cumsum(lens))), np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))
        return ids, np.diff(sums[ends], prepend=0)

    def chunks(self, chunks: list[str]) -> list[list[int]]:
        """Token ids of each string, each match of the pattern apart."""
        ids, counts = self._apart(chunks)
        ends = np.cumsum(counts).tolist()
        return [ids[b - n : b].tolist() for b, n in zip(ends, counts.tolist(), strict=True)]

    def spaced(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all in a row, number of ids of each) of clean words with a space before each, matched as one text."""
        ids, lens, begins = self._matches(self.pattern.findall(" " + " ".join(words)))
        head = np.flatnonzero(begins)
        if len(head) != len(words) or head[0] != 0:  # a pattern that the rule doesn't hold for
            return self._apart([" " + w for w in words])
        return ids, np.add.reduceat(lens, head)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all rows, number of bytes of each row)."""
        lens = self.token_lens[ids]
        sums = np.concatenate(([0], np.cumsum(lens)))
        ends = np.cumsum(counts)
        return gather(self.token_bytes, self.token_starts[ids], lens), sums[ends] - sums[ends - counts]


@lru_cache(maxsize=2)
def load(path: str, pattern: str, bounds: Bounds = Bounds()) -> MergeReplay:  # noqa: B008
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return MergeReplay(ranks, pattern, bounds)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32), type=pa.int32())


def _binary(raw: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The stretches of `sizes` bytes that raw is made of."""
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, _offsets(sizes).buffers()[1], pa.py_buffer(raw.tobytes())])


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None, decoded: str | None = None, digest: str | None = None, bounds: Bounds = Bounds()) -> DataFrame:  # noqa: B008
    """docs with the array<int> column `ids` in place of the text.

    decoded: and the binary column of that name, what those ids decode to, in the same pass: a `decode` after it would
    keep a second worker a task, with a vocabulary of its own. digest: and the SHA-256 of those bytes, in lowercase hex,
    without the bytes leaving the worker.
    """
    path, pattern, hold = path or ranks_path(), _pattern(), fresh(docs, "__text")
    src = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != text), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(hold))
    schema = T.StructType([f for f in src.schema.fields if f.name != hold] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False))])
    if decoded:
        schema.add(decoded, T.BinaryType())
    if digest:
        schema.add(digest, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        replay = load(path, pattern, bounds)
        for batch in batches:
            for a, b, words in columns(batch.column(batch.schema.get_field_index(hold)), bounds.chars):
                flat, counts = replay.coder.texts(words)
                kept = [batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)]
                back: list[pa.Array] = []
                if decoded or digest:
                    raw, sizes = replay.decode(flat, counts)
                    if decoded:
                        back.append(_binary(raw, sizes))
                    if digest:
                        view, cuts = memoryview(raw), np.concatenate(([0], np.cumsum(sizes))).tolist()
                        back.append(pa.array([hashlib.sha256(view[x:y]).hexdigest() for x, y in zip(cuts[:-1], cuts[1:], strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(_offsets(counts), pa.array(flat)), *back], names=schema.names)
            hand_back()  # between batches too: what a batch needed for a while would else stay beside the caches
        replay.clear()
        hand_back()

    return src.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", to: str = "decoded", path: str | None = None) -> DataFrame:
    """df with the binary column `to` that the ids stand for; null ids: null."""
    path, pattern = path or ranks_path(), _pattern()
    schema = T.StructType([*df.schema.fields, T.StructField(to, T.BinaryType())])
    at = df.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = load(path, pattern)
        for batch in batches:
            lists = batch.column(at)
            lens = np.diff(lists.offsets.to_numpy())
            for a, b in slices([int(n) * 4 for n in lens]):
                part = lists.slice(a, b - a)
                counts = np.where(part.is_null().to_numpy(zero_copy_only=False), 0, lens[a:b])
                raw, sizes = replay.decode(part.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
                text = _binary(raw, sizes)
                if part.null_count:
                    text = pa.array([None if n else x for n, x in zip(part.is_null().to_pylist(), text.to_pylist(), strict=True)], type=pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(batch.num_columns)), text], names=schema.names)

    return df.mapInArrow(run, schema)


def bpe_query(docs: DataFrame) -> DataFrame:
    """The contract's digest columns: ids by `encode`, and the bytes that they decode to."""
    both = encode(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), digest="decoded_sha256")
    listed = F.to_json("ids")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.substring(listed, F.lit(2), F.length(listed) - 2), 256).alias("ids_sha256"), "decoded_sha256")
