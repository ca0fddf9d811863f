"""Token files of directly addressable codes (DACs).

A segment holds the ids of whole consecutive documents, cut into 8-bit chunks by level: level 0 has each id's low byte
and a bitmap of the ids that go on; level 1 has the next byte of only those, and so on; a rank directory counts the
bitmap's ones before every 512 bits. Token i is read by one byte and one rank per level, with no block decoding.
Segments are rows of a Parquet table (shard, segment, first, doc_ids, lens, payload), so that any store Spark writes to
serves, with Spark's commit protocol. Order: ascending doc_id (nulls first), ties by text. Cases: a null or empty text
has only the end id; repeated rows are all stored; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.chunks import ChunkCoder, columns
from salescast.llm.common import hand_back, lean, stage, texts

MAGIC, BLOCK = b"DAC1", 512
SEGMENT_CHARS = 2_000_000
DEFAULT_TOKENIZER = "byte_bpe_50k.json"
#: New words that are encoded as one text, and such texts at a time: a call for each word costs more than the word.
WORDS_A_TEXT, TEXTS_AT_ONCE = 250, 20


def pack(ids: np.ndarray) -> bytes:
    """One segment's bytes: magic, number of levels, then per level its count, chunks, bitmap and rank directory."""
    rest, levels = ids.astype(np.uint64), []
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more.astype(np.uint32), np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, np.uint32)
        ranks = np.concatenate(([0], np.cumsum(ones)[:-1])).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[more] >> np.uint64(8)
        if not len(rest):
            return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)


class Segment:
    """Reader of a packed segment."""

    def __init__(self, raw: bytes):
        if raw[:4] != MAGIC:
            raise ValueError("not a token segment")
        self.levels, at = [], 8
        for _ in range(struct.unpack_from("<I", raw, 4)[0]):
            (n,) = struct.unpack_from("<Q", raw, at)
            sizes = (n, (n + 7) // 8, 4 * ((n + BLOCK - 1) // BLOCK))
            a, b, c = at + 8, at + 8 + sizes[0], at + 8 + sizes[0] + sizes[1]
            at = c + sizes[2]
            self.levels.append((np.frombuffer(raw, np.uint8, n, a), np.frombuffer(raw, np.uint8, sizes[1], b), np.frombuffer(raw, "<u4", sizes[2] // 4, c)))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def get(self, i: int) -> int:
        """Token i, by one rank per level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for shift, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * shift)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            inside = np.unpackbits(bits[block * BLOCK // 8 : (i >> 3) + 1], bitorder="little")[: i - block * BLOCK]
            i = int(ranks[block]) + int(inside.sum())
        return value

    def all(self) -> np.ndarray:
        """Every token, level by level."""
        chunks, bits, _ = self.levels[0]
        out, at = chunks.astype(np.uint32), np.arange(len(chunks))
        for shift, (chunks, _, _) in enumerate(self.levels[1:], 1):
            at = at[np.unpackbits(bits, count=len(at), bitorder="little").astype(bool)]
            out[at] |= chunks.astype(np.uint32) << np.uint32(8 * shift)
            bits = self.levels[shift][1]
        return out


@lru_cache(maxsize=2)
def coder(path: str) -> ChunkCoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    t = Tokenizer.from_file(path)

    def encode(chunks: list[str]) -> list[list[int]]:
        # ids only: no offsets are kept
        return [e.ids for e in t.encode_batch_fast(chunks, add_special_tokens=False)]

    if t.normalizer is not None or not isinstance(t.pre_tokenizer, ByteLevel):
        return ChunkCoder(encode)
    vocabulary = t.get_vocab()
    spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    spaced[[i for x, i in vocabulary.items() if x.startswith("\u0120")]] = True  # a space, as the byte-level alphabet has it

    def bulk(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words as texts of many: in clean words, only the tokens that begin them begin with a space."""
        ids, lens = [], []
        for a in range(0, len(words), WORDS_A_TEXT * TEXTS_AT_ONCE):
            groups = [words[b : b + WORDS_A_TEXT] for b in range(a, min(len(words), a + WORDS_A_TEXT * TEXTS_AT_ONCE), WORDS_A_TEXT)]
            for group, got in zip(groups, encode([" " + " ".join(g) for g in groups]), strict=True):
                row = np.array(got, dtype=np.int32)
                begin = np.flatnonzero(spaced[row])
                if len(begin) == len(group) and begin[0] == 0:
                    ids.append(row)
                    lens.append(np.diff(begin, append=len(row)))
                else:  # a vocabulary that the rule doesn't hold for
                    rows = encode([" " + x for x in group])
                    ids.append(np.array([i for r in rows for i in r], dtype=np.int32))
                    lens.append(np.array([len(r) for r in rows], dtype=np.int64))
        return np.concatenate(ids), np.concatenate(lens)

    return ChunkCoder(encode, bulk=bulk)


def write_tokens(docs: DataFrame, name: str = "tokens", path: str | None = None, end_id: int = 0) -> DataFrame:
    """The segment table of all documents, written in the shared folder and reread."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(DEFAULT_TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        shard, segment, first, enc = TaskContext.get().partitionId(), 0, 0, coder(path)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal segment, first, held, size
            doc_ids = [d for h in held for d in h[0]]
            ids, lens = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            row = [[shard], [segment], [first], [len(ids)], [doc_ids], [lens.tolist()], [pack(ids)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary())
            segment, first, held, size = segment + 1, first + len(ids), [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(row, kinds, strict=True)], names=["shard", "segment", "first", "n", "doc_ids", "lens", "payload"])

        for batch in batches:
            for a, b, words in columns(batch.column(1), SEGMENT_CHARS):
                flat, counts = enc.texts(words)
                ids = np.insert(flat, np.cumsum(counts), end_id)
                held.append((batch.column(0).slice(a, b - a).to_pylist(), ids, counts + 1))
                size += int(pc.sum(pc.utf8_length(words)).as_py())
                if size >= SEGMENT_CHARS:
                    yield flush()
        if held:
            yield flush()
        hand_back()  # the dictionary stays, within its bounds: the worker's next task knows most of its chunks

    ordered = texts(docs).repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return stage(ordered.mapInArrow(run, "shard int, segment int, first long, n long, doc_ids array<long>, lens array<int>, payload binary"), name)


def read_tokens(table: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = Segment(row["payload"]).all().astype("<u4")
                lens = np.array(row["lens"], dtype=np.int64)
                starts = np.cumsum(lens) - lens
                sums = [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(starts, lens, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([row["shard"]] * len(lens), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"]), pa.array(lens), pa.array(sums, pa.int64())], names=["shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = table.select("shard", "first", "doc_ids", "lens", "payload").mapInArrow(run, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    totals = table.groupBy("shard").agg(F.sum("n").alias("n"))  # one row per shard: the running sum's window is that small
    base = totals.select("shard", (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("base"))
    return rows.join(base, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_at(table: DataFrame, positions: DataFrame) -> DataFrame:
    """positions(shard, at) -> (shard, at, token): random access within shards, without decoding a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([Segment(r["payload"]).get(r["at"] - r["first"]) for r in rows], pa.int64())], names=["shard", "at", "token"])

    hit = positions.join(table.select("shard", "first", "n", "payload"), "shard").where("at >= first and at < first + n")
    return hit.select("shard", "at", "first", "payload").mapInArrow(run, "shard int, at long, token long")


def token_query(docs: DataFrame) -> DataFrame:
    return read_tokens(write_tokens(docs))
