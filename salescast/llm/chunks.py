"""Exact splitting of texts at clean spaces, and a dictionary coder from chunks to token ids.

The pre-tokenizer pattern never lets a token cross a single space between two non-space characters: the space always
begins a new match. So a text may be cut there, each distinct chunk encoded once per task, and the ids put together.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, repeat
from operator import contains

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = re.compile(r"(?<=\S) (?=\S)")
#: Entries after which a task's dictionary starts anew; results don't depend on it.
DICTIONARY_ENTRIES = 1_000_000
#: Characters of its keys after which a cache starts anew: long tokens count by their length.
CACHE_CHARS = 16_000_000
#: Text characters that are worked on at a time.
SLICE_CHARS = 1_000_000
#: New chunks that are encoded at a time.
AT_ONCE = 50_000
#: Stretches that are copied at a time.
STRETCHES = 1 << 15


class Codes(dict):
    """Numbers chunks as they are first looked up."""

    def of(self, keys: list[str] | list[tuple[str]]) -> tuple[np.ndarray, list[str] | list[tuple[str]]]:
        """(numbers of the keys, those of them that are new)."""
        found = np.fromiter(map(self.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        at = np.flatnonzero(found < 0)
        unknown = [keys[i] for i in at.tolist()]
        new = list(dict.fromkeys(unknown))
        self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
        found[at] = np.fromiter(map(self.__getitem__, unknown), dtype=np.int64, count=len(unknown))
        return found, new


def slices(lengths: list[int], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `limit` characters; a longer row stands alone."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def strings(column: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """(first row, row after the last, texts) of a string column, about `limit` bytes at a time."""
    for a, b in slices(pc.binary_length(column).to_pylist(), limit):
        yield a, b, column.slice(a, b - a).to_pylist()


def columns(column: pa.Array, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int, pa.Array]]:
    """(first row, row after the last, texts) as `strings`, but as slices of the column: no string is made of a text."""
    for a, b in slices(pc.binary_length(column).to_pylist(), limit):
        yield a, b, column.slice(a, b - a)


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The stretches flat[starts[i] : starts[i] + lens[i]], one after the other."""
    ends = np.cumsum(lens)
    out = np.empty(ends[-1] if len(ends) else 0, flat.dtype)
    for a in range(0, len(ends), STRETCHES):
        n, e = lens[a : a + STRETCHES], ends[a : a + STRETCHES]
        begin, end = e[0] - n[0], e[-1]
        out[begin:end] = flat[np.repeat(starts[a : a + STRETCHES] - (e - n), n) + np.arange(begin, end)]
    return out


class ChunkCoder:
    """Encodes texts; `encode(list of distinct strings)` gives the ids of each new chunk.

    bulk: the same for words, to each of which a space belongs before it, without other spaces in or white space around
    them: (ids of all in a row, number of ids of each). They may be encoded as one text.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], entries: int = DICTIONARY_ENTRIES, bulk: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None = None, at_once: int = AT_ONCE):
        self.encode, self.entries, self.bulk, self.at_once = encode, entries, bulk, at_once
        self.clear()

    def clear(self) -> None:
        self.codes = Codes()
        self.starts, self.lens, self.flat = array("q"), array("q"), array("i")
        self.chars = 0
        self.unclean = bytearray()  # by code: the space next to such a chunk may not be a cut

    def _look_up(self, words: list[str], first: bool) -> np.ndarray:
        """Codes of the chunks, all of them first ones of texts or none; new chunks are encoded."""
        # a first chunk has no space before it; as a tuple it is apart from every spaced one
        found, new = self.codes.of(list(zip(words)) if first else words)  # noqa: B905
        for a in range(0, len(new), self.at_once):
            part = [x for (x,) in new[a : a + self.at_once]] if first else new[a : a + self.at_once]
            full = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
            bad = (full == 0) | (np.fromiter(map(len, map(str.rstrip if first else str.strip, part)), dtype=np.int64, count=len(part)) != full)
            fit = np.zeros(len(part), bool)
            if self.bulk and not first:
                fit = ~bad & ~np.fromiter(map(contains, part, repeat(" ")), dtype=bool, count=len(part))
            starts, lens = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            for where in (np.flatnonzero(fit), np.flatnonzero(~fit)):
                if not len(where):
                    continue
                some = part if len(where) == len(part) else [part[i] for i in where.tolist()]
                if fit[where[0]]:
                    ids, n = self.bulk(some)
                else:
                    rows = self.encode(some if first else [" " + x for x in some])
                    n = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
                    ids = np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=int(n.sum()))
                starts[where], lens[where] = len(self.flat) + np.cumsum(n) - n, n
                self.flat.frombytes(ids.astype(np.int32, copy=False).tobytes())
            self.starts.frombytes(starts.tobytes())
            self.lens.frombytes(lens.tobytes())
            self.chars += int(full.sum())
            self.unclean.extend(bad.tobytes())
        return found

    def _split(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(codes of all chunks in a row, number of chunks of each text); a chunk is looked up once, however often it stands there."""
        lists = pc.split_pattern(column, " ")
        offsets = lists.offsets.to_numpy()
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        at, first = coded.indices.to_numpy(), offsets[:-1] - offsets[0]
        later = np.ones(len(at), bool)
        later[first] = False
        used = np.zeros(len(coded.dictionary), bool)
        used[at[later]] = True
        codes = np.zeros(len(used), np.int64)
        codes[used] = self._look_up(coded.dictionary.filter(pa.array(used)).to_numpy(zero_copy_only=False).tolist(), False)
        found = codes[at]
        found[first] = self._look_up(flat.take(pa.array(first)).to_pylist(), True)
        return found, np.diff(offsets).astype(np.int64)

    def texts(self, texts: Sequence[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); no text is null."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if len(self.codes) > self.entries or self.chars > CACHE_CHARS:
            self.clear()
        found, counts = self._split(column)
        bad = np.frombuffer(self.unclean, dtype=np.uint8)[found] if len(found) else found
        if bad.any():  # these texts have other white space next to a space
            again = np.unique(np.repeat(np.arange(len(column)), counts)[bad > 0])
            pieces = [CUT.split(x) for x in column.take(pa.array(again)).to_pylist()]
            sizes = np.array([len(p) for p in pieces], dtype=np.int64)
            codes = np.empty(int(sizes.sum()), np.int64)
            heads = np.zeros(len(codes), bool)
            heads[np.cumsum(sizes) - sizes] = True
            codes[heads] = self._look_up([p[0] for p in pieces], True)
            codes[~heads] = self._look_up([x for p in pieces for x in p[1:]], False)
            parts = np.split(found, np.cumsum(counts)[:-1])
            for i, part in zip(again, np.split(codes, np.cumsum(sizes)[:-1]), strict=True):
                parts[i] = part
            found, counts[again] = np.concatenate(parts), sizes
        lens = np.frombuffer(self.lens, dtype=np.int64)[found] if len(found) else np.zeros(0, np.int64)
        starts = np.frombuffer(self.starts, dtype=np.int64)[found] if len(found) else lens
        ids = gather(np.frombuffer(self.flat, dtype=np.int32) if len(self.flat) else np.zeros(0, np.int32), starts, lens)
        sums = np.concatenate(([0], np.cumsum(lens)))
        ends = np.cumsum(counts)
        return ids, sums[ends] - sums[ends - counts]
