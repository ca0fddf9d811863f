"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time evaluation.

One pass over the whole texts counts every document's terms and keeps, for shards of SHARD_DOCS neighbouring documents, the
postings of the items' terms in order of doc_id: a staged table of one row a shard. Its sums give the corpus counts
(documents, terms, document frequencies); every shard is then searched by itself for all items. In a shard an item's short
lists are added up term at a time into accumulators, sorted by document: from then on they are one iterator, whose bound is
the largest accumulator. It takes part, like a list, in document-at-a-time evaluation with the long lists: lists are ordered
by their bounds, and those whose bounds together stay below the k-th best score so far bring no candidates of their own;
they are only looked up at the documents of the others that can still qualify. Documents are worked on in ranges of
RANGE_DOCS, and a range whose bounds stay below is skipped. Each shard gives an item k documents at most, of which a window
picks the best.

Items are taken in groups of some GROUP_TERMS distinct terms, one group after the other, so that what a task holds of them
is bounded; the tables of such a benchmark make one group. Cases: a null text has no terms; documents without terms are not
counted and never found; null doc_ids rank last among equal scores; repeated rows of documents are documents of their own,
repeated rows of items count once; an item without terms, or of terms that no document holds, has no rows; an empty table
gives no rows. All but the weights is 64-bit integer work; a score that needs more raises.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.common import hand_back, stage

K = 20
#: Documents and postings of a shard at most, documents of a range, and a list's length up to which it is added up first.
SHARD_DOCS, SHARD_POSTINGS, RANGE_DOCS, SHORT = 16_384, 1_000_000, 4_096, 256
GROUP_TERMS = 200_000

#: Fixed values of the contract's score.
SATURATION, LENGTH_SHARE, UNIT = 12, 25, 1_000_000_000
#: Letters and digits of ASCII in lower case and every byte of a longer character; all other bytes part terms.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


@dataclass
class Item:
    """A query: its place in the group, and the numbers of its distinct terms with their repeats."""

    at: int
    repeats: dict[int, int]


class Shard:
    """Postings of neighbouring documents, in order of doc_id (null last)."""

    def __init__(self, row: dict):
        get = lambda name, kind: np.frombuffer(row[name], dtype=kind)
        self.docs, self.lengths = get("docs", np.int64), get("lengths", np.int64)
        self.known = np.unpackbits(np.frombuffer(row["known"], np.uint8), count=len(self.docs)).astype(bool)
        self.at, self.tf = get("at", np.int32), get("tf", np.int32)
        counts = get("counts", np.int64)
        ends = np.cumsum(counts)
        self.lists = {t: (e - n, e) for t, n, e in zip(get("terms", np.int32).tolist(), counts.tolist(), ends.tolist(), strict=True)}


def pack(found: list[tuple[int | None, int, list[tuple[int, int]]]]) -> dict:
    """A shard's row, of (doc_id, number of terms, [(term, occurrences)])."""
    found.sort(key=lambda d: (d[0] is None, d[0] or 0))
    at = np.repeat(np.arange(len(found), dtype=np.int32), [len(d[2]) for d in found])
    pairs = np.array([p for d in found for p in d[2]], dtype=np.int64).reshape(-1, 2)
    order = np.argsort(pairs[:, 0], kind="stable")
    numbers, counts = np.unique(pairs[:, 0], return_counts=True)
    lengths = np.array([d[1] for d in found], dtype=np.int64)
    return {
        "docs": np.array([d[0] or 0 for d in found], dtype=np.int64).tobytes(), "known": np.packbits([d[0] is not None for d in found]).tobytes(), "lengths": lengths.tobytes(),
        "terms": numbers.astype(np.int32).tobytes(), "counts": counts.astype(np.int64).tobytes(), "at": at[order].tobytes(), "tf": pairs[order, 1].astype(np.int32).tobytes(),
        "n_docs": len(found), "n_terms": int(lengths.sum()),
    }


def index(docs: DataFrame, vocabulary: dict[bytes, int], name: str = "lexical-index") -> DataFrame:
    """docs(doc_id, text) -> the staged shards: every document's length, and the postings of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        postings = 0
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1), strict=True):  # a text at a time
                found = terms(text.as_py())
                if found:
                    own = [(vocabulary[t], n) for t, n in Counter(found).items() if t in vocabulary]
                    held.append((doc.as_py(), len(found), own))
                    postings += len(own)
                    if len(held) >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                        yield pa.RecordBatch.from_pylist([pack(held)], schema)
                        held, postings = [], 0
        if held:
            yield pa.RecordBatch.from_pylist([pack(held)], schema)
        hand_back()

    schema = pa.schema([(n, pa.int64() if n in ("n_docs", "n_terms") else pa.binary()) for n in ("docs", "known", "lengths", "terms", "counts", "at", "tf", "n_docs", "n_terms")])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(run, ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary'}" for f in schema)), name)


def frequencies(shards: DataFrame) -> dict[int, int]:
    """Document frequency of each term of the vocabulary, one row a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for b in batches:
            for t, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total.update(dict(zip(np.frombuffer(t, np.int32).tolist(), np.frombuffer(n, np.int64).tolist(), strict=True)))
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(total), pa.int32()), "df": pa.array(list(total.values()), pa.int64())})

    rows = shards.select("terms", "counts").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    return {r["term"]: r["df"] for r in rows}


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Search:
    """All items over one shard."""

    def __init__(self, shard: Shard, weights: dict[int, int], n_docs: int, n_terms: int, short: int = SHORT):
        self.shard, self.weights, self.short = shard, weights, short
        longest = int(shard.lengths.max(initial=0))
        if LENGTH_SHARE * longest * n_docs < 2**63:
            ratio = (LENGTH_SHARE * shard.lengths * n_docs) // max(1, n_terms)
        else:  # the same in longer integers
            ratio = np.array([LENGTH_SHARE * int(n) * n_docs // n_terms for n in shard.lengths], dtype=np.int64)
        self.m = 100 - LENGTH_SHARE + ratio
        self.impacts: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def impact(self, term: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, what an occurrence in the item adds to each, the largest of these)."""
        got = self.impacts.get(term)
        if got is None:
            a, b = self.shard.lists[term]
            at, tf = self.shard.at[a:b], self.shard.tf[a:b].astype(np.int64)
            adds = self.weights[term] * ((UNIT * tf) // (1000 * tf + SATURATION * self.m[at]))
            got = self.impacts[term] = (at, adds, int(adds.max(initial=0)))
        return got

    def top(self, item: Item, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best above 0: falling scores, then rising documents."""
        lists = [(*self.impact(t), r) for t, r in item.repeats.items() if t in self.shard.lists]
        if sum(bound * r for _, _, bound, r in lists) >= 2**63:
            raise OverflowError("a score needs more than 64 bits")
        brief = [x for x in lists if len(x[0]) <= self.short]
        long = [(at, adds * r if r > 1 else adds, bound * r) for at, adds, bound, r in lists if len(at) > self.short]
        if brief:  # term at a time
            every = np.concatenate([x[0] for x in brief])
            at, place = np.unique(every, return_inverse=True)
            sums = np.zeros(len(at), dtype=np.int64)
            np.add.at(sums, place, np.concatenate([x[1] * x[3] for x in brief]))
            long.append((at, sums, int(sums.max())))  # one iterator with one bound
        least = 0  # a score that k documents reach
        for at, adds, _ in long:
            if len(adds) >= k:
                least = max(least, int(np.partition(adds, len(adds) - k)[len(adds) - k]))
        long.sort(key=lambda x: x[2])
        rest = np.concatenate(([0], np.cumsum([x[2] for x in long])))  # bound of the first lists together
        docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for start in range(0, len(self.shard.docs), RANGE_DOCS):  # document at a time
            if rest[-1] < max(least, 1):
                break
            cuts = [np.searchsorted(x[0], (start, start + RANGE_DOCS)) for x in long]
            peaks = [int(x[1][a:b].max(initial=0)) for x, (a, b) in zip(long, cuts, strict=True)]
            if sum(peaks) < max(least, 1):
                continue
            below = np.concatenate(([0], np.cumsum(peaks)))
            lead = int(np.searchsorted(below, max(least, 1), side="left"))  # lists before it stay below together
            lead = max(0, lead - 1)
            total = np.zeros(min(RANGE_DOCS, len(self.shard.docs) - start), dtype=np.int64)
            for (at, adds, _), (a, b) in zip(long[lead:], cuts[lead:], strict=True):
                total[at[a:b] - start] += adds[a:b]
            some = np.flatnonzero(total + below[lead] >= max(least, 1)) if lead else np.flatnonzero(total)
            got = total[some]
            for j in range(lead - 1, -1, -1):  # looked up at the candidates only
                (at, adds, _), (a, b) = long[j], cuts[j]
                place = np.searchsorted(at[a:b], some + start)
                hit = np.flatnonzero(place < b - a)
                hit = hit[at[a:b][place[hit]] == some[hit] + start]
                got[hit] += adds[a:b][place[hit]]
                keep = got + below[j] >= max(least, 1)
                some, got = some[keep], got[keep]
            docs, scores = np.concatenate((docs, some + start)), np.concatenate((scores, got))
            if len(docs) > k:
                order = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[order], scores[order]
                least = max(least, int(scores[-1]))
        keep = scores > 0
        docs, scores = docs[keep], scores[keep]
        order = np.lexsort((docs, -scores))[:k]
        return docs[order], scores[order]


def search(shards: DataFrame, items: list[Item], weights: dict[int, int], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(at, doc_id, score): each shard's k best documents of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                shard = Shard(b.slice(i, 1).to_pylist()[0])
                here = Search(shard, weights, n_docs, n_terms)
                found = [(item.at, *here.top(item, k)) for item in items]
                docs = np.concatenate([d for _, d, _ in found]) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_pydict({
                    "at": pa.array(np.repeat(np.array([a for a, _, _ in found], dtype=np.int32), [len(d) for _, d, _ in found])),
                    "doc_id": pa.array(shard.docs[docs], mask=~shard.known[docs]),
                    "score": pa.array(np.concatenate([s for _, _, s in found]) if found else np.zeros(0, np.int64)),
                })

    return shards.drop("n_docs", "n_terms").mapInArrow(run, "at int, doc_id long, score long")


def groups(items: DataFrame, most: int = GROUP_TERMS) -> Iterator[list[tuple[object, Counter]]]:
    """Items (id, terms), in groups of some `most` distinct terms; they come to the driver one at a time."""
    held: list = []
    known: set[bytes] = set()
    for r in items.toLocalIterator():
        own = Counter(terms(r["text"]))
        if held and len(known) + len(own) > most:
            yield held
            held, known = [], set()
        held.append((r["item_id"], own))
        known.update(own)
    if held:
        yield held


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, note: dict | None = None) -> DataFrame:
    """docs(doc_id, text), items(item_id, text) -> item_id, rank, doc_id, score. note: gets the corpus counts."""
    kind = items.schema["item_id"].dataType
    out = None
    for g, group in enumerate(groups(stage(items.select("item_id", F.col("text").cast("string").alias("text")).distinct(), "lexical-items"))):
        vocabulary = {t: n for n, t in enumerate(sorted(set().union(*(own for _, own in group))))}
        shards = index(docs, vocabulary, f"lexical-index-{g}")
        n_docs, n_terms = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        found = frequencies(shards)
        if note is not None:
            note.update(documents=n_docs, terms=n_terms, shards=shards.count())
        weights = {t: weight(n_docs, df) for t, df in found.items()}
        queries = [Item(at, {vocabulary[t]: n for t, n in own.items()}) for at, (_, own) in enumerate(group)]
        names = docs.sparkSession.createDataFrame([(at, i) for at, (i, _) in enumerate(group)], f"at int, item_id {kind.simpleString()}")
        best = Window.partitionBy("at").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        top = search(shards, queries, weights, n_docs, n_terms, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        top = top.join(F.broadcast(names), "at").select("item_id", "rank", "doc_id", "score")  # names: the group's items
        out = top if out is None else out.unionByName(top)
    return out if out is not None else docs.sparkSession.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")


SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS d, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), c AS (SELECT count(*) AS N, CAST(sum(len(t)) AS BIGINT) AS L FROM w WHERE len(t) > 0),
p AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM w) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
i AS (
  SELECT item_id, term, count(*) AS r FROM (
    SELECT item_id, x, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT item_id, text, row_number() OVER () AS x FROM (SELECT DISTINCT item_id, text FROM benchmark))
  ) GROUP BY item_id, x, term
), s AS (
  SELECT item_id, d, sum(r * CAST(floor(1000 * ln((2 * N + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * len(t) * N) // L))))) AS score
  FROM i JOIN f USING (term) JOIN p USING (term) JOIN w USING (d) CROSS JOIN c GROUP BY ALL
), k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS n FROM s JOIN w USING (d) WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM k WHERE n <= 20
"""
