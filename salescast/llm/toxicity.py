"""Toxicity by non-negative positive-unlabelled learning.

Positives are confirmed toxic documents of the training side, the unlabelled text is any document of that side. A linear
model of the presence of words and word beginnings minimises the class-prior-corrected risk  pi R_p(+1) + max(0, R_u(-1) - pi R_p(-1)).  The model
is fitted on a bounded sample (parameters of Sample); every whole text is scored. Cases: a null or empty text scores the
model's bias; a null doc_id is never held out and has no label; a doc_id that is labelled twice is toxic if any label
says so; repeated rows are scored alike; without positives every score is 0; an empty table gives no rows. Ties of the
sample order (a hash of doc_id) fall to the smaller doc_id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm.chunks import CACHE_CHARS, strings
from salescast.llm.common import fresh, hand_back, lean

WORD = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.3


@dataclass(frozen=True)
class Sample:
    """Bounds of the training sample and of the model."""

    positives: int = 4000
    unlabelled: int = 8000
    buckets: int = 1 << 20
    features: int = 512
    min_docs: int = 4
    min_z: float = 5.0
    steps: int = 300
    rate: float = 0.2
    decay: float = 1e-3


@dataclass(frozen=True)
class Model:
    weights: dict[int, float]  # by bucket of a word or prefix
    bias: float
    buckets: int


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def parts(words: set[str]) -> set[str]:
    """The words, and their first four to six letters for those that are longer."""
    return words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) > n}


def bucket(part: str, buckets: int) -> int:
    return zlib.crc32(part.encode()) % buckets


def nnpu_fit(x: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float, sample: Sample) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model over the 0/1 features x, by full-batch Adam on the non-negative risk."""
    xp, xu = x[positive], x[unlabelled]
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    add = lambda a: np.concatenate([a, np.ones((len(a), 1), a.dtype)], axis=1)
    xp, xu = add(xp), add(xu)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    m = v = np.zeros_like(w)
    for t in range(1, sample.steps + 1):
        zp, zu = xp @ w.astype(xp.dtype), xu @ w.astype(xu.dtype)
        # logistic loss: l(+1) = log(1 + exp(-z)), l(-1) = log(1 + exp(z))
        g_pos = xp.T @ (sig(zp) - 1) / len(xp)
        g_neg = xu.T @ sig(zu) / len(xu) - prior * (xp.T @ sig(zp)) / len(xp)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g = prior * g_pos + g_neg if negative >= 0 else -g_neg  # a negative risk is pushed back to zero
        g[:-1] += sample.decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - sample.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    z, low, high = xu[:, :-1] @ w[:-1].astype(xu.dtype), -30.0, 30.0
    for _ in range(60):  # the bias that makes the mean score of the unlabelled text the class prior
        mid = (low + high) / 2
        low, high = (mid, high) if sig(z + mid).mean() < prior else (low, mid)
    return w[:-1], low


def _select(rows: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, sample: Sample) -> np.ndarray:
    """The buckets whose document shares in positive and unlabelled text differ most, in standard errors."""
    lens = np.array([len(r) for r in rows])
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    count = lambda mask: np.bincount(flat[np.repeat(mask, lens)], minlength=sample.buckets)
    cp, cu = count(positive), count(unlabelled)
    p, u = cp / max(positive.sum(), 1), cu / max(unlabelled.sum(), 1)
    both = (cp + cu) / max(positive.sum() + unlabelled.sum(), 1)
    spread = np.sqrt(both * (1 - both) * (1 / max(positive.sum(), 1) + 1 / max(unlabelled.sum(), 1))) + 1e-6
    z = np.where(cp + cu >= sample.min_docs, np.abs(p - u) / spread, 0)
    best = np.argsort(-z, kind="stable")[: sample.features]
    return best[z[best] > sample.min_z]


def fit(docs: DataFrame, labels: DataFrame, sample: Sample | None = None) -> Model:
    """Train on the sample; only it reaches the driver, as word buckets without text."""
    sample = sample or Sample()
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    lab = lab.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = lab.agg(F.avg("toxic")).first()[0]
    if not prior:
        return Model({}, -30.0, sample.buckets)
    first = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    pos = first(lab.where("toxic = 1").select("doc_id"), sample.positives).withColumn("p", F.lit(1))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    unl = first(ids.where(~held_out(F.col("doc_id"))), sample.unlabelled).withColumn("p", F.lit(0))
    chosen = pos.union(unl).groupBy("doc_id").agg(F.max("p").alias("p"), (F.min("p") == 0).cast("int").alias("u"))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = text.join(F.broadcast(chosen), "doc_id")  # at most positives + unlabelled ids; of rows that share one, one text
    rows = rows.groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"), F.min_by("text", F.xxhash64("text")).alias("text")).select("p", "u", "text")
    buckets = sample.buckets

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            found = [np.unique(np.fromiter((bucket(w, buckets) for w in parts(set(WORD.findall(t.lower())))), np.int32)).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["p", "u", "f"])
        hand_back()

    # copies of a text count once
    got = rows.mapInArrow(features, "p int, u int, f binary").groupBy("f").agg(F.max("p").alias("p"), F.max("u").alias("u")).toPandas().sort_values("f", ignore_index=True)
    found = [np.frombuffer(f, np.int32) for f in got["f"]]
    positive, unlabelled = got["p"].to_numpy() == 1, got["u"].to_numpy() == 1
    if not positive.any() or not unlabelled.any():
        return Model({}, -30.0, sample.buckets)
    kept = _select(found, positive, unlabelled, sample)
    at = np.full(sample.buckets, -1)
    at[kept] = np.arange(len(kept))
    x = np.zeros((len(found), len(kept)), np.float32)
    for i, f in enumerate(found):
        c = at[f]
        x[i, c[c >= 0]] = 1
    w, bias = nnpu_fit(x, positive, unlabelled, float(prior), sample)
    return Model({int(b): float(v) for b, v in zip(kept, w, strict=True)}, bias, sample.buckets)


def score(docs: DataFrame, model: Model, to: str = "score", text: str = "text") -> DataFrame:
    """docs with the column `to`, from whole texts; nothing but the text enters it."""
    hold = fresh(docs, "__text")
    src = docs.select("*", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(hold))
    schema = T.StructType([*docs.schema.fields, T.StructField(to, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        weights, held = model.weights, 0
        seen: set[str] = set()
        useful: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            out = []
            for t in (t for _, _, words in strings(batch.column(batch.num_columns - 1)) for t in words):
                pieces = set(t.lower().split())
                for piece in pieces - seen:
                    held += len(piece)
                    hit = tuple({b for w in parts(set(WORD.findall(piece))) if (b := bucket(w, model.buckets)) in weights})
                    if hit:
                        useful[piece] = hit
                seen |= pieces
                hits = {b for piece in pieces & useful.keys() for b in useful[piece]}
                out.append(1 / (1 + np.exp(-np.clip(model.bias + sum(weights[b] for b in sorted(hits)), -30, 30))))
                if len(seen) > 300_000 or held > CACHE_CHARS:
                    seen, useful, held = set(), {}, 0
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(out, pa.float64())], names=schema.names)
        seen.clear()
        useful.clear()
        hand_back()

    return src.mapInArrow(run, schema)


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
