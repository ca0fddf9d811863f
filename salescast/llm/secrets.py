"""Secret scans: base patterns, then a linear-chain conditional random field over tokens, decoded by Viterbi.

The field tags tokens as begin (B), inside (I) or outside (O) of a secret from their own shape, the neighbouring words
and the file. It is trained by maximum likelihood on a bounded sample whose tags come from the base patterns; each secret is also shown with
another value and without its name (see `disguised`). Decoding
is over whole texts: a plain token among plain tokens is O on every best path (checked from the weights, see `closed`),
so only the stretches around other tokens need the recursion; where the check fails, all tokens are decoded. Cases: a
null text is empty; null doc_ids and repeated rows are kept; an empty table gives no rows; `find_secrets` keeps all other
columns. Spans are ordered by start, then kind as listed.
"""

from __future__ import annotations

import random
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
from salescast.llm.common import fresh, guarded_spans, hand_back, lean, let, span_text

KINDS = ("assign", "access", "hex", "field")
NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""(?i:{NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"

TOKEN = re.compile(r"[^\s\"'=:,;()\[\]{}<>|]+")
PLAIN = re.compile(r"(?:[^\W\d_]|[^\w\s])*+\Z")  # possessive: linear on any token
TRIGGER = re.compile(rf"(?i){NAMES}|credential|private|akia|auth|bearer")
REACH = 2
STATES = 3  # O, B, I

#: Bounds of the training sample: documents with a base secret, and documents without one.
POSITIVE_DOCS, OTHER_DOCS, TRAIN_STEPS = 800, 800, 80


def base_spans(text: Column) -> Column:
    """array<struct<k:int,kind:string,s:int,e:int>> by start, then kind."""

    def of(k: int, quick: Column, pattern: str, keep, group: int | None = None) -> Column:
        found = F.filter(guarded_spans(text, quick, pattern, group), keep)
        return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))

    every = F.concat(
        of(0, text.rlike(rf"""(?i:{NAMES})["']?\x20*[:=]"""), ASSIGN, lambda x: F.length(x["g"]) >= 6, 1),
        of(1, text.contains("AKIA"), ACCESS, lambda x: F.length(x["m"]) >= 20),
        of(2, text.rlike("[0-9a-f]{24}"), HEX, lambda x: F.length(x["m"]) >= 24),
    )
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.transform(F.array_sort(every), lambda x: F.struct(x["k"].alias("k"), F.get(names, x["k"]).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def plain(token: str) -> bool:
    return PLAIN.match(token) is not None and TRIGGER.search(token) is None


def _shape(token: str) -> str:
    d, u, low = any(c.isdigit() for c in token), any(c.isupper() for c in token), any(c.islower() for c in token)
    if re.fullmatch(r"[0-9a-f]+", token) and d and low:
        return "hex"
    if d and not u and not low:
        return "num"
    return "".join(c for c, x in (("d", d), ("u", u), ("l", low)) if x) or "sym"


def own_features(token: str, before: str) -> tuple[str, ...]:
    """Features of the token itself and of the character before it."""
    n = len(token)
    digits = sum(c.isdigit() for c in token)
    return ("p:1",) if plain(token) else ("p:0", f"s:{_shape(token)}", f"n:{min(n // 4, 10)}", f"d:{4 * digits // max(n, 1)}", f"c:{len(set(token)) * 4 // max(n, 1)}", f"t:{bool(TRIGGER.search(token))}", f"b:{before if before in '=:' + chr(34) + chr(39) else ''}")


def tokens_of(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, token, last character before it other than a space)."""
    out = []
    for m in TOKEN.finditer(text):
        a = m.start()
        gap = text[max(0, a - 4) : a].rstrip(" ")
        out.append((a, m.end(), m.group().rstrip(".,;!?") or m.group(), gap[-1:]))
    return [(a, a + len(t), t, b) for a, _, t, b in out]


def features(tokens: list[tuple[int, int, str, str]], where: list[int], file: str) -> list[tuple[str, ...]]:
    """Features of the tokens at the positions `where`."""
    out = []
    for i in where:
        token, before = tokens[i][2], tokens[i][3]
        near = []
        for step in (-2, -1, 1, 2):
            j = i + step
            if 0 <= j < len(tokens) and not plain(x := tokens[j][2]):
                near.append(f"w{step}:{'trigger' if TRIGGER.search(x) else _shape(x)}")
        out.append((*own_features(token, before), *near, file))
    return out


def file_feature(n_tokens: int, n_other: int) -> str:
    """How much of the file isn't plain."""
    share = n_other / max(n_tokens, 1)
    return f"f:{'code' if share > 0.2 else 'mixed' if share > 0.02 else 'prose'}"


def stretches(tokens: list[tuple[int, int, str, str]], whole: bool) -> tuple[list[list[int]], int]:
    """Positions to decode, as runs around tokens that aren't plain, and the number of those tokens."""
    other = [i for i, t in enumerate(tokens) if not plain(t[2])]
    if whole:
        return ([list(range(len(tokens)))] if tokens else []), len(other)
    runs: list[list[int]] = []
    for i in other:
        a, b = max(0, i - REACH), min(len(tokens), i + REACH + 1)
        if runs and runs[-1][-1] >= a - 1:
            runs[-1].extend(range(runs[-1][-1] + 1, b))
        else:
            runs.append(list(range(a, b)))
    return runs, len(other)


@dataclass(frozen=True)
class Field:
    weights: dict[str, np.ndarray]  # feature -> score of each state
    trans: np.ndarray  # from state, to state

    def emit(self, feats: list[tuple[str, ...]]) -> np.ndarray:
        zero = np.zeros(STATES)
        return np.array([sum((self.weights.get(f, zero) for f in fs), zero) for fs in feats]).reshape(-1, STATES)

    def closed(self) -> bool:
        """True if a plain token among plain tokens is O on every best path, whatever its file and neighbours."""
        files = [self.weights.get(f"f:{f}", np.zeros(STATES)) for f in ("code", "mixed", "prose")]
        p = self.weights.get("p:1", np.zeros(STATES))
        margin = min(float((p + f)[0] - max((p + f)[1:])) for f in files)
        t = self.trans
        gain = max(float(t[a, s] + t[s, b] - t[a, 0] - t[0, b]) for a in range(STATES) for b in range(STATES) if a != 0 or b != 2 for s in (1, 2) if t[a, s] > -50 and t[0, b] > -50)
        # The neighbours of a plain run are themselves O or end a secret; I after O is excluded, so entering costs a B.
        return margin > max(gain, 0)

    def viterbi(self, emit: np.ndarray, before: int = 0) -> list[int]:
        """Best tags; the token before the stretch is O."""
        best, back = self.trans[before] + emit[0], []
        for e in emit[1:]:
            step = best[:, None] + self.trans
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + e
        tags = [int(best.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return tags[::-1]


def fit_field(seqs: list[tuple[list[tuple[str, ...]], list[int]]], steps: int = TRAIN_STEPS) -> Field:
    """Maximum likelihood of the tag sequences, by forward-backward over all sequences at once and Adam."""
    start = np.full((STATES, STATES), 0.0)
    start[0, 2] = -100.0  # I never follows O
    if not seqs:
        return Field({"p:0": np.array([5.0, 0, 0]), "p:1": np.array([5.0, 0, 0])}, start)
    names = sorted({f for fs, _ in seqs for x in fs for f in x})
    at = {f: i for i, f in enumerate(names)}
    n, length = len(seqs), max(len(t) for _, t in seqs)
    width = max(len(x) for fs, _ in seqs for x in fs)
    feat = np.full((n, length, width), len(names))
    tags, mask = np.zeros((n, length), int), np.zeros((n, length), bool)
    for i, (fs, t) in enumerate(seqs):
        mask[i, : len(t)], tags[i, : len(t)] = True, t
        for j, x in enumerate(fs):
            feat[i, j, : len(x)] = [at[f] for f in x]
    w, tr = np.zeros((len(names) + 1, STATES)), start.copy()
    hot = np.eye(STATES)[tags] * mask[..., None]
    mw = vw = np.zeros_like(w)
    mt = vt = np.zeros_like(tr)
    lse = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
    for k in range(1, steps + 1):
        e = w[feat].sum(axis=2)
        alpha, beta = np.zeros((n, length, STATES)), np.zeros((n, length, STATES))
        alpha[:, 0] = tr[0] + e[:, 0]
        for j in range(1, length):
            new = lse(alpha[:, j - 1, :, None] + tr, 1) + e[:, j]
            alpha[:, j] = np.where(mask[:, j, None], new, alpha[:, j - 1])
        for j in range(length - 2, -1, -1):
            new = lse(tr + (e[:, j + 1] + beta[:, j + 1])[:, None, :], 2)
            beta[:, j] = np.where(mask[:, j + 1, None], new, 0)
        z = lse(alpha[:, -1], 1)
        node = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        flat, off = feat.ravel(), (hot - node).reshape(-1, STATES)
        gw = np.stack([np.bincount(flat, np.repeat(off[:, s], width), len(w)) for s in range(STATES)], axis=1)
        gt = np.zeros_like(tr)
        for j in range(length):
            before = np.broadcast_to(np.eye(STATES)[0], (n, STATES)) if j == 0 else hot[:, j - 1]
            gt += (before[:, :, None] * hot[:, j, None, :]).sum(axis=0)
            if j == 0:
                gt[0] -= node[:, 0].sum(axis=0)
            else:
                pair = alpha[:, j - 1, :, None] + tr + (e[:, j] + beta[:, j])[:, None, :] - z[:, None, None]
                gt -= (np.exp(np.minimum(pair, 0)) * mask[:, j, None, None]).sum(axis=0)
        gw, gt = gw / n - 1e-3 * w, gt / n - 1e-3 * tr
        gw[-1] = 0
        gt[0, 2] = 0
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
        mt, vt = 0.9 * mt + 0.1 * gt, 0.99 * vt + 0.01 * gt * gt
        c, d = 1 - 0.9**k, 1 - 0.99**k
        w = w + 0.2 * (mw / c) / (np.sqrt(vw / d) + 1e-8)
        tr = tr + 0.1 * (mt / c) / (np.sqrt(vt / d) + 1e-8)
        tr[0, 2] = -100.0
    return Field({f: w[i] for f, i in at.items()}, tr)


def _tagged(text: str, spans: list[tuple[int, int]]) -> list[tuple[list[tuple[str, ...]], list[int]]]:
    """Training sequences of a text with known secrets: stretches around tokens that aren't plain, and one of plain ones."""
    tokens = tokens_of(text)
    runs, n_other = stretches(tokens, False)
    used = {i for r in runs for i in r}
    rest = [i for i in range(len(tokens)) if i not in used][:8]
    file = file_feature(len(tokens), n_other)
    out = []
    for run in [r[a : a + 24] for r in [*runs, rest] if r for a in range(0, len(r), 24)]:
        tags, last = [], -1
        for i in run:
            a, b = tokens[i][:2]
            hit = next((k for k, (s, e) in enumerate(spans) if s < b and a < e), -1)
            tags.append(0 if hit < 0 else 2 if hit == last and tags and tags[-1] else 1)
            last = hit
        out.append((features(tokens, run, file), tags))
    return out


#: Letters and lengths of made-up secrets.
LENGTHS = (16, 49)
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
ASSIGNED = re.compile(rf"""(?i:{NAMES})["']?\x20*[:=]\x20*["']?""")


def disguised(text: str, spans: list[tuple[int, int]], named: bool) -> tuple[str, list[tuple[int, int]]]:
    """The text with each secret's value replaced by a made-up one, and its spans; if not `named`, without the
    name that gives it away. So the field learns what a secret looks like beyond the forms that the base patterns know.
    """
    out, new, at, size = [], [], 0, 0
    for s, e in spans:
        if s < at:
            continue
        lead = ASSIGNED.match(text, s, e)
        begin = lead.end() if lead else s
        rng = random.Random(zlib.crc32(text[begin:e].encode()) + named)
        value = "".join(rng.choices(LETTERS, k=rng.randrange(*LENGTHS)))
        before = text[at:s] + (text[s:begin] if named else "")
        out += [before, value]
        start = size + len(before) - (begin - s if named and lead else 0)
        size += len(before) + len(value)
        new.append((start, size))
        at = e
    return "".join(out) + text[at:], new


def train(docs: DataFrame, positive: int = POSITIVE_DOCS, other: int = OTHER_DOCS) -> Field:
    """Fit on at most `positive` documents with a base secret and `other` without one, the first in a hash order."""
    t = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    quick = F.col("text").rlike(rf"""(?i:{NAMES})["']?\x20*[:=]|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}""")
    order = (F.xxhash64("text"), F.length("text"))
    # a hash share far above the bound keeps texts that can't be chosen out of the sort; both halves are exact top-ks
    short = t.where(F.length("text") <= 20_000).distinct()
    some = short.where(quick).orderBy(*order).limit(positive).union(short.where(~quick & F.col("text").rlike("[0-9]")).orderBy(*order).limit(other))
    rows = some.select("text", base_spans(F.col("text")).alias("spans")).collect()  # bounded by the two parameters
    return fit_field(sequences([(r["text"], [(x["s"], x["e"]) for x in r["spans"]]) for r in rows]))


def sequences(known: list[tuple[str, list[tuple[int, int]]]]) -> list[tuple[list[tuple[str, ...]], list[int]]]:
    """Training sequences of texts with their secrets, as they are and disguised."""
    return [s for text, spans in known for form in ((text, spans), *([disguised(text, spans, n) for n in (True, False)] if spans else [])) for s in _tagged(*form)]


def find_secrets(docs: DataFrame, field: Field, text: str = "text", to: str = "spans") -> DataFrame:
    """docs with the column `to`: array<struct<k,kind,s,e>> of base and field spans, one row per input row."""
    hold, base = fresh(docs, "__text"), fresh(docs, "__base")
    src = docs.select("*", base_spans(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias(base), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(hold))
    found_type = T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))
    added = fresh(docs, "__found")
    schema = T.StructType([*src.schema.fields[:-1], T.StructField(added, found_type)])
    whole = not field.closed()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        seen: set[str] = set()
        odd: set[str] = set()
        held = 0
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        for batch in batches:
            out = []
            for t in (t for _, _, words in strings(batch.column(batch.num_columns - 1)) for t in words):
                pieces = set(t.split())
                new = pieces - seen
                odd.update(p for p in new if any(not plain(x[2]) for x in tokens_of(p)))
                held += sum(map(len, new))
                seen |= new
                found: list[dict] = []
                if whole or not odd.isdisjoint(pieces):
                    tokens = tokens_of(t)
                    runs, n_other = stretches(tokens, whole)
                    file = file_feature(len(tokens), n_other)
                    for r in runs:
                        tags = field.viterbi(field.emit(features(tokens, r, file)))
                        for i, tag in zip(r, tags, strict=True):
                            if tag == 1 or tag == 2 and not found:
                                found.append({"s": tokens[i][0], "e": tokens[i][1]})
                            elif tag == 2:
                                found[-1]["e"] = tokens[i][1]
                out.append(found)
                if len(seen) > 300_000 or held > CACHE_CHARS:
                    seen, odd, held = set(), set(), 0
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(out, kind)], names=schema.names)
        seen.clear()
        odd.clear()
        hand_back()

    rows = src.mapInArrow(run, schema)
    free = F.filter(added, lambda x: ~F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    every = F.concat(F.col(base), F.transform(free, lambda x: F.struct(F.lit(3).alias("k"), F.lit(KINDS[3]).alias("kind"), x["s"].alias("s"), x["e"].alias("e"))))
    order = F.transform(every, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["kind"].alias("kind")))
    return rows.withColumn(to, F.transform(F.array_sort(order), lambda x: F.struct(x["k"].alias("k"), x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))).drop(base, added)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch that spans cover replaced by the mark; overlapping spans give one mark."""
    none = F.expr("cast(array() as array<struct<s:int,e:int>>)")

    def cover(a: Column, x: Column) -> Column:
        last = F.element_at(a, -1)
        wider = F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(a) > 0) & (F.try_element_at(a, F.lit(-1))["e"] > x["s"]), wider).otherwise(F.concat(a, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e")))))

    def joined(parts: Column) -> Column:
        begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(parts, i - 1)["e"])
        gaps = F.transform(parts, lambda x, i: F.concat(F.substring(text, begin(i) + 1, x["s"] - begin(i)), F.lit(mark)))
        return F.concat(F.array_join(gaps, ""), F.substring(text, F.element_at(parts, -1)["e"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, let(F.aggregate(spans, none, cover), joined)).otherwise(text)


def secrets_query(docs: DataFrame) -> DataFrame:
    """The contract's digest columns of find_secrets."""
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = find_secrets(t, train(docs))
    count = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    base = F.filter("spans", lambda x: x["k"] < 3)
    return rows.select("doc_id", *(count(k) for k in range(3)), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"), count(3))
