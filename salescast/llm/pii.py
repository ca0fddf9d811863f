"""Personal data: base patterns, then bootstrapped contextual extraction over a pattern-instance graph.

DataFrame functions only. Cases: a null text is empty and has no spans; a null doc_id is kept; repeated rows each get
their own result row; an empty table gives an empty result; other columns are not read. Ties: spans are ordered by kind as
listed, then start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import guarded_spans, span_text, stage, texts

KINDS = ("email", "ip", "card", "phone")
# Each equals the plain pattern of its kind, match for match: a start inside a run that has already failed is skipped
# (\G: or that follows the last match), and possessive parts never backtrack, so that long runs take linear time.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# What may be an identifier though no base pattern takes it.
LIKE_EMAIL = r"(?:(?<![^\s@,;<>()])|\G)[^\s@,;<>()]++@[^\s@,;<>()]++"
LIKE_NUMBER = r"(?<![0-9])[0-9](?:[\x20().-]{0,2}[0-9]){6,24}+(?![0-9])"

CONTEXT_CHARS = 64  # reach of a lexical pattern on either side
ROUNDS = 3
MIN_CONFIDENCE, MIN_SUPPORT, MIN_INSTANCE, MIN_PATTERNS = 0.9, 3, 0.95, 2


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    back = F.reverse(d)

    def value(i: Column) -> Column:
        x = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _kept(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(_digits(m)).between(13, 19) & _luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<k:int,kind:string,s:int,e:int,m:string>> by kind as listed, then start."""
    quick = (text.contains("@"), text.rlike(r"[0-9]\.[0-9]"), text.rlike(r"(?:[0-9][\x20-]?){12}[0-9]"), text.contains("+"))

    def of(k: int, kind: str, pattern: str) -> Column:
        found = F.filter(guarded_spans(text, quick[k], pattern), lambda x: _kept(kind, x["m"]))
        return F.transform(found, lambda x: F.struct(F.lit(k).alias("k"), F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))

    parts = [of(k, kind, pattern) for k, (kind, pattern) in enumerate(zip(KINDS, (EMAIL, IP, CARD, PHONE), strict=True))]
    return F.concat(*parts)


def candidate_spans(text: Column) -> Column:
    """Identifier-like strings with the kind that their form allows: the graph's unlabelled instances."""
    mails = F.transform(guarded_spans(text, text.contains("@"), LIKE_EMAIL), lambda x: F.struct(F.lit(0).alias("k"), F.lit("email").alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))
    numbers = F.transform(
        guarded_spans(text, text.rlike(r"(?:[0-9][\x20().-]{0,2}){6}[0-9]"), LIKE_NUMBER),
        lambda x: F.struct(
            F.when(x["m"].rlike(r"^[0-9]+(\.[0-9]+){3}$"), 1).when(F.length(_digits(x["m"])) >= 13, 2).otherwise(3).alias("k"),
            F.when(x["m"].rlike(r"^[0-9]+(\.[0-9]+){3}$"), "ip").when(F.length(_digits(x["m"])) >= 13, "card").otherwise("phone").alias("kind"),
            x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"),
        ),
    )
    return F.concat(mails, numbers)


def _word(context: Column, pattern: str) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(context, pattern, 1)), "[0-9]", "0")


def _contexts(text: Column, spans: Column) -> Column:
    """Each span with its lexical patterns: the two words before it, and the words next to it on both sides."""

    def add(x: Column) -> Column:
        left = F.substring(text, F.greatest(x["s"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT_CHARS)))
        right = F.substring(text, x["e"] + 1, F.lit(CONTEXT_CHARS))
        return x.withField("patterns", F.array(
            F.concat(F.lit("L "), _word(left, r"(\S+\s+\S+)\s*$")),
            F.concat(F.lit("B "), _word(left, r"(\S+)\s*$"), F.lit(" _ "), _word(right, r"^\s*(\S+)")),
        ))

    return F.transform(spans, add)


def bootstrap(mentions: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """mentions(kind, m, patterns, seed) -> (kind, m, confidence) of the discovered instances.

    In each round a pattern's confidence is the share of its distinct instances that are known of the kind; patterns
    of MIN_CONFIDENCE with MIN_SUPPORT known instances vote, and an instance that MIN_PATTERNS of them support with a
    noisy-or of MIN_INSTANCE or more joins the known ones. Only grouped sums of (pattern, instance) edges move.
    """
    edges = stage(
        mentions.select("kind", F.lower("m").alias("m"), "seed", F.explode(F.array_distinct("patterns")).alias("pattern"))
        .groupBy("kind", "m", "pattern").agg(F.max(F.col("seed").cast("int")).alias("seed")),
        "pii-edges",
    )
    seeds = edges.where("seed = 1").select("kind", "m", F.lit(1.0).alias("confidence"), F.lit(True).alias("given")).distinct()
    known = seeds
    for k in range(rounds):
        weighed = edges.join(known, ["kind", "m"], "left")
        patterns = (
            weighed.groupBy("kind", "pattern")
            .agg((F.sum(F.coalesce("confidence", F.lit(0.0))) / F.count(F.lit(1))).alias("c"), F.count("confidence").alias("support"))
            .where((F.col("c") >= MIN_CONFIDENCE) & (F.col("support") >= MIN_SUPPORT))
        )
        voted = (
            edges.join(patterns, ["kind", "pattern"])
            .groupBy("kind", "m")
            .agg(F.max("seed").alias("seed"), (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("c") * 0.95, F.lit(1e-9)))))).alias("score"), F.count(F.lit(1)).alias("votes"))
            .where((F.col("seed") == 0) & (F.col("votes") >= MIN_PATTERNS) & (F.col("score") >= MIN_INSTANCE))
        )
        known = stage(seeds.union(voted.select("kind", "m", "score", F.lit(False))), f"pii-known-{k}")
    return known.where("not given").drop("given")  # many votes make a confidence of 1.0 too


def find_pii(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and found: arrays of spans (k, kind, s, e, m), one row per input row."""
    t = texts(docs)
    base, cands = base_spans(F.col("text")), candidate_spans(F.col("text"))
    row = t.select("doc_id", "text", base.alias("base"), cands.alias("cands"))
    free = F.filter("cands", lambda c: ~F.exists("base", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
    rows = stage(
        row.select("doc_id", "text", "base", free.alias("cands"))
        .select(F.monotonically_increasing_id().alias("rid"), "doc_id", _contexts(F.col("text"), F.col("base")).alias("base"), _contexts(F.col("text"), F.col("cands")).alias("cands")),
        "pii-rows",
    )
    every = rows.where("size(base) + size(cands) > 0").select("rid", F.explode(F.concat(F.transform("base", lambda x: x.withField("seed", F.lit(True))), F.transform("cands", lambda x: x.withField("seed", F.lit(False))))).alias("x")).select("rid", "x.*")
    found = bootstrap(every, rounds).select("kind", F.col("m").alias("instance"))
    hits = (
        every.where("not seed").withColumn("instance", F.lower("m")).join(found, ["kind", "instance"])
        .groupBy("rid").agg(F.collect_list(F.struct("k", "kind", "s", "e", "m")).alias("found"))
    )
    plain = F.transform("base", lambda x: F.struct(x["k"].alias("k"), x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))
    none = F.expr("cast(array() as array<struct<k:int,kind:string,s:int,e:int,m:string>>)")
    return rows.join(hits, "rid", "left").select("doc_id", plain.alias("base"), F.coalesce("found", none).alias("found"))


def pii_query(docs: DataFrame) -> DataFrame:
    """The contract's digest columns of find_pii."""
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    every = F.array_sort(F.transform(F.concat("base", "found"), lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return find_pii(docs).select("doc_id", *(count(k) for k in range(4)), F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(every).alias("spans"))
