"""Benchmark decontamination by a distributed positional inverted index.

DataFrame functions only. Cases: a null text has no words and is never hit; items without words have no windows; a null
item_id is ignored in item lists but its windows count as hits; repeated document rows each get their own row; repeated
items count once; an empty table of either kind gives unhit or no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import BROADCAST_ROWS, let, regex_spans, small_side, stage

WINDOW = 13
#: Words that may stand between a window's terms in a proximity match.
NEAR = 2
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Buckets of the test vocabulary that travel in the plan, at most so many flags whatever the benchmark's size.
MIN_FLAGS, MAX_FLAGS = 1 << 16, 1 << 18


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null: none."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, wid, n, window) of every `size` consecutive words of an item; a shorter item is one window."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text").cast("string")).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    every = w.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, F.lit(size)))).alias("window")).distinct()
    return every.select("item", F.md5(F.array_join("window", " ")).alias("wid"), F.size("window").alias("n"), "window")


def _bucket(word: Column, flags: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(flags)).cast("int")


def anchors(wins: DataFrame) -> DataFrame:
    """(wid, n, window, item, term, terms): of each window the term in the fewest items, of those the longest, and how many
    distinct terms it has. Any term would do: a rare one has few places."""
    held = wins.select("item", F.explode("window").alias("term")).groupBy("term").agg(F.count_distinct("item").alias("df"))
    least = wins.select("wid", F.explode("window").alias("term")).distinct().join(held, "term").groupBy("wid").agg(F.min(F.struct("df", -F.length("term"), "term"))["term"].alias("term"))
    return wins.join(least, "wid").select("wid", "n", "window", "item", "term", F.size(F.array_distinct("window")).alias("terms"))


def _marks(terms: DataFrame, flags: int) -> list[int]:
    """By bucket, the bits that terms(bit, term) has in it."""
    marks = [0] * flags
    for r in terms.select("bit", _bucket(F.col("term"), flags).alias("b")).distinct().toLocalIterator():
        marks[r["b"]] |= 1 << r["bit"]
    return marks


def _scan(docs: DataFrame, wins: DataFrame, slop: int = 0, keep: bool = False, anchored: DataFrame | None = None, near: int = 0) -> DataFrame:
    """The staged rows of build_index, with their runs; anchored: and `around`, for every word in the bucket of an anchor
    the stretch of all words that a place with it can hold. One pass over the texts."""
    sizes = {r["n"]: r["terms"] for r in wins.groupBy("n").agg(F.min(F.size(F.array_distinct("window"))).alias("terms")).collect()}  # at most WINDOW
    terms = wins.select("n", F.explode("window").alias("term")).distinct()
    flags = min(MAX_FLAGS, max(MIN_FLAGS, 1 << (16 * max(1, terms.count())).bit_length()))
    # a bit for each size's terms, and above them one for its anchors: each word is looked up once for all of them
    order = sorted(sizes)
    bit = lambda n, above=0: F.array_position(F.array(*map(F.lit, order)), n).cast("int") - 1 + above
    marked = terms.select(bit(F.col("n")).alias("bit"), "term")
    if anchored is not None:
        marked = marked.union(anchored.select(bit(F.col("n"), len(order)), "term"))
    marks = F.split(F.lit(",".join(map(str, _marks(marked, flags) if order else [0]))), ",").cast("array<int>")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if keep else F.lit(None)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text").cast("string")).alias("w"), row.cast(docs.schema if keep else "int").alias("row"))
    rows = rows.withColumn("marks", F.transform("w", lambda x: F.get(marks, _bucket(x, flags) if order else F.lit(0))))
    none = F.expr("cast(array() as array<struct<at:int,run:array<string>>>)")

    def spans(at: int, pattern: str) -> Column:
        flagged = F.array_join(F.transform("marks", lambda m: F.when(m.bitwiseAND(1 << at) > 0, "1").otherwise("0")), "")
        return let(flagged, lambda t: regex_spans(t, pattern))

    def runs(n: int) -> Column:
        # a window's repeated terms need stand but once in a proximity match, and leave room for other words
        few, gap = (sizes[n], n + slop - sizes[n]) if slop else (n, 0)
        found = spans(order.index(n), f"1(?:0{{0,{gap}}}1){{{few - 1},}}+" if slop else f"1{{{n},}}+")
        return F.transform(found, lambda x: F.struct(x["s"].alias("at"), F.slice("w", x["s"] + 1, x["e"] - x["s"]).alias("run")))

    def around(n: int) -> Column:
        reach = n + near - 1
        return F.transform(spans(len(order) + order.index(n), "1"), lambda x: F.struct(
            F.greatest(x["s"] - reach, F.lit(0)).alias("at"),
            F.slice("w", F.greatest(x["s"] - reach, F.lit(0)) + 1, F.least(x["s"], F.lit(reach)) + reach + 1).alias("run"),
            F.element_at("w", x["s"] + 1).alias("term"), F.least(x["s"], F.lit(reach)).alias("k"), F.lit(n).alias("n")))

    held = F.array_distinct(reduce(F.concat, [runs(n) for n in order], none))
    held = F.when(F.size("w") >= (order[0] if order and not slop else 1), held).otherwise(none)
    more = ["row"] if keep else []
    if anchored is not None:
        more.append(reduce(F.concat, map(around, order), F.expr("cast(array() as array<struct<at:int,run:array<string>,term:string,k:int,n:int>>)")).alias("around"))
    return stage(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.size("w").cast("long").alias("n_words"), held.alias("runs"), *more), "decontam-rows")


def _runs(rows: DataFrame) -> DataFrame:
    return rows.where("size(runs) > 0").select("rid", F.explode("runs").alias("r")).select("rid", "r.at", "r.run")


def build_index(docs: DataFrame, wins: DataFrame, slop: int = 0, keep: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, runs): one row per document with rid and n_words; and the index's document runs.

    Only stretches of at least n consecutive test terms can hold a window of n words, so only those are posted:
    a row (rid, at, run) for every stretch, at its first word's position. The flags that mark test terms are hash
    buckets of bounded number; a word of another meaning in the same bucket only makes a stretch longer. slop: so many
    more words than the window's may a proximity match take, and other words may interrupt a stretch.
    """
    rows = _scan(docs, wins, slop, keep)
    return rows.drop("runs"), _runs(rows)


def postings(runs: DataFrame) -> DataFrame:
    """(term, rid, at, k): the positional postings; the word's position is at + k."""
    return runs.select("rid", "at", F.posexplode("run").alias("k", "term"))


def phrase_matches(wins: DataFrame, runs: DataFrame) -> DataFrame:
    """(rid, start, n, item): exact occurrences of windows.

    Each window looks up its rarest term's postings, shifted by the term's offset; those lists are intersected with the
    second-rarest term's shifted lists, and what remains is compared word by word in its stretch. Only positions move;
    the words of a stretch join what is left.
    """
    posted = postings(runs)
    distinct = wins.groupBy("wid", "n", "window").agg(F.collect_set("item").alias("items"))
    needed = distinct.select(F.explode("window").alias("term")).distinct()
    freq = stage(posted.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(needed, "term"), "decontam-freq")
    ranked = (
        distinct.select("wid", F.posexplode("window").alias("off", "term")).join(freq, "term")  # a term without postings: no match
        .groupBy("wid").agg(F.array_sort(F.collect_list(F.struct("df", "off", "term"))).alias("r"))
    )
    look = stage(
        distinct.join(ranked, "wid").where("size(r) = n")
        .select("wid", "n", "window", "items", F.col("r")[0]["term"].alias("term"), F.col("r")[0]["off"].alias("off"), F.coalesce(F.get("r", F.lit(1)), F.col("r")[0])["off"].alias("off2"), F.coalesce(F.get("r", F.lit(1)), F.col("r")[0])["term"].alias("term2")),
        "decontam-look",
    )
    first = posted.join(look.select("term", "wid", "n", "off", "off2", "term2"), "term").select("rid", "at", (F.col("k") - F.col("off")).alias("s"), "wid", "n", (F.col("k") - F.col("off") + F.col("off2")).alias("k"), F.col("term2").alias("term"))
    both = first.where("s >= 0").join(posted, ["rid", "at", "k", "term"], "left_semi")
    exact = both.select("rid", "at", "s", "wid", "n").join(runs, ["rid", "at"]).join(look.select("wid", "window", "items"), "wid").where(F.slice("run", F.col("s") + 1, F.col("n")) == F.col("window"))
    return exact.select("rid", (F.col("at") + F.col("s")).alias("start"), "n", F.explode_outer("items").alias("item")).distinct()  # no items: theirs are null


def proximity_matches(wins: DataFrame, runs: DataFrame, slop: int) -> DataFrame:
    """(rid, item, wid, start): places where all terms of a window stand, in any order, in its length plus `slop` words.

    start is where its rarest term stands. The places are looked for in the stretches of build_index: with slop there,
    other words may stand between the terms; without, only test terms may.
    """
    posted = postings(runs)
    distinct = wins.select("wid", "n", "window", "item")
    freq = posted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rare = distinct.select("wid", F.explode("window").alias("term")).join(freq, "term").groupBy("wid").agg(F.min(F.struct("df", "term"))["term"].alias("term"))
    return _places(posted.join(distinct.join(rare, "wid"), "term").join(runs, ["rid", "at"]), slop)


def _places(at: DataFrame, slop: int) -> DataFrame:
    """Of (rid, at, run, k, a window's columns), its term at k of the run, those with all of the window's terms near it."""
    starts = F.sequence(F.greatest(F.col("k") - F.col("n") - slop + 2, F.lit(1)), F.col("k") + 1)
    near = F.exists(starts, lambda s: F.size(F.array_except("window", F.slice("run", s, F.col("n") + slop))) == 0)
    return at.where(near).select("rid", "item", "wid", (F.col("at") + F.col("k")).alias("start")).distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, keep: bool = False, near: int | None = None) -> DataFrame:
    """doc_id, n_words, n_hit, items, contaminated, in one row per input row; keep: and `row`, all columns of docs.

    near: and `near_items`, the items that have all terms of a window, in any order, within its length plus `near`
    words of the text, whatever words stand between; those of exact occurrences among them. It changes no other column.
    """
    wins = stage(windows(benchmark), "decontam-windows")
    anchored = None if near is None else stage(anchors(wins), "decontam-anchors")
    scanned = _scan(docs, wins, keep=keep, anchored=anchored, near=near or 0)
    rows, runs = scanned.drop("runs", "around"), _runs(scanned)
    found = phrase_matches(wins, runs)
    span = F.transform("places", lambda p: F.sequence(p["start"], p["start"] + p["n"] - 1))
    hits = found.groupBy("rid").agg(F.collect_set(F.struct("start", "n")).alias("places"), F.array_sort(F.collect_set("item")).alias("items"))
    hits = stage(hits.select("rid", F.size(F.array_distinct(F.flatten(span))).cast("long").alias("n_hit"), "items"), "decontam-hits")
    # a row holds its items: the bound is on rows and items
    hits = F.broadcast(hits) if (hits.agg(F.sum(1 + F.size("items"))).first()[0] or 0) <= BROADCAST_ROWS else hits
    out = rows.join(hits, "rid", "left").select("rid", *(["row"] if keep else []), "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))
    out = out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
    return out.drop("rid") if near is None else out.join(_near_items(anchored, scanned, near), "rid", "left").drop("rid").withColumn("near_items", F.coalesce("near_items", F.expr("cast(array() as array<string>)")))


def _near_items(anchored: DataFrame, scanned: DataFrame, slop: int) -> DataFrame:
    """(rid, near_items): sorted distinct items of each row's proximity matches, looked for around every window's anchor."""
    around = scanned.where("size(around) > 0").select("rid", F.explode("around").alias("p")).select("rid", "p.*")
    at = around.join(small_side(anchored.where("item is not null")), ["term", "n"]).where(F.size(F.array_except("window", "run")) == 0)
    found = _places(at, slop).select("rid", "item").distinct()
    return found.groupBy("rid").agg(F.array_sort(F.collect_list("item")).alias("near_items"))


def decontam_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's digest columns of decontaminate, and the proximity matches as n_near and near_items."""
    return decontaminate(docs, benchmark, near=NEAR).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated", F.size("near_items").cast("long").alias("n_near"), F.array_join("near_items", ",").alias("near_items"))
