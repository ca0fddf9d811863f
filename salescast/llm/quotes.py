"""Chat formatting by quotation linking.

A message's lines carry quote levels (leading '>' marks). Lines of level 0 are its own text; every run of quoted lines of
one level is a passage. Passages and the messages' own texts, paragraphs and lines are normalised and hashed, and so are
runs of a message's lines or paragraphs that begin with the first two of some passage and are as long as it. A passage
joins the first message of its conversation that holds it unquoted, or else the first message of any other conversation.
A part of a line, or lines wrapped anew that aren't whole paragraphs, are not found. The latest message that a level-1 passage comes from (level 2 and more, if there is none) is the parent. A conversation in
reply order is its messages by place (see reply_order): each reply stands after what it answers, before what is said next.
Own texts are rendered without quotes. DataFrame functions only; a conversation is never gathered: first occurrences are grouped minima, and
roots and depths come from pointer doubling on (conv_id, turn). Cases: a null or empty text has an empty body; a null
conv_id or turn links with nothing and is its own root; rows that repeat a turn are all kept and share its place; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.common import let, small_side, stage

#: What a passage may be a run of, and what parts them.
UNITS = {"lines": "\n", "paragraphs": r"\n[ \t]*\n"}
MARKS = r"^(?:[ \t]{0,3}+>[ \t]?+)++"  # possessive: a loop, however many marks


def levels(text: Column) -> Column:
    """array<struct<level:int,line:string>> of a text's lines."""
    lines = F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")
    marks = lambda x: F.regexp_extract(x, MARKS, 0)
    return F.transform(lines, lambda x: F.struct((F.length(marks(x)) - F.length(F.regexp_replace(marks(x), ">", ""))).alias("level"), F.regexp_replace(x, MARKS, "").alias("line")))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passages(lines: Column) -> Column:
    """array<struct<level:int,line:string>>: runs of lines of one level, joined by newlines; level 0 runs too."""

    def runs(own: Column, starts: Column) -> Column:
        def run(i: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(own))
            return F.struct(F.get(own, i)["level"].alias("level"), F.array_join(F.transform(F.slice(own, i + 1, end - i), lambda x: x["line"]), "\n").alias("line"))

        return F.transform(starts, run)

    begins = lambda own: F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: (i == 0) | (F.get(own, i)["level"] != F.get(own, i - 1)["level"]))
    return let(lines, lambda own: let(begins(own), lambda starts: runs(own, starts)))


def _trimmed(text: Column) -> Column:
    """The text without white space at its ends; each run of blanks is looked at once."""
    return F.regexp_replace(F.regexp_replace(text, r"^\s++", ""), r"(?<!\s)\s++\z", "")


def _units(text: Column, pattern: str) -> Column:
    """The normalised parts of a text that hold a word."""
    return F.filter(F.transform(F.split(text, pattern), normalised), lambda x: x != "")


def _head(units: Column, i: Column) -> Column:
    """Hash of the two units from the 0-based place i."""
    return F.md5(F.concat(F.get(units, i), F.lit("\n"), F.get(units, i + 1)))


def _said_runs(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(conv_id, turn, hash) of the runs of two or more lines or paragraphs that begin and are as long as a passage."""
    out = None
    for unit, pattern in UNITS.items():
        heads = asked.select(F.col(unit)["head"].alias("head"), F.col(unit)["n"].alias("n")).where("n > 1").distinct()
        heads = small_side(stage(heads, f"quotes-heads-{unit}"))
        own = rows.select("rid", "conv_id", "turn", _units(F.col("body"), pattern).alias("units"))
        starts = F.transform(F.sequence(F.lit(0), F.size("units") - 2), lambda i: _head(F.col("units"), i))
        at = own.where("size(units) > 1").select("rid", F.posexplode(starts).alias("i", "head")).join(heads, "head").select("rid", "i", "n")
        runs = own.join(small_side(stage(at, f"quotes-starts-{unit}")), "rid").where("i + n <= size(units)").select("conv_id", "turn", F.md5(F.array_join(F.slice("units", F.col("i") + 1, F.col("n")), " ")).alias("hash"))
        out = runs if out is None else out.union(runs)
    return out


def _threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of the messages that have a parent, by pointer doubling."""
    now, total = stage(parents.select("conv_id", "turn", F.col("parent_turn").alias("top"), F.lit(1).cast("long").alias("depth")), "quotes-0"), -1
    while True:
        state = now.agg(F.coalesce(F.sum("depth"), F.lit(0))).first()[0]
        if state == total or state == 0:
            return now.select("conv_id", "turn", F.col("top").alias("root_turn"), "depth")
        total = state
        up = now.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), F.col("top").alias("top2"), F.col("depth").alias("d2"))
        step = now.join(up, (F.col("conv_id") == F.col("c2")) & (F.col("top") == F.col("t2")), "left")
        now = stage(step.select("conv_id", "turn", F.coalesce("top2", "top").alias("top"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth")), "quotes-step")


def link_quotes(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, body, n_quotes, n_linked, parent_conv, parent_turn, root_turn, depth, rendered."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = levels(text)
    base = messages.select(F.monotonically_increasing_id().alias("rid"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), passages(lines).alias("runs"))
    own = F.array_join(F.transform(F.filter("runs", lambda x: x["level"] == 0), lambda x: x["line"]), "\n")
    quoted = F.transform(F.filter("runs", lambda x: x["level"] > 0), lambda x: F.struct(x["level"].alias("level"), normalised(x["line"]).alias("norm"), *(_units(x["line"], p).alias(u) for u, p in UNITS.items())))
    run = lambda x: F.struct(F.size(x).alias("n"), _head(x, F.lit(0)).alias("head"))
    quoted = F.transform(F.filter(quoted, lambda x: x["norm"] != ""), lambda x: F.struct(x["level"].alias("level"), F.md5(x["norm"]).alias("hash"), *(run(x[u]).alias(u) for u in UNITS)))
    rows = stage(base.select("rid", "conv_id", "turn", "role", _trimmed(own).alias("body"), quoted.alias("quotes")), "quotes-rows")
    units = F.concat(F.array("body"), F.split("body", r"\n[ \t]*\n"), F.split("body", "\n"))
    hashes = F.array_distinct(F.transform(F.filter(F.transform(units, normalised), lambda x: x != ""), F.md5))
    asked = rows.where("size(quotes) > 0").select("rid", "conv_id", "turn", F.explode("quotes").alias("q")).select("rid", "conv_id", "turn", "q.*")
    placed = rows.where("conv_id is not null and turn is not null")
    said = placed.select("conv_id", "turn", F.explode(hashes).alias("hash")).union(_said_runs(placed, asked)).join(asked.select("hash").distinct(), "hash", "left_semi")
    local = said.groupBy("conv_id", "hash").agg(F.min("turn").alias("t1"))
    local = stage(local, "quotes-said")
    holder = F.min(F.struct("conv_id", F.col("t1").alias("turn")))
    first = local.groupBy("hash").agg(holder.alias("f1"))
    second = local.join(first, "hash").where(F.col("conv_id") != F.col("f1.conv_id")).groupBy("hash").agg(holder.alias("f2"))
    outside = F.when(F.col("f1.conv_id") != F.col("conv_id"), F.col("f1")).when(F.col("f1.conv_id") == F.col("conv_id"), F.col("f2"))
    near = asked.join(local, ["conv_id", "hash"], "left").withColumn("t1", F.when(F.col("t1") < F.col("turn"), F.col("t1")))
    far = near.join(first, "hash", "left").join(second, "hash", "left").select("rid", "conv_id", "turn", "level", "t1", F.when(F.col("t1").isNull(), outside).alias("f"))
    linked = stage(
        far.groupBy("rid").agg(
            F.first("conv_id").alias("c"), F.first("turn").alias("t"),
            F.sum((F.col("t1").isNotNull() | F.col("f").isNotNull()).cast("int")).cast("long").alias("n_linked"),
            F.max(F.when(F.col("t1").isNotNull(), F.struct((F.col("level") == 1).alias("direct"), F.col("t1").alias("t1"))))["t1"].alias("near_turn"),
            F.min("f").alias("far"),
        ),
        "quotes-linked",
    )
    parents = linked.where("near_turn is not null").groupBy(F.col("c").alias("conv_id"), F.col("t").alias("turn")).agg(F.max("near_turn").alias("parent_turn"))
    threads = stage(_threads(parents).join(parents, ["conv_id", "turn"]), "quotes-threads")
    placed = rows.join(linked.select("rid", "n_linked", "far", "near_turn"), "rid", "left").join(threads, ["conv_id", "turn"], "left")
    outside = F.col("parent_turn").isNull() & F.col("far").isNotNull()
    return placed.select(
        "conv_id", "turn", "role", "body", F.size("quotes").cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.when(outside, F.col("far.conv_id")).when(F.col("parent_turn").isNotNull(), F.col("conv_id")).alias("parent_conv"),
        F.when(outside, F.col("far.turn")).otherwise(F.col("parent_turn")).alias("parent_turn"),
        F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("body"), F.lit("\n")).alias("rendered"),
    )


def _resolved(rows: DataFrame, name: str, add: bool) -> DataFrame:
    """rows(conv_id, turn, to, done[, steps]) -> (conv_id, turn, done[, steps]) by pointer doubling: a row without `done` takes
    that of the row which `to` names, in the end; with `add`, the steps on the way are summed. Rows with neither stay null."""
    now, left = stage(rows, f"{name}-0"), -1
    while True:
        open_ = now.where("done is null and to is not null").count()
        if open_ == 0 or open_ == left and not add:
            return now
        left = open_
        up = now.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"), F.col("to").alias("to2"), F.col("done").alias("done2"), *([F.col("steps").alias("s2")] if add else []))
        step = now.join(up, (F.col("conv_id") == F.col("c2")) & (F.col("to") == F.col("t2")) & F.col("done").isNull(), "left")
        open_now = F.col("done").isNull() & F.col("c2").isNotNull()
        now = stage(step.select(
            "conv_id", "turn", F.when(open_now, F.col("to2")).otherwise(F.col("to")).alias("to"), F.coalesce("done", "done2").alias("done"),
            *([F.when(open_now, F.col("steps") + F.col("s2")).otherwise(F.col("steps")).alias("steps")] if add else [])), f"{name}-step")


#: Turns that one sorted run of siblings spans.
RUN_TURNS = 1024


def _siblings(tree: DataFrame) -> DataFrame:
    """tree(conv_id, turn, parent) with `sibling`, the next turn of the same parent (of no parent, for those without).

    Found in runs of RUN_TURNS turns; the last of a run takes the first of the parent's next run that has any."""
    runs = tree.withColumn("run", F.floor(F.col("turn") / RUN_TURNS))
    near = Window.partitionBy("conv_id", "parent", "run").orderBy("turn")
    placed = runs.withColumn("near", F.lead("turn").over(near))
    heads = runs.groupBy("conv_id", "parent", "run").agg(F.min("turn").alias("head"))
    far = heads.withColumn("far", F.lead("head").over(Window.partitionBy("conv_id", "parent").orderBy("run")))
    far = stage(far.select(F.col("conv_id").alias("c2"), F.col("parent").alias("p2"), F.col("run").alias("r2"), "far"), "order-runs")
    both = placed.join(far, (F.col("conv_id") == F.col("c2")) & F.col("parent").eqNullSafe(F.col("p2")) & (F.col("run") == F.col("r2")))
    return both.select("conv_id", "turn", "parent", F.coalesce("near", "far").alias("sibling"))


def _before(trees: DataFrame) -> DataFrame:
    """trees(conv_id, root, end, length) with `before`: the lengths of the conversation's trees of earlier roots together.

    Summed in runs of RUN_TURNS turns, then over the runs."""
    runs = stage(trees.withColumn("run", F.floor(F.col("root") / RUN_TURNS)), "order-trees")
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    sums = runs.groupBy("conv_id", "run").agg(F.sum("length").alias("total"))
    sums = sums.select(F.col("conv_id").alias("c2"), F.col("run").alias("r2"), F.coalesce(F.sum("total").over(earlier("conv_id").orderBy("run")), F.lit(0)).alias("far"))
    near = runs.withColumn("near", F.coalesce(F.sum("length").over(earlier("conv_id", "run").orderBy("root")), F.lit(0)))
    both = near.join(stage(sums, "order-sums"), (F.col("conv_id") == F.col("c2")) & (F.col("run") == F.col("r2")))
    return both.select("conv_id", "root", "end", "length", (F.col("near") + F.col("far")).alias("before"))


def reply_order(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, place): the place of each turn in its conversation's reply order, from 1.

    A conversation is its trees, by the turns of their roots; in a tree, after a turn come its replies, each followed by
    its own replies, in the order of their turns. So after a turn comes its first reply, or else the next sibling of
    itself or of the nearest turn above it that has one. Both "nearest above" and the place in that walk are pointer
    doubling over the turns that have a parent or a reply; a conversation, or the replies to one turn, are never gathered.
    """
    tree = linked.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("parent_conv") == F.col("conv_id"), F.col("parent_turn"))).alias("parent"))
    tree = stage(tree, "order-turns")
    first = tree.where("parent is not null").groupBy("conv_id", F.col("parent").alias("turn")).agg(F.min("turn").alias("reply"))
    tree = stage(tree.join(first, ["conv_id", "turn"], "left"), "order-tree")
    alone, many = tree.where("parent is null and reply is null"), tree.where("parent is not null or reply is not null")
    nothing = F.lit(None).cast("long")
    ups = _siblings(many.where("parent is not null").select("conv_id", "turn", "parent")).select("conv_id", "turn", F.col("parent").alias("to"), F.col("sibling").alias("done"))
    up = _resolved(ups.union(many.where("parent is null").select("conv_id", "turn", nothing, nothing)), "order-up", False)
    walk = many.select("conv_id", "turn", "reply").join(up.select("conv_id", "turn", "done"), ["conv_id", "turn"])
    walk = walk.select("conv_id", "turn", F.coalesce("reply", "done").alias("to"), F.lit(1).cast("long").alias("steps"))
    # a tree's last turn has no next: it names the tree, and all others count the steps to it
    ranked = _resolved(walk.select("conv_id", "turn", "to", F.when(F.col("to").isNull(), F.col("turn")).alias("done"), "steps"), "order-walk", True)
    trees = ranked.groupBy("conv_id", F.col("done").alias("end")).agg(F.max_by("turn", "steps").alias("root"), F.max("steps").alias("length"))
    trees = stage(_before(trees.select("conv_id", "root", "end", "length").union(alone.select("conv_id", F.col("turn").alias("root"), nothing.alias("end"), F.lit(1).cast("long").alias("length")))), "order-before")
    inner = ranked.select("conv_id", "turn", F.col("done").alias("end"), "steps").join(trees.where("end is not null"), ["conv_id", "end"])
    return trees.where("end is null").select("conv_id", F.col("root").alias("turn"), (F.col("before") + 1).alias("place")).union(
        inner.select("conv_id", "turn", (F.col("before") + F.col("length") - F.col("steps") + 1).alias("place")))


def conversations(linked: DataFrame) -> DataFrame:
    """link_quotes' rows with `place`; null where a conversation or turn has no number, shared by rows that repeat a turn."""
    return linked.join(reply_order(linked), ["conv_id", "turn"], "left")


def quotes_query(messages: DataFrame) -> DataFrame:
    """The messages with their links and their place in the reply-ordered conversation."""
    return conversations(stage(link_quotes(messages), "quotes-messages"))
