"""Helpers of the training-data operators: staged tables and native regex spans."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOTS: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """A folder of this session under ``spark.checkpoint.dir``; a scratch folder only on a local master without it.

    Raises on a cluster without the setting: executors could not see each other's files. The folder is
    deleted when the driver process ends normally.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="llm-stage-")
        _ROOTS[app] = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
        atexit.register(_drop, spark, _ROOTS[app])
    return _ROOTS[app]


def _drop(spark: SparkSession, root: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone by now
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage is cut, statistics are real."""
    path = f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean() -> None:
    """Let Arrow in this worker take its memory from malloc, which `hand_back` can trim."""
    pa.set_memory_pool(pa.system_memory_pool())


def hand_back() -> None:
    """Give a worker's freed memory back to the system at a task's end: workers idle on between stages and hold it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without this call keeps it
        ctypes.CDLL(None).malloc_trim(0)


#: Rows of a few short columns that may be broadcast: some 40 MB.
BROADCAST_ROWS = 500_000


def small_side(staged: DataFrame) -> DataFrame:
    """A staged narrow table, marked for broadcast if its counted rows are within the bound; else the planner decides."""
    return F.broadcast(staged) if staged.count() <= BROADCAST_ROWS else staged


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (long), text (null: empty) and the named columns; nothing else of the table is read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def finite(vector: str) -> Column:
    """Whether the array column is there and all its entries are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once however often `use` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Matches that are placed by one running sum; see regex_spans.
SPANS_AT_ONCE = 128


def regex_spans(text: Column, pattern: str, group: int | None = None) -> Column:
    """array<struct<s:int,e:int,m:string,g:string>> of the leftmost non-overlapping matches, in code points.

    s and e bound the match m (e exclusive); g is the named group's text, or the match. Built from the pieces
    between the matches, since Spark has no function that returns positions. An array that grows match by match is
    copied each time; so matches are placed in groups of SPANS_AT_ONCE, which are then shifted by the lengths before them.
    """
    lit = F.lit(pattern)
    found = F.arrays_zip(
        F.regexp_extract_all(text, lit, F.lit(0)).alias("m"),
        F.regexp_extract_all(text, lit, F.lit(group or 0)).alias("g"),
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
    )
    empty = F.expr("cast(array() as array<struct<s:int,e:int,m:string,g:string>>)")

    def place(pairs: Column) -> Column:
        return F.aggregate(
            pairs,
            F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda a, x: F.struct(
                (a["at"] + x["gap"] + F.length(x["m"])).alias("at"),
                F.concat(a["out"], F.array(F.struct((a["at"] + x["gap"]).alias("s"), (a["at"] + x["gap"] + F.length(x["m"])).alias("e"), x["m"].alias("m"), x["g"].alias("g")))).alias("out"),
            ),
        )

    def shifted(parts: Column) -> Column:
        ends = F.aggregate(parts, F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + p["at"])))
        move = lambda p, at: F.transform(p["out"], lambda x: F.struct((x["s"] + at).alias("s"), (x["e"] + at).alias("e"), x["m"].alias("m"), x["g"].alias("g")))
        return let(ends, lambda e: F.flatten(F.transform(parts, lambda p, i: move(p, F.get(e, i)))))

    def spans(pairs: Column) -> Column:
        groups = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / SPANS_AT_ONCE).cast("int"))
        many = let(F.transform(groups, lambda i: place(F.slice(pairs, i * SPANS_AT_ONCE + 1, F.lit(SPANS_AT_ONCE)))), shifted)
        return F.when(F.size(pairs) == 0, empty).when(F.size(pairs) <= SPANS_AT_ONCE, place(pairs)["out"]).otherwise(many)

    return let(F.filter(found, lambda x: x["m"].isNotNull()), spans)


def guarded_spans(text: Column, quick: Column, pattern: str, group: int | None = None) -> Column:
    """regex_spans where the cheap test `quick` allows a match, else an empty array."""
    return F.when(quick, regex_spans(text, pattern, group)).otherwise(F.expr("cast(array() as array<struct<s:int,e:int,m:string,g:string>>)"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, of an array of structs with kind, s and e, in the array's order."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def connected(edges: DataFrame, name: str) -> DataFrame:
    """Components of an undirected graph: edges(u, v) -> (node, root), root the smallest node of the component.

    Alternating large-star and small-star steps; every step is a grouped minimum and a join, and is staged. The minimum
    of a node with very many neighbours is pre-aggregated, and the minima are a staged table of their own: it is
    broadcast within the bound of `small_side`, and beyond it the join's two sides are plain shuffles, of which
    adaptive execution splits the large partitions. So no task need hold all neighbours of such a node.
    """

    def step(pairs: DataFrame, large: bool, k: int) -> DataFrame:
        least = stage(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), f"{name}-least-{k}")
        joined = pairs.join(small_side(least), "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        return stage(out.where("u <> v").distinct(), f"{name}-{k}")

    now, before, k = stage(edges.select("u", "v").where("u <> v"), f"{name}-0"), None, 0
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = step(both, True, k)
        now = step(now.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), False, k)
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before, k = state, k + 1
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
