"""Schema-conformance repair of a drifted landing archive.

1. Footer scan: the archive's file list is a DataFrame (``binaryFile`` with
   the content column pruned), and ``mapInPandas`` reads each Parquet footer
   on the executors -> (path, business_date, signature, drifted columns).
2. The files of days with a drifted one are grouped by stored schema; each
   group is one splittable read, cast to the pinned schema (a lossy conversion
   raises), so that mixed files of a day never meet in one reader and no row of
   the day is left out.
3. The repaired days are staged, then swapped in by dynamic partition
   overwrite (never read and overwrite one path in a single plan).
Idempotent: a conforming archive reports and rewrites nothing.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.schemas import LANDING_ORDERS
from salescast.sources import sinks

_ARROW = {"int64": "bigint", "double": "double", "string": "string", "large_string": "string", "bool": "boolean",
          "int32": "int", "int16": "smallint", "int8": "tinyint", "float": "float", "null": "void", "date32[day]": "date",
          "large_binary": "binary"}


def _spark_type(arrow_type: str) -> str:
    """The Spark type that reads a stored type; others by their own name."""
    if arrow_type.startswith("timestamp["):
        return "timestamp" if "tz=" in arrow_type else "timestamp_ntz"
    return re.sub(r"^decimal128\((\d+), (-?\d+)\)$", r"decimal(\1,\2)", _ARROW.get(arrow_type, arrow_type))


def footer_report(spark: SparkSession, root: str, schema: T.StructType = LANDING_ORDERS) -> DataFrame:
    """One row per Parquet file: path, business_date, schema signature and
    the comma list of columns whose stored type differs from the pinned one
    (empty = conforming). Only footers are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet") \
        .load(root).select("path")
    pinned = {f.name: f.dataType.simpleString() for f in schema.fields}

    def read_footers(it):
        from pyarrow import fs

        for pdf in it:
            out = []
            for p in pdf["path"]:
                store, name = (fs.LocalFileSystem(), re.sub("^file:/+", "/", p)) if p.startswith("file:") else fs.FileSystem.from_uri(p)
                sch = pq.read_schema(name, filesystem=store)
                stored = {f.name: _spark_type(str(f.type)) for f in sch}
                drift = [c for c, t in pinned.items() if c != "business_date" and stored.get(c, "missing") != t]
                m = re.search(r"business_date=(\d+)", p)
                out.append((p, int(m.group(1)) if m else None,
                            ";".join(f"{k}:{v}" for k, v in sorted(stored.items())), ",".join(drift)))
            yield pd.DataFrame(out, columns=["path", "business_date", "signature", "drifted"])

    return files.mapInPandas(read_footers, "path string, business_date bigint, signature string, drifted string")


def safe_cast(c: Column, source: T.DataType, target: T.DataType, name: str) -> Column:
    """Value-exact cast: raises when the round trip changes a value
    (CAST(2.5 AS BIGINT) would silently give 2)."""
    out = c.cast(target)
    if source == target or isinstance(source, T.NullType):
        return out.alias(name)
    exact = c.isNull() | (out.cast(source) == c)
    return F.when(exact, out).otherwise(F.raise_error(F.concat(F.lit(f"lossy cast of {name}: "), c.cast("string")))).alias(name)


def conform_frame(df: DataFrame, schema: T.StructType = LANDING_ORDERS) -> DataFrame:
    """Select the pinned columns by name (a missing column raises; extra
    columns are dropped) and safe-cast each to its pinned type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise KeyError(f"missing columns: {missing}")
    return df.select([safe_cast(F.col(f.name), have[f.name], f.dataType, f.name) for f in schema.fields])


def conform_archive(spark: SparkSession, root: str, schema: T.StructType = LANDING_ORDERS) -> list[int]:
    """Rewrite every day that has a drifted file, with the rows of all its
    files; returns the rewritten days.

    Files of one signature are one read: Spark's own reader splits them by row
    groups, so a file of any size takes no more memory than a batch, and types
    that no one reader can mix are cast apart before they meet. The driver holds
    the paths of the drifted days' files, as any file listing does."""
    report = footer_report(spark, root, schema)
    drifted = report.where(F.col("drifted") != "").select("business_date").distinct()
    rows = report.join(drifted, "business_date", "left_semi").select("business_date", "signature", "path").collect()
    if not rows:
        return []
    by_signature: dict[str, list[str]] = {}
    for r in rows:
        by_signature.setdefault(r["signature"], []).append(r["path"])
    parts = [conform_frame(read_signature(spark, root, signature, sorted(paths), schema), schema) for signature, paths in sorted(by_signature.items())]
    stage = sinks.stage_dir(spark, "conform")
    reduce(DataFrame.unionByName, parts).write.parquet(stage)
    sinks.write_partitions(spark.read.schema(schema).parquet(stage), root, schema, mode="overwrite")
    return sorted({r["business_date"] for r in rows})


def read_signature(spark: SparkSession, root: str, signature: str, paths: list[str], schema: T.StructType) -> DataFrame:
    """Files that share a stored schema, read with it. A column whose stored type
    is null throughout is not read but filled; the folder names the day."""
    stored = dict(part.split(":", 1) for part in signature.split(";"))
    void = [c for c, t in stored.items() if t == "void"]
    fields = [T.StructField(c, T._parse_datatype_string(t)) for c, t in stored.items() if c not in void and c != "business_date"]
    fields.append(schema["business_date"])
    df = spark.read.schema(T.StructType(fields)).option("basePath", root).parquet(*paths)
    return df.withColumns({c: F.lit(None) for c in void})
