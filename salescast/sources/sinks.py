"""Pinned-schema writers.

Every writer casts to its table schema by name first, so a drifted frame can
neither reorder nor silently widen a column; an empty frame never writes.
Row counts come from an ``Observation`` on the write itself (one scan).
"""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.schemas import ARCHIVES, FORECAST_TABLES, ddl, with_keys
from salescast.session import dynamic_overwrite, ensure_checkpoint_dir


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select table columns by name and cast each to the table type."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stage_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint dir (never a
    machine-local temp folder)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/salescast-stage/{label}-{uuid.uuid4().hex}"


def _observed_write(df: DataFrame, write) -> int:
    obs = Observation("rows_written")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    write(observed)
    return int(obs.get.get("n", 0) or 0)


def write_partitions(df: DataFrame, root: str, schema: T.StructType, mode: str = "overwrite") -> int:
    """A5: one partition per non-empty business day. ``overwrite`` replaces
    only the days present in ``df`` (dynamic partition overwrite); ``skip``
    leaves days already on disk untouched (C9 anti join). A day with zero rows
    writes nothing and does not clear an older partition."""
    spark = df.sparkSession
    out = conform(df, schema)
    if mode == "skip":
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):  # no root yet: nothing to skip
            existing = spark.read.schema(schema).parquet(root).select("business_date").distinct()
            out = out.join(existing, "business_date", "left_anti")
    elif mode != "overwrite":
        raise ValueError(f"mode must be overwrite or skip, not {mode!r}")
    # REBALANCE on the partition column: few files per day, while AQE splits a
    # hot day across tasks instead of sending it to one writer.
    out = out.hint("rebalance", "business_date")
    return _observed_write(
        out,
        lambda d: d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("business_date").parquet(root),
    )


#: Documents of a file: a compressed file is read by one task.
DOCUMENTS_PER_FILE = 100_000


def write_documents(df: DataFrame, path: str) -> None:
    """Documents as compressed JSON lines: their field names, repeated in each, take many times the values' space.
    Files are bounded, so that they are read in parallel without being split."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", DOCUMENTS_PER_FILE).json(path)


def table_root(spark: SparkSession, table: str) -> str:
    """Where a table's files go if its caller names no folder: beside the shared
    stage folders, since the default warehouse may be one machine's disk."""
    return stage_dir(spark, f"table-{table.replace('.', '-')}")


def create_table(spark: SparkSession, table: str, schema: T.StructType, partitioned_by: list[str] | None = None, location: str | None = None) -> None:
    """A10: CREATE TABLE IF NOT EXISTS with a pinned schema in a named folder."""
    spark.sql(ddl(table, schema, partitioned_by, location=location or table_root(spark, table)))


def create_forecast_tables(spark: SparkSession, prefix: str = "", keys: list[tuple[str, T.DataType]] | None = None, location: str | None = None) -> list[str]:
    """A10: the four tables that a forecast run writes, so that views over them
    exist before the first run. The archives are partitioned by run."""
    made = []
    for name, schema in FORECAST_TABLES.items():
        part = ["run_ts"] if name in ARCHIVES else None
        create_table(spark, prefix + name, with_keys(schema, keys or []), part, location and f"{location.rstrip('/')}/{prefix}{name}")
        made.append(prefix + name)
    return made


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(df: DataFrame, table: str, schema: T.StructType) -> int:
    """Replace a table's rows as one step: the new rows are written to a folder
    of their own, and the table's location moves there after the last task has
    ended. Until then, and if the write fails, readers see the old rows; a reader
    that has begun goes on reading them. No rows: nothing changes. Returns rows."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(spark, table, schema)
    home = table_location(spark, table).rstrip("/")
    home = home.rpartition("/v-")[0] or home
    folder = f"{home}/v-{uuid.uuid4().hex}"
    n = _observed_write(conform(df, schema), lambda d: d.write.parquet(folder))
    path, fs = _fs(spark, folder)
    if n == 0:
        fs.delete(path, True)
        return 0
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    return n


def drop_old_versions(spark: SparkSession, table: str, keep_hours: float = 24.0) -> int:
    """Delete versions of a published table that are older than ``keep_hours``
    and not the current one; returns how many."""
    now = table_location(spark, table).rstrip("/")
    home, dropped = now.rpartition("/v-")[0], 0
    if not home:
        return 0
    path, fs = _fs(spark, home)
    for f in fs.listStatus(path):
        name = f.getPath().getName()
        if name.startswith("v-") and not now.endswith(name) and f.getModificationTime() < (time.time() - keep_hours * 3600) * 1000:
            fs.delete(f.getPath(), True)
            dropped += 1
    return dropped


def replace_days(df: DataFrame, table: str) -> int:
    """Replace exactly the business days present in ``df`` in a table
    partitioned by business_date, in ONE job. insertInto is positional, so the
    frame is projected onto the table's own column order first."""
    spark = df.sparkSession
    target_cols = spark.table(table).columns
    types = {f.name: f.dataType for f in spark.table(table).schema.fields}
    out = df.select([F.col(c).cast(types[c]).alias(c) for c in target_cols]).hint("rebalance", "business_date")
    with dynamic_overwrite(spark):
        return _observed_write(out, lambda d: d.write.insertInto(table, overwrite=True))


def write_latest(df: DataFrame, table: str, schema: T.StructType) -> int:
    """The table holds only this run; an empty frame writes nothing."""
    return publish(df, table, schema)


def write_overwrite_once(frames: list[DataFrame], table: str, schema: T.StructType) -> int:
    """Union every model's rows and replace ONCE (two replacements would
    make the second wipe the first)."""
    if not frames:
        return 0
    return publish(reduce(DataFrame.unionByName, [conform(f, schema) for f in frames]), table, schema)


def append_history(df: DataFrame, table: str, schema: T.StructType) -> int:
    """Archive (metrics, as-of forecasts) partitioned by run: a run's rows
    are a partition of their own, which a retry of the run replaces, so that
    they are there exactly once; other runs stay. No rows: nothing changes.
    Store assignment is ANSI, so an out-of-range value fails the job."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(spark, table, schema, ["run_ts"])
    with dynamic_overwrite(spark):
        return _observed_write(conform(df, schema), lambda d: d.select(*spark.table(table).columns).write.insertInto(table, overwrite=True))


def export_csv(df: DataFrame, path: str, order_by: list[str] | None = None) -> int:
    """Header CSV export (one folder of part files)."""
    out = df.orderBy(*order_by) if order_by else df
    return _observed_write(out, lambda d: d.write.mode("overwrite").option("header", True).csv(path))


def serving_cells(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Spreadsheet-safe projection, typed per column. Numbers stay numbers,
    with NaN as an empty cell; booleans, dates and timestamps become text;
    a NULL is an empty cell."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType)):
            cell = F.when(~F.isnan(c), c)
        elif isinstance(t, T.NumericType):
            cell = c
        elif isinstance(t, T.BooleanType):
            cell = F.when(c, F.lit("True")).when(~c, F.lit("False"))
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            cell = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            cell = F.date_format(c, "yyyy-MM-dd")
        else:
            cell = c.cast("string")
        cols.append((cell if isinstance(t, T.NumericType) else F.coalesce(cell, F.lit(""))).alias(f.name))
    out = df.select(cols)
    return out.orderBy(*order_by) if order_by else out


def publish_serving(frames: dict[str, DataFrame], root: str, order_by: dict[str, list[str]] | None = None) -> dict[str, int]:
    """Write each serving frame, in its order, as a header CSV under
    ``root/<name>`` and return rows written per target (the spreadsheet push
    itself is transport). Part files are in the order of their names."""
    order_by = order_by or {}
    return {name: export_csv(serving_cells(df, order_by.get(name)), f"{root.rstrip('/')}/{name}") for name, df in frames.items()}


def read_cells(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A published target read back: the cells' types, empty text cells as ''."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema.fields])
