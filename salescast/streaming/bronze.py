"""ST1-ST3: Structured Streaming over landed order documents.

ST1  documents (JSON files) -> flatten -> keyed state per order_guid (latest
     version, its day) -> the days that orders enter or leave -> foreachBatch:
     replace exactly those days (dynamic partition overwrite), idempotently.
     Only the touched days' folders are read; the table as a whole never is.
ST2  late edits: a later version of an order re-lands its day; the state keeps
     the highest version, so post-close refunds/tips are applied.
ST3  today-so-far: running state per business_date (update mode); equals the
     batch D4 aggregate. No watermark: late rows always count, and the state
     is one row per business day.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.functions.dates import BUSINESS_TZ, parse_iso_utc, utc_to_local
from salescast.functions.money import money_sum, rounded
from salescast.operators.flatten import flatten_orders
from salescast.operators.marts import cast_projection, live_orders
from salescast.schemas import BRONZE_ORDERS, NESTED_ORDER
from salescast.session import dynamic_overwrite, session_conf, session_confs
from salescast.sources.sinks import create_table, stage_dir

# Documents carry a version (e.g. the source's modification counter).
VERSIONED_ORDER = T.StructType(list(NESTED_ORDER.fields) + [T.StructField("version", T.LongType())])


def read_order_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(VERSIONED_ORDER)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def folder_jobs(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """Settings for jobs over the table's day folders: many, most of them small.

    A stream's session has adaptive execution off, and then a rebalance hint is dropped without a word: each task would
    write a file of its own into each day. Folders are listed, and small files read, many to a task."""
    listing = max(16, 4 * spark.sparkContext.defaultParallelism)
    return session_confs(spark, {"spark.sql.adaptive.enabled": "true", "spark.sql.files.openCostInBytes": "64k",
                                 "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(listing)})


def marked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows with the hash that decides between equal versions, whatever the order of tasks."""
    return rows.withColumn("mark", F.xxhash64(*[F.col(c) for c in columns if c != "order_guid"]))


def held_rows(spark: SparkSession, table: str, path: str) -> DataFrame:
    """What the table holds when the stream first starts, as a stream of its own: written to path once, for all restarts."""
    spark.catalog.refreshTable(table)  # another stream may have written it
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        with folder_jobs(spark):
            spark.table(table).withColumn("version", F.coalesce("version", F.lit(-1)).cast("bigint")).write.mode("overwrite").parquet(path)
    return spark.readStream.schema(spark.table(table).schema).parquet(path)


def order_changes(docs: DataFrame, held: DataFrame) -> DataFrame:
    """ST1/ST2 as keyed state: versioned documents -> (change, the table's columns).

    The state is a grouped maximum, kept by Spark's own aggregation: each order's latest row, with the batch it came in,
    and the days that it has stood on. An order whose latest row came in this batch is given out as "enter", and each
    other day of its as "leave". held, read in the first batch, is the beginning and is never given out. After that no
    batch looks the orders up in the table. Running a batch again gives the same changes.
    """
    incoming = cast_projection(flatten_orders(docs.withColumn("version", F.coalesce("version", F.lit(0)).cast("bigint")), carry=("version",)), keep=("version",))
    columns = incoming.columns
    now = F.unix_micros(F.current_timestamp())  # one value a batch, also if the batch is done again
    rows = marked(incoming, columns).withColumn("age", -now).unionByName(marked(held.select(*columns), columns).withColumn("age", F.lit(0).cast("bigint")))
    latest = F.max(F.struct("version", "mark", "age", *[c for c in columns if c not in ("order_guid", "version")]))  # equal rows: the first to come
    state = rows.groupBy("order_guid").agg(latest.alias("last"), F.collect_set(F.struct("business_date")).alias("days"))
    fresh = state.where(F.col("last.age") == -now).select("order_guid", "last", F.explode("days.business_date").alias("day"))
    stands = F.col("day").eqNullSafe(F.col("last.business_date"))
    given = {"order_guid": F.col("order_guid"), "business_date": F.col("day")}
    return fresh.select(F.when(stands, "enter").otherwise("leave").alias("change"), *[given.get(c, F.when(stands, F.col(f"last.{c}"))).alias(c) for c in columns])


def touched(table: DataFrame, days: list[int | None]) -> DataFrame:
    """The table's rows of the named days: literals, so that only these folders are listed and read."""
    known = ", ".join(f"{d}L" for d in days if d is not None)  # as text: a call a literal takes seconds for years of days
    cond = F.expr(f"business_date IN ({known})") if known else F.lit(False)
    return table.where(cond | F.col("business_date").isNull() if None in days else cond)


def staying(changes: DataFrame, table: str, days: list[int | None]) -> DataFrame:
    """The table's rows of the named days whose orders are not among the changes."""
    held = touched(changes.sparkSession.table(table), days)
    moved = changes.select(F.col("order_guid").alias("moved")).distinct()
    return held.join(moved, F.col("order_guid").eqNullSafe(F.col("moved")), "left_anti")


def rewritten_days(changes: DataFrame, table: str, days: list[int | None]) -> DataFrame:
    """The rows that the touched days hold after the changes."""
    stay = staying(changes, table, days)
    return stay.unionByName(changes.where("change = 'enter'").select(*stay.columns))


#: Days that a task writes, so that small days are written by many tasks at once; a large day is split among tasks.
DAYS_PER_TASK = 16


def replace_touched(rows: DataFrame, table: str, days: int) -> None:
    """Write the rows of the touched days, of which there are so many, in place of what these days hold.

    rows may read these days: dynamic overwrite writes into a staging folder, whose days take their place after the last task."""
    spark = rows.sparkSession
    tasks = -(-days // DAYS_PER_TASK)
    with dynamic_overwrite(spark), session_conf(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        rows.select(*spark.table(table).columns).hint("rebalance", tasks, "business_date").write.insertInto(table, overwrite=True)


@contextlib.contextmanager
def staged(rows: DataFrame) -> Iterator[DataFrame]:
    """rows, computed once into the shared folder; the copy goes when it has been used."""
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stage_dir(spark, "batch"))
    try:
        rows.write.parquet(path.toString())
        yield spark.read.schema(rows.schema).parquet(path.toString())
    finally:
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def merge_batch(changes: DataFrame, table: str) -> None:
    """foreachBatch body: rewrite the days that the batch's orders enter or leave, and only those.

    The batch is staged once, so that its state is computed once; a day that loses its last order is dropped. Doing a
    batch again gives the same table."""
    spark = changes.sparkSession
    spark.catalog.refreshTable(table)
    with staged(changes) as changes, folder_jobs(spark):
        entered = dict(changes.groupBy("business_date").agg(F.max(F.col("change") == "enter")).collect())  # bounded by the calendar
        if not entered:
            return
        only_left = [d for d, enters in entered.items() if not enters and d is not None]
        still = {r[0] for r in staying(changes, table, only_left).select("business_date").distinct().collect()} if only_left else set()
        replace_touched(rewritten_days(changes, table, list(entered)), table, len(entered))
    for day in (d for d in only_left if d not in still):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (business_date = {day})")


def ensure_versioned_bronze(spark: SparkSession, table: str, location: str | None = None) -> None:
    cols = [f for f in BRONZE_ORDERS.fields if f.name != "business_date"] + [T.StructField("version", T.LongType()),
                                                                             BRONZE_ORDERS["business_date"]]
    create_table(spark, table, T.StructType(cols), ["business_date"], location)


def start_bronze_stream(spark: SparkSession, docs_path: str, table: str, checkpoint: str, available_now: bool = True):
    """ST1: returns the StreamingQuery (availableNow for scheduled catch-up). The state lives in RocksDB, beside memory;
    the table's rows at the first start are kept beside the checkpoint."""
    changes = order_changes(read_order_stream(spark, docs_path), held_rows(spark, table, f"{checkpoint.rstrip('/')}-held"))
    w = changes.writeStream.outputMode("update").foreachBatch(lambda df, _epoch: merge_batch(df, table)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="15 minutes")
    with session_conf(spark, "spark.sql.streaming.stateStore.providerClass", ROCKS_DB):
        return w.start()


def catch_up(spark: SparkSession, docs_path: str, table: str, checkpoint: str) -> None:
    """Take in what has landed and end; the caller's session then sees the table as it is now.

    Its folders are listed here, many to a task; Spark keeps the list for the caller's reads, which would give each folder a task."""
    start_bronze_stream(spark, docs_path, table, checkpoint).awaitTermination()
    spark.catalog.refreshTable(table)
    with folder_jobs(spark):
        spark.table(table)._jdf.inputFiles()


def today_so_far(flat_stream: DataFrame, tz: str = BUSINESS_TZ) -> DataFrame:
    """ST3: per business day, order count, guests, net sales so far and the
    latest local open time. An order belongs to its business_date, whenever it
    was opened, and a late order updates its day's row."""
    live = live_orders(flat_stream).withColumn("opened_local", utc_to_local(parse_iso_utc("opened_date"), tz))
    return live.groupBy(F.col("business_date").cast("bigint").alias("business_date")).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("num_guests").cast("bigint").alias("guest_count"),
        rounded(money_sum("net_amount") - money_sum("deferred_amount"), 2).alias("net_sales_so_far"),
        F.max("opened_local").alias("last_order_opened_at"),
    )
