"""P0 refresh of the landing dataset; P1: incremental, idempotent landing -> bronze load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.operators import load as ld
from salescast.operators.marts import cast_projection
from salescast.schemas import BRONZE_ORDERS, LANDING_ORDERS
from salescast.sources import sinks
from salescast.sources.readers import scan_raw_orders


def ensure_bronze(spark: SparkSession, table: str, location: str | None = None) -> None:
    """A10 for bronze: partitioned by business_date (partition column last)."""
    cols = [f for f in BRONZE_ORDERS.fields if f.name != "business_date"] + [BRONZE_ORDERS["business_date"]]
    sinks.create_table(spark, table, T.StructType(cols), ["business_date"], location)


def staged_days(days: DataFrame) -> DataFrame:
    """The day list as a written table read back through a predicate: it has
    real statistics and a selective filter, so that a semi join on a partition
    column prunes the other side's directories at run time."""
    path = sinks.stage_dir(days.sparkSession, "days")
    days.select("business_date", F.lit(1).alias("need")).write.parquet(path)
    return days.sparkSession.read.schema("business_date bigint, need int").parquet(path).where("need = 1").select("business_date")


def run_load(spark: SparkSession, root: str, table: str = "bronze_orders", full_refresh: bool = False, window: int = 0,
             location: str | None = None) -> int:
    """D3 -> D2 -> C8 -> A1/B3 -> A6 in one replace job. Returns rows written.

    The day list is written before the load because it is derived from the
    very table being overwritten (never read and overwrite one table in a
    single plan)."""
    ensure_bronze(spark, table, location)
    landing = scan_raw_orders(spark, root)
    disk = ld.landing_day_counts(spark, root)
    if full_refresh:
        todo = disk.select("business_date")
    else:
        todo = ld.days_needing_load(disk, ld.day_counts(spark.table(table)), window)
    todo = staged_days(todo)
    if todo.isEmpty():
        return 0
    chosen = landing.join(todo, "business_date", "left_semi")
    return sinks.replace_days(cast_projection(chosen), table)


def run_refresh(source: DataFrame, root: str, today: dt.date, days: int | None, through_today: bool = False) -> int:
    """B7 -> A5 -> L5. Land the days that a refresh on ``today`` covers, each
    replacing what its folder holds; returns rows written.

    The days are literals, so a partitioned source is read in those folders only.
    A refresh of whole days that lands nothing means that extraction is broken,
    and raises; the count is the write's own. Single-day mode (``days=None``) may
    be empty, since a day may only just have begun. Days without orders keep the
    folder they have."""
    first, last = ld.refresh_bounds(today, days, through_today)
    n = sinks.write_partitions(ld.trailing_window(source, first, last), root, LANDING_ORDERS)
    if days is not None and n == 0:
        raise RuntimeError(f"no orders landed from {first} to {last}")
    return n
