"""Incremental, idempotent bronze load by business day.

The day choice is a DataFrame join, not a driver-side dict: counts on disk and
in bronze are aggregated where the data lives and compared with a left join.
Only the resulting day list (bounded by the calendar, not by row volume) is
ever small enough to matter, and even it stays distributed.
"""

from __future__ import annotations

import contextlib
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.functions.dates import date_to_yyyymmdd, yyyymmdd_to_date
from salescast.schemas import LANDING_ORDERS
from salescast.session import cut_lineage, session_conf


def day_counts(df: DataFrame, name: str = "n") -> DataFrame:
    """Rows per business day of a table."""
    return df.groupBy(F.col("business_date").cast("bigint").alias("business_date")).agg(F.count(F.lit(1)).alias(name))


#: Reads Parquet by the reader that answers counts from file footers.
FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(spark: SparkSession, root: str) -> DataFrame:
    """The plan of D3; it is pushed down only while FOOTERS hold."""
    return day_counts(spark.read.schema(LANDING_ORDERS).parquet(root))


def landing_day_counts(spark: SparkSession, root: str) -> DataFrame:
    """D3: rows per day on disk, from file footers alone: the count by partition
    folder is pushed into the scan, which reads no column chunk. The result, one
    row a day, is computed here, while the settings hold."""
    with contextlib.ExitStack() as held:
        for name, value in FOOTERS.items():
            held.enter_context(session_conf(spark, name, value))
        return cut_lineage(footer_counts(spark, root))


def days_needing_load(disk: DataFrame, bronze: DataFrame, window: int = 0) -> DataFrame:
    """C8 + W3 + U3: days on disk missing from bronze or held with a different
    row count, plus the most recent ``window`` days on disk. Days present only
    in bronze are never selected. Input frames: (business_date, n)."""
    d = disk.select("business_date", F.col("n").alias("disk_n"))
    b = bronze.select("business_date", F.col("n").alias("bronze_n"))
    stale = (
        d.join(b, "business_date", "left")
        .where(F.col("bronze_n").isNull() | (F.col("bronze_n") != F.col("disk_n")))
        .select("business_date")
    )
    if window > 0:
        stale = stale.union(recent_days(disk, window)).distinct()
    return stale


def recent_days(days: DataFrame, k: int) -> DataFrame:
    """The ``k`` most recent days (distributed top-k: TakeOrderedAndProject)."""
    return days.select("business_date").distinct().orderBy(F.col("business_date").desc()).limit(k)


def missing_days(candidates: DataFrame, present: DataFrame) -> DataFrame:
    """Candidate days with no landed partition (anti join)."""
    return candidates.select("business_date").join(present.select("business_date"), "business_date", "left_anti")


def refresh_bounds(today: dt.date, days: int | None, through_today: bool = False) -> tuple[dt.date, dt.date]:
    """First and last day that a refresh on ``today`` covers. ``days`` whole
    days up to yesterday (or today); None is single-day mode, today alone."""
    if days is not None and days < 1:
        raise ValueError(f"a refresh covers at least one day, not {days}")
    newest = today if days is None or through_today else today - dt.timedelta(days=1)
    return newest - dt.timedelta(days=(days or 1) - 1), newest


def trailing_window(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Rows whose business_date lies in [start, end]. Literal bounds, so a
    partitioned landing scan prunes directories statically."""
    lo, hi = int(start.strftime("%Y%m%d")), int(end.strftime("%Y%m%d"))
    return df.where(F.col("business_date").between(F.lit(lo), F.lit(hi)))


def history_bounds(days: DataFrame, today_key, max_lookback_days: int | None = None) -> DataFrame:
    """Earliest and latest day with data, and counts; with
    ``max_lookback_days``, none further back than that before today. One aggregate; the reference's
    exponential probe exists only because its source is an HTTP API."""
    d = days.select(F.col("business_date").cast("bigint").alias("business_date"))
    bounded = d
    if max_lookback_days is not None:
        bounded = d.where(F.col("business_date") >= date_to_yyyymmdd(F.date_sub(yyyymmdd_to_date(today_key), max_lookback_days)))
    return bounded.agg(
        F.min("business_date").alias("first_day"),
        F.max("business_date").alias("last_day"),
        F.countDistinct("business_date").alias("days_with_data"),
    ).select(
        "first_day",
        "last_day",
        "days_with_data",
        (F.datediff(yyyymmdd_to_date("last_day"), yyyymmdd_to_date("first_day")) + 1).cast("bigint").alias("calendar_days"),
    )

