"""Staging view, daily sales mart, intraday and hourly views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions.dates import BUSINESS_TZ, parse_iso_utc, utc_to_local
from salescast.functions.money import money_sum, rounded
from salescast.operators.series import join_on
from salescast.schemas import BRONZE_ORDERS


def cast_projection(df: DataFrame, schema=BRONZE_ORDERS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Select every table column BY NAME and cast it to the table type, so
    column-order or width drift in a source cannot shift values. ``keep``
    columns (series keys) pass through in front."""
    return df.select(*keep, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def live_orders(df: DataFrame) -> DataFrame:
    """``not voided and not deleted`` (a NULL flag drops the row, as in SQL)."""
    return df.where(~F.col("voided") & ~F.col("deleted"))


def stg_orders(bronze: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """rename/cast to the 12-column staging shape over live orders."""
    keys = keys or []
    return live_orders(bronze).select(
        *keys,
        F.col("business_date").cast("int").alias("business_date"),
        "order_guid",
        parse_iso_utc("opened_date").alias("opened_at"),
        F.col("source").alias("order_source"),
        "dining_option_guid",
        "num_guests",
        "num_checks",
        "net_amount",
        "total_amount",
        "tax_amount",
        "tip_amount",
        "deferred_amount",
    )


def _sales_aggs(net_name: str = "net_sales") -> list:
    return [
        F.count(F.lit(1)).alias("order_count"),
        F.sum("num_guests").cast("bigint").alias("guest_count"),
        rounded(money_sum("net_amount") - money_sum("deferred_amount"), 2).alias(net_name),
    ]


def fct_daily_sales(stg: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per (keys, business_date). A day whose deferred amounts are
    all NULL gets a NULL net_sales (difference of sums), as in the mart."""
    keys = keys or []
    return stg.groupBy(*keys, "business_date").agg(
        *_sales_aggs(),
        rounded(money_sum("deferred_amount"), 2).alias("deferred_revenue"),
        rounded(money_sum("total_amount"), 2).alias("total_sales"),
        rounded(money_sum("tax_amount"), 2).alias("tax"),
        rounded(money_sum("tip_amount"), 2).alias("tips"),
    )


def today_orders(raw: DataFrame, today, tz: str = BUSINESS_TZ, keys: list[str] | None = None) -> DataFrame:
    """Today-so-far aggregate over one landing day. With an int
    ``today`` the day filter is a literal, so a partitioned landing scan
    prunes statically; a Column (scalar subquery) is also accepted."""
    keys = keys or []
    day = F.lit(today) if isinstance(today, int) else today
    return (
        live_orders(raw.where(F.col("business_date") == day))
        .groupBy(*keys, F.col("business_date").cast("bigint").alias("business_date"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("num_guests").cast("bigint").alias("guest_count"),
            rounded(money_sum("net_amount") - money_sum("deferred_amount"), 2).alias("net_sales_so_far"),
            F.max(utc_to_local(parse_iso_utc("opened_date"), tz)).alias("last_order_opened_at"),
        )
    )


def intraday_today(raw: DataFrame, forecast: DataFrame, today, tz: str = BUSINESS_TZ, keys: list[str] | None = None,
                   anchor_keys: DataFrame | None = None) -> DataFrame:
    """C4: exactly one row for ``today`` (per key of ``anchor_keys`` when
    keyed) -- an anchor left-joined to today's aggregate and to the forecast
    row for the day. Zeros/NULLs, never an empty result."""
    keys = keys or []
    day = F.lit(today) if isinstance(today, int) else today
    if keys:
        anchor = anchor_keys.select(*keys).distinct().withColumn("business_date", day.cast("bigint"))
    else:
        anchor = raw.sparkSession.range(1).select(day.cast("bigint").alias("business_date"))
    on = [*keys, "business_date"]
    o = today_orders(raw, today, tz, keys)
    f = forecast.where(F.col("forecast_date") == day).select(
        *keys, F.col("forecast_date").alias("business_date"), "yhat", "yhat_lower", "yhat_upper"
    )
    so_far = F.coalesce(F.col("net_sales_so_far"), F.lit(0.0))
    return (
        join_on(join_on(anchor, o, on, "left"), f, on, "left")
        .select(
            *keys,
            "business_date",
            F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count"),
            F.coalesce("guest_count", F.lit(0)).cast("bigint").alias("guest_count"),
            so_far.alias("net_sales_so_far"),
            "last_order_opened_at",
            F.col("yhat").alias("forecast_total"),
            "yhat_lower",
            "yhat_upper",
            F.when(F.col("yhat") > 0, F.round(so_far / F.col("yhat") * 100, 1)).alias("pct_of_forecast"),
        )
    )


def hourly_net_sales(stg: DataFrame, business_date: int | None = None, tz: str = BUSINESS_TZ) -> DataFrame:
    """Net sales by local hour (optionally of one day) with the cumulative
    line the dashboard design asked for. The running sum is a window over at
    most 24 rows per day."""
    from pyspark.sql import Window

    src = stg if business_date is None else stg.where(F.col("business_date") == F.lit(business_date))
    by_hour = (
        src.withColumn("hr", F.hour(utc_to_local("opened_at", tz)))
        .groupBy("business_date", "hr")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            (money_sum("net_amount") - money_sum("deferred_amount")).alias("_net"),
        )
    )
    w = Window.partitionBy("business_date").orderBy("hr").rowsBetween(Window.unboundedPreceding, 0)
    return by_hour.select(
        "business_date",
        "hr",
        "order_count",
        rounded(F.col("_net"), 2).alias("net_sales"),
        rounded(F.sum("_net").over(w), 2).alias("cumulative_net_sales"),
    )


def reconcile(mart: DataFrame, summary: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Days whose mart net sales differ from an external summary by more
    than ``tolerance`` (violating rows; empty means reconciled)."""
    m = mart.select(F.col("business_date").cast("bigint").alias("business_date"), F.col("net_sales").alias("mart_net_sales"))
    s = summary.select(F.col("business_date").cast("bigint").alias("business_date"), F.col("net_sales").alias("source_net_sales"))
    return (
        m.join(s, "business_date")
        .withColumn("diff", F.round(F.col("mart_net_sales") - F.col("source_net_sales"), 2))
        .where(F.abs(F.col("mart_net_sales") - F.col("source_net_sales")) > tolerance)
    )
