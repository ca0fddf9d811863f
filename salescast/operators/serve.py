"""Serving views (C1-C3, L6): forecast versus actuals and the champion back-test."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions.dates import yyyymmdd_to_date
from salescast.operators.series import join_on, outer_on


def winner(forecast: DataFrame, keys: list[str]) -> DataFrame:
    """The forecast table is latest-only and holds one model per key, so
    max(model) per key names it."""
    g = forecast.groupBy(*keys) if keys else forecast.groupBy()
    return g.agg(F.max("model").alias("model"))


def champion_backtest(backtest: DataFrame, forecast: DataFrame, keys: list[str]) -> DataFrame:
    """Back-test rows of the winning model only (one row per date and key).
    The winner frame has one row per key, so the planner broadcasts it."""
    return join_on(backtest, winner(forecast, keys), [*keys, "model"], "inner").select(
        *keys, F.col("forecast_date").alias("business_date"), "yhat"
    )


def forecast_vs_actuals(actuals: DataFrame, forecast: DataFrame, backtest: DataFrame, keys: list[str]) -> DataFrame:
    """C1 + C2: actuals FULL OUTER forecast on (keys, business_date) with the
    key coalesced; the champion back-test is a LEFT enrichment and never adds
    rows. Live forecast beats back-test for ``yhat``; ``is_forecast`` only
    when there is no actual."""
    on = [*keys, "business_date"]
    a = actuals.select(*keys, F.col("business_date").cast("bigint").alias("business_date"), F.col("net_sales").alias("net_sales_actual"),
                       F.lit(True).alias("_a"))
    f = forecast.select(*keys, F.col("forecast_date").alias("business_date"), F.col("yhat").alias("_fy"), "yhat_lower", "yhat_upper",
                        "model", "run_ts", F.lit(True).alias("_f"))
    b = champion_backtest(backtest, forecast, keys).select(*keys, "business_date", F.col("yhat").alias("_by"))
    j = join_on(outer_on(a, f, on), b, on, "left")
    return j.select(
        *keys, "business_date", yyyymmdd_to_date("business_date").alias("date_day"), "net_sales_actual",
        F.coalesce("_fy", "_by").alias("yhat"), "yhat_lower", "yhat_upper", "model", "run_ts",
        (F.col("_a").isNull() & F.col("_f").isNotNull()).alias("is_forecast"),
        F.when(F.col("_fy").isNotNull(), F.lit("forecast")).when(F.col("_by").isNotNull(), F.lit("backtest")).alias("yhat_source"),
    )
