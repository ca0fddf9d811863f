"""P4 serve and P5 intraday, over the forecast tables written by P3."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salescast import schemas
from salescast.functions.dates import BUSINESS_TZ
from salescast.operators import marts, serve
from salescast.sources import sinks
from salescast.sources.readers import scan_raw_orders


def serve_views(spark: SparkSession, mart: DataFrame, keys: list[str] | None = None, table_prefix: str = "",
                publish_root: str | None = None) -> dict[str, DataFrame]:
    """C1-C3 over the latest forecast and back-test tables, and A12 publish,
    whose row counts are ``published``."""
    keys = keys or []
    f = spark.table(table_prefix + schemas.FORECAST_TABLE)
    b = spark.table(table_prefix + schemas.BACKTEST_TABLE)
    fva = serve.forecast_vs_actuals(mart, f, b, keys)
    metrics = spark.table(table_prefix + schemas.METRICS_TABLE)
    out = {"forecast_vs_actuals": fva, "model_metrics": metrics}
    if publish_root:
        counts = sinks.publish_serving(out, publish_root, {"forecast_vs_actuals": ["business_date", *keys], "model_metrics": ["run_ts", *keys, "model"]})
        out["published"] = spark.createDataFrame(list(counts.items()), "target string, n long")
    return out


def intraday(spark: SparkSession, landing_root: str, today: int, tz: str = BUSINESS_TZ, table_prefix: str = "") -> DataFrame:
    """P5: one row for ``today`` from the landing partition (static pruning on
    the literal day) against the latest forecast."""
    raw = scan_raw_orders(spark, landing_root)
    return marts.intraday_today(raw, spark.table(table_prefix + schemas.FORECAST_TABLE), today, tz)
