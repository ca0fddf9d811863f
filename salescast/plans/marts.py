"""Staging + daily mart + the declared data tests, from a bronze table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.operators import marts
from salescast.operators import quality as dq
from salescast.sources import sinks


def build_marts(spark: SparkSession, bronze_table: str = "bronze_orders", mart_table: str | None = None,
                summary: DataFrame | None = None) -> dict[str, DataFrame]:
    """B4 -> D1 (-> published as ``mart_table`` if given) and L1-L4 results."""
    stg = marts.stg_orders(spark.table(bronze_table))
    fct = marts.fct_daily_sales(stg)
    if mart_table:
        sinks.publish(fct, mart_table, fct.schema)
        fct = spark.table(mart_table)
    out = {
        "stg_orders": stg,
        "fct_daily_sales": fct,
        "not_null": dq.not_null_summary([("stg_orders", stg, ["order_guid", "business_date"]),
                                         ("fct_daily_sales", fct, ["business_date", "order_count"])]),
        "unique": dq.unique_summary([("stg_orders", stg, ["order_guid"]), ("fct_daily_sales", fct, ["business_date"])]),
        "non_negative": dq.non_negative(fct),
    }
    if summary is not None:
        out["reconcile"] = marts.reconcile(fct, summary)
    return out


def check_summary(built: dict[str, DataFrame]) -> DataFrame:
    """One row per declared data test: [model, column, test, failures]."""
    named = [built[t].select("model", "column", F.lit(t).alias("test"), "failures") for t in ("not_null", "unique")]
    for t in ("non_negative", "reconcile"):
        if t in built:
            named.append(built[t].agg(F.count(F.lit(1)).alias("failures")).select(F.lit("fct_daily_sales").alias("model"), F.lit("net_sales").alias("column"), F.lit(t).alias("test"), "failures"))
    return reduce(DataFrame.unionByName, named)
