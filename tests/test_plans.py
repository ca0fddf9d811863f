"""P1-P5 end to end on sf0.001: land, load, build marts, forecast, serve."""

import datetime as dt

from pyspark.sql import functions as F

from salescast.plans.forecast import run_forecast
from salescast.plans.load import run_load
from salescast.plans.marts import build_marts
from salescast.plans.serve import intraday, serve_views
from salescast.schemas import LANDING_ORDERS
from salescast.sources import bridge, sinks


def test_end_to_end_single_series(spark, tmp_path):
    from tests_support import SF001

    root = str(tmp_path / "raw")
    land = bridge.landing_orders(spark, SF001)
    sinks.write_partitions(land, root, LANDING_ORDERS)
    assert run_load(spark, root, "bronze_e2e", location=str(tmp_path / "bronze")) == land.count()
    m = build_marts(spark, "bronze_e2e", "fct_e2e")
    assert m["not_null"].where("failures > 0").count() == 0
    assert m["unique"].where("failures > 0").count() == 0
    run_ts = dt.datetime(2001, 8, 2, 6)
    out = run_forecast(spark, m["fct_daily_sales"], [], horizon=14, n_folds=8, run_ts=run_ts, table_prefix="e2e_")
    metrics = spark.table("e2e_model_metrics").collect()
    assert {r.model for r in metrics} == {"baseline", "trend_weekday", "seasonal_regression"}
    assert spark.table("e2e_forecast_daily_sales").count() == 14
    assert spark.table("e2e_backtest_predictions").count() == 3 * 8 * 14
    views = serve_views(spark, m["fct_daily_sales"], [], "e2e_", publish_root=str(tmp_path / "pub"))
    fva = views["forecast_vs_actuals"]
    assert fva.count() == m["fct_daily_sales"].count() + 14  # L6: no fan-out
    assert fva.groupBy("business_date").count().where("count > 1").count() == 0
    first_fc = out["forecast"].select(F.min("forecast_date")).first()[0]
    (r,) = intraday(spark, root, int(first_fc), table_prefix="e2e_").collect()
    assert r.forecast_total is not None and r.business_date == first_fc
