"""run_forecast -- back-test every model over every series, score, pick a
champion per series, refit it and write the four forecast tables.

Replaces the reference's driver-side pandas loop: the series never leave the
cluster, all (series, fold, model) work runs as one set of Spark jobs, and
the series frame is checkpointed once because every model reads it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast import schemas
from salescast.operators import backtest as bt
from salescast.operators import forecasters as fc
from salescast.operators import regression as rg
from salescast.operators import series as ser
from salescast.session import cut_lineage
from salescast.sources import sinks


def sql_models() -> dict:
    """The models that are DataFrame functions throughout."""
    return {bt.BASELINE: fc.seasonal_naive, "trend_weekday": fc.trend_weekday}


def default_models(ns: DataFrame, keys: list[str], horizon: int, yearly: bool = True) -> dict:
    """The baseline and both challengers; the holiday calendar spans the series and its horizon."""
    lo, hi = ns.select(F.min("ds")).scalar(), ns.select(F.date_add(F.max("ds"), horizon)).scalar()
    holidays = rg.holiday_calendar(ns.sparkSession, lo, hi)
    key_types = [(k, ns.schema[k].dataType) for k in keys]
    return sql_models() | {"seasonal_regression": rg.seasonal_regression_model(key_types, holidays, yearly)}


def run_forecast(spark: SparkSession, daily: DataFrame, keys: list[str], key_types: list[tuple[str, T.DataType]] | None = None,
                 horizon: int = 14, n_folds: int = 8, min_train: int = 60, models: dict | None = None,
                 run_ts: dt.datetime | None = None, write: bool = True, table_prefix: str = "", round_to: int | None = None) -> dict[str, DataFrame]:
    """``daily``: [*keys, business_date, net_sales]. step is pinned to the
    horizon so each date has one back-test prediction per model. ``round_to``
    rounds what is stored of forecasts and predictions; scores never are."""
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    ns = cut_lineage(ser.numbered_series(ser.to_series(daily, keys), keys))
    models = models or default_models(ns, keys, horizon)
    b = bt.run_backtest(ns, keys, models, horizon, n_folds, horizon, min_train)
    b = cut_lineage(b)
    metrics = bt.model_metrics(b, keys, horizon, n_folds, run_ts)
    winners = bt.with_unscored(ns, bt.champion(metrics, keys), keys)
    forecast = bt.champion_forecast(ns, keys, models, winners, horizon)
    stored = (lambda df: fc.round_forecast(df, round_to)) if round_to is not None else (lambda df: df)
    f_rows = bt.forecast_rows(stored(forecast), keys, run_ts)
    b_rows = bt.backtest_rows(stored(b), keys, run_ts)
    out = {"series": ns, "backtest": b, "metrics": metrics, "champion": winners, "champion_forecast": forecast, "forecast": f_rows, "backtest_rows": b_rows}
    if write:
        kt = key_types or [(k, ns.schema[k].dataType) for k in keys]
        p = table_prefix
        sinks.write_latest(f_rows, p + schemas.FORECAST_TABLE, schemas.with_keys(schemas.FORECAST, kt))
        sinks.append_history(metrics, p + schemas.METRICS_TABLE, schemas.with_keys(schemas.METRICS, kt))
        sinks.append_history(f_rows, p + schemas.HISTORY_TABLE, schemas.with_keys(schemas.FORECAST, kt))
        sinks.write_overwrite_once([b_rows], p + schemas.BACKTEST_TABLE, schemas.with_keys(schemas.BACKTEST, kt))
    return out

