"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one reads the driver tables under ``sf_dir`` (whole tables, no row caps)
and runs one operator family of the library end to end. ``salescast.oracle``
holds the matching DuckDB SQL for every SQL-expressible key.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.functions.dates import local_business_day, parse_iso_utc, utc_to_local, yyyymmdd_to_date, date_to_yyyymmdd
from salescast.operators import flatten as fl
from salescast.operators import marts
from salescast.session import cut_lineage
from salescast.sources import bridge

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = fn
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# ---------------------------------------------------------------- shared inputs
def bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze-typed order rows (landing rows cast by name to the bronze types)."""
    return marts.cast_projection(bridge.landing_orders(spark, sf))


def stg(spark: SparkSession, sf: str) -> DataFrame:
    return marts.stg_orders(bronze(spark, sf))


def fct(spark: SparkSession, sf: str) -> DataFrame:
    return marts.fct_daily_sales(stg(spark, sf))


# ------------------------------------------------------------------ M1 flatten
@register("flatten_orders")
def q_flatten_orders(spark, sf):
    return fl.flatten_orders(bridge.nested_orders(spark, sf))


@register("live_checks")
def q_live_checks(spark, sf):
    docs = bridge.nested_orders(spark, sf)
    lc = fl.live_checks(F.col("checks"))
    return docs.select(
        F.col("guid").alias("order_guid"),
        F.coalesce(F.size("checks"), F.lit(0)).cast("bigint").alias("num_checks"),
        F.coalesce(F.size(lc), F.lit(0)).cast("bigint").alias("num_live_checks"),
    )


@register("order_tips")
def q_order_tips(spark, sf):
    docs = bridge.nested_orders(spark, sf)
    lc = fl.live_checks(F.col("checks"))
    return docs.select(F.col("guid").alias("order_guid"), F.round(fl.tips(lc), 4).cast("double").alias("tip_amount"))


@register("order_deferred")
def q_order_deferred(spark, sf):
    docs = bridge.nested_orders(spark, sf)
    lc = fl.live_checks(F.col("checks"))
    return docs.select(F.col("guid").alias("order_guid"), F.round(fl.deferred(lc), 4).cast("double").alias("deferred_amount"))


@register("pii_allowlist")
def q_pii_allowlist(spark, sf):
    return fl.pii_allowlist(bridge.nested_orders(spark, sf))


@register("stg_orders")
def q_stg_orders(spark, sf):
    return stg(spark, sf)


@register("live_orders")
def q_live_orders(spark, sf):
    return marts.live_orders(bronze(spark, sf))


@register("fct_daily_sales")
def q_fct_daily_sales(spark, sf):
    return fct(spark, sf)


@register("date_keys")
def q_date_keys(spark, sf):
    d = fct(spark, sf).select(F.col("business_date").cast("bigint").alias("business_date"))
    return d.select(
        "business_date",
        yyyymmdd_to_date("business_date").alias("date_day"),
        date_to_yyyymmdd(yyyymmdd_to_date("business_date")).alias("round_trip"),
    )


@register("local_business_day")
def q_local_business_day(spark, sf):
    """Orders moved to hours around the clock, so that UTC and local day differ for a part of them."""
    around = F.make_interval(hours=(F.col("order_guid").cast("bigint") % 24 - 12).cast("int"))
    opened = parse_iso_utc("opened_date") + around
    return bridge.landing_orders(spark, sf).select(
        "order_guid",
        opened.alias("opened_at_utc"),
        utc_to_local(opened).alias("opened_at_local"),
        local_business_day(opened).alias("local_business_date"),
    )


# ------------------------------------------------------------------ M2 load
from salescast.operators import load as ld  # noqa: E402
from salescast.plans.load import ensure_bronze, run_load, run_refresh  # noqa: E402
from salescast.schemas import LANDING_ORDERS  # noqa: E402
from salescast.sources import readers, sinks  # noqa: E402

# The partially loaded bronze fixture used by the load queries --
# on days with business_date % 7 = 0 every 13th order is missing, and days with
# business_date % 11 = 0 were never loaded.
STALE_DAY_EVERY = 7
STALE_ORDER_EVERY = 13
UNLOADED_DAY_EVERY = 11
LOAD_WINDOW = 3
TRAILING_DAYS = 7


def stale_bronze(spark: SparkSession, sf: str) -> DataFrame:
    b = bronze(spark, sf)
    dropped = (F.col("business_date") % STALE_DAY_EVERY == 0) & (F.col("order_guid").cast("bigint") % STALE_ORDER_EVERY == 0)
    return b.where(~dropped & (F.col("business_date") % UNLOADED_DAY_EVERY != 0))


def landed(spark: SparkSession, sf: str) -> str:
    """A5: write landing rows partitioned by day into a fresh stage folder."""
    root = sinks.stage_dir(spark, "landing")
    sinks.write_partitions(bridge.landing_orders(spark, sf), root, LANDING_ORDERS)
    return root


def today_key(df: DataFrame):
    """'Today' derived from the data: the latest business day (scalar subquery)."""
    return df.select(F.max("business_date")).scalar()


@register("cast_projection")
def q_cast_projection(spark, sf):
    return bronze(spark, sf)


@register("day_counts")
def q_day_counts(spark, sf):
    return ld.day_counts(bronze(spark, sf))


@register("landing_day_counts")
def q_landing_day_counts(spark, sf):
    return ld.landing_day_counts(spark, landed(spark, sf))


@register("scan_raw_orders")
def q_scan_raw_orders(spark, sf):
    return readers.scan_raw_orders(spark, landed(spark, sf))


@register("read_nested_orders")
def q_read_nested_orders(spark, sf):
    path = sinks.stage_dir(spark, "orders-json")
    sinks.write_documents(bridge.nested_orders(spark, sf), path)
    return fl.flatten_orders(readers.read_nested_orders(spark, path))


@register("days_needing_load")
def q_days_needing_load(spark, sf):
    disk = ld.day_counts(bridge.landing_orders(spark, sf))
    return ld.days_needing_load(disk, ld.day_counts(stale_bronze(spark, sf)), LOAD_WINDOW)


@register("missing_days")
def q_missing_days(spark, sf):
    return ld.missing_days(ld.day_counts(bridge.landing_orders(spark, sf)), ld.day_counts(stale_bronze(spark, sf)))


@register("recent_days")
def q_recent_days(spark, sf):
    return ld.recent_days(ld.day_counts(bridge.landing_orders(spark, sf)), LOAD_WINDOW)


def latest_day(landing: DataFrame) -> _dt.date:
    """'Today' as a literal: the latest landed day."""
    return _dt.datetime.strptime(str(landing.agg(F.max("business_date")).first()[0]), "%Y%m%d").date()


@register("trailing_window")
def q_trailing_window(spark, sf):
    """B7 over landed folders: the bounds are literals, which prune them."""
    landing = readers.scan_raw_orders(spark, landed(spark, sf))
    return ld.trailing_window(landing, *ld.refresh_bounds(latest_day(landing), TRAILING_DAYS))


@register("refresh_landing")
def q_refresh_landing(spark, sf):
    """A landing dataset whose every day is an older state (no tips yet) is refreshed
    for the trailing days through today; the days before keep the older state."""
    source = readers.scan_raw_orders(spark, landed(spark, sf))
    root = sinks.stage_dir(spark, "refreshed")
    sinks.write_partitions(source.withColumn("tip_amount", F.lit(0.0)), root, LANDING_ORDERS)
    run_refresh(source, root, latest_day(source), TRAILING_DAYS, through_today=True)
    return readers.scan_raw_orders(spark, root)


# Of the message column of order documents, every how manyth is cut
# off in the middle, has a text for a number, or has no text.
CUT_EVERY, TYPED_EVERY, MISSING_EVERY = 37, 41, 43


def messages(spark, sf):
    """Order documents as a column of JSON text beside the message's key, some of them bad."""
    docs = bridge.nested_orders(spark, sf).select(F.col("guid").alias("message_key"), F.to_json(F.struct("*")).alias("value"))
    n = F.col("message_key").cast("bigint")
    mistyped = F.regexp_replace("value", '"businessDate":[0-9]+', '"businessDate":"soon"')
    value = F.when(n % CUT_EVERY == 0, F.expr("left(value, length(value) div 2)")).when(n % TYPED_EVERY == 0, mistyped) \
        .when(n % MISSING_EVERY != 0, F.col("value"))
    return docs.withColumn("value", value)


@register("rescue_good")
def q_rescue_good(spark, sf):
    good, _ = readers.rescue_documents(messages(spark, sf))
    return fl.flatten_orders(good)


@register("rescue_quarantine")
def q_rescue_quarantine(spark, sf):
    _, quarantine = readers.rescue_documents(messages(spark, sf))
    return quarantine.select("message_key", "reason")


@register("load_daily_series")
def q_load_daily_series(spark, sf):
    """A4: the mart published in a second database of the session catalog, read back by its configured name."""
    warehouse = readers.Warehouse(schema=f"sales_{uuid.uuid4().hex[:12]}")
    spark.sql(f"CREATE DATABASE {warehouse.catalog}.{warehouse.schema}_marts LOCATION '{sinks.stage_dir(spark, 'marts')}'")
    mart = fct(spark, sf)
    sinks.publish(mart, warehouse.mart(), mart.schema)
    return readers.load_daily_series(spark, warehouse)


@register("history_bounds")
def q_history_bounds(spark, sf):
    days = ld.day_counts(bridge.landing_orders(spark, sf))
    return ld.history_bounds(days, today_key(days))


@register("replace_days")
def q_replace_days(spark, sf):
    root = landed(spark, sf)
    table = f"bronze_{uuid.uuid4().hex[:12]}"
    ensure_bronze(spark, table, sinks.stage_dir(spark, "bronze"))
    sinks.replace_days(stale_bronze(spark, sf), table)
    run_load(spark, root, table, window=LOAD_WINDOW)
    return spark.table(table)


# ------------------------------------------------------------------ M3 forecasting
from salescast.operators import backtest as bt  # noqa: E402
from salescast.operators import forecasters as fc  # noqa: E402
from salescast.operators import series as ser  # noqa: E402
from salescast.plans.forecast import run_forecast, sql_models  # noqa: E402

KEYS = list(bridge.SERIES_KEYS)
KEY_TYPES = [("c_mktsegment", "string"), ("n_regionkey", "int")]
HORIZON, N_FOLDS, MIN_TRAIN = 14, 8, 60
# The run stamp written on forecast tables by registered queries.
RUN_TS = _dt.datetime(2001, 8, 2, 6, 0, 0)


def keyed_stg(spark: SparkSession, sf: str) -> DataFrame:
    keyed = marts.cast_projection(bridge.keyed_landing_orders(spark, sf), keep=tuple(KEYS))
    return marts.stg_orders(keyed, KEYS)


def daily_by_key(spark: SparkSession, sf: str, before=None) -> DataFrame:
    """Daily mart per (segment, region) over every order;
    ``before`` (a day key or Column) keeps only earlier days."""
    s = keyed_stg(spark, sf)
    if before is not None:
        s = s.where(F.col("business_date") < before)
    # The keyed mart is (#keys x #days) rows and feeds every model, fold and
    # view below: checkpoint it once (shared checkpoint dir) instead of
    # re-deriving it from the fact tables in every branch of the plan.
    return cut_lineage(marts.fct_daily_sales(s, KEYS))


def numbered(spark: SparkSession, sf: str, before=None, daily: DataFrame | None = None) -> DataFrame:
    daily = daily_by_key(spark, sf, before) if daily is None else daily
    return cut_lineage(ser.numbered_series(ser.to_series(daily, KEYS), KEYS))


def _r(df: DataFrame) -> DataFrame:
    return fc.round_forecast(df)


@register("densify_daily")
def q_densify_daily(spark, sf):
    return ser.densify_daily(ser.to_series(daily_by_key(spark, sf), KEYS), KEYS)


@register("last_season")
def q_last_season(spark, sf):
    return ser.last_n(ser.densify_daily(ser.to_series(daily_by_key(spark, sf), KEYS), KEYS), KEYS, fc.SEASON)


@register("seasonal_naive")
def q_seasonal_naive(spark, sf):
    ns = numbered(spark, sf)
    return fc.seasonal_naive(ns, ser.future_origins(ns, KEYS), KEYS, HORIZON).select(*KEYS, "ds", "yhat")


def _backtest(spark, sf, models=None):
    ns = numbered(spark, sf)
    return bt.run_backtest(ns, KEYS, models or sql_models(), HORIZON, N_FOLDS, HORIZON, MIN_TRAIN)


@register("backtest_naive")
def q_backtest_naive(spark, sf):
    b = _backtest(spark, sf, {bt.BASELINE: fc.seasonal_naive})
    return b.select(*KEYS, "model", "fold", "ds", "y", "yhat")


def _metrics(spark, sf):
    return bt.model_metrics(_backtest(spark, sf), KEYS, HORIZON, N_FOLDS, RUN_TS)


def _rounded(metrics: DataFrame, *names: str) -> DataFrame:
    """Metrics as the oracle reports them; the library keeps full precision."""
    return metrics.withColumns({n: F.round(F.round(n, 8), 4) for n in names})  # 8 first: a tie at 4 must not hang on the order of a sum


def _one_metric(name):
    def q(spark, sf):
        b = _backtest(spark, sf, {bt.BASELINE: fc.seasonal_naive})
        return bt.model_metrics(b, KEYS, HORIZON, N_FOLDS, RUN_TS).select(*KEYS, "model", F.round(F.round(name, 8), 4).alias(name))

    return q


for _m in ("mae", "rmse", "mape", "wape"):
    register(f"metric_{_m}")(_one_metric(_m))


@register("model_metrics")
def q_model_metrics(spark, sf):
    return _rounded(_metrics(spark, sf), "mae", "rmse", "mape", "wape")


@register("champion")
def q_champion(spark, sf):
    return bt.champion(_metrics(spark, sf), KEYS)


def _champion_fc(spark, sf, daily: DataFrame | None = None, before=None):
    """P3 itself, with the models that SQL can express."""
    daily = daily_by_key(spark, sf, before) if daily is None else daily
    out = run_forecast(spark, daily, KEYS, horizon=HORIZON, n_folds=N_FOLDS, min_train=MIN_TRAIN, models=sql_models(), run_ts=RUN_TS, write=False)
    return out["series"], out["backtest"], out["champion"], _r(out["champion_forecast"])


@register("champion_forecast")
def q_champion_forecast(spark, sf):
    return _champion_fc(spark, sf)[3]


@register("forecast_rows")
def q_forecast_rows(spark, sf):
    return bt.forecast_rows(_champion_fc(spark, sf)[3], KEYS, RUN_TS)


@register("backtest_rows")
def q_backtest_rows(spark, sf):
    return bt.backtest_rows(_r(_backtest(spark, sf)), KEYS, RUN_TS)


@register("history_plus_forecast")
def q_history_plus_forecast(spark, sf):
    ns, _, _, f = _champion_fc(spark, sf)
    return bt.history_plus_forecast(ns, f, KEYS)


@register("plugin_forecaster")
def q_plugin_forecaster(spark, sf):
    from pyspark.sql import types as T

    kt = [("c_mktsegment", T.StringType()), ("n_regionkey", T.IntegerType())]
    plug = bt.pandas_model(bt.repeat_last_season, kt)
    b = _backtest(spark, sf, {bt.BASELINE: plug})
    return b.select(*KEYS, "model", "fold", "ds", "y", "yhat")


@register("trend_weekday_forecast")
def q_trend_weekday_forecast(spark, sf):
    ns = numbered(spark, sf)
    return _r(fc.trend_weekday(ns, ser.future_origins(ns, KEYS), KEYS, HORIZON))


@register("backtest_trend_weekday")
def q_backtest_trend_weekday(spark, sf):
    return _r(_backtest(spark, sf, {"trend_weekday": fc.trend_weekday}))


# ------------------------------------------------------------------ M4 serving + quality
from salescast.operators import quality as dq  # noqa: E402
from salescast import schemas as _sc  # noqa: E402
from salescast.operators import serve  # noqa: E402
from salescast.plans.marts import build_marts, check_summary  # noqa: E402
from salescast.plans.serve import intraday as plan_intraday, serve_views  # noqa: E402
from salescast.operators.series import future_origins, series_heads  # noqa: E402


def _serving(spark, sf):
    """forecast_daily_sales + backtest_predictions rows and the actuals."""
    daily = daily_by_key(spark, sf)
    ns, b, winners, f = _champion_fc(spark, sf, daily)
    fct_rows = bt.forecast_rows(f, KEYS, RUN_TS)
    bt_rows = bt.backtest_rows(_r(b), KEYS, RUN_TS)
    return daily, fct_rows, bt_rows


def fva(spark, sf):
    actuals, fct_rows, bt_rows = _serving(spark, sf)
    return serve.forecast_vs_actuals(actuals, fct_rows, bt_rows, KEYS)


@register("forecast_vs_actuals")
def q_forecast_vs_actuals(spark, sf):
    return fva(spark, sf)


@register("champion_backtest")
def q_champion_backtest(spark, sf):
    _, fct_rows, bt_rows = _serving(spark, sf)
    return serve.champion_backtest(bt_rows, fct_rows, KEYS)


def intraday(spark, sf):
    """P5 per key: today's so-far vs the nightly champion forecast made from
    history before today ('today' = the latest landed business day)."""
    raw = marts.cast_projection(bridge.keyed_landing_orders(spark, sf), keep=tuple(KEYS))
    today = today_key(raw)
    ns, _, _, fcst = _champion_fc(spark, sf, before=today)
    f = bt.forecast_rows(fcst, KEYS, RUN_TS)
    return marts.intraday_today(raw, f, today, keys=KEYS, anchor_keys=series_heads(ns, KEYS))


@register("intraday_today")
def q_intraday_today(spark, sf):
    return intraday(spark, sf)


@register("hourly_net_sales")
def q_hourly_net_sales(spark, sf):
    return marts.hourly_net_sales(stg(spark, sf))


def source_report(spark, sf):
    """The POS system's own daily net-sales report (fixture): it drops voided
    orders but does not know about deleted ones."""
    land = bridge.landing_orders(spark, sf).where(~F.col("voided"))
    from salescast.functions.money import money_sum, rounded

    return land.groupBy(F.col("business_date").cast("bigint").alias("business_date")).agg(
        rounded(money_sum("net_amount") - money_sum("deferred_amount"), 2).alias("net_sales"))


@register("reconcile")
def q_reconcile(spark, sf):
    path = sinks.stage_dir(spark, "seed")
    source_report(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    return marts.reconcile(fct(spark, sf), readers.read_seed(spark, path))


def served(spark, sf):
    """Forecast tables written, views over them, cells published."""
    prefix, root = f"run_{uuid.uuid4().hex[:12]}_", sinks.stage_dir(spark, "published")
    daily = daily_by_key(spark, sf)
    run = run_forecast(spark, daily, KEYS, horizon=HORIZON, n_folds=N_FOLDS, min_train=MIN_TRAIN, models=sql_models(), run_ts=RUN_TS, table_prefix=prefix, round_to=2)
    return run, serve_views(spark, daily, KEYS, prefix, root), root


@register("serve_views")
def q_serve_views(spark, sf):
    return served(spark, sf)[1]["forecast_vs_actuals"]


@register("publish_serving")
def q_publish_serving(spark, sf):
    """The published cells of forecast_vs_actuals, read back."""
    _, views, root = served(spark, sf)
    return sinks.read_cells(spark, f"{root}/forecast_vs_actuals", sinks.serving_cells(views["forecast_vs_actuals"]).schema)


@register("published_counts")
def q_published_counts(spark, sf):
    return served(spark, sf)[1]["published"]


@register("run_forecast")
def q_run_forecast(spark, sf):
    """P3 with its default models: the seasonal regression competes for every series."""
    prefix = f"run_{uuid.uuid4().hex[:12]}_"
    run_forecast(spark, daily_by_key(spark, sf), KEYS, horizon=HORIZON, n_folds=N_FOLDS, min_train=MIN_TRAIN, run_ts=RUN_TS, table_prefix=prefix, round_to=2)
    return spark.table(prefix + _sc.FORECAST_TABLE)


@register("intraday_plan")
def q_intraday_plan(spark, sf):
    """P5 over the landing folder and the nightly forecast table of the one series."""
    root, prefix = landed(spark, sf), f"run_{uuid.uuid4().hex[:12]}_"
    today = int(latest_day(readers.scan_raw_orders(spark, root)).strftime("%Y%m%d"))
    history = marts.fct_daily_sales(stg(spark, sf).where(F.col("business_date") < today))
    run_forecast(spark, history, [], horizon=HORIZON, n_folds=N_FOLDS, min_train=MIN_TRAIN, models=sql_models(), run_ts=RUN_TS, table_prefix=prefix, round_to=2)
    return plan_intraday(spark, root, today, table_prefix=prefix)


@register("build_marts")
def q_build_marts(spark, sf):
    """P2 from a bronze table: the mart is published, each declared test gives a row."""
    bronze_table, mart_table = _table("bronze"), _table("fct_daily_sales")
    ensure_bronze(spark, bronze_table)
    sinks.replace_days(bronze(spark, sf), bronze_table)
    return check_summary(build_marts(spark, bronze_table, mart_table, source_report(spark, sf)))


# Fixed value: the market segment whose series have no name in the query over NULL keys.
UNNAMED_SEGMENT = "BUILDING"


@register("null_key_serving")
def q_null_key_serving(spark, sf):
    """Forecast and serving with series whose key is NULL in a part."""
    unnamed = keyed_stg(spark, sf).withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit(UNNAMED_SEGMENT)))
    daily = cut_lineage(marts.fct_daily_sales(unnamed, KEYS))
    _, b, _, f = _champion_fc(spark, sf, daily)
    return serve.forecast_vs_actuals(daily, bt.forecast_rows(f, KEYS, RUN_TS), bt.backtest_rows(_r(b), KEYS, RUN_TS), KEYS)


@register("dq_not_null")
def q_dq_not_null(spark, sf):
    return dq.not_null_summary([
        ("stg_orders", stg(spark, sf), ["order_guid", "business_date"]),
        ("fct_daily_sales", fct(spark, sf), ["business_date", "order_count"]),
        # future days have no actuals, days before the first fold no forecast: both must be counted
        ("forecast_vs_actuals", fva(spark, sf), ["business_date", "net_sales_actual", "yhat"]),
        ("intraday_today", intraday(spark, sf), ["business_date"]),
    ])


@register("dq_unique")
def q_dq_unique(spark, sf):
    return dq.unique_summary([
        ("stg_orders", stg(spark, sf), ["order_guid"]),
        ("fct_daily_sales", fct(spark, sf), ["business_date"]),
        ("forecast_vs_actuals", fva(spark, sf), [*KEYS, "business_date"]),
        ("intraday_today", intraday(spark, sf), [*KEYS, "business_date"]),
        ("order_versions", order_versions(spark, sf), ["order_guid"]),  # edited orders occur twice
    ])


@register("dq_non_negative")
def q_dq_non_negative(spark, sf):
    return dq.non_negative(daily_by_key(spark, sf), keys=KEYS)


@register("dq_no_fanout")
def q_dq_no_fanout(spark, sf):
    daily, fct_rows, bt_rows = _serving(spark, sf)
    return dq.no_fanout(serve.forecast_vs_actuals(daily, fct_rows, bt_rows, KEYS), daily, HORIZON, KEYS)


# The audit's text landing -- source field, column, every how
# manyth order holds a text that does not convert, and that text.
BAD_TEXT = [
    ("businessDate", "business_date", 83, "unknown"),
    ("numberOfGuests", "num_guests", 97, "two"),
    ("voided", "voided", 89, "maybe"),
    ("deleted", "deleted", 101, "?"),
]


@register("drift_audit")
def q_drift_audit(spark, sf):
    from pyspark.sql import types as T

    raw = bridge.nested_orders(spark, sf).select(F.to_json(F.struct("*")).alias("doc"))
    # one parse of each document for all fields
    text = raw.select(F.json_tuple("doc", "guid", *[src for src, *_ in BAD_TEXT]).alias("_guid", *[dst for _, dst, *_ in BAD_TEXT]))
    guid = F.col("_guid").cast("bigint")
    text = text.select(*[F.when(guid % every == 0, F.lit(bad)).otherwise(F.col(dst)).alias(dst) for _, dst, every, bad in BAD_TEXT])
    schema = T.StructType([T.StructField("business_date", T.LongType()), T.StructField("num_guests", T.LongType()),
                           T.StructField("voided", T.BooleanType()), T.StructField("deleted", T.BooleanType())])
    return dq.drift_audit(text, schema)


@register("parity_by_day")
def q_parity_by_day(spark, sf):
    return dq.parity_by_day(dq.live_net_by_day(bridge.landing_orders(spark, sf)), dq.live_net_by_day(stale_bronze(spark, sf)))


# ------------------------------------------------------------------ M5 regression family
from salescast.operators import regression as rg  # noqa: E402


def _span(ns: DataFrame):
    """First series day and last forecast day, as scalar subqueries."""
    return ns.select(F.min("ds")).scalar(), ns.select(F.date_add(F.max("ds"), HORIZON)).scalar()


@register("fourier_features")
def q_fourier_features(spark, sf):
    d = ser.densify_daily(ser.to_series(daily_by_key(spark, sf), KEYS), KEYS).select("ds").distinct()
    feats = d.select("ds", *rg.fourier_terms("ds"))
    return feats.select("ds", *[F.round(c, 9).alias(c) for c in feats.columns if c != "ds"])


@register("holiday_calendar")
def q_holiday_calendar(spark, sf):
    ns = numbered(spark, sf)
    lo, hi = _span(ns)
    return rg.holiday_calendar(spark, lo, hi)


@register("trend_fit")
def q_trend_fit(spark, sf):
    f = rg.trend_fit(numbered(spark, sf), KEYS)
    return f.select(*KEYS, F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), "n")


@register("weekday_index")
def q_weekday_index(spark, sf):
    w = rg.weekday_index(numbered(spark, sf), KEYS)
    return w.select(*KEYS, "wd", F.round("index", 6).alias("index"))


def regression_model(spark, sf, ns):
    from pyspark.sql import types as T

    lo, hi = _span(ns)
    kt = [("c_mktsegment", T.StringType()), ("n_regionkey", T.IntegerType())]
    return rg.seasonal_regression_model(kt, rg.holiday_calendar(spark, lo, hi))


@register("seasonal_regression")
def q_seasonal_regression(spark, sf):
    """E5 back-test + live forecast per series (pytest-checked, no SQL oracle)."""
    ns = numbered(spark, sf)
    model = regression_model(spark, sf, ns)
    origins = ser.backtest_origins(ns, KEYS, HORIZON, N_FOLDS, HORIZON, MIN_TRAIN).unionByName(ser.future_origins(ns, KEYS))
    return _r(model(ns, origins, KEYS, HORIZON))


# ------------------------------------------------------------------ M6 edits, conform, profile, streaming
from salescast.operators import conform as cf  # noqa: E402
from salescast.operators.edits import latest_per_key  # noqa: E402
from salescast.operators.profile import json_profile  # noqa: E402

# Late-edit fixture -- orders with o_orderkey % 11 = 0 get a
# second version with the tip raised by 1.00 (a post-close tip adjustment);
# legacy-writer fixture -- days with business_date % 10 = 3 stored the two
# counts as DOUBLE (int + NULL promotion).
EDIT_EVERY = 11
TIP_ADJUSTMENT = 1.0
LEGACY_DAY_EVERY, LEGACY_DAY_REM = 10, 3
LEGACY_COLS = ("num_guests", "num_checks")


def versions(spark, sf):
    land = bridge.landing_orders(spark, sf)
    v1 = land.withColumn("version", F.lit(1).cast("bigint"))
    v2 = (land.where(F.col("order_guid").cast("bigint") % EDIT_EVERY == 0)
          .withColumn("tip_amount", F.round(F.col("tip_amount") + TIP_ADJUSTMENT, 4))
          .withColumn("version", F.lit(2).cast("bigint")))
    return v1, v2


def order_versions(spark, sf):
    v1, v2 = versions(spark, sf)
    return v1.unionByName(v2)


@register("late_edits")
def q_late_edits(spark, sf):
    return latest_per_key(order_versions(spark, sf), "order_guid", "version")


def _legacy(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) if c in LEGACY_COLS else F.col(c) for c in df.columns])


@register("safe_cast")
def q_safe_cast(spark, sf):
    return cf.conform_frame(_legacy(bridge.landing_orders(spark, sf)), LANDING_ORDERS)


def drifted_archive(spark, sf) -> str:
    """Landing root where legacy days were written by the drifting writer."""
    land = bridge.landing_orders(spark, sf)
    legacy_day = F.col("business_date") % LEGACY_DAY_EVERY == LEGACY_DAY_REM
    root = sinks.stage_dir(spark, "archive")
    sinks.write_partitions(land.where(~legacy_day), root, LANDING_ORDERS)
    _legacy(land.where(legacy_day)).hint("rebalance", "business_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("business_date").parquet(root)
    return root


@register("drift_report")
def q_drift_report(spark, sf):
    rep = cf.footer_report(spark, drifted_archive(spark, sf))
    return rep.where(F.col("drifted") != "").select("business_date", "drifted").distinct()


@register("conform_archive")
def q_conform_archive(spark, sf):
    root = drifted_archive(spark, sf)
    cf.conform_archive(spark, root)
    return readers.scan_raw_orders(spark, root)


@register("json_profile")
def q_json_profile(spark, sf):
    docs = bridge.nested_orders(spark, sf).select(F.to_json(F.struct("*")).alias("doc"))
    return json_profile(docs, "doc")


@register("stream_bronze")
def q_stream_bronze(spark, sf):
    """ST1+ST2: two landings of order documents (all orders, then the edited
    versions) streamed into a versioned bronze table; returns the table."""
    from salescast.streaming import bronze as sb

    docs_dir = sinks.stage_dir(spark, "docs")
    nested = bridge.nested_orders(spark, sf)
    sinks.write_documents(nested.withColumn("version", F.lit(1).cast("bigint")), f"{docs_dir}/v1")
    table = f"vbronze_{uuid.uuid4().hex[:12]}"
    sb.ensure_versioned_bronze(spark, table, sinks.stage_dir(spark, "vbronze"))
    ck = sinks.stage_dir(spark, "ckpt")
    sb.catch_up(spark, f"{docs_dir}/v1", table, ck)
    # second landing: only the edited orders, one tip raised on the first live check
    edits = nested.where(F.col("guid").cast("bigint") % EDIT_EVERY == 0)
    edits = edits.withColumn("checks", _edit_first_live_tip(F.col("checks")))
    sinks.write_documents(edits.withColumn("version", F.lit(2).cast("bigint")), f"{docs_dir}/v2")
    sb.catch_up(spark, f"{docs_dir}/v2", table, sinks.stage_dir(spark, "ckpt"))
    return spark.table(table)


def _edit_first_live_tip(checks):
    """Raise the tip of the first payment of the first live check by the adjustment."""
    from salescast.functions.arrays import is_live

    first_live = F.array_position(F.transform(checks, lambda c: is_live(c)), True)
    return F.transform(checks, lambda c, i: F.when(
        i + 1 == first_live,
        c.withField("payments", F.transform(c["payments"], lambda p, j: F.when(
            j == 0, p.withField("tipAmount", F.coalesce(p["tipAmount"], F.lit(0.0)) + TIP_ADJUSTMENT)).otherwise(p)))
    ).otherwise(c))


@register("stream_today")
def q_stream_today(spark, sf):
    """ST3: landing files replayed as a stream; per-day today-so-far state in
    update mode, upserted by day into a table; returns the table."""
    from salescast.streaming import bronze as sb

    root = landed(spark, sf)
    out = sinks.stage_dir(spark, "today")
    stream = spark.readStream.schema(LANDING_ORDERS).parquet(root)

    def upsert(batch, _epoch):
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("business_date").parquet(out)

    q = (sb.today_so_far(stream).writeStream.outputMode("update").foreachBatch(upsert)
         .option("checkpointLocation", sinks.stage_dir(spark, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    # partition discovery would type the day key INT; keep the pinned BIGINT
    return spark.read.parquet(out).select(F.col("business_date").cast("bigint").alias("business_date"), "order_count",
                                          "guest_count", "net_sales_so_far", "last_order_opened_at")


# ------------------------------------------------------------------ E6 and table writers
from pyspark.sql import types as _T  # noqa: E402

KEY_FIELDS = [("c_mktsegment", _T.StringType()), ("n_regionkey", _T.IntegerType())]


def _table(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@register("clip_nonnegative")
def q_clip_nonnegative(spark, sf):
    """E6 over the unclipped trend x weekday projection and its band."""
    ns = numbered(spark, sf)
    raw = fc.trend_weekday(ns, ser.future_origins(ns, KEYS), KEYS, HORIZON, clip=False)
    return _r(fc.clip_nonnegative(raw))


@register("write_latest")
def q_write_latest(spark, sf):
    """The champion forecast written latest-only (twice: still one run's rows)."""
    rows = bt.forecast_rows(_champion_fc(spark, sf)[3], KEYS, RUN_TS)
    t = _table("forecast_daily_sales")
    schema = _sc.with_keys(_sc.FORECAST, KEY_FIELDS)
    sinks.write_latest(rows, t, schema)
    sinks.write_latest(rows, t, schema)
    return spark.table(t)


@register("write_backtest")
def q_write_backtest(spark, sf):
    """Both models' back-test rows unioned and overwritten once."""
    b = _r(_backtest(spark, sf))
    frames = [bt.backtest_rows(b.where(F.col("model") == m), KEYS, RUN_TS) for m in sql_models()]
    t = _table("backtest_predictions")
    sinks.write_overwrite_once(frames, t, _sc.with_keys(_sc.BACKTEST, KEY_FIELDS))
    return spark.table(t)


@register("append_history")
def q_append_history(spark, sf):
    """Metrics of two runs, the second of them retried (each run is there once)."""
    m = cut_lineage(_metrics(spark, sf))
    t = _table("model_metrics")
    schema = _sc.with_keys(_sc.METRICS, KEY_FIELDS)
    second = m.withColumn("run_ts", F.lit(RUN_TS + _dt.timedelta(days=1)).cast("timestamp_ntz"))
    sinks.append_history(m, t, schema)
    sinks.append_history(second, t, schema)
    sinks.append_history(second, t, schema)
    return spark.table(t)


@register("export_csv")
def q_export_csv(spark, sf):
    """Header CSV export of the model metrics, read back with its schema."""
    m = _metrics(spark, sf)
    path = sinks.stage_dir(spark, "csv")
    sinks.export_csv(m, path, [*KEYS, "model"])
    schema = _sc.with_keys(_sc.METRICS, KEY_FIELDS)
    return spark.read.schema(schema).option("header", True).csv(path)
