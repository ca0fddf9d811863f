"""Series, models, back-test, metrics, champion."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from salescast.operators import backtest as bt
from salescast.operators import forecasters as fc
from salescast.operators import series as ser


def _series(spark, rows, keys=()):
    cols = [*keys, "ds", "y"]
    return spark.createDataFrame(rows, cols)


def test_densify_fills_gaps_with_zero(spark):
    s = _series(spark, [(dt.date(2026, 6, 16), 100.0), (dt.date(2026, 6, 17), 200.0), (dt.date(2026, 6, 19), 300.0)])
    got = [r.y for r in ser.densify_daily(s, []).orderBy("ds").collect()]
    assert got == [100.0, 200.0, 0.0, 300.0]


def test_densify_null_value_becomes_zero(spark):
    s = spark.createDataFrame([(dt.date(2026, 1, 1), None), (dt.date(2026, 1, 2), 5.0)], "ds date, y double")
    assert [r.y for r in ser.densify_daily(s, []).orderBy("ds").collect()] == [0.0, 5.0]


def _weekday_series(spark, n, start=dt.date(2026, 1, 5)):
    return _series(spark, [(start + dt.timedelta(days=i), float((start + dt.timedelta(days=i)).weekday())) for i in range(n)])


def test_seasonal_naive_repeats_last_week(spark):
    ns = ser.numbered_series(_weekday_series(spark, 21), [])
    out = fc.seasonal_naive(ns, ser.future_origins(ns, []), [], 14).orderBy("ds").collect()
    assert len(out) == 14
    assert all(r.yhat == float(r.ds.weekday()) for r in out)


def test_seasonal_naive_short_history_tiles(spark):
    s = _series(spark, [(dt.date(2026, 1, 1), 1.0), (dt.date(2026, 1, 2), 2.0), (dt.date(2026, 1, 3), 3.0)])
    ns = ser.numbered_series(s, [])
    got = [r.yhat for r in fc.seasonal_naive(ns, ser.future_origins(ns, []), [], 9).orderBy("ds").collect()]
    # np.resize([1,2,3], 7) = [1,2,3,1,2,3,1], tiled across 9 days
    assert got == [1.0, 2.0, 3.0, 1.0, 2.0, 3.0, 1.0, 1.0, 2.0]


def test_backtest_pure_weekly_series_zero_error(spark):
    ns = ser.numbered_series(_weekday_series(spark, 100), [])
    b = bt.run_backtest(ns, [], {bt.BASELINE: fc.seasonal_naive}, horizon=14, n_folds=3, step=14, min_train=30)
    rows = b.collect()
    assert len(rows) == 42
    assert all(r.y == r.yhat for r in rows)
    assert sorted({r.fold for r in rows}) == [0, 1, 2]


def test_backtest_skips_short_folds_keeps_numbers(spark):
    ns = ser.numbered_series(_weekday_series(spark, 100), [])
    o = ser.backtest_origins(ns, [], horizon=14, n_folds=8, step=14, min_train=60).collect()
    # cutoffs 86 - 14*(7-k) >= 60 -> k in {6, 7}
    assert sorted((r.fold, r.cutoff) for r in o) == [(6, 72), (7, 86)]


def test_metrics_hand_values(spark):
    from salescast.functions import metrics as M

    d = spark.createDataFrame([(10.0, 12.0), (20.0, 18.0), (30.0, 33.0)], "y double, yhat double")
    r = d.agg(M.mae().alias("mae"), M.rmse().alias("rmse")).first()
    assert math.isclose(r.mae, 7 / 3) and math.isclose(r.rmse, math.sqrt(17 / 3))
    d = spark.createDataFrame([(0.0, 50.0), (100.0, 110.0), (200.0, 180.0)], "y double, yhat double")
    r = d.agg(M.mape().alias("mape"), M.wape().alias("wape")).first()
    assert math.isclose(r.mape, 10.0) and math.isclose(r.wape, 80 / 300 * 100)
    z = spark.createDataFrame([(0.0, 1.0)], "y double, yhat double").agg(M.mape().alias("m"), M.wape().alias("w")).first()
    assert z.m is None and z.w is None


def test_missing_prediction_fails_scoring(spark):
    d = spark.createDataFrame([("baseline", 1.0, None)], "model string, y double, yhat double")
    with pytest.raises(Exception):
        bt.model_metrics(d, [], 14, 8, dt.datetime(2026, 1, 1)).collect()


def _metrics(spark, rows):
    return spark.createDataFrame(rows, "k string, model string, wape double")


def test_champion_lowest_wape_baseline_wins_ties_and_nan(spark):
    m = _metrics(spark, [
        ("a", "baseline", 16.9), ("a", "trend_weekday", 13.4),
        ("b", "baseline", 10.0), ("b", "trend_weekday", 10.0),
        ("c", "baseline", None), ("c", "trend_weekday", 5.0),
        ("d", "baseline", 10.0), ("d", "trend_weekday", None),
    ])
    got = {r.k: r.model for r in bt.champion(m, ["k"]).collect()}
    assert got == {"a": "trend_weekday", "b": "baseline", "c": "baseline", "d": "baseline"}


def test_clip_nonnegative(spark):
    d = spark.createDataFrame([(100.0, -5.0), (-50.0, -200.0), (300.0, 150.0)], "yhat double, yhat_lower double")
    assert [tuple(r) for r in fc.clip_nonnegative(d).collect()] == [(100.0, 0.0), (0.0, 0.0), (300.0, 150.0)]


def test_forecast_rows_null_bands_and_keys(spark):
    f = spark.createDataFrame([(dt.date(2026, 6, 27), 1.0), (dt.date(2026, 6, 28), 2.0)], "ds date, yhat double")
    rows = bt.forecast_rows(f.withColumn("model", F.lit("baseline")), [], dt.datetime(2026, 6, 27)).collect()
    assert [r.forecast_date for r in rows] == [20260627, 20260628]
    assert all(r.yhat_lower is None and r.yhat_upper is None for r in rows)


def test_backtest_rows_drop_y_fold_int(spark):
    b = spark.createDataFrame([("baseline", 3, dt.date(2026, 1, 2), 1.0, 2.0)], "model string, fold long, ds date, y double, yhat double")
    r = bt.backtest_rows(b, [], dt.datetime(2026, 1, 1))
    assert "y" not in r.columns and dict(r.dtypes)["fold"] == "int"


def test_history_plus_forecast_flags(spark):
    ns = spark.createDataFrame([(dt.date(2026, 1, d), float(d)) for d in (1, 2, 3)], "ds date, y double")
    f = spark.createDataFrame([(dt.date(2026, 1, d), 9.0, None, None, "baseline") for d in (4, 5)],
                              "ds date, yhat double, yhat_lower double, yhat_upper double, model string")
    out = bt.history_plus_forecast(ns, f, []).orderBy("date").collect()
    assert [r.is_forecast for r in out] == [False, False, False, True, True]
    assert {r.model for r in out} == {"baseline"}


def test_pandas_plugin_equals_dataframe_model(spark):
    from pyspark.sql import types as T

    s = spark.createDataFrame([("k1", dt.date(2026, 1, 1) + dt.timedelta(days=i), float((i * 7) % 11)) for i in range(90)]
                              + [("k2", dt.date(2026, 2, 1) + dt.timedelta(days=i), float(i % 5)) for i in range(80)],
                              "k string, ds date, y double")
    ns = ser.numbered_series(s, ["k"])
    plug = bt.pandas_model(bt.repeat_last_season, [("k", T.StringType())])
    a = bt.run_backtest(ns, ["k"], {bt.BASELINE: fc.seasonal_naive}, 14, 3, 14, 30).select("k", "fold", "ds", "yhat")
    b = bt.run_backtest(ns, ["k"], {bt.BASELINE: plug}, 14, 3, 14, 30).select("k", "fold", "ds", "yhat")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_trend_weekday_recovers_exact_pattern(spark):
    """A level series with a weekly pattern: trend x weekday index tracks the
    pattern (a periodic series fits a near-zero slope, so within a few %)."""
    w = [1.0, 1.5, 1.2, 0.8, 0.9, 1.1, 0.5]
    start = dt.date(2026, 1, 5)
    rows = [(start + dt.timedelta(days=i), 100.0 * w[(start + dt.timedelta(days=i)).weekday()]) for i in range(140)]
    ns = ser.numbered_series(_series(spark, rows), [])
    out = fc.trend_weekday(ns, ser.future_origins(ns, []), [], 14).collect()
    for r in out:
        assert math.isclose(r.yhat, 100.0 * w[r.ds.weekday()], rel_tol=0.05)
        assert r.yhat_lower <= r.yhat <= r.yhat_upper


def test_seasonal_regression_recovers_trend_times_weekday(spark):
    """y = (100 + t) * w(weekday): the multiplicative regression tracks it and
    emits one row per origin x horizon day, with ordered, non-negative bands."""
    from pyspark.sql import types as T

    from salescast.operators import regression as rg

    w = [1.0, 1.5, 1.2, 0.8, 0.9, 1.1, 0.5]
    start = dt.date(2026, 1, 5)
    rows = [("k", start + dt.timedelta(days=i), (100.0 + i) * w[(start + dt.timedelta(days=i)).weekday()]) for i in range(200)]
    s = spark.createDataFrame(rows, "k string, ds date, y double")
    ns = ser.numbered_series(s, ["k"])
    hol = rg.holiday_calendar(spark, "2026-01-01", "2026-12-31").where(F.lit(False))  # no holidays in play
    model = rg.seasonal_regression_model([("k", T.StringType())], hol, yearly=False)  # under a year of history
    origins = ser.backtest_origins(ns, ["k"], 14, 3, 14, 60).unionByName(ser.future_origins(ns, ["k"]))
    out = model(ns, origins, ["k"], 14).collect()
    assert len(out) == 4 * 14
    truth = {start + dt.timedelta(days=i): (100.0 + i) * w[(start + dt.timedelta(days=i)).weekday()] for i in range(214)}
    for r in out:
        assert 0.0 <= r.yhat_lower <= r.yhat <= r.yhat_upper
        assert math.isclose(r.yhat, truth[r.ds], rel_tol=0.02)


def test_seasonal_regression_gives_each_holiday_its_own_effect(spark):
    """Three flat years in which Christmas is half above and Independence Day half below; the key is NULL."""
    from pyspark.sql import types as T

    from salescast.operators import regression as rg

    start = dt.date(2022, 1, 1)
    level = lambda d: 200.0 * {(12, 25): 1.5, (7, 4): 0.5}.get((d.month, d.day), 1.0)
    days = [start + dt.timedelta(days=i) for i in range((dt.date(2024, 12, 20) - start).days)]
    s = spark.createDataFrame([(None, d, level(d)) for d in days], "k string, ds date, y double")
    ns = ser.numbered_series(s, ["k"])
    model = rg.seasonal_regression_model([("k", T.StringType())], rg.holiday_calendar(spark, "2022-01-01", "2025-01-31"))
    out = model(ns, ser.future_origins(ns, ["k"]), ["k"], 14).collect()
    assert len(out) == 14 and {r.k for r in out} == {None}
    for r in out:
        assert math.isclose(r.yhat, level(r.ds), rel_tol=0.06)


def test_null_keys_gaps_and_short_series(spark):
    from salescast.operators import quality as ql

    day = dt.date(2026, 1, 1)
    rows = [("a", day + dt.timedelta(days=i), float(100 + i % 7)) for i in range(140) if i % 11] + [(None, day + dt.timedelta(days=i), 5.0 + i) for i in (0, 1, 3)]
    rows.append(("a", day + dt.timedelta(days=11), None))
    ns = ser.numbered_series(spark.createDataFrame(rows, "k string, ds date, y double"), ["k"])
    assert [r.y for r in ns.where("k is null").orderBy("ds").collect()] == [5.0, 6.0, 0.0, 8.0]
    models = {bt.BASELINE: fc.seasonal_naive}
    winners = bt.champion(bt.model_metrics(bt.run_backtest(ns, ["k"], models, 14, 2), ["k"], 14, 2, dt.datetime(2026, 1, 1)), ["k"])
    every = bt.with_unscored(ns, winners, ["k"])
    assert {(r.k, r.model, r.scored) for r in every.collect()} == {("a", "baseline", True), (None, "baseline", False)}
    assert bt.champion_forecast(ns, ["k"], models, every, 14).groupBy("k").count().where("count = 14").count() == 2
    short = ser.numbered_series(spark.createDataFrame([(r[1], r[2]) for r in rows[-4:-1]], "ds date, y double"), [])
    with pytest.raises(ValueError):
        bt.run_backtest(short, [], models)
    assert ql.no_fanout(spark.range(5), spark.range(3), 2, []).first().ok


def test_near_tie_is_decided_unrounded(spark):
    m = spark.createDataFrame([("k", "baseline", 10.00004), ("k", "trend_weekday", 10.00001)], "k string, model string, wape double")
    assert bt.champion(m, ["k"]).first().model == "trend_weekday"


def _plain_fit(rows, cutoff, horizon):
    """One origin by the textbook: polyfit, weighted rows, normal equations."""
    import numpy as np

    from salescast.operators import regression as rg

    rn, y = rows["rn"].to_numpy(float), rows["y"].to_numpy(float)
    known, ahead = rn <= cutoff, (rn > cutoff) & (rn <= cutoff + horizon)
    names = [[n for b, n in enumerate(rg.HOLIDAYS) if h >> b & 1] for h in rows["hol"]]
    x = np.column_stack([np.ones(len(rn))] + [(rows["wd"] == w).to_numpy(float) for w in range(1, 7)]
                        + [rows[f"{f}{k}"].to_numpy() for k in (1, 2, 3) for f in ("sin", "cos")]
                        + [np.array([float(n in own) for own in names]) for n in rg.HOLIDAYS])
    b, a = np.polyfit(rn[known], y[known], 1)
    w = x * (a + b * rn)[:, None]
    gram = w[known].T @ w[known]
    beta = np.linalg.solve(gram + (rg.RIDGE * np.trace(gram) / len(gram) + 1e-12) * np.eye(len(gram)), w[known].T @ y[known])
    sigma = np.sqrt(np.mean((y[known] - w[known] @ beta) ** 2))
    return (w @ beta)[ahead], sigma


def test_fold_sums_give_the_plain_fit(spark):
    import numpy as np

    from salescast.operators import regression as rg

    rng = np.random.default_rng(5)
    start = dt.date(2023, 1, 1)
    rows = [("k", start + dt.timedelta(days=i), float(500 + i / 2 + 90 * math.sin(i / 58) + 40 * (i % 7) + rng.normal() * 30)) for i in range(900)]
    ns = ser.numbered_series(spark.createDataFrame(rows, "k string, ds date, y double"), ["k"])
    feats = rg.feature_frame(ns, ["k"], 14, rg.holiday_calendar(spark, "2023-01-01", "2025-12-31")).toPandas().sort_values("rn", ignore_index=True)
    folds = ser.backtest_origins(ns, ["k"], 14, 8, 14, 60).unionByName(ser.future_origins(ns, ["k"])).toPandas()
    got = rg.predict_folds(feats, folds, 14)
    feats["y"] = feats["y"].fillna(0.0)
    for _, o in folds.iterrows():
        yhat, sigma = _plain_fit(feats, o["cutoff"], 14)
        mine = got[got["fold"] == o["fold"]].sort_values("ds")
        assert len(mine) == 14
        assert np.allclose(mine["yhat"], yhat, rtol=1e-6) and np.allclose(mine["yhat_upper"] - mine["yhat"], fc.Z80 * sigma, rtol=1e-6)


def test_run_forecast_with_null_keys_and_all_models(spark, tmp_path):
    """A series without a key is forecast, scored, served and seen today like any other; the regression competes."""
    from salescast.operators import marts, quality as ql, serve
    from salescast.plans.forecast import run_forecast

    start = dt.date(2024, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(200)]
    num = lambda d: int(d.strftime("%Y%m%d"))
    daily = spark.createDataFrame([(k, num(d), 100.0 + 10 * d.weekday() + i / 10) for k in ("a", None) for i, d in enumerate(days)], "k string, business_date long, net_sales double")
    ts = dt.datetime(2024, 8, 1)
    out = run_forecast(spark, daily, ["k"], run_ts=ts, write=False)
    metrics = out["metrics"].collect()
    assert {(r.k, r.model) for r in metrics} == {(k, m) for k in ("a", None) for m in ("baseline", "trend_weekday", "seasonal_regression")}
    assert len({(r.model, round(r.wape, 9)) for r in metrics}) == 3  # both series are the same
    best = min(metrics, key=lambda r: r.wape)
    winners = {(r.k, r.model) for r in out["champion"].collect()}
    assert winners == {("a", best.model), (None, best.model)}
    forecast = out["forecast"]
    assert sorted((str(r.k), r["count"]) for r in forecast.groupBy("k").count().collect()) == [("None", 14), ("a", 14)]
    assert out["backtest_rows"].where("yhat is null").count() == 0
    fva = serve.forecast_vs_actuals(daily, forecast, out["backtest_rows"], ["k"])
    per = {r.k: (r.n, r.scored) for r in fva.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count("yhat").alias("scored")).collect()}
    assert per["a"] == per[None] == (214, 126)
    assert [r.ok for r in ql.no_fanout(fva, daily, 14, ["k"]).collect()] == [True, True]
    raw = spark.createDataFrame([(k, num(days[-1] + dt.timedelta(days=1)), "2024-07-19T17:00:00.000+0000", 2, 50.0, 0.0, False, False) for k in ("a", None)],
                                "k string, business_date long, opened_date string, num_guests int, net_amount double, deferred_amount double, voided boolean, deleted boolean")
    today = marts.intraday_today(raw, forecast, num(days[-1] + dt.timedelta(days=1)), keys=["k"], anchor_keys=daily).collect()
    assert {(r.k, r.order_count, r.forecast_total is not None) for r in today} == {("a", 1, True), (None, 1, True)}
