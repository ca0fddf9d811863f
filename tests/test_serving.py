"""C1-C6, D4, D14, L1-L9, A12, P2-P5."""

import datetime as dt

from pyspark.sql import functions as F

from salescast.operators import marts, quality as dq, serve
from salescast.schemas import BACKTEST, FORECAST
from salescast.sources import sinks

TS = dt.datetime(2026, 6, 27, 6, 0)


def _fva_inputs(spark):
    actuals = spark.createDataFrame([(20260625, 100.0), (20260626, 200.0)], "business_date int, net_sales double")
    fc = spark.createDataFrame([(20260627, 300.0, 250.0, 350.0, "trend_weekday", TS), (20260628, 310.0, 260.0, 360.0, "trend_weekday", TS)], FORECAST)
    bt = spark.createDataFrame([(20260625, 90.0, "trend_weekday", 7, TS), (20260625, 95.0, "baseline", 7, TS),
                                (20260624, 80.0, "trend_weekday", 7, TS)], BACKTEST)
    return actuals, fc, bt


def test_forecast_vs_actuals_semantics(spark):
    a, f, b = _fva_inputs(spark)
    rows = {r.business_date: r for r in serve.forecast_vs_actuals(a, f, b, []).collect()}
    assert sorted(rows) == [20260625, 20260626, 20260627, 20260628]  # back-test never adds a row (0624)
    assert rows[20260625].yhat == 90.0 and rows[20260625].yhat_source == "backtest"  # winner's back-test only
    assert rows[20260626].yhat is None and rows[20260626].yhat_source is None
    assert rows[20260627].is_forecast and rows[20260627].yhat_source == "forecast" and rows[20260627].yhat_lower == 250.0
    assert not rows[20260625].is_forecast
    assert rows[20260627].date_day == dt.date(2026, 6, 27)


def test_empty_forecast_no_backtest_rows(spark):
    a, f, b = _fva_inputs(spark)
    out = serve.forecast_vs_actuals(a, f.where(F.lit(False)), b, []).collect()
    assert len(out) == 2 and all(r.yhat is None for r in out)


def _raw(spark, rows):
    return spark.createDataFrame(rows, "business_date long, opened_date string, num_guests int, net_amount double, "
                                       "deferred_amount double, voided boolean, deleted boolean")


def test_intraday_exactly_one_row(spark):
    f = spark.createDataFrame([(20260630, 1000.0, 800.0, 1200.0, "baseline", TS)], FORECAST)
    raw = _raw(spark, [(20260630, "2026-06-30T17:00:00.000+0000", 2, 100.0, 10.0, False, False),
                       (20260630, "2026-06-30T18:30:00.000+0000", None, 50.0, 0.0, False, False),
                       (20260630, "2026-06-30T19:00:00.000+0000", 4, 500.0, 0.0, True, False),
                       (20260629, "2026-06-29T19:00:00.000+0000", 4, 500.0, 0.0, False, False)])
    (r,) = marts.intraday_today(raw, f, 20260630).collect()
    assert (r.order_count, r.guest_count, r.net_sales_so_far) == (2, 2, 140.0)
    assert r.last_order_opened_at == dt.datetime(2026, 6, 30, 13, 30)  # 18:30 UTC = 13:30 CDT
    assert r.forecast_total == 1000.0 and r.pct_of_forecast == 14.0
    (e,) = marts.intraday_today(raw, f.where(F.lit(False)), 20260701).collect()
    assert (e.order_count, e.guest_count, e.net_sales_so_far, e.pct_of_forecast) == (0, 0, 0.0, None)


def test_mart_net_sales_null_when_deferred_all_null(spark):
    stg = spark.createDataFrame([(20260101, 2, 10.0, None, 11.0, 1.0, 0.5)],
                                "business_date int, num_guests int, net_amount double, deferred_amount double, total_amount double, "
                                "tax_amount double, tip_amount double")
    (r,) = marts.fct_daily_sales(stg).collect()
    assert r.net_sales is None and r.order_count == 1 and r.guest_count == 2


def test_reconcile_tolerance(spark):
    m = spark.createDataFrame([(20260624, 2134.11), (20260625, 2819.70)], "business_date int, net_sales double")
    s = spark.createDataFrame([(20260624, 2134.11), (20260625, 2819.68)], "business_date long, net_sales double")
    out = marts.reconcile(m, s).collect()
    assert [r.business_date for r in out] == [20260625]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "business_date int, order_guid string")
    nn = {(r.model, r.column): r.failures for r in dq.not_null_summary([("m", df, ["business_date", "order_guid"])]).collect()}
    assert nn == {("m", "business_date"): 0, ("m", "order_guid"): 1}
    (u,) = dq.unique_summary([("m", df, ["business_date"])]).collect()
    assert u.failures == 1
    neg = spark.createDataFrame([(1, -1.0), (2, 3.0)], "business_date int, net_sales double")
    assert [r.business_date for r in dq.non_negative(neg).collect()] == [1]


def test_parity_by_day(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0)], "business_date long, net double")
    right = spark.createDataFrame([(1, 10.0), (2, 19.0), (4, 5.0)], "business_date long, net double")
    got = sorted((r.business_date, r.diff) for r in dq.parity_by_day(left, right).collect())
    assert got == [(2, 1.0), (3, 30.0), (4, -5.0)]


def test_serving_cells(spark):
    df = spark.createDataFrame([(1, float("nan"), None, True, dt.date(2026, 1, 2)), (2, 12345678.5, "x", None, None)],
                               "a int, b double, c string, d boolean, e date")
    rows = [tuple(r) for r in sinks.serving_cells(df, ["a"]).collect()]
    assert rows == [(1, None, "", "True", "2026-01-02"), (2, 12345678.5, "x", "", "")]


def test_publish_keeps_order_numbers_and_counts(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id * 7919 % 1000 as int) as n", "if(id % 3 = 0, double('NaN'), id / 8) as y", "if(id % 5 = 0, null, 'x,\"y\"') as s", "id % 2 = 0 as b").repartition(7)
    counts = sinks.publish_serving({"t": df, "none": df.where("n < 0")}, str(tmp_path), {"t": ["n"]})
    assert counts == {"t": 1000, "none": 0}
    lines = [x for f in sorted((tmp_path / "t").glob("part-*")) for x in f.read_text().splitlines()[1:]]
    assert [int(x.split(",")[0]) for x in lines] == list(range(1000))
    back = sinks.read_cells(spark, str(tmp_path / "t"), sinks.serving_cells(df).schema)
    assert back.dtypes == [("n", "int"), ("y", "double"), ("s", "string"), ("b", "string")]
    assert back.exceptAll(sinks.serving_cells(df)).count() == 0 and back.count() == 1000


def test_hourly_cumulative(spark):
    stg = spark.createDataFrame([(20260101, dt.datetime(2026, 1, 1, 17), 10.0, 0.0), (20260101, dt.datetime(2026, 1, 1, 19), 5.0, 1.0),
                                 (20260101, dt.datetime(2026, 1, 1, 17, 30), 1.0, 0.0)],
                                "business_date int, opened_at timestamp_ntz, net_amount double, deferred_amount double")
    got = [(r.hr, r.net_sales, r.cumulative_net_sales) for r in marts.hourly_net_sales(stg).orderBy("hr").collect()]
    assert got == [(11, 11.0, 11.0), (13, 4.0, 15.0)]
