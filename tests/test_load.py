"""Landing writes and the incremental bronze load."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescast.operators import load as ld
from salescast.plans.load import ensure_bronze, run_load, run_refresh
from salescast.schemas import BACKTEST, FORECAST, LANDING_ORDERS, METRICS
from salescast.sources import bridge, sinks
from salescast.sources.readers import scan_raw_orders


def _counts(spark, d):
    return spark.createDataFrame(list(d.items()), "business_date long, n long")


def test_days_needing_load_hand_values(spark):
    disk = _counts(spark, {20260626: 100, 20260627: 179, 20260628: 90, 20260412: 102})
    bronze = _counts(spark, {20260626: 100, 20260627: 179, 20260412: 0})
    got = sorted(r.business_date for r in ld.days_needing_load(disk, bronze).collect())
    assert got == [20260412, 20260628]
    equal = _counts(spark, {20260626: 100, 20260627: 179, 20260628: 90})
    got = sorted(r.business_date for r in ld.days_needing_load(equal, equal, window=2).collect())
    assert got == [20260627, 20260628]


def test_bronze_only_days_never_selected(spark):
    disk = _counts(spark, {20260101: 1})
    bronze = _counts(spark, {20260101: 1, 20251231: 5})
    assert ld.days_needing_load(disk, bronze, window=0).count() == 0


def test_refresh_bounds():
    today = dt.date(2024, 3, 1)
    assert ld.refresh_bounds(today, 2) == (dt.date(2024, 2, 28), dt.date(2024, 2, 29))
    assert ld.refresh_bounds(today, 2, through_today=True) == (dt.date(2024, 2, 29), today)
    assert ld.refresh_bounds(today, None) == (today, today)
    with pytest.raises(ValueError):
        ld.refresh_bounds(today, 0)


def _orders(spark, rows):
    """Landing rows of (day, guid, net)."""
    blank = spark.createDataFrame([], LANDING_ORDERS)
    some = spark.createDataFrame(rows, "business_date long, order_guid string, net_amount double")
    return blank.unionByName(some, allowMissingColumns=True)


def test_refresh_lands_its_days_and_fails_on_nothing(spark, tmp_path):
    source, root = str(tmp_path / "source"), str(tmp_path / "landing")
    sinks.write_partitions(_orders(spark, [(d, f"{d}-{i}", 1.0) for d in (20240226, 20240227, 20240228, 20240229, 20240301) for i in range(3)]), source, LANDING_ORDERS)
    orders = scan_raw_orders(spark, source)
    plan = ld.trailing_window(orders, *ld.refresh_bounds(dt.date(2024, 3, 1), 2))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(business_date" in plan and "20240228" in plan and "20240229" in plan
    assert run_refresh(orders, root, dt.date(2024, 3, 1), 2) == 6
    assert {r[0] for r in scan_raw_orders(spark, root).select("business_date").distinct().collect()} == {20240228, 20240229}
    assert run_refresh(orders, root, dt.date(2024, 3, 1), None) == 3
    assert run_refresh(orders, root, dt.date(2024, 3, 4), 5, through_today=True) == 6  # the 29th and the 1st have orders
    with pytest.raises(RuntimeError):
        run_refresh(orders, root, dt.date(2024, 6, 1), 5)
    assert run_refresh(orders, root, dt.date(2024, 6, 1), None) == 0
    assert scan_raw_orders(spark, root).count() == 9


def test_day_counts_come_from_footers(spark, tmp_path):
    root = str(tmp_path / "landing")
    sinks.write_partitions(_orders(spark, [(20240101 + i % 7, str(i), 1.0) for i in range(100)]), root, LANDING_ORDERS)
    got = {r["business_date"]: r["n"] for r in ld.landing_day_counts(spark, root).collect()}
    assert got == {20240101 + d: len(range(d, 100, 7)) for d in range(7)}
    before = {k: spark.conf.get(k) for k in ld.FOOTERS}
    for k, v in ld.FOOTERS.items():
        spark.conf.set(k, v)
    try:
        plan = ld.footer_counts(spark, root)._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [business_date]" in plan


def test_staged_days_prune_the_landing_scan(spark, tmp_path):
    from salescast.plans.load import staged_days

    root = str(tmp_path / "landing")
    spark.range(400).selectExpr("id", "20240101 + id % 20 as business_date").write.partitionBy("business_date").parquet(root)
    days = staged_days(spark.createDataFrame([(20240103,)], "business_date long"))
    landing = spark.read.schema("id long, business_date long").parquet(root)
    chosen = landing.join(days, "business_date", "left_semi")
    assert "dynamicpruning" in chosen._jdf.queryExecution().toString().lower()
    assert chosen.count() == 20


def test_history_bounds_with_closed_day_and_floor(spark):
    days = [dt.date(2026, 7, 30) - dt.timedelta(days=i) for i in range(1, 40) if (dt.date(2026, 7, 30) - dt.timedelta(days=i)).weekday() != 0]
    df = spark.createDataFrame([(int(d.strftime("%Y%m%d")),) for d in days], "business_date long")
    r = ld.history_bounds(df, F.lit(20260730), 900).first()
    assert r.first_day == int(min(days).strftime("%Y%m%d")) and r.last_day == 20260729
    r = ld.history_bounds(df, F.lit(20260730), 10).first()
    floor = dt.date(2026, 7, 20)  # a closed Monday: the first day with data is the 21st
    assert r.first_day == int(min(d for d in days if d >= floor).strftime("%Y%m%d")) == 20260721


def test_landing_write_scan_and_idempotent_load(spark, tmp_path):
    from tests_support import SF001

    land = bridge.landing_orders(spark, SF001)
    root = str(tmp_path / "raw")
    n = sinks.write_partitions(land, root, LANDING_ORDERS)
    assert n == land.count()
    scanned = scan_raw_orders(spark, root)
    assert dict(scanned.dtypes)["business_date"] == "bigint"
    assert scanned.exceptAll(land).count() == 0
    # skip mode writes nothing when every day is already on disk
    assert sinks.write_partitions(land, root, LANDING_ORDERS, mode="skip") == 0
    ensure_bronze(spark, "bronze_t", str(tmp_path / "bronze"))
    first = run_load(spark, root, "bronze_t", location=str(tmp_path / "bronze"))
    assert first == land.count()
    # second run: nothing stale, window re-loads only the last 2 days
    second = run_load(spark, root, "bronze_t", window=2, location=str(tmp_path / "bronze"))
    last2 = [r.business_date for r in ld.recent_days(ld.day_counts(land), 2).collect()]
    assert second == land.where(F.col("business_date").isin(last2)).count()
    b = spark.table("bronze_t")
    assert b.count() == land.count()
    assert dict(b.dtypes)["num_guests"] == "int"


def test_zero_row_day_does_not_clear_partition(spark, tmp_path):
    from tests_support import SF001

    land = bridge.landing_orders(spark, SF001)
    root = str(tmp_path / "raw")
    sinks.write_partitions(land, root, LANDING_ORDERS)
    day = land.select(F.max("business_date")).first()[0]
    empty = land.where(F.lit(False))
    assert sinks.write_partitions(empty, root, LANDING_ORDERS) == 0
    assert scan_raw_orders(spark, root).where(F.col("business_date") == day).count() > 0


TS = dt.datetime(2026, 6, 27, 6, 0)


def test_table_writers(spark):
    f = spark.createDataFrame([(20260627, 1.0, None, None, "baseline", TS)], FORECAST)
    assert sinks.write_latest(f, "fc_t", FORECAST) == 1
    assert sinks.write_latest(f.where(F.lit(False)), "fc_t", FORECAST) == 0
    assert spark.table("fc_t").count() == 1
    b1 = spark.createDataFrame([(20260601, 1.0, "baseline", 0, TS)], BACKTEST)
    b2 = spark.createDataFrame([(20260601, 2.0, "trend_weekday", 0, TS)], BACKTEST)
    assert sinks.write_overwrite_once([b1, b2], "bt_t", BACKTEST) == 2
    assert {r.model for r in spark.table("bt_t").collect()} == {"baseline", "trend_weekday"}
    assert sinks.write_overwrite_once([], "bt_t", BACKTEST) == 0


def test_archive_holds_each_run_once(spark):
    m = lambda ts, mae: spark.createDataFrame([("baseline", mae, 1.0, None, None, 14, 8, ts)], METRICS)
    assert sinks.append_history(m(TS, 1.0), "m_t", METRICS) == 1
    sinks.append_history(m(TS + dt.timedelta(days=1), 2.0), "m_t", METRICS)
    sinks.append_history(m(TS + dt.timedelta(days=1), 2.0), "m_t", METRICS)  # the run is tried again
    assert sinks.append_history(m(TS, 3.0).where(F.lit(False)), "m_t", METRICS) == 0
    assert sorted((r.run_ts, r.mae) for r in spark.table("m_t").collect()) == [(TS, 1.0), (TS + dt.timedelta(days=1), 2.0)]
    assert spark.table("m_t").schema.fieldNames() == METRICS.fieldNames() and dict(spark.table("m_t").dtypes)["horizon"] == "int"


def test_a_failed_publish_leaves_the_old_rows(spark):
    f = lambda y: spark.createDataFrame([(20260627 + i, y, None, None, "baseline", TS) for i in range(3)], FORECAST)
    sinks.publish(f(1.0), "pub_t", FORECAST)
    reader = spark.table("pub_t")
    with pytest.raises(Exception):
        sinks.publish(f(2.0).withColumn("yhat", F.when(F.col("forecast_date") == 20260628, F.raise_error(F.lit("lost"))).otherwise(2.0)), "pub_t", FORECAST)
    assert {r.yhat for r in spark.table("pub_t").collect()} == {1.0}
    old = sinks.table_location(spark, "pub_t")
    assert sinks.publish(f(3.0), "pub_t", FORECAST) == 3 and sinks.table_location(spark, "pub_t") != old
    assert {r.yhat for r in spark.table("pub_t").collect()} == {3.0} and {r.yhat for r in reader.collect()} == {1.0}  # a begun reader goes on
    assert sinks.drop_old_versions(spark, "pub_t") == 0 and sinks.drop_old_versions(spark, "pub_t", keep_hours=-1) == 2
    assert {r.yhat for r in spark.table("pub_t").collect()} == {3.0}


def test_forecast_tables_exist_before_the_first_run(spark, tmp_path):
    from salescast import schemas as sc

    made = sinks.create_forecast_tables(spark, "first_", [("k", LANDING_ORDERS["source"].dataType)], str(tmp_path))
    assert made == ["first_forecast_daily_sales", "first_forecast_history", "first_model_metrics", "first_backtest_predictions"]
    for name in made:
        t = spark.table(name)
        want = sc.FORECAST_TABLES[name.removeprefix("first_")]
        assert t.columns == ["k", *want.fieldNames()] and t.count() == 0
        assert [f.dataType for f in t.schema.fields[1:]] == [f.dataType for f in want.fields]
    ensure_bronze(spark, "first_bronze", str(tmp_path / "b"))
    assert dict(spark.table("first_bronze").dtypes)["num_checks"] == "int" and spark.table("first_bronze").columns[-1] == "business_date"


def test_series_from_a_configured_catalog(spark, tmp_path):
    from salescast.sources.readers import Warehouse, load_daily_series

    w = Warehouse(schema="shop")
    assert (w.mart(), w.base("model_metrics")) == ("spark_catalog.shop_marts.fct_daily_sales", "spark_catalog.shop.model_metrics")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop_marts LOCATION '{tmp_path}'")
    mart = spark.createDataFrame([(20240103, 5.0), (20240101, 1.0), (20240104, None)], "business_date int, net_sales double")
    sinks.publish(mart, w.mart(), mart.schema)
    assert [(r.ds.day, r.y) for r in load_daily_series(spark, w).orderBy("ds").collect()] == [(1, 1.0), (2, 0.0), (3, 5.0), (4, 0.0)]


def test_bad_documents_go_to_quarantine(spark):
    from salescast.operators.flatten import flatten_orders
    from salescast.sources.readers import rescue_documents

    rows = [(1, '{"guid":"a","businessDate":20240101,"unknown":[1],"checks":[{"amount":3}]}'), (2, '{"guid":"b","businessDate":2024'), (3, None), (4, "  "),
            (5, '{"guid":"c","businessDate":"soon"}'), (6, '{"guid":"d","checks":[{"amount":"x"}]}'), (7, "no json")]
    good, bad = rescue_documents(spark.createDataFrame(rows, "at long, value string"))
    assert [(r.at, r.guid) for r in good.select("at", "guid").collect()] == [(1, "a")]
    assert [r.net_amount for r in flatten_orders(good).collect()] == [3.0]
    got = {r["at"]: (r.value, r.reason) for r in bad.collect()}
    assert got == {i: (v, {2: "malformed", 7: "malformed", 3: "missing", 4: "missing"}.get(i, "mistyped")) for i, v in rows if i > 1}


def test_documents_are_parsed_once(spark):
    from salescast.sources.readers import rescue_documents

    good, _ = rescue_documents(spark.createDataFrame([(1, '{"guid":"a"}')], "at long, value string"))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_documents_are_built_after_the_join(spark):
    """No text of a document is shuffled: only the lines' numbers and flags are."""
    from tests_support import SF001

    from salescast.sources import bridge

    plan = bridge.nested_orders(spark, SF001)._jdf.queryExecution().sparkPlan().toString()
    assert "@example.com" not in plan[plan.index("SortMergeJoin"):] and "BroadcastHashJoin" not in plan


def test_landed_documents_are_compressed(spark, tmp_path):
    from salescast.sources import sinks

    docs = spark.range(2_000).selectExpr("cast(id as string) guid", "array(named_struct('amount', 1.5D)) checks")
    sinks.write_documents(docs, str(tmp_path / "docs"))
    plain = sum(len(r[0]) + 1 for r in docs.select(F.to_json(F.struct("*"))).collect())
    assert sum(p.stat().st_size for p in (tmp_path / "docs").glob("part-*")) < plain / 2
    from salescast.sources.readers import read_nested_orders

    assert read_nested_orders(spark, str(tmp_path / "docs")).where("checks[0].amount = 1.5").count() == 2_000


def test_audit_parses_each_document_once(spark):
    from tests_support import SF001

    import __spark_entry__ as entry

    plan = entry.queries()["drift_audit"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("json_tuple(") == 1 and "get_json_object" not in plan
