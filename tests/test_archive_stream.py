"""B6/L7 archive repair, B8 profile, E5 calendar, ST1-ST3 streaming."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from salescast.operators import conform as cf
from salescast.operators.profile import json_profile
from salescast.operators.regression import holiday_calendar
from salescast.schemas import LANDING_ORDERS, ORDER_COLUMNS
from salescast.session import ensure_checkpoint_dir


def _legacy_table(day, money_int=True):
    cols = {c: [] for c in ORDER_COLUMNS}
    row = dict(business_date=day, order_guid="g1", opened_date="2026-06-26T17:00:00.000+0000", closed_date=None, source="s",
               dining_option_guid=None, num_guests=2.0, num_checks=1, net_amount=10, total_amount=11, tax_amount=1, tip_amount=0,
               deferred_amount=0, voided=False, deleted=False)
    for c in ORDER_COLUMNS:
        cols[c].append(row[c])
    types = {"business_date": pa.int64(), "num_guests": pa.float64(), "num_checks": pa.int64(), "dining_option_guid": pa.null(),
             "voided": pa.bool_(), "deleted": pa.bool_()}
    for m in ("net_amount", "total_amount", "tax_amount", "tip_amount", "deferred_amount"):
        types[m] = pa.int64() if money_int else pa.float64()
    return pa.table({c: pa.array(cols[c], type=types.get(c, pa.string())) for c in ORDER_COLUMNS})


def test_conform_archive_rewrites_only_drifted_and_is_idempotent(spark, tmp_path):
    root = tmp_path / "raw"
    for day in (20260625, 20260626):
        (root / f"business_date={day}").mkdir(parents=True)
        pq.write_table(_legacy_table(day), root / f"business_date={day}" / "orders.parquet")
    report = cf.footer_report(spark, str(root)).collect()
    assert len(report) == 2 and all("net_amount" in r.drifted and "num_guests" in r.drifted for r in report)
    assert cf.conform_archive(spark, str(root)) == [20260625, 20260626]
    assert cf.conform_archive(spark, str(root)) == []
    out = spark.read.schema(LANDING_ORDERS).parquet(str(root)).collect()
    assert len(out) == 2 and {r.net_amount for r in out} == {10.0} and {r.num_guests for r in out} == {2}


def test_conform_archive_keeps_the_other_rows_of_a_drifted_day(spark, tmp_path):
    day = tmp_path / "raw" / "business_date=20260625"
    day.mkdir(parents=True)
    good = pa.concat_tables([_legacy_table(20260625)] * 10)
    fixed = pa.schema([(f.name, {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}.get(f.dataType.typeName(), pa.string())) for f in LANDING_ORDERS.fields])
    pq.write_table(good.select(fixed.names).cast(fixed), day / "a.parquet")
    pq.write_table(_legacy_table(20260625), day / "b.parquet")
    assert cf.conform_archive(spark, str(tmp_path / "raw")) == [20260625]
    assert spark.read.schema(LANDING_ORDERS).parquet(str(tmp_path / "raw")).count() == 11


def test_safe_cast_raises_on_loss(spark):
    df = spark.createDataFrame([(2.5,)], "num_guests double")
    from pyspark.sql import types as T

    with pytest.raises(Exception):
        df.select(cf.safe_cast(F.col("num_guests"), T.DoubleType(), T.LongType(), "num_guests")).collect()


def test_large_files_are_split(spark, tmp_path):
    """A drifted file of many row groups is read in pieces."""
    day = tmp_path / "raw" / "business_date=20260625"
    day.mkdir(parents=True)
    pq.write_table(pa.concat_tables([_legacy_table(20260625)] * 20_000), day / "a.parquet", row_group_size=500, use_dictionary=False, compression="none")
    (row,) = cf.footer_report(spark, str(tmp_path / "raw")).collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = cf.read_signature(spark, str(tmp_path / "raw"), row.signature, [row.path], LANDING_ORDERS)
        assert df.rdd.getNumPartitions() > 5
        assert cf.conform_archive(spark, str(tmp_path / "raw")) == [20260625]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert spark.read.schema(LANDING_ORDERS).parquet(str(tmp_path / "raw")).where("num_guests = 2 and dining_option_guid is null").count() == 20_000


def test_lossy_and_missing_columns_stop_the_repair(spark, tmp_path):
    day = tmp_path / "raw" / "business_date=20260625"
    day.mkdir(parents=True)
    lossy = _legacy_table(20260625)
    lossy = lossy.set_column(lossy.column_names.index("num_guests"), "num_guests", pa.array([2.5]))
    pq.write_table(lossy, day / "a.parquet")
    with pytest.raises(Exception, match="lossy"):
        cf.conform_archive(spark, str(tmp_path / "raw"))
    assert pq.ParquetFile(day / "a.parquet").read().column("num_guests").to_pylist() == [2.5]  # as it was
    pq.write_table(_legacy_table(20260625).drop_columns(["tip_amount"]).append_column("extra", pa.array([1])), day / "a.parquet")
    with pytest.raises(KeyError, match="tip_amount"):
        cf.conform_archive(spark, str(tmp_path / "raw"))


def test_json_profile_whole_corpus(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": [{"c": "x"}, {"c": null}]}',), ('{"a": 2.5, "b": []}',), ("{",), (None,)], "doc string").repartition(3)
    got = {(r.path, r.type): (r.n, r.min_length, r.max_length) for r in json_profile(docs, "doc").collect()}
    assert got == {("a", "int"): (1, None, None), ("a", "float"): (1, None, None), ("b", "list"): (2, 0, 2), ("b[]", "dict"): (2, None, None),
                   ("b[].c", "str"): (1, None, None), ("b[].c", "NoneType"): (1, None, None), ("", "malformed"): (1, None, None), ("", "missing"): (1, None, None)}
    assert json_profile(docs.limit(0), "doc").count() == 0


def test_json_profile_any_depth(spark):
    text = "1"
    for k in reversed(range(120)):
        text = f'{{"k{k}": {text}}}'
    got = {(r.path, r.type): r.n for r in json_profile(spark.createDataFrame([(text,)], "doc string"), "doc").collect()}
    assert len(got) == 120 and got[(".".join(f"k{k}" for k in range(120)), "int")] == 1


def test_json_profile_remembers_a_bounded_number_of_shapes(spark, monkeypatch):
    """Every document has a key of its own; shapes are summed up and forgotten on the way, and nothing is counted twice."""
    from salescast.operators import profile

    monkeypatch.setattr(profile, "SHAPES", 7)
    found = profile.PathSketch()
    for k in range(50):
        found.walk({"a": k, "": {"b": [[1], {}, "x"]}, f"k{k}": None, "a.b": True})
        assert len(found.shapes) <= 7
    found.sum_up()
    plain = {("a", "int"): 50, ("b", "list"): 50, ("b[]", "list"): 50, ("b[][]", "int"): 50, ("b[]", "dict"): 50, ("b[]", "str"): 50, ("a.b", "bool"): 50}
    got = {k: v[0] for k, v in found.seen.items()}
    assert got == plain | {(f"k{k}", "NoneType"): 1 for k in range(50)}


def test_stream_state_is_kept_by_spark(spark, tmp_path):
    """No Python process per key; what the table held, and a document that comes again, are not given out."""
    from salescast.streaming import bronze as sb
    from tests_support import doc

    d = tmp_path / "docs"
    d.mkdir()
    sb.ensure_versioned_bronze(spark, "vb_k", str(tmp_path / "vb"))
    (d / "a.json").write_text("\n".join([doc("o1", 20260626, 10.0, 1), doc("o2", 20260627, 5.0, 2)]))
    sb.catch_up(spark, str(d), "vb_k", str(tmp_path / "ck"))
    later = tmp_path / "later"
    later.mkdir()
    (later / "b.json").write_text("\n".join([doc("o2", 20260627, 5.0, 2), doc("o1", 20260628, 10.0, 2), doc("o1", 20260629, 1.0, 0)]))
    seen = []
    changes = sb.order_changes(sb.read_order_stream(spark, str(later)), sb.held_rows(spark, "vb_k", str(tmp_path / "held")))
    assert "Python" not in changes._jdf.queryExecution().analyzed().toString()
    q = changes.writeStream.outputMode("update").foreachBatch(lambda df, _: seen.extend(df.collect())).option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.change, r.order_guid, r.business_date) for r in seen} == {("enter", "o1", 20260628), ("leave", "o1", 20260626), ("leave", "o1", 20260629)}


def test_holiday_calendar_rules(spark):
    got = {(r.holiday, r.ds) for r in holiday_calendar(spark, "2026-01-01", "2026-12-31").collect()}
    assert ("Thanksgiving", dt.date(2026, 11, 26)) in got
    assert ("Memorial Day", dt.date(2026, 5, 25)) in got
    assert ("Independence Day", dt.date(2026, 7, 4)) in got
    assert ("Independence Day (observed)", dt.date(2026, 7, 3)) in got  # Saturday -> Friday
    assert ("Labor Day", dt.date(2026, 9, 7)) in got
    assert len(got) == 12
    got = {(r.holiday, r.ds) for r in holiday_calendar(spark, "2027-01-01", "2027-12-31").collect()}
    assert {("Christmas Day", dt.date(2027, 12, 25)), ("Christmas Day (observed)", dt.date(2027, 12, 24))} <= got
    assert ("New Year's Day (observed)", dt.date(2027, 12, 31)) in got and max(d for _, d in got) == dt.date(2027, 12, 31)


def test_stream_today_equals_batch(spark, tmp_path):
    from tests_support import SF001

    from salescast.operators import marts
    from salescast.sources import bridge, sinks
    from salescast.streaming.bronze import today_so_far

    land = bridge.landing_orders(spark, SF001)
    root = str(tmp_path / "raw")
    sinks.write_partitions(land, root, LANDING_ORDERS)
    stream = spark.readStream.schema(LANDING_ORDERS).option("maxFilesPerTrigger", 200).parquet(root)
    q = (today_so_far(stream).writeStream.outputMode("update").format("memory").queryName("today_mem")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = spark.table("today_mem").groupBy("business_date").agg(
        F.max_by(F.struct("order_count", "net_sales_so_far"), "order_count").alias("r")).select("business_date", "r.*")
    day = land.select(F.max("business_date")).first()[0]
    (b,) = marts.today_orders(land, day).collect()
    (s,) = streamed.where(F.col("business_date") == day).collect()
    assert (s.order_count, s.net_sales_so_far) == (b.order_count, b.net_sales_so_far)


def test_stream_bronze_latest_version_wins(spark, tmp_path):
    from salescast.streaming import bronze as sb
    from tests_support import doc

    d = tmp_path / "docs"
    d.mkdir()
    (d / "a.json").write_text(doc("o1", 20260626, 10.0, 1) + "\n" + doc("o2", 20260626, 5.0, 1) + "\n")
    sb.ensure_versioned_bronze(spark, "vb_t", str(tmp_path / "vb"))
    sb.catch_up(spark, str(d), "vb_t", str(tmp_path / "ck"))
    (d / "b.json").write_text(doc("o1", 20260626, 12.0, 2) + "\n" + doc("o1", 20260626, 99.0, 0) + "\n")
    sb.catch_up(spark, str(d), "vb_t", str(tmp_path / "ck"))
    got = {r.order_guid: r.net_amount for r in spark.table("vb_t").collect()}
    assert got == {"o1": 12.0, "o2": 5.0}


def test_stream_state_moves_orders_between_days(spark, tmp_path):
    """An order that changes its day leaves the old one, an emptied day goes, what the table held before the stream counts,
    and a batch done again changes nothing."""
    from salescast.streaming import bronze as sb
    from tests_support import doc

    d = tmp_path / "docs"
    d.mkdir()
    sb.ensure_versioned_bronze(spark, "vb_m", str(tmp_path / "vb"))
    (d / "a.json").write_text("\n".join([doc("o1", 20260626, 10.0, 1), doc("o2", 20260626, 5.0, 1), doc("o3", 20260627, 7.0, 3)]))
    sb.catch_up(spark, str(d), "vb_m", str(tmp_path / "ck"))

    def rows():
        return sorted((r.order_guid, r.business_date, r.net_amount, r.version) for r in spark.table("vb_m").collect())

    later = tmp_path / "later"
    later.mkdir()
    (later / "b.json").write_text("\n".join([doc("o3", 20260628, 8.0, 4), doc("o3", 20260629, 8.5, 2), doc("o1", 20260626, 10.0, 1), doc("o4", 20260628, 1.0, 1)]))
    sb.catch_up(spark, str(later), "vb_m", str(tmp_path / "ck2"))  # its state begins with the table
    want = [("o1", 20260626, 10.0, 1), ("o2", 20260626, 5.0, 1), ("o3", 20260628, 8.0, 4), ("o4", 20260628, 1.0, 1)]
    assert rows() == want
    assert {r[0] for r in spark.sql("SHOW PARTITIONS vb_m").collect()} == {"business_date=20260626", "business_date=20260628"}
    (later / "c.json").write_text(doc("o3", 20260626, 9.0, 5) + "\n" + doc("o4", 20260626, 2.0, 0))
    sb.catch_up(spark, str(later), "vb_m", str(tmp_path / "ck2"))
    assert rows() == [*want[:2], ("o3", 20260626, 9.0, 5), want[3]]
    again = spark.table("vb_m").where("order_guid = 'o3'").withColumn("change", F.lit("enter"))
    sb.merge_batch(again, "vb_m")
    spark.catalog.refreshTable("vb_m")
    assert rows() == [*want[:2], ("o3", 20260626, 9.0, 5), want[3]]


def test_batch_writes_each_touched_day_once(spark, tmp_path):
    """A stream's session has adaptive execution off: rebalance hints must hold all the same, or each task writes into each day.
    The settings that this takes, and the staged rows of a batch, are gone afterwards."""
    from salescast.streaming import bronze as sb
    from tests_support import doc

    d = tmp_path / "docs"
    d.mkdir()
    (d / "a.json").write_text("\n".join(doc(f"o{i}", 20260601 + i % 20, float(i), 1) for i in range(600)))
    sb.ensure_versioned_bronze(spark, "vb_w", str(tmp_path / "vb"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.files.openCostInBytes", "spark.sql.sources.partitionOverwriteMode")}
    sb.catch_up(spark, str(d), "vb_w", str(tmp_path / "ck"))
    assert before == {k: spark.conf.get(k) for k in before}

    def files():
        named = spark.table("vb_w").select("business_date", F.input_file_name().alias("file"))
        return named.groupBy("business_date").agg(F.countDistinct("file").alias("n"), F.count("*").alias("rows")).collect()

    assert {(r.business_date, r.n, r.rows) for r in files()} == {(20260601 + i, 1, 30) for i in range(20)}
    (d / "b.json").write_text("\n".join(doc(f"o{i}", 20260601 + i % 20, float(i + 1), 2) for i in range(0, 600, 7)))
    sb.catch_up(spark, str(d), "vb_w", str(tmp_path / "ck"))
    assert {(r.business_date, r.n, r.rows) for r in files()} == {(20260601 + i, 1, 30) for i in range(20)}
    assert {r.order_guid: (r.net_amount, r.version) for r in spark.table("vb_w").collect()} == {f"o{i}": (i + 1.0, 2) if i % 7 == 0 else (float(i), 1) for i in range(600)}
    stage = ensure_checkpoint_dir(spark).removeprefix("file:") + "/salescast-stage"
    assert not os.path.isdir(stage) or not [x for x in os.listdir(stage) if x.startswith("batch-")]


def test_batch_reads_only_the_touched_days(spark, tmp_path):
    from salescast.streaming import bronze as sb

    sb.ensure_versioned_bronze(spark, "vb_p", str(tmp_path / "vb"))
    cols = spark.table("vb_p").columns
    rows = spark.range(60).selectExpr("cast(id as string) as order_guid", "20260601 + id % 20 as business_date", "1L as version")
    rows = spark.createDataFrame([], spark.table("vb_p").schema).unionByName(rows, allowMissingColumns=True)
    rows.select(*cols).write.mode("overwrite").insertInto("vb_p")
    changes = spark.table("vb_p").where("order_guid = '3'").withColumn("change", F.lit("enter")).checkpoint()
    out = sb.rewritten_days(changes, "vb_p", [20260604])
    plan = out._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(business_date" in plan and "20260604" in plan
    held = sb.touched(spark.table("vb_p"), [20260604]).select(F.input_file_name()).distinct().collect()
    assert held and all("business_date=20260604" in r[0] for r in held) and out.count() == 3
