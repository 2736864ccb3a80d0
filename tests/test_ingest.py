"""Control-driven extraction: active rows, incremental watermark, audit, reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quarterdeck.operators import recon
from quarterdeck.schemas import INGESTION_CONTROL
from quarterdeck.sources.adapter import read_table
from quarterdeck.sources.control import active_control_rows, key_columns
from quarterdeck.sources.ingest import (
    append_run_audit,
    read_landing,
    run_ingestion,
    source_counts_from_audit,
)

from __spark_entry__ import SMOKE_DIR

NOW = dt.datetime(2026, 1, 1)


def _control(spark):
    rows = [
        (1, "pos", "POS", "SALES_TRANSACTION_LINE", "sales_line_items", "incremental", "l_shipdate",
         "1998-01-01 00:00:00", "l_orderkey, l_linenumber", "landing", "sales_line_items", "csv", "six_daily", True, NOW, NOW),
        (2, "pos", "MASTERDATA", "PRODUCT", "products", "full", None, None, "p_partkey",
         "landing", "products", "csv", "daily_reference", True, NOW, NOW),
        (3, "pos", "POS", "PAYMENT_LINE", "payment_lines", "incremental", "x", None, "a", "landing",
         "payment_lines", "csv", "six_daily", False, NOW, NOW),
        (4, "pos", "POS", "BROKEN", "broken", "full", None, None, "a", "landing", "broken", "csv",
         "six_daily", True, NOW, NOW),
    ]
    return spark.createDataFrame(rows, INGESTION_CONTROL)


def _reader(spark, row):
    tables = {"SALES_TRANSACTION_LINE": "lineitem", "PRODUCT": "part"}
    if row["source_table"] not in tables:
        raise RuntimeError("source object not found")
    return read_table(spark, SMOKE_DIR, tables[row["source_table"]])


def test_active_rows_and_keys(spark):
    c = _control(spark)
    assert [r.ingestion_id for r in active_control_rows(c, "six_daily").collect()] == [1, 4]
    assert key_columns(c).filter("ingestion_id = 1").first().primary_key_array == ["l_orderkey", "l_linenumber"]


def test_incremental_run_audit_watermark_and_recon(spark, tmp_dir):
    control = _control(spark)
    landing = f"{tmp_dir}/landing"
    audit, control2 = run_ingestion(spark, control, _reader, landing, run_group=None, run_id="run1", trigger_time=NOW)
    a = {r.ingestion_id: r for r in audit.collect()}
    assert set(a) == {1, 2, 4}
    li = read_table(spark, SMOKE_DIR, "lineitem")
    expected = li.filter(F.col("l_shipdate") > F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")).count()
    assert a[1].status == "Succeeded" and a[1].rows_read == expected
    assert a[2].rows_read == read_table(spark, SMOKE_DIR, "part").count()
    assert a[4].status == "Failed" and "not found" in a[4].error_message
    newest = li.agg(F.max("l_shipdate")).first()[0].strftime("%Y-%m-%d %H:%M:%S")
    wm = {r.ingestion_id: r.last_watermark_value for r in control2.collect()}
    assert wm[1] == newest and wm[2] is None
    landed = read_landing(spark, landing, "sales_line_items", li.schema, extract_date="2026-01-01")
    assert landed.count() == expected and "run_id" in landed.columns
    # second run: nothing newer than the watermark, so nothing lands and the watermark stays
    audit2, control3 = run_ingestion(spark, control2, _reader, landing, run_group="six_daily", run_id="run2",
                                     trigger_time=NOW + dt.timedelta(hours=4))
    a2 = {r.ingestion_id: r for r in audit2.collect()}
    assert a2[1].rows_read == 0
    assert {r.ingestion_id: r.last_watermark_value for r in control3.collect()}[1] == newest
    audit_path = f"{tmp_dir}/audit"
    append_run_audit(audit, audit_path)
    append_run_audit(audit2, audit_path)
    all_audit = spark.read.parquet(audit_path)
    # R1: source rows per entity and run vs rows landed in the landing/Bronze area
    bronze = spark.read.schema(li.schema).option("header", True).csv(f"{landing}/sales_line_items").withColumn(
        "target_entity", F.lit("sales_line_items")).withColumnRenamed("run_id", "pipeline_run_id")
    src = source_counts_from_audit(all_audit, control).filter("target_entity = 'sales_line_items'")
    r1 = {r.pipeline_run_id: r for r in recon.source_bronze_counts(src, bronze, ["target_entity", "pipeline_run_id"]).collect()}
    assert r1["run1"].row_difference == 0
    # R5: the broken object never succeeded, so it is late; the others are fresh; the inactive one does not count
    now = F.lit(NOW + dt.timedelta(hours=5)).cast("timestamp")
    late = {r.ingestion_id: r for r in recon.load_delays(control, all_audit, now, max_hours=6).collect()}
    assert set(late) == {1, 2, 4} and [late[k].is_delayed for k in (1, 2, 4)] == [False, False, True]
    assert (late[4].last_status, late[4].failed_runs, late[4].hours_since_success) == ("Failed", 2, None)
    never = recon.load_delays(control, all_audit.where("ingestion_id = 1"), now, max_hours=0.5)
    assert {(r.ingestion_id, r.last_status, r.is_delayed) for r in never.collect()} == {(1, "Succeeded", True), (2, "Never run", True), (4, "Never run", True)}


def test_master_ingestion_lands_stamped_loads_and_snapshot_picks_newest(spark, tmp_dir):
    from quarterdeck.schemas import MASTER_CONTROL
    from quarterdeck.sources import adapter as A
    from quarterdeck.sources.files import read_master_parquet
    from quarterdeck.sources.ingest import run_master_ingestion
    from quarterdeck.operators.dedupe import latest_master_snapshot

    src = f"{tmp_dir}/src"
    A.unit_mapping_override(spark, SMOKE_DIR).coalesce(1).write.option("header", True).csv(f"{src}/unit_mapping_override.csv")
    A.product_exclusions(spark, SMOKE_DIR).coalesce(1).write.option("header", True).csv(f"{src}/product_exclusions.csv")
    rows = [
        (1, "site", "https://example.org/sites/masters", "Shared Documents/Unit Mapping Override", "unit_mapping_override.csv",
         "csv", None, "unitmappingoverride", "vault", "a", "b", "c", "landing", "master files", True, "parquet", "full", True, NOW, NOW),
        (2, "site", "https://example.org/sites/masters", "Shared Documents/Product Exclusions", "product_exclusions.csv",
         "csv", None, "productexclusions", "vault", "a", "b", "c", "landing", "master files", True, "parquet", "full", True, NOW, NOW),
        (3, "site", "https://example.org/sites/masters", "Shared Documents/Missing", "missing.csv",
         "csv", None, "forecast", "vault", "a", "b", "c", "landing", "master files", True, "parquet", "full", False, NOW, NOW),
    ]
    control = spark.createDataFrame(rows, MASTER_CONTROL)
    target = f"{tmp_dir}/master"
    first = {r.entity_name: r for r in run_master_ingestion(spark, control, src, target, stamp="20260101020000").collect()}
    assert set(first) == {"unitmappingoverride", "productexclusions"}
    assert first["unitmappingoverride"].target_path.endswith("/masterfiles_unitmappingoverride/unitmappingoverride/unitmappingoverride_20260101020000")
    run_master_ingestion(spark, control, src, target, stamp="20260102020000")
    loads = read_master_parquet(spark, target, "productexclusions")
    n = A.product_exclusions(spark, SMOKE_DIR).count()
    assert n > 0 and loads.count() == 2 * n
    snap = latest_master_snapshot(loads, ["product_id"])
    assert snap.count() == n and {r._file_stamp for r in snap.collect()} == {"20260102020000"}


def test_rows_lost_on_the_way_show_in_audit_and_reconciliation(spark, tmp_dir, monkeypatch):
    import glob
    import os

    from quarterdeck.sources import ingest

    whole = ingest.read_landed_load

    def lossy(session, path, schema):  # a part file is gone before the load is counted
        os.remove(sorted(glob.glob(f"{path}/part-*"))[0])
        return whole(session, path, schema)

    monkeypatch.setattr(ingest, "read_landed_load", lossy)
    control = _control(spark).where("ingestion_id = 1")
    reader = lambda s, row: _reader(s, row).repartition(4)
    audit, after = run_ingestion(spark, control, reader, f"{tmp_dir}/landing", run_id="r", trigger_time=NOW)
    row = audit.first()
    assert row.status == "Incomplete" and 0 < row.rows_written < row.rows_read and "landed" in row.error_message
    assert after.first().last_watermark_value == "1998-01-01 00:00:00"  # the next run takes the rows again
    landed = read_landing(spark, f"{tmp_dir}/landing", "sales_line_items", read_table(spark, SMOKE_DIR, "lineitem").schema)
    bronze = landed.withColumn("target_entity", F.lit("sales_line_items"))
    r1 = recon.source_bronze_counts(source_counts_from_audit(audit, control), bronze, ["target_entity"]).first()
    assert r1.row_difference == row.rows_read - row.rows_written > 0


def test_landed_text_survives_quotes_line_ends_and_microseconds(spark, tmp_dir):
    odd = spark.createDataFrame([(1, 'a "b", c\nd', dt.datetime(2026, 1, 1, 1, 2, 3, 456789)), (2, None, None)], "id long, t string, at timestamp_ntz")
    control = _control(spark).where("ingestion_id = 2")
    audit, _ = run_ingestion(spark, control, lambda s, r: odd, f"{tmp_dir}/l", run_id="r", trigger_time=NOW)
    assert (audit.first().rows_read, audit.first().rows_written) == (2, 2)
    back = read_landing(spark, f"{tmp_dir}/l", "products", odd.schema, extract_date="2026-01-01", run_id="r")
    assert sorted(back.drop("extract_date", "run_id").collect()) == sorted(odd.collect())


def test_landing_by_day_prunes_folders(spark, tmp_dir):
    events = read_table(spark, SMOKE_DIR, "events")
    from quarterdeck.sources.ingest import land_by_day

    land_by_day(events, tmp_dir, "events", F.col("ts"), "run1")
    one = read_landing(spark, tmp_dir, "events", events.schema, extract_date="2024-01-15")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(extract_date" in plan and "extract_date" in plan.split("PartitionFilters")[1][:120]
    want = events.where("cast(ts as date) = date '2024-01-15'")
    assert one.count() == want.count() > 0 and one.select(*events.columns).exceptAll(want).count() == 0
