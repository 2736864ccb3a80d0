"""Inputs that come late, again or malformed: no run dies and no row is lost."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions.money import exact_sum, round_half_up, to_double_or_zero
from quarterdeck.operators import dims
from quarterdeck.plans import catalog as C
from quarterdeck.sources import adapter as A
from quarterdeck.sources import files
from quarterdeck.sources.ingest import advance_watermark, run_ingestion
from quarterdeck.schemas import INGESTION_CONTROL
from quarterdeck.streaming.pipeline import LakeLayout, run_pipeline
from quarterdeck.streaming.upsert import Scd1Upsert, read_current
from test_streaming import _land, _rows, _sorted

from __spark_entry__ import SMOKE_DIR


def test_fresh_checkpoint_over_an_existing_table(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    first = Scd1Upsert(target)
    first(_rows(spark, [(1, "T1", "L1", 1, 1, 1.0)]), 0)
    first(_rows(spark, [(1, "T1", "L1", 2, 2, 2.0)]), 1)
    Scd1Upsert(target)(_rows(spark, [(1, "T1", "L1", 3, 3, 3.0), (1, "T2", "L1", 1, 1, 7.0)]), 0)
    assert [r[-1] for r in _sorted(read_current(spark, target))] == [3.0, 7.0]
    assert os.listdir(f"{target}/_staging") == []


def test_crash_in_the_swap_is_repaired_by_any_later_batch(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    up = Scd1Upsert(target)
    up(_rows(spark, [(1, "T1", "L1", 1, 1, 1.0), (2, "T5", "L1", 1, 1, 5.0)]), 0)
    up._stage(spark, _rows(spark, [(1, "T1", "L1", 2, 2, 2.0)]), f"{up.staging}/broken", 1)
    up._stage(spark, _rows(spark, [(1, "T9", "L1", 1, 1, 9.0)]), f"{up.staging}/unfinished", 1)
    os.remove(f"{up.staging}/unfinished/_SUCCESS")
    Scd1Upsert(target)(_rows(spark, [(3, "T7", "L1", 1, 1, 7.0)]), 0)
    assert [r[-1] for r in _sorted(read_current(spark, target))] == [2.0, 5.0, 7.0]


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("delivery"))
    _land(spark, root)
    return root


def test_route_and_masters_that_start_in_the_second_run(spark, tmp_dir, delivered):
    late_json, late_master = f"{tmp_dir}/json", f"{tmp_dir}/master"
    layout = LakeLayout(landing=f"{delivered}/landing", new_unit_json=late_json, master=late_master, lake=f"{tmp_dir}/lake", checkpoints=f"{tmp_dir}/ckpt", date_grain="month")
    run_pipeline(spark, layout, tiebreak=A.ADAPTER_TIEBREAK)
    first = spark.read.parquet(layout.table("analytics_sales_transactional"))
    lines = first.count()
    assert lines > 0 and first.where("product_name IS NOT NULL OR unit_name IS NOT NULL").count() == 0

    spark.read.text(f"{delivered}/new_unit_json").write.text(late_json)
    for entity in ("unit", "product", "dailybudget"):  # no overrides, corrections, exclusions, forecast
        source = f"{delivered}/master/*/{entity}/{entity}_20260101020000"
        spark.read.parquet(source).write.parquet(f"{late_master}/businessmasters/{entity}/{entity}_20260101020000")
    run_pipeline(spark, layout, tiebreak=A.ADAPTER_TIEBREAK)
    batch = C.silver_sales(spark, SMOKE_DIR)
    second = spark.read.parquet(layout.table("analytics_sales_transactional"))
    assert second.count() == batch.count() > lines
    assert second.where("product_name IS NULL").count() == 0
    assert second.where("daily_budget_net_sales IS NOT NULL").count() > 0
    cols = ["business_date", "transaction_id", "transaction_line_id", "net_sales"]
    assert second.select(*cols).exceptAll(batch.select(*cols)).count() == 0


def test_a_swapped_header_fails_instead_of_filling_wrong_columns(spark, tmp_dir):
    from quarterdeck.schemas import SALES_RAW

    names = SALES_RAW.fieldNames()
    i, j = names.index("gross_sales"), names.index("tax_amount")
    names[i], names[j] = names[j], names[i]
    spark.createDataFrame([tuple("1" for _ in names)], ", ".join(f"{n} string" for n in names)).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/csv")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_sales_csv(spark, f"{tmp_dir}/csv").collect()


@pytest.mark.parametrize("zone", ["UTC", "Europe/London"])
def test_watermark_in_any_zone_and_of_any_type(spark, tmp_dir, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = spark.range(3).select(F.expr("timestamp '2026-07-01 10:00:00' + make_interval(0, 0, 0, 0, id)").alias("changed"), (F.col("id") + 41).alias("version"))
        assert advance_watermark(times, "changed", None).first().new_watermark == "2026-07-01 12:00:00"
        assert advance_watermark(times, "version", "7").first().new_watermark == "43"
        assert advance_watermark(times.where("version < 0"), "version", "7").first().new_watermark == "7"
        values = {"ingestion_id": 1, "is_active": True, "load_pattern": "incremental", "target_folder": "t", "last_watermark_value": None}
        rows = [tuple({**values, "ingestion_id": k, "watermark_column": c, "target_folder": f"t{k}"}.get(f) for f in INGESTION_CONTROL.fieldNames()) for k, c in ((1, "changed"), (2, "version"))]
        control = spark.createDataFrame(rows, INGESTION_CONTROL)
        ids = set()
        for run in ("a", "b"):
            audit, control = run_ingestion(spark, control, lambda s, r: times, f"{tmp_dir}/{run}", run_id=run, trigger_time=dt.datetime(2026, 7, 2))
            got = audit.collect()
            assert {r.status for r in got} == {"Succeeded"}
            ids |= {r.audit_id for r in got}
            assert [r.last_watermark_value for r in control.orderBy("ingestion_id").collect()] == ["2026-07-01 12:00:00", "43"]
            assert {r.rows_written for r in got} == {3 if run == "a" else 0}
            control = spark.createDataFrame(control.collect(), INGESTION_CONTROL)
        assert len(ids) == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_agreed_arithmetic(spark):
    one = spark.createDataFrame([("1.005", 1.005), ("NaN", -1.005), ("Infinity", 44939.734999999993), ("x", 2.5)], "t string, d double")
    assert [r[0] for r in one.select(round_half_up("d", 2)).collect()] == [1.01, -1.01, 44939.74, 2.5]
    assert [r[0] for r in one.select(to_double_or_zero("t")).collect()] == [1.005, 0.0, 0.0, 0.0]
    readings = spark.range(100).select(F.lit("U1").alias("unit_id"), F.lit(dt.datetime(2026, 1, 1, 10)).alias("at"), F.lit("1.004").alias("kwh_consumed"), F.lit(0.281).alias("estimated_running_cost"))
    row = dims.energy_15_minute_cost(readings, "at").first()
    assert (row.kwh_consumed, row.estimated_running_cost) == (100.4, 28.1)
    assert spark.range(10).select(exact_sum(F.lit(0.1))).first()[0] == 1.0


def test_ingest_job_writes_audit_and_advances_the_control_table(spark, tmp_dir):
    from quarterdeck.__main__ import run_ingest_job

    spark.range(5).select((F.col("id") + 1).alias("version")).write.parquet(f"{tmp_dir}/src/pos/lines")
    values = {"ingestion_id": 1, "is_active": True, "load_pattern": "incremental", "watermark_column": "version", "target_folder": "lines", "source_schema": "pos", "source_table": "lines"}
    other = {**values, "ingestion_id": 2, "source_table": "missing"}
    rows = [tuple(v.get(f) for f in INGESTION_CONTROL.fieldNames()) for v in (values, other)]
    spark.createDataFrame(rows, INGESTION_CONTROL).write.parquet(f"{tmp_dir}/control")
    for _ in range(2):
        run_ingest_job(spark, f"{tmp_dir}/control", f"{tmp_dir}/src", f"{tmp_dir}/landing", f"{tmp_dir}/audit")
    audit = spark.read.parquet(f"{tmp_dir}/audit").collect()
    assert len({r.audit_id for r in audit}) == 4
    assert sorted((r.ingestion_id, r.status, r.rows_written) for r in audit if r.ingestion_id == 1) == [(1, "Succeeded", 0), (1, "Succeeded", 5)]
    assert {r.status for r in audit if r.ingestion_id == 2} == {"Failed"} and all(len(r.error_message) > 10 for r in audit if r.ingestion_id == 2)
    assert [r.last_watermark_value for r in spark.read.parquet(f"{tmp_dir}/control").orderBy("ingestion_id").collect()] == ["5", None]
