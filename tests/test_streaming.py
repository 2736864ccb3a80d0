"""Streaming upsert and the file-based medallion pipeline against batch results."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from quarterdeck.operators import products
from quarterdeck.operators.dedupe import dedupe_reposted_sales_lines
from quarterdeck.plans import catalog as C
from quarterdeck.sources import adapter as A
from quarterdeck.sources.ingest import master_file_to_parquet
from quarterdeck.streaming.pipeline import LakeLayout, run_pipeline
from quarterdeck.streaming.upsert import Scd1Upsert, read_current

from __spark_entry__ import SMOKE_DIR

SCHEMA = ("business_date date, transaction_id string, transaction_line_id string, source_sequence long, "
          "source_update_ts timestamp, extraction_ts timestamp, discount_amount double")

KEY_COLS = ["business_date", "transaction_id", "transaction_line_id", "discount_amount"]


def _rows(spark, rows):
    import datetime as dt

    t = lambda h: dt.datetime(2026, 1, 1, h)
    d = dt.date(2026, 1, 1)
    return spark.createDataFrame([(d if day == 1 else dt.date(2026, 1, day), txn, line, seq, t(h), t(h), v)
                                  for day, txn, line, seq, h, v in rows], SCHEMA)


def _sorted(df):
    return sorted(tuple(r) for r in df.select(*KEY_COLS).collect())


def test_upsert_matches_batch_for_any_split_with_late_old_version_and_replay(spark, tmp_dir):
    all_rows = [(1, "T1", "L1", 1, 1, 1.0), (1, "T1", "L1", 3, 3, 3.0), (1, "T1", "L1", 2, 2, 2.0),
                (2, "T2", "L1", 1, 1, 9.0), (1, "T3", "L1", 1, 1, 4.0), (2, "T2", "L1", 5, 5, 5.0),
                (1, None, "L9", 1, 1, 0.0)]
    expected = _sorted(dedupe_reposted_sales_lines(_rows(spark, all_rows).filter("transaction_id IS NOT NULL")))
    target = os.path.join(tmp_dir, "t")
    up = Scd1Upsert(target)
    # newest version first, the older version of the same key arrives in a later batch
    up(_rows(spark, all_rows[:2]), 0)
    up(_rows(spark, all_rows[2:5]), 1)
    up(_rows(spark, all_rows[2:5]), 1)  # replay of the same batch id
    up(_rows(spark, all_rows[5:]), 2)
    up._stage(spark, _rows(spark, all_rows[5:]), f"{up.staging}/batch_id=2", 2)  # crash, then replay
    up(_rows(spark, all_rows[2:5]), 3)  # the same rows arriving again as a new batch
    assert _sorted(read_current(spark, target)) == expected
    assert spark.read.parquet(target + "_quarantine").count() == 1


def test_upsert_recovers_from_crash_after_stage(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    up = Scd1Upsert(target)
    batch = _rows(spark, [(1, "T1", "L1", 1, 1, 1.0)])
    up._stage(spark, up._prepared(batch) if hasattr(up, "_prepared") else batch, f"{up.staging}/batch_id=0")
    # the stage is complete but the swap never ran: replaying the batch applies it
    up(_rows(spark, [(1, "T1", "L1", 1, 1, 1.0)]), 0)
    assert _sorted(read_current(spark, target)) == [(__import__("datetime").date(2026, 1, 1), "T1", "L1", 1.0)]


def test_replay_stream_equals_batch_dedupe(spark):
    streamed = C.q_scd1_stream(spark, SMOKE_DIR)
    batch = C.q_dedupe_reposted(spark, SMOKE_DIR)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def _land(spark, root):
    """Write the sf0.001 adapter data as the pipeline's landing files and master loads."""
    lines = C.bronze_sales(spark, SMOKE_DIR)
    db = lines.filter(F.col("_source_ingestion_route") == A.ROUTE_DB).drop("_source_ingestion_route")
    js = lines.filter(F.col("_source_ingestion_route") == A.ROUTE_JSON).drop("_source_ingestion_route", "source_file_name")
    db.repartition(4).write.option("header", True).csv(f"{root}/landing/sales_line_items")
    js.repartition(2).write.json(f"{root}/new_unit_json")
    readings = A.energy_readings(spark, SMOKE_DIR).withColumnRenamed("reading_ts", "quarter_hour_start_ts")
    readings.select("unit_id", "quarter_hour_start_ts", "kwh_consumed", "energy_unit_rate", "estimated_running_cost") \
        .repartition(2).write.option("header", True).csv(f"{root}/landing/energy_meter_readings")
    masters = {
        "unit": A.unit_master(spark, SMOKE_DIR),
        "unitmappingoverride": A.unit_mapping_override(spark, SMOKE_DIR),
        "product": A.product_master(spark, SMOKE_DIR),
        "producthierarchycorrections": A.product_hierarchy_corrections(spark, SMOKE_DIR).select("product_id", "product_category", "corrected_category"),
        "productexclusions": A.product_exclusions(spark, SMOKE_DIR),
        "dailybudget": A.daily_budget(spark, SMOKE_DIR),
        "forecast": A.daily_forecast(spark, SMOKE_DIR),
    }
    for entity, df in masters.items():
        src = f"{root}/master_src/{entity}"
        df.coalesce(1).write.option("header", True).csv(src)
        master_file_to_parquet(spark, src, f"{root}/master", "Business Masters", entity, stamp="20260101020000")


def test_pipeline_end_to_end_matches_batch(spark, tmp_dir):
    _land(spark, tmp_dir)
    layout = LakeLayout(
        landing=f"{tmp_dir}/landing", new_unit_json=f"{tmp_dir}/new_unit_json", master=f"{tmp_dir}/master",
        lake=f"{tmp_dir}/lake", checkpoints=f"{tmp_dir}/ckpt", max_files_per_trigger=2, date_grain="month",
    )
    from quarterdeck.streaming.pipeline import EXPECTATION_LOG

    EXPECTATION_LOG.clear()
    run_pipeline(spark, layout, tiebreak=A.ADAPTER_TIEBREAK)
    dq = EXPECTATION_LOG["dq_bronze_oracle_sales_line_items"]
    assert dq["rows_checked"] == C.bronze_sales(spark, SMOKE_DIR).filter(
        F.col("_source_ingestion_route") == A.ROUTE_DB).count()
    assert dq["failed_transaction_id_is_present"] == 0
    silver = spark.read.parquet(layout.table("silver_sales_line_items_business"))
    batch = C.silver_sales(spark, SMOKE_DIR)
    cols = ["business_date", "transaction_id", "transaction_line_id", "net_sales", "enhanced_quantity", "quarter_hour_start_ts"]
    assert silver.count() == batch.count()
    assert silver.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    analytics = spark.read.parquet(layout.table("analytics_sales_transactional"))
    assert analytics.count() == batch.count()
    renamed = analytics.filter(F.col("unit_name").endswith(A.RENAMED_SUFFIX)).count()
    expected_renamed = batch.join(A.unit_mapping_override(spark, SMOKE_DIR), "unit_id").count()
    assert renamed == expected_renamed
    extra = {"_change_batch", "business_month"}
    whole = products.transactional_from_silver(
        batch, C.silver_dim_unit(spark, SMOKE_DIR), C.silver_dim_product(spark, SMOKE_DIR), C.silver_budget_forecast(spark, SMOKE_DIR), with_versions=True)
    assert set(analytics.columns) - extra == set(whole.columns) and len(whole.columns) == 25
    exact = ["business_date", "transaction_id", "transaction_line_id", "unit_name", "product_name", "product_category", "net_sales", "daily_budget_net_sales", "forecast_net_sales", "source_sequence"]
    assert analytics.select(*exact).exceptAll(whole.select(*exact)).count() == 0
    gold = spark.read.parquet(layout.table("gold_discount_strategy"))
    assert gold.count() == C.q_discount_strategy(spark, SMOKE_DIR).count()
    # a second triggered run without new files changes nothing
    before = sorted(silver.select(*cols).collect())
    run_pipeline(spark, layout, tiebreak=A.ADAPTER_TIEBREAK)
    after = sorted(spark.read.parquet(layout.table("silver_sales_line_items_business")).select(*cols).collect())
    assert before == after
    assert glob.glob(f"{layout.lake}/silver_energy_15_minute_cost/reading_date=*")


def test_watermarked_energy_aggregate_drops_only_too_late_readings(spark, tmp_dir):
    import datetime as dt
    import time

    from quarterdeck.streaming.energy import energy_cost_windowed

    schema = "unit_id string, quarter_hour_start_ts timestamp, kwh_consumed double, estimated_running_cost double"
    src = f"{tmp_dir}/energy"
    t = lambda h, m: dt.datetime(2026, 1, 1, h, m)
    # A batch filters late rows with the watermark of the batch before it, so the late
    # reading comes two batches after the 13:00 reading that moved the watermark to 12:00.
    batches = [
        [("U1", t(10, 1), 1.0, 0.5), ("U1", t(10, 14), 1.0, 0.5)],
        [("U1", t(13, 0), 1.0, 0.5)],
        [("U1", t(13, 30), 1.0, 0.5)],
        [("U1", t(10, 5), 9.0, 9.0), ("U1", t(16, 0), 1.0, 0.5)],  # 10:05 arrives 3 h late
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)  # distinct modification times keep the arrival order
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (energy_cost_windowed(stream, "1 hour").writeStream.outputMode("append").format("memory")
         .queryName("energy_wm_test").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = {r.quarter_hour_start_ts: r.estimated_running_cost for r in spark.table("energy_wm_test").collect()}
    assert rows[t(10, 0)] == 1.0  # the late reading did not reach the emitted 10:00 bucket
    assert rows[t(13, 0)] == 0.5


def test_energy_replay_counts_late_readings(spark, tmp_dir):
    from quarterdeck.streaming.energy import replay_readings

    readings = A.energy_readings(spark, SMOKE_DIR)
    want = C.energy_cost(spark, SMOKE_DIR)
    buckets, runs = replay_readings(spark, readings, f"{tmp_dir}/in_order")
    assert sorted(buckets.collect()) == sorted(want.collect())
    assert [r.late_groups for r in runs] == [0] * 6 and sum(r.rows_read for r in runs) == readings.count() + 2
    # a tenth of the readings comes a delivery later than its time: what the watermark has passed is dropped, and counted
    held = F.pmod(F.hash("reading_ts"), F.lit(10)) == 0
    late, runs = replay_readings(spark, readings, f"{tmp_dir}/late", held_back=held)
    assert sum(r.late_groups for r in runs) > 0 and sum(r.rows_read for r in runs) == readings.count() + 2
    kwh = lambda df: df.agg(F.sum("kwh_consumed")).first()[0]
    assert kwh(readings.where(~held)) <= kwh(late) < kwh(want)
    assert late.join(want, ["unit_id", "quarter_hour_start_ts"], "left_anti").count() == 0


def test_analytics_joins_are_part_of_the_stream(spark, tmp_dir):
    lines = C.silver_sales(spark, SMOKE_DIR)
    lines.write.parquet(f"{tmp_dir}/lines")
    stream = spark.readStream.schema(lines.schema).parquet(f"{tmp_dir}/lines")
    dimensions = C.silver_dim_unit(spark, SMOKE_DIR), C.silver_dim_product(spark, SMOKE_DIR), C.silver_budget_forecast(spark, SMOKE_DIR)
    joined = products.transactional_from_silver(stream, *dimensions, with_versions=True)
    assert joined.isStreaming and len(joined.columns) == 25
    streamed = C.q_analytics_stream(spark, SMOKE_DIR)
    batch = products.transactional_from_silver(lines, *dimensions, with_versions=True)
    assert streamed.columns == batch.columns and streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_union_by_name_of_two_streams(spark, tmp_dir):
    from quarterdeck.sources.files import unified_sales
    from quarterdeck.streaming.pipeline import bronze_schema
    from quarterdeck.schemas import SALES_JSON, SALES_RAW

    streams = []
    for name, schema in (("db", SALES_RAW), ("json", SALES_JSON)):
        spark.createDataFrame([], bronze_schema(schema)).unionByName(
            spark.createDataFrame([(name,)], "transaction_id string"), allowMissingColumns=True).write.parquet(f"{tmp_dir}/{name}")
        streams.append(spark.readStream.schema(bronze_schema(schema)).parquet(f"{tmp_dir}/{name}"))
    both = unified_sales(*streams)
    assert both.isStreaming and "source_file_name" in both.columns
    q = both.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/c").trigger(availableNow=True).start(f"{tmp_dir}/out")
    q.awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == ["db", "json"]


def test_generated_delivery_through_pipeline(spark, tmp_dir):
    from quarterdeck.sources import synthetic as S

    paths = S.write_landing(spark, tmp_dir, days=2, countries=6)
    lines = spark.read.schema(__import__("quarterdeck.schemas", fromlist=["SALES_RAW"]).SALES_RAW).option("header", True).csv(paths["landing"] + "/sales_line_items")
    assert lines.count() > 0
    layout = LakeLayout(landing=paths["landing"], new_unit_json=paths["new_unit_json"], master=paths["master"],
                        lake=f"{tmp_dir}/lake", checkpoints=f"{tmp_dir}/ckpt")
    run_pipeline(spark, layout)
    silver = spark.read.parquet(layout.table("silver_sales_line_items_business"))
    bronze = spark.read.parquet(layout.table("bronze_sales_line_items_unified"))
    keys = ["business_date", "transaction_id", "transaction_line_id"]
    assert silver.count() == bronze.select(*keys).distinct().count()
    assert silver.filter("source_sequence = 2").count() == bronze.filter("source_sequence = 2").count() > 0
    assert silver.groupBy(*keys).count().filter("count > 1").count() == 0
    kitchen = silver.filter("is_kitchen_instruction").agg(F.sum("enhanced_quantity")).first()[0]
    assert not kitchen
    assert spark.read.parquet(layout.table("gold_unit_quarter_hour_sales")).count() > 0
    dims = spark.read.parquet(layout.table("silver_dim_product"))
    assert dims.filter("product_id = 'A400'").first().product_category == "Meal Deal"
    inv = S.gen_inventory(spark, S.gen_units(spark, 6), days=2)
    assert inv.count() == 2 * 12 * sum(p[4] for p in S.PRODUCTS)


def test_upsert_accepts_a_new_column_in_a_later_batch(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    up = Scd1Upsert(target)
    up(_rows(spark, [(1, "T1", "L1", 1, 1, 1.0), (1, "T2", "L1", 1, 1, 2.0), (2, "T0", "L1", 1, 1, 0.5)]), 0)
    later = _rows(spark, [(2, "T1", "L1", 2, 2, 5.0)]).withColumn("loyalty_id", F.lit("C9"))
    up(later, 1)  # a new column, on a later date partition
    again = _rows(spark, [(2, "T3", "L1", 1, 1, 7.0)])  # a batch without the column, same date
    up(again, 2)
    out = {(r.business_date.day, r.transaction_id): r for r in read_current(spark, target).collect()}
    assert out[(2, "T1")].discount_amount == 5.0 and out[(2, "T1")].loyalty_id == "C9"
    assert out[(1, "T2")].loyalty_id is None and out[(2, "T3")].loyalty_id is None


def test_upsert_writes_a_batch_once_and_reads_what_a_half_swapped_stage_holds(spark, tmp_dir):
    target = os.path.join(tmp_dir, "t")
    up = Scd1Upsert(target)
    up(_rows(spark, [(1, "T1", "L1", 1, 1, 1.0), (2, "T2", "L1", 1, 1, 2.0), (3, "T3", "L1", 1, 1, 3.0)]), 0)
    stage = f"{up.staging}/left"
    up._stage(spark, _rows(spark, [(1, "T1", "L1", 2, 2, 5.0), (2, "T2", "L1", 2, 2, 6.0)]), stage, 1)
    staged = {os.path.basename(f) for f in glob.glob(f"{stage}/business_date=2026-01-01/*.parquet")}
    assert staged and not glob.glob(f"{stage}/business_date=2026-01-03")
    # the first partition was swapped in before the crash, the second one was deleted only
    for day in ("01", "02"):
        __import__("shutil").rmtree(f"{target}/business_date=2026-01-{day}")
    os.rename(f"{stage}/business_date=2026-01-01", f"{target}/business_date=2026-01-01")
    up(_rows(spark, [(3, "T4", "L1", 1, 1, 4.0)]), 2)
    got = {r.transaction_id: r.discount_amount for r in read_current(spark, target).collect()}
    assert got == {"T1": 5.0, "T2": 6.0, "T3": 3.0, "T4": 4.0} and not glob.glob(f"{up.staging}/*")
    # the files of the swapped partition are the staged ones, not a second copy
    assert {os.path.basename(f) for f in glob.glob(f"{target}/business_date=2026-01-01/*.parquet")} == staged


def test_replays_leave_neither_landing_nor_dimensions_and_restore_the_session(spark):
    from quarterdeck.session import checkpoint_root

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, root = spark.conf.get(name, None), checkpoint_root(spark).removeprefix("file:")
    known = set(glob.glob(f"{root}/quarterdeck/*_replay/*"))
    assert C.q_analytics_stream(spark, SMOKE_DIR).count() > 0 and C.q_scd1_stream(spark, SMOKE_DIR).count() > 0
    for run in set(glob.glob(f"{root}/quarterdeck/*_replay/*")) - known:
        assert not glob.glob(f"{run}/landing") and not glob.glob(f"{run}/dimensions")
    assert spark.conf.get(name, None) == before


def test_a_plan_in_buckets_is_joined_as_it_lies(spark, tmp_dir):
    import datetime as dt

    from quarterdeck.session import settings
    from quarterdeck.streaming import replay

    day = lambda d: d and dt.date(2026, 1, d)
    cells = [(1, "U1"), (1, "U2"), (2, "U1"), (2, "U1"), (None, "U1"), (3, None), *((4 + i % 20, f"U{i}") for i in range(200))]
    plan = spark.createDataFrame([(day(d), u, float(i), None) for i, (d, u) in enumerate(cells)], "business_date date, unit_id string, daily_budget_net_sales double, forecast_net_sales double")
    lines = spark.createDataFrame([(i, day(d), u) for i, (d, u) in enumerate([*cells[::2], (9, "U9999"), (None, None)])], "line int, business_date date, unit_id string")
    name, table = "spark.sql.adaptive.coalescePartitions.enabled", lambda: [t.name for t in spark.catalog.listTables() if t.name.startswith("quarterdeck_replay")]
    before = spark.conf.get(name)
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    keys = products.PLAN_KEY
    want = sorted(lines.join(plan, keys, "left").collect(), key=str)
    dealt = plan.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    with settings(spark, off | replay.OWN_TABLES), replay._bucketed(spark, dealt, keys, f"{tmp_dir}/plan") as stored:
        joined = lines.join(stored, keys, "left")
        physical = joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(joined.collect(), key=str) == want and len(table()) == 1
    # the lines are shuffled and sorted, the plan is not
    assert "SortMergeJoin" in physical and physical.count("Exchange") == 1 and physical.count(" Sort ") == 1
    assert not table() and spark.conf.get(name) == before and spark.read.parquet(f"{tmp_dir}/plan").count() == len(cells)


def test_the_analytics_stream_shuffles_no_plan_and_lands_what_it_reads(spark, monkeypatch):
    from quarterdeck.session import settings
    from quarterdeck.streaming import replay

    seen = {}

    def stream(spark, root, dimensions, *rest):
        seen["landed"] = set(spark.read.parquet(f"{root}/landing").columns)
        lines = spark.read.parquet(f"{root}/landing")
        seen["join"] = lines.join(dimensions[2], products.PLAN_KEY, "left")._jdf.queryExecution().executedPlan().toString()
        return replayed(spark, root, dimensions, *rest)

    replayed = replay._stream_lines
    monkeypatch.setattr(replay, "_stream_lines", stream)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        streamed = C.q_analytics_stream(spark, SMOKE_DIR)
    assert seen["join"].count("Exchange") == 1 and seen["join"].count(" Sort ") == 1
    assert {"source_file_name", "is_combo", "_source_ingestion_route"} & seen["landed"] == set()
    want = products.transactional_from_silver(
        C.silver_sales(spark, SMOKE_DIR), C.silver_dim_unit(spark, SMOKE_DIR), C.silver_dim_product(spark, SMOKE_DIR), C.silver_budget_forecast(spark, SMOKE_DIR), with_versions=True)
    assert streamed.columns == want.columns and streamed.count() == want.count() and streamed.exceptAll(want).count() == 0


def test_a_stored_plan_has_the_rows_of_the_partitioned_one(spark):
    import datetime as dt

    from quarterdeck.operators import dims

    d = dt.date(2026, 1, 1)
    budget = spark.createDataFrame([(d, "U1", 1.0), (d, "U1", 2.0), (d, "U2", 3.0), (None, "U1", 4.0), (d, None, 5.0), (d, "U4", None)], "business_date date, unit_id string, daily_budget_net_sales double")
    forecast = spark.createDataFrame([(d, "U1", 6.0), (d, "U1", 7.0), (d, "U3", 8.0), (None, "U1", 9.0), (None, None, 10.0), (d, "U4", 11.0)], "business_date date, unit_id string, forecast_net_sales double")
    both = [dims.daily_budget_forecast(budget, forecast, how).drop("_silver_refreshed_at") for how in (True, False)]
    assert both[0].columns == both[1].columns and len(both[0].collect()) == 11
    assert sorted(both[0].collect(), key=str) == sorted(both[1].collect(), key=str)


def test_a_forecast_moved_ahead_has_the_rows_of_the_grouped_one(spark, tmp_dir):
    import datetime as dt

    day = lambda d: d and dt.datetime(2026, 1, d)
    rows = [(day(1), 1, 1.25), (day(1), 1, 2.5), (day(8), 1, 3.0), (None, 1, 4.0), (None, 1, 5.0), (day(1), None, 6.0), (day(2), 2, None), (day(31), 2, 7.0)]
    spark.createDataFrame(rows, "l_shipdate timestamp_ntz, l_suppkey long, l_extendedprice double").write.parquet(f"{tmp_dir}/lineitem.parquet")
    grouped, moved = (A.daily_forecast(spark, tmp_dir, partitioned) for partitioned in (True, False))
    assert grouped.columns == moved.columns and moved.count() == 6
    assert sorted(grouped.collect(), key=str) == sorted(moved.collect(), key=str)
    # the budget's shuffle of the lines serves the forecast as well
    plans = [C.silver_budget_forecast(spark, tmp_dir, partitioned) for partitioned in (True, False)]
    rows = [sorted(p.drop("_silver_refreshed_at").collect(), key=str) for p in plans]
    assert rows[0] == rows[1] and plans[1].columns == plans[0].columns
