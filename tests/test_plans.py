"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import pytest

from quarterdeck.plans.catalog import QUERIES

from __spark_entry__ import SMOKE_DIR


def _formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"scd1_stream", "analytics_stream", "energy_stream"}))
def test_no_python_udfs(spark, name):
    text = _formatted(QUERIES[name](spark, SMOKE_DIR))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in text, f"{name} runs Python per row ({node})"


def test_dedupe_limits_versions_map_side(spark):
    text = _formatted(QUERIES["dedupe_reposted"](spark, SMOKE_DIR))
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text and "Final" in text


def test_scan_is_pruned_and_filter_pushed(spark):
    text = _formatted(QUERIES["incremental_extract"](spark, SMOKE_DIR))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in text


def test_bounded_dims_are_broadcast(spark):
    text = _formatted(QUERIES["dim_unit"](spark, SMOKE_DIR))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_distinct_count_splits_hot_groups(spark):
    # count(distinct) is planned as an aggregate on (group, transaction) first, so one hot
    # unit is spread over many reducers before the per-unit merge
    text = _formatted(QUERIES["atv"](spark, SMOKE_DIR))
    assert "Keys [5]: [business_date" in text and "partial_count(distinct transaction_id" in text


def test_top_k_is_take_ordered(spark):
    text = _formatted(QUERIES["top_discounts"](spark, SMOKE_DIR))
    assert "TakeOrderedAndProject" in text


def test_lines_are_dealt_once_for_join_and_dedupe(spark):
    # the join's partitioning by order key serves the deduplication on (order, line) as well
    plan = QUERIES["silver_business"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(l_orderkey" in plan
    assert "WindowGroupLimit [l_orderkey" in plan


@pytest.mark.parametrize("name", ["transactional", "vw_transactional"])
def test_transactional_shuffles_lines_three_times_and_plans_once(spark, name):
    # by order, by product (for the product and its dimension) and by date and unit; the unit
    # dimension goes along, and the joined plans keep the partitioning of their sums
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    shuffles = [line for line in plan if "Exchange hashpartitioning" in line]
    assert not [line for line in shuffles if "hashpartitioning(country_code" in line]
    assert sum("hashpartitioning(business_date" in line for line in shuffles) == 1
    union = next(i for i, line in enumerate(plan) if line.rstrip().endswith("Union"))
    assert not any("hashpartitioning(business_date" in line for line in plan[union:])


def test_large_tables_are_dealt_over_tasks_that_follow_their_rows(spark, monkeypatch):
    from quarterdeck.sources import adapter

    rows = adapter.read_table(spark, SMOKE_DIR, "lineitem").count()
    monkeypatch.setattr(adapter, "LINES_PER_TASK", rows // 20)
    lines = QUERIES["duplicate_silver_keys"](spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(l_orderkey" in lines and "REPARTITION_BY_NUM" in lines
    assert sorted(QUERIES["duplicate_keys"](spark, SMOKE_DIR).collect()) == sorted(
        adapter.sales_lines(spark, SMOKE_DIR).groupBy("business_date", "transaction_id", "transaction_line_id").count().where("count > 1").collect())
