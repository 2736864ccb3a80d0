"""Data products on literal rows: discount strategy, actions, break-even, combo, controls,
ATV, budget variance, quality and reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quarterdeck.operators import products, quality, recon

D = dt.date(2026, 1, 1)


def _discount_rows(spark, rows):
    return spark.createDataFrame(
        rows,
        "country_code string, location_id string, unit_id string, discount_type string, discount_name string, "
        "product_category string, gross_sales double, discount_amount double, net_sales double, transaction_id string",
    )


def test_discount_strategy_metrics(spark):
    df = _discount_rows(spark, [
        ("GB", "LOC001", "U1", "PROMO", "Breakfast Combo Promo", "Combo", 100.0, 10.0, 75.0, "T1"),
        ("GB", "LOC001", "U1", "PROMO", "Breakfast Combo Promo", "Combo", 50.0, 5.0, 37.5, "T2"),
    ])
    r = products.discount_strategy(df).first()
    assert (r.gross_sales, r.discount_rate_percent, r.transaction_count) == (150.0, 10.0, 2)
    assert r.net_sales_per_transaction == 56.25


def test_discount_strategy_zero_gross_and_null_group(spark):
    df = _discount_rows(spark, [
        ("GB", "LOC001", "U1", "NONE", None, "Kitchen Instruction", 0.0, 0.0, 0.0, "T1"),
    ])
    r = products.discount_strategy(df).first()
    assert r.discount_rate_percent == 0.0 and r.discount_name is None


def test_commercial_action_thresholds(spark):
    rows = [(25.0, 4.0, 3), (20.0, 4.0, 3), (5.0, 9.0, 150), (5.0, 8.0, 101), (5.0, 8.0, 100), (30.0, 9.0, 500)]
    df = spark.createDataFrame(rows, "discount_rate_percent double, net_sales_per_transaction double, transaction_count long")
    got = [r.commercial_action for r in products.commercial_action(df).collect()]
    assert got == ["review_discount_depth", "monitor", "candidate_for_promotion", "candidate_for_promotion",
                   "monitor", "candidate_for_promotion"]


def _sales(spark, rows):
    return spark.createDataFrame(
        rows,
        "business_date date, country_code string, location_id string, unit_id string, "
        "quarter_hour_start_ts timestamp, net_sales double, enhanced_quantity double, transaction_id string",
    )


def _energy(spark, rows):
    return spark.createDataFrame(rows, "unit_id string, quarter_hour_start_ts timestamp, kwh_consumed double, estimated_running_cost double")


def test_break_even(spark):
    b1, b2, b3 = (dt.datetime(2026, 1, 1, 10, m) for m in (0, 15, 30))
    sales = _sales(spark, [(D, "GB", "L", "U1", b1, 10.0, 1.0, "T1"), (D, "GB", "L", "U1", b1, 5.0, 2.0, "T1"),
                           (D, "GB", "L", "U1", b2, 3.0, 1.0, "T2")])
    energy = _energy(spark, [("U1", b1, 1.0, 4.0), ("U1", b1, 1.0, 4.0), ("U1", b2, 1.0, 3.0), ("U1", b3, 2.0, 6.0)])
    out = {r.quarter_hour_start_ts: r for r in products.unit_15_min_profitability(sales, energy).collect()}
    assert len(out) == 2
    assert (out[b1].net_sales, out[b1].transaction_count, out[b1].estimated_running_cost) == (15.0, 1, 8.0)
    assert out[b1].trading_recommendation == "keep_current_trading_window"
    assert out[b2].profitability_gap == 0.0 and out[b2].trading_recommendation == "keep_current_trading_window"
    idle = {r.quarter_hour_start_ts: r for r in products.unit_15_min_profitability(sales, energy, include_idle=True).collect()}
    assert idle[b3].net_sales == 0.0 and idle[b3].trading_recommendation == "review_open_close_time"
    assert idle[b3].business_date == D
    doubled = {r.quarter_hour_start_ts: r for r in products.unit_15_min_profitability(sales, energy, 2.0).collect()}
    assert doubled[b2].profitability_gap == -3.0


def test_combo_price_variance(spark):
    rows = [("P1", "Burger", True, 8.0, 2.0), ("P1", "Burger", False, 5.0, 1.0), ("P1", "Burger", False, 7.0, 1.0),
            ("P2", "Fries", True, 3.0, 1.0), ("P3", "Cola", False, 2.0, 1.0), ("P1", "Burger", True, 9.0, 0.0)]
    df = spark.createDataFrame(rows, "product_id string, product_name string, is_combo boolean, net_sales double, enhanced_quantity double")
    out = {r.product_id: r for r in products.combo_price_variance(df).collect()}
    assert set(out) == {"P1", "P2"}
    assert out["P1"].combo_avg_unit_net_price == 4.0 and out["P1"].standalone_avg_unit_net_price == 6.0
    assert out["P1"].combo_vs_standalone_delta == -2.0 and out["P1"].combo_discount_percent == -33.33
    assert out["P1"].combo_units == 2.0
    assert out["P2"].standalone_avg_unit_net_price is None and out["P2"].combo_discount_percent is None


def test_product_master_controls(spark):
    sales = spark.createDataFrame([("P001", False, 2.0), ("P004", True, 1.0), ("P009", False, 3.0)],
                                  "product_id string, is_combo boolean, enhanced_quantity double")
    excl = spark.createDataFrame([("P001", "Not priced for ATV", True), ("P009", "old", False)],
                                 "product_id string, exclusion_reason string, is_active boolean")
    over = spark.createDataFrame([("P004", "7.25", True), ("P009", "bad", True)],
                                 "product_id string, override_unit_price string, is_active boolean")
    out = {r.product_id: r for r in products.product_master_controls(sales, excl, over).collect()}
    assert out["P001"].enhanced_quantity == 0.0 and out["P001"].is_masterdata_excluded_product
    assert out["P004"].combo_override_unit_price == 7.25
    assert out["P009"].enhanced_quantity == 3.0 and out["P009"].combo_override_unit_price is None


def test_atv(spark):
    rows = [(D, "GB", "L", "U1", "T1", 10.0, 2.0), (D, "GB", "L", "U1", "T1", 5.0, 0.0), (D, "GB", "L", "U1", "T2", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "business_date date, country_code string, location_id string, unit_id string, "
                                     "transaction_id string, net_sales double, enhanced_quantity double")
    r = products.average_transaction_value(df).first()
    assert (r.transaction_count, r.net_sales, r.average_transaction_value, r.net_sales_per_enhanced_item) == (2, 15.0, 7.5, 7.5)
    zero = products.average_transaction_value(df.filter("transaction_id = 'T2'")).first()
    assert zero.net_sales_per_enhanced_item is None


def test_budget_variance(spark):
    sales = spark.createDataFrame([(D, "U1", 100.0), (D, "U2", 50.0)], "business_date date, unit_id string, net_sales double")
    plan = spark.createDataFrame([(D, "U1", 80.0, None), (D, "U3", 10.0, 12.0)],
                                 "business_date date, unit_id string, daily_budget_net_sales double, forecast_net_sales double")
    out = {r.unit_id: r for r in products.budget_variance(sales, plan).collect()}
    assert out["U1"].budget_variance == 20.0 and out["U1"].budget_attainment_percent == 125.0
    assert out["U2"].daily_budget_net_sales is None
    assert out["U3"].actual_net_sales is None and out["U3"].budget_variance == -10.0


def test_quality_flags_metrics_quarantine(spark):
    df = spark.createDataFrame([(None, D, "completed", 5.0), ("T2", None, "completed", -1.0), ("T3", D, None, -1.0), ("T4", D, "completed", 1.0)],
                               "transaction_id string, business_date date, line_status string, gross_sales double")
    flagged = {r.gross_sales if r.transaction_id != "T4" else 99: r._dq_failed_rules
               for r in quality.with_dq_flags(df, quality.BRONZE_SALES_RULES).collect()}
    assert flagged[5.0] == ["transaction_id_is_present"]
    m = {r.rule_name: r for r in quality.dq_metrics(df, quality.BRONZE_SALES_RULES).collect()}
    assert m["transaction_id_is_present"].rows_failed == 1
    assert m["gross_sales_is_not_negative_for_completed_lines"].rows_failed == 2  # NULL status counts as failed
    assert m["business_date_is_present"].rows_passed == 3
    good, bad = quality.quarantine_split(df, quality.BRONZE_SALES_RULES)
    assert good.count() == 1 and bad.count() == 3
    alerts = quality.dq_alerts(quality.dq_metrics(df, quality.BRONZE_SALES_RULES), quality.notification_owners(spark))
    assert {r.rule_name: r.functional_owner for r in alerts.collect()}["transaction_id_is_present"] == "store-operations"


def test_observed_expectations(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(None, D), ("T2", None), ("T3", D)], "transaction_id string, business_date date")
    obs = Observation("dq_test")
    quality.observe_expectations(df, quality.LANDING_JSON_RULES, obs).collect()
    assert obs.get == {"rows_checked": 3, "failed_transaction_id_is_present": 1, "failed_business_date_is_present": 1}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, v int")
    assert [(r.k, r.row_count) for r in quality.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]


def test_reconciliations(spark):
    countries = spark.createDataFrame([("GB",), ("FR",), ("ES",)], "country_code string")
    sales = spark.createDataFrame([(D, "GB", 10.0), (D, "FR", 5.0), (dt.date(2026, 1, 2), "GB", 1.0)],
                                  "business_date date, country_code string, net_sales double")
    missing = sorted((r.business_date.day, r.country_code) for r in recon.missing_countries(countries, sales, D, dt.date(2026, 1, 3)).collect())
    # on the third day every country was silent
    assert missing == [(1, "ES"), (2, "ES"), (2, "FR"), (3, "ES"), (3, "FR"), (3, "GB")]
    gold = spark.createDataFrame([(D, "GB", 10.0), (D, "FR", 4.0)], "business_date date, country_code string, net_sales double")
    r3 = {r.country_code: r for r in recon.gold_silver_net_sales(gold, sales.filter(F.col("business_date") == D)).collect()}
    assert r3["GB"].is_reconciled and not r3["FR"].is_reconciled and r3["FR"].net_sales_difference == -1.0
    bronze = spark.createDataFrame([(D, "k1"), (D, "k1"), (D, "k2")], "business_date date, k string")
    r2 = recon.bronze_silver_dropped(bronze, ["k"]).first()
    assert (r2.bronze_rows, r2.silver_rows, r2.dropped_rows) == (3, 2, 1)


def test_report_orders(spark):
    df = _discount_rows(spark, [
        ("GB", "L", "U1", "PROMO", "A", "C", 10.0, 1.0, 9.0, "T1"),
        ("GB", "L", "U2", "PROMO", "A", "C", 30.0, 1.0, 29.0, "T2"),
        ("GB", "L", "U3", "PROMO", "A", "C", 30.0, 1.0, 29.0, "T3"),
        ("GB", "L", "U3", "PROMO", "A", "C", 0.0, 0.0, 0.0, "T4"),
    ])
    ordered = [r.unit_id for r in products.order_discount_report(products.discount_strategy(df)).collect()]
    assert ordered == ["U3", "U2", "U1"]
    combo = spark.createDataFrame([("P1", "a", 1.0), ("P2", "b", 5.0), ("P3", "c", None)],
                                  "product_id string, product_name string, combo_units double")
    assert [r.product_id for r in products.order_combo_report(combo).collect()] == ["P2", "P1", "P3"]


def test_plans_join_as_a_full_join_whatever_their_keys(spark):
    from quarterdeck.operators.dims import daily_budget_forecast

    day = ["business_date", "unit_id"]
    budget = spark.createDataFrame([("1", "A", 1.0), ("1", "A", None), ("2", "A", 2.0), (None, "A", 3.0), ("3", None, 4.0)], "business_date string, unit_id string, daily_budget_net_sales double")
    forecast = spark.createDataFrame([("1", "A", 5.0), ("1", "A", 6.0), ("4", "A", 7.0), ("4", "A", 7.0), (None, "A", 8.0), ("3", None, None)], "business_date string, unit_id string, forecast_net_sales double")
    got = daily_budget_forecast(budget, forecast).drop("_silver_refreshed_at")
    whole = budget.join(forecast, day, "full")
    assert got.columns == whole.columns and got.count() == whole.count() == 11
    assert got.exceptAll(whole).count() == 0
