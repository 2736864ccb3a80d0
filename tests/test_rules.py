"""Literal cases for the sales rules (re-expressed from the reference's unit tests, plus the
edge cases its data contract implies)."""

from __future__ import annotations

import datetime as dt

import pytest

from quarterdeck.functions.paths import (
    build_target_path,
    normalise_folder_name,
)
from quarterdeck.operators.rules import (
    add_quarter_hour_bucket,
    apply_enhanced_quantity,
    calculate_net_sales,
    require_columns,
)


def test_net_sales_by_status(spark):
    rows = [(100.0, 10.0, 15.0, s) for s in ("completed", "cancelled", "returned")]
    df = spark.createDataFrame(rows, "gross_sales double, discount_amount double, tax_amount double, line_status string")
    assert [r.net_sales for r in calculate_net_sales(df).collect()] == [75.0, 0.0, -75.0]


def test_net_sales_null_and_cased_status_and_bad_money(spark):
    rows = [("100", "10", "15", None), ("100", "10", "15", "Returned"), ("abc", None, "15", "completed")]
    df = spark.createDataFrame(rows, "gross_sales string, discount_amount string, tax_amount string, line_status string")
    out = calculate_net_sales(df).collect()
    assert [r.net_sales for r in out] == [75.0, -75.0, -15.0]
    assert out[2].gross_sales == 0.0 and out[2].discount_amount == 0.0
    assert [r.net_sales_before_status for r in out] == [75.0, 75.0, -15.0]


def test_returned_line_already_negative_stays_negative(spark):
    df = spark.createDataFrame([(-20.0, 0.0, 0.0, "returned")], "gross_sales double, discount_amount double, tax_amount double, line_status string")
    assert calculate_net_sales(df).first().net_sales == -20.0


def test_net_sales_rounds_half_away_from_zero(spark):
    # halves exact in binary; rounding is defined on the binary value (same bits in any engine)
    df = spark.createDataFrame([(0.125, 0.0, 0.0, "completed"), (0.375, 0.0, 0.0, "returned")],
                               "gross_sales double, discount_amount double, tax_amount double, line_status string")
    assert [r.net_sales for r in calculate_net_sales(df).collect()] == [0.13, -0.38]


def test_missing_columns_raise_sorted(spark):
    df = spark.createDataFrame([(1.0,)], "gross_sales double")
    with pytest.raises(ValueError, match=r"Missing required columns: \['discount_amount', 'line_status', 'tax_amount'\]"):
        calculate_net_sales(df)
    with pytest.raises(ValueError):
        require_columns(df, ["x"])


def test_enhanced_quantity(spark):
    rows = [(2, True, False), (1, False, True), (3, False, False)]
    df = spark.createDataFrame(rows, "quantity int, is_priced_product boolean, is_kitchen_instruction boolean")
    assert [r.enhanced_quantity for r in apply_enhanced_quantity(df).collect()] == [2.0, 0.0, 0.0]


def test_enhanced_quantity_nulls_and_bad_text(spark):
    rows = [("x", True, False), (None, True, False), ("4", None, False), ("5", True, None)]
    df = spark.createDataFrame(rows, "quantity string, is_priced_product boolean, is_kitchen_instruction boolean")
    assert [r.enhanced_quantity for r in apply_enhanced_quantity(df).collect()] == [0.0, 0.0, 0.0, 0.0]


def test_quarter_hour_bucket(spark):
    df = spark.createDataFrame([("2026-01-01T10:07:33Z",), ("2026-01-01 23:59:59+00:00",), ("nonsense",)], "transaction_completed_ts string")
    out = add_quarter_hour_bucket(df).collect()
    assert out[0].quarter_hour_key == "10:00"
    assert out[0].quarter_hour_start_ts == dt.datetime(2026, 1, 1, 10, 0)
    assert out[1].quarter_hour_key == "23:45"
    assert out[2].quarter_hour_start_ts is None


def test_quarter_hour_bucket_other_column_and_offset(spark):
    df = spark.createDataFrame([("2026-03-01T10:14:59+01:00",)], "reading_ts string")
    out = add_quarter_hour_bucket(df, "reading_ts").first()
    assert out.quarter_hour_key == "09:00"


def test_folder_name_normalisation(spark):
    cases = {
        "Daily Budget": "dailybudget",
        "Product Hierarchy Corrections": "producthierarchycorrections",
        "Unit Mapping / Override": "unitmapping_override",
        "  __Odd&&Name??__ ": "odd_name",
    }
    df = spark.createDataFrame([(k,) for k in cases], "name string")
    got = {r.name: r.n for r in df.select("name", normalise_folder_name("name").alias("n")).collect()}
    assert got == cases


def test_folder_name_null_raises(spark):
    df = spark.createDataFrame([(None,)], "name string")
    with pytest.raises(Exception, match="must not be None"):
        df.select(normalise_folder_name("name")).collect()


def test_target_path(spark):
    base = "s3a://lake/landing/masters/"
    df = spark.createDataFrame([(base, "Product Hierarchy Corrections", "Product Corrections")], "b string, f string, e string")
    path = df.select(build_target_path("b", "f", "e").alias("p")).first().p
    assert path.endswith("/masters/producthierarchycorrections/productcorrections")
