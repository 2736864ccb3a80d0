"""Key checks from the control table, JSON-lines round trips, the table registry."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators.quality import key_checks
from quarterdeck.plans.catalog import _control_frame
from quarterdeck.schemas import TABLES
from quarterdeck.sources import tables
from quarterdeck.sources.files import read_json_lines, split_corrupt, write_json_lines


def test_key_checks_count_repeats_and_nulls_per_entity(spark):
    frames = {
        "a": spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, "x"), (None, "x"), (2, None)], "k long, l string"),
        "b": spark.createDataFrame([], "k long"),
    }
    control = _control_frame(spark, [
        {"source_table": "a", "target_entity": "first", "primary_key_columns": " k ,l"},
        {"source_table": "b", "target_entity": "second", "primary_key_columns": "k"},
        {"source_table": "missing", "target_entity": "third", "primary_key_columns": "k", "is_active": False},
    ])
    got = [tuple(r) for r in key_checks(control, frames.__getitem__).orderBy("target_entity").collect()]
    assert got == [("first", "k,l", 6, 2, 1, 1, 3), ("second", "k", 0, 0, 0, 0, 0)]
    wrong = _control_frame(spark, [{"source_table": "a", "target_entity": "x", "primary_key_columns": "nope"}])
    with pytest.raises(ValueError, match="nope"):
        key_checks(wrong, frames.__getitem__)
    with pytest.raises(ValueError, match="no active entity"):
        key_checks(control.where("NOT is_active"), frames.__getitem__)


def test_json_lines_round_trip_and_rejects(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "é \"q\" \n,", 1.5, True), (2, None, None, None)], "id long, t string, d double, b boolean")
    rows = rows.withColumns({"day": F.lit("2026-01-02").cast("date"), "at": F.lit("2026-01-02 03:04:05.678901").cast("timestamp"), "wall": F.lit("2026-01-02 03:04:05.678901").cast("timestamp_ntz")})
    write_json_lines(rows, f"{tmp_dir}/j")
    spark.createDataFrame([('{"id": 3, "t": "cut',), ("no json at all",), ('{"id": "text"}',)], "value string").write.mode("append").text(f"{tmp_dir}/j")
    good, bad = split_corrupt(read_json_lines(spark, f"{tmp_dir}/j", rows.schema).cache())
    assert sorted(good.collect()) == sorted(rows.collect())
    assert sorted(r[0] for r in bad.collect()) == sorted(["no json at all", '{"id": "text"}', '{"id": 3, "t": "cut'])


def test_writers_take_their_mode_from_the_registry(spark, tmp_dir):
    one = spark.range(3)
    for _ in range(2):
        tables.write_table(one, tmp_dir, "silver_dim_unit")  # overwrite
        tables.write_table(one, tmp_dir, "bronze_master_files/unit")  # append
    assert spark.read.parquet(f"{tmp_dir}/silver_dim_unit").count() == 3
    assert spark.read.parquet(f"{tmp_dir}/bronze_master_files/unit").count() == 6
    with pytest.raises(ValueError, match="upsert"):
        tables.write_table(one, tmp_dir, "silver_sales_line_items_deduped")
    with pytest.raises(KeyError, match="nowhere"):
        tables.batch_mode("nowhere")


def test_properties_come_back_from_the_catalog(spark, tmp_dir):
    path = tables.write_table(spark.range(2), tmp_dir, "gold_discount_strategy")
    for _ in range(2):
        tables.declare_table(spark, "qd_test", "gold_discount_strategy", path)
    row = tables.declared_tables(spark, "qd_test").first()
    assert (row.table_name, row.layer, row.write_mode) == ("gold_discount_strategy", "gold", "overwrite")
    assert row.comment == TABLES["gold_discount_strategy"]["comment"] and spark.table("qd_test.gold_discount_strategy").count() == 2
    spark.sql("DROP DATABASE qd_test CASCADE")
    assert spark.read.parquet(path).count() == 2
