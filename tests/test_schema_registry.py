"""Stored schemas: first delivery, drift of later ones, the three rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarterdeck.sources.schema_registry import SchemaDrift, conformed, differences, drift_report, read_tracked, stored_schema

FIRST = "id long, name string, amount double"


def _first(spark):
    return spark.createDataFrame([(1, "a", 1.5), (2, None, None)], FIRST)


def _later(spark):
    return spark.createDataFrame([("3", "2.5", "x"), ("4", "n/a", None), (None, None, "y")], "ID string, amount string, loyalty string")


def test_first_read_stores_the_schema(spark, tmp_dir):
    registry = f"{tmp_dir}/registry"
    assert stored_schema(spark, registry, "s") is None
    got = read_tracked(spark, registry, "s", _first(spark))
    assert got.columns == ["id", "name", "amount", "_rescued"] and got.where("_rescued IS NOT NULL").count() == 0
    assert stored_schema(spark, registry, "s") == (1, _first(spark).schema)
    assert stored_schema(spark, registry, "other") is None


def test_drift_names_every_change_and_counts_its_rows(spark):
    stored = _first(spark).schema
    assert differences(stored, stored) == []
    assert {(n, c) for n, c, _, _ in differences(stored, _later(spark).schema)} == {("id", "retyped"), ("name", "missing"), ("amount", "retyped"), ("loyalty", "added")}
    rows = {r.column_name: (r.change, r.stored_type, r.found_type, r.rows_affected) for r in drift_report(_later(spark), stored).collect()}
    assert rows == {
        "id": ("retyped", "bigint", "string", 0), "name": ("missing", "string", None, 3),
        "amount": ("retyped", "double", "string", 1), "loyalty": ("added", None, "string", 2),
    }
    assert drift_report(_first(spark), stored).count() == 0


def test_evolve_adds_columns_and_rescues_what_does_not_fit(spark, tmp_dir):
    registry = f"{tmp_dir}/registry"
    read_tracked(spark, registry, "s", _first(spark))
    got = {r.id: r for r in read_tracked(spark, registry, "s", _later(spark), "evolve").collect()}
    assert (got[3].amount, got[3].name, got[3].loyalty, got[3]._rescued) == (2.5, None, "x", None)
    assert got[4].amount is None and got[4]._rescued == '{"amount":"n/a"}'
    version, schema = stored_schema(spark, registry, "s")
    assert version == 2 and [(f.name, f.dataType.simpleString()) for f in schema] == [("id", "bigint"), ("name", "string"), ("amount", "double"), ("loyalty", "string")]
    # the first form still reads, with the new column empty, and nothing drifts back
    again = read_tracked(spark, registry, "s", _first(spark), "evolve")
    assert again.columns[:4] == ["id", "name", "amount", "loyalty"] and again.where("loyalty IS NOT NULL").count() == 0
    assert stored_schema(spark, registry, "s")[0] == 2


def test_strict_and_rescue(spark, tmp_dir):
    registry = f"{tmp_dir}/registry"
    read_tracked(spark, registry, "s", _first(spark))
    with pytest.raises(SchemaDrift, match="loyalty added"):
        read_tracked(spark, registry, "s", _later(spark), "strict")
    assert read_tracked(spark, registry, "s", _first(spark).select("amount", "name", "id"), "strict").count() == 2  # order is no drift
    got = read_tracked(spark, registry, "s", _later(spark), "rescue")
    assert got.columns == ["id", "name", "amount", "_rescued"]
    assert sorted(r[0] for r in got.select("_rescued").where("_rescued IS NOT NULL").collect()) == ['{"amount":"n/a"}', '{"loyalty":"x"}', '{"loyalty":"y"}'] or {
        r.id: r._rescued for r in got.collect()
    } == {3: '{"loyalty":"x"}', 4: '{"amount":"n/a"}', None: '{"loyalty":"y"}'}
    assert stored_schema(spark, registry, "s")[0] == 1
    with pytest.raises(ValueError, match="unknown rule"):
        read_tracked(spark, registry, "s", _first(spark), "guess")


def test_odd_names_and_empty_deliveries(spark):
    odd = spark.createDataFrame([(1, 2)], "`a.b` int, `c d` int")
    stored = spark.createDataFrame([], "`a.b` long, z string").schema
    got = conformed(odd, stored).first()
    assert got["a.b"] == 1 and got["z"] is None and got["_rescued"] == '{"c d":"2"}'
    assert {r.column_name: r.rows_affected for r in drift_report(odd.where(F.lit(False)), stored).collect()} == {"a.b": 0, "c d": 0, "z": 0}
