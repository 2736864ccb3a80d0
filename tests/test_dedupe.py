"""Latest-version selection: literal case, decisions and properties."""

from __future__ import annotations

import random


from quarterdeck.operators.dedupe import (
    dedupe_reposted_sales_lines,
    latest_master_snapshot,
    superseded_versions,
)

SCHEMA = ("business_date string, transaction_id string, transaction_line_id string, source_sequence long, "
          "source_update_ts string, extraction_ts string, discount_amount double")


def test_keeps_latest_repost(spark):
    rows = [
        ("2026-01-01", "T1", "T1-001", 1, "2026-01-01T10:00:00Z", "2026-01-01T11:00:00Z", 1.0),
        ("2026-01-01", "T1", "T1-001", 2, "2026-01-01T12:00:00Z", "2026-01-01T13:00:00Z", 2.5),
    ]
    out = dedupe_reposted_sales_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 1 and out[0].discount_amount == 2.5


def test_order_by_update_then_extraction_and_mixed_text(spark):
    rows = [
        ("d", "T", "L", 1, "2026-01-01T10:00:00Z", "2026-01-01 12:00:00", 1.0),
        ("d", "T", "L", 1, "2026-01-01 11:00:00", "2026-01-01T09:00:00Z", 2.0),
        ("d", "T", "L", 1, "2026-01-01T11:00:00Z", "2026-01-01T10:00:00Z", 3.0),
    ]
    assert dedupe_reposted_sales_lines(spark.createDataFrame(rows, SCHEMA)).first().discount_amount == 3.0


def test_null_sequence_loses(spark):
    rows = [("d", "T", "L", None, "2026-01-02T00:00:00Z", "2026-01-02T00:00:00Z", 9.0),
            ("d", "T", "L", 1, "2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z", 1.0)]
    assert dedupe_reposted_sales_lines(spark.createDataFrame(rows, SCHEMA)).first().discount_amount == 1.0


def test_full_tie_is_deterministic_and_order_independent(spark):
    base = [("d", "T", "L", 1, "2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z", float(v)) for v in range(6)]
    picks = set()
    for seed in range(4):
        rows = base[:]
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        picks.add(dedupe_reposted_sales_lines(df).first().discount_amount)
    assert len(picks) == 1


def test_idempotent_and_superseded(spark):
    rows = [("d", "T", "L", s, "2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z", float(s)) for s in (1, 2, 3)]
    rows += [("d", "T", "M", 1, "2026-01-01T00:00:00Z", "2026-01-01T00:00:00Z", 7.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = dedupe_reposted_sales_lines(df)
    twice = dedupe_reposted_sales_lines(once)
    assert sorted(once.collect()) == sorted(twice.collect())
    sup = superseded_versions(df).collect()
    assert sorted(r.source_sequence for r in sup) == [1, 2]
    assert once.count() + len(sup) == df.count()


def test_latest_master_snapshot(spark):
    rows = [("P1", "old", "20260101000000"), ("P2", "old", "20260101000000"),
            ("P1", "new", "20260102000000")]
    df = spark.createDataFrame(rows, "product_id string, product_name string, _file_stamp string")
    out = latest_master_snapshot(df, ["product_id"]).collect()
    assert [(r.product_id, r.product_name) for r in out] == [("P1", "new")]
