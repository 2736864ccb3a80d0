from __future__ import annotations

import re

import numpy as np
import pytest

from quarterdeck.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def check(docs, rows, tolerance):
    got = mixing.mix_sources(docs).toPandas()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    target = brute_targets(sizes) if rows else {}
    assert len(got) == len(rows)
    for r in got.itertuples():
        source = None if r.source is None or r.source != r.source else r.source
        assert r.source_size == sizes[source] and r.target == pytest.approx(target[source])
        assert r.taken in (0, r.size, 2 * r.size) and r.copies in (0, 1, 2)
    for source, part in got.groupby("source", dropna=False):
        key = None if source != source else source
        assert abs(part.taken.sum() - target[key]) <= tolerance(part)
    return got


def test_every_source_meets_its_target(spark, real_docs):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in real_docs.collect()]
    got = check(real_docs, rows, lambda part: 0.01 * part.target.iloc[0] + 20)
    share = got.groupby("source").copies.sum() / (got.groupby("source").doc_id.count() * got.groupby("source").target.first() / got.groupby("source").source_size.first())
    assert share.between(0.9, 1.1).all()  # documents are balanced as well
    again = mixing.mix_sources(real_docs.repartition(7)).toPandas()
    assert dict(zip(got.doc_id, got.taken, strict=True)) == dict(zip(again.doc_id, again.taken, strict=True))


def test_levels_of_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rnd = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rnd.integers(1, 60))), "en", "hot" if i % 3 else f"s{i % 9}") for i in range(1500)]
    check(make_docs([(*r, len(r[1])) for r in rows]), rows, lambda part: 60)


def test_flight_keeps_both_totals_and_each_probability():
    rnd = np.random.default_rng(8)
    words = rnd.integers(1, 500, 400).astype(float)
    p, ones = np.full(400, 0.3), np.ones(400)
    drawn = []
    for _ in range(200):
        out = mixing.flight(p, ones, words, rnd.random(400))
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(p.sum()) and out @ words == pytest.approx(p @ words)
        drawn.append(out)
    assert np.abs(np.mean(drawn, axis=0) - 0.3).max() < 0.15


def test_landing_takes_the_nearest_outcome():
    words = np.array([5.0, 9.0, 20.0])
    assert list(mixing.land(np.full(3, 0.5), np.ones(3), words, (1.5, 14.0))) == [1, 1, 0]


def test_nulls_repeats_empty_sources_and_clashing_columns(make_docs):
    rows = [(1, "a b c", "en", None), (1, "a b c", "en", None), (2, None, "en", "e"), (None, "", "en", "e"), (3, "x " * 50_000, "en", "s"), (4, "y z", None, "s"), (None, "q", "en", "é")]
    docs = make_docs([(*r, 0) for r in rows]).selectExpr("*", "1 AS size", "2 AS copies", "3 AS key", "4 AS `_key`", "5 AS target")
    got = check(docs, rows, lambda part: max(2 * part["size"].max(), 1))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == got.copies.sum()
    assert mixing.mix_sources(docs.where("1 = 0")).count() == 0 and mixing.mixed(docs.where("1 = 0")).count() == 0
