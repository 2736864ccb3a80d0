from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

from quarterdeck.llm import base, quality
from quarterdeck.llm.base import read


def test_scores_match_densities_written_out():
    rnd = np.random.default_rng(4)
    xs = [rnd.normal(size=(60, 3)), rnd.normal(loc=2, scale=2, size=(90, 3))]
    count = np.array([len(x) for x in xs], float)
    model = quality.discriminant(count, np.stack([x.sum(0) for x in xs]), np.stack([x.T @ x for x in xs]), pooling=0.2, ridge=0.1)
    point = rnd.normal(size=(5, 3))
    covariances = [np.cov(x.T, bias=True) for x in xs]
    pooled = (count[0] * covariances[0] + count[1] * covariances[1]) / count.sum()
    logs = []
    for x, own in zip(xs, covariances, strict=True):
        shrunk = 0.8 * own + 0.2 * pooled
        shrunk = 0.9 * shrunk + 0.1 * np.trace(shrunk) / 3 * np.eye(3)
        away = point - x.mean(0)
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", away, np.linalg.inv(shrunk), away) + np.log(np.linalg.det(shrunk))))
    odds = np.log(90.5) - np.log(60.5)
    assert np.allclose(model.score(point), 1 / (1 + np.exp(-(logs[1] - logs[0] + odds))))


def test_held_out_accuracy_and_hold_out_rule(spark):
    sf = "/root/testdata/sf0.01"
    rows = quality.quality_scores(read(spark, sf, "documents"), read(spark, sf, "labels")).toPandas()
    assert len(rows) == 1000 and rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.3)).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(rows.doc_id, rows.held_out, strict=True))
    both = rows.merge(read(spark, sf, "labels").toPandas(), on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95


def test_nulls_empty_long_repeats_and_clashing_columns(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 1), (3, 1, 0), (3, 0, 0), (None, 1, 0), (4, None, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "good words here"), (1, "good words here"), (2, "!! !! !!"), (None, "free"), (6, None), (7, ""), (8, "ab " * 300_000)])
    docs = docs.selectExpr("*", "0.0 AS score", "'p' AS predicted", "1 AS x", "2 AS label")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    kept = quality.scored(docs, quality.fit(docs, labels))
    assert sorted(kept.columns) == sorted([c for c in docs.columns])
    none = quality.quality_scores(docs, labels.where("1 = 0")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(docs.where("1 = 0"), labels).count() == 0


@pytest.mark.parametrize("text", [b"", b"a", b"\n\n", b"one two\none two\nthree"])
def test_statistics_do_not_depend_on_the_block(text):
    other = "Ärger! 123 | x\ny".encode()
    alone = quality.statistics(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    data = np.frombuffer(other + text + other, np.uint8)
    cuts = np.cumsum([0, len(other), len(text), len(other)])
    assert np.allclose(alone[0], quality.statistics(data, cuts)[1])


def test_a_few_labels_are_learnt_in_one_python_step(spark, make_docs, monkeypatch):
    rnd = np.random.default_rng(7)
    docs = make_docs([(i, " ".join(rnd.choice(["a", "Bc", "d1", "e!", "\n"], 30 + i % 9))) for i in range(80)] + [(3, "again"), (None, "x"), (5, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 80, 2)] + [(i, int(i % 3 == 0)) for i in range(1, 60)] + [(None, 1)], "doc_id long, quality int")
    plans, collect = [], type(docs).collect

    def seen(frame):
        plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return collect(frame)

    monkeypatch.setattr(type(docs), "collect", seen)
    few = quality.fit(docs, labels)
    assert len(re.findall("MapInArrow|MapInPandas|ArrowEvalPython", plans[-1])) == 1
    monkeypatch.setattr(base, "BROADCAST_KEYS", 0)
    many = quality.fit(docs, labels)
    assert len(re.findall("MapInArrow|MapInPandas|ArrowEvalPython", plans[-1])) == 3
    for name in ("means", "factors", "log_dets", "log_odds"):
        assert np.allclose(getattr(few, name), getattr(many, name))
