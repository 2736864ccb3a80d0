from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quarterdeck.llm import language_id
from quarterdeck.llm.language_id import LanguageModel, calibrated, follow_the_leader, gram_counts, language_report


def test_held_out_accuracy(real_docs):
    rows = language_report(real_docs).toPandas().merge(real_docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(rows) == 1000 and rows.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 3 == 1) for d, h in zip(rows.doc_id, rows.held_out, strict=True))
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert set(rows.lang_pred) <= {"de", "en", "es", "fr", "und"}


def test_counts_of_pieces_equal_those_of_the_whole(monkeypatch):
    text = "Über große Bäume, 12 km " * 50
    whole = gram_counts(text)
    for size in (7, 100, 333):
        monkeypatch.setattr(language_id, "_PIECE", size)
        at, count = gram_counts(text)
        assert (at == whole[0]).all() and (count == whole[1]).all()
    assert whole[1].sum() == 3 * len(text) - 3
    assert gram_counts("")[0].size == 0


def test_regularisation_gives_sparse_weights_and_learns():
    rnd = np.random.default_rng(2)
    rows = []
    for i in range(300):
        label = i % 3
        at = np.unique(np.concatenate(([label * 10 + rnd.integers(10)], rnd.integers(100, 4000, 5))))
        rows.append((at, np.full(at.size, at.size**-0.5), label))
    weights = follow_the_leader(rows, 3)
    assert (weights != 0).mean() < 0.1
    right = [int(np.argmax(v @ weights[a])) == y for a, v, y in rows]
    assert np.mean(right) > 0.95


def test_temperature_softens_false_certainty():
    scores = np.array([[20.0, 0.0]] * 10)
    labels = np.array([0] * 7 + [1] * 3)
    chance = language_id.softmax(scores / calibrated(scores, labels))[0, 0]
    assert 0.6 < chance < 0.8
    assert calibrated(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_undetermined_nulls_repeats_and_clashing_columns(make_docs):
    rows = [(i, "the cat and the dog went over the hill " * 3, "en") for i in range(40)] + [(i, "der Hund und die Katze gingen über den Berg " * 3, "de") for i in range(40, 80)]
    rows += [(90, None, "en"), (91, "", None), (92, "123 !? ---", "xx"), (None, "the dog", "en"), (93, "die Katze " * 100_000, None), (93, "die Katze", None)]
    docs = make_docs([(d, t, lang, "s") for d, t, lang in rows]).selectExpr("*", "1 AS score", "2 AS turn", "3 AS lang_pred", "4 AS at")
    got = language_report(docs).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, set()).add(r.lang_pred)
    assert len(got) == len(rows) and found[90] == found[91] == found[92] == {"und"}
    assert found[93] == {"de"} and found[0] == {"en"} and found[50] == {"de"}
    assert {r.lang_pred for r in language_report(docs.withColumn("lang", docs.lang.substr(9, 1)).where("lang <> lang OR lang IS NULL")).collect()} <= {"", "und", "de"}
    assert language_report(docs.where("1 = 0")).count() == 0
    assert LanguageModel([], np.zeros(1), np.zeros((1, 0)), 1.0).predict("text") == ("und", 0.0)


def brute_counts(text):
    """Hashed 1- to 3-grams of a text, one by one with Python integers."""
    low, counts, mask = text.lower(), {}, 0xFFFFFFFF
    codes = [ord(c) if ord(c) >= 0xAA or "a" <= c <= "z" else 32 for c in low]
    for begin in range(len(codes)):
        code = 0
        for order in range(1, language_id.ORDERS + 1):
            if begin + order > len(codes):
                break
            code = ((code ^ (codes[begin + order - 1] * 2654435761 & mask)) * 2246822519 + order) & mask
            feature = ((code ^ (code >> 15)) & mask) >> 17
            counts[feature] = counts.get(feature, 0) + 1
    return counts


def brute_fit(rows, classes, epochs):
    """Follow the regularised leader, one coordinate at a time, from its definition."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(key):
        if abs(z[key]) <= language_id.LAMBDA_1:
            return 0.0
        shrunk = z[key] - math.copysign(language_id.LAMBDA_1, z[key])
        return -shrunk / ((language_id.BETA + math.sqrt(n[key])) / language_id.ALPHA + language_id.LAMBDA_2)

    for _ in range(epochs):
        for at, value, label in rows:
            row = [*zip(at.tolist(), value.tolist(), strict=True), (language_id.DIMENSIONS, 1.0)]
            w = {(i, k): weight((i, k)) for i, _ in row for k in range(classes)}
            power = [math.exp(sum(v * w[i, k] for i, v in row)) for k in range(classes)]
            for i, v in row:
                for k in range(classes):
                    g = v * (power[k] / sum(power) - (k == label))
                    sigma = (math.sqrt(n[i, k] + g * g) - math.sqrt(n[i, k])) / language_id.ALPHA
                    z[i, k] += g - sigma * w[i, k]
                    n[i, k] += g * g
    return {key: weight(key) for key in z}


def test_fit_matches_the_definition():
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(40):
        at = np.unique(rnd.integers(0, 30, 6))
        rows.append((at, rnd.random(at.size), i % 3))
    weights = follow_the_leader(rows, 3, epochs=2)
    want = brute_fit(rows, 3, 2)
    for (i, k), value in want.items():
        assert abs(weights[i, k] - value) < 1e-9
    assert (weights != 0).sum() == sum(v != 0 for v in want.values())


def test_features_match_a_count_one_by_one():
    for text in ("", "a", "Straße 12!", "Über größe  Bäume\tΩ 日本 ½", "THE the The"):
        at, count = gram_counts(text)
        assert dict(zip(at.tolist(), count.tolist(), strict=True)) == brute_counts(text)


@pytest.mark.parametrize("text, wanted", [("½ ²", False), ("①Ⅷ", False), ("123 _-", False), ("", False), ("1a", True), ("日", True), ("é", True), ("ª", True)])
def test_letters(text, wanted):
    assert language_id.has_letter(text) is wanted
    model = LanguageModel(["en", "de"], np.ones(language_id.DIMENSIONS), np.zeros((language_id.DIMENSIONS + 1, 2)), 1.0)
    assert (model.predict(text)[0] != "und") is wanted


def test_sample_is_bounded_and_does_not_depend_on_partitions(spark, make_docs, monkeypatch):
    rows = [(i, f"the cat {i} and the dog", "en") for i in range(400)] + [(7, "one hot row", "en")] * 300 + [(i, f"der Hund {i} und die Katze", "de") for i in range(1000, 1030)]
    docs = make_docs([(d, t, lang, "s") for d, t, lang in rows])
    models = [language_id.fit(docs.repartition(n), per_language=20) for n in (1, 7)]
    assert (models[0].weights == models[1].weights).all() and models[0].temperature == models[1].temperature
    assert models[0].languages == ["de", "en"]
