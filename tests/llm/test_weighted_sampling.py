from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quarterdeck.llm.weighted_sampling import SAMPLES, compare_neighbours, edited, fingerprint_documents, fingerprints, written


@pytest.mark.parametrize("share", [0.2, 0.5, 0.9])
def test_collisions_estimate_generalised_jaccard(share):
    rnd = random.Random(share)
    words = [f"w{rnd.randrange(60)}" for _ in range(400)]
    cut = int(400 * share)
    other = words[:cut] + [f"w{rnd.randrange(60, 110)}" for _ in range(400 - cut)]
    a, b = Counter(words), Counter(other)
    jaccard = sum(min(a[k], b[k]) for k in a | b) / sum(max(a[k], b[k]) for k in a | b)
    one, two = fingerprints([" ".join(words), " ".join(other)], 6000)
    assert abs((one == two).mean() - jaccard) < 0.03


def test_fingerprint_does_not_depend_on_the_block(real_docs):
    texts = [r.text for r in real_docs.limit(40).collect()]
    together = fingerprints(texts)
    for i in (0, 7, 39):
        assert (fingerprints([texts[i]])[0] == together[i]).all()
    assert (fingerprints(["A b\tc"])[0] == fingerprints(["a  b\nC"])[0]).all()


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        changed = edited(text, following)
        f = fingerprints([text, changed, following])
        out.append((str(doc_id), len(text), hashlib.sha256(changed.encode()).hexdigest(), written(f[0]), written(f[1]), (f[0] == f[1]).mean(), (f[0] == f[2]).mean()))
    return sorted(out)


def run(docs):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in compare_neighbours(docs).collect())


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_edges(make_docs):
    rows = [(5, "é" * 10 + " ü x"), (9, None), (9, "same id"), (2, ""), (None, "no id"), (None, None), (1, "word " * 200_000), (-3, "a b c d e f"), (5, "é" * 10 + " ü x")]
    docs = make_docs(rows).selectExpr("*", "1 AS part", "2 AS `to`", "3 AS ghost", "4 AS `_first`")
    assert run(docs) == brute(rows)
    assert run(make_docs([(1, "alone in the table")])) == brute([(1, "alone in the table")])
    assert compare_neighbours(docs.where("1 = 0")).count() == 0
    prints = {r.doc_id: r.fingerprint for r in fingerprint_documents(docs.where("doc_id IN (1, 2)")).collect()}
    assert len(prints[1]) == 8 * SAMPLES and prints[2] == written(np.full(SAMPLES, np.iinfo(np.int32).max, np.int32))
