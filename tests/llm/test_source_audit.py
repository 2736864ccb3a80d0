from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quarterdeck.llm import source_audit
from quarterdeck.llm.source_audit import Bounds, PerfectHash, audit_sources, term_hashes

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least, top):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows, in plain Python."""
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(UPPER))) for text, lang, source in rows]
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, _, terms in docs:
        df[lang].update(set(terms))
    kept = {lang: sorted(t for t, n in seen.items() if n >= least) for lang, seen in df.items()}
    for lang, source, terms in docs:
        wanted = set(kept[lang])
        counts[lang, source].update(t for t in terms if t in wanted)
        counts[lang, None].update(t for t in terms if t in wanted)
    p = {}
    for (lang, source), n in counts.items():
        total, v = sum(n.values()), len(kept[lang])
        p[lang, source] = {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * v) for t in kept[lang]}
    out = []
    for lang, source in [k for k in p if k[1] is not None]:
        own, whole = p[lang, source], p[lang, None]
        pairs = [(sum(abs(own[t] - x[t]) for t in own), s) for (g, s), x in p.items() if g == lang and s not in (None, source)]
        terms = [(own[t] - whole[t], t) for t in own if counts[lang, source][t] and own[t] > whole[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def got(docs, **options):
    return sorted(tuple(r) for r in audit_sources(docs, **options).collect())


def test_perfect_hash_is_minimal_and_checks_its_keys():
    terms = pa.array([f"t{i}é" for i in range(5000)], pa.large_string())
    known = PerfectHash.build(terms)
    assert sorted(known.slots(terms, term_hashes(terms))) == list(range(5000))
    other = pa.array([f"x{i}" for i in range(5000)], pa.large_string())
    assert (known.slots(other, term_hashes(other)) == -1).all()
    assert len(known.levels) < 30 and known.keys.take(pa.array(known.slots(terms, term_hashes(terms)))).to_pylist() == terms.to_pylist()


def test_terms_of_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(source_audit, "term_hashes", lambda terms: np.array([len(t.as_py()) for t in terms], np.uint64))
    terms = pa.array(["aa", "bb", "c", "dd"])
    known = PerfectHash.build(terms)
    slots = known.slots(terms, source_audit.term_hashes(terms))
    assert sorted(slots) == [0, 1, 2, 3] and known.keys.take(pa.array(slots)).to_pylist() == ["aa", "bb", "c", "dd"]
    other = pa.array(["zz", "y"])
    assert list(known.slots(other, source_audit.term_hashes(other))) == [-1, -1]


def _random_rows(n, seed=5):
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ka", "Lo", "mé", "ß", "日本") for b in ("x", "Y", "zz", "éa", "o", "i")]
    rows = []
    for _ in range(n):
        lang, source = rnd.choice(["en", "en", "en", "de", None, ""]), rnd.choice(["s0"] * 4 + [f"s{i}" for i in range(1, 9)] + [None])
        words = [rnd.choice(vocabulary[: rnd.randrange(5, 30)]) for _ in range(rnd.randrange(0, 40))]
        rows.append((rnd.choice([" ", ", ", "-1_"]).join(words) if rnd.random() < 0.95 else None, lang, source))
    return rows


@pytest.mark.parametrize("bounds", [Bounds(), Bounds(shard_keys=4, round_bytes=150, held_slots=10, slice_terms=3, block_sources=2)])
def test_matches_brute_force(spark, bounds):
    rows = _random_rows(400)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string").repartition(5)
    assert got(docs, least=20, top=4, bounds=bounds) == brute(rows, 20, 4)


def test_real_documents(spark, real_docs):
    rows = [(r.text, r.lang, r.source) for r in real_docs.collect()]
    assert got(real_docs) == brute(rows, 30, 50)


def test_edges(spark, make_docs):
    assert got(make_docs([]).where("1 = 0")) == []
    # no kept term: pairs of value 0, no terms; nulls read as empty; repeated rows count twice
    rows = [("aa bb", None, "a"), (None, "", "b"), ("", None, None), ("aa bb", "", "a")]
    docs = spark.createDataFrame([(1, *r) for r in rows], "doc_id long, text string, lang string, source string")
    clash = docs.selectExpr("*", "1 AS term", "2 AS at", "3 AS n", "4 AS value", "5 AS rank", "6 AS shard")
    assert got(clash, least=3) == brute(rows, 3, 50) and all(r[4] == 0 for r in got(clash, least=3))
    assert got(clash, least=2) == brute(rows, 2, 50)
    long = "Ab " * 400_000 + "cD"
    rows = [(long, "en", "s1"), ("ab cd ab", "en", "s2"), ("cd", "fr", "s1")]
    docs = spark.createDataFrame([(None, *r) for r in rows], "doc_id long, text string, lang string, source string")
    assert got(docs, least=2) == brute(rows, 2, 50)
