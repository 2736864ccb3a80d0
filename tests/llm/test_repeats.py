from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from quarterdeck.llm import repeats
from quarterdeck.llm.repeats import repeat_report, repeated_windows
from quarterdeck.llm.suffix_sort import common_prefixes, smaller_than_next, suffix_order


def brute(texts, length=200):
    seen = {}
    for t in texts:
        for j in range(len(t) - length + 1):
            seen[t[j : j + length]] = seen.get(t[j : j + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for j in range(len(t) - length + 1):
            if seen[t[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(make_docs, rows):
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeat_report(make_docs(rows)).collect())
    want = sorted((d, *x) for (d, _), x in zip(rows, brute([(t or "").encode() for _, t in rows]), strict=True))
    assert got == want


@pytest.mark.parametrize("alphabet", [b"ab", b"aab\x00", b"abcdefgh \xff", b"a"])
def test_two_stage_order(alphabet):
    rnd = random.Random(11)
    for _ in range(150):
        raw = bytes(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 90)))
        text = np.frombuffer(raw, np.uint8)
        for depth in (6, 128):
            order = suffix_order(text, depth)
            keys = [(raw[i:] + bytes(depth))[:depth] for i in order]
            assert sorted(order) == list(range(len(raw))) and keys == sorted(keys)
            lcp = common_prefixes(text, order, depth)
            padded = raw + bytes(depth + 8)
            for k, (i, j) in enumerate(zip(order[:-1], order[1:], strict=True)):
                n = 0
                while n < depth and padded[i + n] == padded[j + n]:
                    n += 1
                assert lcp[k] == n
        flags = smaller_than_next(text)
        assert [raw[i:] < raw[i + 1 :] for i in range(len(raw))] == list(flags)


def test_repeated_windows_of_a_block():
    rnd = random.Random(2)
    core = bytes(rnd.randrange(97, 120) for _ in range(30))
    raws = [bytes(rnd.randrange(97, 120) for _ in range(9)) + core + bytes([65 + i]) * 5 for i in range(4)]
    found = repeated_windows(raws, 20)
    for flags, raw in zip(found, raws, strict=True):
        want = [sum(r.count(raw[j : j + 20]) for r in raws) > 1 for j in range(len(raw) - 19)]
        assert list(flags) == want


def test_matches_brute_force_on_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeat_report(docs).collect())
    assert got == sorted((d, *x) for (d, _), x in zip(rows, brute([t.encode() for _, t in rows]), strict=True))


def planted():
    rnd = random.Random(9)

    def prose(n):
        return "".join(rnd.choice("abcdefghij klmnop qrstu é") for _ in range(n))

    passage, other = prose(260), prose(199)
    rows = [prose(rnd.randrange(0, 400)) + passage[rnd.randrange(40) :] + prose(rnd.randrange(0, 300)) for _ in range(25)]
    rows += [other + prose(50), prose(50) + other, "x" * 200, "x" * 201, "y" * 200, "The " * 300, "", None, prose(100)]
    rows += [rows[0], rows[3][:230], passage + passage]
    return list(enumerate(rows))


def test_planted_passages_edges_and_repeats(make_docs):
    rows = planted()
    check(make_docs, rows + [rows[5], rows[29]])


def test_hot_anchors_are_split_by_window(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK_SEGMENTS", 3)
    check(make_docs, planted())


def test_long_text_empty_table_and_clashing_columns(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 4096)
    rnd = random.Random(1)
    long = "".join(rnd.choice("abcdef ") for _ in range(40_000))
    rows = [(1, long), (2, "q" + long[9_000:9_400] + "z"), (3, long[:100])]
    df = make_docs(rows).selectExpr("*", "1 AS content", "2 AS anchor", "3 AS parts")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeat_report(df).collect())
    assert got == [(d, *x) for (d, _), x in zip(rows, brute([t.encode() for _, t in rows]), strict=True)]
    assert repeat_report(make_docs([]).where("1 = 0")).count() == 0
