from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from quarterdeck.llm.spelling import checksums, corpus_words, group_spellings, near_words

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute_counts(rows, least_length=5, least_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def brute_near(counts):
    """Near words by what is left when one code point goes or is masked."""
    near, masked = defaultdict(set), defaultdict(set)
    for word in counts:
        for i in range(len(word)):
            masked[word[:i] + "\0" + word[i + 1:]].add(word)
            shorter = word[:i] + word[i + 1:]
            if shorter in counts:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in masked.values():
        for word in group:
            near[word] |= group - {word}
    return near


def brute(rows):
    counts = brute_counts(rows)
    near, form = brute_near(counts), {}
    for word, n in counts.items():
        best = min(near[word], key=lambda x: (-counts[x], x), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, form[word], root, n, len(near[word]), counts.get(form[word])))
    return sorted(out, key=lambda r: r[0])


def got(docs, **options):
    return sorted((tuple(r) for r in group_spellings(docs, **options).collect()), key=lambda r: r[0])


def test_checksums():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.choice([1, 2, 9, 31, 63, 64, 65, 200]))) for _ in range(300)]
    prefix = [f"{rnd.randrange(10**rnd.randrange(1, 12))}:".encode() for _ in words]
    out = checksums(np.array([zlib.crc32(p) for p in prefix], np.uint32), pa.array(words, pa.large_string()), np.arange(len(words)))
    assert list(out) == [zlib.crc32(p + w.encode()) for p, w in zip(prefix, words)]


def test_near_words_of_all_lengths(spark):
    rnd = random.Random(4)
    for alphabet, longest in (("ab", 7), ("aé", 5), ("abc\U0001f600", 4)):
        words = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randrange(1, longest + 1))) for _ in range(150)})
        counts = {w: rnd.randrange(1, 9) for w in words}
        near = brute_near(counts)
        want = sorted((w, len(x), max(counts[y] for y in x), min(x, key=lambda y: (-counts[y], y))) for w, x in near.items() if x)
        frame = spark.createDataFrame(list(counts.items()), "word string, n long")
        for tile in (1024, 3):
            assert sorted(tuple(r) for r in near_words(frame, tile).collect()) == want


def test_matches_brute_force_on_real_documents(real_docs):
    rows = [(r.doc_id, r.text) for r in real_docs.collect()]
    want = brute(rows)
    assert got(real_docs) == want
    assert sum(r[1] is not None for r in want) > 100 and any(r[1] is not None and r[2] != r[1] for r in want)


def test_small_tiles_give_the_same(make_docs):
    rnd = random.Random(9)
    base = ["".join(rnd.choice("xyzàÿ") for _ in range(rnd.randrange(5, 9))) for _ in range(40)]
    rows = []
    for i in range(600):
        word = rnd.choice(base[: rnd.randrange(1, 40)])
        if rnd.random() < 0.5:
            at = rnd.randrange(len(word))
            word = word[:at] + rnd.choice(["", "x", "qx", word[at] + "y"]) + word[at + 1:]
        rows.append((i % 37, rnd.choice([word, word.upper(), f"{word}×1{word}"])))
    docs = make_docs(rows).repartition(7)
    want = brute(rows)
    assert got(docs) == want and got(docs, tile_words=5) == want


def test_edges(make_docs):
    long = "q" * 70_000
    rows = [(None, "Hello hello héllo"), (None, "hello hellos"), (3, None), (4, ""), (5, "hellos HELLOS hellos"), (6, "héllo"), (6, "héllo"), (7, f"{long} {long}x {long}")]
    rows += [(7, f"{long} {long}x {long}x"), (8, "a1b2c3 word word word - ×÷×÷× ×÷×÷× ×÷×÷×")]
    docs = make_docs(rows).selectExpr("*", "1 AS word", "2 AS n", "3 AS token")
    want = brute(rows)
    assert got(docs) == want and {w[0] for w in want} >= {"hello", "hellos", "×÷×÷×"}
    assert got(docs.where("1 = 0")) == []
    assert got(make_docs([(1, None), (2, "one two")])) == []
    assert {(r.word, r.n) for r in corpus_words(docs).collect()} == set(brute_counts(rows).items())
