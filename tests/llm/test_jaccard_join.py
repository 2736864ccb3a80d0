from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from quarterdeck.llm import base, jaccard_join
from quarterdeck.llm.jaccard_join import _leaders, level_bounds, most_apart, pack_tokens, set_tokens, shingle_groups, within_list

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    if len(words) < 3:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 3]) for i in range(len(words) - 2))


def brute(rows):
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in by[g]:
                if j < i:
                    common[j] += 1
        for j, c in common.items():
            if 100 * c >= 90 * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def run(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in shingle_groups(df).collect())


def test_levels_hold_every_link():
    bounds = level_bounds(90, 5000)
    for n in (9, 10, 11, 57, 550, 4999):
        own = int(np.searchsorted(bounds, n, side="right")) - 1
        smallest = -(-90 * n // 100)
        low = int(np.searchsorted(bounds, max(smallest, bounds[0]), side="right")) - 1
        assert own - low <= 1
    assert most_apart(90, 10) == 1 and most_apart(90, 9) == 0


def test_matches_brute_force_on_real_documents(real_docs):
    rows = [(r.doc_id, r.text) for r in real_docs.select("doc_id", "text").collect()]
    assert run(real_docs) == brute(rows)


def test_chains_copies_and_edges(make_docs):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for g in range(30):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([11, 12, 30, 120, 400]))]
        text = list(base)
        for _ in range(rnd.randrange(12)):
            rows.append(" ".join(text))
            for _ in range(max(1, len(text) // rnd.choice([30, 60, 150]))):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                text = text[: -max(1, len(text) // 40)]
    rows += ["", None, "  \t\n", "one", "One", "one two", "ONE TWO", "a b c", "A b C", "É b c", "é b c"]
    pairs = list(enumerate(rows))
    pairs += [(i + 1000, t) for i, t in pairs[::4]]
    assert run(make_docs(pairs)) == brute(pairs)


def test_open_list_finds_links_between_members():
    leader = np.arange(100, dtype=np.uint64)
    left = np.concatenate([leader[12:], np.arange(200, 212, dtype=np.uint64)])
    right = np.sort(np.concatenate([left[1:], np.array([300], np.uint64)]))
    other = np.concatenate([leader[:88], np.arange(400, 412, dtype=np.uint64)])
    found = within_list(leader, [left, other, right], np.array([1, 2, 3]), np.zeros(3, int), (0, 0), 90)
    assert [{i, j} for i, j in found] == [{0, 2}]
    assert within_list(leader, [left, other, right], np.array([1, 2, 1]), np.zeros(3, int), (0, 0), 90) == []


def test_null_ids_repeats_empty_and_clashing_columns(spark, make_docs):
    text = " ".join(f"t{i}" for i in range(40))
    df = make_docs([(None, text), (7, text), (7, text), (3, text + " x"), (None, None), (9, "")])
    df = df.selectExpr("*", "doc_id AS set_key", "1 AS token", "'x' AS owner", "2 AS component")
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in shingle_groups(df).collect()]
    assert sorted(got, key=str) == sorted([(None, 38, 3), (7, 38, 3), (7, 38, 3), (3, 39, 3), (None, 0, None), (9, 0, 9)], key=str)
    assert shingle_groups(make_docs([]).where("1 = 0")).count() == 0


def test_repeated_and_null_ids_with_different_texts(make_docs):
    one, two = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, one), (1, two), (2, one + " tail"), (3, two + " tail"), (None, one + " more"), (None, two + " end end"), (None, "c " * 30), (9, "c " * 31 + "d")]
    apart = [(None, " ".join(f"q{i}" for i in range(50))), (None, " ".join(f"q{i}" for i in range(51)))]
    want = sorted([(1, 1), (1, 1), (2, 1), (3, 1), (None, 1), (None, 1), (None, None), (9, 9), (None, None), (None, None)], key=str)
    for seed in range(3):
        mixed = rows + apart
        random.Random(seed).shuffle(mixed)
        got = shingle_groups(make_docs(mixed).repartition(1 + 3 * seed))
        assert sorted(((r.doc_id, r.component_id) for r in got.collect()), key=str) == want


def test_packed_tokens_give_every_list(spark):
    rnd = random.Random(6)
    blocks = [[(rnd.randrange(1 << 64) if rnd.random() < 0.3 else (rnd.randrange(12) * 0x9E3779B97F4A7C15) % (1 << 64), rnd.randrange(40)) for _ in range(200)] for _ in range(5)]
    holders = defaultdict(set)
    for token, key in (x for b in blocks for x in b):
        holders[token].add(key)
    want = {(k, min(h)) for h in holders.values() for k in h if k != min(h)}
    for buckets in (1, 7):
        packed = pa.Table.from_batches([pack_tokens(np.array([t for t, _ in b], np.uint64), np.array([k for _, k in b], np.int64), buckets) for b in blocks])
        ordered = packed.sort_by([("bucket", "ascending"), ("passing", "ascending")])
        found = pa.Table.from_batches(list(_leaders(iter(ordered.to_batches(max_chunksize=3)))))
        assert set(zip(found["member"].to_pylist(), found["leader"].to_pylist(), strict=True)) == want


def test_near_copies_over_many_blocks(make_docs, monkeypatch):
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        text = list(base)
        for _ in range(rnd.randrange(4)):
            text[rnd.randrange(150)] = f"x{rnd.randrange(50)}"
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 7)
    assert run(make_docs(rows).repartition(6)) == brute(rows)


@pytest.mark.parametrize("size", [300_000])
def test_very_long_text(make_docs, size):
    text = " ".join(str(i) for i in range(size))
    got = run(make_docs([(1, text), (2, text + " tail"), (3, "short text here")]))
    assert got == [(1, size - 2, 1), (2, size - 1, 1), (3, 1, 3)]


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_token(percent):
    rnd = np.random.default_rng(percent)
    bounds = level_bounds(percent, 5000)
    shared = 0
    for _ in range(3000):
        n = int(rnd.integers(1, 60)) if rnd.random() < 0.8 else int(rnd.integers(60, 900))
        one = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        gone, new = (int(x) for x in rnd.integers(0, 2 + n * (100 - percent) // 100, 2))
        other = np.unique(np.concatenate([rnd.permutation(one)[gone:], rnd.integers(0, 1 << 63, new, dtype=np.uint64)]))
        common = np.intersect1d(one, other).size
        if common and not np.array_equal(one, other) and 100 * common >= percent * (one.size + other.size - common):
            assert np.intersect1d(set_tokens(one, percent, bounds), set_tokens(other, percent, bounds)).size
            shared += 1
    assert shared > 300


def test_a_few_texts_are_fetched_without_a_bitmap(make_docs, monkeypatch):
    words = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join([*words[: 40 + i % 20], *words[60 - i % 7:]])) for i in range(60)] + [(i, f"other text {i} here") for i in range(60, 90)] + [(7, words[0])]
    calls, bitmap = [], jaccard_join.bitmap
    monkeypatch.setattr(jaccard_join, "bitmap", lambda *a: calls.append(a) or bitmap(*a))
    assert run(make_docs(rows)) == brute(rows) and not calls
    monkeypatch.setattr(base, "BROADCAST_KEYS", 0)
    assert run(make_docs(rows)) == brute(rows) and calls
