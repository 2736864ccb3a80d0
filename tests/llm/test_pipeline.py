from __future__ import annotations

import random

import corpus_pipeline
import __spark_entry__
from quarterdeck.llm import decontamination, jaccard_join, mixing, quality
from quarterdeck.llm.base import read, staged

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_hold_against_their_operators(spark):
    docs = read(spark, SF, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(staged(stage(spark, frames[-1], SF), "test-" + name.replace(" ", "-")))
    start, good, alone, clean, mix, shards = frames
    assert all(f.columns == COLUMNS for f in frames[:-1])
    model = quality.fit(start, read(spark, SF, "labels"))
    wanted = {r.doc_id for r in quality.scored(start, model).collect() if r.score >= 0.3}
    assert {r.doc_id for r in good.collect()} == wanted
    first = {r.component_id for r in jaccard_join.shingle_groups(good, width=5, percent=80).collect()}
    assert sorted(r.doc_id for r in alone.collect()) == sorted(first)
    leaks = {r.doc_id for r in decontamination.find_leaks(alone, read(spark, SF, "benchmark")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in alone.collect()} - leaks
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(clean).collect() if r.copies}
    got = {}
    for r in mix.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == copies
    assert sorted(r.doc_id for r in shards.collect()) == sorted(r.doc_id for r in mix.collect())
    assert set(shards.columns) >= {"doc_id", "size", "text_crc32", "law", "shard", "slot"}


def test_registered_and_on_an_empty_table(spark, make_docs):
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    empty = make_docs([]).where("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        empty = staged(stage(spark, empty, SF), "test-empty")
        assert empty.count() == 0


def test_one_of_each_group_stays(make_docs):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(5, text), (3, text + " more"), (3, text + " more"), (None, text), (8, ""), (8, ""), (9, None), (7, "other words entirely")]
    kept = jaccard_join.deduplicated(make_docs(rows).selectExpr("*", "1 AS `_key`", "2 AS component_id")).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == [(3, text + " more"), (7, "other words entirely")]
    assert sorted(r.doc_id for r in kept if not r.text) == [8, 8, 9]


def _five_word_first(rows):
    """The smallest id of each component of texts whose 5-word shingle sets have a Jaccard of 0.8, by brute force."""
    sets = [{tuple(t.lower().split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))} for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 100 * len(x & y) >= 80 * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted(least.values())


def test_near_duplicate_stage_holds_five_words_and_four_fifths(spark, make_docs):
    rnd = random.Random(3)
    base = [f"v{rnd.randrange(900)}" for _ in range(450)]
    scattered = [f"x{i}" if i % 50 == 25 else w for i, w in enumerate(base)]
    rows = [base, scattered, base[:-50] + [f"y{i}" for i in range(40)], base + [f"z{i}" for i in range(90)], base + [f"u{i}" for i in range(140)]]
    for size in [5, 6, 7, 8, 9, 10, 12, 14, 17, 20, 30, 60, 120]:
        for _ in range(12):
            text = [f"w{rnd.randrange(5000)}" for _ in range(size)]
            rows.append(text)
            for _ in range(3):
                edits = rnd.randrange(1, 2 + size // 30)
                rows.append([f"e{rnd.randrange(9000)}" if i in {rnd.randrange(size) for _ in range(edits)} else w for i, w in enumerate(text)])
            rows += [text[:-1], text[1:], [*text, "tail"]]
    rows = [(i, " ".join(r)) for i, r in enumerate(rows)]
    kept = corpus_pipeline.near_duplicate_stage(spark, make_docs(rows), SF)
    got = sorted(r.doc_id for r in kept.collect())
    assert not {1, 2, 3} & set(got) and {0, 4} <= set(got)
    assert got == _five_word_first(rows)
