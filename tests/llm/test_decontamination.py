from __future__ import annotations

import re

from quarterdeck.llm.decontamination import decontaminated, find_leaks, template_words

ITEM = "In the old mill John ground 12 kg of barley and then he sold 4 kg of it to Mary for 9 dollars before the rain came over the hill"
CHANGED = "In the old mill Peter ground 57 kg of barley and then he sold 31 kg of it to Anna for 8 dollars before the rain came over the hill"
MUDDLED = "In the old mill John ground 12 kg of barley and then he sold 4 kg of it to Mary for 9 dollars before John came, and John ground 12 kg"
PROSE = "some quite unrelated prose goes on here for a while without any of the words in that order and then it ends "


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def rows(spark, docs, texts):
    return {(r.doc_id, r.item_id): r for r in find_leaks(docs, bench(spark, texts)).collect()}


def test_verbatim_and_reparameterised(spark, make_docs):
    docs = make_docs([(1, PROSE + ITEM + " " + PROSE), (2, PROSE + CHANGED + " " + PROSE), (3, PROSE * 3), (4, ITEM.replace(",", "").replace(" ", "  \n")), (5, CHANGED.replace("57", "3.5"))])
    got = rows(spark, docs, [ITEM, PROSE[:30]])
    assert {k: (r.kind, r.coverage) for k, r in got.items() if k[1] == 0} == {
        (1, 0): ("verbatim", 1.0), (2, 0): ("reparameterised", 1.0), (4, 0): ("verbatim", 1.0), (5, 0): ("reparameterised", 1.0)
    }
    assert got[2, 0].changed == 5 and got[2, 0].slots == got[1, 0].slots
    assert {d for d, i in got if i == 1} == {1, 2, 3}


def test_slots_must_agree(spark, make_docs):
    item = "if Tom gives 5 apples to Ann and then Tom gives 5 pears to her how many pears and apples did Tom give away in all"
    good = item.replace("Tom", "Bob").replace("5", "8")
    bad = "if Tom gives 5 apples to Ann and then Bob gives 7 pears to her how many pears and apples did Joe give away in all"
    got = rows(spark, make_docs([(1, good), (2, bad)]), [item])
    assert set(got) == {(1, 0)} and got[1, 0].kind == "reparameterised"


def test_half_an_item_at_any_place(spark, make_docs):
    words = [f"w{i}x" for i in range(40)]
    texts = [" ".join(words)]
    docs = [(k, f"{'z ' * k}{' '.join(words[k % 7: k % 7 + 27])} end {PROSE}") for k in range(12)] + [(50, " ".join(words[:12]) + " " + PROSE)]
    assert {d for d, _ in rows(spark, make_docs(docs), texts)} == set(range(12))
    cut = " ".join(words[:20] + ["inserted"] + words[20:])
    assert set(rows(spark, make_docs([(7, cut)]), texts)) == {(7, 0)}


def test_short_items(spark, make_docs):
    docs = make_docs([(1, "well the quick red fox ran home today"), (2, "the quick red dog"), (3, "too short")])
    assert set(rows(spark, docs, ["The quick red fox", "too short", "x"])) == {(1, 0)}


def test_brute_force_on_real_tables(spark, real_docs):
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    norm = lambda t: " ".join(re.findall(r"\w+", t))
    texts = {r.doc_id: f" {norm(r.text)} " for r in real_docs.collect()}
    want = {(d, r.item_id) for r in benchmark.collect() for d, t in texts.items() if f" {norm(r.text)} " in t}
    got = {(r.doc_id, r.item_id): r for r in find_leaks(real_docs, benchmark).collect()}
    assert want and want <= set(got)
    assert all(r.coverage < 1 for k, r in got.items() if k not in want)
    clean = decontaminated(real_docs, benchmark)
    assert clean.columns == real_docs.columns and clean.count() == 1000 - len({d for d, _ in got})


def test_words_nulls_empty_tables_and_clashing_columns(spark, make_docs):
    line = spark.createDataFrame([("Pay $3.50, or 1,000 km; it's (so).",)], "text string")
    assert [w for w in line.select(template_words(line.text)).first()[0] if w] == ["Pay", "3.50", "or", "1,000", "km", "it", "s", "so"]
    docs = make_docs([(None, ITEM), (1, None), (2, ""), (3, ITEM), (3, ITEM), (4, "n " * 200_000 + ITEM)])
    docs = docs.selectExpr("*", "1 AS hash", "2 AS item_id", "3 AS doc_key", "4 AS codes", "5 AS words")
    texts = bench(spark, [ITEM, ITEM, None, ""]).selectExpr("*", "1 AS doc_id", "2 AS windows")
    got = find_leaks(docs, texts).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == [("3", 0), ("3", 0), ("4", 0), ("None", 0)]
    assert decontaminated(docs, texts).count() == 2
    assert find_leaks(docs, texts.where("1 = 0")).count() == 0 and find_leaks(docs.where("1 = 0"), texts).count() == 0


def test_each_copy_is_judged_alone(spark, make_docs):
    second = CHANGED.replace("Peter", "Oscar").replace("57", "23").replace("Anna", "Rita")
    stray = "PROSE then Joe ground 5 kg of barley and then he sold 7 kg of nothing "
    docs = make_docs([(1, PROSE + CHANGED + " " + PROSE + second), (2, CHANGED + " " + second), (3, PROSE + CHANGED + " " + PROSE * 3 + stray), (4, PROSE * 2 + stray)])
    got = rows(spark, docs, [ITEM])
    assert {d: (r.kind, r.coverage) for (d, _), r in got.items()} == dict.fromkeys([1, 2, 3], ("reparameterised", 1.0))


def test_few_changed_words_and_other_case(spark, make_docs):
    items = [" ".join(f"w{n}q{i}" for i in range(n)) for n in (12, 15, 22)]
    items.append(" ".join(f"v{i}x" for i in range(60)))
    docs, want = [], set()
    for item, text in enumerate(items):
        words = text.split()
        edits = [(k, None) for k in range(len(words))] + [(k, words[k]) for k in range(len(words))] if len(words) < 60 else [(7, None)]
        for k, kept in edits:
            copy = words[:k] + ["other"] + ([kept] if kept else []) + words[k + 1:]
            if len(words) == 60:
                copy = [f"o{i}" if i in (11, 23, 35, 47) else w for i, w in enumerate(words)]
            want.add((len(docs), item))
            docs.append((len(docs), f"{PROSE} {' '.join(copy)} {PROSE}"))
    for copy in (ITEM.upper(), ITEM.lower(), ITEM.title()):
        want.add((len(docs), 4))
        docs.append((len(docs), PROSE + copy + " " + PROSE))
    assert set(rows(spark, make_docs(docs), [*items, ITEM])) == want


def test_items_of_names_numbers_and_capitals(spark, make_docs):
    items = ["WHICH GAS DO PLANTS ABSORB FROM THE AIR WHEN THEY GROW IN THE LIGHT", "John Smith and Mary Brown met Ann Lee near Paris in May 1999", "12 + 7 - 3 = 16"]
    docs = [(i, f"{PROSE} {t} {PROSE}") for i, t in enumerate(items)]
    docs += [(10, "SOME OTHER LINE IN CAPITALS THAT GOES ON FOR AS LONG AS ANY OF THE REST"), (11, "13 + 8 - 2 = 19"), (12, "Bob Cox Tom Fox Joe Low Ann Lee Jim Roe Sue Poe 1 2 3 4")]
    got = rows(spark, make_docs(docs), items)
    assert {k: (r.kind, r.coverage) for k, r in got.items()} == {(i, i): ("verbatim", 1.0) for i in range(3)}


def test_short_items_need_their_whole_template(spark, make_docs):
    items = ["What is the capital of France", "What is 37 times 48"]
    texts = ["Berlin became the capital of Germany again after the reunification of the country", "this engine is 5 times faster than the old one"]
    texts += ["he asked: What is the capital of Spain", "so What is 51 times 12 then", "WHAT IS THE CAPITAL OF FRANCE"]
    got = rows(spark, make_docs(texts), items)
    assert {k: r.kind for k, r in got.items()} == {(2, 0): "reparameterised", (3, 1): "reparameterised", (4, 0): "verbatim"}
