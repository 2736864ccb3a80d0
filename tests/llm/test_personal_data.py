from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from quarterdeck.llm.personal_data import KINDS, find_personal_data, luhn, personal_data, personal_data_report, plain_characters, undisguised

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def holds(which, match):
    digits = re.sub("[^0-9]", "", match)
    if which == 1:
        return all(int(p) <= 255 for p in match.split("."))
    if which == 2:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return which == 0 or 9 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text) if holds(k, m[0])]
    return [(KINDS[k], s, e) for s, k, e in sorted(found)]


def base(text):
    return [(k, s, e) for s, k, e, own in personal_data(text) if own]


def added(text):
    return [(k, text[s:e]) for s, k, e, own in personal_data(text) if not own]


PIECES = ["a", "b9", "@", "@", ".", ".", "-", "_", "%", "+", " ", " ", "1", "12", "255", "256", "0001", "4111111111111111", "4111 1111-1111 1111", "(", ")", "é", "\n", "mail", "127.0.0.1", "+49 (30) 1234-567", "٣", "one", "dot", "at"]


def test_luhn():
    assert luhn("4111111111111111") and luhn("79927398713") and not luhn("4111111111111112")


def test_base_spans_match_the_regular_expressions():
    rnd = random.Random(1)
    for _ in range(8000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(1, 16)))
        assert base(text) == brute(text), text


@pytest.mark.parametrize("text, kind, span", [
    ("write to john [at] example [dot] com now", "email", "john [at] example [dot] com"),
    ("mail john.doe at mail.example dot com.", "email", "john.doe at mail.example dot com"),
    ("JOHN(AT)EXAMPLE(DOT)COM", "email", "JOHN(AT)EXAMPLE(DOT)COM"),
    ("john@example dot co dot uk", "email", "john@example dot co dot uk"),
    ("john&#64;example.com", "email", "john&#64;example.com"),
    ("a jоhn@exаmple.com b", "email", "jоhn@exаmple.com"),
    ("x jo​hn@exam­ple.com", "email", "jo​hn@exam­ple.com"),
    ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("juan arroba ejemplo punto es", "email", "juan arroba ejemplo punto es"),
    ("john dash doe at example dot com", "email", "doe at example dot com"),
    ("host 192 dot 168 dot 0 dot one up", "ip", "192 dot 168 dot 0 dot one"),
    ("one nine two dot one six eight dot zero dot seven", "ip", "one nine two dot one six eight dot zero dot seven"),
    ("pay four one one one 1111 1111 1111 today", "card", "four one one one 1111 1111 1111"),
    ("pay ４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("pay 41l1 1111 1111 1111", "card", "41l1 1111 1111 1111"),
    ("call plus four nine three zero 1234 567 now", "phone", "plus four nine three zero 1234 567"),
    ("call +49 drei null eins zwei drei vier fünf sechs", "phone", "+49 drei null eins zwei drei vier fünf sechs"),
    ("call +٤٩ ٣٠ ١٢٣٤٥٦٧", "phone", "+٤٩ ٣٠ ١٢٣٤٥٦٧"),
])
def test_disguises_map_back_to_the_source(text, kind, span):
    assert (kind, span) in added(text)


@pytest.mark.parametrize("text", [
    "we met at noon and looked at example.com for a dot", "one two three", "The point is made. At last, two of us.", "a@b.co and 127.0.0.1 as they stand",
    "dos y tres, un point de vue", "look at one dot", "half ½ of ²³ things",
])
def test_plain_prose_gains_nothing(text):
    assert added(text) == []


def test_spans_map_back_through_random_edits():
    rnd = random.Random(7)
    codes = {"1": ["one", "1", "１", "eins"], "2": ["two", "2", "２", "dos"], "@": [" [at] ", "@", "＠", "&#64;"], ".": ["[dot]", ".", "．", " dot "], "a": ["a", "а", "ａ", "a​"]}
    for _ in range(2000):
        names = ["".join(rnd.choice("abk") for _ in range(rnd.randrange(1, 5))) for _ in range(3)]
        plain = f"{names[0]}@{names[1]}.{names[2]}"
        shown = "".join(rnd.choice(codes.get(c, [c])) for c in plain).rstrip("​")
        text = f"¿é ＃ {shown} ​."
        spans = [text[s:e] for s, k, e, _ in personal_data(text) if k == "email"]
        assert shown in spans, (shown, spans)
        plain_text = plain_characters(text)
        clear = undisguised(plain_text.text)
        at = clear.text.index(plain)
        s, e = plain_text.back(clear.back((at, at + len(plain))))
        assert text[s:e] == shown


def test_time_is_linear():
    started = time.time()
    for text in ("1" * 1_000_000, "a" * 1_000_000 + "@", "1." * 500_000, "+1" * 500_000, "1 " * 500_000, "at " * 300_000, "one " * 250_000, "[at]" * 250_000, "a@" * 500_000, " " * 1_000_000, "a" + " at " * 250_000, "plus " * 200_000, "&" * 1_000_000, "a.b " * 250_000):
        personal_data(text)
    assert time.time() - started < 60


def test_report(real_docs):
    rows = real_docs.collect()
    got = {r.doc_id: r for r in personal_data_report(real_docs).collect()}
    total = 0
    for r in rows:
        want = brute(r.text)
        total += len(want)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [got[r.doc_id][f"n_{k}"] for k in KINDS] == [sum(x[0] == k for x in want) for k in KINDS]
        spans = got[r.doc_id].spans.split(",") if got[r.doc_id].spans else []
        assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(spans)
    assert total > 10 and len(got) == len(rows)


def test_edges(make_docs):
    long = "é " * 300_000 + "x@y.org"
    docs = make_docs([(1, None), (2, ""), (None, "call +49 30 1234567"), (3, long), (3, long)]).selectExpr("*", "1 AS findings", "2 AS spans")
    got = sorted((str(r.doc_id), r.n_email, r.n_phone, r.spans) for r in personal_data_report(docs).collect())
    assert got == [("1", 0, 0, ""), ("2", 0, 0, ""), ("3", 1, 0, "email:600000:600007"), ("3", 1, 0, "email:600000:600007"), ("None", 0, 1, "phone:5:19")]
    assert find_personal_data(docs.where("doc_id = 3")).first().findings[0].value == "x@y.org"
    assert personal_data_report(docs.where("1 = 0")).count() == 0
