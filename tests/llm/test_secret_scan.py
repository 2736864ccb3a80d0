from __future__ import annotations

import hashlib
import random
import re

import pytest

from quarterdeck.llm.automaton import compile_rules, either_case
from quarterdeck.llm.secret_scan import Scanner, scan_secrets, secret_report

NAMES = ("assign", "access", "hex")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PIECES = ["token", "secret", "API_KEY", "apikey", "PassWord", "passwd", "=", ":", '"', "'", " ", "  ", "AKIA", "AKIAAKIA", "0123456789abcdef", "deadbeef", "é", "ABCDEFGH12", "x-y_z.=", "\n", "ghp_", "a", "0", "12345678"]


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(NAMES[k], s, e) for s, k, e in sorted(found)]


def test_spans_match_the_regular_expressions():
    scanner, rnd = Scanner(), random.Random(1)
    for _ in range(6000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(1, 14)))
        got = scanner.findings(text)
        assert [f[:3] for f in got if f[0] in NAMES] == brute(text), text
        assert all(text[s:e] == value for _, s, e, value in got)


def test_further_kinds():
    found = Scanner().findings("x ghp_" + "a1B2" * 9 + " xoxb-1234567890-ab AIza" + "Z" * 35 + " -----BEGIN RSA PRIVATE KEY-----")
    assert [f[0] for f in found] == ["github", "slack", "google", "pem"]


@pytest.mark.parametrize("pattern", ["ab?c{2,3}", "(a|bc)*d", "[^a-c]x+", f"{either_case('ab')}_?c", "a{0,2}b", "(a|ab)(c|bcd)"])
def test_automata_against_pattern_matching(pattern):
    rnd = random.Random(3)
    anchored, free = compile_rules([pattern], anchored=True), compile_rules([pattern, "zz"])
    for _ in range(800):
        raw = bytes(rnd.choice(b"abcdxABz_") for _ in range(rnd.randrange(0, 9)))
        ends = [e for e in range(len(raw) + 1) if re.fullmatch(pattern.encode(), raw[:e])]
        assert anchored.longest(raw, 0) == max(ends, default=-1)
        hit = any(re.fullmatch(pattern.encode(), raw[s:e]) for s in range(len(raw)) for e in range(s + 1, len(raw) + 1))
        assert free.mask(raw) == hit + 2 * (b"zz" in raw)


def test_report(spark, real_docs):
    rows = real_docs.collect()
    got = {r.doc_id: r for r in secret_report(real_docs).collect()}
    total = 0
    for r in rows:
        want = brute(r.text)
        total += len(want)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [got[r.doc_id].n_assign, got[r.doc_id].n_access, got[r.doc_id].n_hex] == [sum(k == n for k, _, _ in want) for n in NAMES]
    assert total > 10


def test_edges(make_docs):
    long = "é " * 300_000 + "password = 'abcdefgh1'"
    docs = make_docs([(1, None), (2, ""), (None, "token: 12345678"), (3, long), (3, long)]).selectExpr("*", "1 AS findings", "2 AS spans")
    got = sorted((str(r.doc_id), r.n_assign, r.spans) for r in secret_report(docs).collect())
    assert got == [("1", 0, ""), ("2", 0, ""), ("3", 1, "assign:600000:600021"), ("3", 1, "assign:600000:600021"), ("None", 1, "assign:0:15")]
    assert scan_secrets(docs.where("doc_id = 3")).first().findings[0].value == "password = 'abcdefgh1"
    assert secret_report(docs.where("1 = 0")).count() == 0
