"""Secret scan: all rules in one byte pass of a combined deterministic automaton.

A rule is a head (a regular expression), a run of tail characters and the least length of the
run. One automaton for all rules, compiled once on the driver, reads every byte of a text and
tells which rules occur at all; that is nothing for most texts. Where a rule occurs, its own
anchored automaton and its tail class then give the spans, leftmost and without overlap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.automaton import Automaton, compile_rules, either_case

# Tail characters that the combined automaton counts, after a head and without one; the span step
# counts the rest. Counting all of them there would multiply the states of all rules.
SCANNED_TAIL, SCANNED_RUN = 2, 16


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    tail: str
    least: int


_KEYWORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

# The base kinds in contract order, then public formats of further credentials.
BASE = (
    Rule("assign", rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?", "[A-Za-z0-9+/_.=-]", 8),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
)
FURTHER = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("stripe", "[sr]k_(live|test)_", "[A-Za-z0-9]", 16),
    Rule("pem", "-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY-", "-", 4),
)
RULES = BASE + FURTHER

FINDINGS = "array<struct<kind:string,start:long,end:long,value:string>>"


class Scanner:
    """The compiled rules; plain lists and bytes, so that tasks get it with their code."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.combined = compile_rules([f"{r.head}{r.tail}{{{min(r.least, SCANNED_TAIL if r.head else SCANNED_RUN)}}}" for r in rules])
        self.heads = [compile_rules([r.head], anchored=True) for r in rules]
        self.tails = [compile_rules([f"{r.tail}+"], anchored=True) for r in rules]
        self.firsts = [compile_rules([f"{r.head}{r.tail}"], anchored=True) for r in rules]

    def spans(self, data: bytes, which: int) -> Iterator[tuple[int, int]]:
        """Byte spans of a rule, leftmost first, without overlap; short ones are passed over."""
        head, tail, least, first = self.heads[which], self.tails[which], self.rules[which].least, self.firsts[which]
        can_begin = bytes(first.step[first.start + c] != first.rules.get(-1, -1) for c in first.classes)
        flags = data.translate(can_begin)
        at = flags.find(1)
        while at >= 0:
            middle = head.longest(data, at)
            end = tail.longest(data, middle) if middle >= 0 else -1
            if end < 0:
                at = flags.find(1, at + 1)
                continue
            if end - middle >= least:
                yield at, end
            at = flags.find(1, end)

    def findings(self, text: str) -> list[tuple[str, int, int, str]]:
        data = text.encode("utf-8", "replace")
        mask = self.combined.mask(data)
        found = []
        for which, rule in enumerate(self.rules):
            if mask >> which & 1:
                found += [(start, which, rule.kind, end) for start, end in self.spans(data, which)]
        out, chars, seen = [], 0, 0
        for start, _, kind, end in sorted(found):
            chars += len(data[seen:start].decode("utf-8", "replace")) if start > seen else 0
            seen = max(seen, start)
            out.append((kind, chars, chars + end - start, data[start:end].decode()))
        return out


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, findings`` of every row: kind, start, end (code points, end exclusive) and value.

    Findings stand by start, then by the order of the rules. Whole texts are read; null and
    empty texts have none. Spans of different rules may overlap. Other columns are ignored.
    """
    scanner = Scanner(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "value"), f, strict=True)) for f in scanner.findings(t.as_py() or "")] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "findings"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id long, findings {FINDINGS}")


def listed(findings: Column) -> Column:
    """``kind:start:end`` of the findings, comma-joined."""
    return F.concat_ws(",", F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans, per document."""
    found = scan_secrets(docs)
    base = F.filter("findings", lambda f: f["kind"].isin([r.kind for r in BASE]))

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"))


__all__ = ["Automaton", "BASE", "FURTHER", "RULES", "Rule", "Scanner", "scan_secrets", "secret_report"]
