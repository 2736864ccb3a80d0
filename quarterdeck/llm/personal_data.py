"""Personal data with offset-preserving deobfuscation.

Two transducers rewrite a text and keep, for each edit, where it stands in both texts. The first
works on characters: compatibility forms, digits of any script and look-alike letters become ASCII,
invisible characters go. The second works on disguises: digits that are spelled out, and words or
brackets that stand for ``@``, ``.``, ``+``, ``-`` and ``_``. The detectors read the text as it is
(base spans) and as rewritten; a rewritten match is mapped back through both edit lists to the
characters of the source that it stands for, and counts if the source differs from it there.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in contract order.
KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like ASCII letters, and the letters they look like.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "г": "r",
    "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M",
    "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g",
}
# Digits as words in English, German, French and Spanish.
SPELLED = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
# Words and signs that stand for a character of an identifier.
AT_WORDS, DOT_WORDS = ("at", "arroba", "chez"), ("dot", "punkt", "punto", "point")
SIGN_WORDS = {"dash": "-", "hyphen": "-", "underscore": "_"}
INVISIBLE = "­​‌‍⁠﻿"
DASHES, DOTS = "‐‑‒–—−", "․。．｡"

Span = tuple[int, int]
Edit = tuple[int, int, int, int]  # begin and end in the rewritten text, begin and end in the source


# ---- transducers -------------------------------------------------------------------------------


class _Plain(dict):
    """Code point → the ASCII character it stands for, worked out when first met."""

    def __missing__(self, code: int) -> int:
        char = chr(code)
        plain = LOOK_ALIKES.get(char) or ("-" if char in DASHES else "." if char in DOTS else None)
        if plain is None:
            digit = unicodedata.decimal(char, None)
            folded = unicodedata.normalize("NFKC", char)
            plain = str(digit) if digit is not None else folded if len(folded) == 1 and folded.isascii() else char
        self[code] = ord(plain)
        return self[code]


_PLAIN = _Plain((i, i) for i in range(0x80))
_ODD = re.compile("[ ª­²³¹ºĀ-\U0010ffff]")
_GONE = re.compile(f"[{INVISIBLE}]+")


class Rewritten:
    """A text and its edits in order; spans of the text map back to spans of its source."""

    def __init__(self, text: str, edits: list[Edit]) -> None:
        self.text, self.edits = text, edits
        self._begins, self._ends = [e[0] for e in edits], [e[1] for e in edits]

    @classmethod
    def of(cls, source: str, changes: Iterable[tuple[int, int, str]]) -> Rewritten:
        """``source`` with each (begin, end, new text) in its place; changes stand in order, apart."""
        parts, edits, done, size = [], [], 0, 0
        for begin, end, new in changes:
            kept = source[done:begin]
            size += len(kept)
            parts += [kept, new]
            edits.append((size, size + len(new), begin, end))
            size, done = size + len(new), end
        return cls("".join([*parts, source[done:]]), edits)

    def back(self, span: Span) -> Span:
        """The source characters of a span: whole edits inside it, none of the edits beside it."""
        start, end = span
        at = bisect_right(self._ends, start) - 1  # the last edit that ends by the start
        if at + 1 < len(self.edits) and self._begins[at + 1] < start:
            begin = self.edits[at + 1][2]
        else:
            begin = start if at < 0 else self.edits[at][3] + start - self._ends[at]
        at = bisect_left(self._begins, end)  # the first edit that begins at the end or later
        if at and self._ends[at - 1] > end:
            return begin, self.edits[at - 1][3]
        if at < len(self.edits):
            return begin, self.edits[at][2] - (self._begins[at] - end)
        shift = self.edits[-1][3] - self._ends[-1] if self.edits else 0
        return begin, end + shift


def plain_characters(text: str) -> Rewritten:
    """Look-alikes, compatibility forms and digits of any script as ASCII; no invisible characters."""
    if text.isascii() or not _ODD.search(text):
        return Rewritten(text, [])
    plain = text.translate(_PLAIN)
    return Rewritten.of(plain, [(*m.span(), "") for m in _GONE.finditer(plain)])


def _any(words: Iterable[str]) -> str:
    return "|".join(sorted(map(re.escape, words), key=len, reverse=True))


_WORDS = {**dict.fromkeys(AT_WORDS, "@"), **dict.fromkeys(DOT_WORDS, "."), **SIGN_WORDS, "plus": "+", **SPELLED}
_WORD_BYTES = {w.encode(): w for w in _WORDS}
# ASCII letters in lower case, bytes of other characters as they are, all else a space.
_FOLD = bytes(c | 32 if chr(c).isalpha() else c if c >= 0x80 else 32 for c in range(0x80)) + bytes(range(0x80, 0x100))
_BRACKET = rf"[\[({{<]\x20*(?:{_any([*AT_WORDS, *DOT_WORDS, '@', '.'])})\x20*[\])}}>]|&(?:#64|commat|#46|period);"
_ENTITIES = {"&#64;": "@", "&commat;": "@", "&#46;": ".", "&period;": "."}
_ODD_SIGNS = re.compile(rf"{_BRACKET}|[0-9][ol|][\x20-]?[0-9]")
# A bare "at" reads as @ only before a label whose dot is disguised too, a bare sign only inside an address.
_DISGUISED_DOT = rf"(?:\x20+(?:{_any(DOT_WORDS)})\x20+|\x20*[\[({{<]\x20*(?:{_any([*DOT_WORDS, '.'])})\x20*[\])}}>]\x20*|&#46;|&period;)"
_AFTER_AT = re.compile(rf"[a-z0-9.-]++{_DISGUISED_DOT}[a-z0-9]")
_AFTER_SIGN = re.compile(rf"[a-z0-9.-]++(?:\x20*[\[({{<]\x20*(?:{_any([*AT_WORDS, '@'])})|&#64;|&commat;|@)")
_AFTER_PLUS = re.compile(rf"[0-9]|(?:{_any(SPELLED)})(?![^\W_])")


@lru_cache(maxsize=4096)
def _disguises(words: frozenset[str]) -> re.Pattern:
    """Brackets, entities, look-alike digits and the given words, each at its first character."""
    bare = rf"|(?:{_any(words)})(?![^\W_])" if words else ""
    return re.compile(rf"{_BRACKET}|[ol|](?<=[0-9].)(?=[\x20-]?[0-9]){bare}")


def _lowered(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def undisguised(text: str) -> Rewritten:
    """Spelled digits and disguised signs as the characters they stand for."""
    words = frozenset(_WORD_BYTES[w] for w in _WORD_BYTES.keys() & set(text.encode("utf-8", "replace").translate(_FOLD).split()))
    low = _lowered(text)
    if not words and not _ODD_SIGNS.search(low):
        return Rewritten(text, [])
    changes: list[tuple[int, int, str]] = []
    chain = False  # whether the last change is a row of spelled digits
    for match in _disguises(words).finditer(low):
        begin, end = match.span()
        done = changes[-1][1] if changes else 0
        core = match.group()
        if begin < done:
            continue
        if core in SPELLED:
            if begin and low[begin - 1].isalnum():
                continue
            if chain and begin == done + 1 and low[done] in " -":
                first, _, digits = changes.pop()
                changes.append((first, end, digits + SPELLED[core]))
            else:
                changes.append((begin, end, SPELLED[core]))
            chain = True
            continue
        if core in ("o", "l", "|"):
            changes.append((begin, end, "0" if core == "o" else "1"))
            chain = False
            continue
        if core == "plus":
            after = end + (end < len(low) and low[end] in " -")
            if not (begin and low[begin - 1].isalnum()) and _AFTER_PLUS.match(low, after):
                changes.append((begin, after, "+"))
                chain = False
            continue
        word = core.strip("[](){}<> ")
        sign = _ENTITIES.get(core) or (word if word in "@." else _WORDS[word])
        bare = core == word and core not in _ENTITIES
        left, right = begin, end
        while left > done and low[left - 1] == " ":
            left -= 1
        while right < len(low) and low[right] == " ":
            right += 1
        if bare and (left == begin or right == end):
            continue
        if not (left and low[left - 1].isalnum() and right < len(low) and low[right].isalnum()):
            continue
        if bare and (sign == "@" and not _AFTER_AT.match(low, right) or sign in "-_" and not _AFTER_SIGN.match(low, right)):
            continue
        changes.append((left, right, sign))
        chain = False
    return Rewritten.of(text, changes)


# ---- detectors ---------------------------------------------------------------------------------

# The patterns of the base kinds, written so that a failed start is never read again: a run of
# digits or of local-part characters is taken or passed over whole.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?+")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[Span]:
    for match in _IP.finditer(text):
        parts = match.groups()
        if parts[1] is not None and all(len(p) <= 3 or not p[:-3].strip("0") for p in parts) and all(int(p[-3:]) <= 255 for p in parts):
            yield match.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for match in _CARD.finditer(text):
        if 12 <= match.end() - match.start() < 40:
            digits = match.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield match.span()


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for match in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
            yield match.span()


_DETECTORS = (emails, addresses, cards, phones)


def personal_data(text: str) -> list[tuple[int, str, int, bool]]:
    """(start, kind, end, base) of all spans, by start, kind and end."""
    base = [list(find(text)) for find in _DETECTORS]
    out = [(start, which, end, True) for which, spans in enumerate(base) for start, end in spans]
    plain = plain_characters(text)
    clear = undisguised(plain.text)
    if clear.edits or clear.text != text:
        for which, find in enumerate(_DETECTORS):
            for span in find(clear.text):
                start, end = plain.back(clear.back(span))
                if text[start:end] == clear.text[span[0]: span[1]]:
                    continue  # as it stands: the base detectors have decided
                if any(a <= start and end <= b for a, b in base[which]):
                    continue
                out.append((start, which, end, False))
    return [(start, KINDS[which], end, own) for start, which, end, own in sorted(out, key=lambda x: x[:3])]


# ---- over documents ----------------------------------------------------------------------------

FINDINGS = "array<struct<kind:string,start:long,end:long,value:string,base:boolean>>"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, findings`` of every row: kind, start and end (code points, end exclusive), the source
    text there, and whether the plain pattern finds it.

    Findings stand by start, kind and end; base findings of a kind never overlap, an added one may
    reach beyond a base one. Null and empty texts have none; texts are read whole, in time linear in
    their length; repeated rows each have theirs; other columns are ignored.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for cell in batch.column(1):
                text = cell.as_py() or ""
                found.append([{"kind": k, "start": s, "end": e, "value": text[s:e], "base": b} for s, k, e, b in personal_data(text)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "findings"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id long, findings {FINDINGS}")


def listed(findings: Column) -> Column:
    """``kind:start:end`` of the findings, comma-joined."""
    return F.concat_ws(",", F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts of the base findings by kind, a digest of them, and all spans, per document."""
    base = F.filter("findings", lambda f: f["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("findings", lambda f: f["base"] & (f["kind"] == kind))).cast("long").alias(f"n_{kind}")

    found = find_personal_data(docs)
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"))
