"""Source divergence audit by a minimal-perfect-hash recount.

The first pass counts, exactly and by the strings themselves, in how many documents of a language
each term occurs, and keeps the frequent ones. The kept terms are cut into shards of a bounded
number of keys; each shard gets a minimal perfect hash (rounds of bit vectors: a key that is alone
at its place of a round has its slot there, the others go on to the next round) and its keys in
slot order. The second pass gets the shards broadcast and counts with a dense array of slots for
each (language, source) group: a term's hash gives a slot, the stored key there tells whether the
term is a kept one. Shards go out in rounds of a bounded size, so what is broadcast at once never
grows with the vocabulary; a larger vocabulary takes more rounds over the texts.

Shares are whole numbers (parts in 10^9, smoothed), so every figure is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarterdeck.llm.base import lower, mix, run_strings, runs, span_hashes, staged, text_blocks

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
SMOOTHING = 5
_BLOCK = 4 << 20
_LEVELS = 40



@dataclass(frozen=True)
class Bounds:
    """What one shard, round, task or block holds; results do not depend on it."""

    shard_keys: int = 1 << 16
    round_bytes: int = 32 << 20  # of shards broadcast at once
    held_slots: int = 1 << 22  # dense counters of a task before it hands them on
    slice_terms: int = 2048  # of a block of the pairwise comparison
    block_sources: int = 256


# Bytes of terms: ASCII letters and every byte of a character beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Per term occurrence its text and its code, and the distinct lower-cased terms by code."""
    inside = _TERM[data]
    start, end, first = runs(inside, offsets)
    coded = run_strings(lower(data), inside, start, end)
    return np.repeat(np.arange(len(offsets) - 1), np.diff(first)), coded.indices.to_numpy(), coded.dictionary


def term_hashes(terms: pa.Array) -> np.ndarray:
    """64-bit hashes of terms."""
    if not len(terms):
        return np.zeros(0, np.uint64)
    terms = terms.cast(pa.large_string())
    ends = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset: terms.offset + len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2], np.uint8)[ends[0]: ends[-1]]
    ends = ends - ends[0]
    out, row = np.empty(len(terms), np.uint64), 0
    while row < len(terms):  # in runs: a running sum over all bytes needs a table of their number
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + _BLOCK, side="right")) - 1)
        out[row:stop] = span_hashes(data[ends[row]: ends[stop]], ends[row:stop] - ends[row], ends[row + 1: stop + 1] - ends[row])
        row = stop
    return out


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) → (lang, term, documents), summed per block."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        of_row = langs.indices.to_numpy()
        for row, stop, data, offsets in text_blocks(batch.column(1), _BLOCK):
            text, code, terms = terms_of(data, offsets)
            if not len(terms):
                continue
            once = np.unique(text * len(terms) + code)
            seen, n = np.unique(of_row[row + once // len(terms)] * np.int64(len(terms)) + once % len(terms), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(seen // len(terms))), terms.take(pa.array(seen % len(terms))).cast(pa.string()), pa.array(n, pa.int64())],
                names=["lang", "term", "documents"],
            )


# ---- minimal perfect hashes --------------------------------------------------------------------


class PerfectHash:
    """A minimal perfect hash over distinct terms: bit vectors by round, ``keys`` in slot order."""

    def __init__(self, keys: pa.Array, levels: list[bytes]) -> None:
        self.keys, self.levels = keys.cast(pa.large_string()), levels
        self._open: list[tuple[np.ndarray, np.ndarray]] = []
        self._settled = 0

    def __getstate__(self) -> dict:
        return {"keys": self.keys, "levels": self.levels, "_open": [], "_settled": 0}

    @classmethod
    def build(cls, terms: pa.Array) -> PerfectHash:
        hashes, left = term_hashes(terms), np.arange(len(terms))
        levels, order = [], []
        while left.size and len(levels) < _LEVELS:
            size = cls._size(left.size)
            place = cls._places(hashes[left], len(levels), size)
            alone = np.bincount(place, minlength=size)[place] == 1
            bits = np.zeros(size, bool)
            bits[place[alone]] = True
            levels.append(np.packbits(bits).tobytes())
            order.append(left[alone][np.argsort(place[alone])])
            left = left[~alone]
        # Terms that share a 64-bit hash never part; they stand last and are looked up as strings.
        return cls(terms.take(pa.array(np.concatenate([*order, left]))), levels)

    @staticmethod
    def _size(keys: int) -> int:
        return max(8, 2 * keys)

    @staticmethod
    def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
        return (mix(hashes ^ seed) % np.uint64(size)).astype(np.int64)

    def _unpack(self) -> None:
        for raw in self.levels:
            bits = np.unpackbits(np.frombuffer(raw, np.uint8))[: self._size(len(self.keys) - self._settled)].astype(bool)
            self._open.append((bits, np.cumsum(bits) - 1 + self._settled))
            self._settled += int(bits.sum())

    def slots(self, terms: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The slot of each term, -1 for terms that are not keys (checked against the stored key)."""
        if not self._open:
            self._unpack()  # once per worker
        terms = terms.cast(pa.large_string())
        out, left = np.full(len(terms), -1, np.int64), np.arange(len(terms))
        for level, (bits, rank) in enumerate(self._open):
            place = self._places(hashes[left], level, bits.size)
            hit = bits[place]
            out[left[hit]] = rank[place[hit]]
            left = left[~hit]
            if not left.size:
                break
        found = np.flatnonzero(out >= 0)
        same = pc.equal(self.keys.take(pa.array(out[found])), terms.take(pa.array(found)))
        out[found[~same.to_numpy(zero_copy_only=False)]] = -1
        if self._settled < len(self.keys):
            rest = pc.index_in(terms, self.keys.slice(self._settled)).fill_null(-1).to_numpy()
            out = np.where(rest >= 0, rest + self._settled, out)
        return out


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, shards) → (lang, shard, term)."""
    for batch in batches:
        shards = np.maximum(batch.column(2).to_numpy(), 1).astype(np.uint64)
        shard = ((term_hashes(batch.column(1)) >> np.uint64(32)) % shards).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard), batch.column(1)], names=["lang", "shard", "term"])


def _packed_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    hash_ = PerfectHash.build(pa.array(rows["term"].sort_values(), pa.large_string()))
    return pd.DataFrame({"lang": [key[0]], "shard": [key[1]], "n": [len(rows)], "levels": [hash_.levels], "terms": [hash_.keys.to_pylist()]})


def _recount(shards, held_slots: int):
    """(lang, source, text) → (lang, source, at, n): dense slots per group, handed on when many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shards.value  # lang → (shards of the lang, {shard: (first slot, hash)}, first, slots)
        held: dict[tuple[str, str], np.ndarray] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            langs, sources, ats, ns = [], [], [], []
            for (lang, source), slots in held.items():
                at = np.flatnonzero(slots)
                langs.append(pa.array([lang], pa.string()).take(pa.array(np.zeros(at.size, np.int64))))
                sources.append(pa.array([source], pa.string()).take(pa.array(np.zeros(at.size, np.int64))))
                ats.append(at + known[lang][2])
                ns.append(slots[at])
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(langs), pa.concat_arrays(sources), pa.array(np.concatenate(ats), pa.int64()), pa.array(np.concatenate(ns), pa.int64())],
                names=["lang", "source", "at", "n"],
            )

        for batch in batches:
            langs, sources = batch.column(0).dictionary_encode(), batch.column(1).dictionary_encode()
            names, places = langs.dictionary.to_pylist(), sources.dictionary.to_pylist()
            lang_row, source_row = langs.indices.to_numpy(), sources.indices.to_numpy()
            for row, stop, data, offsets in text_blocks(batch.column(2), _BLOCK):
                text, code, terms = terms_of(data, offsets)
                if not len(terms):
                    continue
                group = lang_row[row:stop].astype(np.int64) * len(places) + source_row[row:stop]
                seen, n = np.unique(group[text] * len(terms) + code, return_counts=True)
                group, code = seen // len(terms), seen % len(terms)
                hashes = term_hashes(terms)
                for lang_no in np.unique(group // len(places)):
                    lang = names[lang_no]
                    if lang not in known:
                        continue
                    shard_count, parts, first, slots = known[lang]
                    mine = group // len(places) == lang_no
                    wanted = np.unique(code[mine])
                    at = np.full(len(terms), -1, np.int64)
                    shard = _shard_of(hashes[wanted], shard_count)
                    for number, (base, hash_) in parts.items():
                        here = wanted[shard == number]
                        if here.size:
                            found = hash_.slots(terms.take(pa.array(here)), hashes[here])
                            at[here] = np.where(found >= 0, found + base, -1)
                    for group_no in np.unique(group[mine]):
                        rows = group == group_no
                        slot, count = at[code[rows]], n[rows]
                        key = (lang, places[group_no % len(places)])
                        if key not in held:
                            if size + slots > held_slots and held:
                                yield flush()
                                held, size = {}, 0
                            held[key] = np.zeros(slots, np.int64)
                            size += slots
                        held[key][slot[slot >= 0]] += count[slot >= 0]
        if held:
            yield flush()

    return run


# ---- exact shares and comparisons --------------------------------------------------------------


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)) as a long, three digits of the quotient at a
    time, so that nothing overflows below totals of 9 * 10^15; 0 without terms."""
    below = F.nullif(total + F.lit(SMOOTHING) * terms, F.lit(0))
    whole, rest = F.lit(0).cast("long"), count + F.lit(SMOOTHING)
    for _ in range(3):
        scaled = rest * F.lit(1000).cast("long")
        whole = whole * 1000 + F.call_function("div", scaled, below)
        rest = scaled % below
    return F.when(terms > 0, whole + 1).otherwise(F.lit(0)).cast("long")


def _compare(slice_terms: int, block_sources: int):
    """Sums of |difference| over the terms of a slice, for the source pairs of two blocks."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, part, lo, hi = key
        begin = part * slice_terms
        terms = int(min(slice_terms, rows["terms"].iloc[0] - begin))
        names = np.unique(rows["sid"].to_numpy())
        shares = np.zeros((names.size, max(terms, 0)), np.int64)
        own, at, p = np.searchsorted(names, rows["sid"].to_numpy()), rows["at"].to_numpy(), rows["p"].to_numpy()
        none = at < 0
        shares[own[none]] = p[none][:, None]
        shares[own[~none], at[~none] - begin] = p[~none]
        block = names // block_sources
        a, b, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(block == lo):
            others = np.flatnonzero((block == hi) & (names > names[i]))
            a.append(np.full(others.size, names[i]))
            b.append(names[others])
            values.append(np.abs(shares[others] - shares[i]).sum(axis=1))
        return pd.DataFrame({"lang": lang, "a": np.concatenate(a), "b": np.concatenate(b), "value": np.concatenate(values)})

    return run


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term) of the terms that at least ``least`` documents of a language hold."""
    found = docs.select("lang", "text").mapInArrow(_document_frequencies, "lang string, term string, documents long")
    return found.groupBy("lang", "term").agg(F.sum("documents").alias("documents")).where(F.col("documents") >= least).select("lang", "term")


def recounted(docs: DataFrame, shards: DataFrame, bounds: Bounds) -> tuple[DataFrame, DataFrame]:
    """Occurrences of the kept terms per (lang, source, at), and the (lang, at, term) of the slots."""
    spark = docs.sparkSession
    size = F.aggregate("terms", F.lit(0).cast("long"), lambda x, t: x + F.octet_length(t) + 16)
    listed = shards.select("lang", "shard", "n", size.alias("size")).orderBy("lang", "shard").collect()  # one row per 65,536 terms
    counts: dict[str, int] = {}
    first: dict[tuple[str, int], int] = {}
    slots: dict[str, int] = {}
    rounds: list[list] = []
    held = bounds.round_bytes
    for row in listed:
        counts[row["lang"]] = max(counts.get(row["lang"], 0), row["shard"] + 1)
        first[row["lang"], row["shard"]] = slots.get(row["lang"], 0)
        slots[row["lang"]] = slots.get(row["lang"], 0) + row["n"]
        if held + row["size"] > bounds.round_bytes:
            rounds.append([])
            held = 0
        rounds[-1].append((row["lang"], row["shard"]))
        held += row["size"]
    schema = "lang string, source string, at long, n long"
    out = spark.createDataFrame([], schema)
    for members in rounds:
        wanted = spark.createDataFrame(members, "lang string, shard long")
        known: dict[str, list] = {}
        for row in shards.join(wanted, ["lang", "shard"], "left_semi").orderBy("lang", "shard").toLocalIterator():
            lang, base = row["lang"], first[row["lang"], row["shard"]]
            entry = known.setdefault(lang, [row["shards"], {}, base, 0])
            entry[1][row["shard"]] = (base - entry[2], PerfectHash(pa.array(row["terms"], pa.large_string()), [bytes(x) for x in row["levels"]]))
            entry[3] = base - entry[2] + row["n"]
        sent = spark.sparkContext.broadcast(known)
        found = docs.select("lang", "source", "text").mapInArrow(_recount(sent, bounds.held_slots), schema)
        out = out.unionByName(staged(found.groupBy("lang", "source", "at").agg(F.sum("n").alias("n")), "audit-counts"))
        sent.unpersist()
    bases = spark.createDataFrame([(lang, shard, base) for (lang, shard), base in first.items()], "lang string, shard long, base long")
    named = shards.join(bases, ["lang", "shard"]).select("lang", "base", F.posexplode("terms").alias("slot", "term"))
    return out, named.select("lang", (F.col("base") + F.col("slot")).alias("at"), "term")


def audit_sources(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, bounds: Bounds = Bounds()) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language departs.

    Part ``pair``: the sum of share differences to every other source of the language. Part
    ``term``: the ``top`` kept terms that the source holds beyond their share in the language.
    Nulls in text, lang and source read as empty; a row is a document, repeated or not; a group
    without terms has the smoothed shares; ties stand by the item's UTF-8 bytes; an empty table
    gives no rows. Texts of any length are read whole; other columns are ignored.
    """
    narrow = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = staged(kept_terms(narrow, least), "audit-terms")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    cut = F.ceil(F.col("terms") / bounds.shard_keys).alias("shards")
    dealt = kept.join(sizes, "lang").select("lang", "term", cut).mapInArrow(_hashed, "lang string, shard long, term string")
    built = dealt.groupBy("lang", "shard").applyInPandas(_packed_shard, "lang string, shard long, n long, levels array<binary>, terms array<string>")
    shards = staged(built.join(sizes.select("lang", cut), "lang"), "audit-shards")
    counts, named = recounted(narrow, shards, bounds)

    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = narrow.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "terms"])
    groups = staged(groups.withColumn("sid", F.row_number().over(W.partitionBy("lang").orderBy("source")).cast("long") - 1), "audit-groups")
    entries = counts.join(groups, ["lang", "source"]).select("lang", "source", "sid", "at", "terms", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    entries = staged(entries, "audit-shares")

    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    of_lang = counts.groupBy("lang", "at").agg(F.sum("n").alias("n")).join(whole, "lang")
    of_lang = of_lang.select("lang", "at", share(F.col("n"), F.col("total"), F.col("terms")).alias("q")).join(named, ["lang", "at"])
    beyond = entries.join(of_lang, ["lang", "at"]).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    place = W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    beyond = beyond.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)

    # Every source of a slice has its share of an absent term (at = -1) beside those of its terms.
    blocks = groups.groupBy("lang").agg((F.floor(F.max("sid") / bounds.block_sources) + 1).alias("blocks"))
    slices = F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("terms") / bounds.slice_terms), F.lit(1)) - 1)
    zero = share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
    absent = groups.select("lang", F.explode(slices).alias("slice"), "sid", F.lit(-1).cast("long").alias("at"), "terms", zero.alias("p"))
    rows = entries.select("lang", F.floor(F.col("at") / bounds.slice_terms).alias("slice"), "sid", "at", "terms", "p").unionByName(absent).join(blocks, "lang")
    rows = rows.withColumn("block", F.floor(F.col("sid") / bounds.block_sources)).withColumn("mate", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("lang", "slice", F.least("block", "mate").alias("lo"), F.greatest("block", "mate").alias("hi"), "sid", "at", "terms", "p")
    sums = rows.groupBy("lang", "slice", "lo", "hi").applyInPandas(_compare(bounds.slice_terms, bounds.block_sources), "lang string, a long, b long, value long")
    sums = staged(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "audit-pairs")
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = groups.select("lang", F.col("sid").alias("a"), "source")
    other = groups.select("lang", F.col("sid").alias("b"), F.col("source").alias("item"))
    pairs = both.join(name, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(place)).unionByName(beyond)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
  FROM documents
),
t AS (SELECT row, lang, source, unnest(found) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
total AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
ltotal AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
lc AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (coalesce(total.total, 0) + 5 * v.v) AS p
  FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang
  LEFT JOIN total ON total.lang = g.lang AND total.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
q AS (
  SELECT lc.lang, lc.term, 1 + (CAST(1000000000 AS HUGEINT) * (lc.n + 5)) // (ltotal.total + 5 * v.v) AS q
  FROM lc JOIN ltotal USING (lang) JOIN v USING (lang)
),
differ AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(differ.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN differ ON differ.lang = a.lang AND differ.source = a.source AND differ.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, CAST(p.p - q.q AS BIGINT)
  FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM every
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
