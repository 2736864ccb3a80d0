"""Document fingerprints by consistent weighted sampling.

The terms of a text are its lower-cased words, weighted by how often they occur. For every
sample number and term two gamma(2, 1) variates ``r`` and ``c`` and a uniform ``b`` are drawn from
a hash of both; a term of weight ``w`` offers ``t = floor(ln w / r + b)`` and
``ln a = ln c - r (t - b) - r``, and the sample is the term and ``t`` of the least ``a``. Two texts
agree in a sample with probability sum(min(w, v)) / sum(max(w, v)), the generalised Jaccard
similarity, so the share of equal samples estimates it. ``ln a`` itself, rounded, stands for the
term and ``t`` in the fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.base import lower, mix, span_hashes, words

SAMPLES = 64
_GRID = float(1 << 20)  # ln a is kept in steps of 2^-20, far above any rounding difference
_EMPTY = np.iinfo(np.int32).max
_BLOCK = 1 << 19
_TERMS = 1 << 11


def _uniform(bits: np.ndarray, shift: int) -> np.ndarray:
    """24 bits of a hash as a number inside (0, 1)."""
    return ((bits >> np.uint64(shift) & np.uint64(0xFFFFFF)).astype(np.float64) + 0.5) / (1 << 24)


def _variates(terms: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``r``, ``b`` and ``ln c`` of each term (rows) and sample (columns)."""
    seed = mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    one = mix(terms[:, None] ^ seed[None, :])
    two = mix(one + np.uint64(0x9E3779B97F4A7C15))
    three = mix(two + np.uint64(0x9E3779B97F4A7C15))
    r = -np.log(_uniform(one, 0) * _uniform(one, 32))
    c = -np.log(_uniform(two, 0) * _uniform(two, 32))
    return r, _uniform(three, 0), np.log(c)


def _offers(terms: np.ndarray, log_weight: np.ndarray, samples: int) -> np.ndarray:
    """``ln a`` of each term at its weight, on the grid."""
    out = np.empty((terms.size, samples), np.int32)
    for i in range(0, terms.size, _TERMS):
        r, b, log_c = _variates(terms[i: i + _TERMS], samples)
        t = np.floor(log_weight[i: i + _TERMS, None] / r + b)
        out[i: i + _TERMS] = np.rint((log_c - r * (t - b) - r) * _GRID)
    return out


def fingerprints(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """The samples of each text, one row per text. A text without words has one fixed row."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    data = lower(np.frombuffer(b"".join(raw), np.uint8))
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    start, end, first = words(data, offsets)
    word = span_hashes(data, start, end)
    terms, weights, cuts = [], [], [0]
    for i in range(len(texts)):
        term, weight = np.unique(word[first[i]: first[i + 1]], return_counts=True)
        terms.append(term)
        weights.append(weight)
        cuts.append(cuts[-1] + term.size)
    out = np.full((len(texts), samples), _EMPTY, np.int32)
    if not cuts[-1]:
        return out
    # A term at a weight makes one offer, however many texts of the block have it.
    term, weight = np.concatenate(terms), np.concatenate(weights)
    order = np.lexsort((weight, term))
    new = np.concatenate(([True], (term[order][1:] != term[order][:-1]) | (weight[order][1:] != weight[order][:-1])))
    row = np.empty(order.size, np.int64)
    row[order] = np.cumsum(new) - 1
    offers = _offers(term[order][new], np.log(weight[order][new].astype(np.float64)), samples)
    for i in range(len(texts)):
        if cuts[i + 1] > cuts[i]:
            out[i] = offers[row[cuts[i]: cuts[i + 1]]].min(axis=0)
    return out


def written(row: np.ndarray) -> str:
    return row.astype(">i4").tobytes().hex()


def fingerprint_documents(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, fingerprint`` of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found: list[str] = []
            for block in _blocks(texts):
                found += [written(row) for row in fingerprints(block, samples)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fingerprint string")


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block, held = [], 0
    for text in texts:
        block.append(text)
        held += len(text)
        if held >= _BLOCK:
            yield block
            block, held = [], 0
    if block:
        yield block


# ---- each document against its edited text and the next document -------------------------------

_REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the beginning of ``following``."""
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]


def _compare(samples: int):
    def report(rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
        changed = [edited(text, following) for _, text, following in rows]
        # The next text of a row is the text of the row after it, except at the end of a block.
        chained = [text for _, text, _ in rows] + [rows[-1][2]]
        same_chain = all(rows[i][2] is rows[i + 1][1] for i in range(len(rows) - 1))
        every = fingerprints(chained + changed + ([] if same_chain else [f for _, _, f in rows]), samples)
        own, other = every[: len(rows)], every[len(rows) + 1: 2 * len(rows) + 1]
        after = every[1: len(rows) + 1] if same_chain else every[2 * len(rows) + 1:]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _, _ in rows], pa.int64()),
                pa.array([len(t) for _, t, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
                pa.array([written(x) for x in own]),
                pa.array([written(x) for x in other]),
                pa.array((own == other).mean(axis=1)),
                pa.array((own == after).mean(axis=1)),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[int | None, str, str]] = []
        held, last, group, closed = 0, None, None, False
        for batch in batches:
            for to, ghost, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                text = text or ""
                if to != group:
                    group, last, closed = to, None, False
                if closed:
                    continue
                if last is not None:
                    block.append((*last, text))
                    held += 2 * len(last[1])
                    if held >= _BLOCK:
                        yield report(block)
                        block, held = [], 0
                last, closed = (doc_id, text), bool(ghost)
        if block:
            yield report(block)

    return run


def compare_neighbours(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Every document against its edited text and the next document by descending id.

    Ids are cut into ranges of about equal counts; a range is sorted and streamed by one task,
    and the first document of the next range is sent along as its last neighbour, so each text is
    shuffled once (two times for one document per range) and no task holds a range in memory.
    Null ids come last; rows with equal ids stand by text; the last row's next is the first. A
    single document is its own next. Null texts count as empty, texts without words are alike.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 4 * tasks
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("cuts")).first()["cuts"]
    bounds = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64)) + 1
        return pd.Series(np.where(ids.isna(), 0, at))

    dealt = rows.withColumn("part", place("doc_id"))
    # One row for each range: its largest id.
    heads = sorted(((r["part"], r["first"]) for r in rows.select("doc_id").withColumn("part", place("doc_id")).groupBy("part").agg(F.max("doc_id").alias("first")).collect()), reverse=True)
    before = [(part, first, heads[i - 1][0]) for i, (part, first) in enumerate(heads)]
    along = F.broadcast(spark.createDataFrame(before, "_part int, _first long, _to int"))
    marked = dealt.join(along, (F.col("part") == F.col("_part")) & F.col("doc_id").eqNullSafe(F.col("_first")), "left")
    own = F.struct(F.col("part").alias("to"), F.lit(0).alias("ghost"))
    guest = F.when(F.col("_part").isNotNull(), F.struct(F.col("_to").alias("to"), F.lit(1).alias("ghost")))
    sent = marked.select("doc_id", "text", F.explode(F.array_compact(F.array(own, guest))).alias("at")).select("at.to", "at.ghost", "doc_id", "text")
    ordered = sent.repartition(tasks, "to").sortWithinPartitions("to", "ghost", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return ordered.mapInArrow(_compare(samples), _REPORT)
