"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source is wanted ``target / size`` times: the whole part is taken outright,
the fraction is an inclusion probability. The flight phase moves the probabilities of a few
documents at a time along the null space of the constraints (number of documents and number of
words), until each is 0 or 1, so both totals of every source are kept while documents are
drawn. It runs over blocks of a source: a block leaves at most two undecided documents, these
meet in the blocks of the next level, and so on until a source has one block; only there the
landing phase drops the word constraint and decides the rest by the nearest outcome.

A level shrinks the undecided rows by the factor ``BLOCK / 2``, so the number of levels is the
logarithm of the corpus. Blocks are dealt by a hash of the row: a source that holds a third of
all rows is simply many blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarterdeck.llm.base import packed, ranged, small_side, staged, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # the mix as a multiple of all sizes
MOST = 2  # no document more often than this
BLOCK = 2048
MOST_LEVELS = 64  # far above the logarithm of any corpus; more is an error
LANDING = 12  # documents of a source's last block that are kept for the landing
_EDGE = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, ...) → with ``target``: shares by weight, capped at ``most`` x size.

    Weights repeat over the sources by code point, null last. What a cap leaves over is dealt to
    the others by weight until none is above its cap; a round is one aggregate, and only its two
    totals reach the driver, so the number of sources is not bounded.
    """
    order = [F.col("source").asc_nulls_last()]
    spread = ranged(sizes, order, "mix-sources")
    # The range partitions are few: one row for each carries the ranks before it.
    counts = spread.groupBy("_part").count()
    before = counts.select("_part", F.coalesce(F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    rank = F.col("_base") + F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(cycle, (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    ranked = staged(spread.join(before, "_part").withColumn("weight", weight).select(*sizes.columns, "weight"), "mix-weights")
    total = share * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    cap, level = F.col("source_size") * most, 0.0
    while True:
        free = cap > F.col("weight") * level if level else F.lit(True)
        row = ranked.agg(F.sum(F.when(free, F.col("weight"))).alias("w"), F.sum(F.when(~free, cap)).alias("c")).first()
        raised = (total - (row["c"] or 0)) / row["w"] if row["w"] else level
        if raised <= level:
            break
        level = raised
    return ranked.select(*sizes.columns, F.least(cap.cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def flight(p: np.ndarray, rows: np.ndarray, words: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """The flight phase on one block; at most two units stay undecided.

    Three undecided units at a time move along the vector that keeps the sums of ``p x rows``
    and of ``p x words``. ``draw`` are uniforms, one per unit; they make each step a martingale,
    so every unit keeps its probability.
    """
    p, n, s, coin = (v.astype(float).tolist() for v in (p, rows, words, draw))
    active: list[int] = []
    for nxt in range(len(p)):
        if not _EDGE < p[nxt] < 1 - _EDGE:
            p[nxt] = float(round(p[nxt]))
            continue
        active.append(nxt)
        while len(active) == 3:
            a, b, c = active
            move = [n[b] * s[c] - n[c] * s[b], n[c] * s[a] - n[a] * s[c], n[a] * s[b] - n[b] * s[a]]
            if not any(move):  # the constraints agree on these three: one of them is enough
                move = [n[b], -n[a], 0.0]
            most = max(map(abs, move))
            steps = [(i, m / most) for i, m in zip(active, move, strict=True) if m]
            up = min((1 - p[i]) / m if m > 0 else p[i] / -m for i, m in steps)
            down = min(p[i] / m if m > 0 else (1 - p[i]) / -m for i, m in steps)
            step = up if coin[a] * (up + down) < down else -down
            coin[a] = (coin[a] * 7919.0 + 0.123456789) % 1.0
            for i, m in steps:
                p[i] += step * m
            for i in active:
                if not _EDGE < p[i] < 1 - _EDGE:
                    p[i] = float(round(p[i]))
            active = [i for i in active if 0 < p[i] < 1]
    return np.array(p)


def land(p: np.ndarray, rows: np.ndarray, words: np.ndarray, wanted: tuple[float, float]) -> np.ndarray:
    """The landing: of all outcomes for a few units, the one nearest to ``wanted`` (rows, words)."""
    outcome = (np.arange(1 << len(p))[:, None] >> np.arange(len(p)) & 1).astype(float)
    away = np.abs(outcome @ words - wanted[1]) / max(1.0, words.mean()) + 0.1 * np.abs(outcome @ rows - wanted[0]) / max(1.0, rows.mean())
    return outcome[int(np.argmin(away))]


def _fly(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["draw", "key"]).reset_index(drop=True)
    p, rows, draw = (block[c].to_numpy(float) for c in ("p", "n", "draw"))
    words = rows * block["size"].to_numpy(float)
    if block["blocks"].iloc[0] > 1:
        block["p"] = flight(p, rows, words, draw)
        return block
    # The last block of a source: its largest undecided units wait for the landing.
    undecided = np.flatnonzero((p > _EDGE) & (p < 1 - _EDGE))
    held = np.sort(undecided[np.argsort(-words[undecided], kind="stable")[:LANDING]])
    wanted = (p @ rows, p @ words)
    flown = np.ones(len(p), bool)
    flown[held] = False
    p[flown] = flight(p[flown], rows[flown], words[flown], draw[flown])
    left = (p > 0) & (p < 1)
    if left.any():
        p[left] = land(p[left], rows[left], words[left], (wanted[0] - p[~left] @ rows[~left], wanted[1] - p[~left] @ words[~left]))
    block["p"] = np.round(p)
    return block


def _identity() -> list[Column]:
    doc_id, source = F.col("doc_id").cast("long"), F.col("source").cast("string")
    return [doc_id.alias("doc_id"), source.alias("source"), F.xxhash64(doc_id, source, F.col("text").cast("string")).alias("key")]


def _units(docs: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """One row per distinct (doc_id, source, text), with ``n`` equal rows and its ``copies``."""
    rows = docs.select(*_identity(), word_count(F.col("text").cast("string")).alias("size"))
    units = staged(rows.groupBy("source", "doc_id", "key", "size").agg(F.count("*").alias("n")), "mix-units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("source_units"))
    sizes = staged(sizes, "mix-sizes")
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "_s")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(wanted + 1e-6)  # a millionth below a whole number is that number
    waiting = units.join(targets, F.col("source").eqNullSafe(F.col("_s"))).select(
        "source", "doc_id", "key", "size", "n", "source_size", "target", whole.cast("int").alias("base"),
        F.greatest(wanted - whole, F.lit(0.0)).alias("p"),
        (F.shiftrightunsigned(F.xxhash64("key", "size"), 11) / F.lit(float(1 << 53))).alias("draw"),
        F.greatest(F.lit(1), F.ceil(F.col("source_units") / BLOCK)).cast("long").alias("blocks"),
    )
    decided = []
    for level in range(MOST_LEVELS):
        dealt = waiting.withColumn("block", F.pmod(F.xxhash64("key", F.lit(level)), F.col("blocks")))
        flown = staged(dealt.groupBy("source", "block").applyInPandas(_fly, dealt.schema).drop("block"), f"mix-{level}")
        decided.append(flown.where("p <= 0 OR p >= 1"))
        waiting = flown.where("p > 0 AND p < 1")
        if waiting.isEmpty():
            break
        waiting = waiting.withColumn("blocks", F.ceil(F.col("blocks") * 2 / BLOCK).cast("long"))
    else:
        raise RuntimeError(f"documents are still undecided after {MOST_LEVELS} levels")
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.withColumn("copies", (F.col("base") + F.round("p")).cast("int"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken``.

    ``copies`` (0 to ``most``) says how often the mix holds the row and ``taken`` the words of
    these copies. Reruns agree: draws are hashes of id, source and text. Rows that repeat all
    three are one unit and get the same copies. Null and empty texts have size 0 and are drawn
    like others; a source without words has target 0 and is left out. Null sources are a source
    of their own. Other columns are ignored.
    """
    each = _units(docs, weights, share, most).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: the rows and columns of ``docs``, each row as often as the mix takes it."""
    taken = staged(_units(docs, weights, share, most).where("copies > 0").select("key", "copies"), "mix-taken")
    joined = packed(docs, key=_identity()[2]).join(small_side(taken), "key")
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
