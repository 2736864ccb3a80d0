"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class is a Gaussian over the statistics of a text. Its covariance is shrunk towards the
pooled one and then towards a scaled identity; the Cholesky factors are computed once on the
driver and a score needs two triangular solves: the difference of the two log densities (half
squared Mahalanobis distances and log determinants) plus the log prior odds.

The model is fitted on every labelled training row: tasks sum counts, sums and products of the
statistics, so what reaches the driver is 2 x (1 + d + d^2) numbers whatever the corpus holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterdeck.llm.base import bucket, is_small, span_hashes, staged, text_blocks, words
from quarterdeck.llm.repeats import bitmap, may_hold

CUTOFF = 0.3
POOLING = 0.1  # weight of the pooled covariance in each class covariance
RIDGE = 0.02  # weight of the scaled identity
HOLD_OUT = 5


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 0xC0)
_KINDS = [
    _UPPER,
    _LOWER,
    _table("0123456789"),
    _table(".,;"),
    _table("!?"),
    _table("#$%&*@^~=+<>_\\/"),
    _table("|"),
    _table(" "),
    _table("\n"),
    np.arange(256) >= 0xC0,
]
STATISTICS = 20


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The transformed statistics of each text of a block, one row per text."""
    texts = len(offsets) - 1
    size = np.diff(offsets)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(flags.size + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    chars = np.maximum(per_text((data & 0xC0) != 0x80), 1)
    kind = [per_text(k[data]) / chars for k in _KINDS]
    start, end, first = words(data, offsets)
    word = span_hashes(data, start, end)
    length = (end - start).astype(np.float64)
    count = np.diff(first)
    some = np.maximum(count, 1)

    def per_word(values: np.ndarray) -> np.ndarray:
        total = np.zeros(values.size + 1)
        np.cumsum(values, out=total[1:])
        return (total[first[1:]] - total[first[:-1]]) / some

    mean = per_word(length)
    spread = np.sqrt(np.maximum(per_word(length**2) - mean**2, 0))
    again = np.zeros(word.size)
    again[1:] = word[1:] == word[:-1]
    last = data[end - 1] if end.size else np.zeros(0, np.uint8)
    distinct, top, lines = np.zeros(texts), np.zeros(texts), np.zeros(texts)
    breaks = np.flatnonzero(data == 10)
    line_at = np.searchsorted(breaks, offsets)
    for i in range(texts):
        if count[i]:
            kept = np.sort(word[first[i]: first[i + 1]])
            edge = np.flatnonzero(np.concatenate(([True], kept[1:] != kept[:-1], [True])))
            distinct[i] = (edge.size - 1) / count[i]
            top[i] = np.diff(edge).max() / count[i]
        if line_at[i + 1] > line_at[i]:
            cut = breaks[line_at[i]: line_at[i + 1]]
            a, b = np.concatenate(([offsets[i]], cut + 1)), np.concatenate((cut, [offsets[i + 1]]))
            lines[i] = 1 - np.unique(span_hashes(data[offsets[i]: offsets[i + 1]], a - offsets[i], b - offsets[i])).size / a.size
    small = 1e-3
    columns = [
        np.log1p(size), np.log1p(count), np.log(mean + 1), np.log(spread + 1),
        *[np.log(k + small) for k in kind],
        np.log(per_word(again) + small), np.log(distinct + small), np.log(top + small), np.log(lines + small),
        np.log(per_word(np.isin(last, [46, 33, 63])) + small),
        np.log(np.maximum(line_at[1:] - line_at[:-1], 0) + 1),
    ]
    return np.stack(columns, axis=1)


@dataclass(frozen=True)
class Discriminant:
    """Class means, Cholesky factors of the shrunk covariances, log determinants, log prior odds."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets, strict=True):
            whitened = np.linalg.solve(factor, (x - mean).T)
            density.append(-0.5 * ((whitened**2).sum(axis=0) + log_det))
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_odds, -60, 60)))


def discriminant(count: np.ndarray, total: np.ndarray, product: np.ndarray, pooling: float = POOLING, ridge: float = RIDGE) -> Discriminant:
    """The model from each class's count, sum and sum of products.

    A class without rows has the mean and covariance of the other one and half a row as prior.
    """
    d = total.shape[1]
    seen = np.maximum(count, 1)
    means = total / seen[:, None]
    scatter = product - seen[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter[count > 0].sum(axis=0) / max(1, count.sum()) if count.any() else np.eye(d)
    for k in (0, 1):
        if not count[k]:
            means[k] = means[1 - k]
    factors, log_dets = [], []
    for k in (0, 1):
        own = scatter[k] / seen[k] if count[k] else pooled
        own = (1 - pooling) * own + pooling * pooled
        own = (1 - ridge) * own + ridge * max(np.trace(own) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(own)
        factors.append(factor)
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    return Discriminant(means, np.stack(factors), np.array(log_dets), float(np.log(count[1] + 0.5) - np.log(count[0] + 0.5)))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, stop, data, offsets in text_blocks(batch.column(1)):
            flat = statistics(data, offsets).ravel()
            ends = np.arange(stop - row + 1, dtype=np.int32) * STATISTICS
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, stop - row), pa.ListArray.from_arrays(ends, flat)], names=["doc_id", "x"])


def _add(held: np.ndarray, label: np.ndarray, x: np.ndarray) -> None:
    """Adds the count, sum and sum of products of each label's rows of ``x``."""
    for k in (0, 1):
        if (label == k).any():
            own = x[label == k]
            held[k] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))


def _text_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros((2, 1 + STATISTICS + STATISTICS**2))
    for batch in batches:
        label = batch.column(0).to_numpy()
        for row, stop, data, offsets in text_blocks(batch.column(1)):
            _add(held, label[row:stop], statistics(data, offsets))
    k, at = np.repeat([0, 1], held.shape[1]), np.tile(np.arange(held.shape[1]), 2)
    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(at, pa.int32()), pa.array(held.ravel())], names=["k", "at", "v"])


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = np.zeros((2, 1 + STATISTICS + STATISTICS**2))
    for rows in batches:
        if len(rows):
            _add(held, rows["label"].to_numpy(), np.stack(rows["x"].to_numpy()))
    yield pd.DataFrame({"k": np.repeat([0, 1], held.shape[1]), "at": np.tile(np.arange(held.shape[1]), 2), "v": held.ravel()})


def fit(docs: DataFrame, labels: DataFrame, pooling: float = POOLING, ridge: float = RIDGE) -> Discriminant:
    """Fits on every document outside the hold-out that has a quality label of 0 or 1.

    Several labels of a document count by majority; a draw is left out, as are null ids.
    """
    mark = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.avg("quality").alias("_q"))
    mark = staged(mark.where("_q <> 0.5").select(F.col("_id").cast("long").alias("_id"), (F.col("_q") > 0.5).cast("int").alias("label")), "quality-labels")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = F.col("doc_id").isNotNull() & (bucket(F.col("doc_id"), HOLD_OUT) != 0)
    near, same, moments = narrow.where(labelled), F.col("doc_id") == F.col("_id"), "k int, at int, v double"
    if is_small(mark):
        # One Python step, so that a core keeps one worker: few labels go to the texts.
        parts = near.join(F.broadcast(mark), same).select("label", "text").mapInArrow(_text_moments, moments)
    else:
        # A bitmap of the labelled ids keeps most texts without a label out of the statistics.
        train = near.where(may_hold(bitmap(mark, "_id"), "doc_id")).mapInArrow(_statistics, "doc_id long, x array<double>")
        parts = train.join(mark.hint("merge"), same).select("label", "x").mapInPandas(_moments, moments)
    sums = parts.groupBy("k", "at").agg(F.sum("v").alias("v"))
    held = np.zeros((2, 1 + STATISTICS + STATISTICS**2))
    for k, at, v in sums.collect():  # 2 x (1 + d + d^2) rows
        held[k, at] = v
    return discriminant(held[:, 0], held[:, 1: 1 + STATISTICS], held[:, 1 + STATISTICS:].reshape(2, STATISTICS, STATISTICS), pooling, ridge)


def scored(docs: DataFrame, model: Discriminant, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (score >= 0.3).

    Only the text decides. Null and empty texts get the score of a text without words; columns
    of ``docs`` named ``score`` or ``predicted`` are replaced.
    """
    kept = docs.drop("score", "predicted")
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.score(statistics(data, offsets)) for _, _, data, offsets in text_blocks(batch.column(at).cast(pa.string()))]
            score = np.concatenate(parts) if parts else np.zeros(0)
            both = [pa.array(score), pa.array((score >= CUTOFF).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *both], names=[*batch.schema.names, "score", "predicted"])

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; fits on rows outside the hold-out."""
    model = fit(docs, labels)
    held = (bucket(F.col("doc_id"), HOLD_OUT) == 0).alias("held_out")
    return scored(docs.select("doc_id", "text"), model).select("doc_id", held, "score", "predicted")
