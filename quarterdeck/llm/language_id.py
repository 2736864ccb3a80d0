"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

The features of a text are its hashed character 1- to 3-grams (letters in lower case, anything
else a blank) with weight (1 + ln tf) x idf and unit length. Document frequencies come from all
training texts; the weights are learned by follow-the-regularised-leader (proximal, per
coordinate, elastic net) on a bounded sample of them, and a temperature fitted on a part of the
sample that the weights have not seen makes the scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarterdeck.llm.base import bucket, staged

DIMENSIONS = 1 << 15
ORDERS = 3
BROADCAST_ROWS = 100_000  # of the sample's keys sent along at most; beyond, a join by shuffle
SAMPLE_PER_LANGUAGE = 1000  # the bound of the rows that the weights are learned from
EPOCHS = 3
ALPHA, BETA, LAMBDA_1, LAMBDA_2 = 0.5, 1.0, 0.02, 0.01
HOLD_OUT, HELD = 3, 1
UNDETERMINED = "und"
_PIECE = 1 << 20  # characters counted at once


def has_letter(text: str) -> bool:
    """Whether a text has a letter; digits of any script, fractions and circled numbers are none."""
    return any(c.isalpha() for c in text)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The features of a whole text and how often each occurs."""
    total = np.zeros(DIMENSIONS, np.int64)
    for begin in range(0, len(text), _PIECE):
        # Pieces overlap so that every n-gram is counted once, in the piece in which it begins.
        piece = text[begin: begin + _PIECE + ORDERS - 1].lower()
        chars = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
        letters = np.where((chars >= 0xAA) | ((chars >= 97) & (chars <= 122)), chars, np.uint32(32)) * np.uint32(2654435761)
        code = np.zeros(chars.size, np.uint32)
        more = begin + _PIECE < len(text)
        for order in range(1, ORDERS + 1):
            size = chars.size - order + 1
            if size <= 0:
                break
            code = (code[:size] ^ letters[order - 1: order - 1 + size]) * np.uint32(2246822519) + np.uint32(order)
            stop = min(size, _PIECE) if more else size
            total += np.bincount((code[:stop] ^ (code[:stop] >> np.uint32(15))) >> np.uint32(17), minlength=DIMENSIONS)
    at = np.flatnonzero(total)
    return at, total[at]


def weighted(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(count)) * idf[at]
    return value / max(float(np.sqrt((value**2).sum())), 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # one row per feature, then the bias
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not has_letter(text):
            return UNDETERMINED, 0.0
        at, count = gram_counts(text)
        chance = softmax((weighted(at, count, self.idf) @ self.weights[at] + self.weights[-1]) / self.temperature)
        best = int(np.argmax(chance))
        return self.languages[best], float(chance[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Learns the weights: one row per feature and one for the bias, a column per class."""
    z, n = np.zeros((DIMENSIONS + 1, classes)), np.zeros((DIMENSIONS + 1, classes))

    def leader(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - LAMBDA_1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + LAMBDA_2)

    for _ in range(epochs):
        for at, value, label in rows:
            at, value = np.append(at, DIMENSIONS), np.append(value, 1.0)
            z_at, n_at = z[at], n[at]
            w = leader(z_at, n_at)
            error = softmax(value @ w)
            error[label] -= 1
            g = value[:, None] * error[None, :]
            sigma = (np.sqrt(n_at + g * g) - np.sqrt(n_at)) / ALPHA
            z[at] = z_at + g - sigma * w
            n[at] = n_at + g * g
    return leader(z, n)


def calibrated(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        chance = np.log(np.maximum(softmax(scores / np.exp(log_t)), 1e-300))
        # One row more than there are, of any language: without errors the scores stay below one.
        return float(-(chance[np.arange(len(labels)), labels].sum() + chance.mean()))

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, texts = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            total[gram_counts(text)[0]] += 1
            texts += 1
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], texts))], names=["feature", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [gram_counts(text) for text in batch.column(1).to_pylist()]
        at = pa.array([a.astype(np.int32) for a, _ in both], pa.list_(pa.int32()))
        count = pa.array([c.astype(np.int32) for _, c in both], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), at, count, batch.column(2)], names=["lang", "at", "count", "turn"])


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Learns from the texts and non-null languages outside the hold-out.

    Document frequencies count all of them. The weights see at most ``per_language`` texts of
    each language, the first by a hash of id and text (equal rows count once); every fifth of these
    is kept for the temperature.
    """
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(bucket(F.col("doc_id"), HOLD_OUT) != HELD)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    frequencies = known.select("text").mapInArrow(_document_frequencies, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df, texts = np.zeros(DIMENSIONS), 0
    for feature, n in frequencies.collect():  # one row per hashed feature at most
        if feature < 0:
            texts = n
        else:
            df[feature] = n
    idf = np.log((1 + texts) / (1 + df)) + 1

    # The first texts of each language by a hash: a threshold on it leaves a few times as many as
    # wanted, however many there are, and only these are put in order. Equal rows count once.
    keyed = known.withColumn("key", F.xxhash64("doc_id", "text"))
    distinct = keyed.select("lang", "key").distinct()
    sizes = distinct.groupBy(F.col("lang").alias("_lang")).agg((F.lit(4.0 * per_language) / F.count("*")).alias("share"))
    low = F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))
    few = distinct.join(sizes, F.col("lang") == F.col("_lang")).where(low < F.col("share")).select("lang", "key")
    place = W.partitionBy("lang").orderBy(F.shiftrightunsigned("key", 11), "key")
    chosen = few.withColumn("turn", F.row_number().over(place)).where(F.col("turn") <= per_language)
    chosen = staged(chosen.select(F.col("key").alias("_key"), F.col("lang").alias("_lang"), "turn"), "language-sample")
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    sample = keyed.join(chosen, (F.col("key") == F.col("_key")) & (F.col("lang") == F.col("_lang")))
    sample = sample.select("lang", "text", "turn").dropDuplicates(["lang", "turn"])
    rows = sample.mapInArrow(_features, "lang string, at array<int>, count array<int>, turn int").toPandas()
    rows = rows.sort_values(["turn", "lang"], kind="stable")
    languages = sorted(set(rows["lang"]))
    name = {lang: i for i, lang in enumerate(languages)}
    vectors = [(np.asarray(a, np.int64), weighted(np.asarray(a, np.int64), np.asarray(c), idf), name[x]) for x, a, c in zip(rows["lang"], rows["at"], rows["count"], strict=True)]
    seen = [v for v, turn in zip(vectors, rows["turn"], strict=True) if turn % 5]
    unseen = [v for v, turn in zip(vectors, rows["turn"], strict=True) if not turn % 5]
    weights = follow_the_leader(seen, len(languages))
    scores = np.array([value @ weights[at] + weights[-1] for at, value, _ in unseen])
    return LanguageModel(languages, idf, weights, calibrated(scores, np.array([label for _, _, label in unseen], int)))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from the whole text alone.

    A text that is null or has no letter is ``und`` with score 0, as is every text if no
    language was learned. Texts are read whole, however long, in pieces; of languages with equal
    scores the first by name wins. Repeated rows stay; an empty table gives no rows; other columns
    are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # its size follows the number of languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.predict(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` with a model learned outside the hold-out."""
    found = identify(docs, fit(docs))
    return found.select("doc_id", (bucket(F.col("doc_id"), HOLD_OUT) == HELD).alias("held_out"), "lang_pred", "score")
