"""What the training-data operators share: shared-folder tables, gapless indexes, byte hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarterdeck.session import scratch_path
from quarterdeck.streaming.upsert import delete_path

# The word separators of the operator contracts (space, tab..carriage return).
SEPARATORS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BLOCK_BYTES = 1 << 20
BROADCAST_KEYS = 500_000  # rows of a few numbers, about 20 MB as a hash table
BATCH_BYTES = 4 << 20
_BATCH_BOUND, _SPARK_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"  # with Spark's default


# The folder of each staged table that is still in use.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES``, so that a batch of long texts takes little of a
    worker's memory; a bound that the session has set itself stays."""
    if spark.conf.get(_BATCH_BOUND) == _SPARK_BATCH_BYTES:
        spark.conf.set(_BATCH_BOUND, str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage, so that what follows survives lost executors without repeating the work
    before it, and every later reader sees the same rows.
    """
    bounded_batches(df.sparkSession)
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes staged tables; call it when everything that reads them is itself staged."""
    for table in tables:
        path = _FOLDERS.pop(table, None)
        if path:
            delete_path(table.sparkSession, path)


def is_small(keys: DataFrame) -> bool:
    """Whether ``keys`` (narrow and staged) has at most ``BROADCAST_KEYS`` rows."""
    return keys.count() <= BROADCAST_KEYS


def small_side(keys: DataFrame) -> DataFrame:
    """``keys``, sent along with a join if it is small; a larger one is joined by shuffle."""
    return F.broadcast(keys) if is_small(keys) else keys


def packed(df: DataFrame, **keys: Column) -> DataFrame:
    """``df`` as one struct column ``row`` beside ``keys``, so that no column name can clash."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    return df.select(whole, *[key.alias(name) for name, key in keys.items()])


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def bucket(column: Column, modulus: int) -> Column:
    """CRC-32 of a column as text, modulo ``modulus`` (null as empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def ranged(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` sorted globally into staged range partitions; ``_part`` is the partition's number.

    Rows that tie on every ordering column are told apart by a row id, so that a crowd of equal
    rows is dealt over several partitions.
    """
    keyed = df.withColumn("_tie", F.monotonically_increasing_id())
    spread = keyed.repartitionByRange(*order, F.col("_tie").asc())
    return staged(spread.withColumn("_part", F.spark_partition_id()), name)


def running(df: DataFrame, within: list[str], order: list[Column], value: Column, into: str, name: str) -> DataFrame:
    """Adds ``into``: the sum of ``value`` over the rows before this one, per ``within`` group.

    The global order is ``within`` then ``order``. Each range partition sums its own rows; what
    earlier partitions hold of the same group is added from one row per partition and group, so
    no group has to fit into one task.
    """
    spread = ranged(df, [*[F.col(c).asc_nulls_last() for c in within], *order], name)
    parts = spread.groupBy("_part", *within).agg(F.sum(value).alias("_v"))
    before = parts.select(
        "_part", *[F.col(c).alias(f"_g_{c}") for c in within],
        F.coalesce(F.sum("_v").over(W.partitionBy(*within).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
    )
    local = W.partitionBy("_part", *within).orderBy(*order, F.col("_tie").asc()).rowsBetween(W.unboundedPreceding, -1)
    summed = spread.withColumn("_local", F.coalesce(F.sum(value).over(local), F.lit(0)))
    on = [summed["_part"] == before["_part"], *[summed[c].eqNullSafe(before[f"_g_{c}"]) for c in within]]
    joined = summed.join(before, on).withColumn(into, F.col("_base") + F.col("_local"))
    return joined.select(*df.columns, into)


# ---- byte hashing inside tasks -----------------------------------------------------------------

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return table(_BASE), table(_BASE_INVERSE)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span ``data[start:end]``, from one running sum over the bytes."""
    up, down = _powers(1 << max(20, int(max(1, data.size)).bit_length()))
    total = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_BYTE[data] * down[: data.size], out=total[1:])
    return mix((total[end] - total[start]) * up[start] + (end - start).astype(np.uint64))


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of ``inside`` bytes, and per text the index of its first run."""
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < inside.size)]
    begin[cut] = inside[cut]
    stop[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return start, end, np.searchsorted(start, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``data``, and per text the index of its first word."""
    return runs(~_SEPARATOR[data], offsets)


def run_strings(data: np.ndarray, inside: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.DictionaryArray:
    """The runs of :func:`runs` as dictionary-encoded strings; equal codes are equal strings."""
    ends = np.zeros(start.size + 1, np.int64)
    np.cumsum(end - start, out=ends[1:])
    raw = pa.py_buffer(np.ascontiguousarray(data[inside]))
    return pa.Array.from_buffers(pa.large_string(), start.size, [None, pa.py_buffer(ends), raw]).dictionary_encode()


def lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def text_blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about ``size`` bytes.

    A null text has no bytes. A longer text is a block of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        yield row, end, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end
