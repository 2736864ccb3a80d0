"""Suffix-array dedup: removes every byte covered by a 200-byte string that occurs elsewhere.

A 200-byte window has an anchor: the 32-byte gram of least hash in it, which its content alone
decides. Equal windows therefore have equal anchors at equal places, and all windows of a text
with one anchor are one short segment around it. So

1. every text yields its segments as (anchor hash, segment hash, places), without bytes;
2. an anchor that occurs once holds no repeat, and a segment that occurs twice is repeated whole,
   whoever the copies belong to: both are settled by counts, with map-side combination;
3. what is left are anchors with several different segments. The bytes of one occurrence of each
   are fetched and sorted in blocks of whole anchors by two-stage suffix sorting; windows whose
   common prefix with a neighbour in that order reaches 200 bytes are repeated;
4. the verdicts return to the texts that have them.

An anchor with more segments than a block holds (a passage between ever different neighbours) is
dealt over several blocks, each sorted as any other. What its blocks still have to tell each other
is which windows they hold: the different windows of a block, packed by hash, so what is common to
all segments travels once per block. Texts go by a 64-bit hash of their content, so copies are read
once. Fixed-size bitmaps keep texts and segments that cannot take part out of the shuffles; they
only ever let too much through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.base import _BYTE, mix, release, span_hashes, staged, text_blocks
from quarterdeck.llm.suffix_sort import common_prefixes, suffix_order

LENGTH = 200
GRAM = 32
BLOCK_SEGMENTS = 2048  # about half a megabyte to sort at once; anchors with more segments take several blocks
BROADCAST_ANCHORS = 100_000  # dealt anchors sent along at most; beyond, a join by shuffle
_MAP_BITS = 24
_PLACE_BITS = 24
_PIECE = 1 << 20

_SEGMENTS = "content long, anchor long, segment long, windows int, places array<int>"


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` (a power of two) bytes at each place, by doubling."""
    out, step = _BYTE[data], 1
    while step < gram:
        out = out[:-step] * np.uint64(0x9FB21C651E98DF25) + out[step:]
        out ^= out >> np.uint64(29)
        step *= 2
    return out


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """The segments of the texts of a block: text, first window, windows, anchor, content hash."""
    size = np.diff(offsets)
    count = np.maximum(size - length + 1, 0)
    if not count.any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    grams = gram_hashes(data, gram)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = sliding_least((grams & ~low) | np.arange(grams.size, dtype=np.uint64), length - gram + 1)
    # The windows inside a text, not those across two.
    text = np.repeat(np.arange(count.size), count)
    window = np.arange(text.size) - np.repeat(np.cumsum(count) - count, count) + offsets[:-1][text]
    place = (least[window] & low).astype(np.int64)
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])))
    at = np.flatnonzero(new)
    many = np.diff(np.append(at, text.size))
    first, place = window[at], place[at]
    content = span_hashes(data, first, first + many - 1 + length)
    return text[at], first - offsets[:-1][text[at]], many, mix(grams[place]), mix(content ^ (place - first).astype(np.uint64))


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """:func:`segments`; a text longer than a piece is cut, its windows shared out."""
    if data.size <= 2 * _PIECE:
        return segments(data, offsets, length, gram)
    parts = []
    for text in range(len(offsets) - 1):
        for begin in range(int(offsets[text]), int(offsets[text + 1]), _PIECE):
            piece = data[begin: min(begin + _PIECE + length - 1, offsets[text + 1])]
            _, first, *rest = segments(piece, np.array([0, piece.size]), length, gram)
            parts.append((np.full(first.size, text), first + begin - offsets[text], *rest))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _list_segments(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in text_blocks(batch.column(1)):
                text, first, many, anchor, content = _pieces(data, offsets, length, gram)
                if not text.size:
                    continue
                order = np.lexsort((first, content, anchor, text))
                text, first, many, anchor, content = (x[order] for x in (text, first, many, anchor, content))
                new = np.ones(text.size, bool)
                new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]) | (many[1:] != many[:-1])
                at = np.flatnonzero(new)
                ends = np.append(at, text.size).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, stop - row).take(pa.array(text[at])),
                        pa.array(anchor[at].view(np.int64)), pa.array(content[at].view(np.int64)), pa.array(many[at].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(first.astype(np.int32))),
                    ],
                    names=["content", "anchor", "segment", "windows", "places"],
                )

    return run


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """A fixed-size bitmap (2 MB) of the low bits of a key column."""
    low = F.pmod(F.col(column), F.lit(1 << _MAP_BITS))
    words = keys.groupBy(F.shiftright(low, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(low, F.lit(64)).cast("int"))).alias("bits"))
    out = np.zeros(1 << (_MAP_BITS - 6), np.uint64)
    rows = words.toPandas()
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def may_hold(bits: np.ndarray, column: str) -> Column:
    @F.pandas_udf("boolean")
    def known(keys: pd.Series) -> pd.Series:
        low = keys.to_numpy(np.int64) & ((1 << _MAP_BITS) - 1)
        return pd.Series((bits[low >> 6] >> (low & 63).astype(np.uint64) & np.uint64(1)).astype(bool))

    return known(F.col(column))


def _cut_out(length: int):
    """(content, text, wanted segments) → the bytes of each wanted segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, names, raws = [], [], []
            for text, wanted in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_buffer()
                for want in wanted.as_py():
                    anchors.append(want["anchor"])
                    names.append(want["segment"])
                    raws.append(data[want["place"]: want["place"] + want["windows"] - 1 + length].to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(names, pa.int64()), pa.array(raws, pa.binary())], names=["anchor", "segment", "raw"])

    return run


def repeated_windows(raws: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment which of its windows occur in another one, by suffix sorting."""
    size = np.array([len(r) for r in raws])
    text = np.frombuffer(b"".join(raws), np.uint8)
    begin = np.cumsum(size) - size
    order = suffix_order(text, length)
    owner = np.repeat(np.arange(size.size), size)
    whole = order[begin[owner[order]] + size[owner[order]] - order >= length]
    equal = common_prefixes(text, whole, length) >= length
    found = np.zeros(text.size, bool)
    found[whole[:-1][equal]] = True
    found[whole[1:][equal]] = True
    return [found[b: b + s - length + 1] for b, s in zip(begin, size, strict=True)]


_SORTED = "anchor long, segment long, flags binary, bucket int, window binary, owner binary, at binary, alone binary"


def _sort_block(length: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        # A block's anchors are sorted in runs of about BLOCK_SEGMENTS: the keys of a run fit a task.
        rows = rows.sort_values("anchor", kind="stable", ignore_index=True)
        ends = np.append(np.flatnonzero(np.diff(rows["anchor"].to_numpy())) + 1, len(rows))
        found, begin = [], 0
        for end, after in zip(ends, np.append(ends[1:], np.iinfo(np.int64).max), strict=True):
            if after - begin > BLOCK_SEGMENTS:
                found += repeated_windows(list(rows["raw"][begin:end]), length)
                begin = end
        out = [(a, s, np.packbits(f).tobytes(), -1, None, None, None, None) for a, s, f in zip(rows["anchor"], rows["segment"], found, strict=True)]
        if key[0]:
            for anchor, part in rows.groupby("anchor"):
                held = held_windows(part["segment"].to_numpy(np.int64), list(part["raw"]), length)
                bucket = (held[0].view(np.uint64) % np.uint64(part["many"].iloc[0])).astype(np.int64)
                for number in np.unique(bucket):
                    out.append((anchor, 0, None, int(number), *(x[bucket == number].tobytes() for x in held)))
        return pd.DataFrame(out, columns=["anchor", "segment", "flags", "bucket", "window", "owner", "at", "alone"])

    return run


def held_windows(segments: np.ndarray, raws: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different windows of a block: hash, segment and place of the first, and whether it is alone."""
    size = np.array([len(r) for r in raws])
    begin, many = np.cumsum(size) - size, size - length + 1
    row = np.repeat(np.arange(size.size), many)
    at = np.arange(row.size) - np.repeat(np.cumsum(many) - many, many)
    window = span_hashes(np.frombuffer(b"".join(raws), np.uint8), begin[row] + at, begin[row] + at + length)
    window, first, count = np.unique(window, return_index=True, return_counts=True)
    return window.view(np.int64), segments[row[first]], at[first].astype(np.int32), count == 1


def _across(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """What the blocks of an anchor hold of one bucket → the windows alone in their block that another block has."""
    window, owner, at, alone = (np.frombuffer(b"".join(rows[c]), t) for c, t in (("window", np.int64), ("owner", np.int64), ("at", np.int32), ("alone", bool)))
    _, place, count = np.unique(window, return_inverse=True, return_counts=True)
    met = alone & (count[place] > 1)
    places = pd.DataFrame({"segment": owner[met], "at": at[met]}).groupby("segment")["at"]
    return pd.DataFrame([(key[0], segment, _flags(x)) for segment, x in places], columns=["anchor", "segment", "flags"])


def _flags(places: pd.Series) -> bytes:
    out = np.zeros(int(places.max()) + 1, bool)
    out[places.to_numpy(np.int64)] = True
    return np.packbits(out).tobytes()


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, parts in zip(batch.column(1), batch.column(2), strict=True):
                data = np.frombuffer(text.as_buffer(), np.uint8) if len(text.as_buffer()) else np.zeros(0, np.uint8)
                edge = np.zeros(data.size + 1, np.int64)
                for part in parts.as_py() or ():
                    if part["flags"] is None:
                        for place in part["places"]:
                            edge[place] += 1
                            edge[place + part["windows"] - 1 + length] -= 1
                    else:
                        at = np.flatnonzero(np.unpackbits(np.frombuffer(part["flags"], np.uint8))[: part["windows"]])
                        for place in part["places"]:
                            np.add.at(edge, place + at, 1)
                            np.add.at(edge, place + at + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if gone.size else 0)
                kept.append(data[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.as_buffer()) for t in batch.column(1)], pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row of ``docs``.

    ``kept`` are the UTF-8 bytes (binary: a removal may cut a character) that no ``length``-byte
    string covers which also starts anywhere else in the input, in the same text included. Null
    texts count as empty; texts under ``length`` bytes stay whole; rows that repeat a text lose
    it. Other columns are ignored.
    """
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("text"), F.xxhash64(raw).alias("content"))
    listed = staged(rows.select("content", "text").mapInArrow(_list_segments(length, gram), _SEGMENTS), "repeat-segments")

    counted = listed.groupBy("anchor").agg(F.sum(F.size("places")).alias("n"), F.min("segment").alias("lo"), F.max("segment").alias("hi"))
    shared = staged(counted.where("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("mixed")), "repeat-anchors")
    near = listed.where(may_hold(bitmap(shared, "anchor"), "anchor"))
    found = staged(near.join(shared, "anchor"), "repeat-shared")

    # Of anchors with several segments: each segment's count and one of its occurrences.
    one = F.min(F.struct("content", F.element_at("places", 1).alias("place"), "windows")).alias("one")
    several = found.where("mixed").groupBy("anchor", "segment").agg(F.sum(F.size("places")).alias("n"), one)
    several = staged(several, "repeat-several")
    # Where every segment of an anchor occurs twice there is nothing left to compare.
    unsettled = several.groupBy("anchor").agg(F.min("n").alias("least")).where("least = 1").select("anchor")
    wanted = several.join(unsettled, "anchor", "left_semi").select(F.col("one.content").alias("content"), F.struct("anchor", "segment", F.col("one.place").alias("place"), F.col("one.windows").alias("windows")).alias("want"))
    wanted = staged(wanted.groupBy("content").agg(F.collect_list("want").alias("wanted")), "repeat-wanted")
    holders = rows.where(may_hold(bitmap(wanted, "content"), "content")).select("content", "text")
    fetched = holders.join(wanted, "content").dropDuplicates(["content"]).select("text", "wanted")
    fetched = staged(fetched.mapInArrow(_cut_out(length), "anchor long, segment long, raw binary"), "repeat-bytes")

    weight = fetched.groupBy("anchor").agg(F.ceil(F.count("*") / BLOCK_SEGMENTS).cast("int").alias("many"))
    hot = staged(weight.where("many > 1"), "repeat-hot")
    along = F.broadcast(hot) if hot.count() <= BROADCAST_ANCHORS else hot
    blocks = max(1, -(-fetched.count() // BLOCK_SEGMENTS))
    # Dealt anchors have blocks of their own (``own`` is not 0), all others share blocks.
    dealt = fetched.join(along, "anchor", "left").withColumns({
        "own": F.when(F.col("many").isNotNull(), F.coalesce(F.nullif("anchor", F.lit(0)), F.lit(1))).otherwise(F.lit(0)),
        "block": F.when(F.col("many").isNotNull(), F.pmod(F.xxhash64("segment"), "many")).otherwise(F.pmod(F.xxhash64("anchor"), F.lit(blocks))),
    })
    in_block = staged(dealt.groupBy("own", "block").applyInPandas(_sort_block(length), _SORTED), "repeat-sorted")
    # A row is a segment with its flags, or (bucket >= 0) windows of a block of a dealt anchor.
    # A window that is alone in its block of a dealt anchor is repeated if another block holds it.
    windows = in_block.where("bucket >= 0").select("anchor", "bucket", "window", "owner", "at", "alone")
    across = windows.groupBy("anchor", "bucket").applyInPandas(_across, "anchor long, segment long, flags binary")
    once = several.where("n = 1").select("anchor", "segment")
    flags = staged(in_block.where("bucket < 0").select("anchor", "segment", "flags").unionByName(across), "repeat-flags").join(once, ["anchor", "segment"])

    # A segment that occurs twice goes whole; of the others the windows that were found again.
    single = found.where("mixed").join(once, ["anchor", "segment"], "left_semi").join(flags, ["anchor", "segment"])
    plain = found.where("NOT mixed").unionByName(found.where("mixed").join(once, ["anchor", "segment"], "left_anti"))
    part = F.struct("places", "windows", "flags")
    parts = plain.withColumn("flags", F.lit(None).cast("binary")).select("content", part.alias("part"))
    parts = parts.unionByName(single.select("content", part.alias("part")))
    verdicts = staged(parts.groupBy("content").agg(F.collect_set("part").alias("parts")), "repeat-verdicts")
    release(listed, shared, found, several, wanted, fetched, hot, in_block)

    known = bitmap(verdicts, "content")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    with_some = rows.where(may_hold(known, "content")).join(verdicts, "content", "left").select("doc_id", "text", "parts")
    kept = F.col("text").cast("binary")
    without = rows.where(~may_hold(known, "content")).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), kept.alias("kept")
    )
    return with_some.mapInArrow(_remove(length), out).unionByName(without)


def repeat_report(docs: DataFrame) -> DataFrame:
    """:func:`remove_repeats` with the digest of the kept bytes in their place."""
    return remove_repeats(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
