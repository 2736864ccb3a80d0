"""Spelling variant grouping by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one into the other, that
is, if their common prefix and common suffix together reach the longer length minus one.

1. Words are counted per document block and summed by Spark; a fixed rule drops one code point of
   some occurrences, so that the corpus holds single edits of frequent words.
2. A word of length m is cut into three pieces. One edit leaves two of them as they are, so near
   words of lengths m and m (or m and m + 1) share the token (m, piece, text before it, text after
   it) of the piece that the edit is in. Tokens need a few letters' freedom only, so their groups
   stay small; a larger group is dealt into blocks and each pair of blocks is a tile of its own.
3. A task lays the words of its tiles out as padded code-point matrices, once from the front and
   once from the back, and compares all pairs of a tile at once. A pair that shares several tokens
   counts at the first piece alone. Only counts and the best near word leave a tile.
4. A word's form is its near word of largest count if that is at least twice its own; forms are
   followed to their root by pointer doubling.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.base import lower, run_strings, runs, staged, text_blocks

LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
DROP_MODULUS = 97
PIECES = 3
TILE_WORDS, TILE_CELLS = 1024, 1 << 20  # words and code points of a block
BROADCAST_TOKENS = 100_000  # hot tokens sent along at most; beyond, a join by shuffle
_BLOCK = 4 << 20
_CELLS = 1 << 22  # code points of one chunk of a task
_PAIRS = 1 << 18

_NEAR = "word string, n_near long, best_n long, best string"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_LEAD = 0xC3  # the first byte of U+00C0 to U+00FF


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to ``[A-Za-z\\u00C0-\\u00FF]``."""
    lead = data == _LEAD
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    return inside


def checksums(prefix: np.ndarray, terms: pa.LargeStringArray, code: np.ndarray) -> np.ndarray:
    """CRC-32 of each (prefix, term): ``prefix`` holds the checksum of what stands before the term."""
    ends = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset: terms.offset + len(terms) + 1]
    data = np.frombuffer(terms.buffers()[2], np.uint8)
    size = (ends[1:] - ends[:-1])[code]
    out = prefix.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    short = np.flatnonzero(size <= 64)
    short = short[np.argsort(-size[short], kind="stable")]
    place, left, crc = ends[code[short]], size[short], out[short]
    for at in range(int(left[0]) if left.size else 0):
        live = int(np.searchsorted(-left, -at))  # those longer than ``at``
        crc[:live] = _CRC[(crc[:live] ^ data[place[:live] + at]) & np.uint32(255)] ^ (crc[:live] >> np.uint32(8))
    out[short] = crc
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > 64):
        out[i] = zlib.crc32(data[ends[code[i]]: ends[code[i] + 1]].tobytes(), int(prefix[i]))
    return out


def _counted(least_length: int):
    """(doc_id as text, text) → (word, n), summed per block of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = np.array([zlib.crc32(f"{i}:".encode()) for i in batch.column(0).to_pylist()], np.uint32)
            for row, stop, data, offsets in text_blocks(batch.column(1), _BLOCK):
                inside = letters(data)
                start, end, first = runs(inside, offsets)
                coded = run_strings(lower(data), inside, start, end)
                terms = coded.dictionary
                if not len(terms):
                    continue
                text = np.repeat(np.arange(row, stop), np.diff(first))
                seen, n = np.unique(text * len(terms) + coded.indices.to_numpy(), return_counts=True)
                text, code = seen // len(terms), seen % len(terms)
                h = checksums(before[text], terms, code)
                changed = h % DROP_MODULUS == 0
                total = np.bincount(code[~changed], n[~changed], len(terms)).astype(np.int64)
                length = pc.utf8_length(terms).to_numpy()
                kept = np.flatnonzero((total > 0) & (length >= least_length))
                edited: dict[str, int] = {}
                for i in np.flatnonzero(changed & (length[code] > least_length)):
                    word = terms[int(code[i])].as_py()
                    at = int(h[i]) % len(word)
                    word = word[:at] + word[at + 1:]
                    edited[word] = edited.get(word, 0) + int(n[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([terms.take(pa.array(kept)).cast(pa.string()), pa.array(list(edited), pa.string())]), pa.array(np.append(total[kept], list(edited.values())).astype(np.int64))],
                    names=["word", "n"],
                )

    return run


def corpus_words(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the frequent words of all texts, by the rule of the module."""
    narrow = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = narrow.mapInArrow(_counted(least_length), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _cuts(m: int | np.ndarray) -> list:
    return [m * i // PIECES for i in range(PIECES + 1)]


def word_tokens(words: DataFrame, shortest: int = 1) -> DataFrame:
    """``token, m, piece, word, n``: a token for each length class and piece of each word.

    Class m compares words of m with words of m and m + 1 code points; no word is below ``shortest``.
    """
    length = F.length("word")
    classes = F.explode(F.array_compact(F.array(length, F.when(length > shortest, length - 1)))).alias("m")
    pieces = F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1))).alias("piece")
    rows = words.select("word", "n", classes).select("word", "n", "m", pieces)
    begin = F.floor(F.col("m") * F.col("piece") / PIECES).cast("int")
    behind = F.col("m") - F.floor(F.col("m") * (F.col("piece") + 1) / PIECES).cast("int")
    token = F.xxhash64("m", "piece", F.substring("word", F.lit(1), begin), F.right("word", behind))
    return rows.select(token.alias("token"), "m", "piece", "word", "n")


def _matrix(chars: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each word, padded, from the front and from the back."""
    row = np.repeat(np.arange(length.size), length)
    at = np.arange(chars.size) - np.repeat(np.cumsum(length) - length, length)
    front, back = np.zeros((length.size, width), chars.dtype), np.zeros((length.size, width), chars.dtype)
    front[row, at] = chars
    back[row, length[row] - 1 - at] = chars
    return front, back


def compare_tiles(m: int, words: list[str], n: np.ndarray, group: np.ndarray, piece: np.ndarray, block: np.ndarray, crossed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Near-word count and best near word (row, or -1) of each row; ``group`` numbers the tiles in order.

    A ``crossed`` tile compares its two blocks, any other one all its words.
    """
    length = np.array([len(w) for w in words])
    chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    front, back = _matrix(chars.astype(np.uint16) if chars.max() < 1 << 16 else chars, length, m + 1)
    last = np.searchsorted(group, group, side="right")
    partners = last - np.arange(group.size) - 1
    before = np.cumsum(partners) - partners
    cuts = np.array(_cuts(m))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    row = 0
    while row < group.size:
        stop = max(row + 1, int(np.searchsorted(before, before[row] + _PAIRS, side="left")))
        i = np.repeat(np.arange(row, stop), partners[row:stop])
        j = np.arange(i.size) + before[row] - before[i] + i + 1
        row = stop
        fit = ((length[i] == m) | (length[j] == m)) & (piece[i] == piece[j]) & (~crossed[i] | (block[i] != block[j]))
        i, j = i[fit], j[fit]
        if not i.size:
            continue
        prefix, suffix = (front[i] == front[j]).argmin(axis=1), (back[i] == back[j]).argmin(axis=1)
        longer = np.maximum(length[i], length[j])
        near = prefix + suffix >= longer - 1
        i, j, prefix, suffix, longer = i[near], j[near], prefix[near], suffix[near], longer[near]
        # The first piece that the edit may be in, so that a pair counts once.
        edit = np.where(longer > m, m - suffix, prefix)
        own = np.where(longer > m, np.searchsorted(cuts[1:], edit, side="left"), np.searchsorted(cuts[1:], edit, side="right"))
        p = piece[i]
        true = (own == p) & (prefix >= cuts[p]) & (suffix >= m - cuts[p + 1])
        found.append((i[true], j[true]))
    a = np.concatenate([x for pair in found for x in pair] or [np.zeros(0, np.int64)])
    b = np.concatenate([x for pair in found for x in pair[::-1]] or [np.zeros(0, np.int64)])
    count = np.bincount(a, minlength=group.size)
    best = np.full(group.size, -1)
    rank = np.empty(group.size, np.int64)
    rank[pc.array_sort_indices(pa.array(words)).to_numpy()] = np.arange(group.size)
    order = np.lexsort((rank[b], -n[b], a))
    first = order[np.flatnonzero(np.diff(a[order], prepend=-1))]
    best[a[first]] = b[first]
    return count, best, length


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(m, token, lo, hi, piece, block, word, n), sorted by the first four → near words per tile row."""

    def chunk(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        m, token, lo, hi, piece, block, _, n = (table.column(i).to_numpy() if i != 6 else None for i in range(8))
        group = np.cumsum(np.concatenate(([0], (token[1:] != token[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (m[1:] != m[:-1]))))
        words = table.column(6).to_pylist()
        row = 0
        while row < m.size:
            # whole groups of one length class, of a bounded number of cells
            stop = int(np.searchsorted(m, m[row], side="right"))
            most = row + max(1, _CELLS // (int(m[row]) + 1))
            if most < stop:
                cut = int(np.searchsorted(group, group[most]))
                stop = cut if cut > row else int(np.searchsorted(group, group[row], side="right"))
            part = slice(row, stop)
            row = stop
            if np.unique(group[part]).size == group[part].size:
                continue  # every word alone
            count, best, _ = compare_tiles(int(m[part.start]), words[part], n[part], group[part], piece[part], block[part], lo[part] != hi[part])
            some = np.flatnonzero(count)
            own, other = pa.array(words[part]), best[some]
            yield pa.RecordBatch.from_arrays(
                [own.take(pa.array(some)).cast(pa.string()), pa.array(count[some], pa.int64()), pa.array(n[part][other], pa.int64()), own.take(pa.array(other)).cast(pa.string())],
                names=["word", "n_near", "best_n", "best"],
            )

    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        # the last tile may go on in the next batch
        same = np.ones(table.num_rows, bool)
        for column in table.columns[:4]:
            values = column.to_numpy()
            same &= values == values[-1]
        cut = int(same.size - same[::-1].argmin()) if not same.all() else 0
        if cut:
            yield from chunk(table.slice(0, cut))
        held = table.slice(cut)
    if held is not None:
        yield from chunk(held)


def near_words(words: DataFrame, tile_words: int = TILE_WORDS, shortest: int = 1) -> DataFrame:
    """``word, n_near, best_n, best`` of every word that has a near word."""
    spark = words.sparkSession
    tokens = word_tokens(words, shortest)
    size = F.greatest(F.ceil(F.count("*") / tile_words), F.ceil(F.sum(F.col("m") + 1) / TILE_CELLS))
    hot = staged(tokens.groupBy("token").agg(size.cast("int").alias("many")).where("many > 1"), "spelling-hot")
    along = F.broadcast(hot) if hot.count() <= BROADCAST_TOKENS else hot
    dealt = tokens.join(along, "token", "left").withColumn("many", F.coalesce("many", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("word"), "many").cast("int")).withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
    tiles = dealt.select("m", "token", F.least("block", "mate").alias("lo"), F.greatest("block", "mate").alias("hi"), "piece", "block", "word", "n")
    spread = tiles.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "token", "lo", "hi").sortWithinPartitions("m", "token", "lo", "hi")
    found = spread.mapInArrow(_tiles, _NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("first")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best"))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` of every word with a form: each round doubles the way gone.

    Counts at least double along a way, so its length is under log2 of the largest count, and the
    rounds follow the logarithm of that.
    """
    way = forms.select("word", F.col("form").alias("root"))
    for round_no in range(max(1, math.ceil(math.log2(math.log2(max(2, most)) + 1)))):
        ahead = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        way = staged(way.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), f"spelling-roots-{round_no}")
    return way


def group_spellings(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, tile_words: int = TILE_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every frequent word of ``docs``.

    Null texts have no words; a null id counts as empty in the rule that drops code points;
    repeated rows count each; of near words with equal counts the smallest by code points wins; a
    run of letters may be of any length; an empty table gives no rows. Other columns are ignored.
    """
    words = staged(corpus_words(docs, least_length, least_count), "spelling-words")
    near = staged(near_words(words, tile_words, least_length), "spelling-near")
    known = words.join(near, "word", "left")
    known = known.withColumn("form", F.when(F.col("best_n") >= RATIO * F.col("n"), F.col("best")))
    known = staged(known.select("word", "form", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n")), "spelling-forms")
    most = known.agg(F.max("n")).first()[0] or 0
    roots = _roots(known.where("form IS NOT NULL"), most)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
