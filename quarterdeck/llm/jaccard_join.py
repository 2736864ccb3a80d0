"""Exact n-gram Jaccard join with set-relation skipping.

A document's set holds its distinct 3-word shingles (64-bit hashes). The join runs in four steps.

1. *Index lists by position.* Sets of similar size share a level; a level cuts the hash range
   into ``P`` positions, more than ``H``, the largest number of shingles by which two linked sets
   of that level can differ. Linked sets agree wholly at ``P - H`` positions at least, so the
   index lists of (level, position, content) tokens hold every pair that may link, and a list
   with one set is skipped as a block. A set with fewer than ``P - H`` empty positions has a
   shingle in common at one of them, so its empty positions, alike for many sets, have no tokens.
   No frequent shingle makes a long list: a token stands for all shingles of its position. Tokens travel once, packed and sorted by block of documents; a
   token that several sets of a block hold goes on as one entry, so a hot list reaches its task as
   a few entries for each block, and the rest of its sets only pass by.
2. *One verified answer per set.* Every set meets the least set, the leader, of each of its lists.
   Pairs whose sizes or bit signatures rule a link out are skipped without their texts. The others
   are checked exactly: each set against one leader first, then against those that are not
   connected to it by then. Sets are reduced to distinct ones before; copies never meet.
3. *Answers derived from a similar set.* A list whose sets are all connected needs no further
   check. In the others, sets are ordered by size, and pairs are skipped by size, component and
   signature as before. Sets with a pair left are held as their difference from one set of the
   list, and the overlap of two sets follows from these two differences.
4. Links feed connected components; copies take their set's component.

Large lists are cut into blocks of a bounded number of sets and shingles, and each pair of blocks
is a group of its own, so no list is held whole by one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.base import is_small, lower, mix, packed, release, small_side, span_hashes, staged, text_blocks, words
from quarterdeck.llm.components import connected_components
from quarterdeck.llm.repeats import bitmap, may_hold

SHINGLE = 3
THRESHOLD_PERCENT = 90
BLOCK_SHINGLES, BLOCK_SETS = 1 << 18, 1 << 11
_SIGNATURE = 1 << 12
BUFFER_TOKENS = 1 << 18  # of a block of documents, packed at once
BUCKET_TOKENS = 1 << 20  # that a task holds at once
_REST = 5  # bytes of a token beside its bucket: equal ones are checked anyway

_SET_SCHEMA = "doc_id long, row_key long, n_shingles long, set_key long, n_tokens long, signature binary"
_TOKEN_SCHEMA = "bucket int, passing int, keys binary, owner binary, rest binary"


def level_bounds(percent: int, largest: int) -> list[int]:
    """Smallest set size of each level; linked sets lie in the same or in neighbouring levels."""
    first = max(1, math.ceil(percent / (100 - percent))) if percent < 100 else largest + 1

    def after(bound: int) -> int:
        return max(bound + 1, math.ceil(bound * 100 / percent))

    bounds = [first]
    while bounds[-1] <= largest:
        bounds.append(after(bounds[-1]))
    return [*bounds, after(bounds[-1])]


def most_apart(percent: int, size: int) -> int:
    """The largest symmetric difference of two linked sets of at most ``size`` shingles."""
    return 2 * size * (100 - percent) // (100 + percent)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block."""
    start, end, first = words(data, offsets)
    word = span_hashes(lower(data), start, end)
    odd = [np.uint64(0xA24BAED4963EE407 + 0x9FB21C651E98DF24 * i & 0xFFFFFFFFFFFFFFFF | 1) for i in range(width)]
    gram = np.zeros(max(0, word.size - width + 1), np.uint64)
    for i in range(width):
        gram += mix(word[i: word.size - width + 1 + i] * odd[i])
    for text in range(len(offsets) - 1):
        a, b = first[text], first[text + 1]
        if b - a >= width:
            yield np.unique(gram[a: b - width + 1])
        elif b > a:
            yield mix((mix(word[a:b]) * np.array(odd[: b - a])).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def set_levels(n: int, percent: int, bounds: list[int]) -> list[tuple[int, int, int]]:
    """(level, H, positions) of a set: its own level, and the next one if its links reach it."""
    if n < bounds[0]:
        return []
    own = int(np.searchsorted(bounds, n, side="right")) - 1
    levels = (own, own + 1) if 100 * n >= percent * bounds[own + 1] else (own,)
    apart = [most_apart(percent, bounds[level + 1] - 1) for level in levels]
    return [(level, h, h + 3 + h // 8) for level, h in zip(levels, apart, strict=True)]


def set_tokens(shingles: np.ndarray, percent: int, bounds: list[int]) -> np.ndarray:
    """The index tokens of a set: one per position of its levels, but for the empty ones."""
    found = [np.zeros(0, np.uint64)]
    if shingles.size >= bounds[0]:
        content = np.zeros(shingles.size + 1, np.uint64)
        np.cumsum(mix(shingles + np.uint64(0x632BE59BD9B4E019)), out=content[1:])
    for level, apart, parts in set_levels(shingles.size, percent, bounds):
        edges = np.arange(parts, dtype=np.float64) * (2.0**64 / parts)
        cut = np.append(np.searchsorted(shingles, edges.astype(np.uint64)), shingles.size)
        place = np.arange(parts, dtype=np.uint64) + np.uint64(level << 40)
        tokens = mix(mix(place) ^ (content[cut[1:]] - content[cut[:-1]]))
        empty = cut[1:] == cut[:-1]
        found.append(tokens[~empty] if empty.sum() < parts - apart else tokens)
    return np.concatenate(found)


def _set_key(shingles: np.ndarray) -> np.uint64:
    return mix(mix(shingles).sum(dtype=np.uint64, keepdims=True) + np.uint64(shingles.size))[0]


class _Bounds:
    """Level bounds that grow with the largest set met."""

    def __init__(self, percent: int) -> None:
        self.percent, self.bounds = percent, level_bounds(percent, 1 << 20)

    def to(self, size: int) -> list[int]:
        while size >= self.bounds[-2]:
            self.bounds = level_bounds(self.percent, 2 * size)
        return self.bounds


def _signature(shingles: np.ndarray) -> np.ndarray:
    """4,096 bits; two signatures differ in no more bits than their sets do in shingles."""
    bits = np.zeros(_SIGNATURE, np.uint8)
    bits[(shingles >> np.uint64(17)).astype(np.int64) % _SIGNATURE] = 1
    return np.packbits(bits).view(np.uint64)


def _sets(width: int, percent: int):
    """(doc_id, row_key, text) → the size, key and signature of each document's set and the number of its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _Bounds(percent)
        for batch in batches:
            for row, stop, data, offsets in text_blocks(batch.column(2)):
                sets = list(shingle_sets(data, offsets, width))
                sizes = [s.size for s in sets]
                tokens = [sum(parts for _, _, parts in set_levels(n, percent, bounds.to(n))) for n in sizes]
                keys = np.array([_set_key(s) for s in sets], np.uint64).view(np.int64)
                signatures = pa.array([_signature(s).tobytes() for s in sets], pa.binary())
                part = batch.slice(row, stop - row)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(keys), pa.array(tokens, pa.int64()), signatures],
                    names=["doc_id", "row_key", "n_shingles", "set_key", "n_tokens", "signature"],
                )

    return run


def _planes(values: np.ndarray, count: int) -> bytes:
    """The low ``count`` bytes of each value, highest bytes of all values first: sorted ones compress."""
    raw = values.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, 8 - count:].T).tobytes()


def _from_planes(raw: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(count, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, 8 - count:] = planes.T
    return whole.view(">u8").ravel().astype(np.uint64)


def pack_tokens(tokens: np.ndarray, keys: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket and kind: (token, key) entries, sorted by token.

    A token of three or more sets is one entry, of its least set; the others pass by it.
    """
    bucket = ((tokens >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    rest = tokens & np.uint64((1 << 8 * _REST) - 1)
    order = np.lexsort((keys, rest, bucket))
    bucket, rest, keys = bucket[order].astype(np.int64), rest[order], keys[order]
    first = np.ones(keys.size, bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (rest[1:] != rest[:-1])
    run = np.cumsum(first) - 1
    passing = ~first & (np.bincount(run) >= 3)[run]
    rows = []
    for kind in (0, 1):
        own = passing == bool(kind)
        b, r, k = bucket[own], rest[own], keys[own]
        ends = np.append(np.flatnonzero(b[1:] != b[:-1]) + 1, b.size) if b.size else []
        begin = 0
        for end in ends:
            known, owner = np.unique(k[begin:end], return_inverse=True)
            rows.append((int(b[begin]), kind, known.tobytes(), _planes(owner, 4), _planes(r[begin:end], _REST)))
            begin = end
    columns = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "passing", "keys", "owner", "rest"])


def _index(width: int, percent: int, buckets: int):
    """(text) → packed tokens of the distinct sets of each block of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds, seen, held, owners, size = _Bounds(percent), set(), [], [], 0
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                for shingles in shingle_sets(data, offsets, width):
                    key = int(_set_key(shingles))
                    if not shingles.size or key in seen:
                        continue
                    tokens = set_tokens(shingles, percent, bounds.to(shingles.size))
                    seen.add(key)
                    held.append(tokens)
                    owners.append(np.full(tokens.size, key, np.uint64))
                    size += tokens.size
                    if size >= BUFFER_TOKENS:
                        yield pack_tokens(np.concatenate(held), np.concatenate(owners).view(np.int64), buckets)
                        seen, held, owners, size = set(), [], [], 0
        if size:
            yield pack_tokens(np.concatenate(held), np.concatenate(owners).view(np.int64), buckets)

    return run


def _leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed tokens, sorted by bucket, passing ones last → (member, leader) of lists of two sets or more."""

    def pairs(member: np.ndarray, leader: np.ndarray) -> pa.RecordBatch:
        other = member != leader
        both = np.unique(np.stack([member[other], leader[other]], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["member", "leader"])

    current, held, known = None, [], None

    def settle() -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
        rest, keys = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((keys, rest))
        rest, keys = rest[order], keys[order]
        first = np.concatenate(([True], rest[1:] != rest[:-1]))
        return rest[first], keys[first], pairs(keys, keys[first][np.cumsum(first) - 1])

    for batch in batches:
        for bucket, passing, keys, owner, rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != current:
                if held:
                    yield settle()[2]
                current, held, known = bucket, [], None
            entry = _from_planes(rest, _REST), np.frombuffer(keys, np.int64)[_from_planes(owner, 4).astype(np.int64)]
            if not passing:
                held.append(entry)
                continue
            if known is None:
                *known, found = settle()
                held = []
                yield found
            yield pairs(entry[1], known[1][np.searchsorted(known[0], entry[0])])
    if held:
        yield settle()[2]


def linked(common: np.ndarray, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (one + other - common)


def may_link(bits: np.ndarray, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes whose signatures differ in ``bits`` may link."""
    both = one + other
    return bits <= both - 2 * -(-percent * both // (100 + percent))


def _likely(percent: int):
    """(member, leader, sizes, signatures) → the pairs that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, _SIGNATURE // 64) for i in (4, 5))
            bits = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)
            chosen = pa.array(may_link(bits, batch.column(2).to_numpy(), batch.column(3).to_numpy(), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], names=["member", "leader"])

    return run


def _each_set(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, _, data, offsets in text_blocks(texts):
        yield from shingle_sets(data, offsets, width)


def _check(width: int, percent: int):
    """(member, leader, text, leader_text) → the pairs that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_each_set(batch.column(2), width), _each_set(batch.column(3), width), strict=True):
                common = np.intersect1d(x, y, assume_unique=True).size
                keep.append(bool(linked(common, x.size, y.size, percent)))
            chosen = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(chosen), batch.column(1).filter(chosen)], names=["a", "b"])

    return run


class _Scan:
    """The sets of a list by size, and for each set those before it that may still link with it."""

    def __init__(self, sizes: np.ndarray, signatures: np.ndarray, component: np.ndarray, block: np.ndarray, pair: tuple[int, int], percent: int) -> None:
        self.sizes, self.signatures, self.block, self.pair, self.percent = sizes, signatures, block, pair, percent
        self.root = component.copy()

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(self.sizes, kind="stable")
        lowest = 0
        for at, i in enumerate(order):
            while self.sizes[order[lowest]] * 100 < self.percent * self.sizes[i]:
                lowest += 1  # too small for this and for every later set
            before = order[lowest:at]
            mate = self.pair[1] if self.block[i] == self.pair[0] else self.pair[0]
            before = before[(self.block[before] == mate) & (self.root[before] != self.root[i])]
            bits = np.bitwise_count(self.signatures[before] ^ self.signatures[i]).sum(axis=1, dtype=np.int64)
            yield i, before[may_link(bits, self.sizes[before], self.sizes[i], self.percent)]


def within_list(pivot: np.ndarray, sets: list[np.ndarray], component: np.ndarray, block: np.ndarray, pair: tuple[int, int], percent: int) -> list[tuple[int, int]]:
    """Links of the sets of a list that connect what is not connected yet.

    x ^ y is (x ^ pivot) ^ (y ^ pivot), so a pair's answer comes from its differences to the pivot.
    """
    sizes = np.array([s.size for s in sets])
    apart = [np.setxor1d(s, pivot, assume_unique=True) for s in sets]
    scan = _Scan(sizes, np.stack([_signature(s) for s in sets]), component, block, pair, percent)
    links: list[tuple[int, int]] = []
    for i, before in scan:
        for j in before:
            if scan.root[i] == scan.root[j]:
                continue
            differ = np.setxor1d(apart[i], apart[j], assume_unique=True).size
            if linked((sizes[i] + sizes[j] - differ) // 2, sizes[i], sizes[j], percent):
                links.append((int(i), int(j)))
                scan.root[scan.root == scan.root[j]] = scan.root[i]
    return links


def _screen(percent: int):
    """The sets of each (leader, one, other) block pair that may link with another one of it."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["leader", "one", "other"], ignore_index=True)
        group = rows[["leader", "one", "other"]].to_numpy()
        begin = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]).any(axis=1))))
        signatures = np.frombuffer(b"".join(rows["signature"]), np.uint64).reshape(len(rows), -1)
        n, component, block = (rows[c].to_numpy() for c in ("n", "component", "block"))
        left = np.zeros(len(rows), bool)
        for a, b in zip(begin, np.append(begin[1:], len(rows)), strict=True):
            scan = _Scan(n[a:b], signatures[a:b], component[a:b], block[a:b], (int(group[a, 1]), int(group[a, 2])), percent)
            for i, before in scan:
                left[a + before] = True
                left[a + i] |= before.size > 0
        return rows.loc[left, ["leader", "member", "component", "block", "one", "other"]]

    return run


def _within(width: int, percent: int):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["member"].to_numpy()
        sets = list(_each_set(pa.array(rows["text"], pa.string()), width))
        pivot = min(sets, key=len)
        found = within_list(pivot, sets, rows["component"].to_numpy(), rows["block"].to_numpy(), (int(key[1]), int(key[2])), percent)
        return pd.DataFrame({"a": [keys[i] for i, _ in found], "b": [keys[j] for _, j in found]}, dtype="int64")

    return run


def shingle_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest document id reachable by links (two sets link when 100 x
    intersection >= ``percent`` x union), itself included. Null, empty and separator-only texts
    have no set, link with nothing and are their own component. Rows are told apart by id and text:
    an id may repeat with other texts. A document without an id links like any other and takes the
    smallest id of its component, null if there is none. Repeated rows stay and share a component.
    Texts are read whole; an empty table gives no rows; other columns of ``docs`` are ignored. Sets
    are keyed by 64-bit hashes.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    narrow = narrow.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text")
    sets = staged(narrow.mapInArrow(_sets(width, percent), _SET_SCHEMA), "jaccard-sets")
    held = sets.where("n_shingles > 0")
    owner = held.groupBy("set_key").agg(F.min("doc_id").alias("owner"), F.min("row_key").alias("row_key"), F.max("n_shingles").alias("n"))
    owner = staged(owner, "jaccard-owners")

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = sets.agg(F.sum("n_tokens")).first()[0] or 0
    buckets = min(1 << 24, max(2 * tasks, -(-total // BUCKET_TOKENS)))
    tokens = narrow.select("text").mapInArrow(_index(width, percent, buckets), _TOKEN_SCHEMA)
    tokens = tokens.repartition(tasks, "bucket").sortWithinPartitions("bucket", "passing")
    checks = staged(tokens.mapInArrow(_leaders, "member long, leader long").distinct(), "jaccard-checks")

    # The sizes and signatures of the sets that take part in a check.
    needed = checks.select("member").union(checks.select("leader")).distinct().withColumnRenamed("member", "set_key")
    needed = needed.join(owner, "set_key").select("set_key", "row_key", "n")
    signed = sets.select("set_key", "row_key", "signature").join(needed, ["set_key", "row_key"]).dropDuplicates(["set_key", "row_key"])
    signed = staged(signed.select(F.col("set_key").alias("member"), "n", "signature"), "jaccard-signed")
    of_leader = signed.toDF("leader", "leader_n", "leader_signature")
    met = checks.join(signed, "member").join(of_leader, "leader").select("member", "leader", "n", "leader_n", "signature", "leader_signature")
    likely = staged(met.mapInArrow(_likely(percent), "member long, leader long"), "jaccard-likely")

    def fetched(keys: DataFrame, name: str) -> DataFrame:
        """(member, text) of the sets of ``keys``: one row of each; no other text is shuffled."""
        wanted = staged(keys.join(owner, keys["member"] == owner["set_key"]).select("member", "row_key"), f"{name}-wanted")
        near = narrow.select("row_key", "text")
        if is_small(wanted):  # the join itself leaves out the other texts, without a Python worker
            near = near.join(F.broadcast(wanted), "row_key")
        else:
            near = near.where(may_hold(bitmap(wanted, "row_key"), "row_key")).join(wanted, "row_key")
        return staged(near.dropDuplicates(["row_key"]).select("member", "text"), name)

    texts = fetched(likely.select("member").union(likely.select("leader")).distinct(), "jaccard-texts")
    leader_texts = texts.toDF("leader", "leader_text")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        both = pairs.join(texts, "member").join(leader_texts, "leader").select("member", "leader", "text", "leader_text")
        return staged(both.mapInArrow(_check(width, percent), "a long, b long"), name)

    def named(pairs: DataFrame, reached: DataFrame) -> DataFrame:
        """(member, leader, component, other): the components of both sets."""
        one = reached.select(F.col("node").alias("member"), "component")
        two = reached.select(F.col("node").alias("leader"), F.col("component").alias("other"))
        joined = pairs.join(one, "member", "left").join(two, "leader", "left")
        return joined.select("member", "leader", F.coalesce("component", "member").alias("component"), F.coalesce("other", "leader").alias("other"))

    def further(reached: DataFrame, links: DataFrame) -> DataFrame:
        """The components after more links between (names of) components."""
        known = reached.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return staged(connected_components(known.unionByName(links)), "jaccard-reached")

    first = likely.groupBy("member").agg(F.min("leader").alias("leader"))
    links = verified(first, "jaccard-first")
    reached = staged(connected_components(links), "jaccard-reached")
    rest = named(likely.join(first, ["member", "leader"], "left_anti"), reached).where("component <> other").select("member", "leader")
    links = verified(rest, "jaccard-rest")
    reached = further(reached, links)

    # Lists that are not connected: small ones share groups, each block pair of a large one is its own.
    lists = staged(_blocks(_open(named(checks, reached), owner)), "jaccard-lists")
    shared = max(tasks, -(-lists.count() // BLOCK_SETS))
    part = F.when(F.col("many") > 1, F.xxhash64("leader", "one", "other")).otherwise(F.pmod(F.xxhash64("leader"), F.lit(shared)))
    rows = lists.join(signed, "member").withColumn("part", part).repartition(tasks, "part")
    tiles = "leader long, member long, component long, block int, one int, other int"
    rows = staged(rows.groupBy("part").applyInPandas(_screen(percent), tiles), "jaccard-open")
    more = rows.join(fetched(rows.select("member").distinct(), "jaccard-more-texts"), "member")
    more = staged(more.groupBy("leader", "one", "other").applyInPandas(_within(width, percent), "a long, b long"), "jaccard-more")
    reached = further(reached, more)
    release(texts, checks, signed, likely, lists, rows)

    least = owner.join(reached, owner["set_key"] == reached["node"], "left")
    least = least.select("set_key", "owner", F.coalesce("component", "set_key").alias("component"))
    smallest = least.groupBy("component").agg(F.min("owner").alias("component_id"))
    classes = least.join(smallest, "component").select("set_key", "component_id")
    joined = sets.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", own.alias("component_id"))


def deduplicated(docs: DataFrame, width: int = SHINGLE, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """``docs`` with one document of each group of linked sets: the smallest id, nulls last.

    Documents without words belong to no group and all stay. Rows that repeat id and text count
    as one document. The columns are those of ``docs``.
    """
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    narrow = docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("id"), "text")
    groups = shingle_groups(narrow.select("key", "text"), key="key", width=width, percent=percent)
    groups = staged(groups.select(F.col("doc_id").alias("key"), "n_shingles", "component_id").distinct(), "jaccard-groups")
    named = groups.join(narrow.select("key", "id").distinct(), "key")
    first = F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("first")
    kept = named.groupBy("component_id").agg(first, F.max("n_shingles").alias("n"))
    kept = staged(kept.select(F.col("first.key").alias("key"), "n"), "jaccard-kept")
    one = packed(docs, key=key).join(small_side(kept), "key")
    one = one.withColumn("nth", F.when(F.col("n") > 0, F.lit(0)).otherwise(F.monotonically_increasing_id()))
    return one.dropDuplicates(["key", "nth"]).select("row.*")


def _open(named: DataFrame, owner: DataFrame) -> DataFrame:
    """(leader, member, component, size, shingles) of the lists whose sets are not all connected."""
    own = named.select("leader", F.col("leader").alias("member"), F.col("other").alias("component")).distinct()
    pairs = named.select("leader", "member", "component").unionByName(own)
    pairs = pairs.join(owner.select(F.col("set_key").alias("member"), "n"), "member")
    spread = pairs.groupBy("leader").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"), F.sum("n").alias("shingles")
    )
    # A list of a leader and one more set was settled by its check.
    return pairs.drop("n").join(spread.where("lo <> hi AND size > 2").select("leader", "size", "shingles"), "leader")


def _blocks(lists: DataFrame) -> DataFrame:
    """Each list's sets dealt into blocks, and each set sent to every pair of blocks it is in."""
    many: Column = F.greatest(F.lit(1), F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.ceil(F.col("size") / BLOCK_SETS)).cast("int")
    dealt = lists.withColumn("many", many).withColumn("block", F.pmod(F.xxhash64("member"), F.col("many")).cast("int"))
    return dealt.withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("many") - 1))).select(
        "leader", "member", "component", "many", "block", F.least("block", "mate").alias("one"), F.greatest("block", "mate").alias("other")
    )


# The same groups for small tables: distinct sets, their common shingles, and all that links reach.
ORACLE = r"""
WITH RECURSIVE spoken AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
sets AS (
  SELECT doc_id, CASE
      WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
      ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')))
    END AS shingles
  FROM spoken
),
keyed AS (SELECT doc_id, len(shingles) AS n, shingles, md5(array_to_string(list_sort(shingles), chr(10))) AS key FROM sets),
one AS (SELECT key, any_value(n) AS n, any_value(shingles) AS shingles, min(doc_id) AS least FROM keyed WHERE n > 0 GROUP BY key),
held AS (SELECT key, n, unnest(shingles) AS shingle FROM one),
common AS (
  SELECT a.key AS a, b.key AS b, a.n AS an, b.n AS bn, count(*) AS c
  FROM held a JOIN held b ON a.shingle = b.shingle AND a.key <> b.key
  WHERE 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
  GROUP BY a.key, b.key, a.n, b.n
),
links AS (SELECT a, b FROM common WHERE 100 * c >= 90 * (an + bn - c)),
reach AS (
  SELECT key AS a, key AS b FROM one
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
),
component AS (SELECT reach.a AS key, min(one.least) AS component_id FROM reach JOIN one ON one.key = reach.b GROUP BY reach.a)
SELECT keyed.doc_id, CAST(keyed.n AS BIGINT) AS n_shingles, CASE WHEN keyed.n > 0 THEN component.component_id ELSE keyed.doc_id END AS component_id
FROM keyed LEFT JOIN component ON component.key = keyed.key
"""
