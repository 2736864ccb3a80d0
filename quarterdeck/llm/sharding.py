"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many virtual nodes on a 64-bit ring; a document belongs to the shard of the
first node at or after its position. A shard's load is bounded: once it is full, its remaining
documents continue clockwise to the next node of a shard that is not full. Positions depend on
the document alone and nodes on the shard alone, so changing the number of shards moves only the
documents of the new shard and of the bound's overflow.

Placement runs in rounds, at most one per shard: all waiting documents look up the ring without
the full shards; each shard accepts in a fixed order until its bound; the rest waits for the next
round. The acceptance test is a running sum over range partitions, so neither a shard nor a
crowd of equal rows meets in one task, and only sums per shard reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.base import mix, running, staged

VIRTUAL_NODES = 512
SLACK = 0.002  # a shard is full at (1 + SLACK) times the mean load
LARGE_SHARE = 1000  # documents above bound / LARGE_SHARE are placed first, the largest first


def ring(shards: list[int], virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Sorted node positions and the shard of each node."""
    shard = np.repeat(np.array(shards, np.int64), virtual_nodes)
    node = np.tile(np.arange(virtual_nodes, dtype=np.uint64), len(shards))
    place = mix(mix(shard.astype(np.uint64) + np.uint64(0x51ED27)) + node)
    order = np.lexsort((shard, place))
    return place[order], shard[order]


def _owners(shards: list[int], virtual_nodes: int):
    place, shard = ring(shards, virtual_nodes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            at = mix(rows["position"].to_numpy(np.int64).view(np.uint64))
            rows["shard"] = shard[np.searchsorted(place, at) % len(place)].astype(np.int32)
            yield rows

    return run


def place(docs: DataFrame, shards: int = 8, virtual_nodes: int = VIRTUAL_NODES, slack: float = SLACK, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot`` and the columns in ``keep``.

    ``size`` is the UTF-8 length plus one (null text: 1). A shard takes documents until its load
    reaches ``(1 + slack)`` times the mean, so it ends above that by less than one document, and
    documents above a thousandth of the bound go first. ``slot`` counts a shard's documents from
    0 without gaps, by id, checksum and size (nulls last). Rows that repeat an id and a text are
    interchangeable; null ids share a ring position and overflow like any other key.
    """
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.when(F.col("text").isNotNull(), F.crc32(raw)).alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("position"),
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
    )
    waiting = staged(rows, "ring-rows")
    total = waiting.agg(F.sum("size")).first()[0] or 0
    bound = (1 + slack) * total / shards
    load = dict.fromkeys(range(shards), 0)
    placed = []
    large = F.col("size") * LARGE_SHARE > bound
    order = [
        large.desc(), F.when(large, -F.col("size")).otherwise(F.xxhash64("position", "text_crc32", "size")).asc(),
        F.col("doc_id").asc_nulls_last(), F.col("text_crc32").asc_nulls_last(),
    ]
    schema = f"{_ddl(waiting)}, shard int"
    for round_no in range(shards):
        open_shards = [k for k in range(shards) if load[k] < bound] or list(range(shards))
        owned = waiting.mapInPandas(_owners(open_shards, virtual_nodes), schema)
        summed = running(owned, ["shard"], order, F.col("size"), "before", f"ring-{round_no}")
        start = F.create_map(*[F.lit(x) for k in range(shards) for x in (k, load[k])])
        round_rows = staged(summed.withColumn("taken", F.col("before") + start[F.col("shard")] < bound), f"ring-{round_no}-taken")
        placed.append(round_rows.where("taken").drop("before", "taken"))
        left = 0
        for shard, taken, size, n in round_rows.groupBy("shard", "taken").agg(F.sum("size"), F.count("*")).collect():
            if taken:
                load[shard] += size
            else:
                left += n
        if not left:
            break
        waiting = round_rows.where("NOT taken").drop("before", "taken", "shard")
    everything = placed[0]
    for more in placed[1:]:
        everything = everything.unionByName(more)
    by_id = [F.col(c).asc_nulls_last() for c in ("doc_id", "text_crc32", "size")]
    slots = running(everything, ["shard"], by_id, F.lit(1), "slot", "ring-slots")
    kept = [F.col(f"_keep_{c}").alias(c) for c in keep]
    return slots.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), *kept)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)


def shard_documents(docs: DataFrame, shards: int = 8, keep: tuple[str, ...] = ()) -> DataFrame:
    """:func:`place` under the law ``bytes``: loads near equal, no promise for one more shard."""
    crc = F.coalesce(F.col("text_crc32"), F.crc32(F.lit("").cast("binary")))
    return place(docs, shards, keep=keep).select(
        "doc_id", "size", crc.alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), *keep
    )
