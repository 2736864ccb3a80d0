"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.base import release, staged

MOST_ROUNDS = 200  # the logarithm of the longest chain stays far below; more is an error


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) → (node, component): the smallest node reachable from each linked node.

    Large-star and small-star rounds: each node hands its larger (then its other) neighbours to
    its smallest one until nothing moves. A round is two aggregations and two joins on the
    node; the number of rounds follows the logarithm of the longest chain. A node with very many
    neighbours is an ordinary join key, which adaptive execution may split. Null ends and self
    links are left out; repeated links count once.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = staged(edges, "cc-0")
    mark = _mark(edges)
    for round_no in range(1, MOST_ROUNDS + 1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        hung = large.join(least, F.col("a") == F.col("n"))
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(hung.select("a", F.col("m").alias("b")))
        before_edges, edges = edges, staged(small.where("a <> b").distinct(), f"cc-{round_no}")
        release(before_edges)
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components still move after {MOST_ROUNDS} rounds")
    nodes = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return nodes.unionByName(roots.join(nodes.select("node"), "node", "left_anti"))


def _mark(edges: DataFrame) -> tuple:
    """Count and an order-free sum of the links: equal marks mean that a round moved nothing."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]
