"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_engine.llm.common import Scratch


def _step(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Links every neighbour of a node with the smallest of them and the node: the larger
    neighbours in a large star, the node and its smaller neighbours in a small one. edges has
    a > b."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = edges.unionByName(turned) if both_ways else edges
    least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    if both_ways:
        moved = near.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), "m")
    else:
        moved = near.join(least, "a").select(F.col("b").alias("a"), "m").unionByName(least)
    return moved.where(F.col("a") != F.col("m")).select("a", F.col("m").alias("b")).distinct()


def smallest_reachable(pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, smallest) of all ids in pairs (a, b) that are not the smallest of their component.
    Rounds grow with the logarithm of a component's size; each is written, none collected."""
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = pairs.where(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct()
    edges = scratch.put(edges, f"{name}_0")
    before, rounds = None, 0
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            break
        before, rounds = now, rounds + 1
        edges = scratch.put(_step(_step(edges, True), False), f"{name}_{rounds}")
        scratch.drop(f"{name}_{rounds - 1}")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("smallest"))
