"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .texts import settle


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1_000_003)).first())


def _star(pairs: DataFrame) -> DataFrame:
    """Each ``u`` with each of its neighbours and the smallest of them and itself."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(low, "u")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node that it can reach) for all nodes of ``links`` (a, b).

    Each round hangs the larger neighbours of a node on its smallest one, then the smaller
    neighbours; edges are a written table after each round, so that the lineage stays short.
    A neighbourhood is never gathered: it is a minimum and a join, which Spark can split.
    """
    edges = settle(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = None
    while (now := _checksum(edges)) != before:
        before = now
        if now[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _star(large)
        hung = small.select("u", F.col("m").alias("v"))
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(hung.unionByName(moved).where("u <> v").distinct())
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own)
