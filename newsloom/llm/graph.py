"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _low_high(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller node."""
    return (links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where("a <> b").distinct())


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"),
                    F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                    F.sum(F.shiftright(F.xxhash64("b", "a"), 20)).alias("s")).first()
    return tuple(row)


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a and b, long);
    ``component`` is the smallest node that can be reached.

    Alternates two steps until nothing changes: hang every larger neighbour on
    the smallest one, then every smaller neighbour.  The number of rounds grows
    with the logarithm of the links; each round is a stored table, so no plan
    grows and a lost executor costs a task.  Minima are aggregated before they
    are joined back, so a node with very many links is no burden.
    """
    now = cut_lineage(_low_high(links), f"{name}-links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = cut_lineage(_low_high(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                        F.col("m").alias("b"))), f"{name}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        now = cut_lineage(_low_high(
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))), f"{name}-small")
        before, state = state, _state(now)
        if state == before:
            break
    leaves = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
