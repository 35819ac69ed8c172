"""Connected components by alternating stars, every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.sources.scratch import keep


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return (
        both.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    rest = down.join(least, "a").where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return rest.unionByName(least.select("a", F.col("low").alias("b"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; root is the smallest node reached.

    Ends when a round changes nothing; each round halves long chains at least, so ``rounds`` is
    only a guard against a fault, and reaching it raises. Loops and repeated edges are ignored;
    no edges give no rows. Only a count and a checksum come to the driver.
    """
    current = keep(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = _digest(current)
    for _ in range(rounds):
        if not before[0]:
            break
        current = keep(_small_star(_large_star(current)), "edges")
        after = _digest(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.distinct())
