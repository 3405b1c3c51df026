"""Connected components of links, as a DataFrame operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.session import stored

# up to so many links are joined up on the driver; beyond, the rounds below run in Spark
SMALL_LINKS = 10_000
MAX_ROUNDS = 100


def _joined_up(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``node, smallest node reachable`` of a bounded list of links."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        above.setdefault(x, x)
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for a, b in pairs:
        low, high = sorted((root(a), root(b)))
        above[high] = low
    return [(x, root(x)) for x in list(above)]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("_low"))
    near = both.filter(F.col("low") > F.col("high")).join(least, F.col("high") == F.col("node"))
    return near.select(F.col("low").alias("high"), F.least("node", "_low").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("_low"))
    near = edges.join(least, F.col("high") == F.col("node")).filter(F.col("low") != F.col("_low"))
    return near.select(F.col("low").alias("high"), F.col("_low").alias("low")).unionByName(least.select(F.col("node").alias("high"), F.col("_low").alias("low"))).distinct()


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first())


def components(links: DataFrame, a: str, b: str, small: int = SMALL_LINKS) -> DataFrame:
    """``node, component`` for every node with a link: the smallest node that can be reached from it.

    Links are BIGINT pairs in any direction, repeated or not; links of a node with itself and links with a NULL end join nothing.
    Large and small stars alternate until every node hangs directly from the smallest of its component. That takes a number of rounds that grows with
    the logarithm of the longest path, a round's edges are never more than the links, and each round is written out, so
    lineage stays short. A hub's neighbours move through joins on it, which run-time skew handling splits.
    """
    spark = links.sparkSession
    ends = [F.col(f"`{c}`").cast("bigint") for c in (a, b)]
    edges = links.select(F.greatest(*ends).alias("high"), F.least(*ends).alias("low"), *[e.isNull().alias(f"_{k}") for k, e in enumerate(ends)])
    edges = edges.filter(~F.col("_0") & ~F.col("_1") & (F.col("high") != F.col("low"))).select("high", "low").distinct()
    few = edges.limit(small + 1).collect()
    if len(few) <= small:
        return spark.createDataFrame(_joined_up([(r["high"], r["low"]) for r in few]), "node bigint, component bigint")
    edges = stored(edges, "links")
    before = _summary(edges)
    for _ in range(MAX_ROUNDS):
        edges = stored(_small_star(_large_star(edges)), "links")
        after = _summary(edges)
        if after == before:
            roots = edges.select(F.col("low").alias("node")).distinct()
            return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
                roots.select("node", F.col("node").alias("component"))
            )
        before = after
    raise RuntimeError(f"links did not settle in {MAX_ROUNDS} rounds")
