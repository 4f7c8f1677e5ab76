"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.llm.common import dropped, written


def _hooked(edges: DataFrame) -> DataFrame:
    """One large-star or small-star half-round: every neighbour is hooked to the smallest one.

    The smallest neighbours are a pre-aggregated table of their own, so a hub with very
    many links is a skewed join that adaptive execution can split, never one group.
    """
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), "star-least")
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = written(_hooked(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                    .where(F.col("u") != F.col("v")).distinct(), "star-large")
    # Every edge now points to a smaller node; its tail and that node's siblings hook to the smallest.
    hooked = _hooked(large)
    small = hooked.select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .unionByName(hooked.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()
    out = written(small, "star-small")
    dropped(large)
    return out


def components(links: DataFrame) -> DataFrame:
    """a, b -> node, root: the smallest node that each linked node can reach.

    Rounds go on until nothing changes; their number grows with the logarithm of the
    longest chain. Nodes are of any ordered type; each round is written to the shared folder.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where(F.col("u") != F.col("v")).distinct(), "star-links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        after = _round(edges)
        dropped(edges)
        edges = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(roots.select("node", F.col("node").alias("root")))
