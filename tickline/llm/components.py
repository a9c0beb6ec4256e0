"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.shared import cut


def _stars(edges: DataFrame) -> DataFrame:
    """Large-star: each node's larger neighbours move to the smallest node among it and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_stars(edges: DataFrame) -> DataFrame:
    """Small-star: each node and its smaller neighbours move to the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node that links reach.

    Nodes may be of any ordered type. Loops and repeated edges do no harm; edges
    with a null end are no edges. Each step is aggregations and joins by node
    without any group gathered in one place, so a node with very many links is
    only a skewed join. The number of steps grows with the logarithm of the
    number of nodes.
    """
    node = edges.select("u", "v").where(F.col("u").isNotNull() & F.col("v").isNotNull())
    lone = node.where(F.col("u") == F.col("v")).select(F.col("u").alias("node")).distinct()
    now = cut(node.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.min(F.hash("u", "v")).alias("y")).first()
        if mark == seen or not mark["n"]:
            break
        seen = mark
        now = cut(_small_stars(_stars(now).distinct()).distinct())
    tree = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    linked = tree.unionByName(roots)
    return linked.unionByName(lone.join(linked, "node", "left_anti").withColumn("root", F.col("node")))
