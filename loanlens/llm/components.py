"""Connected components of a link table, as Spark joins.

Alternating large-star and small-star steps turn any links into stars around the smallest
node of each component in a number of rounds that grows with the logarithm of the size.
The links of each round are written to the shared folder, which cuts the lineage and
survives lost executors; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.session import materialised


def _stars(edges: DataFrame) -> DataFrame:
    """One round on directed links (u, v), u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    # Large star: larger neighbours move to the smallest node around.
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # Small star: a node and its smaller neighbours move to the smallest of them.
    smaller = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(smaller, "u")
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = smaller.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link; the root is the component's smallest node.

    Nodes are numbers.  Repeated links and links of a node with itself do no harm; an empty
    table gives an empty result.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = materialised(links.select(u, v).filter("u > v").distinct(), "links")
    state = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("sum")
    before = edges.agg(*state).first()
    while True:
        edges = materialised(_stars(edges), "stars")
        now = edges.agg(*state).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("node")))
