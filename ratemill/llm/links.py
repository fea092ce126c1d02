"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node it reaches.

    Each round every node asks its neighbours for their smallest root and takes
    the root of its root; the rounds needed grow with the logarithm of the
    longest path. Node and root pairs are stored after each round, and two
    counts reach the driver. Self-loops give a node of its own. NULLs are not allowed.
    """
    both = stored(
        edges.select("a", "b")
        .unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .distinct()
    )
    roots = stored(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed(
            "a", "node"
        )
    )
    while True:
        known = roots.select(F.col("node").alias("b"), F.col("root").alias("near"))
        # The smallest root among the neighbours, offered to the node and to its present root.
        offers = (
            both.join(known, "b")
            .groupBy("a")
            .agg(F.min("near").alias("offer"))
            .withColumnRenamed("a", "node")
            .join(roots, "node")
        )
        offers = stored(offers.where("offer < root"))
        if offers.isEmpty():
            return roots
        hooks = offers.groupBy("root").agg(F.min("offer").alias("hook"))
        hooked = (
            roots.join(hooks.withColumnRenamed("root", "node"), "node", "left")
            .join(offers.select("node", "offer"), "node", "left")
            .select("node", F.least("root", "hook", "offer").alias("root"))
        )
        # Twice the root of the root.
        for _ in range(2):
            hooked = stored(hooked)
            upper = hooked.select(F.col("node").alias("root"), F.col("root").alias("upper"))
            hooked = hooked.join(upper, "root", "left").select(
                "node", F.least("root", "upper").alias("root")
            )
        roots = stored(hooked)
