"""Connected components of a table of links, by repeated hooking to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakesteps.session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node of ``links``; comp is the smallest node it is linked to.

    Each round links all larger neighbours of a node to its smallest one, then each node to the
    smallest node it knows (the "large star" and "small star" of the two-phase algorithm), until
    nothing moves. No group is collected: both steps are an aggregate of one minimum per node and
    a join. Each round is written out, so lineage stays short and lost executors cost one round.
    """
    edges = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u > v").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # The minima are written before they are joined, so that a node with very many neighbours
        # can be split in the join.
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = materialize(low.select("u", F.least("u", "m").alias("m")), "links-low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "links-large")
        lowest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "links-low")
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u > v").distinct()
        after = materialize(small, "links")
        if after.exceptAll(edges).isEmpty():
            break
        edges = after
    roots = after.groupBy("u").agg(F.min("v").alias("comp"))
    return roots.select(F.col("u").alias("node"), "comp").unionByName(
        roots.select(F.col("comp").alias("node"), "comp").distinct())
