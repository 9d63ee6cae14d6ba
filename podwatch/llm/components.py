"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podwatch.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of every node that a link (a, b) names; a component is named by its smallest node.

    Each round points a node to the first of its neighbours and itself, then replaces both ends of each
    link by what they point to. The first round orders nodes by value, which ends stars at once; later
    ones order by a hash of the round, which halves long chains on average. Pointers are followed twice before that, each time
    to where they then lead. A hub is reduced by a
    map-side minimum and joined back, so no task holds its links together.
    """
    spark = scratch.spark
    links = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = scratch.written(links, f"{name}-links-0")
    parents: list[DataFrame] = []
    while not links.isEmpty():
        k = len(parents)
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if k == 0:
            first = F.least(F.min("b"), F.col("a"))
        else:
            def order(c: str) -> F.Column:
                return F.struct(F.xxhash64(c, F.lit(k)).alias("o"), F.col(c).alias("n"))

            first = F.least(F.min(order("b")), F.min(order("a")))["n"]
        parent = scratch.written(both.groupBy("a").agg(first.alias("p")), f"{name}-parent-{k}")
        for jump in (1, 2):
            above = parent.select(F.col("a").alias("p"), F.col("p").alias("pp"))
            parent = scratch.written(parent.join(above, "p").select("a", F.col("pp").alias("p")), f"{name}-parent-{k}-{jump}")
        pa, pb = parent.select("a", F.col("p").alias("pa")), parent.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = links.join(pa, "a").join(pb, "b").where("pa <> pb")
        moved = moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        links = scratch.written(moved, f"{name}-links-{k + 1}")
        scratch.drop(f"{name}-links-{k}")
        parents.append(parent)
    if not parents:
        return spark.createDataFrame([], "node long, component long")
    roots = parents[0].select(F.col("a").alias("node"), F.col("p").alias("root"))
    if len(parents) == 1:
        return roots.withColumnRenamed("root", "component")
    for parent in parents[1:]:
        step = parent.select(F.col("a").alias("root"), "p")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("p", "root").alias("root"))
    roots = scratch.written(roots, f"{name}-roots")
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(least, "root").select("node", "component")
