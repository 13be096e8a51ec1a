"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyroad.llm.places import Scratch


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` for every node that has an edge; a component's name
    is its smallest node.

    Alternating large and small stars: a round hangs every node under the
    smallest node it knows of, until every component is one star. Each half
    round is a table in the shared folder, which the next one deletes, so
    neither lineage nor memory nor disk grows. The number of rounds is about the
    logarithm of the longest path.
    """
    scratch = Scratch(edges.sparkSession)
    step = scratch.keep(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        state = step.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return stars(step)
        before = state
        for star in (large_star, small_star):
            # A table of its own: a hot node is then a skewed side of a plain
            # join, which Spark splits, and not rows that are grouped already.
            down = scratch.keep(step.groupBy("u").agg(F.min("v").alias("least")), "down")
            after = scratch.keep(star(step, down), "edges")
            scratch.drop(step, down)
            step = after


def stars(step: DataFrame) -> DataFrame:
    leaves = step.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(step.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def large_star(step: DataFrame, down: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest neighbour or itself.

    An edge u > v shows u from v's side only, so both ends' smallest
    neighbours are needed for v's list: from u's side v is smaller."""
    # v's smallest known node is the least of its smaller neighbours, or v.
    moved = step.join(down.withColumnRenamed("u", "v"), "v", "left").select("u", F.coalesce("least", "v").alias("v"))
    return moved.distinct()


def small_star(step: DataFrame, down: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and itself, move to the smallest."""
    near = step.join(down, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = down.select("u", F.col("least").alias("v"))
    return near.unionByName(own).where("u <> v").distinct()
