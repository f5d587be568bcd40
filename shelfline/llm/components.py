"""Connected components by contraction, for graphs that fit no single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.scratch import table


def _ordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a, b): the smallest node reachable from it.

    Each round sends every node to the neighbour (or itself) of lowest hash and puts the
    edges between the targets: neighbours stay connected, a star collapses within two
    rounds and a chain shrinks by a constant factor. A round is a map-side combined
    minimum and two joins against its written result, so that a node with very many
    edges is split by the skew join. Loops and repeated edges do no harm; no edges give
    no rows; null ends are dropped.
    """
    left = table(_ordered(edges.filter("a is not null and b is not null"), "a", "b"))
    steps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own, other = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("n")), F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("n"))
        step = table(both.groupBy("a").agg(F.min(other).alias("best")).select(F.col("a").alias("node"), F.least(own, F.col("best"))["n"].alias("to")))
        steps.append(step)
        moved = left.join(step.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        left = table(_ordered(moved, "x", "y"))
    if not steps:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    root = steps[0]
    for step in steps[1:]:
        root = root.join(step.select(F.col("node").alias("to"), F.col("to").alias("_next")), "to", "left").select("node", F.coalesce("_next", "to").alias("to"))
    root = table(root)
    least = table(root.groupBy("to").agg(F.min("node").alias("component")))
    return root.join(least, "to").select("node", "component")
