"""Mixing sources to target weights: repetition rates per source, then whole copies and one seeded draw.

Only DataFrame functions. Sizes are summed per source with map-side combine, the
targets are found on a row per source, and the rates come back to the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.scratch import free, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SOURCES_BROADCAST = 20_000  # rows of (source, rate) sent to every executor at most; beyond it the join shuffles


def n_words(text="text"):
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size -> also weight and target.

    Sources take the weights in code-point order, null last, repeating. A target is
    weight x level, but ``cap`` x size at most; the level is where all targets sum to
    ``share`` x all sizes. That is what handing each excess on by weight ends in: walk the
    sources by cap over weight, and take the first whose cap the level of the rest does not reach.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # a row per source
    weighted = sizes.withColumn("_i", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    )
    walk = Window.orderBy((F.col("source_size") / F.col("weight")), "_i")
    before, on = walk.rowsBetween(Window.unboundedPreceding, -1), walk.rowsBetween(0, Window.unboundedFollowing)
    all_sizes = F.sum("source_size").over(Window.partitionBy())
    level = (share * all_sizes - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("weight").over(on)
    levels = weighted.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("weight") <= cap * F.col("source_size"))
    best = F.min(F.when(F.col("_open"), F.struct((F.col("source_size") / F.col("weight")).alias("r"), "_i", "_level"))).over(Window.partitionBy())
    return levels.withColumn("_best", best["_level"]).select(
        "source", "source_size", "weight",
        F.coalesce(F.least(F.col("weight") * F.col("_best"), cap * F.col("source_size")), cap * F.col("source_size")).cast("double").alias("target"),
    )


def draw(seed: int):
    """A number in [0, 1) that only the seed, the document's id and its text decide."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))).alias("_u")


def plan(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 7) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, rate, copies, taken.

    ``copies`` is floor(rate) plus one with probability equal to the fraction. Null text
    has no words; a null source is a source of its own; a source without words has target
    0 and no copies; documents alike in id and text share their draw; no rows give no rows.
    """
    # the narrow rows have two uses: written once, so the texts are read once
    sized = table(docs.select("doc_id", "source", n_words().alias("size"), draw(seed)))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = table(targets(sizes, share, cap, weights).withColumn("rate", F.coalesce(F.expr("try_divide(target, source_size)"), F.lit(0.0))))
    aims = F.broadcast(aims) if aims.count() <= SOURCES_BROADCAST else aims
    copies = F.floor("rate") + F.when(F.col("_u") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return (
        sized.join(aims.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copies", copies.cast("int"))
        .select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"), "_u")
    )


def mix(docs: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS, seed: int = 7) -> DataFrame:
    """The mixed corpus: every document as often as the plan says, with all its columns."""
    sizes = table(docs.groupBy("source").agg(F.sum(n_words()).alias("source_size")))
    other, rate, n, copy = free(docs, "source", "rate", "n", "copy")
    aims = table(targets(sizes, share, cap, weights).select(F.col("source").alias(other), F.coalesce(F.expr("try_divide(target, source_size)"), F.lit(0.0)).alias(rate)))
    aims = F.broadcast(aims) if aims.count() <= SOURCES_BROADCAST else aims
    copies = F.floor(rate) + F.when(draw(seed) < F.col(rate) - F.floor(rate), 1).otherwise(0)
    return (
        docs.join(aims, F.col("source").eqNullSafe(F.col(other)))
        .withColumn(n, copies.cast("int"))
        .filter(F.col(n) > 0)
        .withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(n))))
        .select(*docs.columns)
    )
