"""Embedding near-dedup: spherical k-means cells, blocked cosine products inside them, one kept per group.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors). Each distinct vector has
the cell of its nearest centroid as home and is also shown to every other cell that a
vector within the distance of the threshold could have as home: unit vectors of cosine t
are sqrt(2 - 2t) apart, and a vector nearer to centroid c than to the own one lies beyond
the plane between them. So comparing homes with all a cell is shown misses no link.
Large cells are cut into blocks on both sides; a block returns counts and a spanning
label per vector, never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm import vectors
from shelfline.llm.components import components
from shelfline.llm.scratch import table

COSINE = 0.98
SAMPLE, ROUNDS, MOST_CELLS = 16_384, 10, 1024
CELL_ROWS = 8192  # vectors a cell is meant to be home of
BLOCK = 2048  # rows on each side of a product
CELLS_BROADCAST = 50_000  # rows of (label, cell, blocks) sent to every executor at most; beyond it the join shuffles


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k unit centroids of unit rows (fewer if there are fewer rows); empty cells restart at the worst served rows."""
    k = min(k, len(x))
    centroids = x[np.linspace(0, len(x) - 1, k).astype(int)].copy() if k else x
    for _ in range(rounds if k > 1 else 1):
        near = x @ centroids.T if k else np.zeros((0, 0))
        home = near.argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        size = np.sqrt((sums * sums).sum(1))
        empty = np.flatnonzero(size < 1e-12)
        if len(empty):
            sums[empty] = x[np.argsort(near.max(1), kind="stable")[:len(empty)]]
            size = np.maximum(np.sqrt((sums * sums).sum(1)), 1e-12)
        centroids = sums / size[:, None]
    return centroids


def _shown(distinct: DataFrame, centroids: np.ndarray, dims: int, reach: float) -> DataFrame:
    """label, cell, home, rep, copies, v: each vector in its home cell and wherever a neighbour's home may be."""
    apart = centroids[None, :, :] - centroids[:, None, :]
    gap = np.sqrt((apart * apart).sum(2)) if len(centroids) else np.zeros((0, 0))

    def run(frames):
        for frame in frames:
            usual = frame["embedding"].map(len).to_numpy() == dims
            if (~usual).any():  # other lengths: one cell per length
                odd = frame[~usual]
                units = [vectors.unit(np.array(v, np.float64)[None, :])[0] for v in odd["embedding"]]
                yield pd.DataFrame({"label": odd["label"], "cell": -odd["embedding"].map(len), "home": True, "rep": odd["rep"], "copies": odd["copies"], "v": units})
            rows = frame[usual]
            for at in range(0, len(rows), 2048):
                part = rows.iloc[at:at + 2048]
                x = vectors.unit(vectors.matrix(part["embedding"]))
                near = x @ centroids.T
                home = near.argmax(1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    margin = (near[np.arange(len(x)), home][:, None] - near) / gap[home]
                show = ~(margin > reach)
                show[np.arange(len(x)), home] = True
                i, cell = np.nonzero(show)
                yield pd.DataFrame({
                    "label": part["label"].to_numpy()[i], "cell": cell, "home": home[i] == cell, "rep": part["rep"].to_numpy()[i],
                    "copies": part["copies"].to_numpy()[i], "v": list(x[i]),
                })

    return distinct.mapInPandas(run, "label string, cell int, home boolean, rep long, copies long, v array<double>")


def _compare(cosine: float):
    def run(home: pd.DataFrame, shown: pd.DataFrame) -> pd.DataFrame:
        if not len(home) or not len(shown):
            return pd.DataFrame({"rep": [], "links": [], "other": []}).astype("int64")
        close = vectors.matrix(home["v"]) @ vectors.matrix(shown["v"]).T >= cosine
        a, b = home["rep"].to_numpy(), shown["rep"].to_numpy()
        close &= a[:, None] != b[None, :]
        links = close @ shown["copies"].to_numpy().astype(np.float64)
        of_a, of_b = a.copy(), b.copy()
        while True:  # smallest id reachable inside the block
            top = np.iinfo(np.int64).max
            new_a = np.minimum(of_a, np.where(close, of_b[None, :], top).min(1))
            new_b = np.minimum(of_b, np.where(close, new_a[:, None], top).min(0))
            if (new_a == of_a).all() and (new_b == of_b).all():
                break
            of_a, of_b = new_a, new_b
        rep, other, links = np.concatenate([a, b]), np.concatenate([of_a, of_b]), np.concatenate([links.astype(np.int64), np.zeros(len(b), np.int64)])
        use = (rep != other) | (links > 0)
        return pd.DataFrame({"rep": rep[use], "links": links[use], "other": other[use]})

    return run


def near_duplicates(frame: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, cell_rows: int = CELL_ROWS, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept: links join vectors of equal label and a cosine of ``cosine`` or more.

    Vectors that are null, empty, zero or hold null or non-finite components, and those of
    null label or id, link with nothing (their component is their own id). Vectors of
    different length never link. Every row counts: two rows of one id are two vectors
    with a common component. Equal vectors of a label are compared once. No rows give no rows.
    """
    rows = frame.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    good = rows.filter(vectors.usable(rows) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    named = good.withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit(1), "embedding"))
    distinct = table(named.groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")))
    n, dims = distinct.count(), vectors.usual_dims(distinct)
    cells = max(1, min(MOST_CELLS, math.ceil(n / cell_rows)))
    centroids = spherical_kmeans(vectors.unit(vectors.sample(distinct, sample, dims)), cells) if n else np.zeros((0, 0))

    shown = table(_shown(distinct, centroids, dims, math.sqrt(2 - 2 * cosine) + 1e-6))
    blocks = shown.groupBy("label", "cell").agg(
        F.ceil(F.count_if("home") / block).cast("int").alias("homes"), F.ceil(F.count("*") / block).cast("int").alias("sides")
    )
    blocks = table(blocks.filter("homes > 0"))
    blocks = F.broadcast(blocks) if blocks.count() <= CELLS_BROADCAST else blocks
    placed = shown.join(blocks, ["label", "cell"])
    home = placed.filter("home").withColumn("i", F.pmod(F.xxhash64("rep"), "homes").cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    side = placed.withColumn("j", F.pmod(F.xxhash64("rep"), "sides").cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)))
    key = ["label", "cell", "i", "j"]
    found = table(
        home.select(*key, "rep", "v").groupBy(*key).cogroup(side.select(*[F.col(c).alias(c) for c in (*key, "rep", "copies", "v")]).groupBy(*key)).applyInPandas(_compare(cosine), "rep long, links long, other long")
    )
    # two rows of one id, with different vectors, are one node
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    twins = named.join(distinct.select("label", "h1", "h2", "rep"), ["label", "h1", "h2"]).filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    shared = named.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("vec_id").alias("a"))
    edges = found.filter("rep <> other").select(F.col("rep").alias("a"), F.col("other").alias("b")).unionByName(twins.join(shared, "a", "left_semi"))
    group = table(components(edges))
    known = distinct.select("label", "h1", "h2", "rep", "copies").join(links, "rep", "left").join(group, F.col("rep") == F.col("node"), "left").select(
        "label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"), F.coalesce("component", "rep").alias("_component")
    )
    known = table(known)
    every = rows.withColumn("h1", F.when(vectors.usable(rows) & F.col("vec_id").isNotNull(), F.xxhash64("embedding"))).withColumn("h2", F.xxhash64(F.lit(1), "embedding"))
    return every.join(known, ["label", "h1", "h2"], "left").select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_component", "vec_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
