"""Approximate nearest neighbours by learned partitions.

On a bounded sample (``SAMPLE`` vectors): a neighbour graph by exact products, a balanced
partition of it (bisection along the widest direction, then moves to where most
neighbours are while room is left), a small network that predicts a vector's partition,
and the number of partitions a query has to try for the wanted recall there. Every
vector is then indexed under its most probable partition; queries go to their most
probable ones and are ranked there by exact products.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import vectors
from shelfline.llm.scratch import table

SAMPLE = 8192
NEIGHBOURS, SLACK, MOVES = 10, 1.1, 15
PARTS_PER_ROOT, MOST_PARTS = 1 / 8, 256  # parts follow the root of the rows: routing and ranking then grow alike
HIDDEN, EPOCHS, BATCH, RATE = 64, 40, 128, 0.01
RECALL = 0.97  # aimed at in the sample; what the whole table reaches is measured in tests
BLOCK, QUERY_BLOCK = 4096, 8192
TOP = 20


def neighbour_graph(x: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Row numbers of each row's k nearest others by inner product."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), max(k, 0)), np.int64)
    for at in range(0, len(x), 1024):
        near = x[at:at + 1024] @ x.T
        near[np.arange(len(near)), np.arange(at, at + len(near))] = -np.inf
        out[at:at + 1024] = np.argpartition(-near, k - 1, axis=1)[:, :k] if k > 0 else 0
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, moves: int = MOVES) -> np.ndarray:
    """A part of each row: parts of near equal size that cut few edges of the graph."""
    label = np.zeros(len(x), np.int64)

    def split(rows: np.ndarray, first: int, n: int) -> None:
        if n == 1 or len(rows) < 2:
            label[rows] = first
            return
        inside = x[rows] - x[rows].mean(0)
        direction = np.ones(x.shape[1])
        for _ in range(12):  # power iteration: the direction of greatest spread
            direction = inside.T @ (inside @ direction)
            direction /= max(np.sqrt((direction * direction).sum()), 1e-30)
        order = rows[np.argsort(inside @ direction, kind="stable")]
        left = len(rows) * (n // 2) // n
        split(order[:left], first, n // 2)
        split(order[left:], first + n // 2, n - n // 2)

    split(np.arange(len(x)), 0, parts)
    room = math.ceil(SLACK * len(x) / parts)
    size = np.bincount(label, minlength=parts)
    for _ in range(moves):
        votes = np.zeros((len(x), parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(label, graph.shape[1])), 1)  # edges count at both ends
        own = votes[np.arange(len(x)), label]
        best = votes.argmax(1)
        gain = votes[np.arange(len(x)), best] - own
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer: scores of the parts for each row."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train_router(x: np.ndarray, label: np.ndarray, parts: int, seed: int = 5) -> Router:
    """Softmax regression on one hidden layer, by Adam."""
    rng = np.random.default_rng(seed)
    p = [rng.normal(0, math.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, math.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            hidden = np.maximum(x[rows] @ p[0] + p[1], 0)
            out = hidden @ p[2] + p[3]
            out = np.exp(out - out.max(1, keepdims=True))
            out /= out.sum(1, keepdims=True)
            out[np.arange(len(rows)), label[rows]] -= 1
            out /= len(rows)
            back = (out @ p[2].T) * (hidden > 0)
            grads = [x[rows].T @ back, back.sum(0), hidden.T @ out, out.sum(0)]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Router(*p)


@dataclass
class Index:
    router: Router | None
    scale: float
    parts: int
    probes: int

    def order(self, x: np.ndarray) -> np.ndarray:
        """Parts of each row, most probable first."""
        if self.router is None:
            return np.zeros((len(x), 1), np.int64)
        return np.argsort(-self.router.scores(x / self.scale), axis=1, kind="stable")


def fit(x: np.ndarray, parts: int, recall: float = RECALL, top: int = TOP) -> Index:
    """An index from a sample: with one part everything is searched."""
    if parts < 2 or len(x) < 2 * parts:
        return Index(None, 1.0, 1, 1)
    scale = float(np.sqrt((x * x).sum(1)).mean())
    y = x / scale
    router = train_router(y, balanced_partition(y, neighbour_graph(y), parts), parts)
    index = Index(router, scale, parts, parts)
    order = index.order(x)
    home = order[:, 0]
    asked = np.arange(0, len(x), max(1, len(x) // 512))
    truth = neighbour_graph(x, top)[asked]
    place = np.argsort(order[asked], axis=1)  # place[q, part]: when the part is tried
    needed = np.sort(np.take_along_axis(place, home[truth], axis=1).ravel())
    index.probes = int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) + 1
    return index


def _best(top: int):
    """The ``top`` best ids of each query's vector in one pair of blocks; a row stands for all ids of its vector."""

    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {"h1": [], "h2": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            ids, x = rows["ids"].to_numpy(), vectors.matrix(rows["v"])
            size = np.sqrt((x * x).sum(1))
            names, q = queries[["h1", "h2"]].to_numpy(), vectors.matrix(queries["v"])
            for at in range(0, len(q), 512):
                near = q[at:at + 512] @ x.T
                k = min(top, near.shape[1])
                least = -np.partition(-near, k - 1, axis=1)[:, k - 1]
                for i in range(len(near)):
                    # the product's rounding depends on a row's place; settle what is near the edge, ties too, row by row
                    slack = 1e-12 * float(size.max() * np.sqrt((q[at + i] ** 2).sum()))
                    pick = np.flatnonzero(near[i] >= least[i] - slack)
                    own = np.concatenate([np.asarray(ids[j], np.int64) for j in pick])
                    score = np.repeat((x[pick] * q[at + i]).sum(1), [len(ids[j]) for j in pick])
                    first = np.lexsort((own, -score))[:top]
                    out["h1"].append(np.full(len(first), names[at + i, 0]))
                    out["h2"].append(np.full(len(first), names[at + i, 1]))
                    out["vec_id"].append(own[first])
                    out["score"].append(score[first])
        return pd.DataFrame({c: np.concatenate(v or [np.zeros(0, np.float64 if c == "score" else np.int64)]) for c, v in out.items()})

    return run


def _by_length(embeddings: pd.Series):
    """(length, row numbers) of a batch, in slices of 4,096 rows."""
    lengths = embeddings.map(len).to_numpy()
    for dims in np.unique(lengths):
        rows = np.flatnonzero(lengths == dims)
        for at in range(0, len(rows), 4096):
            yield int(dims), rows[at:at + 4096]


def search(frame: DataFrame, queries: DataFrame, top: int = TOP, sample: int = SAMPLE, parts_per_root: float = PARTS_PER_ROOT, recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``top`` best of the rows its partitions hold, by inner product in double precision.

    ``queries`` has vec_id and embedding; its own id is no candidate. Vectors that are
    null, empty, zero or hold null or non-finite components, and those without an id, take
    no part, neither as query nor as candidate. Vectors meet those of their own length: each
    length has an index of its own. Ties go to the smaller id. Lengths with too few rows for
    two partitions are searched whole.

    Equal vectors are indexed and asked once, with the ``top`` + 1 smallest of their ids, which
    are all that a list of ``top`` can show, so copies of one vector neither fill the sample nor
    a partition. A query tries further partitions until they hold ``top`` other ids, so lists
    are short only where the table is. A row given twice counts once; an id with different
    vectors is asked once for each of them and may then have as many fewer neighbours.
    """
    name = ["h1", "h2"]

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
        df = df.filter(vectors.usable(df) & F.col("vec_id").isNotNull())
        return df.withColumns({"h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(1), "embedding")})

    rows, asked = clean(frame), clean(queries)
    smallest = F.row_number().over(Window.partitionBy(*name).orderBy("vec_id"))
    ids = rows.select("vec_id", *name).distinct().withColumn("_n", smallest).filter(F.col("_n") <= top + 1).groupBy(*name).agg(F.collect_list("vec_id").alias("ids"))
    distinct = table(rows.groupBy(*name).agg(F.first("embedding").alias("embedding")).join(ids, name))

    indexes, used = {}, 0  # by length: the index and the number of its first partition
    for dims, n in sorted(distinct.groupBy(F.size("embedding")).count().collect()):
        parts = max(1, min(MOST_PARTS, int(parts_per_root * math.sqrt(n))))
        indexes[dims] = (fit(vectors.sample(distinct, sample, dims) if parts > 1 else np.zeros((0, dims)), parts, recall, top), used)
        used += indexes[dims][0].parts

    def index_rows(frames):
        for part in frames:
            for dims, at in _by_length(part["embedding"]):
                some, (index, first) = part.iloc[at], indexes[dims]
                home = index.order(vectors.matrix(some["embedding"]))[:, 0] + first
                yield pd.DataFrame({"part": home, "h1": some["h1"], "v": some["embedding"], "ids": some["ids"]})

    indexed = table(distinct.mapInPandas(index_rows, "part int, h1 long, v array<double>, ids array<long>"))
    held = np.zeros(used, np.int64)
    for part, n in indexed.groupBy("part").agg(F.sum(F.size("ids"))).collect():  # a row per partition
        held[part] = n

    def route(frames):
        for part in frames:
            for dims, at in _by_length(part["embedding"]):
                if dims not in indexes:
                    continue
                some, (index, first) = part.iloc[at], indexes[dims]
                order = index.order(vectors.matrix(some["embedding"]))
                before = np.cumsum(held[order + first], axis=1) - held[order + first]
                row, place = np.nonzero((np.arange(order.shape[1]) < index.probes) | (before <= top))
                some = some.iloc[row]
                yield pd.DataFrame({"part": order[row, place] + first, "h1": some["h1"], "h2": some["h2"], "v": some["embedding"]})

    routed = table(asked.groupBy(*name).agg(F.first("embedding").alias("embedding")).mapInPandas(route, "part int, h1 long, h2 long, v array<double>"))
    # rows of a part in blocks, queries of a part in blocks: a row per part
    blocks = F.broadcast(indexed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    groups = F.broadcast(routed.groupBy("part").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("groups")))
    left = routed.join(blocks, "part").join(groups, "part").withColumn("j", F.pmod("h1", "groups").cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = indexed.join(blocks, "part").join(groups, "part").withColumn("i", F.pmod("h1", "blocks").cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    key = ["part", "i", "j"]
    found = left.select(*key, *name, "v").groupBy(*key).cogroup(right.select(*[F.col(c).alias(c) for c in (*key, "v", "ids")]).groupBy(*key)).applyInPandas(_best(top + 1), "h1 long, h2 long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy(*name).orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("_n", rank).filter(F.col("_n") <= top + 1).groupBy(*name).agg(F.array_sort(F.collect_list(F.struct("_n", "vec_id", "score"))).alias("_best"))
    others = F.filter("_best", lambda b: b["vec_id"] != F.col("query_id"))
    lists = asked.select(F.col("vec_id").alias("query_id"), *name).distinct().join(best, name)
    lists = lists.select("query_id", F.posexplode(F.slice(others, 1, top)).alias("_p", "_b"))
    return lists.select("query_id", (F.col("_p") + 1).alias("rank"), F.col("_b.vec_id").alias("vec_id"), F.col("_b.score").alias("score"))
