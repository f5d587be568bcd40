"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles. Its sketch has one 64-bit parity
word per block: every shingle is XORed into the block its hash names, so two documents
differ in at most as many blocks as their sets have differing shingles. Within a size
band, similarity bounds that number by D; with more than D blocks at least one block is
equal (pigeonhole), and documents meet on (band, block, parity word). A 256-bit parity
sketch, whose Hamming distance also bounds the difference from below, drops most pairs
that meet by chance; the rest are verified on the sets themselves.

Documents of equal sets are one node from the start. Nodes are linked in three waves
(with the first of all partners, the first of each bucket, and whatever shares a bucket
and is still apart), so a bucket of true copies costs links in proportion to its size
while no link between nodes that are still apart is left out.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import textops
from shelfline.llm.components import components
from shelfline.llm.scratch import table

ELEMENT_BITS = 52  # of a shingle's hash; the rest of a sort key is the document's place in its run
MOST_DOCS = 1 << (64 - ELEMENT_BITS)
SPARE = 0.06  # blocks beyond D + 1, as a part of D: what may be empty without being looked at
BLOCK, TASK_WORK = 2048, 100_000  # members of a bucket compared at once; rows, and 512 comparisons a row, of a task
KEY_SHIFT = np.uint64(16)  # 48-bit bucket keys: a chance collision only adds a candidate
_U = np.uint64


class Sets:
    """Distinct shingles of a run of documents, sorted by document: ``doc`` and ``element`` run in parallel."""

    def __init__(self, run: textops.Words, words: int):
        h, counts, bounds = run.hashes(lower=True), run.counts, run.bounds
        docs = len(run)
        g = textops.grams(h, words)
        doc = run.doc_of_word()
        full = doc[:len(g)] == doc[words - 1:] if len(g) else np.zeros(0, bool)
        found, of = g[full], doc[:len(g)][full]
        for c in range(1, words):  # shorter texts: the whole sequence as one
            short = np.flatnonzero(counts == c)
            if len(short):
                found = np.concatenate([found, textops.grams(h, c)[bounds[short]] * _U(2 * c + 1)])
                of = np.concatenate([of, short])
        key = (of.astype(_U) << _U(ELEMENT_BITS)) | (textops.mix(found) >> _U(64 - ELEMENT_BITS))
        key.sort()
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
        self.doc = (key >> _U(ELEMENT_BITS)).astype(np.int64)
        self.element = key & _U((1 << ELEMENT_BITS) - 1)
        self.size = np.bincount(self.doc, minlength=docs)
        self.hash = textops.mix(self.element * _U(0x9E3779B97F4A7C15) + _U(1))
        self.set1, self.set2 = np.zeros(docs, _U), np.zeros(docs, _U)
        filled = np.flatnonzero(self.size)
        if len(filled):
            at = np.concatenate([[0], np.cumsum(self.size[filled])[:-1]])
            self.set1[filled] = textops.mix(np.add.reduceat(self.hash, at))
            self.set2[filled] = textops.mix(np.bitwise_xor.reduceat(textops.mix(self.hash + _U(7)), at))


def sets(column: pa.Array, words: int):
    """Sets of every run of a column; runs are short enough for the sort key."""
    for first in range(0, len(column), MOST_DOCS):
        for run in textops.words(column[first:first + MOST_DOCS]):
            run.first += first
            yield run, Sets(run, words)


def differing(percent: int, total: int) -> int:
    """Most shingles by which two sets of ``total`` shingles together can differ and still be similar."""
    return (100 - percent) * total // (100 + percent)


def indexes(size: int, percent: int, top: int = 1 << 40) -> list[tuple[int, int]]:
    """(index, D) pairs a set of this size takes part in.

    Bands double, from the largest size at which similar sets are equal. Index 2i joins
    the sets inside band i; index 2i + 1 joins sets on the two sides of band i's lower bound.
    """
    low = 0
    while differing(percent, 2 * (low + 1)) == 0:
        low += 1
    low = max(low, 1)
    out, i = [], 0
    while low <= top and size * 100 > percent * low - 100:
        high = 2 * low
        if low < size <= high:
            out.append((2 * i, differing(percent, 2 * high)))
        if (size <= low and size * 100 >= percent * (low + 1)) or (size > low and size * percent <= 100 * low):
            out.append((2 * i + 1, differing(percent, low + 100 * low // percent)))
        low, i = high, i + 1
    return [(k, d) for k, d in out if d > 0]


def _signatures(s: Sets, percent: int, seen: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket key, set key) rows of a run, for sets not ``seen`` in the task before."""
    names, once = np.unique(s.set1, return_index=True)
    chosen = np.zeros(len(s.size), bool)
    chosen[once] = [x not in seen for x in names.tolist()]
    seen.update(names.tolist())
    chosen &= s.size > 0
    per_size = {n: indexes(n, percent) for n in np.unique(s.size[chosen]).tolist()}
    slots = max((len(x) for x in per_size.values()), default=0)
    keys, owners = [], []
    starts = np.concatenate([[0], np.cumsum(s.size)])
    for slot in range(slots):
        index, blocks, spare = (np.zeros(len(s.size), np.int64) for _ in range(3))
        for n, has in per_size.items():
            if slot < len(has):
                own = chosen & (s.size == n)
                k, d = has[slot]
                more = math.ceil(SPARE * d) + 2
                index[own], blocks[own], spare[own] = k, d + 1 + more, more
        place = np.concatenate([[0], np.cumsum(blocks)])  # a document's blocks in the flat sketch
        total = int(place[-1])
        if not total:
            continue
        used = blocks[s.doc] > 0
        doc, h = s.doc[used], s.hash[used]
        at = place[doc] + (((h >> _U(32)) * blocks[doc].astype(_U)) >> _U(32)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        at, h = at[order], textops.mix(h + _U(3))[order]
        heads = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        word, at = np.bitwise_xor.reduceat(h, heads), at[heads]
        owner = np.searchsorted(place, at, "right") - 1
        tag = (index[owner].astype(_U) << _U(40)) | (at - place[owner]).astype(_U)
        keys.append(textops.mix(word ^ textops.mix(tag)))
        owners.append(owner)
        empty = blocks - np.bincount(owner, minlength=len(blocks))
        for i in np.flatnonzero((blocks > 0) & (empty > spare)).tolist():
            # too many empty blocks: an equal one may be empty. Two such sets share one of the
            # elements that come first in the common order of all hashes (prefix filter).
            n = int(s.size[i])
            prefix = s.element[starts[i]:starts[i + 1]][:n - -(-percent * n // 100) + 1]
            keys.append(textops.mix(prefix ^ textops.mix(np.full(1, (int(index[i]) << 40) | (1 << 39), _U))))
            owners.append(np.full(len(prefix), i))
    if not keys:
        return np.zeros(0, _U), np.zeros(0, _U)
    return np.concatenate(keys) >> KEY_SHIFT, s.set1[np.concatenate(owners)] >> KEY_SHIFT


def _sketch(s: Sets) -> list[np.ndarray]:
    """Four 64-bit parity words of each set."""
    out = []
    bit = s.hash & _U(255)
    filled = np.flatnonzero(s.size)
    at = np.concatenate([[0], np.cumsum(s.size[filled])[:-1]]) if len(filled) else np.zeros(0, np.int64)
    for k in range(4):
        value = np.where(bit >> _U(6) == _U(k), _U(1) << (bit & _U(63)), _U(0))
        words = np.zeros(len(s.size), _U)
        if len(filled):
            words[filled] = np.bitwise_xor.reduceat(value, at)
        out.append(words)
    return out


def described(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, set1, set2 (the set's 128-bit name) and the parity sketch p0 to p3."""

    def run(batches):
        for batch in batches:
            for part, s in sets(batch.column("text"), words):
                ids = batch.column("doc_id")[part.first:part.first + len(part)]
                of_text = batch.column("text_hash")[part.first:part.first + len(part)]
                arrays = [ids, of_text, pa.array(s.size)] + [pa.array(textops.signed(x)) for x in (s.set1, s.set2, *_sketch(s))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "n_shingles", "set1", "set2", "p0", "p1", "p2", "p3"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set1 long, set2 long, p0 long, p1 long, p2 long, p3 long")


def buckets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(bucket, set_key) rows of the buckets that hold two set keys or more."""

    def run(batches):
        seen: set[int] = set()  # a number per text of the task: a common text is sent once a task
        for batch in batches:
            for _, s in sets(batch.column("text"), words):
                keys, owners = _signatures(s, percent, seen)
                yield pa.RecordBatch.from_arrays([pa.array(textops.signed(keys)), pa.array(textops.signed(owners))], ["bucket", "set_key"])

    rows = docs.select("text").mapInArrow(run, "bucket long, set_key long")
    same = Window.partitionBy("bucket")
    return rows.withColumn("_lo", F.min("set_key").over(same)).withColumn("_hi", F.max("set_key").over(same)).filter("_lo < _hi").select("bucket", "set_key").distinct()


def _elements(texts: DataFrame, words: int) -> DataFrame:
    """The sets of (node, text) rows, whole and as wide sketches."""

    def run(batches):
        for batch in batches:
            for part, s in sets(batch.column("text"), words):
                ids = batch.column("node")[part.first:part.first + len(part)]
                ends = np.cumsum(s.size)
                packed = [s.element[e - n:e].tobytes() for e, n in zip(ends, s.size, strict=True)]
                wide = [_wide(s.hash[e - n:e]) for e, n in zip(ends, s.size, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, pa.array(s.size), pa.array(packed, pa.binary()), pa.array(wide, pa.binary())], ["node", "size", "elements", "wide"])

    return texts.select("node", "text").mapInArrow(run, "node long, size long, elements binary, wide binary")


def _wide(h: np.ndarray) -> bytes:
    """A parity sketch of one to two bits a shingle (a power of two, 256 at least). Halving it by XOR gives the next narrower one."""
    bits = 1 << max(8, (max(1, len(h)) - 1).bit_length())
    odd = (np.bincount((h & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").tobytes()


def _narrowed(sketch: bytes, words: int) -> np.ndarray:
    """A wide sketch as ``words`` 64-bit words."""
    x = np.frombuffer(sketch, _U)
    while len(x) > words:
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return x


def _fetched(pairs: DataFrame, elements: DataFrame, column: str) -> DataFrame:
    left = pairs.join(elements.select(F.col("node").alias("a"), F.col("size").alias("n"), F.col(column).alias("x")), "a")
    return left.join(elements.select(F.col("node").alias("b"), F.col("size").alias("m"), F.col(column).alias("y")), "b").select("a", "b", "n", "m", "x", "y")


def _verified(pairs: DataFrame, elements: DataFrame, percent: int) -> DataFrame:
    """The similar ones of (a, b) pairs: wide sketches first (a fortieth of the sets), then the sets."""

    def near(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "x", "y")), strict=True):
                words = min(len(x), len(y)) // 8
                hamming = int(np.bitwise_count(_narrowed(x, words) ^ _narrowed(y, words)).sum())
                keep.append(hamming * (100 + percent) <= (n + m) * (100 - percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    likely = table(_fetched(pairs, elements, "wide").mapInArrow(near, "a long, b long"))
    return _fetched(likely, elements, "elements").mapInArrow(exact, "a long, b long")


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b) pairs that sizes and sketches do not rule out."""
    sketch = ["n_shingles", "p0", "p1", "p2", "p3"]
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in sketch]), side)
    hamming = sum((F.bit_count(F.col(f"a_p{k}").bitwiseXOR(F.col(f"b_p{k}"))) for k in range(4)), F.lit(0))
    least, most = F.least("a_n_shingles", "b_n_shingles"), F.greatest("a_n_shingles", "b_n_shingles")
    return pairs.filter((least * 100 >= most * percent) & (hamming * (100 + percent) <= (least + most) * (100 - percent))).select("a", "b")


def _apart(members: DataFrame, elements: DataFrame, percent: int) -> DataFrame:
    """(a, b) pairs that share a bucket, lie in different components and are not ruled out by sizes and sketches.

    A bucket may hold many documents that share a passage and little else. Its members are
    compared by arrays, in blocks of ``BLOCK`` a side, and only plausible pairs become rows.
    Buckets of one first member, such as those a passage fills, share a task, so that a
    node's wide sketch is sent once for all of them, unless they are more than ``TASK_WORK``:
    then they are dealt to as many tasks as that takes.
    """
    sizes = table(members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("lo")))
    work = F.col("n") + F.col("n") * F.col("n") / 512
    shares = sizes.filter(F.col("n") <= BLOCK).groupBy("lo").agg(F.sum(work).alias("work"))
    total = shares.agg(F.coalesce(F.sum("work"), F.lit(0.0))).first()[0]
    shares = shares.select("lo", F.ceil(F.col("work") / TASK_WORK).alias("parts"))
    sizes = table(sizes.join(shares, "lo", "left").select("bucket", "lo", F.coalesce("parts", F.lit(1)).alias("parts"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    placed = members.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    # block pairs (i, j), i <= j, that a member's own block is part of
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    whole = F.pmod(F.xxhash64("lo"), F.lit(int(total // TASK_WORK) + 1))
    dealt = F.xxhash64("lo", F.pmod(F.xxhash64("bucket"), F.col("parts")))
    small = F.when(F.col("parts") == 1, whole).otherwise(dealt)
    placed = table(placed.withColumn("task", F.when(F.col("blocks") == 1, small).otherwise(F.xxhash64("bucket", "i", "j"))))

    def run(rows: pd.DataFrame, sketches: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bucket", "i", "j"], kind="stable")
        named = dict(zip(sketches["node"], sketches["wide"], strict=True))
        key = rows[["bucket", "i", "j"]].to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(rows)]])
        node, group, size, own = (rows[c].to_numpy() for c in ("node", "component", "n_shingles", "own"))
        words, sketch = rows[["p0", "p1", "p2", "p3"]].to_numpy().view(_U), [named[x] for x in rows["node"]]
        found_a, found_b = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            here = np.arange(lo, hi)
            if (group[lo:hi] == group[lo]).all():
                continue
            least_words = min(len(w) for w in sketch[lo:hi]) // 8
            wide = np.stack([_narrowed(w, least_words) for w in sketch[lo:hi]])
            left, right = here[own[lo:hi] == key[lo, 1]], here[own[lo:hi] == key[lo, 2]]
            for at in range(0, len(left), 256):
                x = left[at:at + 256]
                least, most = np.minimum(size[x][:, None], size[right]), np.maximum(size[x][:, None], size[right])
                hamming = sum(np.bitwise_count(words[x, k][:, None] ^ words[right, k][None, :]).astype(np.int64) for k in range(4))
                good = (group[x][:, None] != group[right]) & (least * 100 >= most * percent) & (hamming * (100 + percent) <= (least + most) * (100 - percent))
                for k in np.flatnonzero(good.any(1)):  # what is left: by the wide sketch
                    j = np.flatnonzero(good[k])
                    apart = np.bitwise_count(wide[right[j] - lo] ^ wide[x[k] - lo]).astype(np.int64).sum(1)
                    good[k, j] = apart * (100 + percent) <= (size[x[k]] + size[right[j]]) * (100 - percent)
                i, j = np.nonzero(good)
                found_a.append(np.minimum(node[x[i]], node[right[j]]))
                found_b.append(np.maximum(node[x[i]], node[right[j]]))
        pairs = np.unique(np.stack([np.concatenate(found_a), np.concatenate(found_b)], 1), axis=0) if found_a else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    wide = placed.select("task", "node").distinct().join(elements.select("node", "wide"), "node")
    return placed.groupBy("task").cogroup(wide.select(*[F.col(c).alias(c) for c in ("task", "node", "wide")]).groupBy("task")).applyInPandas(run, "a long, b long")


def similar_components(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest id reachable by links of 100 x intersection >= ``percent`` x union.

    A-Z count as a-z. Texts with fewer than ``words`` words are one shingle; null, empty
    and blank texts are empty sets, linked with nothing. Sets are compared, not ids: each
    text of a repeated id finds its own links, and these hold for the id, whose texts
    are one component; each row keeps its own count. Rows without an id link with nothing
    and have no component. An empty table gives no rows. Other columns are ignored.
    Shingles are told apart by hashes of ``ELEMENT_BITS`` bits, sets by 128 bits.
    """
    narrow = table(described(docs, words))
    own = narrow.filter("doc_id is not null and n_shingles > 0")
    name = ["n_shingles", "set1", "set2"]
    classes = own.groupBy(*name).agg(F.min(F.struct("doc_id", "text_hash")).alias("of"), *[F.first(f"p{k}").alias(f"p{k}") for k in range(4)])
    # a node is a number per set, in the order of ids (so that the oldest text of a bucket is its first), fixed by being written
    classes = classes.select(*name, "of.doc_id", "of.text_hash", *[f"p{k}" for k in range(4)]).repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash")
    classes = table(classes.select(F.monotonically_increasing_id().alias("node"), "*"))
    found = table(buckets(docs.filter("doc_id is not null"), words, percent))
    named = classes.select(F.shiftrightunsigned("set1", 16).alias("set_key"), "node")
    # a bucket's rows by node; a node may stand in a bucket once for each of its keys
    members = table(found.join(named, "set_key").select("bucket", "node").distinct())
    wanted = classes.select("node", "doc_id", "text_hash").join(members.select("node").distinct(), "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").join(wanted, ["doc_id", "text_hash"])
    texts = texts.groupBy("doc_id", "text_hash", "node").agg(F.first("text").alias("text"))  # equal rows once
    elements = table(_elements(texts, words))
    sketches = classes.drop("set1", "set2", "doc_id", "text_hash")

    first = members.groupBy("bucket").agg(F.min("node").alias("lo"))
    linked = table(members.join(table(first), "bucket").filter("lo < node").select(F.col("lo").alias("a"), F.col("node").alias("b")).distinct())
    wave1 = table(linked.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    edges = table(_verified(_plausible(wave1, sketches, percent), elements, percent))
    # the sets of one id hold together without any similarity
    repeated = own.groupBy("doc_id").agg(F.min("text_hash").alias("x"), F.max("text_hash").alias("y")).filter("x < y").select("doc_id")
    same = table(own.join(repeated, "doc_id").select("doc_id", *name).distinct().join(classes.select("node", *name), name).select("doc_id", "node"))
    first = same.groupBy("doc_id").agg(F.min("node").alias("a"))
    edges = table(edges.unionByName(same.join(first, "doc_id").filter("a < node").select("a", F.col("node").alias("b"))))
    tried = wave1
    for wave in (2, 3):
        group = table(components(edges))
        label = members.select("node").distinct().join(group, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        label = table(label)
        if wave == 2:
            pairs = linked
        else:
            apart = table(members.join(label, "node"))
            open_ = apart.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("bucket")
            apart = table(apart.join(open_, "bucket"))
            pairs = _apart(apart.join(sketches, "node"), elements, percent).distinct()
        for side in ("a", "b"):
            pairs = pairs.join(label.select(F.col("node").alias(side), F.col("component").alias(f"{side}_of")), side)
        pairs = table(_plausible(pairs.filter("a_of <> b_of").select("a", "b").join(tried, ["a", "b"], "left_anti"), sketches, percent))
        if pairs.isEmpty():
            continue
        tried = tried.unionByName(pairs)
        edges = table(edges.unionByName(_verified(pairs, elements, percent)))
    group = table(components(edges))
    held = table(group.join(classes.select("node", "doc_id"), "node"))
    least = table(held.groupBy("component").agg(F.min("doc_id").alias("_least")))
    least = held.join(least, "component").select("node", "_least")
    of_class = table(classes.select("node", "doc_id", *name).join(least, "node", "left").select(*name, F.coalesce("_least", "doc_id").alias("_component")))
    return narrow.join(of_class, name, "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id")
    )


def keep_representatives(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that are linked to one of smaller id; rows without an id stay.

    Rows alike in id and text are one document and stay as they are.
    """
    gone = table(similar_components(docs, words, percent).filter("component_id < doc_id").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
