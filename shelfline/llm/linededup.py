"""Line dedup: prefix doubling over line-id sequences finds repeated line runs; later copies go.

A document is a sequence of line ids. Level k names, for every place, the run of 2^k
lines that starts there; level k + 1 pairs each place's name with the name 2^k lines on.
Places of equal name at level k are exactly the suffix array's intervals of common
prefix 2^k or more. Places whose run occurs once leave the doubling.

A run of any n lines is named by the two runs of 2^k lines, 2^k <= n < 2^(k + 1), at its
start and at its end. Not every run has to be named: a longest repeated run of
``min_words`` words or more is the union of the shortest such runs inside it, those from
each of its lines on and those up to each of its lines. So one map-side combined group
per level tells where these shortest runs occur first, and the doubling ends with the
longest of them. Only the narrow places are shuffled; texts move once, to lose lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.mixing import n_words
from shelfline.llm.scratch import free, table

MIN_WORDS = 20


def _place():
    """A document's place in the order of copies: its id (null last) and its text's hash. Rows alike in both are one document."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), F.xxhash64("text")


def _key():
    """The place and the text's length in one hash, to join by."""
    return F.xxhash64(*_place(), F.length("text"))


def _repeated(places: DataFrame, *name: str) -> DataFrame:
    """Places whose name occurs at another place too, with ``early``: whether it occurs before."""
    at = F.struct("d", "t", "i")
    groups = table(places.groupBy(*name).agg(F.count("*").alias("n_places"), F.min(at).alias("first")).filter("n_places > 1"))
    return places.join(groups, list(name)).withColumn("early", F.col("first") < at)


def _shortest(i: np.ndarray, w: np.ndarray, row: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lines) of the shortest runs of ``min_words`` words from each line on and up to each line, over neighbouring lines of one row.

    ``i``: line numbers, rising within a row; ``w``: their words; ``row``: their rows, in order.
    """
    n = len(i)
    new = np.ones(n, bool)
    new[1:] = (row[1:] != row[:-1]) | (i[1:] != i[:-1] + 1)
    heads = np.flatnonzero(new)
    part = np.cumsum(new) - 1
    sums = np.concatenate([[0], np.cumsum(w)])
    every = np.arange(n)
    to = np.maximum(np.searchsorted(sums, sums[:-1] + min_words, "left"), every + 1)
    on = to <= np.append(heads[1:], n)[part]
    since = np.minimum(np.searchsorted(sums, sums[1:] - min_words, "right") - 1, every)
    up = since >= heads[part]
    found = np.unique(np.stack([np.concatenate([every[on], since[up]]), np.concatenate([to[on], every[up] + 1])]), axis=1)
    return found[0], found[1] - found[0]


def _candidates(level: DataFrame, min_words: int) -> DataFrame:
    """(k, d, t, i, n): the shortest runs of ``min_words`` words among lines that occur again."""
    own = level.groupBy("k", "d", "t").agg(F.sort_array(F.collect_list(F.struct("i", "w"))).alias("lines"))  # of one document: bounded by its lines

    def run(batches):
        for batch in batches:
            lines = batch.column("lines")
            flat = lines.flatten()
            row = np.repeat(np.arange(batch.num_rows), lines.value_lengths().to_numpy(zero_copy_only=False))
            i, w = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1))
            place, n = _shortest(i, w, row, min_words)
            keys = [batch.column(c).take(pa.array(row[place])) for c in ("k", "d", "t")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(i[place].astype(np.int32)), pa.array(n.astype(np.int32))], ["k", "d", "t", "i", "n"])

    return own.mapInArrow(run, "k long, d long, t long, i int, n int")


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(k, i, n): runs of n lines from line i of document k on, of ``min_words`` words or more, that start earlier elsewhere.

    They are the shortest ones from each line on and up to each line. Their union is that of
    all such runs of any length: take line j of a run from a to b. If the lines from a to j have
    ``min_words`` words, the shortest run up to j lies inside; if those from j to b have, the
    shortest from j on does; else the shortest from a on holds j. Equal runs have equal shortest runs.
    """
    d, t = _place()
    lines = docs.select(_key().alias("k"), d.alias("d"), t.alias("t"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    lines = lines.select(
        "k", "d", "t", "i",
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"), n_words("line").alias("w"),
    )
    level = table(_repeated(lines, "h1", "h2").select("k", "d", "t", "i", F.xxhash64("h1", "h2").alias("name"), "w").dropDuplicates(["k", "i"]))
    wanted = table(_candidates(level, min_words))
    longest = wanted.agg(F.max("n")).first()[0] or 0
    runs, step = [], 1
    while step <= longest:
        head = level.select("k", "i", "name")
        tail = level.select("k", (F.col("i") + step).alias("_end"), F.col("name").alias("_tail"))
        now = wanted.filter((F.col("n") >= step) & (F.col("n") < 2 * step)).withColumn("_end", F.col("i") + F.col("n"))
        named = now.join(head, ["k", "i"]).join(tail, ["k", "_end"]).select("k", "d", "t", "i", "n", "name", "_tail")
        runs.append(table(_repeated(table(named), "n", "name", "_tail").filter("early").select("k", "i", "n")))
        step *= 2
        if step <= longest:
            after = level.select("k", (F.col("i") - step // 2).alias("i"), F.col("name").alias("_next"))
            pairs = level.join(after, ["k", "i"]).select("k", "d", "t", "i", F.xxhash64("name", "_next").alias("name"))
            level = table(_repeated(table(pairs), "name").select("k", "d", "t", "i", "name"))
    out = runs[0] if runs else docs.sparkSession.createDataFrame([], "k long, i int, n int")
    for more in runs[1:]:
        out = out.unionByName(more)
    return out


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines; n_lines, n_removed and ``removed`` (sorted line numbers) added.

    Lines are cut at line feeds and compared whole. The first of all copies, by document
    id and place, stays; null ids come last; rows alike in id and text are one document and
    are treated alike. Null text stays null and has no lines; an empty text is one empty line.
    Every other column passes unchanged (columns named like the added ones are replaced).
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed", "removed")]
    docs = docs.select(*own)
    key, other, cut = free(docs, "key", "other", "cut")
    spans = repeated_runs(docs, min_words).groupBy("k", "n").agg(F.collect_list("i").alias("starts"))  # of one document: bounded by its lines
    spans = spans.groupBy(F.col("k").alias(other)).agg(F.collect_list(F.struct("n", "starts")).alias(cut))
    joined = docs.withColumn(key, _key()).join(spans, F.col(key) == F.col(other), "left").select(*own, cut)
    fields = docs.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_lines long, n_removed long, removed array<int>"

    def run(batches):
        for batch in batches:
            texts, counts, gone = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(cut).to_pylist(), strict=True):
                lines = text.split("\n") if text is not None else []
                lost: list[int] = []
                if spans:
                    covers = np.zeros(len(lines) + 1, np.int64)  # runs begun less runs ended, line by line
                    for s in spans:
                        np.add.at(covers, s["starts"], 1)
                        np.add.at(covers, np.array(s["starts"]) + s["n"], -1)
                    covered = np.cumsum(covers[:-1]) > 0
                    lost = np.flatnonzero(covered).tolist()
                    text = "\n".join([x for x, gone_ in zip(lines, covered.tolist(), strict=True) if not gone_])
                texts.append(text)
                counts.append(len(lines))
                gone.append(lost)
            columns = [pa.array(texts, pa.string()) if f.name == "text" else batch.column(f.name) for f in fields]
            columns += [pa.array(counts, pa.int64()), pa.array([len(x) for x in gone], pa.int64()), pa.array(gone, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, [*[f.name for f in fields], "n_lines", "n_removed", "removed"])

    return joined.mapInArrow(run, schema)
