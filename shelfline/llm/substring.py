"""Substring dedup: suffix automata of reference shards, and matching statistics against them.

Sending every document past an automaton of every shard would cost documents x shards,
so places that can match are brought together first. A window of ``window`` words is
filed under its anchor, the ``GRAM`` words inside it of lowest hash: equal windows have
equal anchors. Consecutive windows with one anchor form a span. Spans whose anchor
occurs once in the corpus cannot repeat and drop out; a span equal to an earlier span
repeats as a whole. What is left are anchors with different surroundings (edges of shared
passages, edited copies): their first spans, word by word, are the reference shards.
A shard's automaton is built from its spans in corpus order, the spans are streamed past
it, and a window goes where the match of that length ends first at an earlier place.

An anchor with more surroundings than a shard holds meets no automaton: each window of its
spans is hashed, and a map-side combined group per hash finds where it starts first. Its
rows grow with its windows, and no task holds the anchor. Texts are shuffled twice: to cut
out words, and to lose them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm import textops
from shelfline.llm.automaton import SuffixAutomaton
from shelfline.llm.scratch import table

WINDOW, GRAM = 20, 8
SHARD_SPANS = 2000  # spans of one automaton: some 60,000 words
_U = np.uint64


def _spans(run: textops.Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, first window, windows, anchor hash, content hash) of each span of a run."""
    h = run.hashes()
    g = textops.grams(h, gram)
    none = np.zeros(0, np.int64)
    if len(h) < window:
        return none, none, none, none.astype(_U), none.astype(_U)
    doc = run.doc_of_word()
    start = np.flatnonzero(doc[:len(h) - window + 1] == doc[window - 1:])
    near = np.lib.stride_tricks.sliding_window_view(g, window - gram + 1)
    anchor = np.concatenate([near[at:at + 65536].argmin(1) for at in range(0, len(near), 65536)])[start] + start
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    heads = np.flatnonzero(new)
    if not len(heads):
        return none, none, none, none.astype(_U), none.astype(_U)
    n = np.diff(np.append(heads, len(start)))
    first = start[heads]
    sums = np.zeros(len(h) + 1, _U)
    np.cumsum(h * textops._power_table(textops._WORD_BASE, len(h)), out=sums[1:])
    back = textops._power_table(pow(textops._WORD_BASE, -1, 1 << 64), len(h))
    content = textops.mix((sums[first + n + window - 1] - sums[first]) * back[first] + n.astype(_U))
    return doc[first], first - run.bounds[doc[first]], n, g[anchor[heads]], content


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, d (id; null last) and t (hash of the text and its length): texts that share an id are told apart by t."""
    return docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("d"), F.xxhash64("text", F.length("text")).alias("t"))


def spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(a, s, d, t, p, n, known): the spans of all texts, p the place of the first window. (d, t, p) is the corpus order.

    Of equal spans that meet in one batch slice only the first goes to its anchor; the
    others are known to repeat, and get keys of their own: a span in every document
    reaches its anchor once per slice, not once per document.
    """

    def run(batches):
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "t"))
            for part in textops.words(batch.column("text")):
                doc, first, n, a, s = _spans(part, window, gram)
                if not len(doc):
                    continue
                d, t, p = ids[part.first + doc], tags[part.first + doc], first
                order = np.lexsort((p, t, d, s, a))
                same = np.zeros(len(order), bool)
                same[1:] = (a[order][1:] == a[order][:-1]) & (s[order][1:] == s[order][:-1]) & ((d[order][1:] != d[order][:-1]) | (t[order][1:] != t[order][:-1]) | (p[order][1:] != p[order][:-1]))
                known = np.zeros(len(order), bool)
                lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
                # only what differs in place from the first of its kind comes later
                known[order] = same & ((d[order] != d[order][lead]) | (t[order] != t[order][lead]) | (p[order] != p[order][lead]))
                own = textops.mix(textops.mix(d.astype(_U) * _U(0x9E3779B97F4A7C15) ^ t.astype(_U)) + p.astype(_U))
                a = np.where(known, own, a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(textops.signed(a)), pa.array(textops.signed(s)), pa.array(d), pa.array(t), pa.array(p), pa.array(n.astype(np.int32)), pa.array(known)],
                    ["a", "s", "d", "t", "p", "n", "known"],
                )

    return _keyed(docs).select("d", "t", "text").mapInArrow(run, "a long, s long, d long, t long, p long, n int, known boolean")


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(a, s, d, t, p, n, later): spans under anchors that occur again. ``later``: an equal span comes before; else the anchor has other spans."""
    same, anchor = Window.partitionBy("a", "s"), Window.partitionBy("a")
    seen = spans(docs, window, gram).withColumn("_first", F.min(F.struct("d", "t", "p")).over(same)).withColumn("_lo", F.min("s").over(anchor)).withColumn("_hi", F.max("s").over(anchor))
    later = F.col("known") | (F.col("_first") < F.struct("d", "t", "p"))
    return seen.filter(later | (F.col("_lo") < F.col("_hi"))).select("a", "s", "d", "t", "p", "n", later.alias("later"))


def _with_words(docs: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """The spans with their words, cut out of the texts."""
    wanted = found.groupBy("d", "t").agg(F.collect_list(F.struct("a", "s", "p", "n")).alias("spans"))  # of one text
    joined = _keyed(docs).join(wanted, ["d", "t"]).select("d", "t", "text", "spans")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out: list[list] = [[] for _ in range(7)]
                some = batch.slice(at, 64).to_pylist()
                for row in some:
                    words = row["text"].encode().split()
                    for x in row["spans"]:
                        for column, value in zip(out, (x["a"], x["s"], row["d"], row["t"], x["p"], x["n"], b" ".join(words[x["p"]:x["p"] + x["n"] + window - 1])), strict=True):
                            column.append(value)
                kinds = (*[pa.int64()] * 5, pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["a", "s", "d", "t", "p", "n", "words"])

    return joined.mapInArrow(run, "a long, s long, d long, t long, p long, n int, words binary")


def _stream(window: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["d", "t", "p"], kind="stable")
        automaton, at, place = SuffixAutomaton(), [], []
        for d, t, p, words in rows.loc[rows["reference"], ["d", "t", "p", "words"]].itertuples(index=False):
            at.append(automaton.add(words.split()))
            place.append((d, t, p))
        starts = np.array(at + [automaton.size])
        masks = []
        for d, t, p, words in rows[["d", "t", "p", "words"]].itertuples(index=False):
            mask = 0
            for end, symbol in automaton.matches(words.split(), window):
                k = int(np.searchsorted(starts, symbol, "right")) - 1
                if (*place[k][:2], place[k][2] + symbol - starts[k]) < (d, t, p + end - 1):
                    mask |= 1 << (end - window)
            masks.append(mask)
        rows = rows.assign(mask=masks)
        return rows.loc[rows["mask"] > 0, ["d", "t", "p", "mask"]]

    return run


def _by_hash(worded: DataFrame, window: int) -> DataFrame:
    """(d, t, p, mask) like the automata's, by the hash of every window: one row a window, whatever shares its anchor."""

    def run(batches):
        for batch in batches:
            for part in textops.words(batch.column("words").cast(pa.string())):
                g, doc = textops.grams(part.hashes(), window), part.doc_of_word()
                start = np.flatnonzero(doc[:len(g)] == doc[window - 1:]) if len(g) else np.zeros(0, np.int64)
                own = doc[start]
                rows = pa.array(part.first + own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(textops.signed(g[start])), *[batch.column(c).take(rows) for c in ("d", "t", "p")], pa.array((start - part.bounds[own]).astype(np.int32))],
                    ["g", "d", "t", "p", "j"],
                )

    windows = table(worded.select("d", "t", "p", "words").mapInArrow(run, "g long, d long, t long, p long, j int"))
    at = F.struct("d", "t", (F.col("p") + F.col("j")).alias("at"))
    first = windows.groupBy("g").agg(F.count("*").alias("n_places"), F.min(at).alias("first")).filter("n_places > 1")
    return windows.join(first, "g").filter(F.col("first") < at).groupBy("d", "t", "p").agg(F.expr("bit_or(shiftleft(1L, j))").alias("mask"))


def _earlier_windows(docs: DataFrame, found: DataFrame, window: int, shard_spans: int) -> DataFrame:
    """(d, t, p, mask): windows of the anchors' first spans that start earlier in another span."""
    hot = table(found.groupBy("a").agg(F.count("*").alias("n_spans")).filter(F.col("n_spans") > shard_spans).select("a"))
    # anchors share shards until a shard is full; the number of shards follows the number of spans
    shards = max(1, -(-found.count() // shard_spans))
    worded = table(_with_words(docs, found, window))
    dealt = worded.join(hot, "a", "left_anti").select(F.pmod("a", F.lit(shards)).alias("shard"), F.lit(True).alias("reference"), "d", "t", "p", "words")
    judged = dealt.groupBy("shard").applyInPandas(_stream(window), "d long, t long, p long, mask long")
    return judged.unionByName(_by_hash(worded.join(hot, "a", "left_semi"), window))


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_spans: int = SHARD_SPANS) -> DataFrame:
    """(d, t, p, mask): of the windows from place p on, those whose bit is set start earlier elsewhere."""
    found = table(repeated_spans(docs, window, gram))
    whole = found.filter("later").select("d", "t", "p", F.expr("shiftleft(1L, n) - 1").alias("mask"))
    return whole.unionByName(_earlier_windows(docs, found.filter("not later").drop("later").distinct(), window, shard_spans))


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_spans: int = SHARD_SPANS, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``kept_text``): every text without the words of repeated windows.

    A window of ``window`` consecutive words repeats when its words also start at a
    smaller document id, or earlier in the same document; every word it covers goes.
    Windows are judged on the input. Null text has no words; null ids come last. Texts
    that share an id are ordered by their hash; rows alike in id and text are one document
    and lose the same words. Other columns are ignored.
    """
    gone = table(repeated_windows(docs, window, gram, shard_spans))
    lists = gone.groupBy("d", "t").agg(F.collect_list(F.struct("p", "mask")).alias("gone"))  # of one text
    joined = _keyed(docs).join(lists, ["d", "t"], "left").select("doc_id", "text", "gone")

    def run(batches):
        for batch in batches:
            ids, out = batch.column("doc_id"), ([], [], [], [])
            for text, hits in zip(batch.column("text"), batch.column("gone"), strict=True):
                words = (text.as_py() or "").encode().split()
                removed = 0
                kept = words
                if hits.is_valid:
                    cover = np.zeros(len(words) + 1, np.int32)
                    place = np.frombuffer(hits.values.field(0).buffers()[1], np.int64)[hits.values.offset:hits.values.offset + len(hits.values)]
                    mask = hits.values.field(1).to_numpy(zero_copy_only=False)
                    for bit in range(int(mask.max()).bit_length()):
                        at = place[(mask >> bit) & 1 == 1] + bit
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + window, -1)
                    left = np.cumsum(cover[:-1]) == 0
                    kept = [w for w, k in zip(words, left.tolist(), strict=True) if k]
                    removed = len(words) - len(kept)
                joined_words = b" ".join(kept)
                for column, value in zip(out, (len(words), removed, hashlib.sha256(joined_words).hexdigest(), joined_words.decode() if with_text else None), strict=True):
                    column.append(value)
            arrays = [ids, pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(out[3], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return joined.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "gone").mapInArrow(run, schema)
