"""Maximal periodic runs of words, found by internal pattern matching.

Every run of period q that holds four periods contains an aligned block of 2**k words, 2**k <= q < 2**(k + 1), and the
block's copy q words further on. So each aligned block of each size asks where it occurs next inside a window of
twice its own length: its occurrences are one interval of the suffix array, and a wavelet matrix over that array
answers "the first place at or after x in this interval". Occurrences of a block that are close to each other form an
arithmetic progression, whose end is found by comparing prefixes; the next question starts behind it. The distance from the
block to the first or last member of a progression, or from the end of its own progression to that of a later one, is a
candidate period; it is extended both ways and kept if the stretch is long enough.

All of it is numpy over about a megabyte of whole documents at a time; a document is never cut and nothing is shuffled.
Words are compared exactly (dictionary codes), prefixes by the ranks that prefix doubling gives them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructType

from shelfline.llm.textops import Words, words

MIN_LENGTH, MIN_PERIODS = 6, 4
NOWHERE = 1 << 62
_ROWS = 512  # documents of one outgoing batch


@dataclass
class Suffixes:
    """Suffixes of several documents, none of which continues into the next.

    ``ranks[k][i]``: the rank of the 2**k words from place i among all such (a shorter rest is unlike any other);
    after the last level no two places are alike. ``order``: the suffix array; ``heads[k]``, ``tails[k]``: for each aligned
    block of 2**k words, the interval of the suffix array that holds its occurrences.
    """

    ranks: list[np.ndarray]
    order: np.ndarray
    blocks: list[np.ndarray]
    heads: list[np.ndarray]
    tails: list[np.ndarray]


def suffixes(codes: np.ndarray, bounds: np.ndarray) -> Suffixes:
    """Prefix doubling over the words of documents bounds[d]:bounds[d + 1]; only places still alike are sorted again."""
    n = len(codes)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = bounds[1:][doc]
    first = bounds[:-1][doc]
    key = doc * (int(codes.max(initial=0)) + 1) + codes  # words of different documents are different
    order = np.argsort(key, kind="stable").astype(np.int32)
    opens = np.ones(n, bool)
    opens[1:] = key[order][1:] != key[order][:-1]
    out = Suffixes([], order, [], [], [])
    size = 1
    place = np.arange(n, dtype=np.int32)
    while True:
        starts = np.flatnonzero(opens)
        group = np.cumsum(opens) - 1
        rank = np.empty(n, np.int32)
        rank[order] = starts[group]
        length = np.diff(np.append(starts, n))
        alike = length[group] > 1  # by place in the order
        out.ranks.append(rank)
        aligned = place[((place - first) % size == 0) & (place + size <= end)]
        many = np.zeros(n, np.int32)
        many[order] = length[group]
        aligned = aligned[many[aligned] > 1]  # a block that occurs once has no candidate
        out.blocks.append(aligned)
        out.heads.append(rank[aligned])
        out.tails.append(rank[aligned] + many[aligned])
        if not alike.any():
            return out
        slots = np.flatnonzero(alike)
        who = order[slots]
        onward = who + size
        inside = onward < end[who]
        # a rest that ends here is shorter than all others alike and comes first: there is one in a document
        nxt = np.where(inside, rank[np.minimum(onward, n - 1)], -1).astype(np.int64)
        key = (rank[who].astype(np.int64) << 32) + nxt + 1
        by = np.argsort(key, kind="stable")
        order[slots] = who[by]
        key = key[by]
        opens[slots[1:]] |= key[1:] != key[:-1]
        size *= 2


class Wavelet:
    """A wavelet matrix of the suffix array: the smallest value at or above x within an interval of it."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.n = len(values)
        self.zeros: list[np.ndarray] = []  # zeros before each slot
        self.total: list[int] = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(low, out=before[1:])
            self.zeros.append(before)
            self.total.append(int(before[-1]))
            values = np.concatenate([values[low], values[~low]])

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """For each query the smallest value >= x in slots lo:hi, or NOWHERE."""
        below = np.zeros(len(lo), np.int64)
        a, b = lo.astype(np.int64), hi.astype(np.int64)
        for level in range(self.bits):
            zeros, total = self.zeros[level], self.total[level]
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            za, zb = zeros[a], zeros[b]
            below += np.where(one, zb - za, 0)
            a, b = np.where(one, total + a - za, za), np.where(one, total + b - zb, zb)
        found = below < hi - lo
        rest, a, b = np.where(found, below, 0), lo.astype(np.int64), hi.astype(np.int64)
        value = np.zeros(len(lo), np.int64)
        for level in range(self.bits):
            zeros, total = self.zeros[level], self.total[level]
            za, zb = zeros[a], zeros[b]
            one = rest >= zb - za
            rest = rest - np.where(one, zb - za, 0)
            value = value * 2 + one
            a, b = np.where(one, total + a - za, za), np.where(one, total + b - zb, zb)
        return np.where(found, value, NOWHERE)


def _alike_onward(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from i and from j on are the same (i < j)."""
    n = len(ranks[0])
    i, j, out = i.astype(np.int64), j.astype(np.int64), np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        same = j < n
        same[same] = ranks[k][i[same]] == ranks[k][j[same]]
        step = same.astype(np.int64) << k
        i, j, out = i + step, j + step, out + step
    return out


def _alike_before(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before i and before j are the same (i < j)."""
    i, j, out = i.astype(np.int64), j.astype(np.int64), np.zeros(len(i), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        same = i >= 1 << k
        same[same] = ranks[k][i[same] - (1 << k)] == ranks[k][j[same] - (1 << k)]
        step = same.astype(np.int64) << k
        i, j, out = i - step, j - step, out + step
    return out


def _candidates(known: Suffixes, tree: Wavelet, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs that the blocks of 2**k words give: period in 2**k .. 2**(k + 1) - 1."""
    size = 1 << k
    block, lo, hi = known.blocks[k].astype(np.int64), known.heads[k], known.tails[k]
    if not k:  # the only period of this size is 1: the next place
        after = tree.successor(lo, hi, block + 1)
        block = block[after == block + 1]
        return block, np.ones(len(block), np.int64)
    reach = block + 2 * size  # occurrences from here on are too far
    at, own_end = block, np.full(len(block), -1, np.int64)  # at: the occurrence looked from; own_end: where the block's own progression ends
    origin = block
    found_place, found_period = [], []
    step = np.zeros(len(block), np.int64)  # the difference of the block's own progression
    while len(at):
        after = tree.successor(lo, hi, at + 1)
        keep = after < reach
        origin, lo, hi, reach, at, own_end, step, after = (c[keep] for c in (origin, lo, hi, reach, at, own_end, step, after))
        gap = after - at
        found_place.append(origin)
        found_period.append(after - origin)
        close = gap <= size // 2
        # the words from ``at`` to ``stop`` have period ``gap``: the block's occurrences there are a progression
        stop = after.copy()
        stop[close] = after[close] + _alike_onward(known.ranks, at[close], after[close])
        end = after + np.where(close, (stop - size - after) // np.maximum(gap, 1) * gap, 0)  # the progression's last member
        found_place.append(origin)
        found_period.append(end - origin)
        first = close & (at == origin)
        own_end, step = np.where(first, stop, own_end), np.where(first, gap, step)
        later = close & ~first & (own_end >= 0)
        found_place.append(origin[later])
        found_period.append(stop[later] - own_end[later])
        at = np.where(close, np.maximum(after, stop - size), after)
    place, period = np.concatenate(found_place), np.concatenate(found_period)
    keep = (period >= size) & (period < 2 * size)
    return place[keep], period[keep]


def periodic_runs(codes: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every maximal run of the documents, by start, then period; starts count over all documents.

    ``min_periods`` is at least 4: with fewer, no block need lie far enough from both ends of its run.
    """
    if min_periods < 4:
        raise ValueError("min_periods must be 4 or more")
    empty = np.zeros(0, np.int64)
    if not len(codes):
        return empty, empty, empty
    known = suffixes(codes, bounds)
    if not any(map(len, known.blocks)):
        return empty, empty, empty
    tree = Wavelet(known.order)
    pairs = [_candidates(known, tree, k) for k in range(len(known.blocks)) if len(known.blocks[k])]
    place, period = (np.concatenate(x) for x in zip(*pairs, strict=True))
    stop = place + period + _alike_onward(known.ranks, place, place + period)
    start = place - _alike_before(known.ranks, place, place + period)
    keep = stop - start >= np.maximum(min_length, min_periods * period)
    start, stop, period = start[keep], stop[keep], period[keep]
    by = np.lexsort((period, stop, start))
    start, stop, period = start[by], stop[by], period[by]
    new = np.ones(len(start), bool)  # of the same stretch the smallest period
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[new], stop[new], period[new]
    by = np.lexsort((period, start))
    return start[by], (stop - start)[by], period[by]


def _codes(part: Words) -> np.ndarray:
    """A number for each word; equal words have equal numbers."""
    n = len(part.start)
    if not n:
        return np.zeros(0, np.int64)
    edges = np.empty(2 * n, np.int64)
    edges[0::2], edges[1::2] = part.start, part.end
    data = pa.py_buffer(np.ascontiguousarray(part.data))
    both = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * n - 1, [None, pa.py_buffer(edges), data])  # words and what lies between
    return both.dictionary_encode().indices.to_numpy(zero_copy_only=False)[0::2].astype(np.int64)


def _documents(column: pa.Array, min_length: int, min_periods: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for part in words(column):
        bounds = np.asarray(part.bounds, np.int64)
        start, length, period = periodic_runs(_codes(part), bounds, min_length, min_periods)
        yield part, start, length, period, np.searchsorted(start, bounds)


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period: word numbers from 0) and ``collapsed``.

    A run is a maximal stretch of words whose smallest period is ``period`` and which is at least ``min_length`` words
    and ``min_periods`` periods long; runs come by start, then period. ``collapsed`` is the text's words, joined by one
    space, without those that some run contains after its first period. Words are ``[^\\x20\\x09-\\x0D]+``, compared
    byte by byte.

    A null or empty text, or one without words, has no runs and an empty ``collapsed``. Repeated rows and ids are each
    treated by themselves; other columns stay, but for ones of these three names, which are replaced. An empty table
    gives an empty one. A long text is one piece of work: about 150 bytes of memory a word while it is treated.
    """
    docs = docs.drop("n_words", "runs", "collapsed")
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(first, _ROWS)
                counts, lists, texts = [], [], []
                for part, start, length, period, cuts in _documents(rows.column("text"), min_length, min_periods):
                    gone = np.zeros(len(part.start) + 1, np.int64)
                    np.add.at(gone, start + period, 1)
                    np.add.at(gone, start + length, -1)
                    kept = np.cumsum(gone)[:-1] == 0
                    counts.append(part.counts)
                    origin = np.repeat(np.asarray(part.bounds[:-1], np.int64), np.diff(cuts))
                    values = pa.StructArray.from_arrays([pa.array(start - origin), pa.array(length), pa.array(period)], fields=list(run_type))
                    lists.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values))
                    texts.append(_joined(part, kept))
                made = [pa.array(np.concatenate(counts), pa.int64()), pa.concat_arrays(lists), pa.concat_arrays(texts)]
                yield pa.RecordBatch.from_arrays([*rows.columns, *made], [*rows.schema.names, "n_words", "runs", "collapsed"])

    runs = StructType().add("start", "long").add("length", "long").add("period", "long")
    schema = StructType(list(docs.schema.fields)).add("n_words", "long").add("runs", ArrayType(runs)).add("collapsed", "string")
    return docs.mapInArrow(run, schema)


def _joined(part: Words, kept: np.ndarray) -> pa.Array:
    """Each document's kept words, joined by one space."""
    n = len(part.data)
    bounds = np.asarray(part.bounds, np.int64)
    start, end = part.start[kept].astype(np.int64), part.end[kept].astype(np.int64)
    before = np.concatenate([[0], np.cumsum(kept)])[bounds]  # kept words before each document
    spaced = np.ones(len(start), np.int64)
    spaced[before[1:][before[1:] > before[:-1]] - 1] = 0  # none behind a document's last word
    places = np.concatenate([[0], np.cumsum(end - start + spaced)])
    out = np.full(places[-1], 0x20, np.uint8)
    inside = np.zeros(n + 1, np.int8)
    inside[start] += 1
    inside[end] -= 1
    source = np.flatnonzero(np.cumsum(inside[:-1]))
    length = end - start
    out[np.repeat(places[:-1] - np.concatenate([[0], np.cumsum(length)])[:-1], length) + np.arange(len(source))] = part.data[source]
    return pa.LargeStringArray.from_buffers(len(part), pa.py_buffer(places[before]), pa.py_buffer(out)).cast(pa.string())
