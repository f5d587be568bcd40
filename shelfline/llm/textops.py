"""Vectorised word work on whole Arrow text columns, used inside Spark tasks.

Words are ``[^\\x20\\x09-\\x0D]+``. Texts are handled in slices of about a megabyte,
cut between documents, so that memory follows the slice and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2**64 for i below n."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.empty(max(n, 1 << 16), np.uint64)
        have[0] = 1
        done, step = 1, base
        while done < len(have):  # doubling: the second half is the first times base ** done
            more = min(done, len(have) - done)
            have[done:done + more] = have[:more] * np.uint64(step)
            done, step = done * 2, step * step % (1 << 64)
        _powers[base] = have
    return have[:n]


@dataclass
class Words:
    """Words of a run of documents: byte spans in ``data``, and where each document's words lie."""

    first: int  # index of the run's first document in its batch
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # document i has the words bounds[i]:bounds[i + 1]

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes (A-Z as a-z when ``lower``)."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        value = _LOWER_BYTE if lower else _BYTE
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(value[self.data] * _power_table(_BASE, n), out=sums[1:])
        inverse = _power_table(pow(_BASE, -1, 1 << 64), n)
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))

    def strings(self, i: int) -> list[bytes]:
        """Document i's words."""
        lo, hi = self.bounds[i], self.bounds[i + 1]
        raw = self.data
        return [raw[s:e].tobytes() for s, e in zip(self.start[lo:hi], self.end[lo:hi], strict=True)]


_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``most`` bytes (a longer document is a run of its own)."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = last


def words(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[Words]:
    """The words of every text of a column, run by run."""
    data, offsets = text_buffers(column)
    for first, last in slices(offsets, most):
        part = data[offsets[first]:offsets[last]]
        marks = offsets[first:last + 1] - offsets[first]
        inside = ~_SPACE[part]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        edge = marks[(marks > 0) & (marks < len(part))]
        opens[edge] = inside[edge]
        closes[edge - 1] = inside[edge - 1]
        start = np.flatnonzero(opens)
        yield Words(first, part, start, np.flatnonzero(closes) + 1, np.searchsorted(start, marks))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n consecutive hashes from each place on (only full runs): len(h) - n + 1 values."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, done, block, size = None, 0, h, 1
    rest = n
    while True:  # binary decomposition of n over blocks of doubled length
        if rest & 1:
            piece = block * np.uint64(pow(_WORD_BASE, done, 1 << 64))
            out = piece if out is None else out[:len(piece) - done] + piece[done:] if done else out
            done += size
        rest >>= 1
        if not rest:
            break
        block = block[:-size] + block[size:] * np.uint64(pow(_WORD_BASE, size, 1 << 64))
        size *= 2
    return mix(out[:len(h) - n + 1])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a signed long, which is what Spark can hold."""
    return x.view(np.int64)
