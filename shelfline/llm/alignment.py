"""Aligning two tokenizers' tokens of the same texts, and counting which tokens meet.

Both token sequences of a text end at byte offsets. Where a token of each ends at the same byte, the text can be cut for
both: :func:`shared_groups` locates the cuts around the token in the middle of an interval by bisecting the other
sequence's ends, makes what lies between them a group and goes on with both halves. All open intervals of some hundred
documents take each step together.

How many documents link two ids is known only when all are read, and asked again by each of their links. The links are
therefore written once, compressed, in blocks of documents; a block asks for each of its distinct pairs once,
and gets the answers as a table of its own. No table of pairs is broadcast, and no link is shuffled on its own.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from shelfline.llm.scratch import table

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
CACHE = 250_000  # chunks between spaces that a Python worker remembers
LONG = 64  # letters; longer chunks are not remembered
CHUNK_BYTES = 1 << 18  # text whose tokens are aligned together
BLOCK_LINKS = 8_000_000  # links after which a block of documents is full
ROW_PAIRS = 1 << 17  # pairs of a block in one row
_ODD = re.compile("\\s | $|▁")
_loaded: dict[tuple, "Tokenizers"] = {}


class Tokenizers:
    """Both encodings of a text whose tokens, joined, are its bytes after a space.

    The ids, letters and order of merges of the first one are those of its file; its merges are applied by ``tiktoken``,
    which takes them as ranks, some six times as fast as the library that the file is written for, with equal ids.
    """

    def __init__(self, first: str, second: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(first, encoding="utf-8") as file:
            described = json.load(file)
        letters, special = _byte_letters(), {x["content"] for x in described.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special}
        self.first = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.first_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.first_bytes[i] = token
        self.second_bytes = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.first_sizes, self.second_sizes = (np.array(list(map(len, x)), np.int32) for x in (self.first_bytes, self.second_bytes))
        self.separable = not any(re.search("[^▁]▁", p) for p in pieces)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.first_digits, self.second_digits = _digits(len(self.first_bytes)), _digits(len(pieces))

    def whole(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """(ids, ids) of each text as little-endian int32; None where the joined tokens are not a space and the text."""
        out: list[tuple[bytes, bytes] | None] = []
        for text, b in zip(texts, self.second.encode(texts, num_threads=1), strict=True):
            if text and b"".join([self.second_bytes[i] for i in b]) == b" " + text.encode():
                a = self.first.encode_ordinary(f" {text}")
                out.append((struct.pack(f"<{len(a)}i", *a), struct.pack(f"<{len(b)}i", *b)))
            else:
                out.append(None)
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """As :meth:`whole`, by way of the chunks between single spaces, which recur.

        Both tokenizers begin a token at a space behind something that is no white space: the pattern of the first cuts
        there, and no piece of the second goes on there. A text with other white space before a space, a space
        at an end, or the second tokenizer's own sign for a space is encoded whole.
        """
        chunks = [None if not t or not self.separable or t[0] == " " or _ODD.search(t) else t.split(" ") for t in texts]
        known = self.known
        new = {c for own in chunks if own for c in own if c not in known}
        if len(known) + len(new) > CACHE:
            known.clear()
            new = {c for own in chunks if own for c in own}
        new = list(new)
        known.update(zip(new, self.whole(new), strict=True))
        odd = [t for t, own in zip(texts, chunks, strict=True) if own is None and t]
        of_odd = iter(self.whole(odd))
        out: list[tuple[bytes, bytes] | None] = []
        for text, own in zip(texts, chunks, strict=True):
            if own is None:
                out.append(next(of_odd) if text else None)
                continue
            both = [known[c] for c in own]
            out.append(None if None in both else (b"".join([x for x, _ in both]), b"".join([x for _, x in both])))
        for c in [c for c in new if len(c) > LONG]:
            del known[c]
        return out


def tokenizers(first: str, second: str, folder: str | None) -> Tokenizers:
    if (first, second, folder) not in _loaded:
        import public_tokenizers

        _loaded[first, second, folder] = Tokenizers(*(f"{folder}/{x}" if folder else public_tokenizers.path(x) for x in (first, second)))
    return _loaded[first, second, folder]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else the next from U+0100 on."""
    prints = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _digits(n: int) -> np.ndarray:
    """Row i: the decimal digits of i, zero bytes behind them, and one free byte."""
    width = len(str(max(n - 1, 0)))
    text = np.array([str(i) for i in range(n)], f"S{width}")
    return np.concatenate([text.view(np.uint8).reshape(n, width), np.zeros((n, 1), np.uint8)], axis=1)


def shared_groups(a: np.ndarray, b: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where both sequences are cut: tokens before each cut, in ``a`` and in ``b``, from (0, 0) to the ends.

    ``a``, ``b``: byte offsets of tokens' ends, increasing, 0 first; ``first``: numbers of ``a`` tokens before each document
    and before the end, where both sequences end a token. An interval is cut around the token in its middle: from that
    token's end on, each sequence's next end is bisected for in the other one in turn until they agree, and
    likewise from its start back. What lies between is cutless, a leaf; the intervals on both sides go on.
    """
    lo, hi = first[:-1], first[1:]
    keep = hi > lo
    lo, hi = lo[keep], hi[keep]
    cuts_a, cuts_b = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    while len(lo):
        middle = (lo + hi) // 2
        right_a, right_b = _agree(a, b, middle + 1, True)
        left_a, _ = _agree(a, b, middle, False)  # also the right cut of another leaf, or where its interval begins
        cuts_a.append(right_a)
        cuts_b.append(right_b)
        lo, hi = np.stack([lo, right_a], axis=1).ravel(), np.stack([left_a, hi], axis=1).ravel()
        keep = hi > lo
        lo, hi = lo[keep], hi[keep]
    cut_a, cut_b = np.concatenate(cuts_a), np.concatenate(cuts_b)
    by = np.argsort(cut_a)
    return cut_a[by], cut_b[by]


def _agree(a: np.ndarray, b: np.ndarray, at: np.ndarray, onward: bool) -> tuple[np.ndarray, np.ndarray]:
    """The nearest common offset from ``a[at]`` on (or back), as places in ``a`` and ``b``."""
    side, shift = ("left", 0) if onward else ("right", -1)
    in_a = at.copy()
    in_b = np.searchsorted(b, a[at], side) + shift
    open_ = np.flatnonzero(b[in_b] != a[in_a])
    while len(open_):
        in_a[open_] = np.searchsorted(a, b[in_b[open_]], side) + shift
        open_ = open_[b[in_b[open_]] != a[in_a[open_]]]
        in_b[open_] = np.searchsorted(b, a[in_a[open_]], side) + shift
        open_ = open_[b[in_b[open_]] != a[in_a[open_]]]
    return in_a, in_b


def links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token of a, token of b) of every pair whose byte ranges overlap: one for each stretch that no end of either cuts."""
    ends = np.concatenate([a[1:], b[1:]])
    by = np.argsort(ends, kind="stable")
    of_a = by < len(a) - 1
    ends = ends[by]
    new = np.ones(len(ends), bool)
    new[1:] = ends[1:] != ends[:-1]
    before_a = np.cumsum(of_a) - of_a
    return before_a[new], (np.arange(len(ends)) - before_a)[new]


class Aligned:
    """Groups and links of a run of documents."""

    def __init__(self, both: list[tuple[bytes, bytes] | None], known: Tokenizers):
        firsts = [x[0] if x else b"" for x in both]
        seconds = [x[1] if x else b"" for x in both]
        self.known = known
        self.a = np.frombuffer(b"".join(firsts), "<i4")
        self.b = np.frombuffer(b"".join(seconds), "<i4")
        self.bounds_a = np.concatenate([[0], np.cumsum([len(x) // 4 for x in firsts], dtype=np.int64)])
        self.bounds_b = np.concatenate([[0], np.cumsum([len(x) // 4 for x in seconds], dtype=np.int64)])
        ends_a, ends_b = (np.concatenate([[0], np.cumsum(size[ids])]).astype(np.int32) for size, ids in ((known.first_sizes, self.a), (known.second_sizes, self.b)))
        self.cuts_a, self.cuts_b = shared_groups(ends_a, ends_b, self.bounds_a)
        self.groups = np.searchsorted(self.cuts_a, self.bounds_a)  # groups before each document
        link_a, link_b = links(ends_a, ends_b)
        self.pairs = self.a[link_a].astype(np.int64) * len(known.second_bytes) + self.b[link_b]
        self.links = np.searchsorted(link_a, self.bounds_a)  # links before each document

    def written(self) -> tuple[bytes, np.ndarray]:
        """The groups of all documents as ``a1,a2|b1;a3|b2,b3`` each, and where each document's text begins."""
        cuts_a, cuts_b = self.cuts_a, self.cuts_b
        size_a, size_b = np.diff(cuts_a), np.diff(cuts_b)
        width = max(self.known.first_digits.shape[1], self.known.second_digits.shape[1])
        rows = np.zeros((len(self.a) + len(self.b), width), np.uint8)
        place_a = np.arange(len(self.a)) + np.repeat(cuts_b[:-1], size_a)
        place_b = np.arange(len(self.b)) + np.repeat(cuts_a[1:], size_b)
        digits_a, digits_b = self.known.first_digits[self.a], self.known.second_digits[self.b]
        digits_a[:, -1] = digits_b[:, -1] = ord(",")
        digits_a[cuts_a[1:] - 1, -1] = ord("|")
        digits_b[cuts_b[1:] - 1, -1] = ord(";")
        ends = self.bounds_b[1:][self.bounds_b[1:] > self.bounds_b[:-1]]
        digits_b[ends - 1, -1] = 0
        rows[place_a, :digits_a.shape[1] - 1], rows[place_a, -1] = digits_a[:, :-1], digits_a[:, -1]
        rows[place_b, :digits_b.shape[1] - 1], rows[place_b, -1] = digits_b[:, :-1], digits_b[:, -1]
        flat = rows.ravel()
        there = flat != 0
        before = np.concatenate([[0], np.cumsum((digits_a != 0) @ np.ones(digits_a.shape[1], np.int64))])[self.bounds_a]
        before += np.concatenate([[0], np.cumsum((digits_b != 0) @ np.ones(digits_b.shape[1], np.int64))])[self.bounds_b]
        return flat[there].tobytes(), before

    def pairs_of_documents(self) -> np.ndarray:
        """Every pair once for each document that holds it linked."""
        doc = np.repeat(np.arange(len(self.links) - 1), np.diff(self.links))
        top = len(self.known.first_bytes) * len(self.known.second_bytes)
        both = np.sort(doc * top + self.pairs)
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        return both[new] % top


def _runs(texts: pa.Array) -> Iterator[tuple[int, int]]:
    first, size = 0, 0
    for i, own in enumerate(pc.binary_length(texts).to_pylist()):
        size += own or 0
        if size >= CHUNK_BYTES or i == len(texts) - 1:
            yield first, i + 1
            first, size = i + 1, 0


class _Counts:
    """Documents of each pair. What came since is merged once it is as much as what is merged, so a pair is sorted a few times."""

    def __init__(self):
        self.pairs, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, pairs: np.ndarray, n: np.ndarray) -> None:
        self.new.append((pairs, n))
        self.waiting += len(pairs)
        if self.waiting >= max(len(self.pairs), ROW_PAIRS):
            self.merge()

    def merge(self) -> None:
        pairs, n = (np.concatenate(x) for x in zip((self.pairs, self.n), *self.new, strict=True))
        by = np.argsort(pairs, kind="stable")
        pairs, n = pairs[by], n[by]
        heads = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        self.pairs, self.n = pairs[heads], np.add.reduceat(n, heads) if len(heads) else n
        self.new, self.waiting = [], 0

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.merge()
        for i in range(0, len(self.pairs), ROW_PAIRS):
            yield self.pairs[i:i + ROW_PAIRS], self.n[i:i + ROW_PAIRS]


_DOC = StructType().add("doc_id", "long").add("n_a", "long").add("n_b", "long").add("n_groups", "long").add("n_links", "long").add("groups_sha256", "string").add("groups", "string")
_DOC_ARROW = pa.struct([("doc_id", pa.int64()), *[(x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links")], ("groups_sha256", pa.string()), ("groups", pa.string())])


def _written_blocks(docs: DataFrame, first: str, second: str, folder: str | None, with_groups: bool) -> DataFrame:
    """Rows of two kinds: some documents of a block with their links, compressed; a block's pairs with their documents' number."""

    def run(batches):
        known = tokenizers(first, second, folder)
        pack = zstandard.ZstdCompressor(level=3)
        base, block, held = TaskContext.get().partitionId() << 32, 0, 0
        counted = _Counts()

        def row(rows: list[dict], links_: bytes | None, pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([base + block], pa.int64()), pa.array([rows], pa.list_(_DOC_ARROW)), pa.array([links_], pa.binary()),
                 pa.array([pairs], pa.list_(pa.int64())), pa.array([n], pa.list_(pa.int64()))], ["block", "docs", "links", "pairs", "n"])

        none = np.zeros(0, np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for lo, hi in _runs(batch.column("text")):
                part = Aligned(known.encode([t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()]), known)
                raw, places = part.written()
                rows = []
                for k, i in enumerate(range(lo, hi)):
                    own = raw[places[k]:places[k + 1]]
                    rows.append({
                        "doc_id": ids[i], "n_a": int(part.bounds_a[k + 1] - part.bounds_a[k]), "n_b": int(part.bounds_b[k + 1] - part.bounds_b[k]),
                        "n_groups": int(part.groups[k + 1] - part.groups[k]), "n_links": int(part.links[k + 1] - part.links[k]),
                        "groups_sha256": hashlib.sha256(own).hexdigest() if own else "", "groups": own.decode() if with_groups else None})
                yield row(rows, pack.compress(part.pairs.astype(np.uint32 if len(known.first_bytes) * len(known.second_bytes) < 1 << 32 else np.uint64).tobytes()), none, none)
                counted.add(*np.unique(part.pairs_of_documents(), return_counts=True))
                held += len(part.pairs)
                if held >= BLOCK_LINKS:
                    for some in counted.rows():
                        yield row([], None, *some)
                    block, held, counted = block + 1, 0, _Counts()
        for some in counted.rows():
            yield row([], None, *some)

    schema = StructType().add("block", "long").add("docs", ArrayType(_DOC)).add("links", "binary").add("pairs", ArrayType(LongType())).add("n", ArrayType(LongType()))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def align(docs: DataFrame, first: str = FIRST, second: str = SECOND, folder: str | None = None, with_groups: bool = True) -> DataFrame:
    """One row per document: how its tokens by two tokenizers line up, and how usual its links are in all documents.

    doc_id; n_a, n_b: tokens of a space and the text by the byte-level ``first`` and of the text by the sentence-piece
    ``second``, no special tokens; n_groups: the groups that common byte ends cut them into; ``groups``: their ids as
    ``a1,a2|b1;a3|b2,b3`` (null unless ``with_groups``) and groups_sha256; n_links: pairs of token occurrences whose bytes
    overlap; count_sum: over the links, how many documents hold the two ids linked; n_best: links for which
    that number is the highest that their first id reaches anywhere, ties included.

    A text that is null, empty, or whose tokens do not join to a space and the text has no tokens: zeros, and ''. Repeated
    rows count as documents each; repeated and null ids stay. Whole texts, however long: a document's tokens,
    some 60 bytes a character, are in one task. Other columns are left out. An empty table gives an empty one.
    """
    written = table(_written_blocks(docs, first, second, folder, with_groups))
    size = len(tokenizers(first, second, folder).second_bytes)
    held = written.filter("docs is not null and size(pairs) > 0").select("block", F.inline(F.arrays_zip("pairs", "n"))).withColumnRenamed("pairs", "pair")
    counted = table(held.groupBy("pair").agg(F.sum("n").alias("n")))
    most = counted.groupBy((F.expr(f"pair div {size}")).alias("id")).agg(F.max("n").alias("most"))
    judged = counted.withColumn("id", F.expr(f"pair div {size}")).join(most, "id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = held.select(F.col("block").alias("asker"), "pair").join(judged, "pair")
    chunks = written.filter("links is not null").select("block", "docs", "links")
    wide = np.uint32 if size * len(tokenizers(first, second, folder).first_bytes) < 1 << 32 else np.uint64

    def finish(chunk: pa.Table, answer: pa.Table) -> pa.Table:
        pairs = answer.column("pair").to_numpy()
        by = np.argsort(pairs)
        pairs = pairs[by].astype(wide)
        n, best = answer.column("n").to_numpy()[by], answer.column("best").to_numpy()[by]
        out = []
        for own, raw in zip(chunk.column("docs").combine_chunks(), chunk.column("links").to_pylist(), strict=True):
            own = own.values
            places = np.concatenate([[0], np.cumsum(own.field("n_links").to_numpy())])
            at = np.searchsorted(pairs, np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), wide))
            sums = [np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)])[places] if len(at) else places * 0 for x in (best, n)]
            out.append(pa.Table.from_arrays([own.field(f.name) for f in _DOC_ARROW] + [pa.array(np.diff(x)) for x in sums], [f.name for f in _DOC_ARROW] + ["n_best", "count_sum"]))
        return pa.concat_tables(out) if out else pa.table({f.name: pa.array([], f.type) for f in _DOC_ARROW} | {"n_best": pa.array([], pa.int64()), "count_sum": pa.array([], pa.int64())})

    schema = StructType(list(_DOC.fields)).add("n_best", "long").add("count_sum", "long")
    return chunks.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(finish, schema)
