"""Byte-level BPE by dynamic programming over prefixes.

A byte string has one BPE encoding, and so has each of its prefixes; the encoding of a prefix
ends in one token. Written down for every prefix, those last tokens hold everything:

* the token that ends at byte i starts at byte j, and the rest of the encoding is that of the prefix j;
* a token may stand after the last token of prefix j exactly when no merge would have crossed their border,
  which :meth:`Vocabulary.fits` decides from the two tokens alone;
* bytes can be appended, because no earlier entry changes, and an edit changes entries only up to
  the place where as many entries as the longest token has bytes agree with those before the edit.

A text is cut by the tokenizer's pattern first; every cut piece is a byte string of its own. A piece that is
itself a token is that token, merges or not. Nothing is shuffled: documents are encoded where they are read.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfline.llm.scratch import free

TOKENIZER = "byte_bpe_multi_50k"
CACHE = 700_000  # pieces a Python worker remembers
LONG = 64  # letters; longer pieces are not remembered
_ROWS = 512  # documents of one outgoing batch
_loaded: dict[tuple[str, str | None], "Vocabulary"] = {}


class Vocabulary:
    """Ranks of a byte-level BPE, the merge that makes each token, and the pieces met so far."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.halves: dict[int, tuple[int, int] | None] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                self.halves[rank] = None
            elif (parts := self._merged(token, rank)) is not None:
                self.halves[rank] = parts
        self.made = {self.bytes_of[rank]: rank for rank in self.halves}  # tokens that merges can make
        self.longest = max(map(len, self.made), default=1)
        self.endings: list = [-1, {}]  # the tokens by their bytes from the last on: [token or -1, {byte before: node}]
        for token, rank in self.made.items():
            node = self.endings
            for byte in reversed(token):
                node = node[1].setdefault(byte, [-1, {}])
            node[0] = rank
        self.sizes = [len(token) for token in self.bytes_of]
        self._fits: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}

    def _merged(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None where lower merges leave more than two."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            found = [(self.ranks.get(parts[i] + parts[i + 1], rank), i) for i in range(len(parts) - 1)]
            lowest, i = min(found)
            if lowest >= rank:
                return None
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        a, b = (self.ranks.get(part) for part in parts)
        return None if a is None or b is None else (a, b)

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens can be neighbours in an encoding.

        The merges that made them are undone from the latest (the highest rank; of two equal ones the right
        one). What then stands at the border stood there until that merge: had the two sides of the
        border been a merge of a lower rank, or of the same rank and further left, it would have come first.
        """
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= 4 * CACHE:
                self._fits.clear()
            known = self._fits[key] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        none = len(self.bytes_of)
        before = none  # merges below this rank have happened when the border is looked at
        while True:
            if self.ranks.get(self.bytes_of[left] + self.bytes_of[right], none) < before:
                return False
            a, b = self.halves[left], self.halves[right]
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                before, left = left, a[1]
            else:
                before, right = right + 1, b[0]

    def prefixes(self, data: bytes) -> "Prefixes":
        return Prefixes(self, data)

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Each text's ids. Pieces not met before are taken in order, so that each goes on from the prefix it shares with the last."""
        cut, known = [self.pattern.findall(text) for text in texts], self._known
        new = {piece for pieces in cut for piece in pieces if piece not in known}
        if len(known) + len(new) > CACHE:
            known.clear()
            new = {piece for pieces in cut for piece in pieces}
        table = self.prefixes(b"")
        for raw in sorted(piece.encode() for piece in new):
            whole = self.ranks.get(raw)
            if whole is None:
                table.become(raw)
                tokens = table.tokens()
            else:
                tokens = [whole]
            known[raw.decode()] = struct.pack(f"<{len(tokens)}I", *tokens)
        out = [b"".join([known[piece] for piece in pieces]) for pieces in cut]
        for piece in [piece for piece in new if len(piece) > LONG]:
            del known[piece]
        return out

    def decode_all(self, ids: list[bytes]) -> list[bytes]:
        return [self.decode(x) for x in ids]

    def decode(self, ids: bytes) -> bytes:
        """The bytes of little-endian unsigned 32-bit ids; an id the vocabulary lacks is an error."""
        names = self.bytes_of
        return b"".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()])


class Prefixes:
    """The last token of every prefix of one byte string (``last[i]``: of its first i + 1 bytes)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, bytearray(), []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self._extend(len(self.data))

    def become(self, data: bytes) -> None:
        """The table of ``data``; entries of the prefix that it shares with the bytes so far stand."""
        same = 0
        for x, y in zip(self.data, data, strict=False):
            if x != y:
                break
            same += 1
        del self.last[same:]
        self.data = bytearray(data)
        self._extend(len(data))

    def _extend(self, stop: int, settled=None) -> None:
        """Entries up to ``stop``; ends early where ``settled(i)`` says that the rest is known."""
        fits, known, endings = self.vocabulary.fits, self.vocabulary._fits.get, self.vocabulary.endings
        data, last = bytes(self.data), self.last
        for i in range(len(last), stop):
            node, j = endings, i
            while True:  # the tokens that end with byte i, each longer than the one before
                node = node[1].get(data[j])
                if node is None:
                    raise ValueError("the vocabulary lacks single bytes")
                token = node[0]
                if token >= 0:
                    if not j:
                        break
                    fit = known(last[j - 1] << 32 | token)
                    if fit or (fit is None and fits(last[j - 1], token)):
                        break
                elif not j:
                    raise ValueError("the vocabulary lacks single bytes")
                j -= 1
            last.append(token)
            if settled is not None and settled(i + 1):
                return

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Bytes start:stop become ``new``. Returns how many entries had to be worked out again.

        Entries before ``start`` stand. Behind the new bytes an entry depends on the bytes and on at most
        ``longest`` entries before it, so once that many agree with the old ones, all the others do.
        """
        old, behind = self.last, len(self.data) - stop
        self.data[start:stop] = new
        self.last = old[:start]
        shift, first = start + len(new) - stop, start + len(new)
        agreed = 0

        def settled(i: int) -> bool:
            nonlocal agreed
            if i <= first:
                return False
            agreed = agreed + 1 if self.last[i - 1] == old[i - 1 - shift] else 0
            return agreed >= self.vocabulary.longest

        self._extend(first + behind, settled)
        worked = len(self.last) - start
        self.last += old[len(self.last) - shift:]
        return worked

    def tokens(self) -> list[int]:
        out, at, last, sizes = [], len(self.last), self.last, self.vocabulary.sizes
        while at:
            token = last[at - 1]
            out.append(token)
            at -= sizes[token]
        return out[::-1]


def vocabulary(name: str = TOKENIZER, folder: str | None = None) -> Vocabulary:
    """The ranks of ``name``.tiktoken, from ``folder`` or the public package; read once a worker."""
    if (name, folder) not in _loaded:
        import public_tokenizers

        path = f"{folder}/{name}.tiktoken" if folder else public_tokenizers.path(f"{name}.tiktoken")
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _loaded[name, folder] = Vocabulary(ranks, public_tokenizers.PATTERN)
    return _loaded[name, folder]


_SPACE = regex.compile(r"(?<=\S)(?=\s)")


def reencode(words: Vocabulary, text: str, ids: bytes, start: int, stop: int, new: str) -> tuple[str, bytes]:
    """(text, ids) after characters start:stop became ``new``; ids outside the edit's surroundings are taken over.

    Wherever white space follows something else the pattern cuts, whatever stands further off. The text between the
    last such place before the edit and the first behind it is encoded anew: a piece that begins and ends
    where one did before by its prefixes, of which those before the edit stand.
    """
    after = text[:start] + new + text[stop:]
    left = 0
    for cut in _SPACE.finditer(text, max(0, start - 4096), start):
        left = cut.start() if cut.start() < start else left
    if not left and start > 4096:
        left = max((cut.start() for cut in _SPACE.finditer(text, 0, start) if cut.start() < start), default=0)
    behind = next((cut.start() for cut in _SPACE.finditer(text, stop) if cut.start() > stop), len(text))
    ends = np.cumsum([len(words.bytes_of[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)
    a = int(np.searchsorted(ends, len(text[:left].encode()), "right"))
    b = int(np.searchsorted(ends, len(text[:behind].encode()), "right"))
    before, middle = text[left:behind], text[left:start] + new + text[stop:behind]
    one = words.pattern.findall(before)
    if len(one) == 1 and words.pattern.findall(middle) == [middle] and (raw := middle.encode()) not in words.ranks:
        table = words.prefixes(before.encode())
        table.replace(len(text[left:start].encode()), len(text[left:stop].encode()), new.encode())
        assert table.data == raw
        inner = np.array(table.tokens(), "<u4").tobytes()
    else:
        inner = words.encode(middle)
    return after, ids[:4 * a] + inner + ids[4 * b:]


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit ids) and ``n_tokens``.

    A null text counts as empty: no ids, 0 tokens. Repeated rows and ids stay; every other column is kept
    as it is, but for one called ``ids`` or ``n_tokens``, which is replaced. Texts are never cut; a piece longer
    than 64 letters is worked out each time it occurs. An empty table gives an empty one.
    """
    return _mapped(docs, "text", "ids", lambda: vocabulary(tokenizer, folder).encode_all, "").withColumn("n_tokens", F.expr("cast(octet_length(ids) div 4 as long)"))


def decode(encoded: DataFrame, tokenizer: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``; null ids count as none. A column ``decoded`` is replaced."""
    return _mapped(encoded, "ids", "decoded", lambda: vocabulary(tokenizer, folder).decode_all, b"")


def edit(encoded: DataFrame, start: str, stop: str, new: str, tokenizer: str = TOKENIZER, folder: str | None = None) -> DataFrame:
    """``encoded`` after characters start:stop of each text became ``new`` (names of columns): new ``text``, ``ids``, ``n_tokens``.

    An append is an edit at the text's length. Places outside the text mean its ends; a null place or a null ``new``
    leaves the row as it is; null texts count as empty. Only the edit's surroundings are encoded.
    """
    out, = free(encoded, "edited")

    def run(batches):
        words = vocabulary(tokenizer, folder)
        for batch in batches:
            texts, olds = [], []
            for text, ids, a, b, put in zip(*[batch.column(c).to_pylist() for c in ("text", "ids", start, stop, new)], strict=True):
                text, ids = text or "", ids or b""
                if None not in (a, b, put):
                    a = min(max(a, 0), len(text))
                    text, ids = reencode(words, text, ids, a, min(max(b, a), len(text)), put)
                texts.append(text)
                olds.append(ids)
            edited = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(olds, pa.binary())], ["text", "ids"])
            yield pa.RecordBatch.from_arrays([*batch.columns, edited], [*batch.schema.names, out])

    moved = encoded.mapInArrow(run, _with(encoded, out, StructType().add("text", "string").add("ids", "binary"))).withColumn("text", F.col(out)["text"]).withColumn("ids", F.col(out)["ids"]).drop(out)
    return moved.withColumn("n_tokens", F.expr("cast(octet_length(ids) div 4 as long)"))


def _mapped(df: DataFrame, source: str, target: str, load, missing) -> DataFrame:
    """``df`` with ``target``: the loaded function of the values of ``source``, some hundred rows at a time."""
    df = df.drop(target)

    def run(batches):
        function = load()
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                part = batch.slice(first, _ROWS)
                made = pa.array(function([missing if x is None else x for x in part.column(source).to_pylist()]), pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, target])

    return df.mapInArrow(run, _with(df, target, "binary"))


def _with(df: DataFrame, name: str, kind: str | StructType) -> StructType:
    return StructType(list(df.schema.fields)).add(name, kind)
