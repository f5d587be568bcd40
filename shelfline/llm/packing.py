"""Best-fit packing by sum of squares: tokenised documents into sequences of fixed capacity.

Texts are tokenised in their scan and leave it as (document, piece, length, checksum);
only those narrow rows are dealt out, by hash, into packing groups of a set number of
tokens. Inside a group every piece goes where the sum of squared counts of open
sequences per residual gap becomes smallest.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.scratch import table

CAPACITY, END_ID = 2048, 0
GROUP_TOKENS = 30_000_000  # a packing group: about 15,000 full sequences, a few MB in its task
TOKENIZER = "byte_bpe_50k"
_loaded: dict[str, object] = {}


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str):
    """text -> ids as little-endian uint32 bytes, equal to the ``tokenizers`` file ``name``.json without special tokens.

    A text is encoded whole: most of a corpus's different words occur once, so looking words up costs more than it saves.
    """
    if name in _loaded:
        return _loaded[name]
    import public_tokenizers
    import tiktoken

    with open(_public(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})

    def encode(text: str) -> bytes:
        return bpe.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()

    _loaded[name] = encode
    return encode


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ``ids``): a document's ids and the end id, cut into full pieces.

    Only a document above ``capacity`` is cut; its first piece takes what full pieces
    leave over. Null and empty texts are the end id alone. Repeated rows stay repeated.
    """

    def run(batches):
        encode = encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                out: list[list] = [[], [], [], [], [], []]
                ids_of = batch.column("doc_id")[first:first + 256].to_pylist()
                for doc, text in zip(ids_of, batch.column("text")[first:first + 256].to_pylist(), strict=True):
                    ids = (encode(text) if text else b"") + end
                    n = len(ids) // 4
                    at, k = 0, 0
                    size = (n - 1) % capacity + 1
                    while at < n:
                        piece = ids[4 * at:4 * (at + size)]
                        for column, value in zip(out, (doc, k, at, size, zlib.crc32(piece), piece), strict=True):
                            column.append(value)
                        at, k, size = at + size, k + 1, capacity
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32).tolist() for x in out[5]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece, longest first.

    ``count[g]`` is the number of open sequences with gap g. Putting a piece of length s
    into gap g changes the sum of squared counts by 2 (count[g - s] - count[g] + 1), or
    2 count[capacity - s] + 1 for a new sequence (full sequences count for nothing); the
    least change wins, the smallest gap among equals. Taking the longest first leaves the
    short pieces to fill the gaps.
    """
    order = np.argsort(-lengths, kind="stable")
    count = np.zeros(capacity + 1, np.int64)
    opened: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i in order.tolist():
        s = int(lengths[i])
        gaps = np.flatnonzero(count[s:])
        if len(gaps):
            # gap 0 is a full sequence, which does not count: filling one up removes its gap alone
            after = count[gaps]
            after[gaps == 0] = 0
            change = np.where(gaps == 0, 1 - 2 * count[gaps + s], 2 * (after - count[gaps + s] + 1))
            g = int(gaps[change.argmin()]) + s
            bin_ = opened[g].pop()
            count[g] -= 1
        else:
            bin_, g = made, capacity
            made += 1
        sequence[i], offset[i] = bin_, capacity - g
        if g > s:
            count[g - s] += 1
            opened[g - s].append(bin_)
    return sequence, offset


def pack(cut: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``cut`` with sequence_id and offset. Groups follow the total of tokens, so a task's rows stay bounded.

    Each group wastes part of a few sequences; nothing else is lost against one big group.
    """
    cut = table(cut)
    total = cut.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    groups = max(1, -(-total // group_tokens))
    salt = F.monotonically_increasing_id()  # of a written table; rows that are alike spread over the groups too
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", salt), F.lit(groups)).cast("long"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        sequence, offset = sum_of_squares(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=rows["_group"].to_numpy() * (1 << 32) + sequence, offset=offset).drop(columns="_group")

    fields = [f for f in dealt.schema.fields if f.name != "_group"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"
    return dealt.groupBy("_group").applyInPandas(run, schema)
