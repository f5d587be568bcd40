"""Prefix encoding against the public library, exact round trips, and edits against encoding anew."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from shelfline.llm import bpe, queries
from tests.conftest import SF_SMALL

ALPHABET = [chr(c) for c in range(0x80)] + list("\x85\xa0  　᠎​١Ⅴ中日😀̀éяbกᄀ가")


@pytest.fixture(scope="module")
def words():
    return bpe.vocabulary()


@pytest.fixture(scope="module")
def reference(words):
    import public_tokenizers

    return tiktoken.Encoding("reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.ranks, special_tokens={})


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_random_texts_equal_the_library(words, reference):
    rnd = random.Random(3)
    for _ in range(4000):
        letters = ALPHABET if rnd.random() < 0.5 else "abcdefghet  "
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(rnd.choice([4, 40, 300]))))
        assert ids_of(words.encode(text)) == reference.encode_ordinary(text), text
        assert words.decode(words.encode(text)) == text.encode()


def test_one_endless_piece(words, reference):
    text = "".join(random.Random(5).choice("abcdefgh") for _ in range(30_000))
    assert ids_of(words.encode(text)) == reference.encode_ordinary(text)


def test_small_vocabulary_with_a_token_no_merge_makes():
    """Lowest rank first, leftmost of equals; a piece that is a token is that token."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"aa": 258, b"abc": 259, b"xyz": 260}
    words = bpe.Vocabulary(ranks, r"\w+|\W+")
    assert ids_of(words.encode("aaa")) == [258, 97] and ids_of(words.encode("abc")) == [259] and ids_of(words.encode("aabc")) == [97, 259]
    assert ids_of(words.encode("xyz")) == [260] and ids_of(words.encode("xyzx")) == [120, 121, 122, 120]


def test_every_prefix_holds_its_encoding(words, reference):
    raw = b"thstthounexpectedlyly"
    table = words.prefixes(b"")
    for i in range(len(raw)):
        table.append(raw[i:i + 1])
        assert table.tokens() == words.prefixes(raw[:i + 1]).tokens()
        whole = words.ranks.get(raw[:i + 1])
        assert reference._encode_single_piece(raw[:i + 1]) == ([whole] if whole is not None else table.tokens())


def test_edits_near_and_far(words):
    rnd = random.Random(7)
    for _ in range(1500):
        text = "".join(rnd.choice("abe  \n.1é") for _ in range(rnd.randrange(60)))
        start = rnd.randrange(len(text) + 1)
        stop = rnd.randrange(start, len(text) + 1)
        new = "".join(rnd.choice("abe  \n.") for _ in range(rnd.randrange(6)))
        after, ids = bpe.reencode(words, text, words.encode(text), start, stop, new)
        assert after == text[:start] + new + text[stop:] and ids == words.encode(after), (text, start, stop, new)
    raw = bytes(rnd.choice(b"abcdefgh") for _ in range(20_000))
    table = words.prefixes(raw)
    assert table.replace(9_000, 9_004, b"hhaa!") < 400  # the rest of the entries stands
    assert table.data == raw[:9_000] + b"hhaa!" + raw[9_004:] and table.tokens() == words.prefixes(bytes(table.data)).tokens()


def test_documents(spark, words, reference):
    odd = [(None, None), (1, None), (2, ""), (2, ""), (3, " \n\t "), (4, "<|endoftext|> x"), (5, "word " * 40_000), (5, "another text of that id")]
    docs = spark.createDataFrame(odd, "doc_id long, text string").withColumn("ids", F.lit(7)).withColumn("decoded", F.lit("x")).withColumn("N_Tokens", F.lit("y"))
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in rows) == sorted((i is None, i or 0, t or "") for i, t in odd)
    for r in rows:
        assert ids_of(r["ids"]) == reference.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"]) // 4
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_edited_documents(spark, words):
    texts = ["one two three", "", None, "aaaa", "left alone"]
    places = [(4, 7, "2"), (0, 0, "new "), (0, 5, "x"), (-3, 99, None), (None, 1, "x")]
    docs = spark.createDataFrame([(t, a, b, n) for t, (a, b, n) in zip(texts, places, strict=True)], "text string, start int, stop int, new string")
    out = bpe.edit(bpe.encode(docs), "start", "stop", "new").collect()
    assert sorted(r["text"] for r in out) == sorted(["one 2 three", "new ", "x", "aaaa", "left alone"])
    assert all(bytes(r["ids"]) == words.encode(r["text"]) and r["n_tokens"] == len(r["ids"]) // 4 for r in out)


def test_query(spark, reference):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = queries.op13_byte_bpe(spark, SF_SMALL).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
