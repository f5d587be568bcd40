"""Periodic runs against a comparison of every place with every period."""

import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from shelfline.llm import queries, runs
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, periods=4, least=6):
    """Every period: the maximal stretches in which words that far apart are equal; of one stretch the smallest period."""
    out = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def of_documents(documents):
    bounds = np.cumsum([0, *map(len, documents)])
    start, length, period = runs.periodic_runs(np.array([c for d in documents for c in d], np.int64), bounds)
    out = [[] for _ in documents]
    for s, n, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
        d = int(np.searchsorted(bounds, s, "right")) - 1
        out[d].append((s - int(bounds[d]), n, q))
    return out


def test_random_words():
    rnd = random.Random(11)
    for _ in range(700):
        documents = []
        for _ in range(rnd.randrange(1, 5)):
            kind, n = rnd.randrange(4), rnd.randrange(70)
            if kind == 0:
                w = [rnd.randrange(2) for _ in range(n)]
            elif kind == 1:
                w = ([rnd.randrange(2) for _ in range(rnd.randrange(1, 14))] * 20)[:n]
            elif kind == 2:  # a progression inside every period
                u = [0] * rnd.randrange(7) + [1] * rnd.randrange(1, 3) + [0] * rnd.randrange(5)
                w = [rnd.randrange(2) for _ in range(rnd.randrange(5))] + u * rnd.randrange(3, 7) + u[:rnd.randrange(len(u) + 1)] + [rnd.randrange(3) for _ in range(rnd.randrange(5))]
            else:
                u = [0, 1] * rnd.randrange(1, 5) + [2] * rnd.randrange(2) + [0, 1] * rnd.randrange(3)
                w = [1] * rnd.randrange(3) + u * rnd.randrange(4, 6) + u[:rnd.randrange(len(u) + 1)]
            documents.append(w)
        assert of_documents(documents) == [brute(w) for w in documents], documents


def test_every_short_word_over_two_letters():
    documents = [[(x >> i) & 1 for i in range(13)] for x in range(1 << 13)]
    assert of_documents(documents) == [brute(w) for w in documents]


def test_strings_full_of_repeats():
    a, b = [0], [0, 1]
    for _ in range(14):
        a, b = b, b + a
    thue = [bin(i).count("1") & 1 for i in range(512)]
    documents = [b[:600], thue * 4, [7] * 3000, [0, 0, 0, 1] * 9 + [0, 0, 0, 2] * 9]
    assert of_documents(documents) == [brute(w) for w in documents]


def test_long_period():
    rnd = random.Random(4)
    unit = [rnd.randrange(500) for _ in range(9_001)]
    assert of_documents([unit * 4 + unit[:17]]) == [[(0, 36_021, 9_001)]]


def test_documents(spark):
    many = "a b " * 60_000
    texts = [(None, None), (1, None), (2, ""), (2, " \t\n"), (3, "x y z"), (4, "é é  é\té\né é ü"), (5, many), (5, "same id, other text"), (5, many), (6, "A a A a A a A a B")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for name in ("runs", "n_words", "Collapsed", "start", "period"):
        docs = docs.withColumn(name, F.lit("x"))
    out = runs.find_runs(docs).collect()
    assert len(out) == len(texts)
    for r in out:
        w = WORD.findall(r["text"] or "")
        want = brute(w) if len(w) < 1000 else [(0, 120_000, 2)]
        assert r["n_words"] == len(w) and [tuple(x) for x in r["runs"]] == want and r["collapsed"] == collapsed(w, want)
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = queries.op12_periodic_runs(spark, SF_SMALL).collect()
    assert len(out) == len(texts)
    planted = 0
    for r in out:
        w, h = WORD.findall(texts[r["doc_id"]]), zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue
        found = brute(w)
        planted += bool(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (None if best[0] is None else 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(w, found).encode()).hexdigest()
    assert planted > 5
