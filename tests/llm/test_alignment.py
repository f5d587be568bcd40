"""Token alignment against sets of offsets and a comparison of all ranges, tokens against the public libraries."""

import hashlib
import random
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import alignment, queries
from tests.conftest import SF_SMALL

PARTS = ["th", "e", " ", "  ", "\n", "é", "日本", "1", "abc", ".", "▁", "<s>", "<|endoftext|>", "\t", " ", "q\x1c", "\xa0", "😀"]


@pytest.fixture(scope="module")
def known():
    return alignment.tokenizers(alignment.FIRST, alignment.SECOND, None)


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens(text, known, libraries):
    """[(id, start, end)] by each library; none where the bytes differ."""
    out = []
    for ids, names in ((libraries[0].encode(f" {text}", add_special_tokens=False).ids, known.first_bytes), (libraries[1].encode(text), known.second_bytes)):
        if b"".join(names[i] for i in ids) != f" {text}".encode() or not text:
            return [], []
        ends = np.cumsum([len(names[i]) for i in ids]).tolist()
        out.append(list(zip(ids, [0, *ends], ends)))
    return out


def brute(a, b):
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups = []
    for lo, hi in zip([0, *cuts], cuts):
        groups.append("|".join(",".join(str(i) for i, _, e in x if lo < e <= hi) for x in (a, b)))
    links, first = [], 0
    for i, s, e in a:
        while first < len(b) and b[first][2] <= s:
            first += 1
        k = first
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return groups, links


def check(rows, texts, known, libraries):
    """Every row of the operator against the brute force over all texts."""
    found = [brute(*tokens(t or "", known, libraries)) for t in texts]
    counted = Counter(pair for _, links in found for pair in set(links))
    most = {}
    for (i, _), n in counted.items():
        most[i] = max(most.get(i, 0), n)
    want = []
    for t, (groups, links) in zip(texts, found):
        a, b = tokens(t or "", known, libraries)
        own = ";".join(groups)
        want.append((len(a), len(b), len(groups), len(links), sum(counted[p] == most[p[0]] for p in links), sum(counted[p] for p in links), hashlib.sha256(own.encode()).hexdigest() if own else ""))
    got = [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups_sha256"]) for r in rows]
    assert sorted(got) == sorted(want)
    return [";".join(groups) for groups, _ in found]


def test_tokens_equal_the_libraries(known, libraries):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(30))) for _ in range(1500)]
    for text, both in zip(texts, known.encode(texts)):
        a, b = tokens(text, known, libraries)
        assert (both is None) == (not a)
        if both:
            assert [np.frombuffer(x, "<i4").tolist() for x in both] == [[i for i, _, _ in a], [i for i, _, _ in b]]


def test_groups_of_random_ends():
    """Few shared ends, many, none but the documents' own."""
    rnd = random.Random(2)
    for _ in range(500):
        a, b, first = [0], [0], [0]
        for _ in range(rnd.randrange(1, 4)):
            size = rnd.randrange(1, 60)
            base = a[-1]
            for own in (a, b):
                own += sorted({base + x for x in rnd.sample(range(1, size + 1), rnd.randrange(0, size))} | {base + size})
            first.append(len(a) - 1)
        cut_a, cut_b = alignment.shared_groups(np.array(a, np.int32), np.array(b, np.int32), np.array(first))
        common = sorted(set(a) & set(b))
        assert [a[i] for i in cut_a] == common and [b[i] for i in cut_b] == common


def test_documents(spark, known, libraries):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(40))) for _ in range(150)] + [None, "", " ", "the " * 20_000, "same", "same", "same", "a▁b"]
    rows = [(None if i % 11 == 0 else i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name in ("block", "docs", "links", "pair", "n", "N_A"):
        docs = docs.withColumn(name, F.lit("x"))
    out = alignment.align(docs).collect()
    groups = check(out, texts, known, libraries)
    assert sorted(r["groups"] for r in out) == sorted(groups)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out) == sorted((i is None, i or 0) for i, _ in rows)
    assert alignment.align(docs.limit(0)).count() == 0
    assert [r["n_a"] for r in alignment.align(docs.filter("text is null")).collect()] == [0]


def test_small_blocks_change_nothing(spark, known, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).cache()
    whole = sorted(map(tuple, alignment.align(docs, with_groups=False).collect()))
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 500)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 2000)
    assert sorted(map(tuple, alignment.align(docs, with_groups=False).collect())) == whole


def test_query(spark, known, libraries):
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(queries.op11_token_alignment(spark, SF_SMALL).collect(), texts, known, libraries)


def test_a_worker_holds_little(spark, monkeypatch):
    """A batch is taken in runs, and a block's pairs leave in rows of bounded size."""
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(3, 9))) for _ in range(30_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(600)), "text": [" ".join(rnd.choices(words, k=800)) for _ in range(600)]})
    docs = spark.createDataFrame([(0, "")], "doc_id long, text string")
    runs = []
    monkeypatch.setattr(alignment, "ROW_PAIRS", 500, raising=False)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run))
    monkeypatch.setattr(alignment, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    alignment._written_blocks(docs, alignment.FIRST, alignment.SECOND, None, False)
    tracemalloc.start()
    try:
        found = [(r.column("docs")[0].as_py(), r.column("pairs")[0].as_py()) for r in runs[0]([batch])]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [d["doc_id"] for rows, _ in found for d in rows] == list(range(600))
    pairs = [p for _, own in found for p in own]
    assert pairs == sorted(set(pairs))
    assert max(len(own) for _, own in found) <= 500
    assert peak < 60 << 20
