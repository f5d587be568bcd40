"""The operators on embeddings against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfline.llm import ann, neardup
from tests.conftest import SF_SMALL
from tests.llm.test_documents import components


@pytest.fixture(scope="module")
def vectors(spark):
    base = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    x = [float(v) for v in base.first()["embedding"]]
    odd = [(9000, x, 77), (9001, x, 77), (9002, [2 * v for v in x], 77), (9003, x, None), (9004, None, 1), (9005, [], 1), (9006, [0.0] * 64, 1), (9007, [float("nan")] * 64, 1), (9008, [1.0, 2.0], 77), (9009, [1.0, 2.0], 77), (9010, [None] + x[1:], 77)]
    return base.unionByName(spark.createDataFrame(odd, "vec_id long, embedding array<float>, label int")).repartition(4).cache()


def good(rows):
    return {r["vec_id"]: (r["label"], np.array(r["embedding"], float)) for r in rows if r["embedding"] and all(v is not None and np.isfinite(v) for v in r["embedding"]) and any(r["embedding"])}


def test_near_duplicates(vectors):
    # small cells and blocks: several of each
    out = {r["vec_id"]: r for r in neardup.near_duplicates(vectors, cell_rows=60, block=16).collect()}
    usable = good(vectors.collect())
    ids = sorted(usable)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            (la, x), (lb, y) = usable[a], usable[b]
            if la is not None and la == lb and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                links.append((a, b))
    group = components(ids, links)
    for i, r in out.items():
        assert r["n_links"] == sum(i in pair for pair in links) and r["component_id"] == group.get(i, i) and r["kept"] == (r["component_id"] == i)
    assert out[9001]["n_links"] == 2 and not out[9002]["kept"] and out[9009]["component_id"] == 9008
    assert neardup.near_duplicates(vectors.limit(0)).count() == 0


def test_nearest_neighbours(spark, vectors):
    large = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    for frame in (vectors, large):
        usable = {i: x for i, (_, x) in good(frame.collect()).items()}
        found: dict[int, list] = {}
        for r in ann.search(frame, frame.filter("vec_id % 20 = 0")).collect():
            found.setdefault(r["query_id"], []).append(r)
        assert set(found) == {i for i in usable if i % 20 == 0}
        hit = 0
        for q, own in found.items():
            own.sort(key=lambda r: r["rank"])
            best = sorted(((-(usable[i] * usable[q]).sum(), i) for i in usable if i != q and len(usable[i]) == len(usable[q])))[:20]
            assert [r["rank"] for r in own] == list(range(1, len(best) + 1))
            assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
            assert all(r["score"] == pytest.approx(usable[r["vec_id"]] @ usable[q]) for r in own)
            hit += len({i for _, i in best} & {r["vec_id"] for r in own})
        assert hit >= 0.9 * 20 * len(found)
    assert ann.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_neighbours_beside_many_copies_and_of_other_lengths(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(32, 16))
    x = centres[rng.integers(0, 32, 6000)] + rng.normal(scale=0.4, size=(6000, 16))
    x[1000:5000] = x[17]  # two thirds are copies of one vector
    rows = [(i, [float(v) for v in x[i]]) for i in range(6000)]
    other = rng.normal(size=(30, 4))
    rows += [(6000 + i, [float(v) for v in other[i]]) for i in range(30)] + [rows[40], (6100, [1.0]), (6120, [2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("h1", F.lit(0)).repartition(4).cache()
    found: dict[int, list] = {}
    for r in ann.search(frame, frame.filter("vec_id % 20 = 0")).collect():
        found.setdefault(r["query_id"], []).append(r)
    vector = {i: np.array(v) for i, v in rows}
    by_length = {n: [i for i in vector if len(vector[i]) == n] for n in (16, 4, 1)}
    hit = wanted = 0
    for q, own in found.items():
        own.sort(key=lambda r: r["rank"])
        same = [i for i in by_length[len(vector[q])] if i != q]
        score = (np.stack([vector[i] for i in same]) * vector[q]).sum(1)
        best = [same[k] for k in np.lexsort((same, -score))[:20]]
        assert [r["rank"] for r in own] == list(range(1, len(best) + 1))
        assert len({r["vec_id"] for r in own}) == len(own) and q not in {r["vec_id"] for r in own}
        if 1000 <= q < 5000:
            assert [r["vec_id"] for r in own] == best  # a third of all rows asks for the same copies
        else:
            hit, wanted = hit + len(set(best) & {r["vec_id"] for r in own}), wanted + len(best)
    assert set(found) == {i for i in vector if i % 20 == 0} and hit >= 0.9 * wanted


def test_lists_are_full_where_partitions_are_small(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").cache()
    n = {r["query_id"]: r["count"] for r in ann.search(frame, frame.filter("vec_id % 20 = 0"), top=350, recall=0.01).groupBy("query_id").count().collect()}
    assert n == {i: 350 for i in range(0, 600, 20)}
