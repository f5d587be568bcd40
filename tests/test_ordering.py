import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfline.plans.ordering import count_below, number_rows, percentiles, with_rank
from tests.conftest import rows


def test_binary_search(spark):
    rng = random.Random(1)
    marks = sorted(rng.choices(range(40), k=15))
    df = spark.createDataFrame([(v, [float(m) for m in marks]) for v in range(-3, 45)], "v int, marks array<double>")
    got = {r["v"]: r["at"] for r in df.select("v", count_below("marks", F.col("v"), 16).alias("at")).collect()}
    assert got == {v: sum(m <= v for m in marks) for v in range(-3, 45)}


def test_rank_with_ties_and_nulls(spark):
    rng = random.Random(2)
    values = [rng.choice([None, 0, 1, 5, 5, 7, 100, 12345]) for _ in range(200)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    got = {r["id"]: r["rank"] for r in with_rank(df, "v", total="n").collect()}
    key = lambda v: -1 if v is None else v
    assert got == {i: 1 + sum(key(w) > key(v) for w in values) for i, v in enumerate(values)}


def test_rank_runs_nothing_before_it_is_used(spark):
    df = spark.range(3).select(F.raise_error(F.lit("ran")).cast("int").alias("v"))
    assert with_rank(df, "v").columns == ["v", "rank"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-10_000, 10_000), min_size=1, max_size=60))
def test_percentiles_match_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = percentiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.9}).first()
    assert list(got) == pytest.approx([np.percentile(values, p) for p in (25, 50, 90)])


def test_percentiles_by_key_and_weight(spark):
    df = spark.createDataFrame([("x", 1, 3), ("x", 9, 1), ("y", 4, 2)], "k string, v int, w int")
    got = rows(percentiles(df, "v", {"m": 0.5, "t": 1.0}, keys=["k"], weight="w"))
    assert got == [("x", 1.0, 9.0), ("y", 4.0, 4.0)]


def test_number_rows_is_consecutive_in_order(spark):
    n = 5000
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.lit(1).alias("same")).repartition(7)
    got = sorted((r["i"], r["k"]) for r in number_rows(df, ["same", "k"], "i", start=10).collect())
    assert got == [(10 + k, k) for k in range(n)]


def test_keys_are_numbered_without_their_rows(spark, monkeypatch):
    n, written = 3000, []
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 7919 % 100).alias("v"), (F.col("id") % 4).alias("w"), F.lit("wide").alias("text")).repartition(7)
    whole = type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda self, *a, **k: written.append(self.columns) or whole(self, *a, **k))
    expected, at = [], 10
    for v, k in sorted((k * 7919 % 100, k) for k in range(n)):
        expected.append((at, k, "wide"))
        at += k % 4
    plain = sorted(rows(number_rows(df, ["v", "k"], "i", start=10, key=["k"]).select("i", "v", "k")))
    assert plain == [(10 + i, v, k) for i, (v, k) in enumerate(sorted((k * 7919 % 100, k) for k in range(n)))]
    weighted = number_rows(df, ["v", "k"], "i", start=10, key=["k"], weight="w")
    assert weighted.columns == [*df.columns, "i"] and sorted(rows(weighted.select("i", "k", "text"))) == sorted(expected)
    assert written == [["v", "k", "_slot"], ["v", "k", "w", "_slot"]]
    assert number_rows(df.limit(0), ["v", "k"], "i", key=["k"], weight="w").count() == 0


def test_values_of_one_magnitude_fall_into_even_ranges(spark):
    """A hundred thousand distinct values between 5000 and 5001 and one hot value: no range is large."""
    from shelfline.plans import ordering

    n = 100_000
    df = spark.range(0, n, 1, 4).select((F.col("id") * 7919 % n / n + 5000).alias("v")).unionByName(spark.range(0, n // 2, 1, 4).select(F.lit(7000.0).alias("v")))
    counts = ordering._value_counts(df, "v", [])
    sizes = [r["count"] for r in ordering._in_ranges(counts).groupBy("_b").count().collect()]
    assert len(sizes) > 0.9 * ordering.SPLITS and max(sizes) <= 4 * n / ordering.SPLITS
    got = percentiles(df, "v", {"a": 0.25, "b": 0.6, "c": 0.99}).first()
    values = np.concatenate([np.arange(n) / n + 5000, np.full(n // 2, 7000.0)])
    assert list(got) == pytest.approx([np.percentile(values, p) for p in (25, 60, 99)])
    assert with_rank(df, "v").filter("v = 7000").select(F.min("rank"), F.max("rank"), F.count("*")).first()[:] == (1, 1, n // 2)


def test_what_is_ranked_is_read_once(spark, tmp_path):
    spark.range(500).select((F.col("id") % 50).alias("k"), F.col("id").alias("u"), F.lit("x").alias("name")).write.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sold = spark.read.parquet(f"{tmp_path}/t").groupBy("k").agg(F.sum("u").alias("units"), F.countDistinct("u").alias("n"), F.max("name").alias("name"))
        for df in (with_rank(sold, "units"), percentiles(sold, "units", {"m": 0.5})):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan parquet") == 1, plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
