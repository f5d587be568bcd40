"""The pipeline and the registered queries of the add-on."""

import __spark_entry__ as entry
import corpus_pipeline
from shelfline.llm import queries
from tests.compare import compare, connect
from tests.conftest import SF_SMALL


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names} and "pipeline" in names


def test_mixing_twin(spark):
    problems = compare(entry.queries()["op7_mixing"](spark, SF_SMALL), connect(SF_SMALL), queries.SQL["op7_mixing"])
    assert not [p for p in problems if not p.startswith("note")]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF_SMALL).cache()
        if name != "pack_sequences":
            assert after.columns == columns
            kept = {r[0] for r in after.select("doc_id").collect()}
            assert kept <= {r[0] for r in before.select("doc_id").collect()}
            assert len(kept) >= 0.8 * before.select("doc_id").distinct().count()
            if name != "mix_sources":
                assert after.count() < before.count() or name == "language_id"
        before = after
    whole = corpus_pipeline.run(spark, SF_SMALL)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "ids_crc32").collect())) == sorted(map(tuple, before.select("doc_id", "piece", "ids_crc32").collect()))
