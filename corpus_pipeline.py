"""A training corpus from ``documents``: known languages, no repeated lines, one of each near-duplicate group, mixed, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import jaccard, langid, linededup, mixing, packing
from shelfline.llm.scratch import clean_documents, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those no language holds two fifths of, go."""
    docs = clean_documents(docs)
    return langid.keep_known(docs, langid.learn(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; a document they leave empty goes with them."""
    docs = clean_documents(docs)
    kept = linededup.remove_repeats(docs).filter("length(text) > 0")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 stays: the one of smallest id."""
    docs = clean_documents(docs)
    return jaccard.keep_representatives(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks."""
    return mixing.mix(clean_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with its place in a sequence of 2048 tokens."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Language ID, packing and tokenising are not SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir))
    return docs
