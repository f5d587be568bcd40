"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import alignment, ann, bpe, jaccard, langid, linededup, lmscore, mixing, neardup, packing, runs, sharding, substring


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return lmscore.score(docs, lmscore.learn(docs))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_read(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_read(spark, sf_dir, "documents"), with_text=False)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 20 = 0"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(_read(spark, sf_dir, "documents")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(_read(spark, sf_dir, "documents"), words=4, percent=85)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs), spans=False).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.remove_repeats(_read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_read(spark, sf_dir, "documents"), with_groups=False).drop("groups")


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _with_repeated_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document (by the checksum h of its id) repeats one word run from some place to its end; null ids do not."""

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                rows = batch.slice(first, 512)
                texts = rows.column("text").to_pylist()
                for k, doc in enumerate(rows.column("doc_id").to_pylist()):
                    h = 1 if doc is None else zlib.crc32(str(doc).encode())
                    if h % 10 == 0 and (own := _WORD.findall(texts[k] or "")):
                        n, g = len(own), h // 10
                        a = g % n
                        p = 1 + (n - a) // (3 + g % 8)
                        texts[k] = " ".join(own[:a] + (own[a:a + p] * ((n - a) // p + 1))[:n - a])
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return docs.select("doc_id", "text").mapInArrow(run, docs.select("doc_id", "text").schema)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(_with_repeated_tails(_read(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), (-F.col("longest.shorter")).alias("length"), F.col("longest.period").alias("period"),
        F.expr("1000 * -longest.shorter div longest.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(_read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return bpe.decode(encoded).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_embedding_near_dedup, op3_sharding, op4_substring_dedup, op5_nearest_neighbours,
        op6_packing, op7_mixing, op8_ngram_jaccard, op9_language_id, op10_line_dedup,
        op11_token_alignment, op12_periodic_runs, op13_byte_bpe,
    )
}

SQL = {
    "op7_mixing": r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
           ('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM sources
), walked AS (
    SELECT *, (1.5 * sum(source_size) OVER () - 2.0 * coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST)
), best AS (
    SELECT arg_min(level, source_size / weight) AS level FROM walked WHERE level * weight <= 2.0 * source_size
), aims AS (
    SELECT source, source_size, CAST(coalesce(least(weight * (SELECT level FROM best), 2.0 * source_size), 2.0 * source_size) AS DOUBLE) AS target FROM walked
)
SELECT doc_id, size, source_size, target,
       CAST(size * CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) + CASE WHEN u < target / source_size - floor(target / source_size) THEN 1 ELSE 0 END END AS BIGINT) AS taken
FROM sized JOIN aims ON sized.source IS NOT DISTINCT FROM aims.source
""",
}
