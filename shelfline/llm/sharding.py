"""Sharding by size: contiguous shards of equal bytes from global prefix sums.

Only DataFrame functions. The text never moves: each row is reduced to its id, size
and checksum in the scan; those narrow rows are range partitioned by document id,
each partition's totals give the partitions' offsets, and a running sum inside the
partition completes the global prefix sum. The shards are the cuts at equal targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfline.llm.scratch import table

ROW_BYTES = 16


def sized(docs: DataFrame, row_bytes: int = ROW_BYTES) -> DataFrame:
    """``docs`` without the text: size (UTF-8 bytes, null none, plus ``row_bytes``) and checksum (null stays null)."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + row_bytes).alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
    )


def prefix_sums(narrow: DataFrame, size: str = "size", order: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows with ``bytes_before`` and ``rows_before`` over the whole table in ``order``, the one row of totals).

    A tie in ``order`` is cut by the row's place in the scan, so that not even rows that
    are alike in every column have to share a partition. The dealt rows are written
    before anything is derived from them: a retried task cannot number them anew.
    """
    placed = table(
        narrow.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(F.col(order).asc_nulls_first(), "_tie")
        .withColumn("_part", F.spark_partition_id())
    )
    totals = placed.groupBy("_part").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_rows"))
    every = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition, no more
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(every), F.lit(0)).alias("_bytes_at"),
        F.coalesce(F.sum("_rows").over(every), F.lit(0)).alias("_rows_at"),
    )
    inside = Window.partitionBy("_part").orderBy(F.col(order).asc_nulls_first(), "_tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        placed.withColumn("_b", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .withColumn("_r", F.count("*").over(inside))
        .join(F.broadcast(starts), "_part")  # a row per partition
        .withColumn("bytes_before", F.col("_bytes_at") + F.col("_b"))
        .withColumn("rows_before", F.col("_rows_at") + F.col("_r"))
        .drop("_part", "_tie", "_b", "_r", "_bytes_at", "_rows_at")
    )
    return rows, placed.agg(F.sum(size).alias("all_bytes"), F.count("*").alias("all_rows"))


def shard_by_bytes(docs: DataFrame, shards: int = 40, row_bytes: int = ROW_BYTES) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: contiguous runs of document ids with near equal bytes.

    A row lies in the shard its middle byte falls in, so each cut misses its target by
    half a row at most. ``slot`` counts a shard's rows from 0 without gaps. Null text
    has size ``row_bytes`` and no checksum; null ids come first; rows that are alike in
    every column each get a slot; other columns are ignored; no rows give no rows.
    """
    rows, total = prefix_sums(sized(docs, row_bytes))
    placed = rows.join(F.broadcast(total)).withColumn(  # one row of totals
        "shard", F.least(F.expr(f"cast(((2 * bytes_before + size) * {shards}) div (2 * all_bytes) as int)"), F.lit(shards - 1))
    )
    first = placed.groupBy("shard").agg(F.min("rows_before").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(  # a row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("rows_before") - F.col("_first")).alias("slot")
    )
