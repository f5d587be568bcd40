"""Table maintenance as pure transformations: append, replace, update, number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.plans.ordering import number_rows


def append(base: DataFrame, new: DataFrame) -> DataFrame:
    """Base rows plus new ones by column name; columns the new rows lack become null."""
    return base.unionByName(new.select(*[c for c in new.columns if c in base.columns]), allowMissingColumns=True)


def append_to_table(new: DataFrame, table: str) -> None:
    new.write.mode("append").saveAsTable(table)


def replace_slice(base: DataFrame, new: DataFrame, slice_: Column) -> DataFrame:
    """Delete the rows matching ``slice_``, then insert ``new``. A null condition keeps the row."""
    return append(base.filter(~F.coalesce(slice_, F.lit(False))), new)


def delete_dependents(child: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent is not among the removed ones."""
    return child.join(removed.select(key).distinct(), key, "left_anti")


def overwrite_partitions(df: DataFrame, path: str, *partition_by: str) -> None:
    """Replace only the partitions present in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def update_from(base: DataFrame, source: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """UPDATE … FROM: take ``columns`` from the matching source row, else keep them.

    The source must hold one row per key.
    """
    picked = source.select(*on, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(picked, list(on), "left")
    for c in columns:
        current = F.col(c) if c in base.columns else F.lit(None)
        joined = joined.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(current))
    order = [*base.columns, *[c for c in columns if c not in base.columns]]
    return joined.select(*order)


def update_status(base: DataFrame, events: DataFrame, key: str, column: str = "status", order: str | None = None) -> DataFrame:
    """Set the status by key from an event frame of (key, status).

    With several events of a key the latest by ``order`` wins, ties by name order; without
    an order column the last by name order does.
    """
    latest = events.groupBy(key).agg((F.max_by(column, F.struct(order, column)) if order else F.max(column)).alias(column))
    return update_from(base, latest, [key], [column])


def close_parents(parents: DataFrame, children: DataFrame, key: str, parent_status: str, open_value: str = "PENDING", done: str = "DELIVERED") -> DataFrame:
    """A parent with children, none of them open any more, is done."""
    state = children.groupBy(key).agg(F.count_if(F.col("status") == open_value).alias("_open"))
    status = F.when(F.col("_open") == 0, done).otherwise(F.col(parent_status))
    return parents.join(state, key, "left").withColumn(parent_status, status).drop("_open").select(*parents.columns)


def assign_surrogate_id(df: DataFrame, order: Sequence[str], name: str = "id", start: int | Column = 1, key: Sequence[str] = ()) -> DataFrame:
    """Consecutive ids in a total order, starting at ``start`` (a number or max + 1 as a scalar column).

    With ``key``, unique and never null, only the key and the order are sorted and written, not the rows.
    """
    return number_rows(df, list(order), name, start, key)
