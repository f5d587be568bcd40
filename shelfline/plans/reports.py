"""Small report shapes: one-row results side by side, JSON summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(*rows: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row, without a keyless join."""
    names = [name for row in rows for name in row.columns]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.first(name, ignorenulls=True).alias(name) for name in names])


def as_json(row: DataFrame, name: str = "report") -> DataFrame:
    """A one-row frame as a JSON document column."""
    return row.select(F.to_json(F.struct(*row.columns)).alias(name))
