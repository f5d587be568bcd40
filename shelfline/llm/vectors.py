"""What the operators on embeddings share: usable vectors, bounded samples, arrays from Arrow."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(frame: DataFrame, column: str = "embedding"):
    """True where a vector has components, all finite, not all zero."""
    x = F.col(column).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(x) > 0) & ~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    """Rows of equal length as one double-precision matrix."""
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def sample(frame: DataFrame, most: int, dims: int) -> np.ndarray:
    """At most ``most`` vectors of ``dims`` components, those of lowest hash, on the driver."""
    rows = frame.filter(F.size("embedding") == dims).select("embedding", F.xxhash64("embedding").alias("h")).orderBy("h").limit(most).select("embedding").collect()
    return np.array([r[0] for r in rows], np.float64).reshape(len(rows), dims)


def usual_dims(frame: DataFrame) -> int:
    """The most frequent vector length (the smaller of equals), 0 without vectors."""
    row = frame.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return row["n"] if row else 0
