"""How a query is registered: a function of the sample model, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.sources.bridge import Bridge
from suite.model_sql import model_query

Build = Callable[[Bridge], DataFrame]


def presented(df: DataFrame) -> DataFrame:
    """Plain comparison types: DECIMAL as double, every whole number as BIGINT."""

    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(f.name).cast("long").alias(f.name)
        return F.col(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


@dataclass
class Suite:
    builds: dict[str, Build] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, build: Build, sql: str | None = None) -> None:
        if name in self.builds:
            raise ValueError(f"{name} registered twice")
        self.builds[name] = build
        if sql is not None:
            self.sql[name] = model_query(sql)
