"""Bringing a table to its model schema."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Store types and the Spark types they load as (FLOAT widens, TIME stays text).
STORE_TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "smallint", "TINYINT": "tinyint",
    "DECIMAL": "decimal(10,2)", "DOUBLE": "double", "FLOAT": "double", "VARCHAR": "string", "CHAR": "string",
    "TEXT": "string", "DATE": "date", "TIMESTAMP": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp",
    "BOOLEAN": "boolean", "BLOB": "binary", "UUID": "string", "TIME": "string",
}


def spark_type(store_type: str) -> str:
    """Spark type of a store column type; unknown types load as text."""
    text = store_type.strip().upper()
    exact = re.fullmatch(r"DECIMAL\((\d+),\s*(\d+)\)", text)
    if exact:
        return f"decimal({exact.group(1)},{exact.group(2)})"
    return STORE_TYPES.get(re.sub(r"\(.*\)", "", text).strip(), "string")


def _conformed(df: DataFrame, field: T.StructField, id_width: int) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    value = F.col(field.name)
    if field.name == "productId":
        text = value.cast("string")
        return F.when(F.length(text) < id_width, F.lpad(text, id_width, "0")).otherwise(text).alias(field.name)
    source = df.schema[field.name].dataType
    if isinstance(field.dataType, T.StringType) and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(value, "HH:mm:ss").alias(field.name)
    return value.cast(field.dataType).alias(field.name)


def conform_types(df: DataFrame, schema: T.StructType, id_width: int = 18) -> DataFrame:
    """Cast to the model's types, pad product ids, add missing columns as nulls; a pure projection."""
    return df.select(*[_conformed(df, f, id_width) for f in schema.fields])
