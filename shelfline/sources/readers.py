"""Reading tables: CSV, parquet, JSON payloads, several stores at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfline.schema import LOAD_ORDER

_PRICE = (
    "struct<amount:double,amountRelevant:double,amountRelevantDisplay:string,bottleDeposit:double,"
    "bottleDepositDisplay:string,comparison:double,comparisonDisplay:string,currencyCode:string,"
    "currencySymbol:string,perUnit:string,perUnitDisplay:string,wasPriceDisplay:string,additionalInfo:string>"
)
_PRODUCT = (
    "struct<sku:string,name:string,brandName:string,urlSlugText:string,ageRestriction:string,alcohol:boolean,"
    "discontinued:boolean,discontinuedNote:string,notForSale:boolean,notForSaleReason:string,quantityMin:int,"
    "quantityMax:int,quantityInterval:int,quantityDefault:int,quantityUnit:string,weightType:string,"
    f"sellingSize:string,energyClass:string,onSaleDateDisplay:string,price:{_PRICE},"
    "categories:array<struct<id:string,name:string,urlSlugText:string>>,"
    "assets:array<struct<url:string,maxWidth:double,maxHeight:double,mimeType:string,assetType:string,alt:string,displayName:string>>>"
)
PAGE_DDL = f"meta struct<pagination:struct<offset:int,limit:int,totalCount:int>>, data array<{_PRODUCT}>"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV. Give a schema in production: inference reads the files twice."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    return reader.option("inferSchema", True).csv(path) if schema is None else reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, merge_schema: bool = False) -> DataFrame:
    df = spark.read.option("mergeSchema", merge_schema).parquet(path)
    return df if columns is None else df.select(*columns)


def read_product_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Product pages; ``lines=True`` reads one page per line, which splits across tasks."""
    return spark.read.schema(PAGE_DDL).option("multiLine", not lines).json(path)


def read_tables(spark: SparkSession, folder: str, names: Sequence[str] = LOAD_ORDER, suffix: str = ".parquet") -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder.rstrip('/')}/{name}{suffix}") for name in names}


def read_multi(spark: SparkSession, stores: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Tables from several stores, each ``name`` to a path or to a catalog table ``table:<name>``."""
    out = {}
    for name, where in stores.items():
        if where.startswith("table:"):
            out[name] = spark.table(where.removeprefix("table:"))
        elif where.endswith(".csv") or fmt == "csv":
            out[name] = read_csv(spark, where)
        else:
            out[name] = spark.read.format(fmt).load(where)
    return out


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    names = [f"{prefix}{name}" for name in tables]
    for name, df in zip(names, tables.values()):
        df.createOrReplaceTempView(name)
    return names


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)
