"""Writing tables, manifests and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.operators.quality import union_all
from shelfline.schema import FOREIGN_KEYS, TABLE_DDL, table_schema
from shelfline.sources.conform import conform_types


def write_parquet(tables: Mapping[str, DataFrame], folder: str, partition_by: Mapping[str, Sequence[str]] | None = None) -> None:
    """One SNAPPY parquet data set per table.

    Partitioned tables are rebalanced on their partition columns first: Spark splits a
    very large day by its size, while a small one still lands in few files.
    """
    for name, df in tables.items():
        keys = list((partition_by or {}).get(name, []))
        writer = df
        if keys:
            writer = df.hint("rebalance", *[F.col(k) for k in keys])
        out = writer.write.mode("overwrite").option("compression", "snappy")
        (out.partitionBy(*keys) if keys else out).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_clustered(df: DataFrame, path: str, *columns: str, partitions: int | None = None) -> None:
    """Range-clustered by the given columns, so scans on them skip row groups."""
    parts = (partitions,) if partitions else ()
    df.repartitionByRange(*parts, *columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)


def write_csv(tables: Mapping[str, DataFrame], folder: str) -> None:
    """CSV with header; Spark writes a header-only file for an empty table."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder.rstrip('/')}/{name}.csv")


def describe_table(df: DataFrame, name: str) -> DataFrame:
    rows = [(name, i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "table_name string, position int, column_name string, data_type string")


def export_manifest(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and types per table, and a total row."""
    parts = []
    for name, df in tables.items():
        columns = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in df.schema.fields])
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"), columns.alias("columns")))
    listed = union_all(parts)
    total = listed.agg(F.sum("row_count").alias("row_count"), F.sum("column_count").cast("int").alias("column_count")).select(
        F.lit("TOTAL").alias("table_name"), "row_count", "column_count", F.lit(None).cast(listed.schema["columns"].dataType).alias("columns")
    )
    return listed.unionByName(total)


def write_report(df: DataFrame, path: str) -> None:
    """A report frame as JSON lines; reports are a handful of rows."""
    df.coalesce(1).write.mode("overwrite").json(path)


def save_table(df: DataFrame, name: str, merge_schema: bool = True, mode: str = "overwrite") -> None:
    """A managed table. ``append`` goes by column name: rows lack what their side does not have.

    With ``merge_schema`` a column the table does not know is added to it, and the rows already there hold null in it;
    without, such a column is an error. Stored files are not rewritten.
    """
    spark = df.sparkSession
    if mode != "append" or not spark.catalog.tableExists(name):
        df.write.mode(mode).saveAsTable(name)
        return
    known = {f.name.lower() for f in spark.table(name).schema.fields}
    added = [f for f in df.schema.fields if f.name.lower() not in known]
    if added and not merge_schema:
        raise ValueError(f"{name} has no column {', '.join(f.name for f in added)}")
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
    own = {c.lower(): c for c in df.columns}
    columns = [(F.col(f"`{own[f.name.lower()]}`") if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in spark.table(name).schema.fields]
    df.select(*columns).write.insertInto(name)


def save_bucketed(tables: Mapping[str, DataFrame], key: str, buckets: int, database: str | None = None) -> None:
    """Managed tables bucketed and sorted by ``key``, which all of them have: aggregates and joins by it read them without a shuffle.

    Each is shuffled once, here, to a task a bucket, so that a bucket is one file. A bucket is what one task writes and later reads, so
    there are ``buckets`` at least, and the next multiple of it that is no less than the session's shuffle partitions, the same for
    all tables; a key that very many rows share makes one large bucket.
    """
    partitions = max((int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) for df in tables.values()), default=1)
    buckets *= -(-partitions // buckets)
    for name, df in tables.items():
        placed = df.repartition(buckets, key).sortWithinPartitions(key)
        placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}" if database else name)


def load_order(names: Sequence[str], references: Sequence[tuple[str, str, str, str]] = FOREIGN_KEYS) -> list[str]:
    """The tables, parents before the children that refer to them; otherwise as given. References in a circle are an error."""
    parents = {name: {p for c, _, p, _ in references if c == name and p in names and p != name} for name in names}
    out: list[str] = []
    while len(out) < len(parents):
        ready = next((name for name in names if name not in out and parents[name] <= set(out)), None)
        if ready is None:
            raise ValueError(f"references in a circle: {sorted(set(names) - set(out))}")
        out.append(ready)
    return out


def load_all(spark: SparkSession, read: Callable[[str], DataFrame], order: Sequence[str] | None = None, database: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Load every table, parents first; one result row per table in that order, errors included."""
    results = []
    for position, name in enumerate(load_order(list(TABLE_DDL)) if order is None else order):
        target = f"{database}.{name}" if database else name
        try:
            save_table(conform_types(read(name), table_schema(name)), target, mode=mode)
            results.append((position, name, spark.table(target).count(), "Success"))
        except Exception as error:  # the report goes on with the next table
            results.append((position, name, 0, f"Error: {error}"))
    return spark.createDataFrame(results, "position int, table_name string, row_count long, status string")


def catalog_summary(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of the catalog with their row counts."""
    listed = spark.catalog.listTables(database)
    parts = []
    for t in listed:
        full = t.name if t.isTemporary else ".".join([*(t.namespace or []), t.name])
        kind = "VIEW" if t.tableType in ("VIEW", "TEMPORARY") else "TABLE"
        parts.append(spark.table(full).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t.name).alias("name"), F.lit(kind).alias("kind"), "rows"))
    return union_all(parts) if parts else spark.createDataFrame([], "name string, kind string, rows long")
