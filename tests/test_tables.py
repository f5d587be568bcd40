from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.schema import LOAD_ORDER, table_schema
from shelfline.session import ensure_checkpoint_dir
from shelfline.sources import conform, maintain, readers, writers
from tests.conftest import SF_SMALL, rows


def test_store_types():
    assert [conform.spark_type(t) for t in ("DECIMAL(12,3)", "decimal", "FLOAT", "TIME", "VARCHAR(20)", "HUGE")] == ["decimal(12,3)", "decimal(10,2)", "double", "string", "string", "string"]


def test_conform_pads_casts_and_completes(spark):
    loose = spark.createDataFrame([(123, "A", "2025-01-02", "1.5")], "productId long, name string, created_at string, price_gbp string")
    got = conform.conform_types(loose, table_schema("products"))
    assert got.schema == table_schema("products")
    r = got.first()
    assert (r["productId"], r["price_gbp"], r["supplier_id"]) == ("0" * 15 + "123", Decimal("1.50"), None)


def test_empty_csv_has_its_header(spark, tmp_path):
    writers.write_csv({"t": readers.empty_table(spark, "a int, b string")}, str(tmp_path))
    text = "".join(f.read_text() for f in (tmp_path / "t.csv").glob("part-*"))
    assert text.strip() == "a,b"


def test_csv_quotes_and_inference(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", twice\nplease')], "a int, b string")
    writers.write_csv({"t": df}, str(tmp_path))
    back = readers.read_csv(spark, str(tmp_path / "t.csv"))
    assert back.columns == ["a", "b"]


def test_partitioned_write_and_dynamic_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "v int, d string")
    writers.write_parquet({"t": df}, str(tmp_path), {"t": ["d"]})
    path = str(tmp_path / "t.parquet")
    maintain.overwrite_partitions(spark.createDataFrame([(9, "y")], "v int, d string"), path, "d")
    assert rows(readers.read_parquet(spark, path), "v", "d") == [(1, "x"), (9, "y")]


def test_merge_schema_on_read(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_path}/t/p=1")
    spark.createDataFrame([(2, "n")], "a int, b string").write.parquet(f"{tmp_path}/t/p=2")
    assert set(readers.read_parquet(spark, f"{tmp_path}/t", merge_schema=True).columns) == {"a", "b", "p"}


def test_clustered_write(spark, tmp_path):
    writers.write_clustered(spark.range(100).withColumn("k", F.col("id") % 7), f"{tmp_path}/t", "k", "id", partitions=4)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 100


def test_load_all_reports_each_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS loadtest")

    def read(name):
        if name == "sales":
            raise ValueError("no such file")
        return readers.empty_table(spark, table_schema(name)) if name != "customers" else spark.createDataFrame([(1, "Ann")], "customerId int, first_name string")

    got = {r["table_name"]: r for r in writers.load_all(spark, read, database="loadtest").collect()}
    assert list(got) == LOAD_ORDER
    assert got["customers"]["row_count"] == 1 and got["sales"]["status"].startswith("Error") and got["stock"]["status"] == "Success"
    listed = {r["name"]: r["rows"] for r in writers.catalog_summary(spark, "loadtest").collect()}
    assert listed["customers"] == 1 and "sales" not in listed
    maintain.append_to_table(spark.table("loadtest.customers"), "loadtest.customers")
    assert spark.table("loadtest.customers").count() == 2
    assert readers.read_multi(spark, {"c": "table:loadtest.customers"})["c"].count() == 2
    spark.sql("DROP DATABASE loadtest CASCADE")


def test_manifest_and_report(spark, tmp_path):
    t = {"a": spark.range(3), "b": spark.range(2).withColumn("x", F.lit(1))}
    got = {r["table_name"]: (r["row_count"], r["column_count"]) for r in writers.export_manifest(t).collect()}
    assert got == {"a": (3, 1), "b": (2, 2), "TOTAL": (5, 3)}
    writers.write_report(writers.export_manifest(t), f"{tmp_path}/m")
    assert spark.read.json(f"{tmp_path}/m").count() == 3


def test_replace_slice_keeps_rows_with_null_condition(spark):
    base = spark.createDataFrame([(1, date(2025, 1, 1)), (2, None), (3, date(2025, 2, 1))], "id int, d date")
    new = spark.createDataFrame([(4, date(2025, 2, 2))], "id int, d date")
    assert rows(maintain.replace_slice(base, new, F.col("d") >= F.lit(date(2025, 2, 1))), "id") == [(1,), (2,), (4,)]


def test_update_from_can_set_null_and_add_columns(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    source = spark.createDataFrame([(1, None, 7)], "id int, v string, w int")
    got = {r["id"]: (r["v"], r["w"]) for r in maintain.update_from(base, source, ["id"], ["v", "w"]).collect()}
    assert got == {1: (None, 7), 2: ("b", None)}


def test_checkpoint_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    used = ensure_checkpoint_dir(spark)
    assert used and (named is None or named in used)


def test_product_json(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"meta":{"pagination":{"offset":0,"limit":30,"totalCount":1}},"data":[{"sku":"1","name":"n","price":{"amount":99,"currencySymbol":"£"},"categories":[{"name":"A"},{"name":"B"}]},{"sku":"2","name":"m","categories":[{"name":"A"}]}]}')
    from shelfline.operators.catalog import flatten_products

    flat = flatten_products(readers.read_product_json(spark, str(tmp_path / "page.json")))
    assert rows(flat, "sku", "category", "subcategory") == [("1", "A", "B"), ("2", "A", "")]


@pytest.mark.parametrize("name", LOAD_ORDER)
def test_schemas_parse(spark, name):
    assert len(table_schema(name)) >= 5


def test_load_order_follows_references():
    refs = [("a", "x", "b", "x"), ("b", "x", "c", "x"), ("d", "x", "d", "y"), ("e", "x", "gone", "x")]
    assert writers.load_order(["a", "b", "c", "d", "e"], refs) == ["c", "b", "a", "d", "e"]
    with pytest.raises(ValueError, match="circle"):
        writers.load_order(["a", "b", "c"], [*refs, ("c", "x", "a", "x")])


def test_save_table_merges_columns(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS mergetest")
    name = "mergetest.t"
    writers.save_table(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    more = spark.createDataFrame([(2.5, 2)], "W double, K int")
    with pytest.raises(ValueError, match="W"):
        writers.save_table(more, name, merge_schema=False, mode="append")
    writers.save_table(more, name, mode="append")
    assert rows(spark.table(name), "k", "v", "W") == sorted([(1, "a", None), (2, None, 2.5)])
    writers.save_table(spark.createDataFrame([(3,)], "k long"), name, merge_schema=False, mode="append")
    assert spark.table(name).schema["k"].dataType.simpleString() == "int" and spark.table(name).count() == 3
    writers.save_table(spark.createDataFrame([(4,)], "z int"), name)
    assert rows(spark.table(name)) == [(4,)]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    from shelfline.operators.orders import units_by_order
    from shelfline.sources.writers import save_bucketed

    orders = spark.createDataFrame([("o1", "DELIVERED"), ("o2", "PENDING"), (None, "PENDING")], "orderId string, orderStatus string")
    items = spark.createDataFrame([("o1", 2), ("o1", 1), ("o3", 9)], "orderId string, quantity int")
    sales = spark.createDataFrame([("o1", 3, 1.5), (None, 1, 1.0)], "orderId string, quantity int, price double").selectExpr("orderId", "quantity", "cast(price as decimal(10,2)) as unitPrice")
    spark.sql(f"CREATE DATABASE bucketed_test LOCATION '{tmp_path}/db'")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        save_bucketed({"orders": orders, "items": items, "sales": sales}, "orderId", 4, "bucketed_test")
        got = units_by_order(*[spark.table(f"bucketed_test.{n}") for n in ("orders", "items", "sales")])
        assert sorted(map(tuple, got.collect()), key=str) == [("o1", "DELIVERED", 2, 3, 3, 450), ("o2", "PENDING", 0, 0, 0, 0), (None, "PENDING", 0, 0, 0, 0)]
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP DATABASE bucketed_test CASCADE")


def test_buckets_grow_with_the_shuffle_partitions(spark, tmp_path):
    from shelfline.sources.writers import save_bucketed

    spark.sql(f"CREATE DATABASE buckets_test LOCATION '{tmp_path}/db'")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 10)
        save_bucketed({"keys": spark.range(500)}, "id", 4, "buckets_test")
        assert "12" in [r["data_type"] for r in spark.sql("DESCRIBE FORMATTED buckets_test.keys").collect() if r["col_name"] == "Num Buckets"]
        assert spark.table("buckets_test.keys").count() == 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sql("DROP DATABASE buckets_test CASCADE")


def test_documents_are_dealt_out_before_they_are_judged(spark):
    from shelfline.sources.bridge import Bridge
    from suite.quality_suite import payloads

    assert payloads(Bridge(spark, SF_SMALL)).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
