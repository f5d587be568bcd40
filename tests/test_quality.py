from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from shelfline.operators import quality as q
from tests.conftest import rows


def failing(df):
    return {(r["check"], r["entity"]): r["violations"] for r in df.collect() if not r["passed"]}


def test_tables(spark):
    got = rows(q.check_tables(spark, ["a", "b"], ["b", "c"]), "check", "entity", "passed")
    assert got == [("extra_table", "c", True), ("missing_table", "a", False), ("table", "b", True)]


def test_keys(spark):
    df = spark.createDataFrame([("a, b", "c"), ("a", "b, c"), ("x", "y"), ("x", "y"), (None, "z")], "k string, l string")
    assert failing(q.check_key(df, "t", ["k", "l"])) == {("duplicate_key", "t.k,l"): 1, ("null_key", "t.k,l"): 1}
    empty = df.filter("false")
    assert failing(q.check_key(empty, "t", ["k"])) == {} and q.check_key(empty, "t", ["k"]).count() == 2


def test_references_count_rows_of_hot_values(spark):
    orders = spark.range(3000).select(F.col("id").cast("string").alias("orderId"), F.when(F.col("id") % 3 == 0, 99).otherwise(F.col("id") % 10).cast("int").alias("customerId"))
    customers = spark.range(10).select(F.col("id").cast("int").alias("customerId"))
    assert failing(q.check_fk(orders, "orders", "customerId", customers, "customers", "customerId")) == {("foreign_key", "orders.customerId -> customers.customerId"): 1000}
    everything = q.check_all_references({"orders": orders, "customers": customers})
    assert failing(everything) == {("foreign_key", "orders.customerId -> customers.customerId"): 1000}
    assert rows(q.samples(q.orphans(orders, "customerId", customers, "customerId"))) == [(99, 1000)]


def test_row_rules(spark):
    day = lambda n: datetime(2025, 1, n)
    orders = spark.createDataFrame(
        [("1", "DELIVERED", day(1), day(3), Decimal("3.00"), 1), ("2", "CANCELLED", day(5), day(4), Decimal("9.00"), 2), ("3", "LOST", day(1), day(2), Decimal("0.00"), 1)],
        "orderId string, orderStatus string, orderDate timestamp, deliveryDate timestamp, totalAmount decimal(10,2), itemCount int",
    )
    items = spark.createDataFrame(
        [("1", "P", 2, Decimal("1.50"), Decimal("3.00")), ("2", "P", 1, Decimal("1.00"), Decimal("2.00")), ("2", "P", -1, Decimal("1.00"), Decimal("-1.00"))],
        "orderId string, productId string, quantity int, unitPrice decimal(10,2), totalPrice decimal(10,2)",
    )
    sales = spark.createDataFrame([("1", day(3)), ("1", day(4)), ("2", day(4))], "orderId string, saleDate timestamp")
    assert failing(q.check_line_total(items)) == {("line_total", "order_items"): 1}
    assert failing(q.check_order_total(orders, items)) == {("order_total", "orders"): 1}
    assert failing(q.check_domain(orders, "orders", "orderStatus", ["DELIVERED", "CANCELLED"])) == {("domain", "orders.orderStatus"): 1}
    assert failing(q.check_positive(items, "order_items", ["quantity", "unitPrice"])) == {("not_negative", "order_items.quantity"): 1}
    assert failing(q.check_sales_status(sales, orders)) == {("sale_of_undelivered_order", "sales"): 1, ("sale_of_cancelled_order", "sales"): 1}
    assert failing(q.check_dates(orders, sales)) == {("delivery_before_order", "orders"): 1, ("sale_date", "sales"): 1}
    assert failing(q.check_item_coverage(orders, items, sales)) == {
        ("order_without_items", "orders"): 1, ("items_without_order", "order_items"): 1, ("sales_without_delivery", "sales"): 1,
    }
    assert rows(q.duplicate_lines(items)) == [("2", "P", 2)]


def test_price_and_customer_file(spark):
    products = spark.createDataFrame([(100, Decimal("1.00")), (100, Decimal("1.20"))], "price_pence int, price_gbp decimal(10,2)")
    assert failing(q.check_price(products)) == {("price_consistency", "products"): 1}
    assert failing(q.customer_file_check(spark.createDataFrame([(1,), (1,)], "id int"))) == {("duplicate_key", "customers.customerId"): 1}
    assert failing(q.customer_file_check(spark.createDataFrame([(1,)], "name int"))) == {("id_column", "customers.customerId"): 1}
