"""All checks in one aggregation against each rule by itself, on tables with every fault."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline.operators import quality as q
from shelfline.plans.constraints import Constraints
from shelfline.schema import FOREIGN_KEYS, ORDER_STATUSES, PRIMARY_KEYS


def money(pence):
    return Decimal(pence) / 100


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(5)
    day = lambda: datetime(2025, 1, rnd.randrange(1, 6), rnd.randrange(24))
    some = lambda values: rnd.choice([None, *values, *values, *values])
    orders, products, people = [f"o{i}" for i in range(40)], [f"p{i}" for i in range(12)], list(range(9))
    price = rnd.randrange
    t = {
        "products": ([(some(products), money(price(300)), price(300)) for _ in range(25)], "productId string, price_gbp decimal(10,2), price_pence int"),
        "product_skus": ([(some(products + ["gone"]), f"s{rnd.randrange(30)}") for _ in range(30)], "productId string, sku string"),
        "customers": ([(some(people),) for _ in range(12)], "customerId int"),
        "orders": (
            [(some(orders), some(people + [77]), day(), day(), rnd.choice([*ORDER_STATUSES, "LOST", None]), money(price(500)), rnd.randrange(4)) for _ in range(60)],
            "orderId string, customerId bigint, orderDate timestamp, deliveryDate timestamp, orderStatus string, totalAmount decimal(10,2), itemCount int",
        ),
        "order_items": (
            [(f"i{rnd.randrange(90)}", some(orders + ["oX"]), some(products + ["gone"]), rnd.randrange(1, 3), money(100), money(rnd.choice([100, 200, 300]))) for _ in range(120)],
            "orderItemId string, orderId string, productId string, quantity int, unitPrice decimal(10,2), totalPrice decimal(10,2)",
        ),
        "sales": (
            [(f"x{rnd.randrange(200)}", some(orders + ["oY"]), some(products), some(people), rnd.choice([None, day(), day()])) for _ in range(120)],
            "saleId string, orderId string, productId string, customerId int, saleDate timestamp",
        ),
    }
    return {name: spark.createDataFrame(rows, ddl).repartition(3).cache() for name, (rows, ddl) in t.items()}


def found(df):
    return sorted((r["check"], r["entity"], r["violations"], r["passed"]) for r in df.collect())


def one_by_one(t):
    checks = [q.check_key(t[table], table, [column]) for table, column in PRIMARY_KEYS.items()]
    checks += [q.check_fk(t[c], c, cc, t[p], p, pc) for c, cc, p, pc in FOREIGN_KEYS if c in t and p in t]
    checks += [
        q.check_price(t["products"]), q.check_line_total(t["order_items"]), q.check_order_total(t["orders"], t["order_items"]),
        q.check_domain(t["orders"], "orders", "orderStatus", ORDER_STATUSES), q.check_sales_status(t["sales"], t["orders"]), q.check_dates(t["orders"], t["sales"]),
    ]
    return found(q.union_all(checks))


def test_every_fault_is_counted_alike(tables):
    got = found(q.integrity_checks(tables))
    assert got == one_by_one(tables)
    assert sum(not passed for *_, passed in got) >= 20
    assert found(q.check_all_keys(tables)) == [x for x in got if x[0].endswith("_key") and x[0] != "foreign_key"]
    assert found(q.check_all_references(tables)) == [x for x in got if x[0] == "foreign_key"]


def test_empty_tables_pass(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    got = found(q.integrity_checks(empty))
    assert got == one_by_one(empty) and all(passed for *_, passed in got)
    row = q.verdict(q.integrity_checks(empty)).first()
    assert row["all_passed"] and row["failed"] == 0


def test_each_table_is_read_once(spark, tables, tmp_path):
    stored = {}
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else a shared exchange is seen only when it runs
    try:
        assert scans(q.check_all_references(stored)) == scans(q.check_all_keys(stored)) == len(stored)
        assert scans(q.integrity_checks(stored)) == len(stored) + 1  # orders once more, to meet what is counted per order
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_value_is_shuffled_as_one_row(spark):
    child = spark.range(0, 30_000, 1, 4).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5).cast("int").alias("p"))
    c = Constraints({"child": child, "parent": spark.range(5).select(F.col("id").alias("pk"))})
    c.reference("child", "p", "parent", "pk", [("child", "p")])
    assert found(c.verdicts()) == [("foreign_key", "child.p -> parent.pk", 10_000, False)]
    assert c.keys().filter("whole = 7").select("n0", "n1").collect() == [(0, 10_000)]


def test_texts_and_numbers_meet_as_texts(spark):
    parent, child = spark.createDataFrame([("1",), ("02",)], "pk string"), spark.createDataFrame([(1,), (2,), (None,)], "p int")
    c = Constraints({"child": child, "parent": parent})
    c.reference("child", "p", "parent", "pk", [("child", "p")])
    assert found(c.verdicts()) == [("foreign_key", "child.p -> parent.pk", 1, False)]


def test_rows_say_a_key_once_and_rules_come_with_it(spark):
    """A unique key that is pointed to is one key, and a rule's broken rows are its amounts; a second rule has a key of its own."""
    rows = [(1, 5), (1, -1), (None, -2), (2, None)]
    c = Constraints({"t": spark.createDataFrame(rows, "id long, v long"), "child": spark.createDataFrame([(1,), (3,), (None,)], "id long")})
    c.unique("t", "id")
    c.reference("child", "id", "t", "id", [("child", "id")])
    c.row_rule("negative", "t", "t", F.col("v") < 0)
    c.row_rule("large", "t", "t", F.col("v") > 4)
    assert c.keys().agg(F.sum("n0")).collect()[0][0] == 2 * len(rows)
    assert {r["check"]: r["violations"] for r in c.verdicts().collect()} == {"duplicate_key": 1, "null_key": 1, "foreign_key": 1, "negative": 2, "large": 1}
    with pytest.raises(ValueError, match="row rule"):
        c.say("t", 0, "id", 0, amount=F.col("v"))
