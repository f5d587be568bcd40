"""Data-quality rules. Every rule returns ``(check, entity, violations, passed)`` rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.numbers import line_pence, mean_int, money_avg, pence, percent, ratio
from shelfline.operators import sales as sales_ops
from shelfline.plans.constraints import Constraints, no_key
from shelfline.plans.reports import beside
from shelfline.schema import FOREIGN_KEYS, ORDER_STATUSES, PRIMARY_KEYS


def _verdict(counted: DataFrame, check: str, entity: str, column: str = "violations") -> DataFrame:
    violations = F.col(column)
    return counted.select(
        F.lit(check).alias("check"),
        F.lit(entity).alias("entity"),
        F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
        (F.coalesce(violations, F.lit(0)) == 0).alias("passed"),
    )


def _verdicts(counted: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One verdict per (check, entity, column) of a one-row frame of violation counts."""
    found = [
        F.struct(F.lit(check).alias("check"), F.lit(entity).alias("entity"), F.coalesce(column, F.lit(0)).cast("long").alias("violations"))
        for check, entity, column in rules
    ]
    return counted.select(F.explode(F.array(*found)).alias("v")).select(
        "v.check", "v.entity", "v.violations", (F.col("v.violations") == 0).alias("passed")
    )


def _count(rows: DataFrame, check: str, entity: str) -> DataFrame:
    return _verdict(rows.agg(F.count(F.lit(1)).alias("violations")), check, entity)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def samples(violating: DataFrame, n: int = 5) -> DataFrame:
    """A few violating rows, lowest first in column order."""
    return violating.orderBy(*violating.columns).limit(n)


# --- tables and keys --------------------------------------------------------


def check_tables(spark: SparkSession, expected: Sequence[str], present: Sequence[str]) -> DataFrame:
    """Missing tables are violations, extra ones are listed but pass."""
    rows = [("missing_table", t, 1, False) for t in expected if t not in present]
    rows += [("extra_table", t, 0, True) for t in present if t not in expected]
    rows += [("table", t, 0, True) for t in expected if t in present]
    return spark.createDataFrame(rows, "check string, entity string, violations long, passed boolean")


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def check_key(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Distinct key values that repeat, and rows with a null key part; one pass over the table."""
    entity = f"{table}.{','.join(columns)}"
    per_key = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    counted = per_key.agg(F.count_if(F.col("_n") > 1).alias("repeated"), F.sum(F.when(missing, F.col("_n"))).alias("nulls"))
    return _verdicts(counted, [("duplicate_key", entity, "repeated"), ("null_key", entity, "nulls")])


def orphans(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without parent and the rows that carry them.

    Child rows are counted per value before the join, so a value held by very
    many rows is one row by the time it is shuffled.
    """
    values = child.filter(F.col(child_column).isNotNull()).groupBy(F.col(child_column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return values.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def check_fk(child: DataFrame, child_table: str, child_column: str, parent: DataFrame, parent_table: str, parent_column: str) -> DataFrame:
    missing = orphans(child, child_column, parent, parent_column).agg(F.sum("rows").alias("violations"))
    return _verdict(missing, "foreign_key", f"{child_table}.{child_column} -> {parent_table}.{parent_column}")


def check_all_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every primary key: each table is read once and all keys share one shuffle."""
    c = Constraints(tables)
    _unique(c)
    return c.verdicts()


def check_all_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every foreign key: each table is read once, whether it points, is pointed to, or both; no join.

    A value that a third of the rows share is counted before it is shuffled.
    """
    c = Constraints(tables)
    _references(c)
    return c.verdicts()


def _unique(c: Constraints) -> None:
    for table, column in PRIMARY_KEYS.items():
        if table in c.tables:
            c.unique(table, column)


def _references(c: Constraints, done: Sequence[tuple[str, str]] = ()) -> None:
    relations = [r for r in FOREIGN_KEYS if r[0] in c.tables and r[2] in c.tables]
    for child, column, parent, key in relations:
        if (child, column) not in done:
            c.reference(child, column, parent, key, [(a, b) for a, b, p, _ in relations if p == parent])


# --- row rules --------------------------------------------------------------


def _price_off() -> Column:
    return F.abs(F.col("price_gbp").cast("double") - F.col("price_pence") / 100) > 0.01


def check_price(products: DataFrame) -> DataFrame:
    return _count(products.filter(_price_off()), "price_consistency", "products")


def _line_off() -> Column:
    return F.abs(pence(F.col("totalPrice")) - line_pence(F.col("quantity"), F.col("unitPrice"))) > 1


def check_line_total(items: DataFrame) -> DataFrame:
    return _count(items.filter(_line_off()), "line_total", "order_items")


def check_order_total(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order total and item count against the order's lines."""
    lines = items.groupBy("orderId").agg(F.sum(pence(F.col("totalPrice"))).alias("_p"), F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("long")
    matched = orders.select("orderId", "totalAmount", "itemCount").join(lines, "orderId", "left")
    total_off = F.abs(pence(F.col("totalAmount")) - F.coalesce("_p", zero)) > 1
    count_off = F.col("_n").isNotNull() & (F.col("itemCount") != F.col("_n"))
    counted = matched.agg(F.count_if(total_off).alias("total"), F.count_if(count_off).alias("items"))
    return _verdicts(counted, [("order_total", "orders", "total"), ("item_count", "orders", "items")])


def check_domain(df: DataFrame, table: str, column: str, values: Sequence[str]) -> DataFrame:
    return _count(df.filter(~F.col(column).isin(list(values))), "domain", f"{table}.{column}")


def check_positive(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """CHECK (column >= 0) rules of the model."""
    counted = df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in columns])
    return _verdicts(counted, [("not_negative", f"{table}.{c}", c) for c in columns])


def _sales_against_orders(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Sale rows per (order, day) beside the order's status and delivery day, as three violation counts."""
    per_day = sales.groupBy("orderId", F.to_date("saleDate").alias("_sold")).agg(F.count(F.lit(1)).alias("_n"))
    joined = per_day.join(orders.select("orderId", "orderStatus", F.to_date("deliveryDate").alias("_due")), "orderId")
    status, n = F.col("orderStatus"), F.col("_n")
    return joined.agg(
        F.sum(F.when(status != "DELIVERED", n)).alias("open"),
        F.sum(F.when(status == "CANCELLED", n)).alias("cancelled"),
        F.sum(F.when(F.col("_sold") != F.col("_due"), n)).alias("misdated"),
    )


_SALE_STATUS_RULES = [("sale_of_undelivered_order", "sales", "open"), ("sale_of_cancelled_order", "sales", "cancelled")]


def check_sales_status(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Sales of orders that are not DELIVERED, and of CANCELLED ones."""
    return _verdicts(_sales_against_orders(sales, orders), _SALE_STATUS_RULES)


def check_dates(orders: DataFrame, sales: DataFrame) -> DataFrame:
    """Delivery not before order; sale on the delivery date."""
    early = orders.agg(F.count_if(F.col("deliveryDate") < F.col("orderDate")).alias("violations"))
    return _verdict(early, "delivery_before_order", "orders").unionByName(
        _verdict(_sales_against_orders(sales, orders), "sale_date", "sales", "misdated")
    )


def duplicate_lines(items: DataFrame) -> DataFrame:
    """The same product twice in an order; may be intended."""
    return duplicate_keys(items, ["orderId", "productId"])


def duplicate_sales(sales: DataFrame) -> DataFrame:
    return duplicate_keys(sales, ["orderId", "productId", "customerId", "saleDate"])


def check_item_coverage(orders: DataFrame, items: DataFrame, sales: DataFrame) -> DataFrame:
    """Orders with lines = non-cancelled orders; orders with sales = delivered orders."""
    live = orders.filter(F.col("orderStatus") != "CANCELLED").select("orderId")
    delivered = orders.filter(F.col("orderStatus") == "DELIVERED").select("orderId")
    with_lines, with_sales = items.select("orderId").distinct(), sales.select("orderId").distinct()

    def missing(a: DataFrame, b: DataFrame, check: str, entity: str) -> DataFrame:
        return _count(a.join(b, "orderId", "left_anti"), check, entity)

    return union_all(
        [
            missing(live, with_lines, "order_without_items", "orders"),
            missing(with_lines, live, "items_without_order", "order_items"),
            missing(delivered, with_sales, "delivered_without_sales", "orders"),
            missing(with_sales, delivered, "sales_without_delivery", "sales"),
        ]
    )


def check_sale_units(orders: DataFrame, items: DataFrame, sales: DataFrame) -> DataFrame:
    """Units on delivered lines against units sold; lines against sale rows."""
    lines = items.groupBy("orderId").agg(F.sum("quantity").alias("u"), F.count(F.lit(1)).alias("n"))
    expected = lines.join(orders.filter(F.col("orderStatus") == "DELIVERED").select("orderId"), "orderId", "left_semi")
    both = beside(
        expected.agg(F.sum("u").alias("expected_units"), F.sum("n").alias("expected_lines")),
        sales.agg(F.sum("quantity").alias("sold_units"), F.count(F.lit(1)).alias("sale_rows")),
    )
    return both.select("expected_units", "sold_units", "expected_lines", "sale_rows", (F.col("expected_units") == F.col("sold_units")).alias("units_match"))


def check_business_rules(orders: DataFrame, items: DataFrame, customers: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """Requirement checks with their measured value, one row per rule."""
    live = F.when(F.col("orderStatus") != "CANCELLED", F.col("totalAmount"))
    growth = sales_ops.basket_growth(orders).select("first_months_avg", "last_full_months_avg")
    shape = orders.agg(
        F.datediff(F.max("orderDate"), F.min("orderDate")).alias("days"),
        F.count(F.lit(1)).alias("orders"),
        F.countDistinct("customerId").alias("buyers"),
        F.count_if((F.col("orderStatus") == "CANCELLED") & (F.col("deliveryDate") < F.lit(as_of))).alias("cancelled"),
        F.count_if(F.col("deliveryDate") < F.lit(as_of)).alias("past"),
        F.min(live).alias("low"),
        F.max(live).alias("high"),
    )
    people = customers.agg(F.count(F.lit(1)).alias("customers"))
    goods = products.agg(F.count(F.lit(1)).alias("products"))
    ordered = items.agg(F.countDistinct("productId").alias("ordered_products"))
    facts = beside(shape, growth, people, goods, ordered)

    years = F.col("days") / 365.25
    per_week = ratio(F.col("orders"), F.col("buyers")) / (years * 52)
    cancelled = percent(F.col("cancelled"), F.col("past"))
    coverage = ratio(F.col("ordered_products"), F.col("products"))
    low, high = F.col("low").cast("double"), F.col("high").cast("double")
    first, last = F.col("first_months_avg"), F.col("last_full_months_avg")
    rules = [
        ("date_span_years", years, years.between(1.95, 2.05)),
        ("lowest_order_value", low, low >= 20),
        ("highest_order_value", high, high <= 100),
        ("first_months_basket", first, first.between(36, 40)),
        ("last_full_months_basket", last, last.between(41, 45)),
        ("orders_per_customer_week", per_week, per_week.between(1, 2)),
        ("cancellation_rate_pct", cancelled, cancelled.between(0.4, 0.6)),
        ("customers_with_orders", F.col("buyers").cast("double"), F.col("buyers") == F.col("customers")),
        ("product_coverage", coverage, coverage >= 0.32),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), v.cast("double").alias("value"), ok.alias("passed")) for n, v, ok in rules])
    return facts.select(F.explode(rows).alias("r")).select("r.rule", F.round("r.value", 6).alias("value"), "r.passed")


def id_format(tables: Mapping[str, DataFrame], column: str = "productId") -> DataFrame:
    """Shortest and longest id and distinct ids per table."""
    return union_all(
        [
            df.groupBy(column)
            .agg(F.length(F.col(column)).alias("_l"))
            .agg(F.min("_l").alias("min_length"), F.max("_l").alias("max_length"), F.count(column).alias("unique_products"))
            .select(F.lit(name).alias("table_name"), "min_length", "max_length", "unique_products")
            for name, df in tables.items()
        ]
    )


def table_counts(tables: Mapping[str, DataFrame], total: bool = True) -> DataFrame:
    counted = union_all([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()])
    if not total:
        return counted
    return counted.rollup("table_name").agg(F.sum("rows").alias("rows")).withColumn("table_name", F.coalesce("table_name", F.lit("TOTAL")))


def supply_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return table_counts(tables, total=False)


def integrity_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules over the core tables as one relation.

    Each table is read once for its keys, its references and its row rules (see :mod:`shelfline.plans.constraints`). What
    lines and sales say of an order is counted per order, sales per day too, and meets the order's row in one join.
    """
    c = Constraints(tables)
    _unique(c)
    pointing = [("order_items", "orderId"), ("sales", "orderId")]
    _references(c, pointing)
    space = c.space("orders", "orderId", pointing, name="rows")
    lines, sold = c.slot(space), c.slot(space)
    c.say("order_items", space, "orderId", lines, amount=pence(F.col("totalPrice")))
    c.say("sales", space, "orderId", sold, day=F.to_date("saleDate"))
    c.row_rule("price_consistency", "products", "products", _price_off())
    c.row_rule("line_total", "order_items", "order_items", _line_off())
    c.row_rule("domain", "orders.orderStatus", "orders", ~F.col("orderStatus").isin(ORDER_STATUSES))
    c.row_rule("delivery_before_order", "orders", "orders", F.col("deliveryDate") < F.col("orderDate"))
    whole, text = c._key(space, "orderId")
    rows = tables["orders"].select(
        F.lit(space).alias("space"), whole.alias("whole"), text.alias("text"), F.lit(True).alias("met"),
        pence(F.col("totalAmount")).alias("total"), F.col("itemCount").alias("items"), F.col("orderStatus").alias("status"), F.to_date("deliveryDate").alias("due"),
    )
    same = reduce(lambda a, b: a & b, [F.col(f"k.{x}").eqNullSafe(F.col(f"o.{x}")) for x in ("space", "whole", "text")])
    keys = c.keys()
    joined = c.of_space(keys, space).alias("k").join(rows.alias("o"), same, "left").select("k.*", "met", "total", "items", "status", "due")

    met = F.col("met").isNotNull()
    order, sale = met & F.col("day").isNull() & (F.col("n0") > 0), met & ~no_key()
    n_lines, n_sold = F.col(f"n{lines}"), F.col(f"n{sold}")
    has_lines = (n_lines > 0) & ~no_key()
    lost = ~met & ~no_key()
    c.check("foreign_key", "order_items.orderId -> orders.orderId", F.sum(F.when(lost, n_lines)), joined=True)
    c.check("foreign_key", "sales.orderId -> orders.orderId", F.sum(F.when(lost, n_sold)), joined=True)
    c.check("order_total", "orders", F.count_if(order & (F.abs(F.col("total") - F.when(has_lines, F.col("amount")).otherwise(0)) > 1)), joined=True)
    c.check("item_count", "orders", F.count_if(order & has_lines & (F.col("items") != n_lines)), joined=True)
    c.check("sale_of_undelivered_order", "sales", F.sum(F.when(sale & (F.col("status") != "DELIVERED"), n_sold)), joined=True)
    c.check("sale_of_cancelled_order", "sales", F.sum(F.when(sale & (F.col("status") == "CANCELLED"), n_sold)), joined=True)
    c.check("sale_date", "sales", F.sum(F.when(sale & (F.col("day") != F.col("due")), n_sold)), joined=True)
    return c.verdicts(keys, joined)


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Counts, SKU coverage, averages and date ranges as metric rows.

    Ranges come from one aggregate per table; the tables themselves are never
    combined.
    """
    t = tables
    skus = t["product_skus"].groupBy("productId").agg(F.count(F.lit(1)).alias("n"))

    def metric(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
        row = df.agg(*[c.cast("string").alias(n) for n, c in columns.items()])
        pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in columns])
        return row.select(F.explode(pairs).alias("p")).select("p.metric", "p.value")

    counts = [metric(df, {f"{n}_rows": F.count(F.lit(1))}) for n, df in t.items() if n in PRIMARY_KEYS]
    return union_all(
        [
            *counts,
            metric(skus, {"products_with_skus": F.count(F.lit(1)), "avg_skus_per_product": F.round(mean_int(F.col("n")), 2)}),
            metric(t["orders"], {"first_order": F.min(F.to_date("orderDate")), "last_order": F.max(F.to_date("orderDate"))}),
            metric(t["sales"], {"first_sale": F.min(F.to_date("saleDate")), "last_sale": F.max(F.to_date("saleDate"))}),
        ]
    )


def order_status_averages(orders: DataFrame) -> DataFrame:
    return orders.groupBy("orderStatus").agg(F.count(F.lit(1)).alias("count"), money_avg(F.col("totalAmount")).alias("avg_amount"))


def verdict(checks: DataFrame) -> DataFrame:
    return checks.agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(~F.col("passed")).alias("failed"), F.every("passed").alias("all_passed")
    )


def customer_file_check(customers: DataFrame) -> DataFrame:
    """The id column of a customer file: present (``id`` or ``customerId``), unique, not null."""
    named = customers.withColumnRenamed("id", "customerId") if "id" in customers.columns else customers
    if "customerId" not in named.columns:
        return named.agg(F.lit(1).alias("violations")).select(
            F.lit("id_column").alias("check"), F.lit("customers.customerId").alias("entity"),
            F.col("violations").cast("long").alias("violations"), F.lit(False).alias("passed"),
        )
    return check_key(named, "customers", ["customerId"])
