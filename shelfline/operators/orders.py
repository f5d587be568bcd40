"""From scheduled orders to sales."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import anchor, in_days
from shelfline.functions.numbers import line_pence, stable_hash
from shelfline.plans.ordering import number_rows


def stable_draw(*columns: str | Column, seed: int = 0) -> Column:
    """A reproducible number in [0, 1) for a row, in place of a random draw."""
    return stable_hash(*columns, salt=seed) % 1_000_000 / 1_000_000


def reproducible_sample(df: DataFrame, fraction: float, *keys: str, seed: int = 0, draw: Column | None = None) -> DataFrame:
    return df.filter((stable_draw(*keys, seed=seed) if draw is None else draw) < fraction)


def classify_order_status(orders: DataFrame, as_of: date, rule: str = "schedule") -> DataFrame:
    """Status from dates. ``schedule`` lets tomorrow's and later orders override the delivery date."""
    ordered, delivery = F.to_date("orderDate"), F.to_date("deliveryDate")
    by_delivery = (
        F.when(delivery > anchor(as_of), "FUTURE").when(delivery == anchor(as_of), "PICKED").otherwise("DELIVERED")
    )
    if rule == "delivery":
        status = by_delivery
    elif rule == "schedule":
        status = (
            F.when(ordered == anchor(as_of, 1), "PICKED")
            .when(ordered >= anchor(as_of, 2), "FUTURE")
            .otherwise(by_delivery)
        )
    else:
        raise ValueError(f"unknown rule {rule!r}")
    return orders.withColumn("orderStatus", status)


def mark_cancelled(orders: DataFrame, fraction: float = 0.005, seed: int = 42, draw: Column | None = None) -> DataFrame:
    chosen = (stable_draw("orderId", seed=seed) if draw is None else draw) < fraction
    status = F.col("orderStatus")
    return orders.withColumn("orderStatus", F.when((status == "DELIVERED") & chosen, "CANCELLED").otherwise(status))


def sales_from_orders(orders: DataFrame, items: DataFrame, grain: str = "unit", ids: str = "derived") -> DataFrame:
    """One sale per delivered unit (``unit``) or order line (``item``), dated by delivery.

    ``derived`` ids come from the order line and unit; ``running`` ids are
    consecutive over the whole result, in the order of line and unit: lines are numbered by
    their key, ``orderItemId``, and a line takes as many numbers as it has units.
    """
    delivered = orders.filter(F.col("orderStatus") == "DELIVERED").select("orderId", "customerId", "deliveryDate")
    lines = items.select("orderItemId", "orderId", "productId", "quantity", "unitPrice").join(delivered, "orderId")
    if grain == "unit":
        lines = lines.filter(F.col("quantity") > 0)
    if ids == "running":
        lines = number_rows(lines, ["orderItemId"], "_number", key=["orderItemId"], weight="quantity" if grain == "unit" else None)
    if grain == "unit":
        lines = lines.withColumn("_unit", F.explode(F.sequence(F.lit(1), "quantity")))
        lines = lines.withColumn("quantity", F.lit(1))
        key = F.concat_ws("_", F.lit("SALE"), "orderItemId", "_unit")
    elif grain == "item":
        key = F.concat_ws("_", F.lit("SALE"), "orderItemId")
    else:
        raise ValueError(f"unknown grain {grain!r}")
    sold = lines.withColumn("saleId", key)
    if ids == "running":
        number = (F.col("_number") + (F.col("_unit") - 1 if grain == "unit" else F.lit(0))).cast("string")
        padded = F.when(F.length(number) < 10, F.lpad(number, 10, "0")).otherwise(number)
        sold = sold.withColumn("saleId", F.concat(F.lit("SALE_"), padded))
    return sold.select(
        "saleId",
        "orderId",
        "orderItemId",
        "customerId",
        "productId",
        F.col("deliveryDate").alias("saleDate"),
        "unitPrice",
        "quantity",
    )


def units_by_order(orders: DataFrame, items: DataFrame, sales: DataFrame) -> DataFrame:
    """Per order: its status, lines and units ordered, and units and pence sold; zeros without lines or sales.

    Both facts are reduced to a row per order before they meet the orders. From tables bucketed by ``orderId``
    (``sources.writers.save_bucketed``) nothing is shuffled.
    """
    ordered = items.groupBy("orderId").agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units_ordered"))
    sold = sales.groupBy("orderId").agg(F.sum("quantity").alias("units_sold"), F.sum(line_pence(F.col("quantity"), F.col("unitPrice"))).alias("pence_sold"))
    joined = orders.select("orderId", "orderStatus").join(ordered, "orderId", "left").join(sold, "orderId", "left")
    return joined.select("orderId", "orderStatus", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("lines", "units_ordered", "units_sold", "pence_sold")])


def missing_sales(
    orders: DataFrame, items: DataFrame, sales: DataFrame, first: date, last: date, grain: str = "unit"
) -> DataFrame:
    """Sales for delivered orders in a delivery window that have none yet."""
    open_orders = orders.filter((F.col("orderStatus") == "DELIVERED") & in_days("deliveryDate", first, last)).join(
        sales.select("orderId").distinct(), "orderId", "left_anti"
    )
    return sales_from_orders(open_orders, items, grain=grain)


def close_orders(orders: DataFrame, first: date, last: date) -> DataFrame:
    """Orders picked or planned for delivery in the window become DELIVERED."""
    due = F.col("orderStatus").isin("PICKED", "FUTURE") & in_days("deliveryDate", first, last)
    return orders.withColumn("orderStatus", F.when(due, "DELIVERED").otherwise(F.col("orderStatus")))


def with_price_gbp(products: DataFrame) -> DataFrame:
    price = (F.col("price_pence").cast("decimal(10,0)") / F.lit(100)).cast("decimal(10,2)")
    return products.withColumn("price_gbp", price)


def _padded(df: DataFrame) -> DataFrame:
    return df.withColumn("productId", F.lpad(F.col("productId").cast("string"), 18, "0"))


def assemble_model(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The six core tables from the ingest, order and customer stores."""
    products = sources["products"].select(
        F.col("sku").alias("productId"),
        "name",
        "brandName",
        "sellingSize",
        "currency",
        F.col("price").cast("int").alias("price_pence"),
        "category",
        "subcategory",
    )
    skus = sources["product_skus"].select(
        "productId", "sku", "sku_suffix", (F.col("sku_suffix") == "0001").alias("is_primary")
    )
    customers = sources["customers"]
    if "id" in customers.columns:
        customers = customers.withColumnRenamed("id", "customerId")
    return {
        "products": with_price_gbp(products),
        "product_skus": skus,
        "customers": customers,
        "orders": sources["orders"],
        "order_items": _padded(sources["order_items"]),
        "sales": _padded(sources["sales"]),
    }
