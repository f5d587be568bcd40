"""The thirteen published views.

Views are relations: none of them sorts, so a consumer that filters, joins or
aggregates further never pays for a global order. Facts are aggregated on
their key before they meet a dimension.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import anchor, weekday_name
from shelfline.functions.numbers import mean_int, money_avg, pence, pounds, revenue
from shelfline.plans.ordering import with_rank


def _is(status_column: str, status: str) -> Column:
    return F.col(status_column) == status


def customer_analytics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    delivered = _is("orderStatus", "DELIVERED")
    value = F.when(delivered, F.col("totalAmount"))
    history = orders.groupBy("customerId").agg(
        F.countDistinct("orderId").alias("total_orders"),
        F.count_if(delivered).alias("delivered_orders"),
        F.count_if(_is("orderStatus", "CANCELLED")).alias("cancelled_orders"),
        F.sum(pence(value)).alias("_pence"),
        money_avg(value).alias("avg_order_value"),
        F.min("orderDate").alias("first_order"),
        F.max("orderDate").alias("last_order"),
    )
    zero = F.lit(0).cast("long")
    return customers.join(history, "customerId", "left").select(
        *[customers[c] for c in ("customerId", "first_name", "last_name", "email", "city", "postcode")],
        *[F.coalesce(c, zero).alias(c) for c in ("total_orders", "delivered_orders", "cancelled_orders")],
        pounds(F.coalesce("_pence", zero)).alias("lifetime_value"),
        "avg_order_value",
        "first_order",
        "last_order",
    )


def product_performance(products: DataFrame, sales: DataFrame) -> DataFrame:
    sold = sales.groupBy("productId").agg(
        F.countDistinct("orderId").alias("times_ordered"),
        F.sum("quantity").alias("units_sold"),
        revenue(F.col("quantity"), F.col("unitPrice")).alias("revenue"),
    )
    rows = products.select("productId", "name", "brandName", "category", "subcategory", "price_gbp").join(
        sold, "productId", "left"
    )
    rows = rows.withColumn("times_ordered", F.coalesce("times_ordered", F.lit(0).cast("long")))
    return with_rank(rows, "units_sold", "sales_rank")


def _expiring(as_of: date, days: int = 7) -> Column:
    return F.sum(
        F.when(F.col("expiration_date") <= anchor(as_of, days), F.col("quantity_in_stock")).otherwise(0)
    )


def stock_availability(stock: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    held = (
        stock.filter(_is("stock_status", "AVAILABLE"))
        .groupBy("productId")
        .agg(
            F.countDistinct("sku").alias("num_skus"),
            F.sum("quantity_in_stock").alias("total_quantity"),
            F.min("expiration_date").alias("earliest_expiration"),
            _expiring(as_of).alias("expiring_week_qty"),
            money_avg(F.col("purchase_price")).alias("avg_purchase_price"),
        )
    )
    names = products.select("productId", F.col("name").alias("product_name"), "category")
    return names.join(held, "productId")


def latest_forecasts(forecasts: DataFrame) -> DataFrame:
    """All rows of each product's newest forecast date.

    The newest date is a combinable aggregate joined back, so a product with
    very many forecast rows is never sorted in one task as a window would do.
    Both sides are shuffled whatever size Spark takes them for: one row per
    product is no small table, and forecasts exploded from products are read off as the products' size.
    """
    newest = forecasts.groupBy("productId").agg(F.max("forecast_date").alias("forecast_date")).hint("shuffle_hash")
    return forecasts.join(newest, ["productId", "forecast_date"], "left_semi")


def pending_deliveries(inbound: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    due = (
        inbound.filter(_is("status", "PENDING") & (F.col("expected_delivery_date") >= anchor(as_of)))
        .groupBy("productId", "expected_delivery_date")
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.countDistinct("po_id").alias("num_orders"),
            money_avg(F.col("unit_cost")).alias("avg_unit_cost"),
        )
    )
    return due.join(products.select("productId", F.col("name").alias("product_name")), "productId")


def product_catalog(products: DataFrame, skus: DataFrame) -> DataFrame:
    """Product with its primary SKU and SKU count; several primary SKUs give several rows."""
    counted = skus.groupBy("productId").agg(F.countDistinct("sku").alias("total_skus"))
    primary = skus.filter("is_primary").select("productId", F.col("sku").alias("primary_sku")).distinct()
    columns = ["productId", "name", "brandName", "sellingSize", "category", "subcategory", "price_gbp"]
    return (
        products.select(*columns)
        .join(counted, "productId", "left")
        .join(primary, "productId", "left")
        .select(*columns, "primary_sku", F.coalesce("total_skus", F.lit(0).cast("long")).alias("total_skus"))
    )


def stock_summary(stock: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    held = (
        stock.filter(_is("stock_status", "AVAILABLE"))
        .groupBy("productId")
        .agg(
            F.countDistinct("sku").alias("num_skus"),
            F.countDistinct("batch_number").alias("num_batches"),
            F.sum("quantity_in_stock").alias("total_stock"),
            F.min("expiration_date").alias("earliest_expiration"),
            F.max("expiration_date").alias("latest_expiration"),
            _expiring(as_of).alias("expiring_soon_qty"),
        )
    )
    about = products.select("productId", F.col("name").alias("product_name"), "category", "subcategory")
    return about.join(held, "productId")


def supplier_delivery_calendar(schedules: DataFrame, suppliers: DataFrame) -> DataFrame:
    return schedules.join(
        suppliers.select("supplier_id", "supplier_name", "contact_email"), "supplier_id"
    ).select(
        "supplier_id",
        "supplier_name",
        "contact_email",
        "delivery_date",
        "po_cutoff_date",
        "po_cutoff_time",
        "lead_time_days",
        weekday_name(F.col("delivery_date")).alias("delivery_day_of_week"),
    )


def future_purges(stock: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    expiry = F.col("expiration_date")
    status = (
        F.when(expiry < anchor(as_of), "EXPIRED")
        .when(expiry == anchor(as_of), "EXPIRING_TODAY")
        .when(expiry <= anchor(as_of, 3), "EXPIRING_SOON")
        .otherwise("FUTURE")
    )
    held = stock.filter((F.col("quantity_in_stock") > 0) & _is("stock_status", "AVAILABLE"))
    return held.join(products.select("productId", F.col("name").alias("product_name")), "productId").select(
        "sku",
        "productId",
        "product_name",
        F.col("quantity_in_stock").alias("quantity_to_purge"),
        expiry.alias("purge_date"),
        "batch_number",
        status.alias("purge_status"),
    )


def stock_by_zone(stock: DataFrame) -> DataFrame:
    return (
        stock.filter(_is("stock_status", "AVAILABLE"))
        .groupBy("temperature_zone")
        .agg(
            F.countDistinct("productId").alias("num_products"),
            F.countDistinct("sku").alias("num_skus"),
            F.sum("quantity_in_stock").alias("total_items"),
            F.countDistinct("batch_number").alias("num_batches"),
        )
        .orderBy("temperature_zone")
    )


def product_expiration_guide(products: DataFrame, shelf_life: DataFrame) -> DataFrame:
    guide = shelf_life.select(
        F.col("category").alias("_category"),
        F.col("subcategory").alias("_subcategory"),
        "shelf_life_days",
        "min_shelf_life_days",
        "max_shelf_life_days",
        "temperature_sensitive",
        "requires_refrigeration",
        F.col("notes").alias("storage_notes"),
    )
    same = (F.col("category") == F.col("_category")) & F.col("subcategory").eqNullSafe(F.col("_subcategory"))
    about = products.select(
        "productId", F.col("name").alias("product_name"), "category", "subcategory", "price_pence", "price_gbp"
    )
    return about.join(guide, same, "left").drop("_category", "_subcategory")


def active_basket(basket: DataFrame, now: datetime) -> DataFrame:
    expires = F.col("expires_at")
    return basket.filter(_is("status", "ACTIVE") & (expires.isNull() | (expires > F.lit(now))))


def itb_summary(basket: DataFrame, products: DataFrame, now: datetime) -> DataFrame:
    """What shoppers hold in their baskets now ("in the basket"), per product."""
    held = active_basket(basket, now).groupBy("productId").agg(
        F.countDistinct("session_id").alias("active_sessions"),
        F.sum("quantity").alias("total_quantity"),
        mean_int(F.col("quantity")).alias("avg_quantity_per_session"),
        F.min("added_at").alias("earliest_add"),
        F.max("added_at").alias("latest_add"),
    )
    return held.join(products.select("productId", F.col("name").alias("product_name")), "productId")


def daily_actuals(sales: DataFrame, name: str = "actual_quantity") -> DataFrame:
    return sales.groupBy("productId", F.to_date("saleDate").alias("target_date")).agg(
        F.sum("quantity").alias(name)
    )


def forecast_accuracy(forecasts: DataFrame, sales: DataFrame) -> DataFrame:
    predicted, actual = F.col("predicted_quantity"), F.col("actual_quantity")
    # neither side is broadcast: forecasts exploded from products are read off as the products' size
    return forecasts.join(daily_actuals(sales).hint("merge"), ["productId", "target_date"]).select(
        "productId",
        "forecast_date",
        "target_date",
        "forecast_horizon",
        "predicted_quantity",
        "actual_quantity",
        F.abs(predicted - actual).alias("absolute_error"),
        F.when(actual > 0, (predicted - actual) / actual).alias("relative_error"),
    )
