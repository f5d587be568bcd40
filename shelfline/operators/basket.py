"""Live baskets against forecasts, deliveries and future orders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import anchor
from shelfline.functions.numbers import half_up, pence, percent, pounds
from shelfline.operators import views


def _active(basket: DataFrame) -> DataFrame:
    return basket.filter(F.col("status") == "ACTIVE")


def basket_daily(basket: DataFrame) -> DataFrame:
    return _active(basket).groupBy("productId", F.to_date("added_at").alias("target_date")).agg(
        F.sum("quantity").alias("itb_quantity")
    )


def _latest_between(forecasts: DataFrame, first: date, days: int) -> DataFrame:
    return views.latest_forecasts(forecasts).filter(F.col("target_date").between(anchor(first), anchor(first, days - 1)))


def basket_vs_forecast(forecasts: DataFrame, basket: DataFrame, first: date, days: int = 7) -> DataFrame:
    itb = F.coalesce(F.sum("itb_quantity"), F.lit(0).cast("long"))
    return (
        _latest_between(forecasts, first, days)
        .select("productId", "target_date", "predicted_quantity")
        .join(basket_daily(basket), ["productId", "target_date"], "left")
        .groupBy("target_date")
        .agg(
            F.countDistinct("productId").alias("products_forecasted"),
            F.countDistinct(F.when(F.col("itb_quantity").isNotNull(), F.col("productId"))).alias("products_in_basket"),
            F.sum("predicted_quantity").alias("total_forecast"),
            itb.alias("total_itb"),
            half_up(percent(itb, F.sum("predicted_quantity")), 1).alias("itb_percentage"),
        )
        .orderBy("target_date")
    )


def demand_coverage(
    forecasts: DataFrame, basket: DataFrame, inbound: DataFrame, stock: DataFrame, first: date, days: int = 7
) -> DataFrame:
    """Per day: forecast plus basket demand against deliveries due and stock on hand."""
    due = F.col("expected_delivery_date")
    arriving = (
        inbound.filter((F.col("status") == "PENDING") & due.between(anchor(first), anchor(first, days - 1)))
        .groupBy("productId", due.alias("target_date"))
        .agg(F.sum("quantity").alias("_inbound"))
    )
    held = (
        stock.filter(F.col("stock_status") == "AVAILABLE")
        .groupBy("productId")
        .agg(F.sum("quantity_in_stock").alias("_held"))
    )
    zero = F.lit(0).cast("long")
    rows = (
        _latest_between(forecasts, first, days)
        .select("productId", "target_date", "predicted_quantity")
        .join(basket_daily(basket), ["productId", "target_date"], "left")
        .join(arriving, ["productId", "target_date"], "left")
        .join(held, "productId", "left")
        .select(
            "productId", "target_date",
            (F.col("predicted_quantity") + F.coalesce("itb_quantity", zero)).alias("_demand"),
            F.coalesce("_inbound", zero).alias("_inbound"),
            F.coalesce("_held", zero).alias("_held"),
        )
    )
    supply = F.sum("_inbound") + F.sum("_held")
    return (
        rows.groupBy(F.col("target_date").alias("demand_date"))
        .agg(
            F.countDistinct("productId").alias("products"),
            F.sum("_demand").alias("total_demand"),
            F.sum("_inbound").alias("inbound_supply"),
            F.sum("_held").alias("current_stock"),
            half_up(percent(supply, F.sum("_demand")), 1).alias("coverage_percentage"),
        )
        .orderBy("demand_date")
    )


def basket_by_category(basket: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    collapsed = _active(basket).groupBy("productId", "session_id").agg(F.sum("quantity").alias("_q"))
    return (
        collapsed.join(products.select("productId", "category", "price_gbp"), "productId")
        .groupBy("category")
        .agg(
            F.countDistinct("productId").alias("products"),
            F.countDistinct("session_id").alias("sessions"),
            F.sum("_q").alias("total_quantity"),
            pounds(F.sum(pence(F.col("price_gbp")) * F.col("_q"))).alias("basket_value"),
        )
        .orderBy(F.desc("basket_value"), "category")
        .limit(k)
    )


def recent_baskets(basket: DataFrame, customers: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """Newest active basket rows with customer and product names."""
    known = _active(basket).join(customers.select("customerId", "first_name", "last_name"), "customerId")
    newest = known.join(products.select("productId"), "productId", "left_semi").orderBy(F.desc("added_at"), "basket_id").limit(k)
    return newest.join(products.select("productId", F.col("name").alias("product_name")), "productId").select(
        "basket_id", "session_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "product_name", "quantity", "added_at", "expires_at",
    )


def active_customers(orders: DataFrame, min_orders: int = 10) -> DataFrame:
    return (
        orders.filter(F.col("orderStatus").isin("DELIVERED", "PICKED"))
        .groupBy("customerId")
        .agg(F.countDistinct("orderId").alias("order_count"))
        .filter(F.col("order_count") > min_orders)
    )


def basket_overview(basket: DataFrame) -> DataFrame:
    return _active(basket).agg(
        F.countDistinct("basket_id").alias("total_baskets"),
        F.countDistinct("session_id").alias("total_sessions"),
        F.countDistinct("customerId").alias("unique_customers"),
        F.min(F.to_date("added_at")).alias("earliest_basket"),
        F.max(F.to_date("added_at")).alias("latest_basket"),
    )


def session_date(session_id: Column) -> Column:
    """The date in ``SES_<customer>_<yyyymmdd>_<hash>``."""
    return F.to_date(F.split_part(session_id, F.lit("_"), F.lit(3)), "yyyyMMdd")


def basket_sessions(basket: DataFrame) -> DataFrame:
    return (
        basket.groupBy(session_date(F.col("session_id")).alias("basket_date"))
        .agg(
            F.countDistinct("session_id").alias("sessions"),
            F.countDistinct("customerId").alias("customers"),
            F.sum("quantity").alias("total_quantity"),
        )
    )


def basket_vs_future_orders(basket: DataFrame, orders: DataFrame, items: DataFrame, since: date) -> DataFrame:
    """Basket days beside days with FUTURE orders, either side possibly missing."""
    units = items.groupBy("orderId").agg(F.sum("quantity").alias("_u"))
    future = (
        orders.filter(F.col("orderStatus") == "FUTURE")
        .select("orderId", "customerId", F.to_date("orderDate").alias("basket_date"))
        .join(units, "orderId")
        .groupBy("basket_date")
        .agg(
            F.countDistinct("orderId").alias("future_orders"),
            F.countDistinct("customerId").alias("future_customers"),
            F.sum("_u").alias("future_qty"),
        )
    )
    filled = ["sessions", "customers", "total_quantity", "future_orders", "future_customers", "future_qty"]
    names = ["basket_sessions", "basket_customers", "basket_qty", "future_orders", "future_customers", "future_qty"]
    return (
        basket_sessions(basket)
        .join(future, "basket_date", "full")
        .filter(F.col("basket_date") >= anchor(since))
        .select(
            F.col("basket_date").alias("date"),
            *[F.coalesce(c, F.lit(0).cast("long")).alias(n) for c, n in zip(filled, names)],
        )
        .orderBy("date")
    )


def horizon_forecasts(forecasts: DataFrame, products: DataFrame, first: date, days: int = 7) -> DataFrame:
    # neither side is broadcast: both have a row per product or more
    about = products.select("productId", F.col("name").alias("product_name"), "price_gbp").hint("merge")
    return _latest_between(forecasts, first, days).join(about, "productId").select(
        "productId", "target_date", F.col("predicted_quantity").alias("forecast_qty"), "product_name", "price_gbp"
    )
