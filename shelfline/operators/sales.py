"""Sales, basket and customer analytics."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.classify import customer_segment
from shelfline.functions.dates import anchor, in_days, month_start, months_before, quarter_label, week_start, weekday_name
from shelfline.functions.numbers import (
    half_up, line_pence, mean_int, money_avg, money_sum, pence, percent, pounds, ratio, revenue,
)
from shelfline.plans.ordering import profile, reads_all, value_counts, with_rank
from shelfline.plans.reports import beside

COMPLETED = ["DELIVERED", "PICKED"]


def _line() -> Column:
    return line_pence(F.col("quantity"), F.col("unitPrice"))


def _sale_revenue() -> Column:
    return revenue(F.col("quantity"), F.col("unitPrice"))


def _day(column: str) -> Column:
    return F.to_date(column)


def _not_cancelled(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("orderStatus") != "CANCELLED")


def _last_days(sales: DataFrame, as_of: date, days: int) -> DataFrame:
    return sales.filter(F.col("saleDate") >= anchor(as_of, -days))


def order_totals(items: DataFrame) -> DataFrame:
    """Value in pence, units and lines per order; combines map-side before the order join."""
    return items.groupBy("orderId").agg(
        F.sum(_line()).alias("_value"), F.sum("quantity").alias("_units"), F.count(F.lit(1)).alias("_lines")
    )


def _priced_orders(orders: DataFrame, items: DataFrame, as_of: date, months: int) -> DataFrame:
    recent = orders.filter(
        F.col("orderStatus").isin(COMPLETED) & (F.col("orderDate") >= months_before(as_of, months))
    ).select("orderId", "customerId", F.year("orderDate").alias("y"), F.quarter("orderDate").alias("q"))
    return recent.join(order_totals(items), "orderId")


def _per_product(sales: DataFrame, products: DataFrame, *more_keys: Column | str, columns: Sequence[str] = ("name", "category")) -> DataFrame:
    """Sales collapsed to (product, order, ...) and only then given product attributes."""
    keys = ["productId", "orderId", *more_keys]
    collapsed = sales.groupBy(*keys).agg(F.sum("quantity").alias("_units"), F.sum(_line()).alias("_value"))
    return collapsed.join(products.select("productId", *columns), "productId")


# --- quarters ---------------------------------------------------------------


def basket_size_by_quarter(orders: DataFrame, items: DataFrame, as_of: date, months: int = 18) -> DataFrame:
    value = F.col("_value")
    return (
        _priced_orders(orders, items, as_of, months)
        .groupBy(F.col("y").alias("order_year"), F.col("q").alias("order_quarter"))
        .agg(
            quarter_label(F.col("order_year"), F.col("order_quarter")).alias("quarter_label"),
            F.countDistinct("orderId").alias("total_orders"),
            half_up(mean_int(value) / 100, 2).alias("avg_basket_size_gbp"),
            pounds(F.min(value)).alias("min_basket_gbp"),
            pounds(F.max(value)).alias("max_basket_gbp"),
            half_up(F.stddev_samp(value) / 100, 2).alias("stddev_basket_gbp"),
        )
        .orderBy(F.desc("order_year"), F.desc("order_quarter"))
    )


FEATURED_CATEGORIES = ["Fresh Food", "Chilled Food", "Food Cupboard", "Bakery"]


def sales_by_quarter(
    sales: DataFrame, products: DataFrame, as_of: date, months: int = 18, categories: Sequence[str] = FEATURED_CATEGORIES
) -> DataFrame:
    per_product = (
        sales.filter(F.col("saleDate") >= months_before(as_of, months))
        .groupBy("productId", F.year("saleDate").alias("sale_year"), F.quarter("saleDate").alias("sale_quarter"))
        .agg(F.sum("quantity").alias("_units"), F.sum(_line()).alias("_value"))
        .join(products.select("productId", "category"), "productId")
    )
    pivot = [
        pounds(F.sum(F.when(F.col("category") == c, F.col("_value")).otherwise(0))).alias(
            re.sub(r"\W+", "_", c.lower()) + "_revenue_gbp"
        )
        for c in categories
    ]
    return (
        per_product.groupBy("sale_year", "sale_quarter")
        .agg(
            quarter_label(F.col("sale_year"), F.col("sale_quarter")).alias("quarter_label"),
            F.countDistinct("productId").alias("products_sold"),
            F.sum("_units").alias("total_units_sold"),
            pounds(F.sum("_value")).alias("total_revenue_gbp"),
            half_up(mean_int(F.col("_value")) / 100, 2).alias("avg_sale_value_gbp"),
            *pivot,
        )
        .orderBy(F.desc("sale_year"), F.desc("sale_quarter"))
    )


def quarterly_trends(orders: DataFrame, items: DataFrame, sales: DataFrame, as_of: date, months: int = 18) -> DataFrame:
    baskets = (
        _priced_orders(orders, items, as_of, months)
        .groupBy(F.col("y").alias("year"), F.col("q").alias("quarter"))
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.countDistinct("customerId").alias("active_customers"),
            F.sum("_value").alias("_value"),
            F.sum("_units").alias("_items"),
        )
    )
    sold = (
        sales.filter(F.col("saleDate") >= months_before(as_of, months))
        .groupBy(F.year("saleDate").alias("year"), F.quarter("saleDate").alias("quarter"))
        .agg(F.sum(_line()).alias("_revenue"))
    )
    by_quarter = Window.orderBy("year", "quarter")  # one row per quarter
    n, basket = F.col("order_count"), ratio(F.col("_value"), F.col("order_count"))
    return (
        baskets.join(sold, ["year", "quarter"], "left")
        .withColumn("_basket", basket)
        .withColumn("prev_quarter_orders", F.lag("order_count").over(by_quarter))
        .withColumn("_before", F.lag("_basket").over(by_quarter))
        .select(
            "year",
            "quarter",
            quarter_label(F.col("year"), F.col("quarter")).alias("quarter_label"),
            "order_count",
            "active_customers",
            half_up(F.col("_basket") / 100, 2).alias("avg_basket_size_gbp"),
            half_up(ratio(F.col("_items"), n), 1).alias("avg_items_per_basket"),
            half_up(ratio(n, F.col("active_customers")), 1).alias("orders_per_customer"),
            pounds(F.col("_revenue")).alias("total_revenue_gbp"),
            half_up(ratio(F.col("_revenue"), n) / 100, 2).alias("revenue_per_order_gbp"),
            "prev_quarter_orders",
            half_up(ratio(F.col("_basket") - F.col("_before"), F.col("_before")) * 100, 2).alias("basket_size_qoq_growth_pct"),
        )
        .orderBy(F.desc("year"), F.desc("quarter"))
    )


def quarter_yoy(orders: DataFrame, items: DataFrame, as_of: date, y0: int, y1: int, months: int = 18) -> DataFrame:
    """The same quarter in two years; the basket mean is over order lines."""

    def in_year(year: int, value: str) -> Column:
        return F.sum(F.when(F.col("y") == year, F.col(value)))

    def orders_in(year: int) -> Column:
        found = F.count_if(F.col("y") == year)
        return F.when(found > 0, found)

    mean0 = ratio(in_year(y0, "_value"), in_year(y0, "_lines")) / 100
    mean1 = ratio(in_year(y1, "_value"), in_year(y1, "_lines")) / 100
    return (
        _priced_orders(orders, items, as_of, months)
        .groupBy(F.col("q").alias("quarter"))
        .agg(
            orders_in(y0).alias(f"orders_{y0}"),
            orders_in(y1).alias(f"orders_{y1}"),
            half_up(mean0, 2).alias(f"avg_basket_{y0}_gbp"),
            half_up(mean1, 2).alias(f"avg_basket_{y1}_gbp"),
            half_up(ratio(mean1 - mean0, mean0) * 100, 2).alias("yoy_basket_growth_pct"),
        )
        .orderBy("quarter")
    )


# --- report on recent sales -------------------------------------------------


def daily_sales(sales: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return (
        _last_days(sales, as_of, days)
        .groupBy(_day("saleDate").alias("sale_date"))
        .agg(
            F.countDistinct("orderId").alias("num_orders"),
            F.sum("quantity").alias("units_sold"),
            _sale_revenue().alias("revenue"),
        )
        .orderBy("sale_date")
    )


def _product_revenue(sales: DataFrame, products: DataFrame) -> DataFrame:
    collapsed = sales.groupBy("productId").agg(F.sum("quantity").alias("_units"), F.sum(_line()).alias("_value"))
    return (
        collapsed.join(products.select("productId", "name", "category"), "productId")
        .groupBy(F.col("name").alias("product_name"), "category")
        .agg(F.sum("_units").alias("units_sold"), pounds(F.sum("_value")).alias("revenue"))
    )


def top_products(sales: DataFrame, products: DataFrame, as_of: date, days: int = 30, k: int = 20) -> DataFrame:
    return (
        _product_revenue(_last_days(sales, as_of, days), products)
        .orderBy(F.desc("revenue"), "product_name", "category")
        .limit(k)
    )


def category_performance(sales: DataFrame, products: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    collapsed = (
        _last_days(sales, as_of, days)
        .groupBy("productId", "orderId")
        .agg(
            F.sum("quantity").alias("_units"),
            F.sum(_line()).alias("_value"),
            F.sum(pence(F.col("unitPrice"))).alias("_price"),
            F.count("unitPrice").alias("_n"),
        )
        .join(products.select("productId", "category"), "productId")
    )
    return (
        collapsed.groupBy("category")
        .agg(
            F.countDistinct("orderId").alias("num_orders"),
            F.sum("_units").alias("units_sold"),
            pounds(F.sum("_value")).alias("revenue"),
            (ratio(F.sum("_price"), F.sum("_n")) / 100).alias("avg_price"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def sales_report_summary(sales: DataFrame, products: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    daily = daily_sales(sales, as_of, days).agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("units_sold").alias("total_units"),
        F.sum("num_orders").alias("total_orders"),
        (ratio(F.sum(pence(F.col("revenue"))), F.count(F.lit(1))) / 100).alias("avg_daily_revenue"),
    )
    category = category_performance(sales, products, as_of, days).orderBy(F.desc("revenue"), "category").limit(1)
    product = top_products(sales, products, as_of, days, k=1)
    return beside(
        daily,
        category.select(F.col("category").alias("top_category")),
        product.select(F.col("product_name").alias("top_product")),
    )


# --- customers --------------------------------------------------------------


def customer_segments(analytics: DataFrame, scheme: str = "report") -> DataFrame:
    value = F.col("lifetime_value")
    return (
        analytics.groupBy(customer_segment(value, scheme).alias("segment"))
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            money_avg(value).alias("avg_lifetime_value"),
            mean_int(F.col("total_orders")).alias("avg_orders"),
            half_up(F.avg("avg_order_value"), 4).alias("avg_basket_size"),
        )
        .orderBy(F.desc("avg_lifetime_value"), "segment")
    )


def top_customers(analytics: DataFrame, k: int = 20) -> DataFrame:
    return (
        analytics.filter(F.col("lifetime_value") > 0)
        .orderBy(F.desc("lifetime_value"), "customerId")
        .limit(k)
        .select(
            "customerId",
            F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
            "city", "total_orders", "delivered_orders", "lifetime_value", "avg_order_value",
        )
    )


def city_distribution(analytics: DataFrame, k: int = 10) -> DataFrame:
    value = F.col("lifetime_value")
    return (
        analytics.groupBy("city")
        .agg(F.count(F.lit(1)).alias("customer_count"), money_sum(value).alias("total_value"), money_avg(value).alias("avg_value"))
        .orderBy(F.desc("customer_count"), "city")
        .limit(k)
    )


def customer_report_summary(analytics: DataFrame, k: int | None = None) -> DataFrame:
    """Customer totals, value of the buying customers (with ``k``: of the top ``k``), and the segments as a nested array."""
    segments = customer_segments(analytics)
    nested = segments.agg(
        F.sum("customer_count").alias("total_customers"),
        F.array_sort(F.collect_list(F.struct("segment", "customer_count", "avg_lifetime_value", "avg_orders"))).alias("segments"),
    )
    buying = analytics.filter(F.col("lifetime_value") > 0) if k is None else top_customers(analytics, k)
    best = buying.agg(
        money_sum(F.col("lifetime_value")).alias("total_lifetime_value"),
        money_avg(F.col("lifetime_value")).alias("avg_customer_value"),
    )
    return beside(nested, best)


def customer_value(orders: DataFrame, k: int = 100) -> DataFrame:
    return (
        _not_cancelled(orders)
        .groupBy("customerId")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            money_sum(F.col("totalAmount")).alias("lifetime_value"),
            money_avg(F.col("totalAmount")).alias("avg_order_value"),
            F.min("orderDate").alias("first_order"),
            F.max("orderDate").alias("last_order"),
        )
        .orderBy(F.desc("lifetime_value"), "customerId")
        .limit(k)
    )


def customer_activity(orders: DataFrame) -> DataFrame:
    days = F.datediff("last_order", "first_order")
    return (
        orders.groupBy("customerId")
        .agg(F.count(F.lit(1)).alias("total_orders"), F.min("orderDate").alias("first_order"), F.max("orderDate").alias("last_order"))
        .withColumn("days_active", days)
        .withColumn("weeks_active", F.col("days_active") / 7)
        .withColumn("orders_per_week", half_up(ratio(F.col("total_orders"), F.col("weeks_active")), 2))
    )


def orders_per_customer_week(orders: DataFrame) -> DataFrame:
    weekly = orders.groupBy("customerId", week_start(F.col("orderDate")).alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return weekly.agg(
        mean_int(F.col("n")).alias("avg_orders_per_week"),
        F.min("n").alias("min_orders"),
        F.max("n").alias("max_orders"),
        # order counts of a customer-week: a handful of distinct values in the buffer
        F.percentile("n", F.lit(0.5)).alias("median_orders"),
    )


def customer_frequency_bands(orders: DataFrame) -> DataFrame:
    n = F.col("n")
    return (
        orders.groupBy("customerId")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count_if(n < 52).alias("low_frequency"),
            F.count_if(n.between(52, 156)).alias("normal_frequency"),
            F.count_if(n > 156).alias("high_frequency"),
        )
    )


# --- time patterns ----------------------------------------------------------


def sales_by_month(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(month_start(F.col("saleDate")).alias("month"))
        .agg(F.count(F.lit(1)).alias("sales_count"), F.sum("quantity").alias("units_sold"), _sale_revenue().alias("revenue"))
        .orderBy("month")
    )


def sales_growth(sales: DataFrame) -> DataFrame:
    """First against last month, in units."""
    monthly = sales_by_month(sales)
    first, last = F.min_by("units_sold", "month"), F.max_by("units_sold", "month")
    return monthly.agg(
        first.alias("first_month_units"),
        last.alias("last_month_units"),
        half_up(percent(last - first, first), 4).alias("growth_pct"),
    )


def sales_by_weekday(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(F.weekday("saleDate").alias("weekday"))
        .agg(F.first(weekday_name(F.col("saleDate"))).alias("day_name"), F.sum("quantity").alias("units_sold"))
        .orderBy("weekday")
    )


def daily_peaks(sales: DataFrame) -> DataFrame:
    daily = sales.groupBy(_day("saleDate").alias("d")).agg(F.sum("quantity").alias("u"), F.sum(_line()).alias("v"))
    return daily.agg(
        mean_int(F.col("u")).alias("avg_units_per_day"),
        (mean_int(F.col("v")) / 100).alias("avg_daily_revenue"),
        F.max("u").alias("peak_daily_units"),
        pounds(F.max("v")).alias("peak_daily_revenue"),
    )


def product_sales_summary(sales: DataFrame) -> DataFrame:
    return sales.groupBy("productId").agg(
        F.sum("quantity").alias("units_sold"),
        _sale_revenue().alias("total_revenue"),
        money_avg(F.col("unitPrice")).alias("avg_price"),
    )


def basket_growth(orders: DataFrame) -> DataFrame:
    """Mean basket of the first three months against the last three full ones, and the monthly slope."""
    monthly = (
        _not_cancelled(orders)
        .groupBy(month_start(F.col("orderDate")).alias("month"))
        .agg(money_avg(F.col("totalAmount")).alias("basket"))
    )
    by_month = Window.orderBy("month")  # one row per month
    placed = monthly.select(
        "basket",
        (F.row_number().over(by_month) - 1).alias("i"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    )
    i, n = F.col("i"), F.col("n")
    return placed.agg(
        F.count(F.lit(1)).alias("months"),
        half_up(F.avg(F.when(i < 3, F.col("basket"))), 4).alias("first_months_avg"),
        half_up(F.avg(F.when((i >= n - 4) & (i < n - 1), F.col("basket"))), 4).alias("last_full_months_avg"),
        half_up(F.regr_slope("basket", i), 4).alias("slope_per_month"),
    )


def items_per_order(items: DataFrame) -> DataFrame:
    return items.groupBy("orderId").agg(F.count(F.lit(1)).alias("n")).agg(
        mean_int(F.col("n")).alias("mean_items"), F.min("n").alias("min_items"), F.max("n").alias("max_items")
    )


def order_value_profile(orders: DataFrame, low: float = 20, high: float = 100) -> DataFrame:
    """Distribution of order values excluding cancelled orders, from one pass over them."""
    counts = value_counts(_not_cancelled(orders), "totalAmount")
    amount = F.col("value")
    facts = counts.agg(
        (ratio(F.sum(pence(amount) * F.col("n")), F.sum("n")) / 100).alias("mean"),
        F.sum(F.when((amount < low) | (amount > high), F.col("n")).otherwise(0)).alias("out_of_range"),
    )
    shape = profile(counts, {"q1": 0.25, "median": 0.5, "q3": 0.75}, sample=False).drop("mean")
    return beside(shape.withColumn("std", half_up(F.col("std"), 4)), facts)


# --- orders -----------------------------------------------------------------


def status_distribution(orders: DataFrame) -> DataFrame:
    counted = orders.groupBy("orderStatus").agg(F.count(F.lit(1)).alias("count"), money_avg(F.col("totalAmount")).alias("avg_amount"))
    share = percent(F.col("count"), F.sum("count").over(Window.partitionBy()))  # one row per status
    return counted.withColumn("percentage", share).orderBy(F.desc("count"), "orderStatus")


def cancellation_rate(orders: DataFrame, as_of: date) -> DataFrame:
    return orders.filter(F.col("deliveryDate") < anchor(as_of)).agg(
        percent(F.count_if(F.col("orderStatus") == "CANCELLED"), F.count(F.lit(1))).alias("cancellation_rate")
    )


def orders_per_week(orders: DataFrame) -> DataFrame:
    weekly = orders.groupBy(week_start(F.col("orderDate")).alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return weekly.agg(
        mean_int(F.col("n")).alias("avg_orders"), F.min("n").alias("min_orders"), F.max("n").alias("max_orders")
    )


def _with_share(counted: DataFrame, count: str = "count") -> DataFrame:
    # the frames passed in have one row per weekday or per delivery delay
    return counted.withColumn("percentage", half_up(percent(F.col(count), F.sum(count).over(Window.partitionBy())), 1))


def orders_by_weekday(orders: DataFrame) -> DataFrame:
    counted = orders.groupBy(F.weekday("orderDate").alias("weekday")).agg(
        F.first(weekday_name(F.col("orderDate"))).alias("day_name"), F.count(F.lit(1)).alias("count")
    )
    return _with_share(counted).orderBy("weekday")


def delivery_days_distribution(orders: DataFrame) -> DataFrame:
    counted = (
        _not_cancelled(orders)
        .groupBy(F.datediff("deliveryDate", "orderDate").alias("delivery_days"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return _with_share(counted).orderBy("delivery_days")


def status_by_delivery_period(orders: DataFrame, as_of: date) -> DataFrame:
    delivery = _day("deliveryDate")
    period = F.when(delivery < anchor(as_of), "past").when(delivery == anchor(as_of), "today").otherwise("future")
    return (
        orders.groupBy(period.alias("delivery_period"), "orderStatus")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("delivery_period", "orderStatus")
    )


def weekly_trend(orders: DataFrame) -> DataFrame:
    return (
        _not_cancelled(orders)
        .groupBy(week_start(F.col("orderDate")).alias("week"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.countDistinct("customerId").alias("unique_customers"),
            money_sum(F.col("totalAmount")).alias("revenue"),
            money_avg(F.col("totalAmount")).alias("avg_order_value"),
        )
        .orderBy("week")
    )


def daily_order_volume(orders: DataFrame, k: int = 30) -> DataFrame:
    return (
        _not_cancelled(orders)
        .groupBy(_day("orderDate").alias("order_day"))
        .agg(F.count(F.lit(1)).alias("orders"), money_sum(F.col("totalAmount")).alias("revenue"))
        .orderBy(F.desc("order_day"))
        .limit(k)
    )


def _live_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Order lines collapsed to (product, order), cancelled orders left out."""
    lines = items.groupBy("orderId", "productId").agg(
        F.sum("quantity").alias("_units"), F.sum(_line()).alias("_value"),
        F.sum(pence(F.col("unitPrice"))).alias("_price"), F.count(F.lit(1)).alias("_n"),
    )
    return lines.join(_not_cancelled(orders).select("orderId"), "orderId", "left_semi")


def popular_products(orders: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    return (
        _live_lines(orders, items)
        .groupBy("productId")
        .agg(
            F.count(F.lit(1)).alias("order_count"),  # rows are already one per product and order
            F.sum("_units").alias("total_quantity"),
            pounds(F.sum("_value")).alias("total_revenue"),
            (ratio(F.sum("_price"), F.sum("_n")) / 100).alias("avg_price"),
        )
        .orderBy(F.desc("order_count"), F.desc("total_revenue"), "productId")
        .limit(k)
    )


def category_order_sales(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _live_lines(orders, items)
        .join(products.select("productId", "category"), "productId")
        .groupBy("category")
        .agg(
            F.countDistinct("orderId").alias("orders"),
            F.sum("_units").alias("units_sold"),
            pounds(F.sum("_value")).alias("revenue"),
        )
    )


def revenue_reconciliation(orders: DataFrame, sales: DataFrame, tolerance: float = 0.01) -> DataFrame:
    ordered = (
        orders.filter(F.col("orderStatus") == "DELIVERED")
        .groupBy(_day("deliveryDate").alias("delivery_day"))
        .agg(F.sum(pence(F.col("totalAmount"))).alias("_o"))
    )
    sold = sales.groupBy(_day("saleDate").alias("delivery_day")).agg(F.sum(_line()).alias("_s"))
    gap = pounds(F.abs(F.col("_o") - F.col("_s")))
    return (
        ordered.join(sold, "delivery_day")
        .select("delivery_day", pounds(F.col("_o")).alias("order_revenue"), pounds(F.col("_s")).alias("sales_revenue"), gap.alias("difference"))
        .filter(F.col("difference") > tolerance)
    )


def delivered_revenue(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("orderStatus") == "DELIVERED").agg(money_sum(F.col("totalAmount")).alias("total_revenue"))


def orders_by_day_status(orders: DataFrame, first: date, last: date) -> DataFrame:
    return (
        orders.filter(in_days("orderDate", first, last))
        .groupBy(_day("orderDate").alias("order_date"), "orderStatus")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("order_date", "orderStatus")
    )


def status_date_ranges(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("orderStatus")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min(_day("deliveryDate")).alias("min_date"),
            F.max(_day("deliveryDate")).alias("max_date"),
        )
        .orderBy("orderStatus")
    )


# --- products in sales ------------------------------------------------------


def top_products_share(sales: DataFrame, products: DataFrame, as_of: date, days: int = 30, k: int = 10) -> DataFrame:
    """Best sellers with their share of all units sold in the window."""
    recent = _last_days(sales, as_of, days)
    collapsed = recent.groupBy("productId", "saleDate").agg(F.sum("quantity").alias("_u"), F.sum(_line()).alias("_v"))
    named = (  # one row per name, for the total and the top k
        collapsed.join(products.select("productId", "name"), "productId")
        .groupBy("name")
        .agg(
            F.countDistinct("saleDate").alias("days_sold"),
            F.sum("_u").alias("total_quantity"),
            pounds(F.sum("_v")).alias("total_revenue"),
        )
    )
    total = named.agg(F.sum(F.col("total_quantity") + reads_all(named))).scalar()
    return (
        named.orderBy(F.desc("total_quantity"), "name")
        .limit(k)
        .withColumn("pct_of_sales", half_up(percent(F.col("total_quantity"), total), 4))
    )


def sales_coverage(sales: DataFrame) -> DataFrame:
    daily = sales.groupBy(_day("saleDate").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return daily.agg(
        F.min("d").alias("first_sale"), F.max("d").alias("last_sale"),
        F.count(F.lit(1)).alias("days_with_sales"), F.sum("n").alias("total_sales"),
    )


def recent_sales_by_day(sales: DataFrame, since: date) -> DataFrame:
    return (
        sales.filter(in_days("saleDate", since))
        .groupBy(_day("saleDate").alias("sale_date"))
        .agg(
            F.count(F.lit(1)).alias("sales_count"),
            F.countDistinct("orderId").alias("order_count"),
            F.countDistinct("customerId").alias("customers"),
        )
        .orderBy("sale_date")
    )


def product_rank_like(products: DataFrame, sales: DataFrame, pattern: str) -> DataFrame:
    """Rank by units among the products whose name matches."""
    named = products.filter(F.col("name").like(pattern)).select("productId", "name")
    sold = (
        sales.join(named.select("productId"), "productId", "left_semi")
        .groupBy("productId")
        .agg(F.countDistinct("saleId").alias("total_sales"), F.sum("quantity").alias("total_units"))
    )
    rows = named.join(sold, "productId", "left").withColumn("total_sales", F.coalesce("total_sales", F.lit(0).cast("long")))
    return with_rank(rows, "total_units", "sales_rank")


def product_performance_with_forecast(
    products: DataFrame, sales: DataFrame, forecasts: DataFrame, first: date, last: date, model: str = "HistoricalPattern"
) -> DataFrame:
    """Sales beside the mean forecast of a window; each side aggregated before the join."""
    sold = sales.groupBy("productId").agg(
        F.countDistinct("orderId").alias("order_count"),
        F.sum("quantity").alias("total_quantity_sold"),
        _sale_revenue().alias("total_revenue_gbp"),
    )
    ahead = (
        forecasts.filter(F.col("target_date").between(F.lit(first), F.lit(last)) & (F.col("model_name") == model))
        .groupBy("productId")
        .agg(F.avg("predicted_quantity").alias("avg_forecast_quantity"))
    )
    return (
        products.select("productId", F.col("name").alias("product_name"), "category")
        .join(sold, "productId", "left")
        .join(ahead, "productId", "left")
        .withColumn("order_count", F.coalesce("order_count", F.lit(0).cast("long")))
    )


def sales_overview(sales: DataFrame) -> DataFrame:
    """Both distinct counts run over (product, sale time) rows, not over raw sales."""
    collapsed = sales.groupBy("productId", "saleDate").agg(
        F.sum("quantity").alias("_u"), F.sum(_line()).alias("_v"), F.count(F.lit(1)).alias("_n")
    )
    return collapsed.agg(
        F.countDistinct("saleDate").alias("sale_days"),
        F.countDistinct("productId").alias("products_sold"),
        F.sum("_u").alias("total_units"),
        pounds(F.sum("_v")).alias("total_revenue"),
        (ratio(F.sum("_v"), F.sum("_n")) / 100).alias("avg_sale_value"),
    )


def daily_sales_items(sales: DataFrame, k: int = 30) -> DataFrame:
    return (
        sales.groupBy(_day("saleDate").alias("sale_day"))
        .agg(
            F.countDistinct("orderId").alias("orders_delivered"),
            F.count(F.lit(1)).alias("items_sold"),
            F.sum("quantity").alias("units_sold"),
            _sale_revenue().alias("revenue"),
        )
        .orderBy(F.desc("sale_day"))
        .limit(k)
    )


def monthly_sales_trend(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(month_start(F.col("saleDate")).alias("month"))
        .agg(
            F.countDistinct("orderId").alias("orders"),
            _sale_revenue().alias("revenue"),
            money_avg(F.col("unitPrice")).alias("avg_price"),
        )
        .orderBy("month")
    )


def top_selling(sales: DataFrame, k: int = 20) -> DataFrame:
    return (
        sales.groupBy("productId")
        .agg(
            F.countDistinct("orderId").alias("orders"),
            F.count(F.lit(1)).alias("times_sold"),
            F.sum("quantity").alias("units_sold"),
            _sale_revenue().alias("revenue"),
            money_avg(F.col("unitPrice")).alias("avg_price"),
        )
        .orderBy(F.desc("revenue"), "productId")
        .limit(k)
    )
