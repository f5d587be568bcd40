"""Stock levels, expiry, cover and stock-out risk."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.classify import temperature_zone
from shelfline.functions.dates import anchor, compact_date, in_days
from shelfline.functions.numbers import half_up, mean_int, percent, pence, pounds, ratio
from shelfline.operators import views
from shelfline.plans.ordering import with_rank


def _available(stock: DataFrame) -> DataFrame:
    return stock.filter(F.col("stock_status") == "AVAILABLE")


def stock_position(stock: DataFrame) -> DataFrame:
    """Available stock and nearest expiry per product."""
    return _available(stock).groupBy("productId").agg(
        F.sum("quantity_in_stock").alias("total_stock"), F.min("expiration_date").alias("nearest_expiry")
    )


def incoming_position(inbound: DataFrame, as_of: date) -> DataFrame:
    """Pending quantity and next delivery per product."""
    return _pending(inbound, as_of).groupBy("productId").agg(
        F.sum("quantity").alias("incoming_stock"), F.min("expected_delivery_date").alias("next_delivery")
    )


def _pending(inbound: DataFrame, as_of: date, days: int | None = None) -> DataFrame:
    due = F.col("expected_delivery_date")
    rows = inbound.filter((F.col("status") == "PENDING") & (due >= anchor(as_of)))
    return rows if days is None else rows.filter(due < anchor(as_of, days))


def _forecast_total(forecasts: DataFrame, as_of: date, days: int) -> DataFrame:
    target = F.col("target_date")
    return (
        forecasts.filter((target >= anchor(as_of)) & (target < anchor(as_of, days)))
        .groupBy("productId")
        .agg(F.sum("predicted_quantity").alias("expected_demand"))
    )


def daily_demand(sales: DataFrame, first: date | Column, before: date | None = None) -> DataFrame:
    """Units per product and sale day from ``first`` on, optionally up to (not including) ``before``."""
    rows = sales.filter(in_days("saleDate", first, None if before is None else before - timedelta(days=1)))
    return rows.groupBy("productId", F.to_date("saleDate").alias("sale_day")).agg(F.sum("quantity").alias("daily_quantity"))


def average_daily_demand(sales: DataFrame, first: date, before: date) -> DataFrame:
    return (
        daily_demand(sales, first, before)
        .groupBy("productId")
        .agg(mean_int(F.col("daily_quantity")).alias("avg_daily_demand"))
    )


# --- capacity and batches ---------------------------------------------------


def stock_capacity(sales: DataFrame, products: DataFrame, shelf_life: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    daily = (
        daily_demand(sales, anchor(as_of, -days))
        .groupBy("productId")
        .agg(
            F.max("daily_quantity").alias("max_daily_sales"),
            mean_int(F.col("daily_quantity")).alias("avg_daily_sales"),
            F.count(F.lit(1)).alias("days_sold"),
        )
    )
    guide = views.product_expiration_guide(products, shelf_life).select(
        "productId", "product_name", "category", "subcategory", "shelf_life_days", "temperature_sensitive", "requires_refrigeration"
    )
    return guide.join(daily, "productId").withColumn("warehouse_capacity", F.col("max_daily_sales") * 2)


# What is left of the oldest and second-oldest batch (middle of 30-70 % and 60-90 %).
_OLDEST_LEFT, _SECOND_LEFT = 0.5, 0.75


def split_into_batches(capacity: DataFrame, skus: DataFrame, as_of: date, max_batches: int = 5) -> DataFrame:
    """Spread a product's capacity over its SKUs as batches of staggered age."""
    counts = skus.groupBy("productId").agg(F.least(F.count(F.lit(1)), F.lit(max_batches)).alias("_batches"))
    order = Window.partitionBy("productId").orderBy("sku")
    # the rank filter becomes a map-side group limit: at most max_batches SKUs of a product are shuffled per task
    placed = (
        skus.select("productId", "sku", F.row_number().over(order).alias("_n"))
        .filter(F.col("_n") <= max_batches)
        .select("productId", "sku", (F.col("_n") - 1).alias("_i"))
    )
    rows = capacity.join(counts, "productId").join(placed, "productId")
    shelf = F.coalesce("shelf_life_days", F.lit(30))
    age = ((F.col("_batches") - F.col("_i") - 1) * F.floor(shelf / F.col("_batches"))).cast("int")
    base = F.floor(F.col("warehouse_capacity") / F.col("_batches"))
    left = F.when(F.col("_i") == 0, _OLDEST_LEFT).when(F.col("_i") == 1, _SECOND_LEFT).otherwise(1.0)
    expiry = F.date_add(F.lit(as_of), (shelf - age).cast("int"))
    return rows.select(
        "sku",
        "productId",
        F.floor(base * left).cast("int").alias("quantity_in_stock"),
        expiry.alias("expiration_date"),
        F.concat_ws("-", F.lit("BATCH"), F.substring("productId", 1, 8), compact_date(expiry)).alias("batch_number"),
        F.date_sub(F.lit(as_of), age).alias("received_date"),
        F.when(F.col("requires_refrigeration"), "CHILLED").otherwise("AMBIENT").alias("temperature_zone"),
        F.lit("AVAILABLE").alias("stock_status"),
    )


def product_zones(products: DataFrame) -> DataFrame:
    return products.select(
        "productId", "name", "category", "subcategory", "supplier_id",
        temperature_zone(F.col("category"), F.col("subcategory")).alias("temp_zone"),
    )


def stock_zone_stats(stock: DataFrame) -> DataFrame:
    return (
        stock.groupBy("temperature_zone")
        .agg(
            F.countDistinct("productId").alias("products"),
            F.countDistinct("sku").alias("skus"),
            F.sum("quantity_in_stock").alias("total_items"),
            half_up(mean_int(F.col("quantity_in_stock")), 1).alias("avg_items_per_sku"),
        )
        .orderBy("temperature_zone")
    )


def expiration_timeline(stock: DataFrame, as_of: date) -> DataFrame:
    """Batches and units in six expiry buckets, nearest first."""
    edges = [("Expired", 0), ("1-3 days", 3), ("4-7 days", 7), ("8-14 days", 14), ("15-30 days", 30)]
    place = F.lit(len(edges) + 1)
    for i, (_, days) in reversed(list(enumerate(edges, start=1))):
        place = F.when(F.col("expiration_date") <= anchor(as_of, days), i).otherwise(place)
    labels = F.array(*[F.lit(name) for name, _ in edges], F.lit("30+ days"))
    return (
        _available(stock)
        .groupBy(place.alias("_place"))
        .agg(F.count(F.lit(1)).alias("num_batches"), F.sum("quantity_in_stock").alias("total_items"))
        .orderBy("_place")
        .select(F.element_at(labels, F.col("_place")).alias("expiration_range"), "num_batches", "total_items")
    )


def stock_of_top_products(stock: DataFrame, products: DataFrame, k: int = 3, n: int = 15) -> DataFrame:
    """Batches of the ``k`` products with most available stock."""
    best = (
        stock_position(stock).orderBy(F.desc("total_stock"), "productId").limit(k).select("productId")
    )
    names = products.select("productId", F.col("name").alias("product"))
    return (
        stock.join(F.broadcast(best), "productId", "left_semi")  # k ids
        .join(names, "productId")
        .select(
            "product", "sku", F.col("quantity_in_stock").alias("qty"), F.col("expiration_date").alias("expires"),
            F.col("batch_number").alias("batch"), F.col("temperature_zone").alias("zone"), "stock_id",
        )
        .orderBy("product", "expires", "sku", "stock_id")
        .limit(n)
    )


# --- inventory report -------------------------------------------------------


def inventory_by_category(stock: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    soon = F.when(F.col("expiration_date") <= anchor(as_of, 7), F.col("quantity_in_stock")).otherwise(0)
    per_sku = (
        _available(stock)
        .groupBy("productId", "sku")
        .agg(
            F.sum("quantity_in_stock").alias("units"),
            F.sum(pence(F.col("purchase_price")) * F.col("quantity_in_stock")).alias("value"),
            F.sum(soon).alias("soon"),
        )
    )
    return (
        per_sku.join(products.select("productId", "category"), "productId")
        .groupBy("category")
        .agg(
            F.countDistinct("productId").alias("num_products"),
            F.countDistinct("sku").alias("num_skus"),
            F.sum("units").alias("total_units"),
            pounds(F.sum("value")).alias("inventory_value"),
            F.sum("soon").alias("expiring_soon"),
        )
        .orderBy(F.desc("inventory_value"), "category")
    )


def low_stock(
    products: DataFrame, stock: DataFrame, forecasts: DataFrame, as_of: date,
    threshold: int = 50, cover_days: int = 3, days: int = 7, k: int | None = 20,
) -> DataFrame:
    """Products below ``threshold`` units or ``cover_days`` of forecast, unknown cover first."""
    ahead = (
        views.latest_forecasts(forecasts)
        .filter(F.col("target_date") <= anchor(as_of, days))
        .groupBy("productId")
        .agg(F.avg("predicted_quantity").alias("demand"))
    )
    held, demand = F.col("total_stock"), F.col("demand")
    cover = F.when(demand > 0, held / demand)
    rows = (
        products.select("productId", F.col("name").alias("product_name"), "category")
        .join(stock_position(stock), "productId", "left")
        .join(ahead, "productId", "left")
        .filter((held < threshold) | (cover < cover_days))
        .select(
            "productId", "product_name", "category",
            F.coalesce(held, F.lit(0).cast("long")).alias("current_stock"),
            F.coalesce(demand, F.lit(0.0)).alias("avg_daily_demand"),
            cover.alias("days_of_stock"),
        )
    )
    return rows if k is None else rows.orderBy(F.asc_nulls_first("days_of_stock"), "productId").limit(k)


def low_stock_pending(products: DataFrame, stock: DataFrame, inbound: DataFrame, as_of: date, threshold: int = 50, k: int | None = 10) -> DataFrame:
    """Low-stock products with what expires this week and their pending delivery dates."""
    held = views.stock_availability(stock, products, as_of).select("productId", "total_quantity", "expiring_week_qty")
    coming = (
        views.pending_deliveries(inbound, products, as_of)
        .groupBy("productId")
        .agg(F.count(F.lit(1)).alias("pending_deliveries"))
    )
    zero = F.lit(0).cast("long")
    rows = (
        products.select("productId", F.col("name").alias("product_name"))
        .join(held, "productId", "left")
        .join(coming, "productId", "left")
        .select(
            "productId", "product_name",
            F.coalesce("total_quantity", zero).alias("current_stock"),
            F.coalesce("expiring_week_qty", zero).alias("expiring_soon"),
            F.coalesce("pending_deliveries", zero).alias("pending_deliveries"),
        )
        .filter(F.col("current_stock") < threshold)
    )
    return rows if k is None else rows.orderBy("current_stock", "productId").limit(k)


def expiring_batches(stock: DataFrame, products: DataFrame, as_of: date, days: int = 7, k: int | None = 20) -> DataFrame:
    rows = (
        _available(stock)
        .filter(F.col("expiration_date") <= anchor(as_of, days))
        .join(products.select("productId", F.col("name").alias("product_name")), "productId")
        .select(
            "product_name", "batch_number", "quantity_in_stock", "expiration_date",
            F.datediff("expiration_date", anchor(as_of)).alias("days_until_expiry"), "stock_id",
        )
    )
    return rows if k is None else rows.orderBy("expiration_date", "stock_id", "batch_number").limit(k)


def inventory_report_summary(products: DataFrame, stock: DataFrame, forecasts: DataFrame, as_of: date, k: int | None = None) -> DataFrame:
    """One row of report totals; with ``k`` the two product counts are those of the report's top-``k`` lists."""
    from shelfline.plans.reports import beside

    totals = inventory_by_category(stock, products, as_of).agg(
        F.sum("inventory_value").alias("total_inventory_value"),
        F.sum("total_units").alias("total_units_in_stock"),
        F.sum("expiring_soon").alias("units_expiring_soon"),
    )
    low = low_stock(products, stock, forecasts, as_of, k=k).agg(F.count(F.lit(1)).alias("products_with_low_stock"))
    soon = expiring_batches(stock, products, as_of, k=k).agg(F.count(F.lit(1)).alias("products_expiring_soon"))
    return beside(totals, low, soon)


# --- cover and risk ---------------------------------------------------------


def two_day_cover(products: DataFrame, sales: DataFrame, stock: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    recent = (
        daily_demand(sales, anchor(as_of, -days))
        .groupBy("productId")
        .agg(mean_int(F.col("daily_quantity")).alias("avg"))
        .filter(F.col("avg") > 0)
    )
    held = F.coalesce("total_stock", F.lit(0).cast("long"))
    return (
        products.select("productId", F.col("name").alias("product_name"), "category", "subcategory")
        .join(recent, "productId")
        .join(stock_position(stock), "productId", "left")
        .select(
            "productId", "product_name", "category", "subcategory",
            held.alias("current_stock"),
            half_up(F.col("avg"), 2).alias("avg_daily_sales"),
            half_up(F.col("avg") * 2, 2).alias("needed_for_2_days"),
            F.when(held >= F.col("avg") * 2, "SUFFICIENT").when(held > 0, "LOW").otherwise("OUT_OF_STOCK").alias("stock_status"),
            half_up(held / F.col("avg"), 1).alias("days_of_stock_remaining"),
            F.col("nearest_expiry").alias("earliest_expiration"),
        )
    )


def order_two_day_cover(cover: DataFrame) -> DataFrame:
    """Out of stock first, then low, then sufficient; heavier sellers first within each."""
    status = F.col("stock_status")
    place = F.when(status == "OUT_OF_STOCK", 1).when(status == "LOW", 2).otherwise(3)
    return cover.orderBy(place, F.desc("avg_daily_sales"), "productId")


def stockout_risk(
    products: DataFrame, sales: DataFrame, stock: DataFrame, inbound: DataFrame, as_of: date, history: int = 14, ahead: int = 2
) -> DataFrame:
    demand = (
        daily_demand(sales, anchor(as_of, -history))
        .groupBy("productId")
        .agg(
            mean_int(F.col("daily_quantity")).alias("avg"),
            F.max("daily_quantity").alias("peak"),
            F.stddev_samp("daily_quantity").alias("spread"),
        )
        .filter(F.col("avg") > 0)
    )
    soon = F.when(F.col("expiration_date") <= anchor(as_of, ahead), F.col("quantity_in_stock")).otherwise(0)
    levels = _available(stock).groupBy("productId").agg(
        F.sum("quantity_in_stock").alias("held"), F.sum(soon).alias("expiring_in_2_days")
    )
    coming = (
        inbound.filter(F.col("status").isin("PENDING", "SHIPPED") & (F.col("expected_delivery_date") <= anchor(as_of, ahead)))
        .groupBy("productId")
        .agg(F.sum("quantity").alias("incoming"), F.min("expected_delivery_date").alias("next_delivery"))
    )
    zero = F.lit(0).cast("long")
    held, avg, peak = F.coalesce("held", zero), F.col("avg"), F.col("peak")
    return (
        products.select("productId", F.col("name").alias("product_name"), "category", "subcategory")
        .join(demand, "productId")
        .join(levels, "productId", "left")
        .join(coming, "productId", "left")
        .filter((held < peak * ahead) | (F.col("expiring_in_2_days") > 0))
        .select(
            "productId", "product_name", "category", "subcategory",
            held.alias("current_stock"),
            half_up(avg, 2).alias("avg_daily_demand"),
            half_up(peak, 2).alias("peak_daily_demand"),
            half_up(F.col("spread"), 2).alias("demand_stddev"),
            half_up(avg * ahead, 2).alias("expected_2day_demand"),
            half_up(peak * ahead, 2).alias("peak_2day_demand"),
            half_up(held - half_up(avg * ahead, 2), 2).alias("stock_surplus_deficit"),
            F.coalesce("incoming", zero).alias("incoming_stock"),
            "next_delivery",
            "expiring_in_2_days",
            F.when(held < avg * ahead, "HIGH_RISK").when(held < peak * ahead, "MEDIUM_RISK").otherwise("LOW_RISK").alias("risk_level"),
            half_up(held / avg, 1).alias("days_of_coverage"),
        )
    )


def order_stockout_risk(risk: DataFrame) -> DataFrame:
    level = F.col("risk_level")
    place = F.when(level == "HIGH_RISK", 1).when(level == "MEDIUM_RISK", 2).otherwise(3)
    return risk.orderBy(place, "stock_surplus_deficit", "productId")


def stock_health(products: DataFrame, sales: DataFrame, stock: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Products, low, out of stock and share at risk, overall and per category."""
    recent = (
        daily_demand(sales, anchor(as_of, -days))
        .groupBy("productId")
        .agg(mean_int(F.col("daily_quantity")).alias("avg"))
        .filter(F.col("avg") > 0)
    )
    cover = F.coalesce("total_stock", F.lit(0).cast("long")) / F.col("avg")
    rows = products.select("productId", "category").join(recent, "productId").join(stock_position(stock), "productId", "left")
    rows = rows.select("category", (cover < 2).alias("low"), (cover == 0).alias("out"))
    total = F.count(F.lit(1))
    return (
        rows.rollup("category")
        .agg(
            F.grouping("category").alias("_all"),
            total.alias("total_products"),
            F.count_if("low").alias("products_low_stock"),
            F.count_if("out").alias("products_out_of_stock"),
            half_up(percent(F.count_if("low"), total), 2).alias("pct_at_risk"),
        )
        .filter((F.col("_all") == 0) | (F.col("total_products") > 0))
        .withColumn("category", F.when(F.col("_all") == 1, "Overall").otherwise(F.col("category")))
        .orderBy(F.desc("_all"), F.desc("pct_at_risk"), "category")
        .drop("_all")
    )


def stockout_date(products: DataFrame, stock: DataFrame, forecasts: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    target = F.col("target_date")
    ahead = (
        forecasts.filter(target.between(anchor(as_of), anchor(as_of, days)))
        .groupBy("productId")
        .agg(F.avg("predicted_quantity").alias("demand"))
    )
    held = F.coalesce("total_stock", F.lit(0).cast("long"))
    demand = F.coalesce("demand", F.lit(0.0))
    left = F.coalesce(ratio(held, demand), F.lit(999.0))
    return (
        products.select("productId", F.col("name").alias("product_name"))
        .join(stock_position(stock), "productId", "left")
        .join(ahead, "productId", "left")
        .select(
            "productId", "product_name",
            held.alias("current_stock"),
            half_up(demand, 2).alias("avg_daily_demand"),
            half_up(left, 1).alias("days_until_stockout"),
            F.when(demand != 0, F.date_add(F.lit(as_of), F.bround(ratio(held, demand)).cast("int"))).alias("estimated_stockout_date"),
            F.when(left <= 1, "CRITICAL").when(left <= 3, "HIGH_RISK").when(left <= 7, "MEDIUM_RISK").otherwise("LOW_RISK").alias("risk_level"),
        )
    )


def nearest_expiry(stock: DataFrame, products: DataFrame, as_of: date) -> DataFrame:
    """The first batch to expire of every product; combinable, so no per-product sort."""
    batch = F.struct("expiration_date", "sku", "stock_id", "quantity_in_stock")
    first = (
        _available(stock)
        .filter(F.col("quantity_in_stock") > 0)
        .groupBy("productId")
        .agg(F.min(batch).alias("b"))
    )
    expiry = F.col("b.expiration_date")
    return products.select("productId", F.col("name").alias("product_name")).join(first, "productId").select(
        "productId", "product_name",
        F.col("b.sku").alias("sku"),
        F.col("b.quantity_in_stock").alias("quantity_in_stock"),
        expiry.alias("expiration_date"),
        F.datediff(expiry, anchor(as_of)).alias("days_until_expiration"),
        F.when(expiry <= anchor(as_of), "EXPIRED")
        .when(expiry <= anchor(as_of, 3), "EXPIRING_SOON")
        .when(expiry <= anchor(as_of, 7), "WARNING")
        .otherwise("OK")
        .alias("expiration_status"),
    )


def _positions(products: DataFrame, stock: DataFrame, forecasts: DataFrame, inbound: DataFrame, as_of: date, n_days: int) -> DataFrame:
    coming = _pending(inbound, as_of, n_days).groupBy("productId").agg(F.sum("quantity").alias("incoming"))
    zero = F.lit(0).cast("long")
    held, incoming = F.coalesce("total_stock", zero), F.coalesce("incoming", zero)
    demand = F.coalesce("expected_demand", F.lit(0.0))
    return (
        products.select("productId", F.col("name").alias("product_name"), "category")
        .join(stock_position(stock), "productId", "left")
        .join(_forecast_total(forecasts, as_of, n_days), "productId", "left")
        .join(coming, "productId", "left")
        .select(
            "productId", "product_name", "category",
            held.alias("current_stock"),
            incoming.alias("incoming_stock"),
            demand.alias("expected_demand"),
            (held + incoming - demand).alias("net_position"),
        )
    )


def sufficient_stock(products: DataFrame, stock: DataFrame, forecasts: DataFrame, inbound: DataFrame, as_of: date, n_days: int = 3) -> DataFrame:
    return _positions(products, stock, forecasts, inbound, as_of, n_days).select(
        "productId", "product_name", "current_stock", "incoming_stock",
        (F.col("current_stock") + F.col("incoming_stock")).alias("total_available"),
        "expected_demand",
        F.when(F.col("net_position") >= 0, "YES").otherwise("NO").alias("sufficient_stock"),
        F.col("net_position").alias("surplus_or_shortage"),
    )


def next_delivery(inbound: DataFrame, products: DataFrame, purchase_orders: DataFrame, suppliers: DataFrame, as_of: date) -> DataFrame:
    line = F.struct("expected_delivery_date", "delivery_id", "po_id", "sku", "quantity")
    first = _pending(inbound, as_of).groupBy("productId").agg(F.min(line).alias("d")).select("productId", "d.*")
    heads = purchase_orders.select("po_id", "supplier_id")
    return (
        first.join(products.select("productId", F.col("name").alias("product_name")), "productId")
        .join(heads, "po_id")
        .join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .select(
            "productId", "product_name", "delivery_id", "expected_delivery_date",
            F.datediff("expected_delivery_date", anchor(as_of)).alias("days_until_delivery"),
            F.col("quantity").alias("incoming_quantity"),
            "sku", "po_id", "supplier_id", "supplier_name",
        )
    )


def risk_list(products: DataFrame, stock: DataFrame, forecasts: DataFrame, inbound: DataFrame, as_of: date, n_days: int = 3, k: int | None = 50) -> DataFrame:
    net, demand = F.col("net_position"), F.col("expected_demand")
    rows = (
        _positions(products, stock, forecasts, inbound, as_of, n_days)
        .filter(net < demand * 0.5)
        .withColumn(
            "risk_status",
            F.when(net < 0, "STOCKOUT").when(net == 0, "ZERO_STOCK").when(net < demand * 0.2, "CRITICAL_LOW").otherwise("LOW_STOCK"),
        )
    )
    return rows if k is None else rows.orderBy("net_position", F.desc("expected_demand"), "productId").limit(k)


def emergency_orders(risk: DataFrame, calendar: DataFrame) -> DataFrame:
    """Deficits with the supplier and lead time each could be ordered from."""
    routes = calendar.select("productId", "supplier_id", "lead_time_days").distinct()
    return risk.filter(F.col("net_position") < 0).join(routes, "productId").select(
        "productId", "product_name", F.abs("net_position").alias("units_needed"), "supplier_id", "lead_time_days"
    )


def replenishment_needs(forecasts: DataFrame, products: DataFrame, stock: DataFrame, first: date, last: date, buffer: float = 1.2) -> DataFrame:
    """Demand of the latest run in a window beyond ``buffer`` times the stock."""
    latest_run = forecasts.agg(F.max("run_id")).scalar()
    demand = (
        forecasts.filter(F.col("target_date").between(F.lit(first), F.lit(last)) & (F.col("run_id") == latest_run))
        .groupBy("productId")
        .agg(F.sum("predicted_quantity").alias("total_demand"))
    )
    held = stock.filter(F.col("quantity_in_stock") > 0).groupBy("productId").agg(F.sum("quantity_in_stock").alias("held"))
    current = F.coalesce("held", F.lit(0).cast("long"))
    return (
        demand.join(products.select("productId", F.col("name").alias("product_name")), "productId")
        .join(held, "productId", "left")
        .filter(F.col("total_demand") > current * buffer)
        .select(
            "productId", "product_name", "total_demand", current.alias("current_stock"),
            (F.col("total_demand") - current).alias("units_needed"),
        )
    )


# --- deliveries in the warehouse --------------------------------------------


def received_summary(inbound: DataFrame, day: date) -> DataFrame:
    return (
        inbound.filter(F.col("actual_delivery_date") == F.lit(day))
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.sum("quantity").alias("total_units"),
            pounds(F.sum(pence(F.col("unit_cost")) * F.col("quantity"))).alias("total_value"),
        )
    )


def upcoming_deliveries(inbound: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    due = F.col("expected_delivery_date")
    return (
        inbound.filter((F.col("status") == "PENDING") & (due > anchor(as_of)) & (due <= anchor(as_of, days)))
        .groupBy("expected_delivery_date")
        .agg(F.count(F.lit(1)).alias("num_deliveries"), F.sum("quantity").alias("total_units"))
        .orderBy("expected_delivery_date")
    )


def capacity_breaches(lines: DataFrame, products: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """Days on which a zone would take in more than it can."""
    from shelfline.functions.reference import ZONE_CAPACITY

    limits = ZONE_CAPACITY if limits is None else limits
    category = F.col("category")
    zone = F.when(category == "Chilled Food", "CHILLED").when(category == "Frozen Food", "FROZEN").otherwise("AMBIENT")
    table = F.create_map(*[lit for name, units in limits.items() for lit in (F.lit(name), F.lit(units))])
    per_product = lines.groupBy("productId", "expected_delivery_date").agg(F.sum("quantity").alias("q"))
    return (
        per_product.join(products.select("productId", "category"), "productId")
        .groupBy("expected_delivery_date", zone.alias("temp_zone"))
        .agg(F.sum("q").alias("total_quantity"))
        .filter(F.col("total_quantity") > F.try_element_at(table, F.col("temp_zone")))
    )


def supplier_performance(inbound: DataFrame, purchase_orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Deliveries, lateness, on-time rank and grade per supplier."""
    late = F.col("actual_delivery_date") > F.col("expected_delivery_date")
    per_order = (
        inbound.filter(F.col("actual_delivery_date").isNotNull())
        .groupBy("po_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"))
    )
    per_supplier = (
        per_order.join(purchase_orders.select("po_id", "supplier_id"), "po_id")
        .groupBy("supplier_id")
        .agg(F.sum("n").alias("total_deliveries"), F.sum("late").alias("late_deliveries"))
        .withColumn("on_time_pct", percent(F.col("total_deliveries") - F.col("late_deliveries"), F.col("total_deliveries")))
    )
    on_time = F.col("on_time_pct")
    return with_rank(per_supplier, "on_time_pct", "rank").join(
        suppliers.select("supplier_id", "supplier_name"), "supplier_id"
    ).select(
        "rank", "supplier_id", "supplier_name", "total_deliveries", "late_deliveries",
        half_up(on_time, 2).alias("on_time_pct"),
        F.when(on_time >= 90, "good").when(on_time >= 85, "watch").otherwise("poor").alias("grade"),
    )


def late_products(inbound: DataFrame, products: DataFrame, min_deliveries: int = 5, k: int = 10) -> DataFrame:
    late = F.col("actual_delivery_date") > F.col("expected_delivery_date")
    per_product = (
        inbound.filter(F.col("status") == "DELIVERED")
        .groupBy("productId")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"))
    )
    return (
        per_product.join(products.select("productId", F.col("name").alias("product_name")), "productId")
        .groupBy("product_name")
        .agg(F.sum("n").alias("total_deliveries"), F.sum("late").alias("late_deliveries"))
        .filter(F.col("total_deliveries") >= min_deliveries)
        .withColumn("late_pct", half_up(percent(F.col("late_deliveries"), F.col("total_deliveries")), 1))
        .orderBy(F.desc("late_pct"), "product_name")
        .limit(k)
    )
