"""Supplier calendars, order quantities, purchase orders and goods receipt."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import reference as ref
from shelfline.functions.classify import minimum_order, order_multiple, size_bound, temperature_zone, volume_class
from shelfline.functions.dates import anchor, business_days, compact_date
from shelfline.functions.numbers import ceil_to_multiple, half_up, mean_int, pence, percent, pounds, stable_hash
from shelfline.operators import views
from shelfline.plans.ordering import cut_lineage, number_rows


# --- calendars --------------------------------------------------------------


def business_calendar(spans: DataFrame, first: str, last: str, holidays: list[date]) -> DataFrame:
    """Business days between the earliest ``first`` and latest ``last`` date of ``spans``."""
    closed = F.array(*[F.lit(h) for h in holidays]) if holidays else F.array().cast("array<date>")
    return (
        spans.agg(F.min(F.to_date(first)).alias("a"), F.max(F.to_date(last)).alias("b"))
        .select(F.explode(F.sequence("a", "b")).alias("business_day"))
        .filter((F.weekday("business_day") < 5) & ~F.array_contains(closed, F.col("business_day")))
    )


def default_lead_time(key: Column) -> Column:
    """Lead time by a stable draw over the published shares."""
    draw, reached, ladder = stable_hash(key) % 100, 0, None
    for days, share in ref.LEAD_TIME_SHARES.items():
        reached += share
        ladder = (F if ladder is None else ladder).when(draw < reached, days)
    return ladder.cast("int")


def supplier_schedule(
    suppliers: DataFrame, first: date, last: date, holidays: list[date], lead_time: Column | None = None
) -> DataFrame:
    """Every supplier's deliveries on business days, with the order cut-off a lead time earlier.

    The calendar is one small array expression, so the whole schedule is a
    map over suppliers: no calendar join, no day-by-day walk. It starts early
    enough for each supplier's own lead time: two calendar days for each of
    its business days, and one for each holiday.
    """
    lead = default_lead_time(F.col("supplier_id")) if lead_time is None else lead_time
    earlier = F.greatest(F.coalesce(lead, F.lit(0)), F.lit(0)).cast("int") * 2 + (len(holidays) + 7)
    calendar = business_days(F.date_sub(F.lit(first), earlier), last, holidays)
    slots = F.transform(
        F.col("_days"),
        lambda d, i: F.struct(d.alias("delivery_date"), F.get(F.col("_days"), i - F.col("lead_time_days")).alias("po_cutoff_date")),
    )
    return (
        suppliers.select("supplier_id", lead.alias("lead_time_days"), calendar.alias("_days"))
        .select("supplier_id", "lead_time_days", F.explode(slots).alias("_slot"))
        .filter(F.col("_slot.delivery_date") >= F.lit(first))
        .select(
            "supplier_id",
            F.col("_slot.delivery_date").alias("delivery_date"),
            F.col("_slot.po_cutoff_date").alias("po_cutoff_date"),
            F.lit(ref.PO_CUTOFF_TIME).alias("po_cutoff_time"),
            "lead_time_days",
        )
    )


def lead_time_distribution(suppliers: DataFrame, lead_time: Column | None = None) -> DataFrame:
    lead = default_lead_time(F.col("supplier_id")) if lead_time is None else lead_time
    counted = suppliers.groupBy(lead.alias("lead_time_days")).agg(F.count(F.lit(1)).alias("suppliers"))
    share = percent(F.col("suppliers"), F.sum("suppliers").over(Window.partitionBy()))  # one row per lead time
    return counted.withColumn("percentage", half_up(share, 1)).orderBy("lead_time_days")


def schedule_window(schedules: DataFrame, suppliers: DataFrame, first: date, last: date, supplier_ids: list[int] | None = None) -> DataFrame:
    rows = schedules.filter(F.col("delivery_date").between(F.lit(first), F.lit(last)))
    if supplier_ids is not None:
        rows = rows.filter(F.col("supplier_id").isin(supplier_ids))
    return rows.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id").select(
        "supplier_name", "delivery_date", "po_cutoff_date", "po_cutoff_time", "lead_time_days"
    )


def next_valid_delivery(schedules: DataFrame, as_of: date) -> DataFrame:
    """Per supplier, the first delivery an order placed today can still make."""
    reachable = F.col("delivery_date") >= F.date_add(F.lit(as_of), F.col("lead_time_days"))
    return (
        schedules.filter(reachable & (F.col("po_cutoff_date") >= anchor(as_of)))
        .groupBy("supplier_id")
        .agg(F.min("delivery_date").alias("next_delivery"))
    )


def ordering_calendar(
    products: DataFrame, schedules: DataFrame, shelf_life: DataFrame, as_of: date, seed: Column | None = None
) -> DataFrame:
    """Ordering opportunities: each product on each of its supplier's delivery days.

    The following delivery is looked up on the supplier schedule, where a
    group has one row per calendar day, and not on the product fan-out.
    """
    by_day = Window.partitionBy("supplier_id").orderBy("delivery_date")
    days = schedules.filter(F.col("delivery_date") >= anchor(as_of)).select(
        "supplier_id", "delivery_date", "po_cutoff_date", "lead_time_days",
        F.lead("delivery_date").over(by_day).alias("next_atp_delivery_date"),
    )
    life = shelf_life.select("category", "subcategory", "shelf_life_days")
    draw = stable_hash("productId") if seed is None else seed
    rules = products.join(life, ["category", "subcategory"], "left").select(
        "productId",
        "supplier_id",
        F.coalesce("shelf_life_days", F.lit(14)).alias("_life"),
        minimum_order(F.col("category"), draw).alias("min_order_quantity"),
        order_multiple(F.col("category")).alias("order_multiple"),
    )
    return rules.join(days, "supplier_id").select(
        "productId",
        "supplier_id",
        F.col("po_cutoff_date").alias("order_date"),
        F.col("delivery_date").alias("atp_delivery_date"),
        "next_atp_delivery_date",
        F.date_add("delivery_date", F.col("_life").cast("int")).alias("purge_date"),
        F.lit(2).alias("contingency_days_in_advance"),
        F.lit(4).alias("contingency_days_of_demand"),
        "lead_time_days",
        "min_order_quantity",
        "order_multiple",
        F.lit(True).alias("is_active"),
    )


def calendar_stats(calendar: DataFrame) -> DataFrame:
    return calendar.filter("is_active").agg(
        F.countDistinct("productId").alias("unique_products"),
        F.countDistinct("supplier_id").alias("unique_suppliers"),
        F.count(F.lit(1)).alias("total_entries"),
        F.min("order_date").alias("earliest_order"),
        F.max("order_date").alias("latest_order"),
        mean_int(F.col("lead_time_days")).alias("avg_lead_time"),
    )


def next_opportunities(calendar: DataFrame, products: DataFrame, suppliers: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` earliest active slots of known products and suppliers."""
    first = (
        calendar.filter("is_active")
        .join(products.select("productId"), "productId", "left_semi")
        .join(suppliers.select("supplier_id"), "supplier_id", "left_semi")
        .orderBy("order_date", "atp_delivery_date", "productId")
        .limit(k)
    )
    return (
        first.join(products.select("productId", "name"), "productId")
        .join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .select("productId", "name", "supplier_name", "order_date", "atp_delivery_date", "min_order_quantity")
    )


# --- quantities -------------------------------------------------------------


def order_quantity(
    rule: str,
    demand: Column,
    stock: Column,
    minimum: Column,
    multiple: Column,
    in_transit: Column | None = None,
    contingency_days: Column | None = None,
) -> Column:
    """Units to order.

    ``weekly``: a week of demand plus three days of safety stock, less stock.
    ``net``: requirement less stock and goods in transit.
    ``contingency``: daily demand over the contingency days, less stock, at least the minimum.
    """
    if rule == "weekly":
        need = demand + demand / 7 * 3 - stock
        wanted = F.greatest(need.cast("double"), minimum.cast("double"))
        rounded = F.when(multiple > 1, ceil_to_multiple(wanted, multiple)).otherwise(F.floor(wanted))
        return F.when(need <= 0, 0).otherwise(rounded).cast("long")
    if rule == "net":
        need = demand - stock - (F.lit(0) if in_transit is None else in_transit)
        return F.when(need <= 0, 0).when(need < minimum, minimum).otherwise(ceil_to_multiple(need, multiple)).cast("long")
    if rule == "contingency":
        days = F.lit(1) if contingency_days is None else contingency_days
        return F.greatest(minimum, ceil_to_multiple(demand * days - stock, multiple)).cast("long")
    raise ValueError(f"unknown rule {rule!r}")


def order_requirements(
    calendar: DataFrame, forecasts: DataFrame, stock: DataFrame, inbound: DataFrame, first: date, last: date, delivery: date
) -> DataFrame:
    """Gross and net requirement of each opportunity that delivers on ``delivery``."""
    demand = (
        forecasts.filter(F.col("target_date").between(F.lit(first), F.lit(last)))
        .groupBy("productId")
        .agg(F.sum("predicted_quantity").alias("d"))
    )
    held = stock.filter(F.col("stock_status") == "AVAILABLE").groupBy("productId").agg(F.sum("quantity_in_stock").alias("s"))
    moving = inbound.filter(F.col("status") == "PENDING").groupBy("productId").agg(F.sum("quantity").alias("t"))
    zero = F.lit(0).cast("long")
    gross = F.col("d") * F.col("contingency_days_of_demand")
    held_now, in_transit = F.coalesce("s", zero), F.coalesce("t", zero)
    return (
        calendar.filter(F.col("atp_delivery_date") == F.lit(delivery))
        .join(demand, "productId")
        .join(held, "productId", "left")
        .join(moving, "productId", "left")
        .select(
            "productId", "supplier_id", "atp_delivery_date",
            gross.alias("gross_requirement"), held_now.alias("current_stock"), in_transit.alias("in_transit"),
            (gross - held_now - in_transit).alias("net_requirement"),
            order_quantity("net", gross, held_now, F.col("min_order_quantity"), F.col("order_multiple"), in_transit).alias("order_quantity"),
        )
    )


def order_opportunities(
    calendar: DataFrame, products: DataFrame, suppliers: DataFrame, stock: DataFrame, forecasts: DataFrame,
    as_of: date, days: int = 3, default_demand: float = 100.0,
) -> DataFrame:
    """Active calendar rows to be ordered in the coming days, with stock and weekly demand."""
    target = F.col("target_date")
    weekly = (
        views.latest_forecasts(forecasts)
        .filter(target.between(anchor(as_of), anchor(as_of, 7)))
        .groupBy("productId")
        .agg(F.sum("predicted_quantity").alias("w"))
    )
    held = views.stock_availability(stock, products, as_of).select("productId", "total_quantity", "expiring_week_qty")
    due = calendar.filter(F.col("order_date").between(anchor(as_of), anchor(as_of, days)) & F.col("is_active"))
    zero = F.lit(0).cast("long")
    return (
        due.join(products.select("productId", F.col("name").alias("product_name"), "price_pence"), "productId")
        .join(suppliers.select("supplier_id", "supplier_name"), "supplier_id")
        .join(held, "productId", "left")
        .join(weekly, "productId", "left")
        .select(
            *[due[c] for c in ("productId", "supplier_id", "order_date", "atp_delivery_date", "purge_date", "min_order_quantity", "order_multiple")],
            "product_name", "price_pence", "supplier_name",
            F.coalesce("total_quantity", zero).alias("current_stock"),
            F.coalesce("expiring_week_qty", zero).alias("expiring_soon"),
            F.coalesce("w", F.lit(default_demand)).alias("weekly_demand"),
        )
    )


def with_order_quantity(opportunities: DataFrame) -> DataFrame:
    return opportunities.withColumn(
        "order_quantity",
        order_quantity("weekly", F.col("weekly_demand"), F.col("current_stock"), F.col("min_order_quantity"), F.col("order_multiple")),
    )


# --- purchase orders --------------------------------------------------------


def purchase_orders(opportunities: DataFrame, cost_factor: str = "0.70", start: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Purchase-order headers and delivery lines, one order per order date and supplier.

    Orders and lines are numbered in (order date, supplier, product) order
    without gathering them: see ``plans.ordering.number_rows``.
    """
    factor = F.lit(Decimal(cost_factor))
    needed = ["order_date", "supplier_id", "productId", "atp_delivery_date", "purge_date", "price_pence", "order_quantity"]
    sized = with_order_quantity(opportunities).select(*needed, F.monotonically_increasing_id().alias("_row"))
    sized = cut_lineage(sized)  # for the headers, the numbers and the lines; ``_row`` is written with it
    heads = number_rows(
        sized.groupBy("order_date", "supplier_id").agg(F.min(F.struct("productId", "atp_delivery_date")).alias("_first")),
        ["order_date", "supplier_id"], "_po", start=start,
    ).select(
        "order_date", "supplier_id", F.col("_first.atp_delivery_date").alias("expected_delivery_date"),
        F.concat_ws("_", F.lit("PO"), compact_date(F.col("order_date")), F.col("_po").cast("string")).alias("po_id"),
    )
    lines = number_rows(
        sized.filter(F.col("order_quantity") > 0),
        ["order_date", "supplier_id", "productId", "atp_delivery_date"], "_line", start=start, key=["_row"],
    )
    # several delivery days of one product in one order: at most the days of a calendar window
    batch = F.row_number().over(Window.partitionBy("order_date", "supplier_id", "productId").orderBy("atp_delivery_date"))
    arrival = F.col("atp_delivery_date")
    shelf = F.floor(F.datediff("purge_date", arrival) * 4 / 5).cast("int")
    padded = F.lpad(F.col("_batch").cast("string"), 3, "0")
    lines = (
        lines.withColumn("_batch", batch)
        .join(heads.select("order_date", "supplier_id", "po_id"), ["order_date", "supplier_id"])
        .select(
            F.concat_ws("_", F.lit("DEL"), compact_date(F.col("order_date")), F.col("_line").cast("string")).alias("delivery_id"),
            "po_id",
            "productId",
            F.concat_ws("-", "productId", compact_date(arrival), padded).alias("sku"),
            F.col("order_quantity").alias("quantity"),
            F.round(F.col("price_pence").cast("decimal(10,0)") * factor / F.lit(100), 2).cast("decimal(10,2)").alias("unit_cost"),
            arrival.alias("expected_delivery_date"),
            F.lit(None).cast("date").alias("actual_delivery_date"),
            F.date_add(arrival, shelf).alias("expiration_date"),
            F.concat_ws("_", F.lit("BATCH"), compact_date(arrival), padded).alias("batch_number"),
            F.lit("PENDING").alias("status"),
            (F.col("price_pence").cast("long") * F.col("order_quantity")).alias("_full_pence"),
        )
    )
    totals = lines.groupBy("po_id").agg(
        F.sum("quantity").alias("total_items"),
        F.round(F.sum("_full_pence").cast("decimal(20,0)") * factor / F.lit(100), 2).cast("decimal(20,2)").alias("total_amount"),
    )
    headers = heads.join(totals, "po_id").select(
        "po_id", "supplier_id", "order_date", "expected_delivery_date", F.lit("PENDING").alias("po_status"), "total_items", "total_amount"
    )
    return headers, lines.drop("_full_pence")


def po_rollup(lines: DataFrame) -> DataFrame:
    """Purchase-order headers from delivery lines that carry supplier and order date."""
    return lines.groupBy("po_id").agg(
        F.min("supplier_id").alias("supplier_id"),
        F.min("order_date").alias("order_date"),
        F.min("expected_delivery_date").alias("expected_delivery_date"),
        F.when(F.count_if(F.col("status") == "PENDING") > 0, "PENDING").otherwise("DELIVERED").alias("po_status"),
        F.sum("quantity").alias("total_items"),
        pounds(F.sum(pence(F.col("unit_cost")) * F.col("quantity"))).alias("total_amount"),
    )


def po_summary_by_date(orders: DataFrame, first: date, last: date) -> DataFrame:
    return (
        orders.filter(F.col("order_date").between(F.lit(first), F.lit(last)))
        .groupBy("order_date")
        .agg(
            F.countDistinct("po_id").alias("num_pos"),
            F.countDistinct("supplier_id").alias("num_suppliers"),
            F.sum("total_items").alias("total_units"),
            pounds(F.sum(pence(F.col("total_amount")))).alias("total_value"),
        )
        .orderBy("order_date")
    )


def top_ordered(lines: DataFrame, orders: DataFrame, products: DataFrame, first: date, last: date, k: int = 10) -> DataFrame:
    chosen = orders.filter(F.col("order_date").between(F.lit(first), F.lit(last))).select("po_id")
    per_product = (
        lines.join(chosen, "po_id", "left_semi")
        .groupBy("productId", "po_id")
        .agg(F.sum("quantity").alias("q"), F.sum(pence(F.col("unit_cost")) * F.col("quantity")).alias("v"))
    )
    return (
        per_product.join(products.select("productId", F.col("name").alias("product_name")), "productId")
        .groupBy("product_name")
        .agg(
            F.countDistinct("po_id").alias("num_orders"),
            F.sum("q").alias("total_quantity"),
            pounds(F.sum("v")).alias("total_value"),
        )
        .orderBy(F.desc("total_value"), "product_name")
        .limit(k)
    )


def delivery_schedule(lines: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    return (
        lines.filter(F.col("expected_delivery_date").between(anchor(as_of), anchor(as_of, days)))
        .groupBy("expected_delivery_date")
        .agg(
            F.countDistinct("po_id").alias("num_pos"),
            F.count(F.lit(1)).alias("num_deliveries"),
            F.sum("quantity").alias("total_units"),
        )
        .orderBy("expected_delivery_date")
    )


def register_new_skus(lines: DataFrame, skus: DataFrame) -> DataFrame:
    """SKU map rows for delivery SKUs that the map does not have yet."""
    return (
        lines.select("productId", "sku")
        .distinct()
        .join(skus.select("sku"), "sku", "left_anti")
        .select(
            "productId", "sku",
            F.expr("substring(sku, length(productId) + 2)").alias("sku_suffix"),
            F.lit(False).alias("is_primary"),
        )
    )


def receive_deliveries(
    inbound: DataFrame, products: DataFrame, orders: DataFrame, stock: DataFrame, as_of: date, rejected: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Book due deliveries into stock.

    ``rejected`` names the delivery_ids turned away. Returns the new stock
    rows and the updated ``inbound_deliveries`` and ``purchase_orders``.
    """
    due = (F.col("status") == "PENDING") & (F.col("expected_delivery_date") <= anchor(as_of))
    refused = inbound.sparkSession.createDataFrame([], "delivery_id string") if rejected is None else rejected
    refused = refused.select("delivery_id").distinct().withColumn("_refused", F.lit(True))
    marked = inbound.join(refused, "delivery_id", "left")
    outcome = F.when(F.col("_refused"), "REJECTED").otherwise("RECEIVED")
    updated = marked.withColumn("_due", due)
    updated = (
        updated.withColumn("status", F.when(F.col("_due"), outcome).otherwise(F.col("status")))
        .withColumn("actual_delivery_date", F.when(F.col("_due"), F.lit(as_of)).otherwise(F.col("actual_delivery_date")))
    )

    about = products.select("productId", temperature_zone(F.col("category"), F.col("subcategory")).alias("temperature_zone"))
    arrived = (
        updated.filter(F.col("_due") & (F.col("status") == "RECEIVED"))
        .drop("supplier_id", "order_date")
        .join(about, "productId")
        .join(orders.select("po_id", "supplier_id"), "po_id")
    )
    next_id = F.coalesce(stock.agg(F.max("stock_id")).scalar(), F.lit(0)) + 1
    new_stock = number_rows(
        arrived, ["expected_delivery_date", "productId", "delivery_id"], "stock_id", start=next_id, key=["delivery_id"]
    ).select(
        "stock_id", "sku", "productId", F.col("quantity").alias("quantity_in_stock"), "expiration_date", "batch_number",
        F.lit(as_of).alias("received_date"), "temperature_zone", F.lit("AVAILABLE").alias("stock_status"),
        F.col("unit_cost").alias("purchase_price"), "supplier_id",
    )

    progress = updated.groupBy("po_id").agg(
        F.count_if("_due").alias("_touched"), F.count_if(F.col("status") == "PENDING").alias("_open")
    )
    finished = (F.col("_touched") > 0) & (F.col("_open") == 0)
    new_orders = (
        orders.join(progress, "po_id", "left")
        .withColumn("po_status", F.when(finished, "DELIVERED").otherwise(F.col("po_status")))
        .drop("_touched", "_open")
    )
    return {
        "stock": new_stock,
        "inbound_deliveries": updated.select(*inbound.columns),
        "purchase_orders": new_orders.select(*orders.columns),
    }


def delivery_sizes(products: DataFrame) -> DataFrame:
    """Delivery volume class and size range of each product."""
    volume = F.col("volume_category")
    return (
        products.withColumn("volume_category", volume_class(F.col("name"), F.col("category"), F.col("subcategory")))
        .select("productId", "name", "category", "subcategory", "volume_category", size_bound(volume, 0).alias("min_size"), size_bound(volume, 1).alias("max_size"))
    )
