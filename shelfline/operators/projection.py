"""Day-by-day stock projection with expiry, and the base order derived from it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.classify import temperature_zone
from shelfline.functions.dates import anchor
from shelfline.functions.numbers import half_up
from shelfline.operators.basket import basket_daily
from shelfline.operators.views import latest_forecasts
from shelfline.plans.ordering import spread


def total_demand(forecasts: DataFrame, basket: DataFrame) -> DataFrame:
    """Forecast plus basket demand per product and date; either side may be missing."""
    zero, zero_units = F.lit(0.0), F.lit(0).cast("long")
    forecast, itb = F.coalesce("predicted_quantity", zero), F.coalesce("itb_quantity", zero_units)
    predicted = latest_forecasts(forecasts).groupBy("productId", "target_date").agg(
        F.sum("predicted_quantity").alias("predicted_quantity")
    )
    return predicted.join(basket_daily(basket), ["productId", "target_date"], "full").select(
        "productId", "target_date", forecast.alias("forecast_demand"), itb.alias("itb_demand"), (forecast + itb).alias("total_demand")
    )


_FLOWS = ["forecast_demand", "itb_demand", "inbound_deliveries", "expiring", "opening"]


def _movement(day: Column, ends: Column | None = None, **kinds: Column) -> Column:
    """A movement on ``day`` of the kinds given, the others at zero; ``ends`` is the day offset its units expire on."""
    zero = F.lit(0.0)
    expires = F.lit(None).cast("int") if ends is None else ends
    return F.struct(
        day.alias("projection_date"), expires.alias("_ends"),
        *[(kinds[f].cast("double") if f in kinds else zero).alias(f) for f in _FLOWS],
    )


def _moves(df: DataFrame, *movements: Column) -> DataFrame:
    return df.select("productId", F.inline(F.array(*movements)))


def projection_flows(
    products: DataFrame, stock: DataFrame, inbound: DataFrame, forecasts: DataFrame, basket: DataFrame, as_of: date, days: int, lots: bool = False
) -> DataFrame:
    """One row per product and projection day with demand, arrivals and what expires; opening stock stands on the first day.

    Each source is read once and emits all its movements, which are stacked and
    summed once: one shuffle with map-side combine. With ``lots`` the row also
    holds, in ``_lots``, the units that arrive on the day and expire by day 0, 1, …
    ``days`` (what expires later or never counts as ``days``); ``expiring`` stays zero.
    """
    first, last = anchor(as_of), anchor(as_of, days - 1)
    inside = lambda c: F.col(c).between(first, last)
    ends = F.least(F.datediff("expiration_date", first), F.lit(days))
    expires, held_units, due_units = F.col("expiration_date"), F.col("quantity_in_stock"), F.col("quantity")
    held = stock.filter((F.col("stock_status") == "AVAILABLE") & (expires >= first))
    due = inbound.filter((F.col("status") == "PENDING") & inside("expected_delivery_date"))
    active = basket.filter(F.col("status") == "ACTIVE").withColumn("_d", F.to_date("added_at")).filter(inside("_d"))
    predicted = latest_forecasts(forecasts).filter(inside("target_date"))
    spine = spread(products.select("productId"), "productId").select("productId", F.explode(F.sequence(first, last)).alias("_d"))
    spoils = lambda units: [] if lots else [_movement(expires, expiring=units)]
    flows = (
        _moves(spine, _movement(F.col("_d")))
        .unionByName(_moves(predicted, _movement(F.col("target_date"), forecast_demand=F.col("predicted_quantity"))))
        .unionByName(_moves(active, _movement(F.col("_d"), itb_demand=F.col("quantity"))))
        .unionByName(_moves(held, _movement(first, ends, opening=held_units), *spoils(held_units)))
        .unionByName(_moves(due, _movement(F.col("expected_delivery_date"), ends, inbound_deliveries=due_units), *spoils(due_units)))
    )
    sums = [F.sum(f).alias(f) for f in _FLOWS]
    if lots:
        units = F.col("opening") + F.col("inbound_deliveries")
        by_end = [F.sum(F.when(F.col("_ends") <= day, units).otherwise(F.lit(0.0))) for day in range(days + 1)]
        sums.append(F.array(*by_end).alias("_lots"))
    return flows.filter(inside("projection_date")).groupBy("productId", "projection_date").agg(*sums)


def netted_purges(flows: DataFrame) -> DataFrame:
    """A day purges what expires beyond that day's demand."""
    spare = F.col("expiring") - F.col("forecast_demand") - F.col("itb_demand")
    return flows.withColumn("purge_quantity", F.greatest(spare, F.lit(0.0)))


def fefo_purges(flows: DataFrame, as_of: date, days: int) -> DataFrame:
    """Lots sell earliest expiry first, unmet demand waits for the next lot, and what is left at the end of its last day is purged.

    ``left`` holds the units that expire by each day. Selling takes ``wanted`` units
    off all of these running totals, a purge then takes off what the day's own total
    still holds; both together are the larger of the two. A product is one row
    of ``days`` structs of ``days + 1`` numbers, however many lots are behind it.
    """
    first, zero = anchor(as_of), F.lit(0.0)

    def step(state: Column, day: Column) -> Column:
        today = F.datediff(day["projection_date"], first)
        wanted = state["owed"] + (day["forecast_demand"] + day["itb_demand"])
        by = lambda i: F.get(state["left"], i) + F.get(day["_lots"], i)
        taken = F.greatest(wanted, by(today))
        return F.struct(
            F.zip_with(state["left"], day["_lots"], lambda x, y: F.greatest(x + y - taken, zero)).alias("left"),
            F.greatest(wanted - by(F.lit(days)), zero).alias("owed"),
            F.concat(state["purged"], F.array(F.greatest(by(today) - wanted, zero))).alias("purged"),
        )

    start = F.struct(F.array_repeat(zero, days + 1).alias("left"), zero.alias("owed"), F.array().cast("array<double>").alias("purged"))
    per_product = flows.groupBy("productId").agg(F.array_sort(F.collect_list(F.struct("projection_date", *_FLOWS, "_lots"))).alias("_days"))
    purged = per_product.withColumn("_purged", F.aggregate("_days", start, step, lambda state: state["purged"]))
    return purged.select("productId", F.inline(F.arrays_zip("_days", "_purged"))).select(
        "productId", "_days.projection_date", *[f"_days.{f}" for f in _FLOWS], F.col("_purged").alias("purge_quantity")
    )


def project(flows: DataFrame) -> DataFrame:
    """Running stock per product from daily flows and purges.

    The windows see one row per product and projection day, a group of the
    length of the horizon for every product, hot or not.
    """
    upto = Window.partitionBy("productId").orderBy("projection_date").rowsBetween(Window.unboundedPreceding, 0)
    by_day = Window.partitionBy("productId").orderBy("projection_date")
    rows = flows.withColumn("total_demand", F.col("forecast_demand") + F.col("itb_demand"))
    so_far = lambda c: F.sum(c).over(upto)
    ending = so_far("opening") + so_far("inbound_deliveries") - so_far("total_demand") - so_far("purge_quantity")
    rows = rows.withColumn("projected_ending_stock", ending).withColumn("_opening", so_far("opening"))
    return rows.withColumn("beginning_stock", F.coalesce(F.lag("projected_ending_stock").over(by_day), F.col("_opening"))).select(
        "productId", "projection_date", "beginning_stock", "inbound_deliveries", "forecast_demand", "itb_demand",
        "total_demand", "purge_quantity", "projected_ending_stock",
    )


def stock_projection(
    products: DataFrame, stock: DataFrame, inbound: DataFrame, forecasts: DataFrame, basket: DataFrame,
    as_of: date, days: int = 14, rule: str = "netted",
) -> DataFrame:
    """Start, inbound, demand, purge and ending stock per product and day; stock may go negative.

    ``rule`` names the purge: ``netted`` or ``fefo``.
    """
    if rule not in ("netted", "fefo"):
        raise ValueError(f"unknown rule {rule!r}")
    flows = projection_flows(products, stock, inbound, forecasts, basket, as_of, days, lots=rule == "fefo")
    projected = project(netted_purges(flows) if rule == "netted" else fefo_purges(flows, as_of, days))
    whole = Window.partitionBy("productId")
    ending, demand = F.col("projected_ending_stock"), F.col("total_demand")
    mean = F.avg("total_demand").over(whole)
    about = products.select(
        "productId", F.col("name").alias("product_name"), "category",
        temperature_zone(F.col("category"), F.col("subcategory")).alias("temp_zone"),
    ).hint("merge")  # the days lie by product already
    return (
        projected.withColumn("days_of_supply", F.when(mean > 0, half_up(F.greatest(F.col("beginning_stock"), F.lit(0.0)) / mean, 2)))
        .withColumn("stock_status", F.when(ending < 0, "STOCKOUT_RISK").when(ending < demand, "LOW_STOCK").otherwise("OK"))
        .join(about, "productId")
    )


def base_order(projection: DataFrame, calendar: DataFrame, closed: bool = False) -> DataFrame:
    """Need and demand of each ordering opportunity from the projected days it covers.

    The opportunity runs from its delivery to the next one (``closed`` counts
    that day too); the contingency range starts its days in advance after the
    order date and spans its days of demand.
    """
    day, stock, demand = F.col("projection_date"), F.col("projected_ending_stock"), F.col("total_demand")
    atp, following, purge = F.col("atp_delivery_date"), F.col("next_atp_delivery_date"), F.col("purge_date")
    start = F.date_add("order_date", F.col("contingency_days_in_advance"))
    end = F.date_add(start, F.col("contingency_days_of_demand"))
    in_window = (day >= atp) & ((day <= following) if closed else (day < following))
    in_purge = day.between(following, purge)
    in_contingency = day.between(start, end)
    need = F.greatest(-stock, F.lit(0.0))
    zero = F.lit(0.0)

    def total(value: Column, inside: Column, name: str) -> Column:
        return F.sum(F.when(inside, value).otherwise(zero)).alias(name)

    # what the rules can touch: a day is only paired with opportunities that cover it
    opportunities = calendar.select(
        "productId", "order_date", "atp_delivery_date", "next_atp_delivery_date", "purge_date",
        "contingency_days_in_advance", "contingency_days_of_demand",
    )
    covered = (day >= F.least(atp, start)) & (day <= F.greatest(following, purge, end))
    days = projection.select(F.col("productId").alias("_pid"), "projection_date", "projected_ending_stock", "total_demand", "purge_quantity")
    joined = opportunities.join(days, (F.col("productId") == F.col("_pid")) & covered)
    return joined.groupBy("productId", "order_date", "atp_delivery_date", "next_atp_delivery_date", "purge_date").agg(
        total(need, in_window, "raw_need"),
        total(demand, in_window, "total_demand"),
        total(demand, in_purge, "demand_till_purge"),
        total(need, in_purge, "raw_need_till_purge"),
        total(demand, in_contingency, "contingency_forecast_sales"),
        total(need, in_contingency, "contingency_raw_need"),
        total(F.greatest(stock, zero) + F.col("purge_quantity"), day == following, "final_stock"),
    )


# --- questions to the projection --------------------------------------------


def projection_daily_summary(projection: DataFrame) -> DataFrame:
    return (
        projection.groupBy("projection_date", "temp_zone")
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.sum("beginning_stock").alias("beginning_stock"),
            F.sum("inbound_deliveries").alias("inbound_deliveries"),
            F.sum("total_demand").alias("total_demand"),
            F.sum("purge_quantity").alias("purge_quantity"),
            F.sum("projected_ending_stock").alias("projected_ending_stock"),
            F.count_if(F.col("stock_status") == "STOCKOUT_RISK").alias("products_at_risk"),
        )
        .orderBy("projection_date", "temp_zone")
    )


def storage_needs(projection: DataFrame) -> DataFrame:
    return (
        projection.groupBy("projection_date", "temp_zone")
        .agg(F.sum(F.col("projected_ending_stock") + F.col("inbound_deliveries")).alias("total_storage_needed"))
        .orderBy("projection_date", "temp_zone")
    )


def projection_alerts(projection: DataFrame, min_days: int = 3) -> DataFrame:
    return (
        projection.groupBy("productId", "product_name", "category")
        .agg(
            F.count_if(F.col("stock_status") == "STOCKOUT_RISK").alias("stockout_days"),
            F.max("total_demand").alias("max_daily_demand"),
            F.min("projected_ending_stock").alias("min_projected_stock"),
            F.min(F.when(F.col("stock_status") == "STOCKOUT_RISK", F.col("projection_date"))).alias("first_stockout_date"),
        )
        .filter(F.col("stockout_days") >= min_days)
    )


def stockout_on(projection: DataFrame, day: date) -> DataFrame:
    return projection.filter((F.col("projection_date") == F.lit(day)) & (F.col("stock_status") == "STOCKOUT_RISK")).select(
        "productId", "product_name", "category", "beginning_stock", "inbound_deliveries", "total_demand", "projected_ending_stock"
    )


def product_projection(projection: DataFrame, product_id: str) -> DataFrame:
    return projection.filter(F.col("productId") == product_id).orderBy("projection_date")


def excess_stock(projection: DataFrame, days: float = 30) -> DataFrame:
    return (
        projection.filter(F.col("days_of_supply") > days)
        .groupBy("productId", "product_name", "category", "beginning_stock")
        .agg(half_up(F.avg("forecast_demand"), 4).alias("avg_daily_demand"), F.min("days_of_supply").alias("days_of_supply"))
    )
