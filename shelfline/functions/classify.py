"""Business classifications as column ladders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Temperature zones by category and subcategory.
CHILLED_CATEGORIES = ["Chilled Food", "Dairy"]
CHILLED_SUBCATEGORIES = ["Milk", "Cheese", "Yoghurt", "Chilled Meats", "Ready Meals"]
FROZEN_CATEGORIES = ["Frozen Food"]
FROZEN_SUBCATEGORIES = ["Ice Cream", "Frozen Desserts", "Frozen Meat", "Frozen Fish"]

# Price bands in pounds, right-closed.
PRICE_TIERS = [("budget", 0, 2), ("standard", 2, 5), ("premium", 5, 10), ("luxury", 10, 100)]

# Customer value bands, lower bound inclusive.
SEGMENTS = {
    "report": [("High Value", 2000), ("Medium Value", 500), ("Low Value", None), ("New", 0)],
    "verify": [("VIP", 3000), ("High Value", 1500), ("Regular", 500), ("Occasional", None), ("No Orders", 0)],
}


def _in(column: Column, values: list[str]) -> Column:
    return F.coalesce(column.isin(values), F.lit(False))


def temperature_zone(category: Column, subcategory: Column) -> Column:
    return (
        F.when(_in(category, CHILLED_CATEGORIES) | _in(subcategory, CHILLED_SUBCATEGORIES), "CHILLED")
        .when(_in(category, FROZEN_CATEGORIES) | _in(subcategory, FROZEN_SUBCATEGORIES), "FROZEN")
        .otherwise("AMBIENT")
    )


def price_tier(price: Column) -> Column:
    bands = [(name, (price > low) & (price <= high)) for name, low, high in PRICE_TIERS]
    name, inside = bands[0]
    return reduce(lambda ladder, band: ladder.when(band[1], band[0]), bands[1:], F.when(inside, name))


def customer_segment(value: Column, scheme: str = "report") -> Column:
    bands = SEGMENTS[scheme]
    (zero_name, _), (rest_name, _) = bands[-1], bands[-2]
    ladder = F.when(value == 0, zero_name)
    for name, floor in bands[:-2]:
        ladder = ladder.when(value >= floor, name)
    return ladder.otherwise(rest_name)


def volume_class(name: Column, category: Column, subcategory: Column) -> Column:
    return (
        F.when((category == "Fruit & Vegetables") & name.like("%Banana%"), "high_volume")
        .when((category == "Food Cupboard") & subcategory.like("%Spice%"), "low_volume")
        .otherwise("medium_volume")
    )


# Delivery sizes by volume class.
DELIVERY_SIZES = {"low_volume": (10, 20), "medium_volume": (20, 40), "high_volume": (50, 100)}


def size_bound(volume: Column, which: int) -> Column:
    default = DELIVERY_SIZES["medium_volume"][which]
    return (
        F.when(volume == "low_volume", DELIVERY_SIZES["low_volume"][which])
        .when(volume == "high_volume", DELIVERY_SIZES["high_volume"][which])
        .otherwise(default)
    )


def order_multiple(category: Column) -> Column:
    return (
        F.when(category.isin("Fresh Food", "Fruit & Vegetables"), 5)
        .when(category.isin("Chilled Food", "Dairy"), 3)
        .otherwise(1)
    )


def minimum_order(category: Column, seed: Column) -> Column:
    """Minimum order quantity drawn from the category's range by a stable seed."""
    return (
        F.when(category.isin("Fresh Food", "Fruit & Vegetables"), F.pmod(seed, F.lit(20)) + 20)
        .when(category.isin("Chilled Food", "Dairy"), F.pmod(seed, F.lit(15)) + 15)
        .otherwise(F.pmod(seed, F.lit(15)) + 10)
        .cast("int")
    )
