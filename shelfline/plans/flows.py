"""End-to-end flows composed from the operators; each is one lazy plan up to its numbered ids."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from shelfline.operators import forecast, projection, replenish


def demand_to_orders(tables: Mapping[str, DataFrame], as_of: date, days: int = 3) -> tuple[DataFrame, DataFrame]:
    """Forecast the products in stock, find what must be ordered now, and write the purchase orders."""
    made = forecast.seasonal_forecast(tables["stock"], tables["sales"], as_of)
    due = replenish.order_opportunities(
        tables["product_ordering_calendar"], tables["products"], tables["suppliers"], tables["stock"], made, as_of, days
    )
    return replenish.purchase_orders(due)


def planned_base_orders(tables: Mapping[str, DataFrame], as_of: date, days: int = 14, rule: str = "fefo") -> DataFrame:
    """Stock projection through expiry, then the base order of every opportunity."""
    projected = projection.stock_projection(
        tables["products"], tables["stock"], tables["inbound_deliveries"], tables["forecasts"], tables["live_basket"], as_of, days, rule
    )
    return projection.base_order(projected, tables["product_ordering_calendar"])
