"""Demand forecasts: making them, backtesting them, measuring them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.dates import anchor, compact_date
from shelfline.functions.numbers import half_up, ratio
from shelfline.operators import views
from shelfline.operators.stock import daily_demand

MODEL_NAME = "HistoricalPattern"
Z_95 = 1.96
DEFAULT_SPREAD = 0.2


def products_in_stock(stock: DataFrame, products: DataFrame) -> DataFrame:
    held = (
        stock.filter(F.col("quantity_in_stock") > 0)
        .groupBy("productId")
        .agg(F.sum("quantity_in_stock").alias("total_stock"))
    )
    return products.select("productId", F.col("name").alias("product_name"), "category").join(held, "productId")


# --- seasonal forecast ------------------------------------------------------


def _moments(quantity: Column) -> Column:
    """Count, sum and sum of squares: whole numbers, so they merge exactly."""
    return F.struct(
        F.count(quantity).alias("n"), F.sum(quantity).alias("s"), F.sum(quantity * quantity).alias("q")
    )


def _mean(m: Column) -> Column:
    return ratio(m["s"], m["n"])


def _std(m: Column) -> Column:
    n, s, q = m["n"].cast("double"), m["s"].cast("double"), m["q"].cast("double")
    return F.when(m["n"] > 1, F.sqrt((q * n - s * s) / (n * (n - 1))))


def _weekday_profile(daily: DataFrame, keys: list[str]) -> DataFrame:
    """Moments per weekday as a map of at most seven entries, and over all days."""
    per_day = daily.groupBy(*keys, F.weekday("sale_day").alias("_dow")).agg(_moments(F.col("daily_quantity")).alias("_m"))
    return per_day.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_dow", "_m"))).alias("_by_dow"),
        F.struct(F.sum("_m.n").alias("n"), F.sum("_m.s").alias("s"), F.sum("_m.q").alias("q")).alias("_all"),
    )


def _project(profiled: DataFrame, made: Column, horizon: int, *carried: str) -> DataFrame:
    """Horizon rows from a weekday profile; no history gives the minimal forecast."""
    days = profiled.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("forecast_horizon"))
    target = F.date_add(made, F.col("forecast_horizon"))
    chosen = F.coalesce(F.try_element_at(F.col("_by_dow"), F.weekday(target)), F.col("_all"))
    days = days.withColumn("target_date", target).withColumn("_c", chosen).withColumn("_mean", _mean(F.col("_c")))
    spread = _std(F.col("_c"))
    spread = F.when(spread.isNull() | (spread == 0), F.col("_mean") * DEFAULT_SPREAD).otherwise(spread)
    days = days.withColumn("_band", spread * Z_95)
    known = F.col("_mean").isNotNull()
    value = F.greatest(F.lit(1.0), F.bround("_mean"))
    return days.select(
        *carried,
        "target_date",
        "forecast_horizon",
        F.when(known, value).otherwise(1.0).alias("predicted_quantity"),
        F.when(known, F.greatest(F.lit(1.0), F.bround(F.col("_mean") - F.col("_band")))).otherwise(1.0).alias("confidence_lower"),
        F.when(known, F.greatest(value + 1, F.bround(F.col("_mean") + F.col("_band")))).otherwise(2.0).alias("confidence_upper"),
    )


def seasonal_forecast(stock: DataFrame, sales: DataFrame, as_of: date, history: int = 180, horizon: int = 7) -> DataFrame:
    """Weekday-seasonal forecast for every product in stock, in one pass over the sales."""
    stocked = stock.filter(F.col("quantity_in_stock") > 0).select("productId").distinct()
    profile = _weekday_profile(daily_demand(sales, anchor(as_of, -history), before=as_of), ["productId"])
    rows = _project(stocked.join(profile, "productId", "left"), F.lit(as_of), horizon, "productId")
    stamp = as_of.strftime("%Y%m%d")
    return rows.select(
        F.concat_ws("_", F.lit("FCT"), "productId", F.lit(stamp), F.col("forecast_horizon").cast("string")).alias("forecast_id"),
        F.lit(f"RUN_{stamp}").alias("run_id"),
        F.lit(as_of).alias("forecast_date"),
        *rows.columns,
        F.lit(MODEL_NAME).alias("model_name"),
    )


def series_context(sales: DataFrame, end: date, length: int = 90) -> DataFrame:
    """Zero-filled daily vector of ``length`` days up to ``end``, per product sold in it.

    Days are packed into one map per product (at most ``length`` entries) and
    read back along the calendar, so no product × day spine is built.
    """
    first = end - timedelta(days=length - 1)
    daily = daily_demand(sales, first, before=end + timedelta(days=1))
    packed = daily.groupBy("productId").agg(
        F.map_from_entries(F.collect_list(F.struct("sale_day", "daily_quantity"))).alias("_days")
    )
    calendar = F.sequence(F.lit(first), F.lit(end))
    vector = F.transform(calendar, lambda d: F.coalesce(F.try_element_at(F.col("_days"), d), F.lit(0)).cast("double"))
    return packed.select("productId", F.lit(end).alias("context_end"), vector.alias("context"))


def backtest_dates(sales: DataFrame, days: int = 7, floor_days: int = 90) -> DataFrame:
    """The last ``days`` sale dates, none earlier than ``floor_days`` after the first sale."""
    span = sales.agg(F.min(F.to_date("saleDate")).alias("a"), F.max(F.to_date("saleDate")).alias("b"))
    start = F.greatest(F.date_sub("b", days - 1), F.date_add("a", floor_days))
    return span.filter(start <= F.col("b")).select(F.explode(F.sequence(start, "b")).alias("forecast_date"))


def backtest_grid(sales: DataFrame, days: int = 7, horizon: int = 7, history: int = 90, floor_days: int = 90) -> DataFrame:
    """Seasonal forecasts as they would have been made on each of the last days.

    Each sale day is sent to the few forecast dates whose history covers it
    (at most ``days``), so the sales are read and aggregated once.
    """
    a = sales.agg(F.min(F.to_date("saleDate"))).scalar()
    b = sales.agg(F.max(F.to_date("saleDate"))).scalar()
    start = F.greatest(F.date_sub(b, days - 1), F.date_add(a, floor_days))
    daily = (
        sales.filter(F.col("saleDate") >= F.date_sub(b, days - 2 + history))
        .groupBy("productId", F.to_date("saleDate").alias("sale_day"))
        .agg(F.sum("quantity").alias("daily_quantity"))
    )
    first = F.greatest(start, F.col("sale_day"))
    last = F.least(b, F.date_add("sale_day", history - 1))
    spread = daily.select("*", F.explode(F.when(first <= last, F.sequence(first, last))).alias("forecast_date"))
    profile = _weekday_profile(spread, ["productId", "forecast_date"])
    rows = _project(profile, F.col("forecast_date"), horizon, "productId", "forecast_date")
    return rows.withColumn("run_id", F.concat_ws("_", F.lit("RUN"), compact_date(F.col("forecast_date"))))


ModelFn = Callable[["list[list[float]]", int], "list[list[tuple[float, float, float]]]"]


def model_forecast(contexts: DataFrame, model: ModelFn, horizon: int = 7) -> DataFrame:
    """Run a batch model over ``series_context`` rows.

    ``model(vectors, horizon)`` returns, for each vector, ``horizon`` triples
    (value, lower, upper). Called once per Arrow batch.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = model([list(v) for v in batch["context"]], horizon)
            rows = [
                (pid, end, h + 1, float(v), float(lo), float(hi))
                for pid, end, steps in zip(batch["productId"], batch["context_end"], made)
                for h, (v, lo, hi) in enumerate(steps)
            ]
            yield pd.DataFrame(rows, columns=["productId", "forecast_date", "forecast_horizon", "predicted_quantity", "confidence_lower", "confidence_upper"])

    schema = "productId string, forecast_date date, forecast_horizon int, predicted_quantity double, confidence_lower double, confidence_upper double"
    return contexts.mapInPandas(run, schema).withColumn("target_date", F.date_add("forecast_date", F.col("forecast_horizon")))


# --- accuracy ---------------------------------------------------------------


def accuracy_detail(forecasts: DataFrame, products: DataFrame, sales: DataFrame, as_of: date) -> DataFrame:
    """Forecast against sales per product and day; a day without sales counts as zero."""
    past = forecasts.filter(F.col("target_date") <= anchor(as_of))
    actual = F.coalesce("actual_quantity", F.lit(0).cast("long"))
    gap = F.abs(F.col("predicted_quantity") - actual)
    return (
        past.join(views.daily_actuals(sales), ["productId", "target_date"], "left")
        .join(products.select("productId", F.col("name").alias("product_name"), "category"), "productId")
        .select(
            "productId", "product_name", "category", "forecast_date", "target_date", "forecast_horizon",
            "predicted_quantity", "confidence_lower", "confidence_upper",
            actual.alias("actual_quantity"),
            gap.alias("absolute_error"),
            F.when(actual > 0, gap / actual).alias("relative_error"),
            F.when(actual.between(F.col("confidence_lower"), F.col("confidence_upper")), 1).otherwise(0).alias("within_confidence"),
        )
    )


def _metrics(places: int) -> list[Column]:
    return [
        half_up(F.avg("absolute_error"), places).alias("mae"),
        half_up(F.avg("relative_error") * 100, places).alias("mape"),
        half_up(F.avg("within_confidence") * 100, places).alias("confidence_accuracy"),
        F.count(F.lit(1)).alias("predictions"),
    ]


def accuracy_overall(detail: DataFrame) -> DataFrame:
    error = F.col("predicted_quantity") - F.col("actual_quantity")
    return detail.agg(
        *_metrics(6),
        half_up(F.sqrt(F.avg(error * error)), 6).alias("rmse"),
        F.min("target_date").alias("first_date"),
        F.max("target_date").alias("last_date"),
    )


def accuracy_by(detail: DataFrame, key: str, trim: float | None = None) -> DataFrame:
    """Metrics by category, target date or horizon; ``trim`` drops relative errors at or over it."""
    rows = detail
    if trim is not None:
        rows = rows.filter(F.col("relative_error").isNotNull() & (F.abs("relative_error") < trim))
    return rows.groupBy(key).agg(*_metrics(6)).orderBy(key)


def worst_forecasts(detail: DataFrame, side: str = "over", k: int = 5) -> DataFrame:
    error = F.col("predicted_quantity") - F.col("actual_quantity")
    chosen = detail.filter(error > 0 if side == "over" else error < 0)
    return (
        chosen.orderBy(F.desc("absolute_error"), "productId", "forecast_date", "target_date")
        .limit(k)
        .select("productId", "product_name", "forecast_date", "target_date", "predicted_quantity", "actual_quantity", error.alias("error"))
    )


def error_histogram(detail: DataFrame, bins: int = 50) -> DataFrame:
    """Prediction errors in equal-width bins from the smallest to the largest error."""
    # counted per distinct error first: range and bins both come from those rows
    error = (F.col("predicted_quantity") - F.col("actual_quantity")).alias("e")
    errors = detail.groupBy(error).agg(F.count(F.lit(1)).alias("n"))
    counted = F.when(F.col("n") > 0, F.col("e"))  # both columns, as below: the errors are computed once
    ends = errors.agg(F.struct(F.min(counted).alias("low"), F.max(counted).alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    slot = F.coalesce(F.floor(F.try_divide((F.col("e") - low) * bins, high - low)), F.lit(0).cast("long"))
    return (
        errors.groupBy(F.least(slot, F.lit(bins - 1)).alias("bin"))
        .agg(F.sum("n").alias("frequency"), F.min("e").alias("smallest"), F.max("e").alias("largest"))
        .orderBy("bin")
    )


# --- summaries --------------------------------------------------------------


def forecast_summary(forecasts: DataFrame, run_id: str | None = None) -> DataFrame:
    rows = forecasts if run_id is None else forecasts.filter(F.col("run_id") == run_id)
    value = F.col("predicted_quantity")
    return rows.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("productId").alias("unique_products"),
        F.min("forecast_date").alias("min_forecast_date"),
        F.max("forecast_date").alias("max_forecast_date"),
        F.min("target_date").alias("min_target"),
        F.max("target_date").alias("max_target"),
        F.avg(value).alias("avg_predicted"),
        F.min(value).alias("min_predicted"),
        F.max(value).alias("max_predicted"),
        F.count(value).alias("non_null_predictions"),
        F.count_if(value > 0).alias("positive_predictions"),
    )


def forecast_runs(forecasts: DataFrame, key: str = "run_id", k: int = 5) -> DataFrame:
    """The newest runs with their products and records."""
    return (
        forecasts.groupBy(key)
        .agg(
            F.min("forecast_date").alias("forecast_date"),
            F.countDistinct("productId").alias("product_count"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .orderBy(F.desc("forecast_date"), key)
        .limit(k)
    )


def top_forecasts(forecasts: DataFrame, products: DataFrame, k: int = 10, horizon: int = 7) -> DataFrame:
    """Largest predictions of the newest forecast date."""
    newest = forecasts.agg(F.max("forecast_date")).scalar()
    best = (
        forecasts.filter((F.col("forecast_date") == newest) & (F.col("forecast_horizon") <= horizon))
        .join(products.select("productId"), "productId", "left_semi")
        .orderBy(F.desc("predicted_quantity"), "target_date", "productId")
        .limit(k)
    )
    return best.join(products.select("productId", F.col("name").alias("product_name")), "productId").select(
        "productId", "product_name", "target_date", "predicted_quantity", "confidence_lower", "confidence_upper", "forecast_horizon"
    )


def forecastable_products(sales: DataFrame, products: DataFrame, min_days: int = 90, k: int | None = None) -> DataFrame:
    daily = sales.groupBy("productId", F.to_date("saleDate").alias("d")).agg(F.sum("quantity").alias("u"))
    rich = (
        daily.groupBy("productId")
        .agg(F.count(F.lit(1)).alias("days_with_sales"), F.sum("u").alias("total_quantity"))
        .filter(F.col("days_with_sales") >= min_days)
    )
    rows = products.select("productId", F.col("name").alias("product_name"), "category").join(rich, "productId")
    return rows if k is None else rows.orderBy(F.desc("total_quantity"), "productId").limit(k)


def product_forecast(forecasts: DataFrame, product_id: str, first: date, last: date) -> DataFrame:
    return (
        forecasts.filter(
            (F.col("productId") == product_id)
            & F.col("target_date").between(F.lit(first), F.lit(last))
            & F.col("predicted_quantity").isNotNull()
        )
        .select("productId", "forecast_date", "target_date", "predicted_quantity", "confidence_lower", "confidence_upper", "model_name")
        .orderBy("target_date", "model_name", "forecast_date")
    )


def accuracy_report(detail: DataFrame) -> DataFrame:
    """Overall metrics with the per-category metrics as a nested array, in one row and one pass."""
    error = F.col("predicted_quantity") - F.col("actual_quantity")
    sums = detail.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.sum("absolute_error").alias("a"), F.sum("relative_error").alias("r"), F.count("relative_error").alias("rn"),
        F.sum("within_confidence").alias("w"), F.sum(error * error).alias("q"), F.min("target_date").alias("lo"), F.max("target_date").alias("hi"),
    )
    own = F.struct(
        "category", half_up(ratio(F.col("a"), F.col("n")), 6).alias("mae"), half_up(ratio(F.col("r"), F.col("rn")) * 100, 6).alias("mape"),
        half_up(ratio(F.col("w"), F.col("n")) * 100, 6).alias("confidence_accuracy"),
    )
    return sums.agg(
        half_up(ratio(F.sum("a"), F.sum("n")), 6).alias("mae"),
        half_up(ratio(F.sum("r"), F.sum("rn")) * 100, 6).alias("mape"),
        half_up(ratio(F.sum("w"), F.sum("n")) * 100, 6).alias("confidence_accuracy"),
        F.sum("n").alias("predictions"),
        half_up(F.sqrt(ratio(F.sum("q"), F.sum("n"))), 6).alias("rmse"),
        F.min("lo").alias("first_date"),
        F.max("hi").alias("last_date"),
        F.array_sort(F.collect_list(own)).alias("category_metrics"),  # one entry per category
    )
