"""Plans that must not send rows per product through the driver, nor multiply a small file's rows in one task."""

from datetime import date, datetime

from pyspark.sql import functions as F

from shelfline.operators.basket import horizon_forecasts
from shelfline.operators.projection import stock_projection, total_demand
from shelfline.operators.views import forecast_accuracy, latest_forecasts
from shelfline.plans.ordering import DEALT_ROWS, spread
from shelfline.session import STARTING_PARTITIONS, prefer_defaults
from shelfline.sources.bridge import Bridge
from tests.conftest import SF_SMALL, rows

DAY = date(2025, 7, 14)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _forecasts(spark, n=3):
    return spark.range(n).select(
        F.col("id").cast("string").alias("productId"), F.lit(DAY).alias("forecast_date"), F.explode(F.lit([date(2025, 7, 15), date(2025, 7, 16)])).alias("target_date"),
        F.lit(1).alias("forecast_horizon"), F.lit(2.0).alias("predicted_quantity"),
    )


def _products(spark):
    return spark.createDataFrame([("0", "a", "Bakery", None, 1.5), ("1", "b", "Bakery", None, 2.5)], "productId string, name string, category string, subcategory string, price_gbp double")


def test_forecasts_and_products_are_not_broadcast(spark):
    """They look small, as an exploded frame is taken to be as large as what it is exploded from."""
    sales = spark.createDataFrame([("0", datetime(2025, 7, 15), 5), ("0", datetime(2025, 7, 15, 9), 1), (None, datetime(2025, 7, 15), 1)], "productId string, saleDate timestamp, quantity int")
    accuracy = forecast_accuracy(_forecasts(spark), sales)
    horizon = horizon_forecasts(_forecasts(spark), _products(spark), date(2025, 7, 15))
    assert rows(accuracy, "productId", "target_date", "actual_quantity") == [("0", date(2025, 7, 15), 6)]
    assert rows(horizon, "productId", "target_date") == [(p, date(2025, 7, d)) for p in "01" for d in (15, 16)]
    for df in (accuracy, horizon, latest_forecasts(_forecasts(spark))):
        assert "Broadcast" not in _plan(df)


def test_rows_are_dealt_out_before_they_multiply(spark):
    """A product's days and forecasts are made after a shuffle of the products to a given number of tasks."""
    stock = spark.createDataFrame([], "productId string, stock_status string, expiration_date date, quantity_in_stock int")
    inbound = spark.createDataFrame([], "productId string, status string, expected_delivery_date date, expiration_date date, quantity int")
    basket = spark.createDataFrame([("0", "ACTIVE", datetime(2025, 7, 14, 9), 3)], "productId string, status string, added_at timestamp, quantity int")
    projected = stock_projection(_products(spark), stock, inbound, _forecasts(spark), basket, DAY, 2)
    assert rows(projected, "productId", "projection_date", "total_demand") == [("0", date(2025, 7, 14), 3.0), ("0", date(2025, 7, 15), 2.0), ("1", date(2025, 7, 14), 0.0), ("1", date(2025, 7, 15), 2.0)]
    assert "REPARTITION_BY_NUM" in _plan(projected) and "Broadcast" not in _plan(projected)
    made = Bridge(spark, SF_SMALL).forecasts
    assert "REPARTITION_BY_NUM" in _plan(made) and made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert rows(total_demand(_forecasts(spark), basket), "productId", "total_demand") == [("0", 2.0), ("0", 2.0), ("0", 3.0), ("1", 2.0), ("1", 2.0), ("2", 2.0), ("2", 2.0)]


def test_a_task_reads_little_unless_the_session_chose_otherwise(spark):
    """What a task sorts and hashes takes many times the bytes it reads, so it must not grow to Spark's 64 or 128 MB of them."""
    sizes = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    fresh, chosen = spark.newSession(), spark.newSession()
    for key in sizes:
        chosen.conf.set(key, "5m")
    assert [prefer_defaults(fresh).conf.get(key) for key in sizes] == ["16m", "16m"]
    assert [prefer_defaults(chosen).conf.get(key) for key in sizes] == ["5m", "5m"]
    assert spark.conf.get(sizes[0]) == "16m"


def test_shuffles_start_with_enough_partitions_unless_the_session_chose_otherwise(spark):
    """An aggregate's partitions are merged but never split, so a few of them would hold whatever the tables grow to."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    few, many, chosen, kept = (spark.newSession() for _ in range(4))
    few.conf.set("spark.sql.shuffle.partitions", 4)
    many.conf.set("spark.sql.shuffle.partitions", 4 * STARTING_PARTITIONS)
    chosen.conf.set(key, 7)
    assert [prefer_defaults(s).conf.get(key) for s in (few, many, chosen)] == [str(STARTING_PARTITIONS), str(4 * STARTING_PARTITIONS), "7"]
    assert prefer_defaults(kept, partitions=False).conf.get(key, None) is None
    few.conf.set("spark.sql.shuffle.partitions", 4 * STARTING_PARTITIONS)  # raised later
    assert prefer_defaults(few).conf.get(key) == str(4 * STARTING_PARTITIONS)


def test_rows_are_dealt_to_more_tasks_as_they_grow(spark):
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread(spark.range(10), "id").rdd.getNumPartitions() == shuffled
    dealt = spread(spark.range(DEALT_ROWS * shuffled * 2), "id")
    assert dealt.rdd.getNumPartitions() == 2 * shuffled and dealt.distinct().count() == DEALT_ROWS * shuffled * 2


def test_products_are_not_broadcast_to_the_stock(spark):
    assert "Broadcast" not in _plan(Bridge(spark, SF_SMALL).stock)
