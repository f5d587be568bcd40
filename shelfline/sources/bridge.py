"""The TPC-H-like sample tables seen as the retail model.

Every model table is a projection, filter or key join of the sample parquet,
so the retail operators can be run and checked on data of any scale factor.
Identifiers are derived from the source keys: no sequence, no window, no
driver round trip.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.classify import temperature_zone
from shelfline.functions.dates import compact_date
from shelfline.operators import catalog, replenish
from shelfline.plans.ordering import spread

AS_OF = date(2001, 8, 1)
BASKET_NOW = datetime(2001, 8, 1, 12, 0)
HOLIDAYS = [date(2001, 8, 27)]
BASKET_SHIFT_DAYS = 8204
SOLD_AFTER_DAYS = 120
FORECAST_AGES = [0, 7, 28]
SCHEDULE_DAYS = 30

SAMPLE_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Sample categories: part type to retail category, with three subcategories each.
CATEGORIES = {
    "ECONOMY": ("Fresh Food", ["Vegetables", "Fruit", "Salad"]),
    "PROMO": ("Chilled Food", ["Milk & Cream", "Cheese", "Beef"]),
    "STANDARD": ("Food Cupboard", ["Tins, Cans & Packets", "Chocolate & Sweets", "Herbs & Spices"]),
    "MEDIUM": ("Bakery", ["Bread & Rolls", "Cakes & Treats", "Seasonal"]),
    "LARGE": ("Frozen Food", ["Ice Cream", "Frozen Fish", "Vegetables"]),
    "SMALL": ("Drinks", ["Juice", "Water", "Squash"]),
}


def _id18(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 18, "0")


def _money(pence: Column) -> Column:
    return (pence.cast("decimal(12,0)") / F.lit(100)).cast("decimal(10,2)")


class Bridge:
    """Lazily built retail tables over one sample directory."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @cached_property
    def _raw(self) -> dict[str, DataFrame]:
        return {}

    def raw(self, name: str) -> DataFrame:
        """A sample table with its known schema, so that no footer is read to plan a query."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.schema(SAMPLE_DDL[name]).parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def customers(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
        named = F.split("c_name", "#")
        return self.raw("customer").join(nation, "c_nationkey", "left").select(
            F.col("c_custkey").alias("customerId"),
            F.get(named, F.lit(0)).alias("first_name"),
            F.get(named, F.lit(1)).alias("last_name"),
            F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
            "city",
            F.concat(F.lit("PC"), F.col("c_nationkey").cast("string")).alias("postcode"),
        )

    @cached_property
    def products(self) -> DataFrame:
        suppliers = self.raw("supplier").agg(F.count(F.lit(1))).scalar()
        kind = F.col("p_type")
        category = F.lit(None).cast("string")
        subcategory = F.lit(None).cast("string")
        for source, (name, subs) in CATEGORIES.items():
            category = F.when(kind == source, name).otherwise(category)
            picked = F.get(F.array(*[F.lit(s) for s in subs]), (F.col("p_size") % 3).cast("int"))
            subcategory = F.when(kind == source, picked).otherwise(subcategory)
        price = (F.pmod(F.round(F.col("p_retailprice") * 10).cast("long") * 7, F.lit(2400)) + 25).cast("int")
        return self.raw("part").select(
            _id18("p_partkey").alias("productId"),
            F.col("p_name").alias("name"),
            F.when(F.col("p_partkey") % 100 == 0, "").otherwise(F.col("p_brand")).alias("brandName"),
            F.concat(F.col("p_size").cast("string"), F.lit(" g")).alias("sellingSize"),
            F.lit("GBP").alias("currency"),
            price.alias("price_pence"),
            category.alias("category"),
            F.when(F.col("p_size") % 7 != 0, subcategory).alias("subcategory"),
            _money(price).alias("price_gbp"),
            (F.col("p_partkey") % suppliers).alias("supplier_id"),
        )

    @cached_property
    def suppliers(self) -> DataFrame:
        nation = self.raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("city"))
        return self.raw("supplier").join(nation, "s_nationkey", "left").select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit("@example.com")).alias("contact_email"),
            "city",
            (F.col("s_suppkey") % 5 + 1).cast("int").alias("lead_time_days"),
        )

    @cached_property
    def product_skus(self) -> DataFrame:
        parts = self.raw("part").select(_id18("p_partkey").alias("productId"), (F.col("p_partkey") % 3 + 1).cast("int").alias("n"))
        return catalog.generate_skus(parts, sku_count=F.col("n"))

    @cached_property
    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = (
            F.when(key % 200 == 0, "CANCELLED")
            .when(F.col("o_orderstatus") == "F", "DELIVERED")
            .when(F.col("o_orderstatus") == "P", "PICKED")
            .otherwise("FUTURE")
        )
        total = F.floor(F.round("o_totalprice").cast("long") / 5).cast("long")
        return self.raw("orders").select(
            F.concat(F.lit("ORD_"), key.cast("string")).alias("orderId"),
            F.col("o_custkey").alias("customerId"),
            F.col("o_orderdate").alias("orderDate"),
            (F.col("o_orderdate") + F.make_dt_interval(days=(key % 7 + 1).cast("int"))).alias("deliveryDate"),
            status.alias("orderStatus"),
            _money(total).alias("totalAmount"),
            (key % 9 + 1).cast("int").alias("itemCount"),
        )

    @staticmethod
    def _unit_pence() -> Column:
        q = F.col("l_quantity").cast("long")
        return F.floor((F.round("l_extendedprice").cast("long") * 2 + q) / (q * 2)).cast("long")

    @staticmethod
    def _line_key() -> Column:
        return F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

    @cached_property
    def order_items(self) -> DataFrame:
        unit = self._unit_pence()
        return self.raw("lineitem").select(
            F.concat(F.lit("ITM_"), self._line_key()).alias("orderItemId"),
            F.concat(F.lit("ORD_"), F.col("l_orderkey").cast("string")).alias("orderId"),
            _id18("l_partkey").alias("productId"),
            F.col("l_quantity").cast("int").alias("quantity"),
            _money(unit).alias("unitPrice"),
            _money(unit * F.col("l_quantity").cast("long")).alias("totalPrice"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        from shelfline.operators.orders import sales_from_orders

        return sales_from_orders(self.orders, self.order_items, grain="item")

    @cached_property
    def stock(self) -> DataFrame:
        received = F.to_date("l_shipdate")
        lots = self.raw("lineitem").filter(F.col("l_shipdate") <= F.lit(AS_OF).cast("timestamp_ntz"))  # what has arrived
        expiry = F.date_add(received, (F.col("l_orderkey") % 150).cast("int"))
        old = received <= F.lit(AS_OF - timedelta(days=SOLD_AFTER_DAYS))
        status = (
            F.when(old & (expiry < F.lit(AS_OF)), "EXPIRED").when(old, "SOLD")
            .when(F.col("l_returnflag") == "R", "RESERVED").otherwise("AVAILABLE")
        )
        lots = lots.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("stock_id"),
            _id18("l_partkey").alias("productId"),
            F.concat(
                _id18("l_partkey"),
                F.lpad((F.col("l_linenumber") % (F.col("l_partkey") % 3 + 1) + 1).cast("string"), 4, "0"),
            ).alias("sku"),
            F.col("l_quantity").cast("int").alias("quantity_in_stock"),
            expiry.alias("expiration_date"),
            received.alias("received_date"),
            status.alias("stock_status"),
            _money(F.floor(self._unit_pence() * 7 / 10).cast("long")).alias("purchase_price"),
        ).withColumn("batch_number", F.concat_ws("-", F.lit("BATCH"), F.substring("productId", 1, 8), compact_date(F.col("expiration_date"))))
        about = self.products.select(
            "productId", "supplier_id", temperature_zone(F.col("category"), F.col("subcategory")).alias("temperature_zone")
        ).hint("merge")  # a column or two of the products' file look small enough to broadcast, their rows are not
        return lots.join(about, "productId")

    @cached_property
    def inbound_deliveries(self) -> DataFrame:
        shipped = F.to_date("l_shipdate")
        expected = F.date_sub(shipped, F.when(F.col("l_orderkey") % 10 == 0, 1).otherwise(0))
        return (
            self.raw("lineitem")
            .withColumn("expected_delivery_date", expected)
            .withColumn("_stamp", compact_date(F.col("expected_delivery_date")))
            .withColumn("_arrived", shipped <= F.lit(AS_OF))
            .select(
                F.concat(F.lit("DEL_"), self._line_key()).alias("delivery_id"),
                F.concat_ws("_", F.lit("PO"), "_stamp", "l_suppkey").alias("po_id"),
                _id18("l_partkey").alias("productId"),
                F.concat_ws("-", _id18("l_partkey"), "_stamp", F.lit("001")).alias("sku"),
                F.col("l_quantity").cast("int").alias("quantity"),
                _money(F.floor(self._unit_pence() * 7 / 10).cast("long")).alias("unit_cost"),
                "expected_delivery_date",
                F.when(F.col("_arrived"), shipped).alias("actual_delivery_date"),
                F.date_add("expected_delivery_date", (F.col("l_orderkey") % 40 + 5).cast("int")).alias("expiration_date"),
                F.concat_ws("_", F.lit("BATCH"), "_stamp", F.lit("001")).alias("batch_number"),
                F.when(F.col("_arrived"), "DELIVERED").otherwise("PENDING").alias("status"),
                F.col("l_suppkey").alias("supplier_id"),
                F.date_sub("expected_delivery_date", 3).alias("order_date"),
            )
        )

    @cached_property
    def purchase_orders(self) -> DataFrame:
        return replenish.po_rollup(self.inbound_deliveries)

    @cached_property
    def live_basket(self) -> DataFrame:
        return self.basket_rows(self.raw("events"))

    def basket_rows(self, events: DataFrame) -> DataFrame:
        """Basket rows of ``events``, a table or a stream."""
        products = self.raw("part").agg(F.count(F.lit(1))).scalar()
        added = F.col("ts") - F.make_dt_interval(days=F.lit(BASKET_SHIFT_DAYS))
        return (
            events
            .withColumn("added_at", added)
            .select(
                F.col("event_id").alias("basket_id"),
                F.concat_ws(
                    "_", F.lit("SES"), "user_id", compact_date(F.col("added_at")), (F.col("user_id") % 97).cast("string")
                ).alias("session_id"),
                F.col("user_id").alias("customerId"),
                F.lpad((F.col("event_id") % products).cast("string"), 18, "0").alias("productId"),
                (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
                "added_at",
                F.when(
                    F.col("event_id") % 10 != 0, F.col("added_at") + F.make_dt_interval(hours=F.lit(3))
                ).alias("expires_at"),
                F.when(F.col("event_type") == "error", "EXPIRED").otherwise("ACTIVE").alias("status"),
            )
        )

    @cached_property
    def forecasts(self) -> DataFrame:
        ages = F.array(*[F.lit(a) for a in FORECAST_AGES])
        parts = spread(self.raw("part").select("p_partkey"), "p_partkey").select("p_partkey", F.explode(ages).alias("age"))
        grid = parts.select("*", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("forecast_horizon"))
        made = F.date_sub(F.lit(AS_OF), F.col("age"))
        predicted = (F.pmod(F.col("p_partkey") * 7 + F.col("forecast_horizon") * 3 + F.col("age"), F.lit(40)) + 1).cast("double")
        return grid.select(
            F.concat_ws("_", F.lit("FCT"), "p_partkey", compact_date(made), "forecast_horizon").alias("forecast_id"),
            F.concat_ws("_", F.lit("RUN"), compact_date(made)).alias("run_id"),
            made.alias("forecast_date"),
            _id18("p_partkey").alias("productId"),
            F.date_add(made, F.col("forecast_horizon")).alias("target_date"),
            "forecast_horizon",
            predicted.alias("predicted_quantity"),
            F.greatest(predicted - 3, F.lit(0.0)).alias("confidence_lower"),
            (predicted + 4).alias("confidence_upper"),
            F.lit("HistoricalPattern").alias("model_name"),
        )

    @cached_property
    def supplier_schedules(self) -> DataFrame:
        return replenish.supplier_schedule(
            self.suppliers, AS_OF, AS_OF + timedelta(days=SCHEDULE_DAYS), HOLIDAYS, lead_time=F.col("lead_time_days")
        )

    @cached_property
    def product_purge_reference(self) -> DataFrame:
        return catalog.shelf_life_reference(self.products)

    @cached_property
    def product_ordering_calendar(self) -> DataFrame:
        return replenish.ordering_calendar(
            self.products,
            self.supplier_schedules,
            self.product_purge_reference,
            as_of=AS_OF,
            seed=F.col("productId").cast("long"),
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
