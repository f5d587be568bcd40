"""Product catalogue, SKUs, brands, suppliers and the reference demand series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions import reference as ref
from shelfline.functions.classify import PRICE_TIERS, price_tier
from shelfline.functions.numbers import half_up, mean_int, pence, percent, stable_hash
from shelfline.plans.ordering import number_rows, percentiles, profile, value_counts, with_rank
from shelfline.plans.reports import beside

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


# --- ingest -----------------------------------------------------------------


def flatten_products(pages: DataFrame) -> DataFrame:
    """One flat row per product of a page payload; first two categories become the hierarchy."""
    carried = [c for c in pages.columns if c != "data"]
    p = "product"
    name_at = lambda i: F.coalesce(F.get(F.col(f"{p}.categories.name"), F.lit(i)), F.lit(""))
    return pages.select(*carried, F.posexplode("data").alias("position", p)).select(
        *[c for c in carried if c != "meta"],
        "position",
        F.col(f"{p}.sku").alias("sku"),
        F.col(f"{p}.name").alias("name"),
        F.col(f"{p}.brandName").alias("brandName"),
        F.col(f"{p}.sellingSize").alias("sellingSize"),
        F.col(f"{p}.price.currencySymbol").alias("currency"),
        F.col(f"{p}.price.amount").alias("price"),
        name_at(0).alias("category"),
        name_at(1).alias("subcategory"),
    )


def dedup_products(products: DataFrame, order: Sequence[str]) -> DataFrame:
    """First row of each SKU in page order, with the number of later repeats.

    ``min_by`` over the order columns combines map-side, so a SKU repeated on
    very many pages costs no sort.
    """
    key = F.struct(*order)
    rest = [c for c in products.columns if c != "sku"]
    return (
        products.groupBy("sku")
        .agg(F.min_by(F.struct(*rest), key).alias("_first"), (F.count(F.lit(1)) - 1).alias("duplicates"))
        .select("sku", *[F.col(f"_first.{c}").alias(c) for c in rest], "duplicates")
    )


# --- overview ---------------------------------------------------------------


def catalog_overview(products: DataFrame) -> DataFrame:
    named = lambda c: F.when(F.col(c) != "", F.col(c))
    return products.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.countDistinct("brandName").alias("unique_brands"),
        F.countDistinct(named("category")).alias("unique_categories"),
        F.countDistinct(named("subcategory")).alias("unique_subcategories"),
        (F.min("price_pence") / 100).alias("min_price_gbp"),
        (F.max("price_pence") / 100).alias("max_price_gbp"),
    )


def _mean_price() -> Column:
    return half_up(mean_int(F.col("price_pence")) / 100, 2)


def category_stats(products: DataFrame, k: int = 10) -> DataFrame:
    return (
        products.filter(F.col("category") != "")
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.countDistinct("brandName").alias("brands"),
            _mean_price().alias("avg_price_gbp"),
            (F.min("price_pence") / 100).alias("min_price_gbp"),
            (F.max("price_pence") / 100).alias("max_price_gbp"),
        )
        .orderBy(F.desc("product_count"), "category")
        .limit(k)
    )


def subcategory_stats(products: DataFrame, k: int = 15) -> DataFrame:
    return (
        products.filter(F.col("subcategory") != "")
        .groupBy("category", "subcategory")
        .agg(F.count(F.lit(1)).alias("product_count"), _mean_price().alias("avg_price_gbp"))
        .orderBy("category", F.desc("product_count"), "subcategory")
        .limit(k)
    )


def top_by_price(products: DataFrame, k: int = 5) -> DataFrame:
    return (
        products.select("productId", "name", "brandName", "price_gbp")
        .orderBy(F.desc("price_gbp"), "productId")
        .limit(k)
    )


def top_by_revenue(performance: DataFrame, k: int = 5) -> DataFrame:
    return (
        performance.filter(F.col("units_sold") > 0)
        .select("productId", "name", "brandName", "units_sold", "revenue", "sales_rank")
        .orderBy(F.desc("revenue"), "productId")
        .limit(k)
    )


# --- SKUs -------------------------------------------------------------------


def generate_skus(products: DataFrame, sku_count: Column | None = None) -> DataFrame:
    """One to three SKUs per product: the id plus a four-digit suffix, the first one primary."""
    count = (stable_hash("productId") % 3).cast("int") + 1 if sku_count is None else sku_count
    suffix = F.lpad(F.col("_i").cast("string"), 4, "0")
    return products.select("productId", F.explode(F.sequence(F.lit(1), count)).alias("_i")).select(
        "productId",
        F.concat("productId", suffix).alias("sku"),
        suffix.alias("sku_suffix"),
        (F.col("_i") == 1).alias("is_primary"),
    )


def _skus_per_product(skus: DataFrame) -> DataFrame:
    return skus.groupBy("productId").agg(F.count(F.lit(1)).alias("sku_count"))


def sku_distribution(skus: DataFrame) -> DataFrame:
    sizes = _skus_per_product(skus).groupBy("sku_count").agg(F.count(F.lit(1)).alias("number_of_products"))
    n = F.col("number_of_products")
    share = percent(n, F.sum(n).over(Window.partitionBy()))  # one row per SKU count
    return sizes.select(
        F.col("sku_count").alias("skus_per_product"),
        "number_of_products",
        half_up(share, 2).alias("percentage"),
        F.repeat(F.lit("■"), F.round(n / 10).cast("int")).alias("visual_bar"),
    ).orderBy("skus_per_product")


def sku_summary(skus: DataFrame) -> DataFrame:
    return _skus_per_product(skus).agg(
        F.count(F.lit(1)).alias("unique_products"),
        F.sum("sku_count").alias("total_skus"),
        half_up(mean_int(F.col("sku_count")), 2).alias("avg_skus_per_product"),
        F.min("sku_count").alias("min_skus_per_product"),
        F.max("sku_count").alias("max_skus_per_product"),
    )


def sku_lists(products: DataFrame, skus: DataFrame, min_skus: int = 2, category: str | None = None, k: int | None = None) -> DataFrame:
    """Products with at least ``min_skus`` SKUs and their ordered SKU and suffix lists."""
    chosen = products if category is None else products.filter(F.col("category") == category)
    listed = skus.groupBy("productId").agg(
        F.count(F.lit(1)).alias("num_skus"),
        F.array_join(F.array_sort(F.collect_list("sku")), ", ").alias("skus"),
        F.array_join(F.array_sort(F.collect_list("sku_suffix")), ", ").alias("sku_suffixes"),
    ).filter(F.col("num_skus") >= min_skus)
    rows = chosen.select("productId", "name", "brandName", "category", "subcategory", "price_gbp").join(listed, "productId")
    return rows if k is None else rows.orderBy(F.desc("num_skus"), "productId").limit(k)


def skus_of(products: DataFrame, skus: DataFrame, chosen: DataFrame) -> DataFrame:
    """SKUs of the products in ``chosen`` (any frame with a productId column)."""
    about = products.select("productId", "name", "brandName", "category", "subcategory")
    return (
        skus.join(chosen.select("productId").distinct(), "productId", "left_semi")
        .join(about, "productId")
        .select("productId", "name", "brandName", "category", "subcategory", "sku", "sku_suffix", "is_primary")
    )


def first_products(skus: DataFrame, n: int = 3) -> DataFrame:
    return skus.select("productId").distinct().orderBy("productId").limit(n)


def multi_sku_products(skus: DataFrame, min_skus: int = 2) -> DataFrame:
    return _skus_per_product(skus).filter(F.col("sku_count") >= min_skus)


def listed_products(skus: DataFrame, product_ids: Sequence[str]) -> DataFrame:
    return skus.filter(F.col("productId").isin(list(product_ids)))


def brand_sku_stats(products: DataFrame, skus: DataFrame, k: int = 10) -> DataFrame:
    """Products, SKUs and average SKUs per brand; the average is weighted by SKU rows."""
    per_product = products.select("productId", "brandName").join(_skus_per_product(skus), "productId")
    n = F.col("sku_count")
    return (
        per_product.groupBy("brandName")
        .agg(
            F.countDistinct("productId").alias("product_count"),
            F.sum(n).alias("total_skus"),
            half_up(F.sum(n * n).cast("double") / F.sum(n), 2).alias("avg_skus_per_product"),
        )
        .orderBy(F.desc("product_count"), "brandName")
        .limit(k)
    )


# --- price tiers and mapping ------------------------------------------------


def with_price_tier(products: DataFrame) -> DataFrame:
    return products.withColumn("price_tier", price_tier(F.col("price_gbp")))


def price_tiers(products: DataFrame) -> DataFrame:
    counted = (
        with_price_tier(products)
        .filter(F.col("price_tier").isNotNull())
        .groupBy("price_tier")
        .agg(F.count(F.lit(1)).alias("products"))
    )
    share = percent(F.col("products"), F.sum("products").over(Window.partitionBy()))  # at most four rows
    return counted.withColumn("percentage", half_up(share, 1))


def top_brands_by_tier(products: DataFrame, k: int = 3) -> DataFrame:
    counted = (
        with_price_tier(products)
        .filter(F.col("price_tier").isNotNull())
        .groupBy("price_tier", "brandName")
        .agg(F.count(F.lit(1)).alias("products"))
    )
    best = Window.partitionBy("price_tier").orderBy(F.desc("products"), "brandName")
    # Spark turns the rank filter into a map-side group limit, so each task forwards k rows per tier
    return counted.withColumn("position", F.row_number().over(best)).filter(F.col("position") <= k)


def item_popularity(series: DataFrame) -> DataFrame:
    """Positive sales per item over all stores; the id is the series id without its store suffix."""
    return (
        series.filter(F.col("y") > 0)
        .groupBy(F.regexp_replace("unique_id", "(_[^_]+){2}$", "").alias("item_id"))
        .agg(F.sum("y").alias("total_sold"), F.avg("y").alias("avg_quantity"), F.count(F.lit(1)).alias("times_sold"))
    )


def popularity_percentiles(popularity: DataFrame) -> DataFrame:
    return percentiles(popularity, "total_sold", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9})


def map_items_to_products(
    popularity: DataFrame, products: DataFrame, tier_draw: Column | None = None, pick: Column | None = None
) -> DataFrame:
    """Give each reference item a price tier by popularity band, then a product of that tier.

    ``tier_draw`` in [0, 1) chooses the tier, ``pick`` (a whole number) the
    product; both default to stable hashes of the item id. Popular items
    (top 30 %) pick from the first half of a tier with more than ten products.
    """
    draw = stable_hash("item_id", salt=1) % 1_000_000 / 1_000_000 if tier_draw is None else tier_draw
    choice = stable_hash("item_id", salt=2) if pick is None else pick
    names = [name for name, _, _ in PRICE_TIERS]

    ranked = with_rank(popularity, "total_sold", "popularity_rank", total="_items")
    fraction = (F.col("popularity_rank") - 1) / F.col("_items")
    tier = F.lit(None).cast("string")
    for upper, weights in reversed(ref.TIER_WEIGHTS):
        cumulative, ladder = 0.0, None
        for name, weight in zip(names[:-1], weights[:-1]):
            cumulative = round(cumulative + weight, 6)
            ladder = (F if ladder is None else ladder).when(draw < cumulative, name)
        tier = F.when(fraction < upper, ladder.otherwise(names[-1])).otherwise(tier)
    items = ranked.select("item_id", "total_sold", "popularity_rank", fraction.alias("_fraction"), tier.alias("price_tier"), choice.alias("_pick"))

    numbered = number_rows(
        with_price_tier(products)
        .filter(F.col("price_tier").isNotNull())
        .select("price_tier", "productId", "name", "brandName", "price_gbp"),
        ["price_tier", "productId"],
        "_row",
    )
    sizes = numbered.groupBy("price_tier").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    sizes = F.broadcast(sizes)  # one row per tier, four at most
    shelf = numbered.join(sizes.select("price_tier", "_first"), "price_tier").withColumn("_slot", F.col("_row") - F.col("_first"))
    popular = (F.col("_fraction") < 0.3) & (F.col("_size") > 10)
    reach = F.when(popular, F.floor(F.col("_size") / 2)).otherwise(F.col("_size"))
    aimed = items.join(sizes.select("price_tier", "_size"), "price_tier").withColumn("_slot", F.pmod(F.col("_pick"), reach))
    return aimed.join(shelf, ["price_tier", "_slot"]).select(
        "item_id", "popularity_rank", "total_sold", F.col("productId").alias("product_id"),
        F.col("name").alias("product_name"), F.col("brandName").alias("brand"), "price_gbp", "price_tier",
    )


def numeric_profile(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles, max of one column; one pass, exact quartiles, no one-task sort."""
    return profile(value_counts(df, column), QUARTILES)


def mapping_quality(mapping: DataFrame, products: DataFrame) -> DataFrame:
    """Price profile, product reuse and tier shares of a mapping, in one row.

    The mapping is reduced to one counted row per product before anything
    else; the results all need the count, so that table is computed once.
    """
    used = mapping.groupBy("product_id", "price_tier", "price_gbp").agg(F.count(F.lit(1)).alias("n"))
    reuse = used.agg(
        F.count(F.lit(1)).alias("products_used"),
        mean_int(F.col("n")).alias("avg_mappings_per_product"),
        F.max("n").alias("max_mappings_per_product"),
        *[F.sum(F.when(F.col("price_tier") == t, F.col("n")).otherwise(0)).alias(f"{t}_items") for t, _, _ in PRICE_TIERS],
    )
    p, n = pence(F.col("price_gbp")), F.col("n")
    total, s, q = F.sum(n).cast("double"), F.sum(n * p).cast("double"), F.sum(n * p * p).cast("double")
    prices = used.agg(
        F.sum(n).alias("count"),
        (s / total / 100).alias("mean"),
        (F.sqrt((q * total - s * s) / (total * (total - 1))) / 100).alias("std"),  # exact whole-pence moments
        (F.min(p) / 100).alias("min"),
        (F.max(p) / 100).alias("max"),
    )
    available = products.agg(F.count(F.lit(1)).alias("products_available"))
    return beside(prices, percentiles(used, "price_gbp", QUARTILES, weight="n"), reuse, available)


# --- reference series -------------------------------------------------------


def item_price_stats(prices: DataFrame, rate: float = 0.8) -> DataFrame:
    """Min, max and mean of the distinct prices of an item, converted at ``rate``."""
    distinct = prices.select("unique_id", "sell_price").distinct()
    return distinct.groupBy(F.regexp_replace("unique_id", "(_[^_]+){2}$", "").alias("item_id")).agg(
        (F.min("sell_price") * rate).alias("min"),
        (F.max("sell_price") * rate).alias("max"),
        (F.avg("sell_price") * rate).alias("mean"),
    )


def temporal_patterns(series: DataFrame) -> DataFrame:
    """Positive demand by weekday (0 = Monday) and by month, as ``dimension``/``period`` rows."""
    positive = series.filter(F.col("y") > 0)
    spread = positive.select(
        "y",
        F.explode(
            F.array(
                F.struct(F.lit("weekday").alias("dimension"), F.weekday("ds").alias("period")),
                F.struct(F.lit("month").alias("dimension"), F.month("ds").alias("period")),
            )
        ).alias("at"),
    )
    return spread.groupBy("at.dimension", "at.period").agg(
        F.sum("y").alias("total"), F.avg("y").alias("mean"), F.count(F.lit(1)).alias("count")
    )


def daily_series_profile(series: DataFrame) -> DataFrame:
    daily = series.groupBy("ds").agg(F.sum("y").alias("total_quantity"), F.count(F.lit(1)).alias("transactions"))
    return daily.agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("total_quantity").alias("avg_daily_quantity"),
        mean_int(F.col("transactions")).alias("avg_daily_transactions"),
    )


def thin_daily_series(series: DataFrame, step: int = 30) -> DataFrame:
    """Daily totals, every ``step``-th day kept."""
    daily = series.groupBy("ds").agg(F.sum("y").alias("total_quantity"))
    by_day = Window.orderBy("ds")  # one row per day
    return daily.withColumn("_day", F.row_number().over(by_day) - 1).filter(F.col("_day") % step == 0).drop("_day")


def series_near_level(series: DataFrame, target: float = 1000.0, band: float = 100.0, prefix: str = "", k: int = 10) -> DataFrame:
    """Series whose mean is within ``band`` of ``target``, the closest first."""
    level = series.filter(F.col("unique_id").startswith(prefix)).groupBy("unique_id").agg(F.avg("y").alias("avg_sales"))
    near = (F.col("avg_sales") > target - band) & (F.col("avg_sales") < target + band)
    return (
        level.filter(near)
        .withColumn("distance", F.abs(F.col("avg_sales") - target))
        .orderBy("distance", "unique_id")
        .limit(k)
    )


def extract_baskets(series: DataFrame, min_items: int = 5, max_items: int = 50) -> DataFrame:
    """Items and quantities sold in one store on one day, for days of a usable size.

    Sizes are counted first, so only groups already known to be within
    ``max_items`` are ever collected into a row.
    """
    positive = series.filter(F.col("y") > 0).select(
        "ds",
        F.regexp_extract("unique_id", "([^_]+_[^_]+)$", 1).alias("store"),
        F.regexp_replace("unique_id", "(_[^_]+){2}$", "").alias("item_id"),
        "y",
    )
    usable = (
        positive.groupBy("ds", "store")
        .agg(F.count(F.lit(1)).alias("n_items"))
        .filter(F.col("n_items").between(min_items, max_items))
    )
    lines = positive.join(usable, ["ds", "store"])
    packed = lines.groupBy("ds", "store", "n_items").agg(F.array_sort(F.collect_list(F.struct("item_id", "y"))).alias("lines"))
    return packed.select(
        "ds", "store", "n_items", F.col("lines.item_id").alias("item_ids"), F.col("lines.y").alias("quantities")
    )


def basket_size_profile(baskets: DataFrame) -> DataFrame:
    return numeric_profile(baskets, "n_items")


def filter_series(series: DataFrame, static: DataFrame, category: str) -> DataFrame:
    wanted = static.filter(F.col("cat_id") == category).select("unique_id").distinct()
    return series.join(wanted, "unique_id", "left_semi")


def category_series_counts(static: DataFrame, category: str) -> DataFrame:
    return static.filter(F.col("cat_id") == category).agg(
        F.countDistinct("item_id").alias("items"),
        F.countDistinct("unique_id").alias("series"),
        F.countDistinct("store_id").alias("stores"),
        F.countDistinct("state_id").alias("states"),
    )


def dataset_profile(df: DataFrame, date_column: str, id_column: str, value_column: str) -> DataFrame:
    """Rows, columns, date range, distinct ids and the numeric profile of any table."""
    shape = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.min(date_column).alias("first_date"),
        F.max(date_column).alias("last_date"),
        F.countDistinct(id_column).alias("distinct_ids"),
    )
    return beside(shape, numeric_profile(df, value_column))


# --- suppliers and shelf life -----------------------------------------------


def build_suppliers(products: DataFrame) -> DataFrame:
    """One supplier per brand in name order, with contact details derived from the number."""
    brands = products.filter(F.col("brandName") != "").select(F.col("brandName").alias("supplier_name")).distinct()
    n, name = F.col("supplier_id"), F.col("supplier_name")
    cities = F.array(*[F.lit(c) for c in ref.SUPPLIER_CITIES])
    mail = F.replace(
        F.replace(F.replace(F.lower(name), F.lit(" "), F.lit(".")), F.lit("&"), F.lit("and")), F.lit("'"), F.lit("")
    )
    digit = (F.pmod(n - 1, F.lit(9)) + 1).cast("string")
    return (
        number_rows(brands, ["supplier_name"], "supplier_id")
        .withColumn("city", F.get(cities, F.pmod(n - 1, F.lit(len(ref.SUPPLIER_CITIES))).cast("int")))
        .select(
            "supplier_id",
            "supplier_name",
            F.concat(F.lit("supplier@"), mail, F.lit(".co.uk")).alias("contact_email"),
            F.concat(F.lit("0"), (n + 1000).cast("string"), F.lit(" "), (n + 555000).cast("string")).alias("contact_phone"),
            F.concat(n.cast("string"), F.lit(" "), name, F.lit(" House, Business Park")).alias("address"),
            "city",
            F.concat(F.upper(F.substring("city", 1, 2)), digit, F.lit(" "), digit, F.lit("AB")).alias("postcode"),
            F.lit("UK").alias("country"),
        )
    )


def assign_suppliers(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """products.supplier_id by brand; a brand without supplier keeps what it had."""
    found = suppliers.select(F.col("supplier_name").alias("brandName"), F.col("supplier_id").alias("_found"))
    current = F.col("supplier_id") if "supplier_id" in products.columns else F.lit(None).cast("long")
    return (
        products.join(found, "brandName", "left")
        .withColumn("supplier_id", F.coalesce("_found", current))
        .drop("_found")
    )


def supplier_coverage(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count("supplier_id").alias("products_with_supplier"), F.count(F.lit(1)).alias("total_products")
    )


def top_suppliers(suppliers: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    counted = products.groupBy("supplier_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        suppliers.join(counted, "supplier_id", "left")
        .groupBy("supplier_name")
        .agg(F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("product_count"))
        .orderBy(F.desc("product_count"), "supplier_name")
        .limit(k)
    )


def _shelf_days() -> Column:
    """Subcategory override, then category default, then 30; a literal map, no join."""
    overrides = [
        lit
        for category, subs in ref.SHELF_LIFE.items()
        for sub, days in subs.items()
        for lit in (F.lit(f"{category}|{sub}"), F.lit(days))
    ]
    defaults = [lit for category, days in ref.SHELF_LIFE_DEFAULT.items() for lit in (F.lit(category), F.lit(days))]
    key = F.concat_ws("|", "category", F.coalesce("subcategory", F.lit("")))
    return F.coalesce(
        F.try_element_at(F.create_map(*overrides), key),
        F.try_element_at(F.create_map(*defaults), F.col("category")),
        F.lit(ref.SHELF_LIFE_OTHER),
    )


def shelf_life_reference(products: DataFrame) -> DataFrame:
    notes = [lit for sub, note in ref.STORAGE_NOTES.items() for lit in (F.lit(sub), F.lit(note))]
    days = F.col("shelf_life_days")
    return (
        products.filter(F.col("category").isNotNull())
        .groupBy("category", F.when(F.col("subcategory") != "", F.col("subcategory")).alias("subcategory"))
        .agg(F.count(F.lit(1)).alias("product_count"))
        .withColumn("shelf_life_days", _shelf_days())
        .select(
            "category",
            "subcategory",
            "shelf_life_days",
            F.floor(days * 4 / 5).cast("int").alias("min_shelf_life_days"),
            F.floor(days * 6 / 5).cast("int").alias("max_shelf_life_days"),
            F.col("category").isin(ref.TEMPERATURE_SENSITIVE).alias("temperature_sensitive"),
            F.col("category").isin(ref.REFRIGERATED).alias("requires_refrigeration"),
            "product_count",
            F.try_element_at(F.create_map(*notes), F.col("subcategory")).alias("notes"),
        )
    )


def shelf_life_summary(shelf_life: DataFrame) -> DataFrame:
    days = F.col("shelf_life_days")
    return shelf_life.groupBy("category").agg(
        F.countDistinct("subcategory").alias("subcategory_count"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
        half_up(mean_int(days), 1).alias("avg_days"),
        F.sum("product_count").alias("total_products"),
    ).orderBy("avg_days", "category")


def shelf_life_ranges(shelf_life: DataFrame) -> DataFrame:
    days = F.col("shelf_life_days")
    return shelf_life.agg(
        F.count_if(days <= 3).alias("very_short"),
        F.count_if((days > 3) & (days <= 7)).alias("short"),
        F.count_if((days > 7) & (days <= 30)).alias("medium"),
        F.count_if((days > 30) & (days <= 365)).alias("long"),
        F.count_if(days > 365).alias("very_long"),
        F.count_if("temperature_sensitive").alias("temperature_sensitive_count"),
        F.count_if("requires_refrigeration").alias("requires_refrigeration_count"),
    )


def shelf_life_examples(shelf_life: DataFrame, subcategories: Sequence[str]) -> DataFrame:
    return shelf_life.filter(F.col("subcategory").isin(list(subcategories))).select(
        "category", "subcategory", "shelf_life_days",
        F.when(F.col("requires_refrigeration"), "Yes").otherwise("No").alias("refrigeration"), "product_count",
    ).orderBy("shelf_life_days", "category", "subcategory")
