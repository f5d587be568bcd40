"""Catalogue, SKUs, brands, suppliers, shelf life and the reference demand series.

The demand series is the sales table seen as (unique_id, ds, y): one series
per product and customer market segment, with the segment as the store suffix.
"""

from pyspark.sql import functions as F

from shelfline.functions.numbers import half_up
from shelfline.operators import catalog as c
from shelfline.operators import views as v
from suite.model_sql import half_up as r
from suite.registry import Suite

_SERIES = """SELECT p_type || '_' || p_size || '_S' || (s_k % 4) || '_W' || (s_k % 3) AS unique_id, ds, SUM(q)::DOUBLE AS y
             FROM (SELECT p_type, p_size, l_suppkey AS s_k, l_shipdate::DATE AS ds, l_quantity - 10 AS q FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY ALL"""
_ITEM = "regexp_replace(unique_id, '(_[^_]+){2}$', '')"
_POP = f"SELECT {_ITEM} AS item_id, SUM(y) AS total_sold, AVG(y) AS avg_quantity, COUNT(*) AS times_sold FROM ({_SERIES}) WHERE y > 0 GROUP BY 1"
_PRICES = """SELECT p_type || '_' || p_size || '_S' || (l_suppkey % 4) || '_W' || (l_suppkey % 3) AS unique_id, ROUND(l_extendedprice / 1000) AS sell_price FROM lineitem JOIN part ON l_partkey = p_partkey"""
_STATIC = """SELECT DISTINCT p_type || '_' || p_size || '_S' || (l_suppkey % 4) || '_W' || (l_suppkey % 3) AS unique_id, p_type || '_' || p_size AS item_id, p_type AS cat_id, 'S' || (l_suppkey % 4) AS store_id,
                'W' || (l_suppkey % 3) AS state_id FROM lineitem JOIN part ON l_partkey = p_partkey"""
_TIER = "CASE WHEN price_pence > 0 AND price_pence <= 200 THEN 'budget' WHEN price_pence > 200 AND price_pence <= 500 THEN 'standard' WHEN price_pence > 500 AND price_pence <= 1000 THEN 'premium' WHEN price_pence > 1000 AND price_pence <= 10000 THEN 'luxury' END"
_DRAW = "(CAST(total_sold AS BIGINT) * 7919 % 1000)"
_MAPPING = f"""WITH items AS (SELECT item_id, total_sold, RANK() OVER (ORDER BY total_sold DESC) AS popularity_rank, COUNT(*) OVER () AS n FROM ({_POP})),
     aimed AS (SELECT *, (popularity_rank - 1)::DOUBLE / n AS frac, {_DRAW} AS d FROM items),
     tiered AS (SELECT *, CASE WHEN frac < 0.2 THEN CASE WHEN d < 500 THEN 'budget' WHEN d < 850 THEN 'standard' WHEN d < 970 THEN 'premium' ELSE 'luxury' END
                               WHEN frac < 0.5 THEN CASE WHEN d < 400 THEN 'budget' WHEN d < 750 THEN 'standard' WHEN d < 950 THEN 'premium' ELSE 'luxury' END
                               ELSE CASE WHEN d < 350 THEN 'budget' WHEN d < 700 THEN 'standard' WHEN d < 950 THEN 'premium' ELSE 'luxury' END END AS price_tier FROM aimed),
     shelf AS (SELECT {_TIER} AS price_tier, *, ROW_NUMBER() OVER (PARTITION BY {_TIER} ORDER BY productId) - 1 AS slot, COUNT(*) OVER (PARTITION BY {_TIER}) AS size FROM m_products WHERE {_TIER} IS NOT NULL)
SELECT item_id, popularity_rank, total_sold, s.productId AS product_id, s.name AS product_name, s.brandName AS brand, s.price_gbp::DOUBLE AS price_gbp, t.price_tier
FROM tiered t JOIN shelf s ON t.price_tier = s.price_tier AND s.slot = (CAST(total_sold AS BIGINT) * 31 % CASE WHEN frac < 0.3 AND size > 10 THEN size // 2 ELSE size END)"""


def _series_id():
    k = F.col("l_suppkey")
    return F.concat_ws("_", "p_type", "p_size", F.concat(F.lit("S"), (k % 4).cast("string")), F.concat(F.lit("W"), (k % 3).cast("string"))).alias("unique_id")


def _lines(m):
    return m.raw("lineitem").join(m.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size"), "l_partkey")


def series(m):
    return _lines(m).groupBy(_series_id(), F.to_date("l_shipdate").alias("ds")).agg(F.sum(F.col("l_quantity") - 10).alias("y"))


def prices(m):
    return _lines(m).select(_series_id(), F.round(F.col("l_extendedprice") / 1000).alias("sell_price"))


def static(m):
    k = F.col("l_suppkey")
    return _lines(m).select(
        _series_id(), F.concat_ws("_", "p_type", "p_size").alias("item_id"), F.col("p_type").alias("cat_id"),
        F.concat(F.lit("S"), (k % 4).cast("string")).alias("store_id"), F.concat(F.lit("W"), (k % 3).cast("string")).alias("state_id"),
    ).distinct()


def mapping(m):
    sold = F.col("total_sold").cast("long")
    return c.map_items_to_products(c.item_popularity(series(m)), m.products, tier_draw=(sold * 7919 % 1000) / 1000, pick=sold * 31)


def rounded(df, *columns, places=4):
    kept = [x for x in df.columns if x not in columns]
    return df.select(*kept, *[half_up(F.col(x), places).alias(x) for x in columns])


PROFILE = ("mean", "std", "p25", "p50", "p75")


def profile_sql(column: str, source: str) -> str:
    x = f"({column})::DOUBLE"
    return f"""SELECT COUNT({column}) AS count, {r(f'AVG({x})', 4)} AS mean, {r(f'STDDEV_SAMP({x})', 4)} AS std, MIN({x}) AS min, MAX({x}) AS max,
                      {r(f'quantile_cont({x}, 0.25)', 4)} AS p25, {r(f'quantile_cont({x}, 0.5)', 4)} AS p50, {r(f'quantile_cont({x}, 0.75)', 4)} AS p75 FROM ({source})"""


def pages(m):
    """Product pages of eight, as nested payload rows, with some products repeated on the next page."""
    part = m.raw("part")
    own = part.select("*", F.floor(F.col("p_partkey") / 8).alias("page"))
    again = part.filter(F.col("p_partkey") % 8 == 0).select("*", (F.floor(F.col("p_partkey") / 8) + 1).alias("page"))
    names = F.when(F.col("p_size") % 5 == 0, F.array().cast("array<string>")).when(F.col("p_size") % 3 == 0, F.array("p_type")).otherwise(F.array("p_type", "p_name"))
    product = F.struct(
        F.lpad(F.col("p_partkey").cast("string"), 18, "0").alias("sku"), F.col("p_name").alias("name"), F.col("p_brand").alias("brandName"),
        F.concat(F.col("p_size").cast("string"), F.lit(" g")).alias("sellingSize"),
        F.struct(F.round(F.col("p_retailprice") * 100).alias("amount"), F.lit("£").alias("currencySymbol")).alias("price"),
        F.transform(names, lambda n: F.struct(n.alias("id"), n.alias("name"), F.lower(n).alias("urlSlugText"))).alias("categories"),
    )
    # at most nine products to a page
    return own.unionByName(again).groupBy("page").agg(F.array_sort(F.collect_list(product)).alias("data"))


_FLAT = """SELECT pg AS page, ROW_NUMBER() OVER (PARTITION BY pg ORDER BY sku) - 1 AS position, sku, name, brandName, sellingSize, '£' AS currency, price,
                  CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END AS category, CASE WHEN p_size % 5 = 0 OR p_size % 3 = 0 THEN '' ELSE name END AS subcategory
           FROM (SELECT p_partkey // 8 AS pg, LPAD(p_partkey::VARCHAR, 18, '0') AS sku, p_name AS name, p_brand AS brandName, p_size || ' g' AS sellingSize, ROUND(p_retailprice * 100) AS price, p_type, p_size FROM part
                 UNION ALL SELECT p_partkey // 8 + 1, LPAD(p_partkey::VARCHAR, 18, '0'), p_name, p_brand, p_size || ' g', ROUND(p_retailprice * 100), p_type, p_size FROM part WHERE p_partkey % 8 = 0)"""


def register(s: Suite) -> None:
    s.add("flatten_products", lambda m: c.flatten_products(pages(m)), _FLAT)
    s.add(
        "dedup_products",
        lambda m: c.dedup_products(c.flatten_products(pages(m)), ["page", "position"]),
        f"SELECT * EXCLUDE (k) FROM (SELECT *, COUNT(*) OVER (PARTITION BY sku) - 1 AS duplicates, ROW_NUMBER() OVER (PARTITION BY sku ORDER BY page, position) AS k FROM ({_FLAT})) WHERE k = 1",
    )
    s.add(
        "catalog_overview",
        lambda m: c.catalog_overview(m.products),
        """SELECT COUNT(*) AS total_products, COUNT(DISTINCT brandName) AS unique_brands, COUNT(DISTINCT category) AS unique_categories, COUNT(DISTINCT subcategory) AS unique_subcategories,
                  MIN(price_pence) / 100 AS min_price_gbp, MAX(price_pence) / 100 AS max_price_gbp FROM m_products""",
    )
    mean = r("SUM(price_pence)::DOUBLE / COUNT(*) / 100", 2)
    s.add(
        "category_stats",
        lambda m: c.category_stats(m.products),
        f"""SELECT category, COUNT(*) AS product_count, COUNT(DISTINCT brandName) AS brands, {mean} AS avg_price_gbp, MIN(price_pence) / 100 AS min_price_gbp, MAX(price_pence) / 100 AS max_price_gbp
            FROM m_products GROUP BY category ORDER BY product_count DESC, category LIMIT 10""",
    )
    s.add(
        "subcategory_stats",
        lambda m: c.subcategory_stats(m.products),
        f"""SELECT category, subcategory, COUNT(*) AS product_count, {mean} AS avg_price_gbp FROM m_products WHERE subcategory IS NOT NULL
            GROUP BY category, subcategory ORDER BY category, product_count DESC, subcategory LIMIT 15""",
    )
    s.add("generate_skus", lambda m: m.product_skus, "SELECT * FROM m_skus")
    s.add(
        "generate_skus_drawn",
        lambda m: c.generate_skus(m.products),
        """SELECT productId, productId || LPAD(CAST(i AS VARCHAR), 4, '0') AS sku, LPAD(CAST(i AS VARCHAR), 4, '0') AS sku_suffix, i = 1 AS is_primary
           FROM (SELECT productId, UNNEST(range(1, ('0x' || substr(md5('0|' || productId), 1, 12))::BIGINT % 3 + 2)) AS i FROM m_products)""",
    )
    sizes = "(SELECT productId, COUNT(*) AS n FROM m_skus GROUP BY productId)"
    s.add(
        "sku_distribution",
        lambda m: c.sku_distribution(m.product_skus),
        f"""SELECT n AS skus_per_product, COUNT(*) AS number_of_products, {r('COUNT(*)::DOUBLE * 100 / (SUM(COUNT(*)) OVER ())::DOUBLE', 2)} AS percentage,
                   repeat('■', ROUND(COUNT(*) / 10)::INTEGER) AS visual_bar FROM {sizes} GROUP BY n""",
    )
    s.add(
        "sku_summary",
        lambda m: c.sku_summary(m.product_skus),
        f"""SELECT COUNT(*) AS unique_products, SUM(n)::BIGINT AS total_skus, {r('SUM(n)::DOUBLE / COUNT(*)', 2)} AS avg_skus_per_product, MIN(n) AS min_skus_per_product, MAX(n) AS max_skus_per_product FROM {sizes}""",
    )
    listed = "SELECT p.productId, name, brandName, category, subcategory, price_gbp::DOUBLE AS price_gbp, COUNT(*) AS num_skus, string_agg(sku, ', ' ORDER BY sku) AS skus, string_agg(sku_suffix, ', ' ORDER BY sku_suffix) AS sku_suffixes FROM m_products p JOIN m_skus k ON p.productId = k.productId"
    s.add("sku_lists", lambda m: c.sku_lists(m.products, m.product_skus, min_skus=2), f"{listed} GROUP BY ALL HAVING COUNT(*) >= 2")
    s.add("sku_lists_of_category", lambda m: c.sku_lists(m.products, m.product_skus, min_skus=1, category="Chilled Food"), f"{listed} WHERE category = 'Chilled Food' GROUP BY ALL")
    of = "SELECT p.productId, name, brandName, category, subcategory, sku, sku_suffix, is_primary FROM m_products p JOIN m_skus k ON p.productId = k.productId"
    s.add(
        "skus_of_first_products",
        lambda m: c.skus_of(m.products, m.product_skus, c.first_products(m.product_skus)),
        f"{of} WHERE k.productId IN (SELECT DISTINCT productId FROM m_skus ORDER BY productId LIMIT 3)",
    )
    s.add("skus_of_multi_sku_products", lambda m: c.skus_of(m.products, m.product_skus, c.multi_sku_products(m.product_skus)), f"{of} WHERE k.productId IN (SELECT productId FROM {sizes} WHERE n >= 2)")
    ids = [f"{i:018d}" for i in (3, 7, 11)]
    s.add("skus_of_listed_products", lambda m: c.skus_of(m.products, m.product_skus, c.listed_products(m.product_skus, ids)), f"{of} WHERE k.productId IN ({', '.join(repr(i) for i in ids)})")
    s.add(
        "brand_sku_stats",
        lambda m: c.brand_sku_stats(m.products, m.product_skus),
        f"""SELECT brandName, COUNT(DISTINCT p.productId) AS product_count, COUNT(*) AS total_skus, {r('SUM(n)::DOUBLE / COUNT(*)', 2)} AS avg_skus_per_product
            FROM m_products p JOIN m_skus k ON p.productId = k.productId JOIN {sizes} z ON p.productId = z.productId GROUP BY brandName ORDER BY product_count DESC, brandName LIMIT 10""",
    )
    s.add(
        "price_tiers",
        lambda m: c.price_tiers(m.products),
        f"SELECT {_TIER} AS price_tier, COUNT(*) AS products, {r('COUNT(*)::DOUBLE * 100 / (SUM(COUNT(*)) OVER ())::DOUBLE', 1)} AS percentage FROM m_products WHERE {_TIER} IS NOT NULL GROUP BY 1",
    )
    s.add(
        "top_brands_by_tier",
        lambda m: c.top_brands_by_tier(m.products),
        f"""SELECT * FROM (SELECT {_TIER} AS price_tier, brandName, COUNT(*) AS products, ROW_NUMBER() OVER (PARTITION BY {_TIER} ORDER BY COUNT(*) DESC, brandName) AS position
                           FROM m_products WHERE {_TIER} IS NOT NULL GROUP BY 1, 2) WHERE position <= 3""",
    )
    s.add("map_items_to_products", mapping, _MAPPING)
    hashed = lambda salt: f"('0x' || substr(md5('{salt}|' || item_id), 1, 12))::BIGINT"
    s.add(
        "map_items_to_products_drawn",
        lambda m: c.map_items_to_products(c.item_popularity(series(m)), m.products),
        _MAPPING.replace(_DRAW, f"{hashed(1)} % 1000000 / 1000.0").replace("CAST(total_sold AS BIGINT) * 31 %", f"{hashed(2)} %"),
    )
    s.add(
        "mapping_quality",
        lambda m: rounded(c.mapping_quality(mapping(m), m.products), *PROFILE, "avg_mappings_per_product"),
        f"""SELECT * FROM ({profile_sql('price_gbp', _MAPPING)}),
            (SELECT COUNT(*) AS products_used, {r('SUM(n)::DOUBLE / COUNT(*)', 4)} AS avg_mappings_per_product, MAX(n) AS max_mappings_per_product FROM (SELECT COUNT(*) AS n FROM ({_MAPPING}) GROUP BY product_id)),
            (SELECT COUNT(*) FILTER (price_tier = 'budget') AS budget_items, COUNT(*) FILTER (price_tier = 'standard') AS standard_items, COUNT(*) FILTER (price_tier = 'premium') AS premium_items,
                    COUNT(*) FILTER (price_tier = 'luxury') AS luxury_items FROM ({_MAPPING})), (SELECT COUNT(*) AS products_available FROM m_products)""",
    )
    s.add("item_popularity", lambda m: c.item_popularity(series(m)), _POP)
    s.add(
        "popularity_percentiles",
        lambda m: rounded(c.popularity_percentiles(c.item_popularity(series(m))), "p25", "p50", "p75", "p90"),
        f"""SELECT {r('quantile_cont(total_sold, 0.25)', 4)} AS p25, {r('quantile_cont(total_sold, 0.5)', 4)} AS p50, {r('quantile_cont(total_sold, 0.75)', 4)} AS p75, {r('quantile_cont(total_sold, 0.9)', 4)} AS p90 FROM ({_POP})""",
    )
    s.add(
        "item_price_stats",
        lambda m: rounded(c.item_price_stats(prices(m)), "min", "max", "mean"),
        f"""SELECT {_ITEM} AS item_id, {r('MIN(sell_price) * 0.8::DOUBLE', 4)} AS min, {r('MAX(sell_price) * 0.8::DOUBLE', 4)} AS max, {r('AVG(sell_price) * 0.8::DOUBLE', 4)} AS mean
            FROM (SELECT DISTINCT * FROM ({_PRICES})) GROUP BY 1""",
    )
    s.add(
        "temporal_patterns",
        lambda m: c.temporal_patterns(series(m)),
        f"""WITH t AS (SELECT * FROM ({_SERIES}) WHERE y > 0)
            SELECT 'weekday' AS dimension, isodow(ds) - 1 AS period, SUM(y) AS total, AVG(y) AS mean, COUNT(*) AS count FROM t GROUP BY 2
            UNION ALL SELECT 'month', month(ds), SUM(y), AVG(y), COUNT(*) FROM t GROUP BY 2""",
    )
    s.add(
        "daily_series_profile",
        lambda m: c.daily_series_profile(series(m)),
        f"SELECT COUNT(*) AS days, AVG(t) AS avg_daily_quantity, SUM(n)::DOUBLE / COUNT(*) AS avg_daily_transactions FROM (SELECT SUM(y) AS t, COUNT(*) AS n FROM ({_SERIES}) GROUP BY ds)",
    )
    s.add(
        "thin_daily_series",
        lambda m: c.thin_daily_series(series(m)),
        f"SELECT ds, total_quantity FROM (SELECT ds, SUM(y) AS total_quantity, ROW_NUMBER() OVER (ORDER BY ds) - 1 AS i FROM ({_SERIES}) GROUP BY ds) WHERE i % 30 = 0",
    )
    s.add(
        "series_near_level",
        lambda m: rounded(c.series_near_level(series(m), target=18, band=2, prefix="ECONOMY"), "avg_sales", "distance", places=6),
        f"""SELECT unique_id, {r('a', 6)} AS avg_sales, {r('ABS(a - 18)', 6)} AS distance FROM (SELECT unique_id, AVG(y) AS a FROM ({_SERIES}) WHERE unique_id LIKE 'ECONOMY%' GROUP BY 1)
            WHERE a > 16 AND a < 20 ORDER BY ABS(a - 18), unique_id LIMIT 10""",
    )
    baskets = f"""SELECT ds, regexp_extract(unique_id, '([^_]+_[^_]+)$', 1) AS store, COUNT(*) AS n_items, string_agg({_ITEM} || ':' || y::BIGINT, ',' ORDER BY {_ITEM}, y) AS packed
                  FROM ({_SERIES}) WHERE y > 0 GROUP BY 1, 2 HAVING COUNT(*) BETWEEN 2 AND 50"""
    s.add(
        "extract_baskets",
        lambda m: c.extract_baskets(series(m), min_items=2).select(
            "ds", "store", "n_items",
            F.array_join(F.zip_with("item_ids", "quantities", lambda i, y: F.concat(i, F.lit(":"), y.cast("long").cast("string"))), ",").alias("packed"),
        ),
        baskets,
    )
    s.add("basket_size_profile", lambda m: rounded(c.basket_size_profile(c.extract_baskets(series(m), min_items=2)), *PROFILE), profile_sql("n_items", baskets))
    s.add("filter_series", lambda m: c.filter_series(series(m), static(m), "PROMO"), f"SELECT * FROM ({_SERIES}) WHERE unique_id LIKE 'PROMO%'")
    s.add(
        "category_series_counts",
        lambda m: c.category_series_counts(static(m), "PROMO"),
        f"SELECT COUNT(DISTINCT item_id) AS items, COUNT(DISTINCT unique_id) AS series, COUNT(DISTINCT store_id) AS stores, COUNT(DISTINCT state_id) AS states FROM ({_STATIC}) WHERE cat_id = 'PROMO'",
    )
    s.add(
        "dataset_profile",
        lambda m: rounded(c.dataset_profile(series(m), "ds", "unique_id", "y"), *PROFILE),
        f"SELECT * FROM (SELECT COUNT(*) AS rows, 3::BIGINT AS columns, MIN(ds) AS first_date, MAX(ds) AS last_date, COUNT(DISTINCT unique_id) AS distinct_ids FROM ({_SERIES})), ({profile_sql('y', _SERIES)})",
    )
    suppliers = """SELECT n AS supplier_id, b AS supplier_name, 'supplier@' || replace(replace(replace(lower(b), ' ', '.'), '&', 'and'), '''', '') || '.co.uk' AS contact_email,
                          '0' || (1000 + n) || ' ' || (555000 + n) AS contact_phone, n || ' ' || b || ' House, Business Park' AS address, city,
                          upper(substr(city, 1, 2)) || ((n - 1) % 9 + 1) || ' ' || ((n - 1) % 9 + 1) || 'AB' AS postcode, 'UK' AS country
                   FROM (SELECT b, n, ['London', 'Manchester', 'Birmingham', 'Leeds', 'Glasgow', 'Liverpool', 'Bristol', 'Sheffield', 'Edinburgh', 'Cardiff'][(n - 1) % 10 + 1] AS city
                         FROM (SELECT b, ROW_NUMBER() OVER (ORDER BY b) AS n FROM (SELECT DISTINCT brandName AS b FROM m_products WHERE brandName <> '')))"""
    s.add("build_suppliers", lambda m: c.build_suppliers(m.products), suppliers)
    assigned = f"SELECT p.* EXCLUDE (supplier_id), s.supplier_id FROM m_products p LEFT JOIN ({suppliers}) s ON p.brandName = s.supplier_name"
    unassigned = lambda m: c.assign_suppliers(m.products.drop("supplier_id"), c.build_suppliers(m.products))
    s.add("assign_suppliers", lambda m: unassigned(m).select("productId", "brandName", "supplier_id"), f"SELECT productId, brandName, supplier_id FROM ({assigned})")
    s.add("supplier_coverage", lambda m: c.supplier_coverage(unassigned(m)), f"SELECT COUNT(supplier_id) AS products_with_supplier, COUNT(*) AS total_products FROM ({assigned})")
    s.add(
        "top_suppliers",
        lambda m: c.top_suppliers(m.suppliers, m.products),
        "SELECT supplier_name, COUNT(p.productId) AS product_count FROM m_suppliers s LEFT JOIN m_products p ON s.supplier_id = p.supplier_id GROUP BY supplier_name ORDER BY product_count DESC, supplier_name LIMIT 5",
    )
    s.add(
        "shelf_life_reference",
        lambda m: m.product_purge_reference,
        """SELECT category, subcategory, shelf_life_days::BIGINT AS shelf_life_days, min_shelf_life_days::BIGINT AS min_shelf_life_days, max_shelf_life_days::BIGINT AS max_shelf_life_days,
                  temperature_sensitive, requires_refrigeration, product_count, notes FROM m_shelf""",
    )
    s.add(
        "shelf_life_summary",
        lambda m: c.shelf_life_summary(m.product_purge_reference),
        f"""SELECT category, COUNT(DISTINCT subcategory) AS subcategory_count, MIN(shelf_life_days)::BIGINT AS min_days, MAX(shelf_life_days)::BIGINT AS max_days,
                   {r('SUM(shelf_life_days)::DOUBLE / COUNT(*)', 1)} AS avg_days, SUM(product_count)::BIGINT AS total_products FROM m_shelf GROUP BY category""",
    )
    s.add(
        "shelf_life_ranges",
        lambda m: c.shelf_life_ranges(m.product_purge_reference),
        """SELECT COUNT(*) FILTER (d <= 3) AS very_short, COUNT(*) FILTER (d > 3 AND d <= 7) AS short, COUNT(*) FILTER (d > 7 AND d <= 30) AS medium, COUNT(*) FILTER (d > 30 AND d <= 365) AS long,
                  COUNT(*) FILTER (d > 365) AS very_long, COUNT(*) FILTER (temperature_sensitive) AS temperature_sensitive_count, COUNT(*) FILTER (requires_refrigeration) AS requires_refrigeration_count
           FROM (SELECT *, shelf_life_days AS d FROM m_shelf)""",
    )
    s.add(
        "shelf_life_examples",
        lambda m: c.shelf_life_examples(m.product_purge_reference, ["Milk & Cream", "Beef", "Vegetables", "Bread & Rolls", "Tins, Cans & Packets", "Chocolate & Sweets"]),
        """SELECT category, subcategory, shelf_life_days::BIGINT AS shelf_life_days, CASE WHEN requires_refrigeration THEN 'Yes' ELSE 'No' END AS refrigeration, product_count FROM m_shelf
           WHERE subcategory IN ('Milk & Cream', 'Beef', 'Vegetables', 'Bread & Rolls', 'Tins, Cans & Packets', 'Chocolate & Sweets')""",
    )
    s.add("top_by_price", lambda m: c.top_by_price(m.products), "SELECT productId, name, brandName, price_gbp::DOUBLE AS price_gbp FROM m_products ORDER BY price_gbp DESC, productId LIMIT 5")
    s.add(
        "top_by_revenue",
        lambda m: c.top_by_revenue(v.product_performance(m.products, m.sales)),
        """SELECT p.productId, name, brandName, u AS units_sold, v::DOUBLE / 100 AS revenue, RANK() OVER (ORDER BY u DESC) AS sales_rank
           FROM m_products p JOIN (SELECT productId, SUM(quantity)::BIGINT AS u, SUM(line_pence) AS v FROM m_sales GROUP BY productId) s ON p.productId = s.productId ORDER BY v DESC, p.productId LIMIT 5""",
    )
