"""Data-quality rules and the product payload contract."""

from pyspark.sql import functions as F

from shelfline.operators import contract as c
from shelfline.operators import quality as q
from shelfline.plans.ordering import spread
from shelfline.schema import ORDER_STATUSES
from shelfline.sources.bridge import AS_OF
from suite.model_sql import AS_OF as A
from suite.registry import Suite


def row(check: str, entity: str, count: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{entity}' AS entity, n::BIGINT AS violations, n = 0 AS passed FROM (SELECT COALESCE(({count}), 0) AS n)"


def key_sql(table: str, name: str, column: str) -> str:
    dup = f"SELECT COUNT(*) FROM (SELECT {column} FROM {table} GROUP BY {column} HAVING COUNT(*) > 1)"
    return row("duplicate_key", f"{name}.{column}", dup) + " UNION ALL " + row("null_key", f"{name}.{column}", f"SELECT COUNT(*) FROM {table} WHERE {column} IS NULL")


def fk_sql(child: str, cname: str, ccol: str, parent: str, pname: str, pcol: str) -> str:
    missing = f"SELECT COUNT(*) FROM {child} c WHERE {ccol} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{ccol})"
    return row("foreign_key", f"{cname}.{ccol} -> {pname}.{pcol}", missing)


_KEYS = [("m_products", "products", "productId"), ("m_skus", "product_skus", "sku"), ("m_customers", "customers", "customerId"), ("m_orders", "orders", "orderId"), ("m_items", "order_items", "orderItemId"), ("m_sales", "sales", "saleId")]
_REFS = [
    ("m_skus", "product_skus", "productId", "m_products", "products", "productId"),
    ("m_orders", "orders", "customerId", "m_customers", "customers", "customerId"),
    ("m_items", "order_items", "orderId", "m_orders", "orders", "orderId"),
    ("m_items", "order_items", "productId", "m_products", "products", "productId"),
    ("m_sales", "sales", "orderId", "m_orders", "orders", "orderId"),
    ("m_sales", "sales", "productId", "m_products", "products", "productId"),
    ("m_sales", "sales", "customerId", "m_customers", "customers", "customerId"),
]
_MORE_REFS = [
    ("m_basket", "live_basket", "productId", "m_products", "products", "productId"),
    ("m_stock", "stock", "productId", "m_products", "products", "productId"),
    ("m_products", "products", "supplier_id", "m_suppliers", "suppliers", "supplier_id"),
    ("m_inbound", "inbound_deliveries", "productId", "m_products", "products", "productId"),
    ("m_inbound", "inbound_deliveries", "po_id", "m_po", "purchase_orders", "po_id"),
]
CORE = ["products", "product_skus", "customers", "orders", "order_items", "sales"]
_PRICE = row("price_consistency", "products", "SELECT COUNT(*) FROM m_products WHERE ABS(price_gbp - price_pence / 100) > 0.01")
_LINE = row("line_total", "order_items", "SELECT COUNT(*) FROM m_items WHERE ABS(line_pence - quantity * unit_pence) > 1")
_TOTALS = "m_orders o LEFT JOIN (SELECT orderId, SUM(line_pence) AS v, COUNT(*) AS n FROM m_items GROUP BY orderId) i ON o.orderId = i.orderId"
_ORDER = row("order_total", "orders", f"SELECT COUNT(*) FROM {_TOTALS} WHERE ABS(total_pence - COALESCE(v, 0)) > 1") + " UNION ALL " + row("item_count", "orders", f"SELECT COUNT(*) FROM {_TOTALS} WHERE n <> itemCount")
_DOMAIN = row("domain", "orders.orderStatus", "SELECT COUNT(*) FROM m_orders WHERE orderStatus NOT IN ('DELIVERED', 'CANCELLED', 'PICKED', 'FUTURE')")
_STATUS = row("sale_of_undelivered_order", "sales", "SELECT COUNT(*) FROM m_sales s JOIN m_orders o ON s.orderId = o.orderId WHERE orderStatus <> 'DELIVERED'") + " UNION ALL " + row(
    "sale_of_cancelled_order", "sales", "SELECT COUNT(*) FROM m_sales s JOIN m_orders o ON s.orderId = o.orderId WHERE orderStatus = 'CANCELLED'"
)
_DATES = row("delivery_before_order", "orders", "SELECT COUNT(*) FROM m_orders WHERE deliveryDate < orderDate") + " UNION ALL " + row(
    "sale_date", "sales", "SELECT COUNT(*) FROM m_sales s JOIN m_orders o ON s.orderId = o.orderId WHERE s.sale_day <> o.deliveryDate::DATE"
)


def core(m):
    return {name: m.table(name) for name in CORE}


def _diff(a: str, b: str) -> str:
    return f"SELECT COUNT(*) FROM (SELECT DISTINCT orderId FROM {a} EXCEPT SELECT orderId FROM {b})"


_LIVE = "(SELECT orderId FROM m_orders WHERE orderStatus <> 'CANCELLED')"
_DONE = "(SELECT orderId FROM m_orders WHERE orderStatus = 'DELIVERED')"


# --- payloads ---------------------------------------------------------------


def payloads(m):
    """Product documents built from the part table, seven kinds of fault spread over them by key."""
    key = F.col("p_partkey")
    fault = key % 10
    text = lambda c: F.col(c)
    eur = fault == 1
    pounds = F.format_string("£%.2f", F.col("p_retailprice"))
    price = F.struct(
        F.round(F.col("p_retailprice") * 100).cast("long").alias("amount"), F.round(F.col("p_retailprice") * 100).cast("long").alias("amountRelevant"),
        F.when(eur, F.format_string("%.2f", F.col("p_retailprice"))).otherwise(pounds).alias("amountRelevantDisplay"),
        F.lit(0).alias("bottleDeposit"), F.lit("£0.00").alias("bottleDepositDisplay"), F.lit(1.5).alias("comparison"), F.lit("£1.50/1 kg").alias("comparisonDisplay"),
        F.when(eur, "EUR").otherwise("GBP").alias("currencyCode"), F.when(eur, "€").otherwise("£").alias("currencySymbol"),
    )
    category = F.struct(text("p_type").alias("id"), F.when(fault != 6, text("p_type")).alias("name"), F.lower("p_type").alias("urlSlugText"))
    asset = F.struct(F.lit("https://example.com/{w}.png").alias("url"), F.lit(100).alias("maxWidth"), F.lit(100).alias("maxHeight"), F.lit("image/png").alias("mimeType"), F.lit("FR01").alias("assetType"))
    doc = F.struct(
        key.cast("string").alias("sku"), text("p_name").alias("name"), F.when(fault != 2, text("p_brand")).alias("brandName"), F.lower("p_name").alias("urlSlugText"),
        F.lit(False).alias("discontinued"), F.lit(False).alias("notForSale"), F.when(fault == 3, 0).otherwise(1).alias("quantityMin"), F.lit(99).alias("quantityMax"),
        F.lit(1).alias("quantityInterval"), F.lit(1).alias("quantityDefault"), F.lit("ea").alias("quantityUnit"), F.lit("0").alias("weightType"),
        F.col("p_size").cast("string").alias("sellingSize"), F.when(fault != 0, price).alias("price"), F.array(category).alias("categories"), F.array(asset).alias("assets"),
        F.when(fault == 4, "x").alias("extra"),
    )
    made = F.to_json(doc)
    nulled = F.replace(made, F.concat(F.lit('"sku":"'), key.cast("string"), F.lit('"')), F.lit('"sku":null'))
    # a document is long and slow to judge, and a small file is one task
    return spread(m.raw("part"), "p_partkey").select(key.alias("key"), F.when(fault == 5, nulled).otherwise(made).alias("json"))


_FULL = """CASE key % 10 WHEN 0 THEN '"price" is required'
    WHEN 1 THEN '"price.amountRelevantDisplay" fails to match the money pattern; "price.currencyCode" must be [GBP]; "price.currencySymbol" must be [£]'
    WHEN 2 THEN '"brandName" is required' WHEN 3 THEN '"quantityMin" must be a positive integer' WHEN 4 THEN '"extra" is not allowed' WHEN 5 THEN '"sku" must not be null'
    WHEN 6 THEN '"categories.name" is required' ELSE '' END"""
_CRITICAL = """CASE key % 10 WHEN 0 THEN '"price" is required' WHEN 1 THEN '"price.amountRelevantDisplay" fails to match the money pattern'
    WHEN 2 THEN '"brandName" is required' WHEN 5 THEN '"sku" must not be null' ELSE '' END"""


def pages(m):
    """Pages of twelve documents; every seventh page has lost its envelope."""
    page = F.floor(F.col("key") / 12)
    # at most twelve documents to a page
    joined = payloads(m).groupBy(page.alias("page")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "json"))), lambda x: x["json"]), ",").alias("docs"))
    meta = F.when(F.col("page") % 7 == 0, "").otherwise('"meta":{"pagination":{"offset":0,"limit":12,"totalCount":12}},')
    return joined.select("page", F.concat(F.lit("{"), meta, F.lit('"data":['), "docs", F.lit("]}")).alias("json"))


def register(s: Suite) -> None:
    union = " UNION ALL "
    s.add("check_keys", lambda m: q.check_all_keys(core(m)), union.join(key_sql(*k) for k in _KEYS))
    s.add("check_references", lambda m: q.check_all_references({**core(m), **{t: m.table(t) for t in ("live_basket", "stock", "suppliers", "inbound_deliveries", "purchase_orders")}}), union.join(fk_sql(*k) for k in _REFS + _MORE_REFS))
    s.add(
        "orphan_samples",
        lambda m: q.samples(q.orphans(m.orders, "customerId", m.customers.filter(F.col("customerId") % 3 == 0), "customerId")),
        "SELECT customerId AS value, COUNT(*) AS rows FROM m_orders WHERE customerId % 3 <> 0 GROUP BY 1 ORDER BY 1 LIMIT 5",
    )
    s.add("check_price", lambda m: q.check_price(m.products), _PRICE)
    s.add("check_line_total", lambda m: q.check_line_total(m.order_items), _LINE)
    s.add("check_order_total", lambda m: q.check_order_total(m.orders, m.order_items), _ORDER)
    s.add("check_domain", lambda m: q.check_domain(m.orders, "orders", "orderStatus", ORDER_STATUSES), _DOMAIN)
    s.add(
        "check_positive",
        lambda m: q.check_positive(m.order_items, "order_items", ["quantity", "unitPrice"]),
        row("not_negative", "order_items.quantity", "SELECT COUNT(*) FROM m_items WHERE quantity < 0") + union + row("not_negative", "order_items.unitPrice", "SELECT COUNT(*) FROM m_items WHERE unit_pence < 0"),
    )
    s.add("check_sales_status", lambda m: q.check_sales_status(m.sales, m.orders), _STATUS)
    s.add("check_dates", lambda m: q.check_dates(m.orders, m.sales), _DATES)
    s.add("duplicate_lines", lambda m: q.duplicate_lines(m.order_items), "SELECT orderId, productId, COUNT(*) AS cnt FROM m_items GROUP BY 1, 2 HAVING COUNT(*) > 1")
    s.add("duplicate_sales", lambda m: q.duplicate_sales(m.sales), "SELECT orderId, productId, customerId, saleDate, COUNT(*) AS cnt FROM m_sales GROUP BY 1, 2, 3, 4 HAVING COUNT(*) > 1")
    s.add(
        "check_item_coverage",
        lambda m: q.check_item_coverage(m.orders, m.order_items, m.sales),
        union.join(
            [
                row("order_without_items", "orders", _diff(_LIVE, "m_items")),
                row("items_without_order", "order_items", _diff("m_items", _LIVE)),
                row("delivered_without_sales", "orders", _diff(_DONE, "m_sales")),
                row("sales_without_delivery", "sales", _diff("m_sales", _DONE)),
            ]
        ),
    )
    s.add(
        "check_sale_units",
        lambda m: q.check_sale_units(m.orders, m.order_items, m.sales),
        """SELECT u AS expected_units, su AS sold_units, n AS expected_lines, sn AS sale_rows, u = su AS units_match
           FROM (SELECT SUM(quantity)::BIGINT AS u, COUNT(*) AS n FROM m_items i JOIN m_orders o ON i.orderId = o.orderId WHERE orderStatus = 'DELIVERED'), (SELECT SUM(quantity)::BIGINT AS su, COUNT(*) AS sn FROM m_sales)""",
    )
    s.add(
        "check_business_rules",
        lambda m: q.check_business_rules(m.orders, m.order_items, m.customers, m.products, AS_OF),
        f"""WITH o AS (SELECT datediff('day', MIN(orderDate), MAX(orderDate))::DOUBLE AS days, COUNT(*)::DOUBLE AS orders, COUNT(DISTINCT customerId)::DOUBLE AS buyers,
                              COUNT(*) FILTER (orderStatus = 'CANCELLED' AND deliveryDate < {A})::DOUBLE AS cancelled, COUNT(*) FILTER (deliveryDate < {A})::DOUBLE AS past FROM m_orders),
                 l AS (SELECT MIN(total_pence)::DOUBLE / 100 AS low, MAX(total_pence)::DOUBLE / 100 AS high FROM m_orders WHERE orderStatus <> 'CANCELLED'),
                 g AS (SELECT ROUND(CAST(AVG(b) FILTER (i < 3) AS DECIMAL(28,8)), 4)::DOUBLE AS a, ROUND(CAST(AVG(b) FILTER (i >= n - 4 AND i < n - 1) AS DECIMAL(28,8)), 4)::DOUBLE AS z
                       FROM (SELECT SUM(total_pence)::DOUBLE / COUNT(*) / 100 AS b, ROW_NUMBER() OVER (ORDER BY date_trunc('month', orderDate)) - 1 AS i, COUNT(*) OVER () AS n
                             FROM m_orders WHERE orderStatus <> 'CANCELLED' GROUP BY date_trunc('month', orderDate))),
                 c AS (SELECT COUNT(*)::DOUBLE AS customers FROM m_customers), p AS (SELECT COUNT(*)::DOUBLE AS products FROM m_products), d AS (SELECT COUNT(DISTINCT productId)::DOUBLE AS ordered FROM m_items),
                 v AS (SELECT days / 365.25::DOUBLE AS years, orders / buyers / (days / 365.25::DOUBLE * 52) AS pw, cancelled * 100 / past AS cp, ordered / products AS cov, * FROM o, l, g, c, p, d)
            SELECT rule, ROUND(value, 6) AS value, passed FROM (
                SELECT 'date_span_years' AS rule, years AS value, years BETWEEN 1.95 AND 2.05 AS passed FROM v UNION ALL SELECT 'lowest_order_value', low, low >= 20 FROM v
                UNION ALL SELECT 'highest_order_value', high, high <= 100 FROM v UNION ALL SELECT 'first_months_basket', a, a BETWEEN 36 AND 40 FROM v UNION ALL SELECT 'last_full_months_basket', z, z BETWEEN 41 AND 45 FROM v
                UNION ALL SELECT 'orders_per_customer_week', pw, pw BETWEEN 1 AND 2 FROM v UNION ALL SELECT 'cancellation_rate_pct', cp, cp BETWEEN 0.4 AND 0.6 FROM v
                UNION ALL SELECT 'customers_with_orders', buyers, buyers = customers FROM v UNION ALL SELECT 'product_coverage', cov, cov >= 0.32 FROM v)""",
    )
    s.add(
        "id_format",
        lambda m: q.id_format({"products": m.products, "sales": m.sales, "live_basket": m.live_basket}),
        union.join(f"SELECT '{n}' AS table_name, MIN(LENGTH(productId)) AS min_length, MAX(LENGTH(productId)) AS max_length, COUNT(DISTINCT productId) AS unique_products FROM {t}" for n, t in (("products", "m_products"), ("sales", "m_sales"), ("live_basket", "m_basket"))),
    )
    s.add(
        "integrity_report",
        lambda m: q.integrity_report(core(m)),
        union.join(f"SELECT '{n}_rows' AS metric, COUNT(*)::VARCHAR AS value FROM {t}" for t, n, _ in _KEYS)
        + """ UNION ALL SELECT 'products_with_skus', COUNT(DISTINCT productId)::VARCHAR FROM m_skus UNION ALL SELECT 'avg_skus_per_product', ROUND(COUNT(*)::DOUBLE / COUNT(DISTINCT productId), 2)::VARCHAR FROM m_skus
             UNION ALL SELECT 'first_order', MIN(orderDate::DATE)::VARCHAR FROM m_orders UNION ALL SELECT 'last_order', MAX(orderDate::DATE)::VARCHAR FROM m_orders
             UNION ALL SELECT 'first_sale', MIN(sale_day)::VARCHAR FROM m_sales UNION ALL SELECT 'last_sale', MAX(sale_day)::VARCHAR FROM m_sales""",
    )
    everything = union.join([*[key_sql(*k) for k in _KEYS], *[fk_sql(*k) for k in _REFS], _PRICE, _LINE, _ORDER, _DOMAIN, _STATUS, _DATES])
    s.add("integrity_checks", lambda m: q.integrity_checks(core(m)), everything)
    s.add("integrity_verdict", lambda m: q.verdict(q.integrity_checks(core(m))), f"SELECT COUNT(*) AS checks, COUNT(*) FILTER (NOT passed) AS failed, bool_and(passed) AS all_passed FROM ({everything})")
    s.add("order_status_averages", lambda m: q.order_status_averages(m.orders), "SELECT orderStatus, COUNT(*) AS count, SUM(total_pence)::DOUBLE / COUNT(*) / 100 AS avg_amount FROM m_orders GROUP BY orderStatus")
    s.add("customer_file_check", lambda m: q.customer_file_check(m.customers.withColumnRenamed("customerId", "id")), key_sql("m_customers", "customers", "customerId"))
    supply = {"suppliers": "m_suppliers", "supplier_schedules": "m_sched", "product_ordering_calendar": "m_cal", "purchase_orders": "m_po", "inbound_deliveries": "m_inbound", "stock": "m_stock", "live_basket": "m_basket"}
    s.add("supply_counts", lambda m: q.supply_counts({t: m.table(t) for t in supply}), union.join(f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM {v}" for t, v in supply.items()))
    docs = "(SELECT p_partkey AS key FROM part)"
    for name, check, text in (("validate_products", c.validate_products, _FULL), ("validate_critical", c.validate_critical, _CRITICAL)):
        s.add(
            name,
            lambda m, check=check: check(payloads(m)).select("key", F.array_join("errors", "; ").alias("errors"), "is_valid"),
            f"SELECT key, {text} AS errors, {text} = '' AS is_valid FROM {docs}",
        )
    s.add(
        "contract_report",
        lambda m: c.contract_report(pages(m), "page").withColumn("report", F.array_join("report", "; ")),
        f"""WITH d AS (SELECT key // 12 AS page, key % 12 AS i, key, {_FULL} AS f, {_CRITICAL} AS k FROM {docs}),
                 e AS (SELECT page, key, i, UNNEST(string_split(f, '; ')) AS msg FROM d WHERE f <> ''),
                 n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY page ORDER BY key, msg) AS pos FROM e),
                 t AS (SELECT page, COUNT(*) AS m, string_agg('Product[' || i || ']: ' || msg, '; ' ORDER BY pos) FILTER (pos <= 5) AS shown FROM n GROUP BY page),
                 g AS (SELECT page, COUNT(*) AS products, COUNT(*) FILTER (k <> '') AS critical_errors FROM d GROUP BY page)
            SELECT g.page, page_ok AND COALESCE(m, 0) = 0 AND critical_errors = 0 AS is_valid, page_ok AND COALESCE(m, 0) = 0 AS structure_valid, critical_errors = 0 AS critical_fields_valid, products,
                   COALESCE(m, 0) AS product_errors, critical_errors,
                   concat_ws('; ', CASE WHEN NOT page_ok THEN '"meta" is required' END, shown, CASE WHEN m > 5 THEN '... and ' || (m - 5) || ' more' END) AS report
            FROM (SELECT *, page % 7 <> 0 AS page_ok FROM g) g LEFT JOIN t ON g.page = t.page""",
    )
    s.add(
        "json_path_access",
        lambda m: m.raw("events").groupBy("event_type").agg(F.sum(F.from_json("props", "k int")["k"]).alias("total_k"), F.max(F.get_json_object("props", "$.k").cast("int")).alias("max_k")),
        "SELECT event_type, SUM((props::JSON ->> '$.k')::INTEGER)::BIGINT AS total_k, MAX((props::JSON ->> '$.k')::INTEGER)::BIGINT AS max_k FROM events GROUP BY event_type",
    )
