"""From orders to sales."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfline.operators import orders as o
from shelfline.sources.bridge import AS_OF
from suite.model_sql import AS_OF as A
from suite.registry import Suite

_STATUS = f"CASE WHEN delivery > {A} THEN 'FUTURE' WHEN delivery = {A} THEN 'PICKED' ELSE 'DELIVERED' END"
_DATED = "(SELECT *, orderDate::DATE AS ordered, deliveryDate::DATE AS delivery, total_pence::DOUBLE / 100 AS totalAmount FROM m_orders)"
_EARLIER = AS_OF - timedelta(days=3)


def _number(column: str):
    return F.regexp_extract(column, r"(\d+)$", 1).cast("long")


def register(s: Suite) -> None:
    s.add(
        "classify_order_status",
        lambda m: o.classify_order_status(m.orders, _EARLIER).select("orderId", "orderDate", "deliveryDate", "orderStatus"),
        f"""SELECT orderId, orderDate, deliveryDate, CASE WHEN ordered = {A} - 2 THEN 'PICKED' WHEN ordered >= {A} - 1 THEN 'FUTURE' WHEN delivery > {A} - 3 THEN 'FUTURE'
                   WHEN delivery = {A} - 3 THEN 'PICKED' ELSE 'DELIVERED' END AS orderStatus FROM {_DATED}""",
    )
    s.add(
        "classify_order_status_by_delivery",
        lambda m: o.classify_order_status(m.orders, AS_OF, "delivery").select("orderId", "orderStatus"),
        f"SELECT orderId, {_STATUS} AS orderStatus FROM {_DATED}",
    )
    s.add(
        "mark_cancelled",
        lambda m: o.mark_cancelled(m.orders, 0.005, draw=(_number("orderId") * 7919 % 1000) / 1000).select("orderId", "orderStatus"),
        "SELECT orderId, CASE WHEN orderStatus = 'DELIVERED' AND regexp_extract(orderId, '(\\d+)$', 1)::BIGINT * 7919 % 1000 < 5 THEN 'CANCELLED' ELSE orderStatus END AS orderStatus FROM m_orders",
    )
    s.add(
        "reproducible_sample",
        lambda m: o.reproducible_sample(m.orders, 0.1, draw=(_number("orderId") * 7919 % 1000) / 1000).select("orderId"),
        "SELECT orderId FROM m_orders WHERE regexp_extract(orderId, '(\\d+)$', 1)::BIGINT * 7919 % 1000 < 100",
    )
    drawn = lambda salt: f"('0x' || substr(md5('{salt}|' || orderId), 1, 12))::BIGINT % 1000000"
    s.add(
        "mark_cancelled_drawn",
        lambda m: o.mark_cancelled(m.orders, 0.005).select("orderId", "orderStatus"),
        f"SELECT orderId, CASE WHEN orderStatus = 'DELIVERED' AND {drawn(42)} < 5000 THEN 'CANCELLED' ELSE orderStatus END AS orderStatus FROM m_orders",
    )
    s.add(
        "reproducible_sample_drawn",
        lambda m: o.reproducible_sample(m.orders, 0.1, "orderId", seed=7).select("orderId"),
        f"SELECT orderId FROM m_orders WHERE {drawn(7)} < 100000",
    )
    s.add(
        "sales_from_orders",
        lambda m: o.sales_from_orders(m.orders, m.order_items),
        """SELECT 'SALE_' || orderItemId || '_' || u AS saleId, orderId, orderItemId, customerId, productId, saleDate, unit_pence::DOUBLE / 100 AS unitPrice, 1::BIGINT AS quantity
           FROM (SELECT *, UNNEST(range(1, quantity + 1)) AS u FROM m_sales)""",
    )
    s.add(
        "sales_from_orders_by_item",
        lambda m: m.sales,
        "SELECT saleId, orderId, orderItemId, customerId, productId, saleDate, unit_pence::DOUBLE / 100 AS unitPrice, quantity::BIGINT AS quantity FROM m_sales",
    )
    s.add(
        "sales_with_running_ids",
        lambda m: o.sales_from_orders(m.orders, m.order_items, grain="item", ids="running").select("saleId", "orderItemId"),
        "SELECT 'SALE_' || lpad((ROW_NUMBER() OVER (ORDER BY orderItemId))::VARCHAR, 10, '0') AS saleId, orderItemId FROM m_sales",
    )
    s.add(
        "missing_sales",
        lambda m: o.missing_sales(m.orders, m.order_items, m.sales.filter(F.col("saleDate") < F.lit(date(2001, 7, 20))), date(2001, 7, 10), date(2001, 7, 31), grain="item"),
        """SELECT saleId, orderId, orderItemId, customerId, productId, saleDate, unit_pence::DOUBLE / 100 AS unitPrice, quantity::BIGINT AS quantity
           FROM m_sales WHERE sale_day BETWEEN DATE '2001-07-20' AND DATE '2001-07-31'""",
    )
    s.add(
        "close_orders",
        lambda m: o.close_orders(m.orders, date(2001, 7, 10), date(2001, 7, 31)).select("orderId", "orderStatus"),
        f"SELECT orderId, CASE WHEN orderStatus IN ('PICKED', 'FUTURE') AND delivery BETWEEN DATE '2001-07-10' AND DATE '2001-07-31' THEN 'DELIVERED' ELSE orderStatus END AS orderStatus FROM {_DATED}",
    )
    s.add(
        "assemble_model_products",
        lambda m: _assembled(m)["products"],
        "SELECT productId, name, brandName, sellingSize, currency, price_pence::BIGINT AS price_pence, category, subcategory, price_gbp::DOUBLE AS price_gbp FROM m_products",
    )
    s.add(
        "assemble_model_order_items",
        lambda m: _assembled(m)["order_items"],
        "SELECT orderItemId, orderId, productId, quantity::BIGINT AS quantity, unit_pence::DOUBLE / 100 AS unitPrice, line_pence::DOUBLE / 100 AS totalPrice FROM m_items",
    )
    s.add(
        "price_gbp",
        lambda m: o.with_price_gbp(m.products.drop("price_gbp")).select("productId", "price_pence", "price_gbp"),
        "SELECT productId, price_pence::BIGINT AS price_pence, price_gbp::DOUBLE AS price_gbp FROM m_products",
    )


def _assembled(m):
    """The stores as ingest leaves them: products under their SKU name, ids read back as numbers."""
    loose = lambda df: df.withColumn("productId", F.col("productId").cast("long"))
    return o.assemble_model(
        {
            "products": m.products.withColumnRenamed("productId", "sku").withColumnRenamed("price_pence", "price"),
            "product_skus": m.product_skus,
            "customers": m.customers.withColumnRenamed("customerId", "id"),
            "orders": m.orders,
            "order_items": loose(m.order_items),
            "sales": loose(m.sales),
        }
    )
