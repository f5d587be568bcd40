"""The retail model over the sample tables, as SQL text for the comparison engine.

Written independently of the DataFrame bridge: the two sides share no code.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-01'"
BASKET_NOW = "TIMESTAMP '2001-08-01 12:00:00'"

_UNIT = "((2 * CAST(ROUND(l_extendedprice) AS BIGINT) + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT)))"
_PART18 = "LPAD(CAST(l_partkey AS VARCHAR), 18, '0')"

# Shelf life in days by category and subcategory (None: any other) of the sample tables.
_SHELF = [
    ("Fresh Food", "Vegetables", 7),
    ("Fresh Food", "Fruit", 7),
    ("Fresh Food", "Herbs & Spices", 10),
    ("Fresh Food", "Salad", 5),
    ("Fresh Food", "Fresh Soup", 3),
    ("Fresh Food", None, 7),
    ("Chilled Food", "Milk & Cream", 14),
    ("Chilled Food", "Cheese", 21),
    ("Chilled Food", "Beef", 5),
    ("Chilled Food", None, 10),
    ("Bakery", "Bread & Rolls", 3),
    ("Bakery", "Cakes & Treats", 5),
    ("Bakery", None, 3),
    ("Food Cupboard", "Tins, Cans & Packets", 730),
    ("Food Cupboard", "Chocolate & Sweets", 365),
    ("Food Cupboard", "Herbs & Spices", 730),
    ("Food Cupboard", None, 365),
]


def _shelf_case() -> str:
    lines = [f"WHEN category = '{category}'" + (f" AND subcategory = '{sub}'" if sub else "") + f" THEN {days}" for category, sub, days in _SHELF]
    return "CASE " + " ".join(lines) + " ELSE 30 END"


CTES = {
    "m_customers": """
        SELECT c_custkey AS customerId, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
               'c' || c_custkey || '@example.com' AS email, n_name AS city, 'PC' || c_nationkey AS postcode
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "m_products": """
        SELECT LPAD(CAST(p_partkey AS VARCHAR), 18, '0') AS productId, p_name AS name,
               CASE WHEN p_partkey % 100 = 0 THEN '' ELSE p_brand END AS brandName, p_size || ' g' AS sellingSize, 'GBP' AS currency,
               CAST(CAST(ROUND(p_retailprice * 10) AS BIGINT) * 7 % 2400 + 25 AS INTEGER) AS price_pence,
               CASE p_type WHEN 'ECONOMY' THEN 'Fresh Food' WHEN 'PROMO' THEN 'Chilled Food' WHEN 'STANDARD' THEN 'Food Cupboard'
                           WHEN 'MEDIUM' THEN 'Bakery' WHEN 'LARGE' THEN 'Frozen Food' WHEN 'SMALL' THEN 'Drinks' END AS category,
               CASE WHEN p_size % 7 = 0 THEN NULL ELSE CASE p_type
                    WHEN 'ECONOMY' THEN ['Vegetables', 'Fruit', 'Salad'][p_size % 3 + 1]
                    WHEN 'PROMO' THEN ['Milk & Cream', 'Cheese', 'Beef'][p_size % 3 + 1]
                    WHEN 'STANDARD' THEN ['Tins, Cans & Packets', 'Chocolate & Sweets', 'Herbs & Spices'][p_size % 3 + 1]
                    WHEN 'MEDIUM' THEN ['Bread & Rolls', 'Cakes & Treats', 'Seasonal'][p_size % 3 + 1]
                    WHEN 'LARGE' THEN ['Ice Cream', 'Frozen Fish', 'Vegetables'][p_size % 3 + 1]
                    WHEN 'SMALL' THEN ['Juice', 'Water', 'Squash'][p_size % 3 + 1] END END AS subcategory,
               CAST((CAST(ROUND(p_retailprice * 10) AS BIGINT) * 7 % 2400 + 25) AS DECIMAL(12,2)) / 100 AS price_gbp,
               p_partkey % (SELECT COUNT(*) FROM supplier) AS supplier_id
        FROM part""",
    "m_suppliers": """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name, 's' || s_suppkey || '@example.com' AS contact_email,
               n_name AS city, s_suppkey % 5 + 1 AS lead_time_days
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "m_skus": """
        SELECT productId, productId || LPAD(CAST(i AS VARCHAR), 4, '0') AS sku, LPAD(CAST(i AS VARCHAR), 4, '0') AS sku_suffix, i = 1 AS is_primary
        FROM (SELECT LPAD(CAST(p_partkey AS VARCHAR), 18, '0') AS productId, UNNEST(range(1, p_partkey % 3 + 2)) AS i FROM part)""",
    "m_orders": """
        SELECT 'ORD_' || o_orderkey AS orderId, o_custkey AS customerId, o_orderdate AS orderDate,
               o_orderdate + to_days(CAST(o_orderkey % 7 + 1 AS INTEGER)) AS deliveryDate,
               CASE WHEN o_orderkey % 200 = 0 THEN 'CANCELLED' WHEN o_orderstatus = 'F' THEN 'DELIVERED'
                    WHEN o_orderstatus = 'P' THEN 'PICKED' ELSE 'FUTURE' END AS orderStatus,
               CAST(ROUND(o_totalprice) AS BIGINT) // 5 AS total_pence, CAST(o_orderkey % 9 + 1 AS INTEGER) AS itemCount
        FROM orders""",
    "m_items": f"""
        SELECT concat_ws('_', 'ITM', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS orderItemId, 'ORD_' || l_orderkey AS orderId,
               {_PART18} AS productId, CAST(l_quantity AS INTEGER) AS quantity, {_UNIT} AS unit_pence,
               {_UNIT} * CAST(l_quantity AS BIGINT) AS line_pence
        FROM lineitem""",
    "m_sales": """
        SELECT 'SALE_' || i.orderItemId AS saleId, i.orderId, i.orderItemId, o.customerId, i.productId, o.deliveryDate AS saleDate,
               CAST(o.deliveryDate AS DATE) AS sale_day, i.quantity, i.unit_pence, i.line_pence
        FROM m_items i JOIN m_orders o ON i.orderId = o.orderId WHERE o.orderStatus = 'DELIVERED'""",
    "m_stock": f"""
        SELECT l_orderkey * 10 + l_linenumber AS stock_id, p.productId,
               p.productId || LPAD(CAST(l_linenumber % (l_partkey % 3 + 1) + 1 AS VARCHAR), 4, '0') AS sku,
               CAST(l_quantity AS INTEGER) AS quantity_in_stock,
               CAST(l_shipdate AS DATE) + CAST(l_orderkey % 150 AS INTEGER) AS expiration_date, CAST(l_shipdate AS DATE) AS received_date,
               'BATCH-' || substr(p.productId, 1, 8) || '-' || strftime(CAST(l_shipdate AS DATE) + CAST(l_orderkey % 150 AS INTEGER), '%Y%m%d') AS batch_number,
               CASE WHEN CAST(l_shipdate AS DATE) > {AS_OF} - 120 THEN CASE WHEN l_returnflag = 'R' THEN 'RESERVED' ELSE 'AVAILABLE' END
                    WHEN CAST(l_shipdate AS DATE) + CAST(l_orderkey % 150 AS INTEGER) < {AS_OF} THEN 'EXPIRED' ELSE 'SOLD' END AS stock_status, {_UNIT} * 7 // 10 AS cost_pence, p.supplier_id,
               CASE WHEN p.category IN ('Chilled Food', 'Dairy') OR COALESCE(p.subcategory IN ('Milk', 'Cheese', 'Yoghurt', 'Chilled Meats', 'Ready Meals'), FALSE) THEN 'CHILLED'
                    WHEN p.category IN ('Frozen Food') OR COALESCE(p.subcategory IN ('Ice Cream', 'Frozen Desserts', 'Frozen Meat', 'Frozen Fish'), FALSE) THEN 'FROZEN'
                    ELSE 'AMBIENT' END AS temperature_zone
        FROM lineitem JOIN m_products p ON p.productId = {_PART18}
        WHERE l_shipdate <= {AS_OF}""",
    "m_inbound": f"""
        SELECT concat_ws('_', 'DEL', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS delivery_id,
               'PO_' || strftime(expected, '%Y%m%d') || '_' || l_suppkey AS po_id, {_PART18} AS productId,
               {_PART18} || '-' || strftime(expected, '%Y%m%d') || '-001' AS sku, CAST(l_quantity AS INTEGER) AS quantity,
               {_UNIT} * 7 // 10 AS cost_pence, expected AS expected_delivery_date,
               CASE WHEN shipped <= {AS_OF} THEN shipped END AS actual_delivery_date, expected + CAST(l_orderkey % 40 + 5 AS INTEGER) AS expiration_date,
               'BATCH_' || strftime(expected, '%Y%m%d') || '_001' AS batch_number,
               CASE WHEN shipped <= {AS_OF} THEN 'DELIVERED' ELSE 'PENDING' END AS status, l_suppkey AS supplier_id, expected - 3 AS order_date
        FROM (SELECT *, CAST(l_shipdate AS DATE) AS shipped, CAST(l_shipdate AS DATE) - CASE WHEN l_orderkey % 10 = 0 THEN 1 ELSE 0 END AS expected
              FROM lineitem)""",
    "m_po": """
        SELECT po_id, MIN(supplier_id) AS supplier_id, MIN(order_date) AS order_date, MIN(expected_delivery_date) AS expected_delivery_date,
               CASE WHEN COUNT(*) FILTER (status = 'PENDING') > 0 THEN 'PENDING' ELSE 'DELIVERED' END AS po_status,
               CAST(SUM(quantity) AS BIGINT) AS total_items, CAST(SUM(quantity * cost_pence) AS BIGINT) AS total_pence
        FROM m_inbound GROUP BY po_id""",
    "m_basket": """
        SELECT event_id AS basket_id, concat_ws('_', 'SES', user_id, strftime(added_at, '%Y%m%d'), user_id % 97) AS session_id, user_id AS customerId,
               LPAD(CAST(event_id % (SELECT COUNT(*) FROM part) AS VARCHAR), 18, '0') AS productId, CAST(event_id % 5 + 1 AS INTEGER) AS quantity, added_at,
               CASE WHEN event_id % 10 <> 0 THEN added_at + INTERVAL 3 HOUR END AS expires_at,
               CASE WHEN event_type = 'error' THEN 'EXPIRED' ELSE 'ACTIVE' END AS status
        FROM (SELECT *, ts - INTERVAL 8204 DAY AS added_at FROM events)""",
    "m_forecasts": f"""
        SELECT concat_ws('_', 'FCT', p_partkey, strftime(made, '%Y%m%d'), h) AS forecast_id, 'RUN_' || strftime(made, '%Y%m%d') AS run_id, made AS forecast_date,
               LPAD(CAST(p_partkey AS VARCHAR), 18, '0') AS productId, made + CAST(h AS INTEGER) AS target_date, h AS forecast_horizon,
               ((p_partkey * 7 + h * 3 + age) % 40 + 1)::DOUBLE AS predicted_quantity,
               GREATEST(((p_partkey * 7 + h * 3 + age) % 40 + 1)::DOUBLE - 3, 0) AS confidence_lower,
               ((p_partkey * 7 + h * 3 + age) % 40 + 1)::DOUBLE + 4 AS confidence_upper, 'HistoricalPattern' AS model_name
        FROM (SELECT p_partkey, age, h, {AS_OF} - CAST(age AS INTEGER) AS made
              FROM part, (VALUES (0), (7), (28)) a(age), range(1, 8) r(h))""",
    "m_days": f"""
        SELECT d, ROW_NUMBER() OVER (ORDER BY d) AS n FROM
        (SELECT CAST(g AS DATE) AS d FROM generate_series(TIMESTAMP '2001-07-01', TIMESTAMP '2001-08-31', INTERVAL 1 DAY) t(g))
        WHERE isodow(d) < 6 AND d <> DATE '2001-08-27'""",
    "m_sched": f"""
        SELECT s.supplier_id, b.d AS delivery_date, c.d AS po_cutoff_date, '17:00:00' AS po_cutoff_time, s.lead_time_days
        FROM m_suppliers s, m_days b JOIN m_days c ON TRUE
        WHERE c.n = b.n - s.lead_time_days AND b.d >= {AS_OF} AND b.d <= {AS_OF} + 30""",
    "m_shelf": f"""
        SELECT category, subcategory, product_count, days AS shelf_life_days, days * 4 // 5 AS min_shelf_life_days, days * 6 // 5 AS max_shelf_life_days,
               category IN ('Fresh Food', 'Chilled Food', 'Bakery') AS temperature_sensitive, category = 'Chilled Food' AS requires_refrigeration,
               CASE subcategory WHEN 'Milk & Cream' THEN 'Use within 3 days of opening' WHEN 'Bread & Rolls' THEN 'Can be frozen to extend shelf life'
                    WHEN 'Beef' THEN 'Can be frozen before use-by date' END AS notes
        FROM (SELECT category, subcategory, COUNT(*) AS product_count, {_shelf_case()} AS days FROM m_products WHERE category IS NOT NULL GROUP BY ALL)""",
    "m_cal": f"""
        SELECT p.productId, p.supplier_id, s.po_cutoff_date AS order_date, s.delivery_date AS atp_delivery_date,
               LEAD(s.delivery_date) OVER (PARTITION BY p.productId ORDER BY s.delivery_date) AS next_atp_delivery_date,
               s.delivery_date + CAST(COALESCE(h.shelf_life_days, 14) AS INTEGER) AS purge_date, s.lead_time_days,
               CASE WHEN p.category = 'Fresh Food' THEN CAST(p.productId AS BIGINT) % 20 + 20 WHEN p.category = 'Chilled Food' THEN CAST(p.productId AS BIGINT) % 15 + 15
                    ELSE CAST(p.productId AS BIGINT) % 15 + 10 END AS min_order_quantity,
               CASE WHEN p.category = 'Fresh Food' THEN 5 WHEN p.category = 'Chilled Food' THEN 3 ELSE 1 END AS order_multiple,
               2 AS contingency_days_in_advance, 4 AS contingency_days_of_demand, TRUE AS is_active
        FROM m_products p JOIN m_sched s ON p.supplier_id = s.supplier_id
        LEFT JOIN m_shelf h ON p.category = h.category AND p.subcategory = h.subcategory""",
    # --- shared sub-results ---
    "v_customer": """
        SELECT c.*, COUNT(DISTINCT o.orderId) AS total_orders, COUNT(*) FILTER (o.orderStatus = 'DELIVERED') AS delivered_orders,
               COUNT(*) FILTER (o.orderStatus = 'CANCELLED') AS cancelled_orders,
               COALESCE(SUM(total_pence) FILTER (o.orderStatus = 'DELIVERED'), 0)::DOUBLE / 100 AS lifetime_value,
               (SUM(total_pence) FILTER (o.orderStatus = 'DELIVERED'))::DOUBLE / NULLIF(COUNT(*) FILTER (o.orderStatus = 'DELIVERED'), 0) / 100 AS avg_order_value,
               MIN(o.orderDate) AS first_order, MAX(o.orderDate) AS last_order
        FROM m_customers c LEFT JOIN m_orders o ON c.customerId = o.customerId GROUP BY ALL""",
    "v_stock": f"""
        SELECT s.productId, p.name AS product_name, p.category, COUNT(DISTINCT s.sku) AS num_skus, SUM(quantity_in_stock)::BIGINT AS total_quantity,
               MIN(expiration_date) AS earliest_expiration,
               SUM(CASE WHEN expiration_date <= {AS_OF} + 7 THEN quantity_in_stock ELSE 0 END)::BIGINT AS expiring_week_qty,
               SUM(cost_pence)::DOUBLE / COUNT(cost_pence) / 100 AS avg_purchase_price
        FROM m_stock s JOIN m_products p ON s.productId = p.productId WHERE stock_status = 'AVAILABLE' GROUP BY ALL""",
    "v_latest": """
        SELECT f.* FROM m_forecasts f JOIN (SELECT productId, MAX(forecast_date) AS newest FROM m_forecasts GROUP BY productId) x
        ON f.productId = x.productId AND f.forecast_date = x.newest""",
    "v_onhand": "SELECT productId, SUM(quantity_in_stock)::BIGINT AS current_stock, MIN(expiration_date) AS earliest_expiration FROM m_stock WHERE stock_status = 'AVAILABLE' GROUP BY productId",
    "v_day_demand": "SELECT productId, sale_day, SUM(quantity)::BIGINT AS daily_quantity FROM m_sales GROUP BY productId, sale_day",
}


def _needs(text: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", text)]


def model_query(sql: str) -> str:
    """Prefix a query with the model CTEs it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _needs(text):
            if name not in ordered:
                visit(CTES[name])
                ordered.append(name)

    visit(sql)
    if not ordered:
        return sql
    prefix = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {prefix},\n{body[5:]}"
    return f"WITH {prefix}\n{body}"


def half_up(expression: str, places: int) -> str:
    return f"ROUND(CAST({expression} AS DECIMAL(28,8)), {places})::DOUBLE"
