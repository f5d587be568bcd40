"""The retail model: table schemas, load order, keys and references."""

from __future__ import annotations

from pyspark.sql import types as T

# The sixteen base tables of the retail model.
TABLE_DDL = {
    "customers": "customerId int, first_name string, last_name string, email string, gender string, address string, city string, postcode string, created_at timestamp",
    "suppliers": "supplier_id int, supplier_name string, contact_email string, contact_phone string, address string, city string, postcode string, country string, created_at timestamp, updated_at timestamp",
    "products": "productId string, name string, brandName string, sellingSize string, currency string, price_pence int, category string, subcategory string, price_gbp decimal(10,2), created_at timestamp, supplier_id int",
    "product_skus": "productId string, sku string, sku_suffix string, is_primary boolean, created_at timestamp",
    "orders": "orderId string, customerId int, orderDate timestamp, deliveryDate timestamp, orderStatus string, totalAmount decimal(10,2), itemCount int, created_at timestamp",
    "order_items": "orderItemId string, orderId string, productId string, quantity int, unitPrice decimal(10,2), totalPrice decimal(10,2), created_at timestamp",
    "sales": "saleId string, orderId string, orderItemId string, customerId int, productId string, saleDate timestamp, unitPrice decimal(10,2), quantity int, created_at timestamp",
    "stock": "stock_id int, sku string, productId string, quantity_in_stock int, expiration_date date, batch_number string, received_date date, temperature_zone string, stock_status string, last_updated timestamp, purchase_price decimal(10,2), supplier_id int",
    "forecasts": "forecast_id string, run_id string, forecast_date date, productId string, target_date date, forecast_horizon int, predicted_quantity double, confidence_lower double, confidence_upper double, model_name string, created_at timestamp",
    "supplier_schedules": "schedule_id int, supplier_id int, delivery_date date, po_cutoff_date date, po_cutoff_time string, lead_time_days int",
    "product_ordering_calendar": "calendar_id int, productId string, supplier_id int, order_date date, atp_delivery_date date, next_atp_delivery_date date, purge_date date, contingency_days_in_advance int, contingency_days_of_demand int, lead_time_days int, min_order_quantity int, order_multiple int, is_active boolean, created_at timestamp",
    "purchase_orders": "po_id string, supplier_id int, order_date date, expected_delivery_date date, po_status string, total_items int, total_amount decimal(10,2), created_at timestamp, updated_at timestamp",
    "inbound_deliveries": "delivery_id string, po_id string, productId string, sku string, quantity int, unit_cost decimal(10,2), expected_delivery_date date, actual_delivery_date date, expiration_date date, batch_number string, status string, created_at timestamp",
    "live_basket": "basket_id int, session_id string, customerId int, productId string, quantity int, added_at timestamp, expires_at timestamp, status string",
    "product_purge_reference": "reference_id int, category string, subcategory string, shelf_life_days int, min_shelf_life_days int, max_shelf_life_days int, temperature_sensitive boolean, requires_refrigeration boolean, product_count int, notes string, created_at timestamp, updated_at timestamp",
    "purge_log": "purge_id int, sku string, productId string, quantity_purged int, purge_date date, purge_reason string, batch_number string, original_expiration_date date, created_at timestamp",
}

# Parents before children.
LOAD_ORDER = list(TABLE_DDL)

PRIMARY_KEYS = {
    "products": "productId",
    "product_skus": "sku",
    "customers": "customerId",
    "orders": "orderId",
    "order_items": "orderItemId",
    "sales": "saleId",
}

# (child, column, parent, column)
FOREIGN_KEYS = [
    ("product_skus", "productId", "products", "productId"),
    ("orders", "customerId", "customers", "customerId"),
    ("order_items", "orderId", "orders", "orderId"),
    ("order_items", "productId", "products", "productId"),
    ("sales", "orderId", "orders", "orderId"),
    ("sales", "productId", "products", "productId"),
    ("sales", "customerId", "customers", "customerId"),
    ("live_basket", "productId", "products", "productId"),
    ("stock", "productId", "products", "productId"),
    ("products", "supplier_id", "suppliers", "supplier_id"),
    ("inbound_deliveries", "productId", "products", "productId"),
    ("inbound_deliveries", "po_id", "purchase_orders", "po_id"),
]

ORDER_STATUSES = ["DELIVERED", "CANCELLED", "PICKED", "FUTURE"]

SUPPLY_TABLES = [
    "suppliers",
    "supplier_schedules",
    "product_ordering_calendar",
    "purchase_orders",
    "inbound_deliveries",
    "stock",
    "live_basket",
]


def table_schema(name: str) -> T.StructType:
    return T._parse_datatype_string(TABLE_DDL[name])
