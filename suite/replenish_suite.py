"""Supplier calendars, order quantities, purchase orders and goods receipt."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfline.operators import replenish as p
from shelfline.sources.bridge import AS_OF, HOLIDAYS
from suite.model_sql import AS_OF as A
from suite.model_sql import half_up as r
from suite.registry import Suite

_OPP = f"""SELECT c.productId, c.supplier_id, c.order_date, c.atp_delivery_date, c.purge_date, c.min_order_quantity, c.order_multiple, q.name AS product_name, q.price_pence::BIGINT AS price_pence, s.supplier_name,
                  COALESCE(v.total_quantity, 0) AS current_stock, COALESCE(v.expiring_week_qty, 0) AS expiring_soon, COALESCE(w, 100) AS weekly_demand
           FROM m_cal c JOIN m_products q ON c.productId = q.productId JOIN m_suppliers s ON c.supplier_id = s.supplier_id LEFT JOIN v_stock v ON c.productId = v.productId
           LEFT JOIN (SELECT productId, SUM(predicted_quantity) AS w FROM v_latest WHERE target_date >= {A} AND target_date <= {A} + 7 GROUP BY productId) f ON c.productId = f.productId
           WHERE c.order_date BETWEEN {A} AND {A} + 3 AND c.is_active"""
_SIZED = f"""SELECT *, CASE WHEN need <= 0 THEN 0 WHEN order_multiple > 1 THEN CEIL(GREATEST(need, min_order_quantity) / order_multiple) * order_multiple
                            ELSE FLOOR(GREATEST(need, min_order_quantity)) END::BIGINT AS order_quantity
             FROM (SELECT *, weekly_demand + weekly_demand / 7 * 3 - current_stock AS need FROM ({_OPP}))"""
_HEADS = f"""SELECT order_date, supplier_id, arg_min(atp_delivery_date, productId || atp_delivery_date::VARCHAR) AS expected_delivery_date,
                    'PO_' || strftime(order_date, '%Y%m%d') || '_' || (ROW_NUMBER() OVER (ORDER BY order_date, supplier_id) + 999) AS po_id FROM ({_SIZED}) GROUP BY order_date, supplier_id"""
_LINES = f"""SELECT *, ROW_NUMBER() OVER (ORDER BY order_date, supplier_id, productId, atp_delivery_date) + 999 AS line,
                    lpad(ROW_NUMBER() OVER (PARTITION BY order_date, supplier_id, productId ORDER BY atp_delivery_date)::VARCHAR, 3, '0') AS batch
             FROM ({_SIZED}) WHERE order_quantity > 0"""
_DUE_DAY = "DATE '2001-08-06'"


def headers_sql(latest: str) -> str:
    """Purchase-order headers, with the newest forecasts taken from ``latest``."""
    return f"""SELECT h.po_id, h.supplier_id, h.order_date, h.expected_delivery_date, 'PENDING' AS po_status, SUM(order_quantity)::BIGINT AS total_items,
                      ROUND(SUM(price_pence * order_quantity)::DECIMAL(28,4) * 0.0070, 2)::DOUBLE AS total_amount
               FROM ({_HEADS}) h JOIN ({_LINES}) l ON h.order_date = l.order_date AND h.supplier_id = l.supplier_id GROUP BY ALL""".replace("v_latest", latest)


def _opportunities(m):
    return p.order_opportunities(m.product_ordering_calendar, m.products, m.suppliers, m.stock, m.forecasts, AS_OF)


def _received(m, table):
    rejected = m.inbound_deliveries.filter(F.col("delivery_id").endswith("7")).select("delivery_id")
    return p.receive_deliveries(m.inbound_deliveries, m.products, m.purchase_orders, m.stock, date(2001, 8, 6), rejected)[table]


def register(s: Suite) -> None:
    s.add(
        "business_calendar",
        lambda m: p.business_calendar(m.orders, "orderDate", "deliveryDate", HOLIDAYS),
        """SELECT g::DATE AS business_day FROM (SELECT UNNEST(generate_series(MIN(orderDate), MAX(deliveryDate), INTERVAL 1 DAY)) AS g FROM m_orders)
           WHERE isodow(g) < 6 AND g::DATE <> DATE '2001-08-27'""",
    )
    s.add("supplier_schedule", lambda m: m.supplier_schedules, "SELECT * FROM m_sched")
    s.add(
        "lead_time_distribution",
        lambda m: p.lead_time_distribution(m.suppliers, F.col("lead_time_days")),
        f"SELECT lead_time_days, COUNT(*) AS suppliers, {r('COUNT(*)::DOUBLE * 100 / (SUM(COUNT(*)) OVER ())::DOUBLE', 1)} AS percentage FROM m_suppliers GROUP BY lead_time_days",
    )
    s.add(
        "lead_time_distribution_drawn",
        lambda m: p.lead_time_distribution(m.suppliers),
        f"""SELECT lead_time_days, COUNT(*) AS suppliers, {r('COUNT(*)::DOUBLE * 100 / (SUM(COUNT(*)) OVER ())::DOUBLE', 1)} AS percentage
            FROM (SELECT CASE WHEN d < 10 THEN 1 WHEN d < 33 THEN 2 WHEN d < 66 THEN 3 WHEN d < 89 THEN 4 ELSE 5 END::BIGINT AS lead_time_days
                  FROM (SELECT ('0x' || substr(md5('0|' || supplier_id), 1, 12))::BIGINT % 100 AS d FROM m_suppliers)) GROUP BY lead_time_days""",
    )
    s.add(
        "minimum_orders_drawn",
        lambda m: p.ordering_calendar(m.products, m.supplier_schedules, m.product_purge_reference, as_of=AS_OF).groupBy("productId").agg(F.min("min_order_quantity").alias("low"), F.max("min_order_quantity").alias("high")),
        """SELECT productId, q AS low, q AS high FROM (SELECT productId, CASE WHEN category = 'Fresh Food' THEN h % 20 + 20 WHEN category = 'Chilled Food' THEN h % 15 + 15 ELSE h % 15 + 10 END AS q
             FROM (SELECT *, ('0x' || substr(md5('0|' || productId), 1, 12))::BIGINT AS h FROM m_products)) WHERE productId IN (SELECT productId FROM m_cal)""",
    )
    s.add(
        "schedule_window",
        lambda m: p.schedule_window(m.supplier_schedules, m.suppliers, date(2001, 8, 6), date(2001, 8, 10), [1, 2, 3, 4, 5]),
        """SELECT s.supplier_name, delivery_date, po_cutoff_date, po_cutoff_time, c.lead_time_days FROM m_sched c JOIN m_suppliers s ON c.supplier_id = s.supplier_id
           WHERE delivery_date BETWEEN DATE '2001-08-06' AND DATE '2001-08-10' AND c.supplier_id IN (1, 2, 3, 4, 5)""",
    )
    s.add(
        "next_valid_delivery",
        lambda m: p.next_valid_delivery(m.supplier_schedules, AS_OF),
        f"SELECT supplier_id, MIN(delivery_date) AS next_delivery FROM m_sched WHERE delivery_date >= {A} + CAST(lead_time_days AS INTEGER) AND po_cutoff_date >= {A} GROUP BY supplier_id",
    )
    s.add(
        "ordering_calendar",
        lambda m: m.product_ordering_calendar,
        """SELECT productId, supplier_id, order_date, atp_delivery_date, next_atp_delivery_date, purge_date, lead_time_days, min_order_quantity, order_multiple::BIGINT AS order_multiple,
                  contingency_days_in_advance::BIGINT AS contingency_days_in_advance, contingency_days_of_demand::BIGINT AS contingency_days_of_demand, is_active FROM m_cal""",
    )
    s.add(
        "calendar_stats",
        lambda m: p.calendar_stats(m.product_ordering_calendar),
        """SELECT COUNT(DISTINCT productId) AS unique_products, COUNT(DISTINCT supplier_id) AS unique_suppliers, COUNT(*) AS total_entries, MIN(order_date) AS earliest_order,
                  MAX(order_date) AS latest_order, SUM(lead_time_days)::DOUBLE / COUNT(*) AS avg_lead_time FROM m_cal WHERE is_active""",
    )
    s.add(
        "next_opportunities",
        lambda m: p.next_opportunities(m.product_ordering_calendar, m.products, m.suppliers),
        """SELECT c.productId, q.name, s.supplier_name, order_date, atp_delivery_date, min_order_quantity
           FROM m_cal c JOIN m_products q ON c.productId = q.productId JOIN m_suppliers s ON c.supplier_id = s.supplier_id
           WHERE is_active ORDER BY order_date, atp_delivery_date, c.productId LIMIT 5""",
    )
    s.add(
        "order_requirements",
        lambda m: p.order_requirements(m.product_ordering_calendar, m.forecasts, m.stock, m.inbound_deliveries, AS_OF, AS_OF + timedelta(days=3), AS_OF + timedelta(days=5)),
        f"""WITH x AS (SELECT c.productId, c.supplier_id, c.atp_delivery_date, d * contingency_days_of_demand AS gross_requirement, COALESCE(h.current_stock, 0) AS current_stock, COALESCE(t, 0) AS in_transit,
                              min_order_quantity, order_multiple, d * contingency_days_of_demand - COALESCE(h.current_stock, 0) - COALESCE(t, 0) AS net_requirement
                       FROM m_cal c JOIN (SELECT productId, SUM(predicted_quantity) AS d FROM m_forecasts WHERE target_date BETWEEN {A} AND {A} + 3 GROUP BY productId) f ON c.productId = f.productId
                       LEFT JOIN v_onhand h ON c.productId = h.productId
                       LEFT JOIN (SELECT productId, SUM(quantity)::BIGINT AS t FROM m_inbound WHERE status = 'PENDING' GROUP BY productId) i ON c.productId = i.productId
                       WHERE c.atp_delivery_date = {A} + 5)
            SELECT productId, supplier_id, atp_delivery_date, gross_requirement, current_stock, in_transit, net_requirement,
                   CASE WHEN net_requirement <= 0 THEN 0 WHEN net_requirement < min_order_quantity THEN min_order_quantity ELSE CEIL(net_requirement / order_multiple) * order_multiple END::BIGINT AS order_quantity FROM x""",
    )
    s.add("order_opportunities", lambda m: _opportunities(m), f"SELECT * REPLACE (order_multiple::BIGINT AS order_multiple, weekly_demand::DOUBLE AS weekly_demand) FROM ({_OPP})")
    s.add(
        "order_quantity_weekly",
        lambda m: p.with_order_quantity(_opportunities(m)).select("productId", "order_date", "atp_delivery_date", "weekly_demand", "current_stock", "order_quantity"),
        f"SELECT productId, order_date, atp_delivery_date, weekly_demand::DOUBLE AS weekly_demand, current_stock, order_quantity FROM ({_SIZED})",
    )
    s.add(
        "order_quantity_contingency",
        lambda m: _opportunities(m).select(
            "productId", "order_date", "atp_delivery_date",
            p.order_quantity("contingency", F.col("weekly_demand") / 7, F.col("current_stock"), F.col("min_order_quantity"), F.col("order_multiple"), contingency_days=F.lit(4)).alias("order_quantity"),
        ),
        f"""SELECT productId, order_date, atp_delivery_date, GREATEST(min_order_quantity, CEIL((weekly_demand / 7 * 4 - current_stock) / order_multiple) * order_multiple)::BIGINT AS order_quantity FROM ({_OPP})""",
    )
    s.add("purchase_order_headers", lambda m: p.purchase_orders(_opportunities(m))[0], headers_sql("v_latest"))
    s.add(
        "purchase_order_lines",
        lambda m: p.purchase_orders(_opportunities(m))[1],
        f"""SELECT 'DEL_' || strftime(l.order_date, '%Y%m%d') || '_' || line AS delivery_id, po_id, productId, productId || '-' || strftime(atp_delivery_date, '%Y%m%d') || '-' || batch AS sku,
                   order_quantity AS quantity, ROUND(price_pence::DECIMAL(14,4) * 0.0070, 2)::DOUBLE AS unit_cost, atp_delivery_date AS expected_delivery_date, NULL::DATE AS actual_delivery_date,
                   atp_delivery_date + CAST((purge_date - atp_delivery_date) * 4 // 5 AS INTEGER) AS expiration_date, 'BATCH_' || strftime(atp_delivery_date, '%Y%m%d') || '_' || batch AS batch_number, 'PENDING' AS status
            FROM ({_LINES}) l JOIN ({_HEADS}) h ON h.order_date = l.order_date AND h.supplier_id = l.supplier_id""",
    )
    s.add(
        "po_rollup",
        lambda m: m.purchase_orders,
        "SELECT po_id, supplier_id, order_date, expected_delivery_date, po_status, total_items, total_pence::DOUBLE / 100 AS total_amount FROM m_po",
    )
    s.add(
        "po_summary_by_date",
        lambda m: p.po_summary_by_date(m.purchase_orders, AS_OF, AS_OF + timedelta(days=3)),
        f"""SELECT order_date, COUNT(DISTINCT po_id) AS num_pos, COUNT(DISTINCT supplier_id) AS num_suppliers, SUM(total_items)::BIGINT AS total_units, SUM(total_pence)::DOUBLE / 100 AS total_value
            FROM m_po WHERE order_date BETWEEN {A} AND {A} + 3 GROUP BY order_date""",
    )
    s.add(
        "top_ordered",
        lambda m: p.top_ordered(m.inbound_deliveries, m.purchase_orders, m.products, AS_OF, AS_OF + timedelta(days=3)),
        f"""SELECT q.name AS product_name, COUNT(DISTINCT i.po_id) AS num_orders, SUM(i.quantity)::BIGINT AS total_quantity, SUM(i.quantity * cost_pence)::DOUBLE / 100 AS total_value
            FROM m_inbound i JOIN m_products q ON i.productId = q.productId JOIN m_po o ON i.po_id = o.po_id WHERE o.order_date BETWEEN {A} AND {A} + 3
            GROUP BY q.name ORDER BY total_value DESC, product_name LIMIT 10""",
    )
    s.add(
        "delivery_schedule",
        lambda m: p.delivery_schedule(m.inbound_deliveries, AS_OF),
        f"""SELECT expected_delivery_date, COUNT(DISTINCT po_id) AS num_pos, COUNT(*) AS num_deliveries, SUM(quantity)::BIGINT AS total_units FROM m_inbound
            WHERE expected_delivery_date BETWEEN {A} AND {A} + 7 GROUP BY 1""",
    )
    s.add(
        "register_new_skus",
        lambda m: p.register_new_skus(m.inbound_deliveries, m.product_skus),
        """SELECT DISTINCT productId, sku, substr(sku, length(productId) + 2) AS sku_suffix, FALSE AS is_primary FROM m_inbound i
           WHERE NOT EXISTS (SELECT 1 FROM m_skus k WHERE k.sku = i.sku)""",
    )
    updated = f"""SELECT *, status = 'PENDING' AND expected_delivery_date <= {_DUE_DAY} AS due,
                         CASE WHEN status = 'PENDING' AND expected_delivery_date <= {_DUE_DAY} THEN CASE WHEN delivery_id LIKE '%7' THEN 'REJECTED' ELSE 'RECEIVED' END ELSE status END AS now_status FROM m_inbound"""
    s.add(
        "receive_deliveries_stock",
        lambda m: _received(m, "stock"),
        f"""SELECT (SELECT MAX(stock_id) FROM m_stock) + ROW_NUMBER() OVER (ORDER BY u.expected_delivery_date, u.productId, delivery_id) AS stock_id, sku, u.productId, quantity::BIGINT AS quantity_in_stock,
                   expiration_date, batch_number, {_DUE_DAY} AS received_date,
                   CASE WHEN q.category = 'Chilled Food' OR COALESCE(q.subcategory = 'Cheese', FALSE) THEN 'CHILLED' WHEN q.category = 'Frozen Food' OR COALESCE(q.subcategory IN ('Ice Cream', 'Frozen Fish'), FALSE) THEN 'FROZEN' ELSE 'AMBIENT' END AS temperature_zone,
                   'AVAILABLE' AS stock_status, cost_pence::DOUBLE / 100 AS purchase_price, o.supplier_id
            FROM ({updated}) u JOIN m_products q ON u.productId = q.productId JOIN m_po o ON u.po_id = o.po_id WHERE due AND now_status = 'RECEIVED'""",
    )
    s.add(
        "receive_deliveries_lines",
        lambda m: _received(m, "inbound_deliveries").select("delivery_id", "po_id", "status", "actual_delivery_date"),
        f"SELECT delivery_id, po_id, now_status AS status, CASE WHEN due THEN {_DUE_DAY} ELSE actual_delivery_date END AS actual_delivery_date FROM ({updated})",
    )
    s.add(
        "receive_deliveries_orders",
        lambda m: _received(m, "purchase_orders").select("po_id", "po_status"),
        f"""SELECT o.po_id, CASE WHEN t > 0 AND n = 0 THEN 'DELIVERED' ELSE o.po_status END AS po_status
            FROM m_po o JOIN (SELECT po_id, COUNT(*) FILTER (due) AS t, COUNT(*) FILTER (now_status = 'PENDING') AS n FROM ({updated}) GROUP BY po_id) u ON o.po_id = u.po_id""",
    )
    s.add(
        "delivery_sizes",
        lambda m: p.delivery_sizes(m.products),
        """SELECT productId, name, category, subcategory, CASE WHEN category = 'Food Cupboard' AND subcategory LIKE '%Spice%' THEN 'low_volume' ELSE 'medium_volume' END AS volume_category,
                  CASE WHEN category = 'Food Cupboard' AND subcategory LIKE '%Spice%' THEN 10 ELSE 20 END::BIGINT AS min_size, CASE WHEN category = 'Food Cupboard' AND subcategory LIKE '%Spice%' THEN 20 ELSE 40 END::BIGINT AS max_size
           FROM m_products""",
    )
