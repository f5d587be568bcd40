"""The published views."""

from shelfline.operators import views as v
from shelfline.sources.bridge import AS_OF, BASKET_NOW
from suite.model_sql import AS_OF as A
from suite.model_sql import BASKET_NOW as NOW
from suite.registry import Suite


def register(s: Suite) -> None:
    s.add(
        "customer_analytics",
        lambda m: v.customer_analytics(m.customers, m.orders),
        """SELECT customerId, first_name, last_name, email, city, postcode, total_orders, delivered_orders, cancelled_orders,
                  lifetime_value, avg_order_value, first_order, last_order FROM v_customer""",
    )
    s.add(
        "product_performance",
        lambda m: v.product_performance(m.products, m.sales),
        """SELECT p.productId, p.name, p.brandName, p.category, p.subcategory, p.price_gbp::DOUBLE AS price_gbp,
                  COALESCE(times, 0) AS times_ordered, units AS units_sold, pence::DOUBLE / 100 AS revenue,
                  RANK() OVER (ORDER BY units DESC NULLS LAST) AS sales_rank
           FROM m_products p LEFT JOIN (SELECT productId, COUNT(DISTINCT orderId) AS times, SUM(quantity)::BIGINT AS units, SUM(line_pence) AS pence
                                        FROM m_sales GROUP BY productId) s ON p.productId = s.productId""",
    )
    s.add(
        "stock_availability",
        lambda m: v.stock_availability(m.stock, m.products, AS_OF),
        "SELECT * FROM v_stock",
    )
    s.add("latest_forecasts", lambda m: v.latest_forecasts(m.forecasts), "SELECT * FROM v_latest")
    s.add(
        "pending_deliveries",
        lambda m: v.pending_deliveries(m.inbound_deliveries, m.products, AS_OF),
        f"""SELECT i.productId, p.name AS product_name, i.expected_delivery_date, SUM(i.quantity)::BIGINT AS total_quantity,
                   COUNT(DISTINCT i.po_id) AS num_orders, SUM(cost_pence)::DOUBLE / COUNT(cost_pence) / 100 AS avg_unit_cost
            FROM m_inbound i JOIN m_products p ON i.productId = p.productId
            WHERE status = 'PENDING' AND expected_delivery_date >= {A} GROUP BY ALL""",
    )
    s.add(
        "product_catalog",
        lambda m: v.product_catalog(m.products, m.product_skus),
        """SELECT p.productId, p.name, p.brandName, p.sellingSize, p.category, p.subcategory, p.price_gbp::DOUBLE AS price_gbp,
                  a.sku AS primary_sku, COUNT(DISTINCT b.sku) AS total_skus
           FROM m_products p LEFT JOIN m_skus a ON a.productId = p.productId AND a.is_primary LEFT JOIN m_skus b ON b.productId = p.productId
           GROUP BY ALL""",
    )
    s.add(
        "stock_summary",
        lambda m: v.stock_summary(m.stock, m.products, AS_OF),
        f"""SELECT s.productId, p.name AS product_name, p.category, p.subcategory, COUNT(DISTINCT s.sku) AS num_skus,
                   COUNT(DISTINCT batch_number) AS num_batches, SUM(quantity_in_stock)::BIGINT AS total_stock,
                   MIN(expiration_date) AS earliest_expiration, MAX(expiration_date) AS latest_expiration,
                   SUM(CASE WHEN expiration_date <= {A} + 7 THEN quantity_in_stock ELSE 0 END)::BIGINT AS expiring_soon_qty
            FROM m_stock s JOIN m_products p ON s.productId = p.productId WHERE stock_status = 'AVAILABLE' GROUP BY ALL""",
    )
    s.add(
        "supplier_delivery_calendar",
        lambda m: v.supplier_delivery_calendar(m.supplier_schedules, m.suppliers),
        """SELECT c.supplier_id, s.supplier_name, s.contact_email, c.delivery_date, c.po_cutoff_date, c.po_cutoff_time,
                  c.lead_time_days, dayname(c.delivery_date) AS delivery_day_of_week
           FROM m_sched c JOIN m_suppliers s ON c.supplier_id = s.supplier_id""",
    )
    s.add(
        "future_purges",
        lambda m: v.future_purges(m.stock, m.products, AS_OF),
        f"""SELECT s.sku, s.productId, p.name AS product_name, quantity_in_stock::BIGINT AS quantity_to_purge, expiration_date AS purge_date, batch_number,
                   CASE WHEN expiration_date < {A} THEN 'EXPIRED' WHEN expiration_date = {A} THEN 'EXPIRING_TODAY'
                        WHEN expiration_date <= {A} + 3 THEN 'EXPIRING_SOON' ELSE 'FUTURE' END AS purge_status
            FROM m_stock s JOIN m_products p ON s.productId = p.productId WHERE quantity_in_stock > 0 AND stock_status = 'AVAILABLE'""",
    )
    s.add(
        "stock_by_zone",
        lambda m: v.stock_by_zone(m.stock),
        """SELECT temperature_zone, COUNT(DISTINCT productId) AS num_products, COUNT(DISTINCT sku) AS num_skus,
                  SUM(quantity_in_stock)::BIGINT AS total_items, COUNT(DISTINCT batch_number) AS num_batches
           FROM m_stock WHERE stock_status = 'AVAILABLE' GROUP BY temperature_zone""",
    )
    s.add(
        "product_expiration_guide",
        lambda m: v.product_expiration_guide(m.products, m.product_purge_reference),
        """SELECT p.productId, p.name AS product_name, p.category, p.subcategory, h.shelf_life_days::BIGINT AS shelf_life_days,
                  h.min_shelf_life_days::BIGINT AS min_shelf_life_days, h.max_shelf_life_days::BIGINT AS max_shelf_life_days,
                  h.temperature_sensitive, h.requires_refrigeration, h.notes AS storage_notes, p.price_pence::BIGINT AS price_pence, p.price_gbp::DOUBLE AS price_gbp
           FROM m_products p LEFT JOIN m_shelf h ON p.category = h.category AND p.subcategory IS NOT DISTINCT FROM h.subcategory""",
    )
    s.add(
        "itb_summary",
        lambda m: v.itb_summary(m.live_basket, m.products, BASKET_NOW),
        f"""SELECT b.productId, p.name AS product_name, COUNT(DISTINCT session_id) AS active_sessions, SUM(quantity)::BIGINT AS total_quantity,
                   SUM(quantity)::DOUBLE / COUNT(*) AS avg_quantity_per_session, MIN(added_at) AS earliest_add, MAX(added_at) AS latest_add
            FROM m_basket b JOIN m_products p ON b.productId = p.productId
            WHERE status = 'ACTIVE' AND (expires_at IS NULL OR expires_at > {NOW}) GROUP BY ALL""",
    )
    s.add(
        "forecast_accuracy",
        lambda m: v.forecast_accuracy(m.forecasts, m.sales),
        """SELECT f.productId, f.forecast_date, f.target_date, f.forecast_horizon, f.predicted_quantity, d.daily_quantity AS actual_quantity,
                  ABS(f.predicted_quantity - d.daily_quantity) AS absolute_error,
                  CASE WHEN d.daily_quantity > 0 THEN (f.predicted_quantity - d.daily_quantity) / d.daily_quantity END AS relative_error
           FROM m_forecasts f JOIN v_day_demand d ON f.productId = d.productId AND f.target_date = d.sale_day""",
    )
