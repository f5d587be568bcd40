"""Stock, risk and delivery questions."""

from datetime import date, timedelta

from shelfline.operators import stock as k
from shelfline.sources.bridge import AS_OF
from suite.model_sql import AS_OF as A
from suite.model_sql import half_up as r
from suite.registry import Suite


def _daily(days: int) -> str:
    return f"(SELECT * FROM v_day_demand WHERE sale_day >= {A} - {days})"


def _avg(days: int) -> str:
    return f"(SELECT productId, SUM(daily_quantity)::DOUBLE / COUNT(*) AS a FROM {_daily(days)} GROUP BY productId)"


def _fc(days: int) -> str:
    return f"(SELECT productId, SUM(predicted_quantity) AS d FROM m_forecasts WHERE target_date >= {A} AND target_date < {A} + {days} GROUP BY productId)"


def _in(days: int) -> str:
    return f"(SELECT productId, SUM(quantity)::BIGINT AS i FROM m_inbound WHERE status = 'PENDING' AND expected_delivery_date >= {A} AND expected_delivery_date < {A} + {days} GROUP BY productId)"


def _positions(days: int) -> str:
    return f"""SELECT p.productId, p.name AS product_name, p.category, COALESCE(h.current_stock, 0) AS current_stock, COALESCE(i, 0) AS incoming_stock, COALESCE(d, 0) AS expected_demand,
                      COALESCE(h.current_stock, 0) + COALESCE(i, 0) - COALESCE(d, 0) AS net_position
               FROM m_products p LEFT JOIN v_onhand h ON p.productId = h.productId LEFT JOIN {_fc(days)} f ON p.productId = f.productId LEFT JOIN {_in(days)} n ON p.productId = n.productId"""


_RISK = f"""SELECT *, CASE WHEN net_position < 0 THEN 'STOCKOUT' WHEN net_position = 0 THEN 'ZERO_STOCK' WHEN net_position < expected_demand * 0.2::DOUBLE THEN 'CRITICAL_LOW' ELSE 'LOW_STOCK' END AS risk_status
            FROM ({_positions(3)}) WHERE net_position < expected_demand * 0.5::DOUBLE"""
_LOW = f"""SELECT p.productId, p.name AS product_name, p.category, COALESCE(current_stock, 0) AS current_stock, COALESCE(a, 0) AS avg_daily_demand, CASE WHEN a > 0 THEN current_stock / a END AS days_of_stock
           FROM m_products p LEFT JOIN v_onhand h ON p.productId = h.productId
           LEFT JOIN (SELECT productId, AVG(predicted_quantity) AS a FROM v_latest WHERE target_date <= {A} + 7 GROUP BY productId) f ON p.productId = f.productId
           WHERE current_stock < 50 OR (a > 0 AND current_stock / a < 3)"""
_BY_CATEGORY = f"""SELECT p.category, COUNT(DISTINCT s.productId) AS num_products, COUNT(DISTINCT s.sku) AS num_skus, SUM(quantity_in_stock)::BIGINT AS total_units,
                          SUM(quantity_in_stock * cost_pence)::DOUBLE / 100 AS inventory_value, SUM(CASE WHEN expiration_date <= {A} + 7 THEN quantity_in_stock ELSE 0 END)::BIGINT AS expiring_soon
                   FROM m_stock s JOIN m_products p ON s.productId = p.productId WHERE stock_status = 'AVAILABLE' GROUP BY p.category"""
_EXPIRING = f"""SELECT p.name AS product_name, batch_number, quantity_in_stock::BIGINT AS quantity_in_stock, expiration_date, expiration_date - {A} AS days_until_expiry, stock_id
                FROM m_stock s JOIN m_products p ON s.productId = p.productId WHERE stock_status = 'AVAILABLE' AND expiration_date <= {A} + 7"""
_CAPACITY = f"""SELECT p.productId, p.name AS product_name, p.category, p.subcategory, h.shelf_life_days::BIGINT AS shelf_life_days, h.temperature_sensitive, h.requires_refrigeration,
                       mx AS max_daily_sales, a AS avg_daily_sales, n AS days_sold, mx * 2 AS warehouse_capacity
                FROM (SELECT productId, MAX(daily_quantity) AS mx, SUM(daily_quantity)::DOUBLE / COUNT(*) AS a, COUNT(*) AS n FROM {_daily(30)} GROUP BY productId) d
                JOIN m_products p ON d.productId = p.productId LEFT JOIN m_shelf h ON p.category = h.category AND p.subcategory IS NOT DISTINCT FROM h.subcategory"""


def _capacity(m):
    return k.stock_capacity(m.sales, m.products, m.product_purge_reference, AS_OF)


def _risk(m, limit=50):
    return k.risk_list(m.products, m.stock, m.forecasts, m.inbound_deliveries, AS_OF, 3, limit)


def register(s: Suite) -> None:
    s.add("stock_capacity", _capacity, _CAPACITY)
    s.add(
        "split_into_batches",
        lambda m: k.split_into_batches(_capacity(m), m.product_skus, AS_OF),
        f"""WITH c AS ({_CAPACITY}), n AS (SELECT productId, LEAST(COUNT(*), 5) AS nb FROM m_skus GROUP BY productId),
                 t AS (SELECT k.productId, k.sku, ROW_NUMBER() OVER (PARTITION BY k.productId ORDER BY k.sku) - 1 AS i FROM m_skus k),
                 b AS (SELECT t.sku, t.productId, t.i, nb, warehouse_capacity // nb AS base, COALESCE(shelf_life_days, 30) AS life, requires_refrigeration,
                              (nb - i - 1) * (COALESCE(shelf_life_days, 30) // nb) AS age FROM c JOIN n ON c.productId = n.productId JOIN t ON c.productId = t.productId WHERE i < 5)
            SELECT sku, productId, FLOOR(base * CASE i WHEN 0 THEN 0.5 WHEN 1 THEN 0.75 ELSE 1 END)::BIGINT AS quantity_in_stock, {A} + (life - age)::INTEGER AS expiration_date,
                   'BATCH-' || substr(productId, 1, 8) || '-' || strftime({A} + (life - age)::INTEGER, '%Y%m%d') AS batch_number, {A} - age::INTEGER AS received_date,
                   CASE WHEN requires_refrigeration THEN 'CHILLED' ELSE 'AMBIENT' END AS temperature_zone, 'AVAILABLE' AS stock_status FROM b""",
    )
    s.add(
        "product_zones",
        lambda m: k.product_zones(m.products),
        """SELECT productId, name, category, subcategory, supplier_id,
                  CASE WHEN category = 'Chilled Food' OR COALESCE(subcategory = 'Cheese', FALSE) THEN 'CHILLED'
                       WHEN category = 'Frozen Food' OR COALESCE(subcategory IN ('Ice Cream', 'Frozen Fish'), FALSE) THEN 'FROZEN' ELSE 'AMBIENT' END AS temp_zone FROM m_products""",
    )
    s.add(
        "stock_zone_stats",
        lambda m: k.stock_zone_stats(m.stock),
        f"""SELECT temperature_zone, COUNT(DISTINCT productId) AS products, COUNT(DISTINCT sku) AS skus, SUM(quantity_in_stock)::BIGINT AS total_items,
                   {r('SUM(quantity_in_stock)::DOUBLE / COUNT(*)', 1)} AS avg_items_per_sku FROM m_stock GROUP BY temperature_zone""",
    )
    s.add(
        "expiration_timeline",
        lambda m: k.expiration_timeline(m.stock, AS_OF),
        f"""SELECT CASE WHEN expiration_date <= {A} THEN 'Expired' WHEN expiration_date <= {A} + 3 THEN '1-3 days' WHEN expiration_date <= {A} + 7 THEN '4-7 days'
                        WHEN expiration_date <= {A} + 14 THEN '8-14 days' WHEN expiration_date <= {A} + 30 THEN '15-30 days' ELSE '30+ days' END AS expiration_range,
                   COUNT(*) AS num_batches, SUM(quantity_in_stock)::BIGINT AS total_items FROM m_stock WHERE stock_status = 'AVAILABLE' GROUP BY 1""",
    )
    s.add(
        "stock_of_top_products",
        lambda m: k.stock_of_top_products(m.stock, m.products),
        """SELECT p.name AS product, s.sku, quantity_in_stock::BIGINT AS qty, expiration_date AS expires, batch_number AS batch, temperature_zone AS zone, stock_id
           FROM m_stock s JOIN m_products p ON s.productId = p.productId
           WHERE s.productId IN (SELECT productId FROM v_onhand ORDER BY current_stock DESC, productId LIMIT 3) ORDER BY product, expires, s.sku, stock_id LIMIT 15""",
    )
    s.add("inventory_by_category", lambda m: k.inventory_by_category(m.stock, m.products, AS_OF), _BY_CATEGORY)
    s.add(
        "low_stock",
        lambda m: k.low_stock(m.products, m.stock, m.forecasts, AS_OF),
        f"{_LOW} ORDER BY days_of_stock NULLS FIRST, p.productId LIMIT 20",
    )
    s.add("low_stock_all", lambda m: k.low_stock(m.products, m.stock, m.forecasts, AS_OF, k=None), _LOW)
    s.add(
        "low_stock_pending",
        lambda m: k.low_stock_pending(m.products, m.stock, m.inbound_deliveries, AS_OF, k=None),
        f"""SELECT p.productId, p.name AS product_name, COALESCE(v.total_quantity, 0) AS current_stock, COALESCE(v.expiring_week_qty, 0) AS expiring_soon, COALESCE(n, 0) AS pending_deliveries
            FROM m_products p LEFT JOIN v_stock v ON p.productId = v.productId
            LEFT JOIN (SELECT productId, COUNT(DISTINCT expected_delivery_date) AS n FROM m_inbound WHERE status = 'PENDING' AND expected_delivery_date >= {A} GROUP BY productId) d ON p.productId = d.productId
            WHERE COALESCE(v.total_quantity, 0) < 50""",
    )
    s.add("expiring_batches", lambda m: k.expiring_batches(m.stock, m.products, AS_OF), f"{_EXPIRING} ORDER BY expiration_date, stock_id, batch_number LIMIT 20")
    s.add("expiring_batches_all", lambda m: k.expiring_batches(m.stock, m.products, AS_OF, k=None), _EXPIRING)
    s.add(
        "inventory_report_summary",
        lambda m: k.inventory_report_summary(m.products, m.stock, m.forecasts, AS_OF),
        f"""SELECT (SELECT SUM(quantity_in_stock * cost_pence) FROM m_stock WHERE stock_status = 'AVAILABLE')::DOUBLE / 100 AS total_inventory_value,
                   (SELECT SUM(total_units) FROM ({_BY_CATEGORY}))::BIGINT AS total_units_in_stock, (SELECT SUM(expiring_soon) FROM ({_BY_CATEGORY}))::BIGINT AS units_expiring_soon,
                   (SELECT COUNT(*) FROM ({_LOW})) AS products_with_low_stock, (SELECT COUNT(*) FROM ({_EXPIRING})) AS products_expiring_soon""",
    )
    s.add(
        "inventory_report_summary_of_lists",
        lambda m: k.inventory_report_summary(m.products, m.stock, m.forecasts, AS_OF, k=20),
        f"""SELECT (SELECT SUM(quantity_in_stock * cost_pence) FROM m_stock WHERE stock_status = 'AVAILABLE')::DOUBLE / 100 AS total_inventory_value,
                   (SELECT SUM(total_units) FROM ({_BY_CATEGORY}))::BIGINT AS total_units_in_stock, (SELECT SUM(expiring_soon) FROM ({_BY_CATEGORY}))::BIGINT AS units_expiring_soon,
                   LEAST((SELECT COUNT(*) FROM ({_LOW})), 20) AS products_with_low_stock, LEAST((SELECT COUNT(*) FROM ({_EXPIRING})), 20) AS products_expiring_soon""",
    )
    s.add(
        "two_day_cover",
        lambda m: k.two_day_cover(m.products, m.sales, m.stock, AS_OF),
        f"""SELECT p.productId, p.name AS product_name, p.category, p.subcategory, COALESCE(current_stock, 0) AS current_stock, {r('a', 2)} AS avg_daily_sales, {r('a * 2', 2)} AS needed_for_2_days,
                   CASE WHEN COALESCE(current_stock, 0) >= a * 2 THEN 'SUFFICIENT' WHEN COALESCE(current_stock, 0) > 0 THEN 'LOW' ELSE 'OUT_OF_STOCK' END AS stock_status,
                   {r('COALESCE(current_stock, 0) / a', 1)} AS days_of_stock_remaining, earliest_expiration
            FROM m_products p JOIN {_avg(7)} d ON p.productId = d.productId LEFT JOIN v_onhand h ON p.productId = h.productId WHERE a > 0""",
    )
    s.add(
        "stockout_risk",
        lambda m: k.stockout_risk(m.products, m.sales, m.stock, m.inbound_deliveries, AS_OF),
        f"""WITH d AS (SELECT productId, SUM(daily_quantity)::DOUBLE / COUNT(*) AS a, MAX(daily_quantity) AS mx, STDDEV_SAMP(daily_quantity) AS sd FROM {_daily(14)} GROUP BY productId),
                 l AS (SELECT productId, SUM(quantity_in_stock)::BIGINT AS h, SUM(CASE WHEN expiration_date <= {A} + 2 THEN quantity_in_stock ELSE 0 END)::BIGINT AS e
                       FROM m_stock WHERE stock_status = 'AVAILABLE' GROUP BY productId),
                 n AS (SELECT productId, SUM(quantity)::BIGINT AS i, MIN(expected_delivery_date) AS nd FROM m_inbound WHERE status IN ('PENDING', 'SHIPPED') AND expected_delivery_date <= {A} + 2 GROUP BY productId)
            SELECT p.productId, p.name AS product_name, p.category, p.subcategory, COALESCE(h, 0) AS current_stock, {r('a', 2)} AS avg_daily_demand, {r('mx', 2)} AS peak_daily_demand,
                   {r('sd', 2)} AS demand_stddev, {r('a * 2', 2)} AS expected_2day_demand, {r('mx * 2', 2)} AS peak_2day_demand,
                   {r('COALESCE(h, 0) - ' + r('a * 2', 2), 2)} AS stock_surplus_deficit, COALESCE(i, 0) AS incoming_stock, nd AS next_delivery, e AS expiring_in_2_days,
                   CASE WHEN COALESCE(h, 0) < a * 2 THEN 'HIGH_RISK' WHEN COALESCE(h, 0) < mx * 2 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_level, {r('COALESCE(h, 0) / a', 1)} AS days_of_coverage
            FROM m_products p JOIN d ON p.productId = d.productId LEFT JOIN l ON p.productId = l.productId LEFT JOIN n ON p.productId = n.productId
            WHERE a > 0 AND (COALESCE(h, 0) < mx * 2 OR e > 0)""",
    )
    pct = r("COUNT(*) FILTER (c < 2)::DOUBLE * 100 / COUNT(*)", 2)
    counts = f"COUNT(*) AS total_products, COUNT(*) FILTER (c < 2) AS products_low_stock, COUNT(*) FILTER (c = 0) AS products_out_of_stock, {pct} AS pct_at_risk"
    s.add(
        "stock_health",
        lambda m: k.stock_health(m.products, m.sales, m.stock, AS_OF),
        f"""WITH x AS (SELECT p.category, COALESCE(current_stock, 0) / a AS c FROM m_products p JOIN {_avg(7)} d ON p.productId = d.productId LEFT JOIN v_onhand h ON p.productId = h.productId WHERE a > 0)
            SELECT 'Overall' AS category, {counts} FROM x UNION ALL SELECT category, {counts} FROM x GROUP BY category""",
    )
    s.add(
        "stockout_date",
        lambda m: k.stockout_date(m.products, m.stock, m.forecasts, AS_OF),
        f"""WITH x AS (SELECT p.productId, p.name AS product_name, COALESCE(current_stock, 0) AS h, COALESCE(d, 0) AS d, CASE WHEN COALESCE(d, 0) = 0 THEN 999 ELSE COALESCE(current_stock, 0) / d END AS l
                       FROM m_products p LEFT JOIN v_onhand h ON p.productId = h.productId
                       LEFT JOIN (SELECT productId, AVG(predicted_quantity) AS d FROM m_forecasts WHERE target_date >= {A} AND target_date <= {A} + 7 GROUP BY productId) f ON p.productId = f.productId)
            SELECT productId, product_name, h AS current_stock, {r('d', 2)} AS avg_daily_demand, {r('l', 1)} AS days_until_stockout, CASE WHEN d <> 0 THEN {A} + CAST(h / d AS INTEGER) END AS estimated_stockout_date,
                   CASE WHEN l <= 1 THEN 'CRITICAL' WHEN l <= 3 THEN 'HIGH_RISK' WHEN l <= 7 THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS risk_level FROM x""",
    )
    s.add(
        "nearest_expiry",
        lambda m: k.nearest_expiry(m.stock, m.products, AS_OF),
        f"""SELECT productId, product_name, sku, quantity_in_stock, expiration_date, expiration_date - {A} AS days_until_expiration,
                   CASE WHEN expiration_date <= {A} THEN 'EXPIRED' WHEN expiration_date <= {A} + 3 THEN 'EXPIRING_SOON' WHEN expiration_date <= {A} + 7 THEN 'WARNING' ELSE 'OK' END AS expiration_status
            FROM (SELECT p.productId, p.name AS product_name, s.sku, s.quantity_in_stock::BIGINT AS quantity_in_stock, s.expiration_date,
                         ROW_NUMBER() OVER (PARTITION BY p.productId ORDER BY s.expiration_date, s.sku, s.stock_id, s.quantity_in_stock) AS n
                  FROM m_products p JOIN m_stock s ON p.productId = s.productId WHERE stock_status = 'AVAILABLE' AND quantity_in_stock > 0) WHERE n = 1""",
    )
    s.add(
        "sufficient_stock",
        lambda m: k.sufficient_stock(m.products, m.stock, m.forecasts, m.inbound_deliveries, AS_OF, 3),
        f"""SELECT productId, product_name, current_stock, incoming_stock, current_stock + incoming_stock AS total_available, expected_demand,
                   CASE WHEN net_position >= 0 THEN 'YES' ELSE 'NO' END AS sufficient_stock, net_position AS surplus_or_shortage FROM ({_positions(3)})""",
    )
    s.add(
        "next_delivery",
        lambda m: k.next_delivery(m.inbound_deliveries, m.products, m.purchase_orders, m.suppliers, AS_OF),
        f"""SELECT productId, product_name, delivery_id, expected_delivery_date, expected_delivery_date - {A} AS days_until_delivery, quantity AS incoming_quantity, sku, po_id, supplier_id, supplier_name
            FROM (SELECT p.productId, p.name AS product_name, i.delivery_id, i.expected_delivery_date, i.quantity::BIGINT AS quantity, i.sku, i.po_id, o.supplier_id, s.supplier_name,
                         ROW_NUMBER() OVER (PARTITION BY p.productId ORDER BY i.expected_delivery_date, i.delivery_id) AS n
                  FROM m_products p JOIN m_inbound i ON p.productId = i.productId JOIN m_po o ON i.po_id = o.po_id JOIN m_suppliers s ON o.supplier_id = s.supplier_id
                  WHERE i.status = 'PENDING' AND i.expected_delivery_date >= {A}) WHERE n = 1""",
    )
    s.add("risk_list", lambda m: _risk(m), f"SELECT * FROM ({_RISK}) ORDER BY net_position, expected_demand DESC, productId LIMIT 50")
    s.add("risk_list_all", lambda m: _risk(m, None), _RISK)
    s.add(
        "emergency_orders",
        lambda m: k.emergency_orders(_risk(m, None), m.product_ordering_calendar),
        f"""SELECT DISTINCT x.productId, x.product_name, ABS(net_position) AS units_needed, c.supplier_id, c.lead_time_days
            FROM ({_RISK}) x JOIN m_cal c ON x.productId = c.productId WHERE net_position < 0""",
    )
    s.add(
        "replenishment_needs",
        lambda m: k.replenishment_needs(m.forecasts, m.products, m.stock, AS_OF, AS_OF + timedelta(days=7)),
        f"""WITH d AS (SELECT productId, SUM(predicted_quantity) AS t FROM m_forecasts WHERE target_date BETWEEN {A} AND {A} + 7 AND run_id = (SELECT MAX(run_id) FROM m_forecasts) GROUP BY productId),
                 h AS (SELECT productId, SUM(quantity_in_stock)::BIGINT AS q FROM m_stock WHERE quantity_in_stock > 0 GROUP BY productId)
            SELECT d.productId, p.name AS product_name, t AS total_demand, COALESCE(q, 0) AS current_stock, t - COALESCE(q, 0) AS units_needed
            FROM d JOIN m_products p ON d.productId = p.productId LEFT JOIN h ON d.productId = h.productId WHERE t > COALESCE(q, 0) * 1.2::DOUBLE""",
    )
    s.add(
        "received_summary",
        lambda m: k.received_summary(m.inbound_deliveries, date(2001, 7, 31)),
        """SELECT status, COUNT(*) AS count, SUM(quantity)::BIGINT AS total_units, SUM(quantity * cost_pence)::DOUBLE / 100 AS total_value
           FROM m_inbound WHERE actual_delivery_date = DATE '2001-07-31' GROUP BY status""",
    )
    s.add(
        "upcoming_deliveries",
        lambda m: k.upcoming_deliveries(m.inbound_deliveries, AS_OF),
        f"""SELECT expected_delivery_date, COUNT(*) AS num_deliveries, SUM(quantity)::BIGINT AS total_units FROM m_inbound
            WHERE status = 'PENDING' AND expected_delivery_date > {A} AND expected_delivery_date <= {A} + 7 GROUP BY 1""",
    )
    s.add(
        "capacity_breaches",
        lambda m: k.capacity_breaches(m.inbound_deliveries, m.products, {"CHILLED": 100, "FROZEN": 100, "AMBIENT": 400}),
        """SELECT * FROM (SELECT i.expected_delivery_date, CASE p.category WHEN 'Chilled Food' THEN 'CHILLED' WHEN 'Frozen Food' THEN 'FROZEN' ELSE 'AMBIENT' END AS temp_zone,
                                 SUM(quantity)::BIGINT AS total_quantity FROM m_inbound i JOIN m_products p ON i.productId = p.productId GROUP BY 1, 2)
           WHERE total_quantity > CASE temp_zone WHEN 'AMBIENT' THEN 400 ELSE 100 END""",
    )
    perf = """SELECT o.supplier_id, COUNT(*) AS t, COUNT(*) FILTER (i.actual_delivery_date > i.expected_delivery_date) AS l,
                     (COUNT(*) - COUNT(*) FILTER (i.actual_delivery_date > i.expected_delivery_date))::DOUBLE * 100 / COUNT(*)::DOUBLE AS p
              FROM m_inbound i JOIN m_po o ON i.po_id = o.po_id WHERE i.actual_delivery_date IS NOT NULL GROUP BY o.supplier_id"""
    s.add(
        "supplier_performance",
        lambda m: k.supplier_performance(m.inbound_deliveries, m.purchase_orders, m.suppliers),
        f"""SELECT RANK() OVER (ORDER BY p DESC) AS rank, x.supplier_id, supplier_name, t AS total_deliveries, l AS late_deliveries, {r('p', 2)} AS on_time_pct,
                   CASE WHEN p >= 90 THEN 'good' WHEN p >= 85 THEN 'watch' ELSE 'poor' END AS grade FROM ({perf}) x JOIN m_suppliers s ON x.supplier_id = s.supplier_id""",
    )
    s.add(
        "late_products",
        lambda m: k.late_products(m.inbound_deliveries, m.products),
        f"""SELECT p.name AS product_name, COUNT(*) AS total_deliveries, COUNT(*) FILTER (actual_delivery_date > expected_delivery_date) AS late_deliveries,
                   {r('COUNT(*) FILTER (actual_delivery_date > expected_delivery_date)::DOUBLE * 100 / COUNT(*)', 1)} AS late_pct
            FROM m_inbound i JOIN m_products p ON i.productId = p.productId WHERE status = 'DELIVERED' GROUP BY p.name HAVING COUNT(*) >= 5 ORDER BY late_pct DESC, product_name LIMIT 10""",
    )
    s.add(
        "average_daily_demand",
        lambda m: k.average_daily_demand(m.sales, date(2001, 1, 1), AS_OF),
        f"SELECT productId, SUM(daily_quantity)::DOUBLE / COUNT(*) AS avg_daily_demand FROM v_day_demand WHERE sale_day >= DATE '2001-01-01' AND sale_day < {A} GROUP BY productId",
    )
    s.add("stock_position", lambda m: k.stock_position(m.stock), "SELECT productId, current_stock AS total_stock, earliest_expiration AS nearest_expiry FROM v_onhand")
    s.add(
        "incoming_position",
        lambda m: k.incoming_position(m.inbound_deliveries, AS_OF),
        f"""SELECT productId, SUM(quantity)::BIGINT AS incoming_stock, MIN(expected_delivery_date) AS next_delivery FROM m_inbound
            WHERE status = 'PENDING' AND expected_delivery_date >= {A} GROUP BY productId""",
    )
