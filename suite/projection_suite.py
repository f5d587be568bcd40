"""Stock projection and base orders."""

from datetime import timedelta

from pyspark.sql import functions as F

from shelfline.operators import projection as p
from shelfline.plans import flows
from shelfline.sources.bridge import AS_OF
from suite.model_sql import AS_OF as A
from suite.forecast_suite import seasonal_sql
from suite.model_sql import half_up as r
from suite.replenish_suite import headers_sql
from suite.registry import Suite

DAYS = 14
_ITB = "SELECT productId, added_at::DATE AS d, SUM(quantity)::BIGINT AS q FROM m_basket WHERE status = 'ACTIVE' GROUP BY ALL"
_LATEST = "SELECT productId, target_date AS d, SUM(predicted_quantity) AS q FROM v_latest GROUP BY ALL"


def _projected(day_rows: str) -> str:
    """The projection from rows of product, day, opening stock, demand, arrivals and purge."""
    return f"""SELECT x.productId, p.name AS product_name, p.category,
                   CASE WHEN p.category = 'Chilled Food' OR COALESCE(p.subcategory = 'Cheese', FALSE) THEN 'CHILLED'
                        WHEN p.category = 'Frozen Food' OR COALESCE(p.subcategory IN ('Ice Cream', 'Frozen Fish'), FALSE) THEN 'FROZEN' ELSE 'AMBIENT' END AS temp_zone,
                   d AS projection_date, opening + cum_in - inn - (cum_out - dem) - (cum_purge - purge) AS beginning_stock, inn AS inbound_deliveries, f AS forecast_demand, b AS itb_demand, dem AS total_demand,
                   purge AS purge_quantity, opening + cum_in - cum_out - cum_purge AS projected_ending_stock,
                   CASE WHEN mean > 0 THEN {r('GREATEST(opening + cum_in - inn - (cum_out - dem) - (cum_purge - purge), 0) / mean', 2)} END AS days_of_supply,
                   CASE WHEN opening + cum_in - cum_out - cum_purge < 0 THEN 'STOCKOUT_RISK' WHEN opening + cum_in - cum_out - cum_purge < dem THEN 'LOW_STOCK' ELSE 'OK' END AS stock_status
            FROM (SELECT *, SUM(inn) OVER w AS cum_in, SUM(dem) OVER w AS cum_out, SUM(purge) OVER w AS cum_purge, AVG(dem) OVER (PARTITION BY productId) AS mean
                  FROM ({day_rows})
                  WINDOW w AS (PARTITION BY productId ORDER BY d)) x JOIN m_products p ON x.productId = p.productId"""


_NETTED_DAYS = f"""SELECT s.productId, s.d, COALESCE(h.q, 0)::DOUBLE AS opening, COALESCE(f.q, 0)::DOUBLE AS f, COALESCE(b.q, 0)::DOUBLE AS b, COALESCE(f.q, 0)::DOUBLE + COALESCE(b.q, 0) AS dem, COALESCE(n.q, 0)::DOUBLE AS inn,
                               GREATEST(COALESCE(e.q, 0) + COALESCE(g.q, 0) - (COALESCE(f.q, 0)::DOUBLE + COALESCE(b.q, 0)), 0)::DOUBLE AS purge
                        FROM (SELECT productId, {A} + i::INTEGER AS d FROM m_products, range(0, {DAYS}) t(i)) s
                        LEFT JOIN (SELECT productId, SUM(quantity_in_stock) AS q FROM m_stock WHERE stock_status = 'AVAILABLE' AND expiration_date >= {A} GROUP BY productId) h ON h.productId = s.productId
                        LEFT JOIN ({_LATEST}) f ON f.productId = s.productId AND f.d = s.d LEFT JOIN ({_ITB}) b ON b.productId = s.productId AND b.d = s.d
                        LEFT JOIN (SELECT productId, expected_delivery_date AS d, SUM(quantity) AS q FROM m_inbound WHERE status = 'PENDING' GROUP BY ALL) n ON n.productId = s.productId AND n.d = s.d
                        LEFT JOIN (SELECT productId, expiration_date AS d, SUM(quantity_in_stock) AS q FROM m_stock WHERE stock_status = 'AVAILABLE' GROUP BY ALL) e ON e.productId = s.productId AND e.d = s.d
                        LEFT JOIN (SELECT productId, expiration_date AS d, SUM(quantity) AS q FROM m_inbound WHERE status = 'PENDING' AND expected_delivery_date BETWEEN {A} AND {A} + {DAYS - 1} GROUP BY ALL) g ON g.productId = s.productId AND g.d = s.d"""
_ENDS = DAYS + 1
# a day at a time: what is held per expiry day sells from the earliest on, then the day's own lots and older ones go
_FEFO_DAYS = f"""
    WITH RECURSIVE lots AS (
        SELECT productId, i, SUM(q) FILTER (held) AS opened, SUM(q) FILTER (NOT held) AS inn,
               [{", ".join(f"COALESCE(SUM(q) FILTER (e = {e}), 0)::DOUBLE" for e in range(_ENDS))}] AS a
        FROM (SELECT productId, TRUE AS held, 0 AS i, LEAST(expiration_date - {A}, {DAYS}) AS e, quantity_in_stock AS q FROM m_stock WHERE stock_status = 'AVAILABLE' AND expiration_date >= {A}
              UNION ALL SELECT productId, FALSE, expected_delivery_date - {A}, LEAST(GREATEST(expiration_date - {A}, 0), {DAYS}), quantity FROM m_inbound
              WHERE status = 'PENDING' AND expected_delivery_date BETWEEN {A} AND {A} + {DAYS - 1}) GROUP BY productId, i),
    x AS (SELECT s.productId, s.i, {A} + s.i::INTEGER AS d, COALESCE(l.opened, 0)::DOUBLE AS opened, COALESCE(l.inn, 0)::DOUBLE AS inn, COALESCE(f.q, 0)::DOUBLE AS f, COALESCE(b.q, 0)::DOUBLE AS b,
                 COALESCE(f.q, 0)::DOUBLE + COALESCE(b.q, 0) AS dem, COALESCE(l.a, {[0.0] * _ENDS}::DOUBLE[]) AS a
          FROM (SELECT productId, i FROM m_products, range(0, {DAYS}) t(i)) s LEFT JOIN lots l ON l.productId = s.productId AND l.i = s.i
          LEFT JOIN ({_LATEST}) f ON f.productId = s.productId AND f.d = {A} + s.i::INTEGER LEFT JOIN ({_ITB}) b ON b.productId = s.productId AND b.d = {A} + s.i::INTEGER),
    st(productId, i, on_hand, owed, purge) AS (
        SELECT productId, -1::BIGINT, {[0.0] * _ENDS}::DOUBLE[], 0::DOUBLE, 0::DOUBLE FROM m_products
        UNION ALL
        SELECT productId, i, [CASE WHEN e <= i THEN 0 ELSE kept[e + 1] END FOR e IN range(0, {_ENDS})], GREATEST(w - list_sum(got), 0), COALESCE(list_sum(kept[1:i + 1]), 0)
        FROM (SELECT *, [got[e + 1] - LEAST(got[e + 1], GREATEST(w - COALESCE(list_sum(got[1:e]), 0), 0)) FOR e IN range(0, {_ENDS})] AS kept
              FROM (SELECT st.productId, x.i, st.owed + x.dem AS w, [st.on_hand[e + 1] + x.a[e + 1] FOR e IN range(0, {_ENDS})] AS got FROM st JOIN x ON x.productId = st.productId AND x.i = st.i + 1)))
    SELECT x.productId, x.d, MAX(x.opened) OVER (PARTITION BY x.productId) AS opening, x.f, x.b, x.dem, x.inn, st.purge FROM st JOIN x ON x.productId = st.productId AND x.i = st.i"""
_PROJ, _FEFO = _projected(_NETTED_DAYS), _projected(_FEFO_DAYS)


def _base_orders(projection: str) -> str:
    return f"""WITH pr AS ({projection}), c AS (SELECT *, order_date + 2 AS cs, order_date + 6 AS ce FROM m_cal)
        SELECT c.productId, order_date, atp_delivery_date, next_atp_delivery_date, purge_date,
               COALESCE(SUM(GREATEST(-projected_ending_stock, 0)) FILTER (projection_date >= atp_delivery_date AND projection_date < next_atp_delivery_date), 0) AS raw_need,
               COALESCE(SUM(total_demand) FILTER (projection_date >= atp_delivery_date AND projection_date < next_atp_delivery_date), 0) AS total_demand,
               COALESCE(SUM(total_demand) FILTER (projection_date BETWEEN next_atp_delivery_date AND purge_date), 0) AS demand_till_purge,
               COALESCE(SUM(GREATEST(-projected_ending_stock, 0)) FILTER (projection_date BETWEEN next_atp_delivery_date AND purge_date), 0) AS raw_need_till_purge,
               COALESCE(SUM(total_demand) FILTER (projection_date BETWEEN cs AND ce), 0) AS contingency_forecast_sales,
               COALESCE(SUM(GREATEST(-projected_ending_stock, 0)) FILTER (projection_date BETWEEN cs AND ce), 0) AS contingency_raw_need,
               COALESCE(SUM(GREATEST(projected_ending_stock, 0) + purge_quantity) FILTER (projection_date = next_atp_delivery_date), 0) AS final_stock
        FROM c JOIN pr ON c.productId = pr.productId AND projection_date >= LEAST(atp_delivery_date, cs) AND projection_date <= GREATEST(next_atp_delivery_date, purge_date, ce) GROUP BY ALL"""


def netted(m):
    return p.stock_projection(m.products, m.stock, m.inbound_deliveries, m.forecasts, m.live_basket, AS_OF, DAYS, "netted")


def register(s: Suite) -> None:
    s.add("stock_projection_netted", netted, _PROJ)
    s.add(
        "stock_projection_fefo",
        lambda m: p.stock_projection(m.products, m.stock, m.inbound_deliveries, m.forecasts, m.live_basket, AS_OF, DAYS, "fefo"),
        _FEFO,
    )
    s.add(
        "base_order",
        lambda m: p.base_order(netted(m), m.product_ordering_calendar),
        _base_orders(_PROJ),
    )
    s.add(
        "projection_daily_summary",
        lambda m: p.projection_daily_summary(netted(m)),
        f"""SELECT projection_date, temp_zone, COUNT(*) AS products, SUM(beginning_stock) AS beginning_stock, SUM(inbound_deliveries) AS inbound_deliveries, SUM(total_demand) AS total_demand, SUM(purge_quantity) AS purge_quantity,
                   SUM(projected_ending_stock) AS projected_ending_stock, COUNT(*) FILTER (stock_status = 'STOCKOUT_RISK') AS products_at_risk FROM ({_PROJ}) GROUP BY 1, 2""",
    )
    s.add("storage_needs", lambda m: p.storage_needs(netted(m)), f"SELECT projection_date, temp_zone, SUM(projected_ending_stock + inbound_deliveries) AS total_storage_needed FROM ({_PROJ}) GROUP BY 1, 2")
    s.add(
        "projection_alerts",
        lambda m: p.projection_alerts(netted(m)),
        f"""SELECT productId, product_name, category, COUNT(*) FILTER (stock_status = 'STOCKOUT_RISK') AS stockout_days, MAX(total_demand) AS max_daily_demand, MIN(projected_ending_stock) AS min_projected_stock,
                   MIN(projection_date) FILTER (stock_status = 'STOCKOUT_RISK') AS first_stockout_date FROM ({_PROJ}) GROUP BY 1, 2, 3 HAVING COUNT(*) FILTER (stock_status = 'STOCKOUT_RISK') >= 3""",
    )
    s.add(
        "stockout_on",
        lambda m: p.stockout_on(netted(m), AS_OF + timedelta(days=1)),
        f"""SELECT productId, product_name, category, beginning_stock, inbound_deliveries, total_demand, projected_ending_stock FROM ({_PROJ})
            WHERE projection_date = {A} + 1 AND stock_status = 'STOCKOUT_RISK'""",
    )
    s.add("product_projection", lambda m: p.product_projection(netted(m), "000000000000000042"), f"SELECT * FROM ({_PROJ}) WHERE productId = '000000000000000042'")
    s.add(
        "excess_stock",
        lambda m: p.excess_stock(netted(m), 5),
        f"""SELECT productId, product_name, category, beginning_stock, {r('AVG(forecast_demand)', 4)} AS avg_daily_demand, MIN(days_of_supply) AS days_of_supply
            FROM ({_PROJ}) WHERE days_of_supply > 5 GROUP BY 1, 2, 3, 4""",
    )
    s.add(
        "total_demand",
        lambda m: p.total_demand(m.forecasts, m.live_basket),
        f"""SELECT COALESCE(f.productId, b.productId) AS productId, COALESCE(f.d, b.d) AS target_date, COALESCE(f.q, 0)::DOUBLE AS forecast_demand, COALESCE(b.q, 0) AS itb_demand, COALESCE(f.q, 0)::DOUBLE + COALESCE(b.q, 0) AS total_demand
            FROM ({_LATEST}) f FULL JOIN ({_ITB}) b ON f.productId = b.productId AND f.d = b.d""",
    )
    s.add("planned_base_orders", lambda m: flows.planned_base_orders(_tables(m), AS_OF), _base_orders(_FEFO))
    s.add("demand_to_orders", lambda m: flows.demand_to_orders(_tables(m), AS_OF)[0], headers_sql(f"({seasonal_sql()})"))


class _tables(dict):
    """Model tables by name, built when asked for."""

    def __init__(self, m):
        super().__init__()
        self.m = m

    def __missing__(self, name):
        return self.m.table(name)
