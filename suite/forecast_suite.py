"""Forecasts, their accuracy, and live baskets."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfline.operators import basket as b
from shelfline.operators import forecast as f
from shelfline.sources.bridge import AS_OF
from suite.model_sql import AS_OF as A
from suite.model_sql import half_up as r
from suite.registry import Suite

_STD = "CASE WHEN n > 1 THEN sqrt((q::DOUBLE * n - s::DOUBLE * s) / (n::DOUBLE * (n - 1))) END"


def _profile(daily: str, keys: str) -> str:
    return f"""SELECT {keys}, isodow(sale_day) - 1 AS dow, COUNT(*) AS n, SUM(daily_quantity)::BIGINT AS s, SUM(daily_quantity * daily_quantity)::BIGINT AS q FROM ({daily}) GROUP BY ALL
               UNION ALL SELECT {keys}, -1, COUNT(*), SUM(daily_quantity)::BIGINT, SUM(daily_quantity * daily_quantity)::BIGINT FROM ({daily}) GROUP BY ALL"""


_VALUE = """CASE WHEN mean IS NULL THEN 1 ELSE GREATEST(1, round_even(mean, 0)) END AS predicted_quantity,
            CASE WHEN mean IS NULL THEN 1 ELSE GREATEST(1, round_even(mean - sd * 1.96::DOUBLE, 0)) END AS confidence_lower,
            CASE WHEN mean IS NULL THEN 2 ELSE GREATEST(GREATEST(1, round_even(mean, 0)) + 1, round_even(mean + sd * 1.96::DOUBLE, 0)) END AS confidence_upper"""
_SPREAD = "CASE WHEN sd0 IS NULL OR sd0 = 0 THEN mean * 0.2::DOUBLE ELSE sd0 END AS sd"


def seasonal_sql() -> str:
    daily = f"SELECT * FROM v_day_demand WHERE sale_day >= {A} - 180 AND sale_day < {A}"
    return f"""WITH pr AS (SELECT *, s::DOUBLE / n AS mean, {_STD} AS sd0 FROM ({_profile(daily, 'productId')})),
        g AS (SELECT productId, h, {A} + h::INTEGER AS target FROM (SELECT DISTINCT productId FROM m_stock WHERE quantity_in_stock > 0), range(1, 8) t(h)),
        x AS (SELECT g.productId, h, target, CASE WHEN w.n IS NOT NULL THEN w.mean ELSE a.mean END AS mean, CASE WHEN w.n IS NOT NULL THEN w.sd0 ELSE a.sd0 END AS sd0
              FROM g LEFT JOIN pr w ON g.productId = w.productId AND w.dow = isodow(target) - 1 LEFT JOIN pr a ON g.productId = a.productId AND a.dow = -1)
        SELECT 'FCT_' || productId || '_20010801_' || h AS forecast_id, 'RUN_20010801' AS run_id, {A} AS forecast_date, productId, target AS target_date, h AS forecast_horizon,
               {_VALUE}, 'HistoricalPattern' AS model_name FROM (SELECT *, {_SPREAD} FROM x)"""


_BACKTEST = f"""WITH span AS (SELECT MIN(sale_day) AS a, MAX(sale_day) AS b FROM m_sales),
    dates AS (SELECT (b - i::INTEGER) AS fd FROM span, range(0, 7) t(i) WHERE b - i::INTEGER >= a + 90),
    daily AS (SELECT d.productId, d.sale_day, d.daily_quantity, fd FROM v_day_demand d JOIN dates ON d.sale_day <= fd AND d.sale_day > fd - 90),
    pr AS (SELECT *, s::DOUBLE / n AS mean, {_STD} AS sd0 FROM ({_profile('SELECT * FROM daily', 'productId, fd')})),
    x AS (SELECT a.productId, a.fd, h, a.fd + h::INTEGER AS target, CASE WHEN w.n IS NOT NULL THEN w.mean ELSE a.mean END AS mean, CASE WHEN w.n IS NOT NULL THEN w.sd0 ELSE a.sd0 END AS sd0
          FROM pr a CROSS JOIN range(1, 8) t(h) LEFT JOIN pr w ON a.productId = w.productId AND a.fd = w.fd AND w.dow = isodow(a.fd + h::INTEGER) - 1 WHERE a.dow = -1)
    SELECT productId, fd AS forecast_date, target AS target_date, h AS forecast_horizon, {_VALUE}, 'RUN_' || strftime(fd, '%Y%m%d') AS run_id FROM (SELECT *, {_SPREAD} FROM x)"""
_DETAIL = f"""SELECT f.productId, p.name AS product_name, p.category, f.forecast_date, f.target_date, f.forecast_horizon, f.predicted_quantity, f.confidence_lower, f.confidence_upper,
                     COALESCE(d.daily_quantity, 0) AS actual_quantity, ABS(f.predicted_quantity - COALESCE(d.daily_quantity, 0)) AS absolute_error,
                     CASE WHEN COALESCE(d.daily_quantity, 0) > 0 THEN ABS(f.predicted_quantity - d.daily_quantity) / d.daily_quantity END AS relative_error,
                     CASE WHEN COALESCE(d.daily_quantity, 0) BETWEEN f.confidence_lower AND f.confidence_upper THEN 1 ELSE 0 END::BIGINT AS within_confidence
              FROM m_forecasts f JOIN m_products p ON f.productId = p.productId LEFT JOIN v_day_demand d ON f.productId = d.productId AND f.target_date = d.sale_day WHERE f.target_date <= {A}"""
_METRICS = f"""{r('AVG(absolute_error)', 6)} AS mae, {r('AVG(relative_error) * 100', 6)} AS mape, {r('AVG(within_confidence) * 100', 6)} AS confidence_accuracy, COUNT(*) AS predictions"""
_ITB = "SELECT productId, added_at::DATE AS d, SUM(quantity)::BIGINT AS q FROM m_basket WHERE status = 'ACTIVE' GROUP BY ALL"
_NEXT = f"SELECT * FROM v_latest WHERE target_date BETWEEN {A} + 1 AND {A} + 7"
FIRST = AS_OF + timedelta(days=1)


def _detail(m):
    return f.accuracy_detail(m.forecasts, m.products, m.sales, AS_OF)


def last_week_mean(vectors, horizon):
    """A stand-in model: the mean of the last seven days, with a fixed band."""
    made = []
    for v in vectors:
        mean = sum(v[-7:]) / 7
        made.append([(mean, mean - 1, mean + 1)] * horizon)
    return made


def register(s: Suite) -> None:
    s.add(
        "products_in_stock",
        lambda m: f.products_in_stock(m.stock, m.products),
        "SELECT s.productId, p.name AS product_name, p.category, SUM(quantity_in_stock)::BIGINT AS total_stock FROM m_stock s JOIN m_products p ON s.productId = p.productId WHERE quantity_in_stock > 0 GROUP BY ALL",
    )
    s.add("seasonal_forecast", lambda m: f.seasonal_forecast(m.stock, m.sales, AS_OF), seasonal_sql())
    vector = f"""SELECT productId, list_transform(range(0, 90), lambda i: COALESCE(list_sum(list_transform(list_filter(ds, lambda x: x.d = {A} - 89 + i::INTEGER), lambda x: x.q)), 0)::BIGINT) AS v
                 FROM (SELECT productId, list({{'d': sale_day, 'q': daily_quantity}}) AS ds FROM v_day_demand WHERE sale_day BETWEEN {A} - 89 AND {A} GROUP BY productId)"""
    s.add(
        "series_context",
        lambda m: f.series_context(m.sales, AS_OF).select("productId", "context_end", F.array_join(F.transform("context", lambda x: x.cast("long").cast("string")), ",").alias("context")),
        f"SELECT productId, {A} AS context_end, array_to_string(v, ',') AS context FROM ({vector})",
    )
    s.add(
        "model_forecast",
        lambda m: f.model_forecast(f.series_context(m.sales, AS_OF), last_week_mean),
        f"""SELECT productId, {A} AS forecast_date, h AS forecast_horizon, a AS predicted_quantity, a - 1 AS confidence_lower, a + 1 AS confidence_upper, {A} + h::INTEGER AS target_date
            FROM (SELECT productId, list_sum(v[84:90])::DOUBLE / 7 AS a FROM ({vector})), range(1, 8) t(h)""",
    )
    s.add("backtest_dates", lambda m: f.backtest_dates(m.sales), "SELECT (b - i::INTEGER) AS forecast_date FROM (SELECT MIN(sale_day) AS a, MAX(sale_day) AS b FROM m_sales), range(0, 7) t(i) WHERE b - i::INTEGER >= a + 90")
    s.add("backtest_grid", lambda m: f.backtest_grid(m.sales), _BACKTEST)
    s.add("accuracy_detail", _detail, _DETAIL)
    s.add(
        "accuracy_overall",
        lambda m: f.accuracy_overall(_detail(m)),
        f"SELECT {_METRICS}, {r('sqrt(AVG((predicted_quantity - actual_quantity) * (predicted_quantity - actual_quantity)))', 6)} AS rmse, MIN(target_date) AS first_date, MAX(target_date) AS last_date FROM ({_DETAIL})",
    )
    s.add(
        "accuracy_report",
        lambda m: f.accuracy_report(_detail(m)).withColumn("category_metrics", F.array_join(F.transform("category_metrics", lambda x: F.concat(x["category"], F.lit("="), F.round(x["mae"], 2).cast("decimal(10,2)").cast("string"))), "; ")),
        f"""SELECT *, (SELECT string_agg(category || '=' || v::VARCHAR, '; ' ORDER BY category) FROM (SELECT category, ROUND(CAST(AVG(absolute_error) AS DECIMAL(28,6)), 2)::DECIMAL(10,2) AS v FROM ({_DETAIL}) GROUP BY category)) AS category_metrics
            FROM (SELECT {_METRICS}, {r('sqrt(AVG((predicted_quantity - actual_quantity) * (predicted_quantity - actual_quantity)))', 6)} AS rmse, MIN(target_date) AS first_date, MAX(target_date) AS last_date FROM ({_DETAIL}))""",
    )
    s.add("accuracy_by_category", lambda m: f.accuracy_by(_detail(m), "category"), f"SELECT category, {_METRICS} FROM ({_DETAIL}) GROUP BY category")
    s.add("accuracy_by_target_date", lambda m: f.accuracy_by(_detail(m), "target_date"), f"SELECT target_date, {_METRICS} FROM ({_DETAIL}) GROUP BY target_date")
    s.add(
        "accuracy_by_horizon",
        lambda m: f.accuracy_by(_detail(m), "forecast_horizon", trim=2),
        f"SELECT forecast_horizon, {_METRICS} FROM ({_DETAIL}) WHERE relative_error IS NOT NULL AND ABS(relative_error) < 2 GROUP BY forecast_horizon",
    )
    for side, sign in (("over", ">"), ("under", "<")):
        s.add(
            f"worst_forecasts_{side}",
            lambda m, side=side: f.worst_forecasts(_detail(m), side),
            f"""SELECT productId, product_name, forecast_date, target_date, predicted_quantity, actual_quantity, predicted_quantity - actual_quantity AS error FROM ({_DETAIL})
                WHERE predicted_quantity {sign} actual_quantity ORDER BY absolute_error DESC, productId, forecast_date, target_date LIMIT 5""",
        )
    s.add(
        "error_histogram",
        lambda m: f.error_histogram(_detail(m)),
        f"""WITH e AS (SELECT predicted_quantity - actual_quantity AS e FROM ({_DETAIL})), k AS (SELECT MIN(e) AS lo, MAX(e) AS hi FROM e)
            SELECT LEAST(FLOOR((e - lo) * 50 / (hi - lo)), 49)::BIGINT AS bin, COUNT(*) AS frequency, MIN(e) AS smallest, MAX(e) AS largest FROM e, k GROUP BY 1""",
    )
    summary = """COUNT(*) AS total_records, COUNT(DISTINCT productId) AS unique_products, MIN(forecast_date) AS min_forecast_date, MAX(forecast_date) AS max_forecast_date, MIN(target_date) AS min_target,
                 MAX(target_date) AS max_target, AVG(predicted_quantity) AS avg_predicted, MIN(predicted_quantity) AS min_predicted, MAX(predicted_quantity) AS max_predicted,
                 COUNT(predicted_quantity) AS non_null_predictions, COUNT(*) FILTER (predicted_quantity > 0) AS positive_predictions FROM m_forecasts"""
    s.add("forecast_summary", lambda m: f.forecast_summary(m.forecasts), f"SELECT {summary}")
    s.add("forecast_summary_of_run", lambda m: f.forecast_summary(m.forecasts, "RUN_20010801"), f"SELECT {summary} WHERE run_id = 'RUN_20010801'")
    s.add(
        "forecast_runs",
        lambda m: f.forecast_runs(m.forecasts),
        "SELECT run_id, MIN(forecast_date) AS forecast_date, COUNT(DISTINCT productId) AS product_count, COUNT(*) AS record_count FROM m_forecasts GROUP BY run_id ORDER BY forecast_date DESC, run_id LIMIT 5",
    )
    s.add(
        "top_forecasts",
        lambda m: f.top_forecasts(m.forecasts, m.products),
        """SELECT f.productId, p.name AS product_name, target_date, predicted_quantity, confidence_lower, confidence_upper, forecast_horizon FROM m_forecasts f JOIN m_products p ON f.productId = p.productId
           WHERE forecast_date = (SELECT MAX(forecast_date) FROM m_forecasts) AND forecast_horizon <= 7 ORDER BY predicted_quantity DESC, target_date, f.productId LIMIT 10""",
    )
    s.add(
        "forecastable_products",
        lambda m: f.forecastable_products(m.sales, m.products, min_days=10),
        "SELECT d.productId, p.name AS product_name, p.category, COUNT(*) AS days_with_sales, SUM(daily_quantity)::BIGINT AS total_quantity FROM v_day_demand d JOIN m_products p ON d.productId = p.productId GROUP BY ALL HAVING COUNT(*) >= 10",
    )
    s.add(
        "product_forecast",
        lambda m: f.product_forecast(m.forecasts, "000000000000000042", date(2001, 7, 15), date(2001, 8, 7)),
        """SELECT productId, forecast_date, target_date, predicted_quantity, confidence_lower, confidence_upper, model_name FROM m_forecasts
           WHERE productId = '000000000000000042' AND target_date BETWEEN DATE '2001-07-15' AND DATE '2001-08-07'""",
    )
    s.add(
        "basket_vs_forecast",
        lambda m: b.basket_vs_forecast(m.forecasts, m.live_basket, FIRST),
        f"""SELECT f.target_date, COUNT(DISTINCT f.productId) AS products_forecasted, COUNT(DISTINCT i.productId) AS products_in_basket, SUM(predicted_quantity) AS total_forecast, COALESCE(SUM(q), 0)::BIGINT AS total_itb,
                   {r('COALESCE(SUM(q), 0)::DOUBLE * 100 / SUM(predicted_quantity)', 1)} AS itb_percentage FROM ({_NEXT}) f LEFT JOIN ({_ITB}) i ON f.productId = i.productId AND f.target_date = i.d GROUP BY 1""",
    )
    s.add(
        "demand_coverage",
        lambda m: b.demand_coverage(m.forecasts, m.live_basket, m.inbound_deliveries, m.stock, FIRST),
        f"""WITH n AS (SELECT productId, expected_delivery_date AS d, SUM(quantity)::BIGINT AS q FROM m_inbound WHERE status = 'PENDING' GROUP BY ALL)
            SELECT f.target_date AS demand_date, COUNT(DISTINCT f.productId) AS products, SUM(predicted_quantity + COALESCE(i.q, 0)) AS total_demand, SUM(COALESCE(n.q, 0))::BIGINT AS inbound_supply,
                   SUM(COALESCE(h.current_stock, 0))::BIGINT AS current_stock,
                   {r('(SUM(COALESCE(n.q, 0)) + SUM(COALESCE(h.current_stock, 0)))::DOUBLE * 100 / SUM(predicted_quantity + COALESCE(i.q, 0))', 1)} AS coverage_percentage
            FROM ({_NEXT}) f LEFT JOIN ({_ITB}) i ON f.productId = i.productId AND f.target_date = i.d LEFT JOIN n ON f.productId = n.productId AND f.target_date = n.d
            LEFT JOIN v_onhand h ON f.productId = h.productId GROUP BY 1""",
    )
    s.add(
        "basket_by_category",
        lambda m: b.basket_by_category(m.live_basket, m.products),
        """SELECT category, COUNT(DISTINCT l.productId) AS products, COUNT(DISTINCT session_id) AS sessions, SUM(quantity)::BIGINT AS total_quantity, SUM(quantity * price_pence)::DOUBLE / 100 AS basket_value
           FROM m_basket l JOIN m_products p ON l.productId = p.productId WHERE status = 'ACTIVE' GROUP BY category ORDER BY basket_value DESC, category LIMIT 10""",
    )
    s.add(
        "recent_baskets",
        lambda m: b.recent_baskets(m.live_basket, m.customers, m.products),
        """SELECT basket_id, session_id, first_name || ' ' || last_name AS customer_name, p.name AS product_name, quantity::BIGINT AS quantity, added_at, expires_at
           FROM m_basket l JOIN m_customers c ON l.customerId = c.customerId JOIN m_products p ON l.productId = p.productId WHERE status = 'ACTIVE' ORDER BY added_at DESC, basket_id LIMIT 10""",
    )
    s.add(
        "active_customers",
        lambda m: b.active_customers(m.orders),
        "SELECT customerId, COUNT(DISTINCT orderId) AS order_count FROM m_orders WHERE orderStatus IN ('DELIVERED', 'PICKED') GROUP BY customerId HAVING COUNT(DISTINCT orderId) > 10",
    )
    s.add(
        "basket_overview",
        lambda m: b.basket_overview(m.live_basket),
        """SELECT COUNT(DISTINCT basket_id) AS total_baskets, COUNT(DISTINCT session_id) AS total_sessions, COUNT(DISTINCT customerId) AS unique_customers, MIN(added_at::DATE) AS earliest_basket,
                  MAX(added_at::DATE) AS latest_basket FROM m_basket WHERE status = 'ACTIVE'""",
    )
    sessions = "SELECT strptime(split_part(session_id, '_', 3), '%Y%m%d')::DATE AS basket_date, COUNT(DISTINCT session_id) AS sessions, COUNT(DISTINCT customerId) AS customers, SUM(quantity)::BIGINT AS total_quantity FROM m_basket GROUP BY 1"
    s.add("session_date", lambda m: b.basket_sessions(m.live_basket), sessions)
    s.add(
        "basket_vs_future_orders",
        lambda m: b.basket_vs_future_orders(m.live_basket, m.orders, m.order_items, AS_OF - timedelta(days=30)),
        f"""WITH b AS ({sessions}), o AS (SELECT orderDate::DATE AS d, COUNT(DISTINCT o.orderId) AS n, COUNT(DISTINCT customerId) AS c, SUM(quantity)::BIGINT AS q FROM m_orders o JOIN m_items i ON o.orderId = i.orderId WHERE orderStatus = 'FUTURE' GROUP BY 1)
            SELECT COALESCE(basket_date, d) AS date, COALESCE(sessions, 0) AS basket_sessions, COALESCE(customers, 0) AS basket_customers, COALESCE(total_quantity, 0) AS basket_qty, COALESCE(n, 0) AS future_orders,
                   COALESCE(c, 0) AS future_customers, COALESCE(q, 0) AS future_qty FROM b FULL JOIN o ON basket_date = d WHERE COALESCE(basket_date, d) >= {A} - 30""",
    )
    s.add(
        "horizon_forecasts",
        lambda m: b.horizon_forecasts(m.forecasts, m.products, FIRST),
        f"SELECT f.productId, f.target_date, predicted_quantity AS forecast_qty, p.name AS product_name, p.price_gbp::DOUBLE AS price_gbp FROM ({_NEXT}) f JOIN m_products p ON f.productId = p.productId",
    )
