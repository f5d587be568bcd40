"""Sales, basket and customer analytics."""

from datetime import date

from shelfline.operators import sales as q
from shelfline.operators import views as v
from shelfline.sources.bridge import AS_OF
from pyspark.sql import functions as F
from suite.model_sql import AS_OF as A
from suite.model_sql import half_up as r
from suite.registry import Suite

_SINCE = f"({A} - INTERVAL 18 MONTH)"
_SALES_Q = f"""SELECT YEAR(saleDate) AS y, QUARTER(saleDate) AS q, * FROM m_sales WHERE saleDate >= {_SINCE}"""
_ORDER_Q = f"""SELECT o.orderId, o.customerId, YEAR(o.orderDate) AS y, QUARTER(o.orderDate) AS q, SUM(i.line_pence)::BIGINT AS v, SUM(i.quantity)::BIGINT AS u, COUNT(*) AS n
               FROM m_orders o JOIN m_items i ON o.orderId = i.orderId
               WHERE o.orderStatus IN ('DELIVERED', 'PICKED') AND o.orderDate >= {_SINCE} GROUP BY ALL"""
_LAST30 = f"(SELECT * FROM m_sales WHERE saleDate >= {A} - 30)"
_LIVE = "(SELECT * FROM m_orders WHERE orderStatus <> 'CANCELLED')"


def _va(m):
    return v.customer_analytics(m.customers, m.orders)


def register(s: Suite) -> None:
    s.add(
        "basket_size_by_quarter",
        lambda m: q.basket_size_by_quarter(m.orders, m.order_items, AS_OF),
        f"""SELECT y AS order_year, q AS order_quarter, y || '-Q' || q AS quarter_label, COUNT(*) AS total_orders,
                   {r('SUM(v)::DOUBLE / COUNT(v) / 100', 2)} AS avg_basket_size_gbp, MIN(v)::DOUBLE / 100 AS min_basket_gbp, MAX(v)::DOUBLE / 100 AS max_basket_gbp,
                   {r('STDDEV_SAMP(v) / 100', 2)} AS stddev_basket_gbp FROM ({_ORDER_Q}) GROUP BY y, q""",
    )
    s.add(
        "sales_by_quarter",
        lambda m: q.sales_by_quarter(m.sales, m.products, AS_OF),
        f"""SELECT y AS sale_year, q AS sale_quarter, y || '-Q' || q AS quarter_label, COUNT(*) AS products_sold, SUM(u)::BIGINT AS total_units_sold,
                   SUM(v)::DOUBLE / 100 AS total_revenue_gbp, {r('SUM(v)::DOUBLE / COUNT(v) / 100', 2)} AS avg_sale_value_gbp,
                   COALESCE(SUM(v) FILTER (category = 'Fresh Food'), 0)::DOUBLE / 100 AS fresh_food_revenue_gbp,
                   COALESCE(SUM(v) FILTER (category = 'Chilled Food'), 0)::DOUBLE / 100 AS chilled_food_revenue_gbp,
                   COALESCE(SUM(v) FILTER (category = 'Food Cupboard'), 0)::DOUBLE / 100 AS food_cupboard_revenue_gbp,
                   COALESCE(SUM(v) FILTER (category = 'Bakery'), 0)::DOUBLE / 100 AS bakery_revenue_gbp
            FROM (SELECT y, q, s.productId, category, SUM(quantity) AS u, SUM(line_pence) AS v FROM ({_SALES_Q}) s JOIN m_products p ON s.productId = p.productId GROUP BY ALL)
            GROUP BY y, q""",
    )
    s.add(
        "quarterly_trends",
        lambda m: q.quarterly_trends(m.orders, m.order_items, m.sales, AS_OF),
        f"""WITH om AS (SELECT y, q, COUNT(*) AS n, COUNT(DISTINCT customerId) AS c, SUM(v)::DOUBLE AS v, SUM(u)::DOUBLE AS u, SUM(v)::DOUBLE / COUNT(*) AS b FROM ({_ORDER_Q}) GROUP BY y, q),
                 sm AS (SELECT y, q, SUM(line_pence)::DOUBLE AS v FROM ({_SALES_Q}) GROUP BY y, q)
            SELECT om.y AS year, om.q AS quarter, om.y || '-Q' || om.q AS quarter_label, n AS order_count, c AS active_customers, {r('b / 100', 2)} AS avg_basket_size_gbp,
                   {r('om.u / n', 1)} AS avg_items_per_basket, {r('n::DOUBLE / c', 1)} AS orders_per_customer, sm.v / 100 AS total_revenue_gbp,
                   {r('sm.v / n / 100', 2)} AS revenue_per_order_gbp, LAG(n) OVER w AS prev_quarter_orders,
                   {r('(b - LAG(b) OVER w) / LAG(b) OVER w * 100', 2)} AS basket_size_qoq_growth_pct
            FROM om LEFT JOIN sm ON om.y = sm.y AND om.q = sm.q WINDOW w AS (ORDER BY om.y, om.q)""",
    )
    s.add(
        "quarter_yoy",
        lambda m: q.quarter_yoy(m.orders, m.order_items, AS_OF, 2000, 2001),
        f"""WITH t AS (SELECT q, y, COUNT(*) AS o, SUM(v)::DOUBLE / SUM(n)::DOUBLE / 100 AS b FROM ({_ORDER_Q}) GROUP BY q, y),
                 p AS (SELECT q, MAX(o) FILTER (y = 2000) AS o0, MAX(o) FILTER (y = 2001) AS o1, MAX(b) FILTER (y = 2000) AS b0, MAX(b) FILTER (y = 2001) AS b1 FROM t GROUP BY q)
            SELECT q AS quarter, o0 AS orders_2000, o1 AS orders_2001, {r('b0', 2)} AS avg_basket_2000_gbp, {r('b1', 2)} AS avg_basket_2001_gbp,
                   {r('(b1 - b0) / b0 * 100', 2)} AS yoy_basket_growth_pct FROM p""",
    )
    s.add(
        "daily_sales",
        lambda m: q.daily_sales(m.sales, AS_OF),
        f"""SELECT sale_day AS sale_date, COUNT(DISTINCT orderId) AS num_orders, SUM(quantity)::BIGINT AS units_sold, SUM(line_pence)::DOUBLE / 100 AS revenue
            FROM {_LAST30} GROUP BY sale_day""",
    )
    top = f"""SELECT p.name AS product_name, p.category, SUM(quantity)::BIGINT AS units_sold, SUM(line_pence)::DOUBLE / 100 AS revenue
              FROM {_LAST30} s JOIN m_products p ON s.productId = p.productId GROUP BY ALL ORDER BY revenue DESC, product_name, category"""
    s.add("top_products", lambda m: q.top_products(m.sales, m.products, AS_OF), f"{top} LIMIT 20")
    perf = f"""SELECT p.category, COUNT(DISTINCT orderId) AS num_orders, SUM(quantity)::BIGINT AS units_sold, SUM(line_pence)::DOUBLE / 100 AS revenue,
                      SUM(unit_pence)::DOUBLE / COUNT(*) / 100 AS avg_price FROM {_LAST30} s JOIN m_products p ON s.productId = p.productId GROUP BY p.category"""
    s.add("category_performance", lambda m: q.category_performance(m.sales, m.products, AS_OF), perf)
    s.add(
        "sales_report_summary",
        lambda m: q.sales_report_summary(m.sales, m.products, AS_OF),
        f"""WITH d AS (SELECT sale_day, COUNT(DISTINCT orderId) AS o, SUM(quantity) AS u, SUM(line_pence) AS v FROM {_LAST30} GROUP BY sale_day)
            SELECT SUM(v)::DOUBLE / 100 AS total_revenue, SUM(u)::BIGINT AS total_units, SUM(o)::BIGINT AS total_orders, SUM(v)::DOUBLE / COUNT(*) / 100 AS avg_daily_revenue,
                   (SELECT category FROM ({perf}) ORDER BY revenue DESC, category LIMIT 1) AS top_category, (SELECT product_name FROM ({top} LIMIT 1)) AS top_product FROM d""",
    )
    for scheme, case in {
        "report": "CASE WHEN lifetime_value = 0 THEN 'New' WHEN lifetime_value < 500 THEN 'Low Value' WHEN lifetime_value < 2000 THEN 'Medium Value' ELSE 'High Value' END",
        "verify": "CASE WHEN lifetime_value >= 3000 THEN 'VIP' WHEN lifetime_value >= 1500 THEN 'High Value' WHEN lifetime_value >= 500 THEN 'Regular' WHEN lifetime_value > 0 THEN 'Occasional' ELSE 'No Orders' END",
    }.items():
        s.add(
            f"customer_segments_{scheme}",
            lambda m, scheme=scheme: q.customer_segments(_va(m), scheme),
            f"""SELECT {case} AS segment, COUNT(*) AS customer_count, SUM(ROUND(lifetime_value * 100)::BIGINT)::DOUBLE / COUNT(*) / 100 AS avg_lifetime_value,
                       SUM(total_orders)::DOUBLE / COUNT(*) AS avg_orders, {r('AVG(avg_order_value)', 4)} AS avg_basket_size FROM v_customer GROUP BY 1""",
        )
    best = """SELECT customerId, first_name || ' ' || last_name AS customer_name, city, total_orders, delivered_orders, lifetime_value, avg_order_value
              FROM v_customer WHERE lifetime_value > 0 ORDER BY lifetime_value DESC, customerId LIMIT 20"""
    s.add("top_customers", lambda m: q.top_customers(_va(m)), best)
    s.add(
        "city_distribution",
        lambda m: q.city_distribution(_va(m)),
        """SELECT city, COUNT(*) AS customer_count, SUM(ROUND(lifetime_value * 100)::BIGINT)::DOUBLE / 100 AS total_value,
                  SUM(ROUND(lifetime_value * 100)::BIGINT)::DOUBLE / COUNT(*) / 100 AS avg_value FROM v_customer GROUP BY city ORDER BY customer_count DESC, city LIMIT 10""",
    )
    s.add(
        "customer_report_summary",
        lambda m: q.customer_report_summary(_va(m)).withColumn(
            "segments",
            F.array_join(F.transform("segments", lambda x: F.concat(x["segment"], F.lit("="), x["customer_count"].cast("string"))), "; "),
        ),
        f"""SELECT (SELECT COUNT(*) FROM v_customer) AS total_customers, SUM(ROUND(lifetime_value * 100)::BIGINT)::DOUBLE / 100 AS total_lifetime_value,
                   SUM(ROUND(lifetime_value * 100)::BIGINT)::DOUBLE / COUNT(*) / 100 AS avg_customer_value,
                   (SELECT string_agg(g || '=' || n, '; ' ORDER BY g) FROM (SELECT CASE WHEN lifetime_value = 0 THEN 'New' WHEN lifetime_value < 500 THEN 'Low Value'
                        WHEN lifetime_value < 2000 THEN 'Medium Value' ELSE 'High Value' END AS g, COUNT(*) AS n FROM v_customer GROUP BY 1)) AS segments
            FROM v_customer WHERE lifetime_value > 0""",
    )
    s.add(
        "customer_report_summary_of_list",
        lambda m: q.customer_report_summary(_va(m), k=20).drop("segments"),
        f"""SELECT (SELECT COUNT(*) FROM v_customer) AS total_customers, SUM(ROUND(lifetime_value * 100)::BIGINT)::DOUBLE / 100 AS total_lifetime_value,
                   SUM(ROUND(lifetime_value * 100)::BIGINT)::DOUBLE / COUNT(*) / 100 AS avg_customer_value FROM ({best})""",
    )
    month = "SELECT date_trunc('month', sale_day)::DATE AS month, COUNT(*) AS sales_count, SUM(quantity)::BIGINT AS units_sold, SUM(line_pence)::DOUBLE / 100 AS revenue FROM m_sales GROUP BY 1"
    s.add("sales_by_month", lambda m: q.sales_by_month(m.sales), month)
    s.add(
        "sales_growth",
        lambda m: q.sales_growth(m.sales),
        f"""SELECT arg_min(units_sold, month) AS first_month_units, arg_max(units_sold, month) AS last_month_units,
                   {r('(arg_max(units_sold, month) - arg_min(units_sold, month))::DOUBLE * 100 / arg_min(units_sold, month)', 4)} AS growth_pct FROM ({month})""",
    )
    s.add(
        "sales_by_weekday",
        lambda m: q.sales_by_weekday(m.sales),
        "SELECT isodow(sale_day) - 1 AS weekday, dayname(sale_day) AS day_name, SUM(quantity)::BIGINT AS units_sold FROM m_sales GROUP BY ALL",
    )
    s.add(
        "daily_peaks",
        lambda m: q.daily_peaks(m.sales),
        """SELECT SUM(u)::DOUBLE / COUNT(*) AS avg_units_per_day, SUM(v)::DOUBLE / COUNT(*) / 100 AS avg_daily_revenue, MAX(u)::BIGINT AS peak_daily_units,
                  MAX(v)::DOUBLE / 100 AS peak_daily_revenue FROM (SELECT SUM(quantity) AS u, SUM(line_pence) AS v FROM m_sales GROUP BY sale_day)""",
    )
    s.add(
        "product_sales_summary",
        lambda m: q.product_sales_summary(m.sales),
        "SELECT productId, SUM(quantity)::BIGINT AS units_sold, SUM(line_pence)::DOUBLE / 100 AS total_revenue, SUM(unit_pence)::DOUBLE / COUNT(*) / 100 AS avg_price FROM m_sales GROUP BY productId",
    )
    s.add(
        "basket_growth",
        lambda m: q.basket_growth(m.orders),
        f"""WITH t AS (SELECT SUM(total_pence)::DOUBLE / COUNT(*) / 100 AS b, ROW_NUMBER() OVER (ORDER BY date_trunc('month', orderDate)) - 1 AS i, COUNT(*) OVER () AS n
                       FROM {_LIVE} GROUP BY date_trunc('month', orderDate))
            SELECT COUNT(*) AS months, {r('AVG(b) FILTER (i < 3)', 4)} AS first_months_avg, {r('AVG(b) FILTER (i >= n - 4 AND i < n - 1)', 4)} AS last_full_months_avg,
                   {r('regr_slope(b, i)', 4)} AS slope_per_month FROM t""",
    )
    s.add(
        "items_per_order",
        lambda m: q.items_per_order(m.order_items),
        "SELECT SUM(n)::DOUBLE / COUNT(*) AS mean_items, MIN(n) AS min_items, MAX(n) AS max_items FROM (SELECT COUNT(*) AS n FROM m_items GROUP BY orderId)",
    )
    s.add(
        "order_value_profile",
        lambda m: q.order_value_profile(m.orders).select(
            "count", "mean", "std", "min", "max", "out_of_range", *[F.round(F.col(c).cast("decimal(28,8)"), 4).cast("double").alias(c) for c in ("q1", "median", "q3")]
        ),
        f"""SELECT COUNT(*) AS count, SUM(total_pence)::DOUBLE / COUNT(*) / 100 AS mean, {r('STDDEV_POP(total_pence::DOUBLE / 100)', 4)} AS std,
                   MIN(total_pence)::DOUBLE / 100 AS min, MAX(total_pence)::DOUBLE / 100 AS max, COUNT(*) FILTER (total_pence < 2000 OR total_pence > 10000) AS out_of_range,
                   {r('quantile_cont(total_pence::DOUBLE / 100, 0.25)', 4)} AS q1, {r('quantile_cont(total_pence::DOUBLE / 100, 0.5)', 4)} AS median,
                   {r('quantile_cont(total_pence::DOUBLE / 100, 0.75)', 4)} AS q3 FROM {_LIVE}""",
    )
    s.add(
        "status_distribution",
        lambda m: q.status_distribution(m.orders),
        """SELECT orderStatus, COUNT(*) AS count, SUM(total_pence)::DOUBLE / COUNT(*) / 100 AS avg_amount,
                  COUNT(*)::DOUBLE * 100 / (SUM(COUNT(*)) OVER ())::DOUBLE AS percentage FROM m_orders GROUP BY orderStatus""",
    )
    s.add(
        "cancellation_rate",
        lambda m: q.cancellation_rate(m.orders, AS_OF),
        f"SELECT COUNT(*) FILTER (orderStatus = 'CANCELLED')::DOUBLE * 100 / COUNT(*) AS cancellation_rate FROM m_orders WHERE deliveryDate < {A}",
    )
    s.add(
        "orders_per_customer_week",
        lambda m: q.orders_per_customer_week(m.orders),
        """SELECT SUM(n)::DOUBLE / COUNT(*) AS avg_orders_per_week, MIN(n) AS min_orders, MAX(n) AS max_orders, quantile_cont(n::DOUBLE, 0.5) AS median_orders
           FROM (SELECT COUNT(*) AS n FROM m_orders GROUP BY customerId, date_trunc('week', orderDate))""",
    )
    s.add(
        "customer_frequency_bands",
        lambda m: q.customer_frequency_bands(m.orders),
        """SELECT COUNT(*) FILTER (n < 52) AS low_frequency, COUNT(*) FILTER (n BETWEEN 52 AND 156) AS normal_frequency, COUNT(*) FILTER (n > 156) AS high_frequency
           FROM (SELECT COUNT(*) AS n FROM m_orders GROUP BY customerId)""",
    )
    activity = f"""SELECT customerId, COUNT(*) AS total_orders, MIN(orderDate) AS first_order, MAX(orderDate) AS last_order,
                          datediff('day', MIN(orderDate), MAX(orderDate)) AS days_active, datediff('day', MIN(orderDate), MAX(orderDate))::DOUBLE / 7 AS weeks_active,
                          {r("COUNT(*)::DOUBLE / NULLIF(datediff('day', MIN(orderDate), MAX(orderDate))::DOUBLE / 7, 0)", 2)} AS orders_per_week FROM m_orders GROUP BY customerId"""
    s.add("customer_activity", lambda m: q.customer_activity(m.orders), activity)
    s.add(
        "customer_activity_profile",
        lambda m: _rounded_profile(m),
        f"""SELECT COUNT(orders_per_week) AS count, {r('AVG(orders_per_week)', 4)} AS mean, {r('STDDEV_SAMP(orders_per_week)', 4)} AS std, MIN(orders_per_week) AS min,
                   MAX(orders_per_week) AS max, {r('quantile_cont(orders_per_week, 0.25)', 4)} AS p25, {r('quantile_cont(orders_per_week, 0.5)', 4)} AS p50,
                   {r('quantile_cont(orders_per_week, 0.75)', 4)} AS p75 FROM ({activity})""",
    )
    s.add(
        "orders_per_week",
        lambda m: q.orders_per_week(m.orders),
        "SELECT SUM(n)::DOUBLE / COUNT(*) AS avg_orders, MIN(n) AS min_orders, MAX(n) AS max_orders FROM (SELECT COUNT(*) AS n FROM m_orders GROUP BY date_trunc('week', orderDate))",
    )
    share = r("COUNT(*)::DOUBLE * 100 / (SUM(COUNT(*)) OVER ())::DOUBLE", 1)
    s.add(
        "orders_by_weekday",
        lambda m: q.orders_by_weekday(m.orders),
        f"SELECT isodow(orderDate) - 1 AS weekday, dayname(orderDate) AS day_name, COUNT(*) AS count, {share} AS percentage FROM m_orders GROUP BY 1, 2",
    )
    s.add(
        "delivery_days_distribution",
        lambda m: q.delivery_days_distribution(m.orders),
        f"SELECT datediff('day', orderDate, deliveryDate) AS delivery_days, COUNT(*) AS count, {share} AS percentage FROM {_LIVE} GROUP BY 1",
    )
    s.add(
        "status_by_delivery_period",
        lambda m: q.status_by_delivery_period(m.orders, AS_OF),
        f"""SELECT CASE WHEN deliveryDate::DATE < {A} THEN 'past' WHEN deliveryDate::DATE = {A} THEN 'today' ELSE 'future' END AS delivery_period, orderStatus, COUNT(*) AS count
            FROM m_orders GROUP BY 1, 2""",
    )
    s.add(
        "weekly_trend",
        lambda m: q.weekly_trend(m.orders),
        f"""SELECT date_trunc('week', orderDate)::DATE AS week, COUNT(*) AS orders, COUNT(DISTINCT customerId) AS unique_customers, SUM(total_pence)::DOUBLE / 100 AS revenue,
                   SUM(total_pence)::DOUBLE / COUNT(*) / 100 AS avg_order_value FROM {_LIVE} GROUP BY 1""",
    )
    s.add(
        "daily_order_volume",
        lambda m: q.daily_order_volume(m.orders),
        f"SELECT orderDate::DATE AS order_day, COUNT(*) AS orders, SUM(total_pence)::DOUBLE / 100 AS revenue FROM {_LIVE} GROUP BY 1 ORDER BY 1 DESC LIMIT 30",
    )
    s.add(
        "popular_products",
        lambda m: q.popular_products(m.orders, m.order_items),
        f"""SELECT productId, COUNT(DISTINCT i.orderId) AS order_count, SUM(quantity)::BIGINT AS total_quantity, SUM(line_pence)::DOUBLE / 100 AS total_revenue,
                   SUM(unit_pence)::DOUBLE / COUNT(*) / 100 AS avg_price
            FROM m_items i JOIN {_LIVE} o ON i.orderId = o.orderId GROUP BY productId ORDER BY order_count DESC, total_revenue DESC, productId LIMIT 20""",
    )
    s.add(
        "category_order_sales",
        lambda m: q.category_order_sales(m.orders, m.order_items, m.products),
        f"""SELECT p.category, COUNT(DISTINCT i.orderId) AS orders, SUM(quantity)::BIGINT AS units_sold, SUM(line_pence)::DOUBLE / 100 AS revenue
            FROM m_items i JOIN {_LIVE} o ON i.orderId = o.orderId JOIN m_products p ON i.productId = p.productId GROUP BY p.category""",
    )
    s.add(
        "revenue_reconciliation",
        lambda m: q.revenue_reconciliation(m.orders, m.sales),
        """WITH o AS (SELECT deliveryDate::DATE AS d, SUM(total_pence) AS v FROM m_orders WHERE orderStatus = 'DELIVERED' GROUP BY 1), s AS (SELECT sale_day AS d, SUM(line_pence) AS v FROM m_sales GROUP BY 1)
           SELECT o.d AS delivery_day, o.v::DOUBLE / 100 AS order_revenue, s.v::DOUBLE / 100 AS sales_revenue, ABS(o.v - s.v)::DOUBLE / 100 AS difference
           FROM o JOIN s ON o.d = s.d WHERE ABS(o.v - s.v) > 1""",
    )
    s.add("delivered_revenue", lambda m: q.delivered_revenue(m.orders), "SELECT SUM(total_pence)::DOUBLE / 100 AS total_revenue FROM m_orders WHERE orderStatus = 'DELIVERED'")
    s.add(
        "top_products_share",
        lambda m: q.top_products_share(m.sales, m.products, AS_OF),
        f"""SELECT p.name, COUNT(DISTINCT saleDate) AS days_sold, SUM(quantity)::BIGINT AS total_quantity, SUM(line_pence)::DOUBLE / 100 AS total_revenue,
                   {r(f'SUM(quantity)::DOUBLE * 100 / (SELECT SUM(quantity) FROM {_LAST30})::DOUBLE', 4)} AS pct_of_sales
            FROM {_LAST30} s JOIN m_products p ON s.productId = p.productId GROUP BY p.name ORDER BY total_quantity DESC, name LIMIT 10""",
    )
    s.add(
        "sales_coverage",
        lambda m: q.sales_coverage(m.sales),
        "SELECT MIN(sale_day) AS first_sale, MAX(sale_day) AS last_sale, COUNT(DISTINCT sale_day) AS days_with_sales, COUNT(*) AS total_sales FROM m_sales",
    )
    s.add(
        "orders_by_day_status",
        lambda m: q.orders_by_day_status(m.orders, date(2001, 7, 20), AS_OF),
        f"SELECT orderDate::DATE AS order_date, orderStatus, COUNT(*) AS count FROM m_orders WHERE orderDate::DATE BETWEEN DATE '2001-07-20' AND {A} GROUP BY 1, 2",
    )
    s.add(
        "status_date_ranges",
        lambda m: q.status_date_ranges(m.orders),
        "SELECT orderStatus, COUNT(*) AS count, MIN(deliveryDate::DATE) AS min_date, MAX(deliveryDate::DATE) AS max_date FROM m_orders GROUP BY orderStatus",
    )
    s.add(
        "recent_sales_by_day",
        lambda m: q.recent_sales_by_day(m.sales, date(2001, 7, 1)),
        """SELECT sale_day AS sale_date, COUNT(*) AS sales_count, COUNT(DISTINCT orderId) AS order_count, COUNT(DISTINCT customerId) AS customers
           FROM m_sales WHERE sale_day >= DATE '2001-07-01' GROUP BY sale_day""",
    )
    s.add(
        "product_rank_like",
        lambda m: q.product_rank_like(m.products, m.sales, "%widget%"),
        """SELECT p.productId, p.name, COUNT(DISTINCT s.saleId) AS total_sales, SUM(s.quantity)::BIGINT AS total_units, RANK() OVER (ORDER BY SUM(s.quantity) DESC NULLS LAST) AS sales_rank
           FROM m_products p LEFT JOIN m_sales s ON p.productId = s.productId WHERE p.name LIKE '%widget%' GROUP BY p.productId, p.name""",
    )
    s.add(
        "product_performance_with_forecast",
        lambda m: q.product_performance_with_forecast(m.products, m.sales, m.forecasts, date(2001, 7, 25), date(2001, 8, 5)),
        """SELECT p.productId, p.name AS product_name, p.category, COALESCE(o, 0) AS order_count, u AS total_quantity_sold, v::DOUBLE / 100 AS total_revenue_gbp, f AS avg_forecast_quantity
           FROM m_products p LEFT JOIN (SELECT productId, COUNT(DISTINCT orderId) AS o, SUM(quantity)::BIGINT AS u, SUM(line_pence) AS v FROM m_sales GROUP BY productId) s ON p.productId = s.productId
           LEFT JOIN (SELECT productId, AVG(predicted_quantity) AS f FROM m_forecasts WHERE target_date BETWEEN DATE '2001-07-25' AND DATE '2001-08-05' AND model_name = 'HistoricalPattern' GROUP BY productId) g
           ON p.productId = g.productId""",
    )
    s.add(
        "customer_value",
        lambda m: q.customer_value(m.orders),
        f"""SELECT customerId, COUNT(*) AS total_orders, SUM(total_pence)::DOUBLE / 100 AS lifetime_value, SUM(total_pence)::DOUBLE / COUNT(*) / 100 AS avg_order_value,
                   MIN(orderDate) AS first_order, MAX(orderDate) AS last_order FROM {_LIVE} GROUP BY customerId ORDER BY lifetime_value DESC, customerId LIMIT 100""",
    )
    s.add(
        "sales_overview",
        lambda m: q.sales_overview(m.sales),
        """SELECT COUNT(DISTINCT saleDate) AS sale_days, COUNT(DISTINCT productId) AS products_sold, SUM(quantity)::BIGINT AS total_units, SUM(line_pence)::DOUBLE / 100 AS total_revenue,
                  SUM(line_pence)::DOUBLE / COUNT(*) / 100 AS avg_sale_value FROM m_sales""",
    )
    s.add(
        "daily_sales_items",
        lambda m: q.daily_sales_items(m.sales),
        """SELECT sale_day, COUNT(DISTINCT orderId) AS orders_delivered, COUNT(*) AS items_sold, SUM(quantity)::BIGINT AS units_sold, SUM(line_pence)::DOUBLE / 100 AS revenue
           FROM m_sales GROUP BY sale_day ORDER BY sale_day DESC LIMIT 30""",
    )
    s.add(
        "monthly_sales_trend",
        lambda m: q.monthly_sales_trend(m.sales),
        """SELECT date_trunc('month', sale_day)::DATE AS month, COUNT(DISTINCT orderId) AS orders, SUM(line_pence)::DOUBLE / 100 AS revenue, SUM(unit_pence)::DOUBLE / COUNT(*) / 100 AS avg_price
           FROM m_sales GROUP BY 1""",
    )
    s.add(
        "top_selling",
        lambda m: q.top_selling(m.sales),
        """SELECT productId, COUNT(DISTINCT orderId) AS orders, COUNT(*) AS times_sold, SUM(quantity)::BIGINT AS units_sold, SUM(line_pence)::DOUBLE / 100 AS revenue,
                  SUM(unit_pence)::DOUBLE / COUNT(*) / 100 AS avg_price FROM m_sales GROUP BY productId ORDER BY revenue DESC, productId LIMIT 20""",
    )


def _rounded_profile(m):
    from shelfline.functions.numbers import half_up
    from shelfline.operators.catalog import numeric_profile

    shape = numeric_profile(q.customer_activity(m.orders), "orders_per_week")
    return shape.select("count", "min", "max", *[half_up(F.col(c), 4).alias(c) for c in ("mean", "std", "p25", "p50", "p75")])
