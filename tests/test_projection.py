import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from shelfline.operators import projection as p

D0 = date(2025, 6, 20)


def day(i):
    return D0 + timedelta(days=i)


def flows(spark, data):
    return spark.createDataFrame(
        [(pid, day(i), float(d), 0.0, float(n), float(e), float(o)) for pid, i, d, n, e, o in data],
        "productId string, projection_date date, forecast_demand double, itb_demand double, inbound_deliveries double, expiring double, opening double",
    )


def test_netted_worked_example(spark):
    demand, inbound, expiring = [18, 20, 22, 19, 23], [0, 0, 15, 0, 0], [0, 0, 0, 25, 0]
    f = flows(spark, [("A", i, demand[i], inbound[i], expiring[i], 0 if i else 75) for i in range(5)])
    got = [r["projected_ending_stock"] for r in p.project(p.netted_purges(f)).orderBy("projection_date").collect()]
    assert got == [57, 37, 30, 5, -18]


def calendar(spark, order, atp, following, purge, advance, demand_days):
    return spark.createDataFrame(
        [("A", order, atp, following, purge, advance, demand_days)],
        "productId string, order_date date, atp_delivery_date date, next_atp_delivery_date date, purge_date date, contingency_days_in_advance int, contingency_days_of_demand int",
    )


def projected(spark, first, stock, demand, purge):
    return spark.createDataFrame(
        [("A", day(first + i), float(s), float(d), float(q)) for i, (s, d, q) in enumerate(zip(stock, demand, purge))],
        "productId string, projection_date date, projected_ending_stock double, total_demand double, purge_quantity double",
    )


FIELDS = ["raw_need", "total_demand", "demand_till_purge", "raw_need_till_purge", "contingency_forecast_sales", "contingency_raw_need", "final_stock"]


def test_base_order_worked_example(spark):
    series = projected(spark, 1, [80, 40, -10, -30, -50, 10, -20, -40], [10, 12, 15, 10, 20, 25, 18, 12], [0, 0, 5, 10, 0, 2, 0, 0])
    got = p.base_order(series, calendar(spark, day(0), day(1), day(5), day(8), 1, 3)).select(*FIELDS).first()
    assert list(got) == [40, 47, 75, 110, 47, 40, 0]


def test_base_order_closed_window(spark):
    series = projected(spark, 0, [57, 37, 30, 5, -18, -28, -59], [18, 20, 22, 19, 23, 21, 20], [0] * 7)
    got = p.base_order(series, calendar(spark, day(0), day(2), day(4), day(7), 2, 4), closed=True).select("raw_need", "total_demand", "demand_till_purge", "raw_need_till_purge", "contingency_forecast_sales").first()
    assert list(got) == [18, 64, 64, 105, 105]


def day_by_day(opening, demand, arrivals):
    """Independent loop over single units' lots: receive, sell earliest expiry first, purge at day end."""
    lots = [[e, q] for e, q in opening]
    owed, out = 0.0, []
    for t, d in enumerate(demand):
        lots += [[e, q] for a, e, q in arrivals if a == t]
        owed += d
        for lot in sorted(lots):
            take = min(lot[1], owed)
            lot[1] -= take
            owed -= take
        purged = sum(q for e, q in lots if e <= t)
        lots = [[e, q] for e, q in lots if e > t]
        out.append((purged, sum(q for _, q in lots) - owed))
    return out


def test_fefo_against_day_loop(spark):
    rng, days, cases = random.Random(7), 8, {}
    stock, inbound, demand = [], [], []
    for i in range(60):
        pid = f"P{i:03d}"
        held = [(rng.randint(0, 10), rng.randint(1, 9)) for _ in range(rng.randint(0, 4))]
        coming = [(rng.randint(0, days - 1), rng.randint(0, 12), rng.randint(1, 9)) for _ in range(rng.randint(0, 4))]
        coming = [(a, max(a, e), q) for a, e, q in coming]
        wanted = [rng.randint(0, 6) for _ in range(days)]
        cases[pid] = (held, wanted, coming)
        stock += [(pid, q, day(e), "AVAILABLE") for e, q in held]
        inbound += [(pid, q, day(a), day(e), "PENDING") for a, e, q in coming]
        demand += [(pid, D0, day(t), float(w)) for t, w in enumerate(wanted)]
    products = spark.createDataFrame([(pid, "n", "c", None) for pid in cases], "productId string, name string, category string, subcategory string")
    stock_df = spark.createDataFrame(stock, "productId string, quantity_in_stock int, expiration_date date, stock_status string")
    inbound_df = spark.createDataFrame(inbound, "productId string, quantity int, expected_delivery_date date, expiration_date date, status string")
    forecasts = spark.createDataFrame(demand, "productId string, forecast_date date, target_date date, predicted_quantity double")
    basket = spark.createDataFrame([], "productId string, quantity int, added_at timestamp, status string")
    breakers = sum(any(e < h for a, e, _ in coming for h in [h for h, _ in held] + [f for b, f, _ in coming if b < a]) for held, _, coming in cases.values())
    assert 0 < breakers < len(cases)  # arrivals in and out of expiry order
    got = {}
    for r in p.stock_projection(products, stock_df, inbound_df, forecasts, basket, D0, days, "fefo").orderBy("projection_date").collect():
        got.setdefault(r["productId"], []).append((r["purge_quantity"], r["projected_ending_stock"]))
    for pid, (held, wanted, coming) in cases.items():
        assert got[pid] == day_by_day(held, wanted, coming), pid


def test_hot_product_is_projected_like_any_other(spark):
    """A third of all stock rows belong to one product."""
    n = 9000
    stock = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("P"), F.col("id") % 50)).alias("productId"),
        F.lit(1).alias("quantity_in_stock"),
        F.date_add(F.lit(D0), (F.col("id") % 5).cast("int")).alias("expiration_date"),
        F.lit("AVAILABLE").alias("stock_status"),
    )
    products = spark.createDataFrame([("HOT",)], "productId string")
    inbound = spark.createDataFrame([], "productId string, quantity int, expected_delivery_date date, expiration_date date, status string")
    forecasts = spark.createDataFrame([], "productId string, forecast_date date, target_date date, predicted_quantity double")
    basket = spark.createDataFrame([], "productId string, quantity int, added_at timestamp, status string")
    rows = p.projection_flows(products, stock, inbound, forecasts, basket, D0, 5, lots=True).filter("productId = 'HOT'").orderBy("projection_date").collect()
    assert [r["opening"] for r in rows] == [n / 3, 0, 0, 0, 0]  # a row per day before any per-product work
    assert rows[0]["_lots"] == [n / 15, 2 * n / 15, 3 * n / 15, 4 * n / 15, n / 3, n / 3]
