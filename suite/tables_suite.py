"""Reading, writing, conforming and maintaining tables; the basket stream."""

from uuid import uuid4

from pyspark.sql import functions as F

from shelfline.operators import quality as q
from shelfline.operators import sales as sales_ops
from shelfline.operators.catalog import flatten_products
from shelfline.operators.orders import units_by_order
from shelfline.plans.reports import as_json
from shelfline.schema import table_schema
from shelfline.session import ensure_checkpoint_dir
from shelfline.sources import maintain, readers, writers
from shelfline.sources.bridge import AS_OF, BASKET_NOW
from shelfline.sources.conform import conform_types
from shelfline.streaming import basket as stream
from suite.catalog_suite import pages
from suite.model_sql import AS_OF as A
from suite.model_sql import BASKET_NOW as NOW
from suite.quality_suite import core
from suite.registry import Suite

_CORE_SQL = {"products": "m_products", "product_skus": "m_skus", "customers": "m_customers", "orders": "m_orders", "order_items": "m_items", "sales": "m_sales"}
_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS rows FROM {t}" for n, t in _CORE_SQL.items())


def scratch(m, name: str) -> str:
    """A fresh folder beside the session's checkpoints, which every executor can reach."""
    return f"{ensure_checkpoint_dir(m.spark)}/shelfline-{uuid4().hex}/{name}"


def _csv_round_trip(m):
    folder = scratch(m, "csv")
    writers.write_csv({"orders": m.orders}, folder)
    return readers.read_csv(m.spark, f"{folder}/orders.csv", "orderId string, customerId bigint, orderDate timestamp_ntz, deliveryDate timestamp_ntz, orderStatus string, totalAmount decimal(10,2), itemCount int")


def _parquet_round_trip(m):
    folder = scratch(m, "parquet")
    writers.write_parquet({"order_items": m.order_items}, folder)
    return readers.read_parquet(m.spark, f"{folder}/order_items.parquet", ["orderItemId", "orderId", "productId", "quantity"])


def _partitioned_round_trip(m):
    folder = scratch(m, "partitioned")
    writers.write_parquet({"orders": m.orders}, folder, {"orders": ["orderStatus"]})
    return m.spark.read.parquet(f"{folder}/orders.parquet").select("orderId", "customerId", "orderStatus", "itemCount")


def _overwritten_partitions(m):
    folder = f"{scratch(m, 'overwrite')}/orders"
    orders = m.orders.select("orderId", "orderStatus", "itemCount")
    maintain.overwrite_partitions(orders, folder, "orderStatus")
    delivered = orders.filter("orderStatus = 'DELIVERED'").withColumn("itemCount", F.col("itemCount") + 100)
    maintain.overwrite_partitions(delivered, folder, "orderStatus")
    return m.spark.read.parquet(folder)


def _clustered_round_trip(m):
    folder = scratch(m, "clustered")
    writers.write_clustered(m.order_items, folder, "productId", "orderItemId")
    return m.spark.read.parquet(folder).select("orderItemId", "orderId", "productId", "quantity")


def _json_round_trip(m):
    folder = scratch(m, "json")
    pages(m).write.json(folder)
    return flatten_products(readers.read_product_json(m.spark, folder, lines=True)).select("sku", "name", "price", "category", "subcategory")


def _database(m) -> str:
    """A new database whose tables lie beside the session's checkpoints."""
    name = f"load_{uuid4().hex}"
    m.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch(m, name)}'")
    return name


def _saved_table(m):
    """Delivered orders without their item count, then all others with it."""
    name = f"{_database(m)}.orders"
    done = F.col("orderStatus") == "DELIVERED"
    writers.save_table(m.orders.filter(done).select("orderId", "orderStatus"), name)
    writers.save_table(m.orders.filter(~done).select("itemCount", "orderId", "orderStatus"), name, mode="append")
    return m.spark.table(name)


def _loaded(m):
    """The core tables, one that cannot be read, and the orders a second time; what the load reports beside what the tables hold."""
    database, known = _database(m), core(m)
    names = writers.load_order(["sales", "order_items", "stock", *[n for n in known if n not in ("sales", "order_items")]])
    report = writers.load_all(m.spark, known.__getitem__, names, database)
    again = writers.load_all(m.spark, known.__getitem__, ["orders"], database, mode="append").select(F.lit(len(names)).alias("position"), "table_name", "row_count", "status")
    return report.unionByName(again).withColumn("status", F.substring_index("status", ":", 1))


def _bucketed(m):
    """Orders, lines and sales stored by order id, then joined by it."""
    database = _database(m)
    names = ["orders", "order_items", "sales"]
    writers.save_bucketed({n: m.table(n) for n in names}, "orderId", 8, database)
    return units_by_order(*[m.spark.table(f"{database}.{n}") for n in names])


def _views(m):
    prefix = f"t{uuid4().hex[:8]}_"
    readers.register_views(m.spark, core(m), prefix)
    listed = writers.catalog_summary(m.spark).filter(F.col("name").startswith(prefix))
    return listed.select(F.substring("name", len(prefix) + 1, 64).alias("name"), "kind", "rows")


def _events(m):
    return m.spark.readStream.schema(m.raw("events").schema).option("pathGlobFilter", "events.parquet").parquet(m.folder)


def _stream(m):
    """The events file as a stream of basket rows, run to its end."""
    events = _events(m)
    folder = scratch(m, "stream")
    summary = stream.stream_itb_summary(m.basket_rows(events), BASKET_NOW, exact_sessions=True)
    stream.run_available(summary, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    totals = stream.latest_totals(m.spark.read.parquet(f"{folder}/out"))
    return totals.select("basket_day", "productId", "active_sessions", "total_quantity", "basket_rows", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("earliest_add", "latest_add")])


def _live(m):
    """The same rows, each out again once the stream's clock has passed its expiry."""
    folder = scratch(m, "live")
    stream.run_available(stream.stream_live_basket(m.basket_rows(_events(m)), "1 hour"), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    totals = stream.live_totals(m.spark.read.parquet(f"{folder}/out"))
    return totals.select("basket_day", "productId", "active_sessions", "total_quantity", "basket_rows", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("earliest_add", "latest_add")])


def register(s: Suite) -> None:
    s.add(
        "read_parquet_columns",
        lambda m: readers.read_parquet(m.spark, f"{m.folder}/lineitem.parquet", ["l_orderkey", "l_quantity"]).groupBy("l_orderkey").agg(F.sum("l_quantity").alias("quantity")),
        "SELECT l_orderkey, SUM(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey",
    )
    s.add(
        "read_multi",
        lambda m: q.table_counts(readers.read_multi(m.spark, {t: f"{m.folder}/{t}.parquet" for t in ("orders", "customer", "part")})),
        """SELECT 'orders' AS table_name, COUNT(*) AS rows FROM orders UNION ALL SELECT 'customer', COUNT(*) FROM customer UNION ALL SELECT 'part', COUNT(*) FROM part
           UNION ALL SELECT 'TOTAL', (SELECT COUNT(*) FROM orders) + (SELECT COUNT(*) FROM customer) + (SELECT COUNT(*) FROM part)""",
    )
    s.add("write_and_read_csv", _csv_round_trip, "SELECT orderId, customerId, orderDate, deliveryDate, orderStatus, total_pence::DOUBLE / 100 AS totalAmount, itemCount::BIGINT AS itemCount FROM m_orders")
    s.add("write_and_read_parquet", _parquet_round_trip, "SELECT orderItemId, orderId, productId, quantity::BIGINT AS quantity FROM m_items")
    s.add("write_and_read_partitioned", _partitioned_round_trip, "SELECT orderId, customerId, orderStatus, itemCount::BIGINT AS itemCount FROM m_orders")
    s.add(
        "overwrite_partitions",
        _overwritten_partitions,
        "SELECT orderId, orderStatus, (itemCount + CASE WHEN orderStatus = 'DELIVERED' THEN 100 ELSE 0 END)::BIGINT AS itemCount FROM m_orders",
    )
    s.add("write_and_read_clustered", _clustered_round_trip, "SELECT orderItemId, orderId, productId, quantity::BIGINT AS quantity FROM m_items")
    s.add(
        "write_and_read_product_json",
        _json_round_trip,
        """SELECT LPAD(p_partkey::VARCHAR, 18, '0') AS sku, p_name AS name, ROUND(p_retailprice * 100) AS price, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_type END AS category,
                  CASE WHEN p_size % 5 = 0 OR p_size % 3 = 0 THEN '' ELSE p_name END AS subcategory FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 8 = 0)""",
    )
    s.add("save_table", _saved_table, "SELECT orderId, orderStatus, CASE WHEN orderStatus <> 'DELIVERED' THEN itemCount END::BIGINT AS itemCount FROM m_orders")
    s.add(
        "load_all",
        _loaded,
        f"""WITH c AS ({_COUNTS}), t(position, table_name) AS (VALUES (0, 'products'), (1, 'stock'), (2, 'product_skus'), (3, 'customers'), (4, 'orders'), (5, 'sales'), (6, 'order_items'), (7, 'orders'))
            SELECT position::BIGINT AS position, t.table_name, (CASE WHEN t.table_name = 'stock' THEN 0 WHEN position = 7 THEN 2 * rows ELSE rows END)::BIGINT AS row_count,
                   CASE WHEN t.table_name = 'stock' THEN 'Error' ELSE 'Success' END AS status
            FROM t LEFT JOIN c ON c.table_name = t.table_name""",
    )
    s.add(
        "save_bucketed",
        _bucketed,
        """SELECT o.orderId, orderStatus, COALESCE(n, 0) AS lines, COALESCE(u, 0)::BIGINT AS units_ordered, COALESCE(su, 0)::BIGINT AS units_sold, COALESCE(p, 0)::BIGINT AS pence_sold
           FROM m_orders o LEFT JOIN (SELECT orderId, COUNT(*) AS n, SUM(quantity) AS u FROM m_items GROUP BY 1) i ON o.orderId = i.orderId
           LEFT JOIN (SELECT orderId, SUM(quantity) AS su, SUM(quantity * unit_pence) AS p FROM m_sales GROUP BY 1) s ON o.orderId = s.orderId""",
    )
    s.add("register_views", _views, f"SELECT table_name AS name, 'VIEW' AS kind, rows FROM ({_COUNTS})")
    s.add("table_counts", lambda m: q.table_counts(core(m)), f"SELECT * FROM ({_COUNTS}) UNION ALL SELECT 'TOTAL', SUM(rows)::BIGINT FROM ({_COUNTS})")
    s.add(
        "export_manifest",
        lambda m: writers.export_manifest(core(m)).select("table_name", "row_count", F.coalesce(F.size("columns") == F.col("column_count"), F.col("table_name") == "TOTAL").alias("columns_listed")),
        f"SELECT table_name, rows AS row_count, TRUE AS columns_listed FROM ({_COUNTS}) UNION ALL SELECT 'TOTAL', SUM(rows)::BIGINT, TRUE FROM ({_COUNTS})",
    )
    s.add(
        "describe_table",
        lambda m: writers.describe_table(m.sales, "sales")
        .withColumn("rows", m.sales.agg(F.count(F.lit(1))).scalar()),
        """SELECT 'sales' AS table_name, position, column_name, data_type, (SELECT COUNT(*) FROM m_sales) AS rows
           FROM (VALUES (0::BIGINT, 'saleId', 'string'), (1, 'orderId', 'string'), (2, 'orderItemId', 'string'), (3, 'customerId', 'bigint'), (4, 'productId', 'string'),
                        (5, 'saleDate', 'timestamp_ntz'), (6, 'unitPrice', 'decimal(10,2)'), (7, 'quantity', 'int')) t(position, column_name, data_type)""",
    )
    s.add(
        "report_json",
        lambda m: as_json(sales_ops.sales_coverage(m.sales)),
        """SELECT '{"first_sale":"' || MIN(sale_day)::VARCHAR || '","last_sale":"' || MAX(sale_day)::VARCHAR || '","days_with_sales":' || COUNT(DISTINCT sale_day) || ',"total_sales":' || COUNT(*) || '}' AS report FROM m_sales""",
    )
    s.add(
        "conform_types",
        lambda m: conform_types(m.order_items.withColumn("productId", F.col("productId").cast("long")).withColumn("quantity", F.col("quantity").cast("string")), table_schema("order_items")).drop("created_at"),
        "SELECT orderItemId, orderId, productId, quantity::BIGINT AS quantity, unit_pence::DOUBLE / 100 AS unitPrice, line_pence::DOUBLE / 100 AS totalPrice FROM m_items",
    )
    s.add(
        "append_rows",
        lambda m: maintain.append(m.orders.filter(F.col("orderStatus") == "DELIVERED"), m.orders.filter(F.col("orderStatus") == "PICKED").drop("itemCount")).select("orderId", "orderStatus", "itemCount"),
        "SELECT orderId, orderStatus, CASE WHEN orderStatus = 'DELIVERED' THEN itemCount END::BIGINT AS itemCount FROM m_orders WHERE orderStatus IN ('DELIVERED', 'PICKED')",
    )
    s.add(
        "replace_slice",
        lambda m: maintain.replace_slice(m.purchase_orders, m.purchase_orders.filter(F.col("supplier_id") == 1).withColumn("po_status", F.lit("NEW")), F.col("order_date") >= F.lit(AS_OF)).select("po_id", "po_status", "order_date"),
        f"SELECT po_id, po_status, order_date FROM m_po WHERE order_date < {A} UNION ALL SELECT po_id, 'NEW', order_date FROM m_po WHERE supplier_id = 1",
    )
    s.add(
        "delete_dependents",
        lambda m: maintain.delete_dependents(m.inbound_deliveries, m.purchase_orders.filter(F.col("order_date") >= F.lit(AS_OF)), "po_id").select("delivery_id", "po_id"),
        f"SELECT delivery_id, po_id FROM m_inbound WHERE po_id NOT IN (SELECT po_id FROM m_po WHERE order_date >= {A})",
    )
    s.add(
        "update_from",
        lambda m: maintain.update_from(m.products, m.products.filter(F.col("category") == "Bakery").select("productId", (F.col("price_pence") * 2).alias("price_pence")), ["productId"], ["price_pence"]).select("productId", "price_pence"),
        "SELECT productId, CASE WHEN category = 'Bakery' THEN price_pence * 2 ELSE price_pence END::BIGINT AS price_pence FROM m_products",
    )
    s.add(
        "update_status",
        lambda m: maintain.update_status(m.inbound_deliveries, m.inbound_deliveries.filter(F.col("quantity") > 25).select("delivery_id", F.lit("RECEIVED").alias("status")), "delivery_id").select("delivery_id", "status"),
        "SELECT delivery_id, CASE WHEN delivery_id IN (SELECT delivery_id FROM m_inbound WHERE quantity > 25) THEN 'RECEIVED' ELSE status END AS status FROM m_inbound",
    )
    s.add(
        "close_parents",
        lambda m: maintain.close_parents(m.purchase_orders.withColumn("po_status", F.lit("PENDING")), m.inbound_deliveries, "po_id", "po_status").select("po_id", "po_status"),
        "SELECT po_id, po_status FROM m_po",
    )
    s.add(
        "assign_surrogate_id",
        lambda m: maintain.assign_surrogate_id(m.orders, ["orderDate", "orderId"], "order_number", start=1000, key=["orderId"]).select("orderId", "order_number"),
        "SELECT orderId, ROW_NUMBER() OVER (ORDER BY orderDate, orderId) + 999 AS order_number FROM m_orders",
    )
    s.add(
        "stream_itb_summary",
        _stream,
        f"""SELECT added_at::DATE AS basket_day, productId, COUNT(DISTINCT session_id) AS active_sessions, SUM(quantity)::BIGINT AS total_quantity, COUNT(*) AS basket_rows,
                   MIN(added_at) AS earliest_add, MAX(added_at) AS latest_add
            FROM m_basket WHERE status = 'ACTIVE' AND (expires_at IS NULL OR expires_at > {NOW}) GROUP BY 1, 2""",
    )
    s.add(
        "stream_live_basket",
        _live,
        """SELECT added_at::DATE AS basket_day, productId, COUNT(DISTINCT session_id) AS active_sessions, SUM(quantity)::BIGINT AS total_quantity, COUNT(*) AS basket_rows,
                  MIN(added_at) AS earliest_add, MAX(added_at) AS latest_add
           FROM m_basket WHERE status = 'ACTIVE'
             AND (expires_at IS NULL OR expires_at >= (SELECT date_trunc('millisecond', MAX(added_at)) - INTERVAL 1 HOUR FROM m_basket WHERE status = 'ACTIVE')) GROUP BY 1, 2""",
    )
