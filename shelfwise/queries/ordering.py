"""New-order watch, alert texts and the streaming jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shelfwise.operators import orders as O
from shelfwise.queries import views as V
from shelfwise.registry import query, table
from shelfwise.session import cut_lineage, shared_folder
from shelfwise.streaming import audits as SA, orders as SO

_ORDERS = f"WITH orders_view AS ({V.as_sql(V.ORDERS)}), items_view AS ({V.as_sql(V.ITEMS)})"
_FA = "translate(CAST({0} AS VARCHAR), '0123456789', '۰۱۲۳۴۵۶۷۸۹')"
_ALERTS = _ORDERS + f""", counted AS (SELECT id, count(*) AS n FROM items_view GROUP BY id),
lines AS (SELECT id, string_agg(concat('• ', {_FA.format('quantity')}, '× ', substring(name, 1, 40)), chr(10) ORDER BY position) AS body
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY position) AS rn FROM items_view) WHERE rn <= 3 GROUP BY id),
texts AS (SELECT o.id, concat('📦 سفارش جدید #', {_FA.format('o.id')}, chr(10), 'وضعیت: ',
  CASE status WHEN 'processing' THEN 'در حال پردازش' WHEN 'on-hold' THEN 'در انتظار بررسی' ELSE status END, chr(10), 'شهر: ',
  coalesce(nullif(shipping_city, ''), nullif(billing_city, ''), '—'), chr(10),
  CASE WHEN n IS NULL THEN '• (فاقد جزئیات اقلام)' ELSE body END, CASE WHEN n > 3 THEN concat(chr(10), '• و ', {_FA.format('n - 3')}, ' قلم دیگر') ELSE '' END,
  chr(10), 'مبلغ: ', translate(format('{{:,}}', CAST(total AS BIGINT)), '0123456789', '۰۱۲۳۴۵۶۷۸۹'), ' تومان',
  CASE WHEN upper(currency) <> 'IRT' THEN concat(' (', currency, ')') ELSE '' END) AS text
  FROM orders_view o LEFT JOIN counted c ON o.id = c.id LEFT JOIN lines l ON o.id = l.id WHERE status IN ('processing', 'on-hold'))
"""


def _orders(spark, folder):
    return V.view(spark, folder, V.ORDERS)


def _with_items(spark, folder, orders):
    bare = orders.withColumn("line_items", F.lit(None).cast("array<struct<name:string,quantity:int>>"))
    names = table(spark, folder, "part").select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"))
    return O.with_items(bare, V.view(spark, folder, V.ITEM_LINES), names=names)


@query("new_orders", _ORDERS + " SELECT * FROM orders_view WHERE status IN ('processing', 'on-hold') AND id > 0")
def new_orders(spark, folder):
    return O.new_orders(_orders(spark, folder), 0)


@query("new_orders_since", _ORDERS + """, top AS (SELECT max(id) // 2 AS cursor FROM orders_view)
SELECT * FROM orders_view WHERE status IN ('processing', 'on-hold') AND id > (SELECT cursor FROM top)""")
def new_orders_since(spark, folder):
    orders = _orders(spark, folder)
    return O.new_orders(orders, orders.agg(F.expr("max(id) div 2")).scalar())


@query("order_cursor", _ORDERS + " SELECT greatest(max(id), 10) AS last_seen_id FROM orders_view WHERE status IN ('processing', 'on-hold')")
def order_cursor(spark, folder):
    return O.next_cursor(O.watched(_orders(spark, folder)), 10)


@query("order_alert_text", _ALERTS + "SELECT id, text FROM texts")
def order_alert_text(spark, folder):
    return O.alerts(_with_items(spark, folder, O.watched(_orders(spark, folder))))


@query("order_item_summary", _ORDERS + """ SELECT id, count(*) AS item_count,
string_agg(name, '|' ORDER BY position) FILTER (rn <= 3) AS first_items
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY position) AS rn FROM items_view) GROUP BY id""")
def order_item_summary(spark, folder):
    found = O.item_summary(V.view(spark, folder, V.ITEMS))
    return found.select("id", "item_count", F.concat_ws("|", F.transform("first_items", lambda x: x["name"])).alias("first_items"))


def _run_folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("stream_new_orders", _ALERTS + "SELECT id, text FROM texts")
def stream_new_orders(spark, folder):
    """The alerts of ``order_alert_text``, from a stream of bare orders whose items and city are looked up batch by batch."""
    stream = SO.order_stream(spark, folder, table(spark, folder, "orders").schema, "orders.parquet")
    status = F.when(F.col("o_orderstatus") == "F", "processing").when(F.col("o_orderstatus") == "O", "on-hold").otherwise("pending")
    orders = stream.select(F.col("o_orderkey").alias("id"), status.alias("status"))

    def enrich(batch):
        known = _orders(spark, folder).drop("status")
        return _with_items(spark, folder, batch.join(known, "id"))

    work = _run_folder(spark, "alerts")
    SO.start_alerts(orders, f"{work}/outbox", f"{work}/progress", enrich=enrich).awaitTermination()
    return SO.read_outbox(spark, f"{work}/outbox").select("id", "text")


@query("stream_rescan", _ALERTS + "SELECT id, text, count(*) AS times FROM texts GROUP BY ALL")
def stream_rescan(spark, folder):
    """The alerts after two full reads with fresh checkpoints, the first one in bounded steps: each order once."""
    known = cut_lineage(_with_items(spark, folder, _orders(spark, folder).drop("status")))  # one pass over the lines for all batches
    work = _run_folder(spark, "rescan")
    status = F.when(F.col("o_orderstatus") == "F", "processing").when(F.col("o_orderstatus") == "O", "on-hold").otherwise("pending")
    bare = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), status.alias("status"))
    bare.repartition(6, "id").write.parquet(f"{work}/in")
    for run, files in (("first", 2), ("second", None)):
        stream = SO.order_stream(spark, f"{work}/in", bare.schema, "*.parquet", files)
        SO.start_alerts(stream, f"{work}/outbox", f"{work}/{run}", enrich=lambda batch: batch.join(known, "id")).awaitTermination()
    return SO.read_outbox(spark, f"{work}/outbox").groupBy("id", "text").agg(F.count(F.lit(1)).alias("times"))


@query("stream_inventory_audit", """
WITH f AS (SELECT event_id AS id, user_id AS sku, CAST(floor(value) AS BIGINT) % 5 - 1 AS q, event_type <> 'error' AS m FROM events),
found AS (SELECT 'zero_visible' AS label FROM f WHERE m AND q = 0 UNION ALL SELECT 'negative_stock' FROM f WHERE q < 0
UNION ALL SELECT 'duplicate_sku' FROM (SELECT row_number() OVER (PARTITION BY sku ORDER BY id) AS rn FROM f) WHERE rn > 1)
SELECT label, count(*) AS n FROM found GROUP BY label""")
def stream_inventory_audit(spark, folder):
    schema = table(spark, folder, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    products = stream.select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("sku"),
        F.col("event_type").alias("name"),
        (F.col("event_type") != "error").alias("manage_stock"),
        (F.floor("value").cast("bigint") % 5 - 1).alias("stock_quantity"),
        F.lit("visible").alias("catalog_visibility"),
        F.create_map().cast("map<string,string>").alias("meta"),
    )
    work = _run_folder(spark, "audit")
    SA.start_inventory_audit(products, f"{work}/report", f"{work}/progress").awaitTermination()
    return spark.read.parquet(f"{work}/report").select("label", "n")
