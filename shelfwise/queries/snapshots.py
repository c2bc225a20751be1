"""Upserts, protected payloads, audit findings, first-wins, round robin and greedy claims."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import audit as A, dedup as D, upsert as U
from shelfwise.operators.keys import mark_repeats
from shelfwise.plans import sync
from shelfwise.queries import views as V
from shelfwise.queries.ordering import _run_folder
from shelfwise.registry import ORACLES, query, table
from shelfwise.sources.keyed import KeyedTable

_STAMP = "2024-06-01T00:00:00+00:00"
_ITEMS = f"""
WITH feed AS ({V.as_sql(V.FEED)}), mapping AS ({V.as_sql(V.MAPPING)}),
items AS (
  SELECT f.legacy_id, trim(translate(f.title, 'يك0123456789', 'یک۰۱۲۳۴۵۶۷۸۹')) AS name,
    concat('SKU-', CASE WHEN upper(trim(cat_code)) IN ('RNG','NEC','BRC','SET','EAR') THEN upper(trim(cat_code)) ELSE 'RNG' END, '-',
      CASE WHEN upper(gender_code) IN ('W','M','U') THEN upper(gender_code) ELSE 'U' END, '-', CAST(f.legacy_id AS VARCHAR)) AS sku,
    CAST(greatest(coalesce(f.stock, 0), 0) AS BIGINT) AS exact_stock,
    CASE WHEN price_locked OR (is_special_gemstone AND stone_value <= 0) THEN 'manual_locked'
      WHEN coalesce(weight_g, 0) > 0 AND stone_value > 0 THEN 'silver_weight_plus_stone'
      WHEN coalesce(weight_g, 0) > 0 THEN 'silver_weight_only' ELSE 'legacy_mirror' END AS pricing_mode,
    price, split_part(image_url, '?', 1) AS image_src, m.wc_status AS known_status, m.sku AS known_sku, coalesce(m.wc_status = 'publish', false) AS protected
  FROM feed f LEFT JOIN mapping m ON f.legacy_id = m.legacy_id)
"""


def _sync(spark, folder):
    return sync.plan(V.view(spark, folder, V.FEED), V.view(spark, folder, V.MAPPING), _STAMP)


@query("protected_payload", _ITEMS + """
SELECT legacy_id, true AS manage_stock, exact_stock AS stock_quantity, CASE WHEN NOT protected THEN name END AS name,
  CASE WHEN NOT protected THEN sku END AS sku, CASE WHEN NOT protected THEN 'draft' END AS status, CASE WHEN NOT protected THEN price END AS regular_price,
  CASE WHEN NOT protected THEN pricing_mode END AS pricing_mode, CASE WHEN NOT protected THEN image_src END AS image_src FROM items""")
def protected_payload(spark, folder):
    return _sync(spark, folder)[0]


@query("upsert_mapping", _ITEMS + f"""
SELECT coalesce(i.legacy_id, m.legacy_id) AS legacy_id, CASE WHEN i.legacy_id IS NULL OR protected THEN m.sku ELSE i.sku END AS sku,
  m.product_id AS product_id,
  CASE WHEN i.legacy_id IS NULL OR protected THEN m.wc_status ELSE 'draft' END AS wc_status,
  CASE WHEN i.legacy_id IS NULL THEN m.exact_stock ELSE i.exact_stock END AS exact_stock,
  CASE WHEN i.legacy_id IS NULL THEN m.pricing_mode ELSE i.pricing_mode END AS pricing_mode,
  CASE WHEN i.legacy_id IS NULL THEN m.last_sync_utc ELSE '{_STAMP}' END AS last_sync_utc
FROM items i FULL OUTER JOIN mapping m ON i.legacy_id = m.legacy_id""")
def upsert_mapping(spark, folder):
    return _sync(spark, folder)[1]


@query("keyed_sync", ORACLES["upsert_mapping"])
def keyed_sync(spark, folder):
    """The mapping of ``upsert_mapping``, kept as a keyed table that gets its changes only."""
    mapping = KeyedTable.create(V.view(spark, folder, V.MAPPING), _run_folder(spark, "mapping"), "legacy_id", buckets=32)
    sync.apply(V.view(spark, folder, V.FEED), mapping, _STAMP)
    return mapping.read()


@query("keyed_rerun", ORACLES["upsert_mapping"].replace("SELECT coalesce(i.legacy_id", ", after AS (SELECT coalesce(i.legacy_id", 1) + """)
SELECT 1 AS run, count(*) AS changed FROM after a LEFT JOIN mapping m ON a.legacy_id = m.legacy_id
WHERE m.legacy_id IS NULL OR a.sku IS DISTINCT FROM m.sku OR a.product_id IS DISTINCT FROM m.product_id OR a.wc_status IS DISTINCT FROM m.wc_status
  OR a.exact_stock IS DISTINCT FROM m.exact_stock OR a.pricing_mode IS DISTINCT FROM m.pricing_mode OR a.last_sync_utc IS DISTINCT FROM m.last_sync_utc
UNION ALL SELECT 2, 0""")
def keyed_rerun(spark, folder):
    """Rows each of two runs of the same sync changes: the second one none."""
    mapping = KeyedTable.create(V.view(spark, folder, V.MAPPING), _run_folder(spark, "mapping"), "legacy_id", buckets=32)
    first, second = (sync.apply(V.view(spark, folder, V.FEED), mapping, _STAMP)[0] for _ in range(2))
    counts = first.agg(F.count(F.lit(1)).alias("changed")).withColumn("run", F.lit(1))
    return counts.unionByName(second.agg(F.count(F.lit(1)).alias("changed")).withColumn("run", F.lit(2))).select("run", "changed")


_OLD = """SELECT concat('P', CAST(p_partkey AS STRING)) AS sku, p_name AS name, CASE WHEN p_partkey % 3 = 0 THEN 'publish' ELSE 'draft' END AS status,
  p_partkey * 1000 AS price, p_partkey % 4 AS stock, CASE WHEN p_partkey % 4 > 0 THEN 'instock' ELSE 'outofstock' END AS stock_status,
  p_partkey % 5 + 10 AS c1, CAST(p_partkey AS STRING) AS m1 FROM {part}"""
_NEW = """SELECT concat('P', CAST(p_partkey * 2 AS STRING)) AS sku, concat('new ', p_name) AS name, p_partkey * 1500 AS price, p_partkey % 3 AS stock,
  p_partkey % 7 + 10 AS c1, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'v' END AS m1, p_brand AS m2 FROM {part}"""


@query("merge_products", f"""WITH old AS ({V.as_sql(_OLD)}), new AS ({V.as_sql(_NEW)})
SELECT coalesce(n.sku, o.sku) AS sku, coalesce(n.name, o.name) AS name, coalesce(o.status, 'draft') AS status, coalesce(n.price, o.price) AS price,
  coalesce(n.stock, o.stock) AS stock, CASE WHEN n.sku IS NULL THEN o.stock_status WHEN n.stock > 0 THEN 'instock' ELSE 'outofstock' END AS stock_status,
  CASE WHEN n.sku IS NULL THEN CAST(o.c1 AS VARCHAR) WHEN o.sku IS NULL OR o.c1 = n.c1 THEN CAST(n.c1 AS VARCHAR)
    ELSE concat(least(o.c1, n.c1), '|', greatest(o.c1, n.c1)) END AS category_ids,
  CASE WHEN n.sku IS NULL THEN concat('a=', o.m1) ELSE concat_ws(';', CASE WHEN n.m1 <> '' THEN concat('a=', n.m1) END, concat('b=', n.m2)) END AS meta
FROM old o FULL OUTER JOIN new n ON o.sku = n.sku""")
def merge_products(spark, folder):
    old = V.view(spark, folder, _OLD).withColumn("category_ids", F.array("c1")).withColumn("meta", F.create_map(F.lit("a"), "m1"))
    new = V.view(spark, folder, _NEW).withColumn("category_ids", F.array("c1")).withColumn("meta", F.create_map(F.lit("a"), F.col("m1"), F.lit("b"), F.col("m2")))
    merged = U.merge_products(old.drop("c1", "m1"), new.drop("c1", "m1", "m2"))
    pairs = F.transform(F.array_sort(F.map_entries("meta")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return merged.withColumn("category_ids", F.concat_ws("|", F.array_sort("category_ids"))).withColumn("meta", F.concat_ws(";", pairs))


@query("keyed_products", ORACLES["merge_products"])
def keyed_products(spark, folder):
    """The products of ``merge_products``, merged into a keyed table in two steps with a compaction after each."""
    old = V.view(spark, folder, _OLD).withColumn("category_ids", F.array("c1")).withColumn("meta", F.create_map(F.lit("a"), "m1"))
    new = V.view(spark, folder, _NEW).withColumn("category_ids", F.array("c1")).withColumn("meta", F.create_map(F.lit("a"), F.col("m1"), F.lit("b"), F.col("m2")))
    store = KeyedTable.create(old.drop("c1", "m1"), _run_folder(spark, "products"), "sku", buckets=32)
    for half in (0, 1):
        U.merge_products_into(store, new.filter(F.pmod(F.xxhash64("sku"), F.lit(2)) == half).drop("c1", "m1", "m2"))
        store.compact()
    pairs = F.transform(F.array_sort(F.map_entries("meta")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return store.read().withColumn("category_ids", F.concat_ws("|", F.array_sort("category_ids"))).withColumn("meta", F.concat_ws(";", pairs))


_PRICED = """SELECT p_partkey AS id, CAST(p_partkey * 1000 AS STRING) AS regular_price, CASE WHEN p_partkey % 4 = 0 THEN '5' END AS sale_price FROM {part}"""
_MOVES = "SELECT p_partkey * 3 AS id, p_partkey * 2000 AS new_regular_price FROM {part}"


@query("keyed_prices", f"""WITH store AS ({V.as_sql(_PRICED)}), moves AS ({V.as_sql(_MOVES)})
SELECT s.id, coalesce(CAST(m.new_regular_price AS VARCHAR), s.regular_price) AS regular_price, CASE WHEN m.id IS NULL THEN s.sale_price END AS sale_price, false AS gone
FROM store s LEFT JOIN moves m ON m.id = s.id
UNION ALL SELECT m.id, CAST(m.new_regular_price AS VARCHAR), NULL, true FROM moves m WHERE m.id NOT IN (SELECT id FROM store)""")
def keyed_prices(spark, folder):
    """A keyed store after a price write-back, and the price rows whose product is gone."""
    store = KeyedTable.create(V.view(spark, folder, _PRICED), _run_folder(spark, "prices"), "id", buckets=32)
    gone, _ = U.apply_prices_to(store, V.view(spark, folder, _MOVES))
    missing = gone.select("id", F.col("new_regular_price").cast("string").alias("regular_price"), F.lit(None).cast("string").alias("sale_price"), F.lit(True).alias("gone"))
    return store.read().withColumn("gone", F.lit(False)).unionByName(missing)


_DRAFTS = """SELECT p_partkey + 1000 AS product_id, CAST(p_partkey AS STRING) AS legacy_id, CASE WHEN p_partkey % 8 = 0 THEN 'publish' ELSE 'draft' END AS status,
  p_name AS title, '' AS description, p_partkey * 1000 AS regular_price FROM {part}"""
_ENRICHED = """SELECT p_partkey + 1100 AS product_id, CASE WHEN p_partkey % 9 = 0 THEN '?' ELSE CAST(p_partkey + 100 AS STRING) END AS legacy_id,
  concat('t ', p_name) AS title, concat('d ', p_brand) AS description, p_partkey % 2 = 0 AS update_price, p_partkey * 1700 AS regular_price FROM {part}"""
_TARGETS = f"""WITH drafts AS ({V.as_sql(_DRAFTS)}), enriched AS ({V.as_sql(_ENRICHED)}),
joined AS (SELECT e.*, d.product_id AS found, d.status, d.legacy_id AS old_id, d.regular_price AS old_price,
  CASE WHEN d.product_id IS NULL OR d.status <> 'draft' THEN 'DRAFT_NOT_FOUND' WHEN d.legacy_id <> e.legacy_id THEN 'LEGACY_ID_MISMATCH' END AS problem
  FROM enriched e LEFT JOIN drafts d ON d.product_id = e.product_id)"""


@query("targeted_updates", _TARGETS + """ SELECT product_id, old_id AS legacy_id, status, title, description,
CASE WHEN update_price THEN regular_price ELSE old_price END AS regular_price FROM joined WHERE problem IS NULL""")
def targeted_updates(spark, folder):
    return U.targeted_updates(V.view(spark, folder, _DRAFTS), V.view(spark, folder, _ENRICHED))[0]


@query("update_violations", _TARGETS + " SELECT product_id, legacy_id, problem FROM joined WHERE problem IS NOT NULL")
def update_violations(spark, folder):
    return U.targeted_updates(V.view(spark, folder, _DRAFTS), V.view(spark, folder, _ENRICHED))[1]


_ANOMALIES = f"""
WITH store AS ({V.as_sql(V.STORE)}),
facts AS (
  SELECT id, sku, name, stock_quantity, manage_stock, catalog_visibility, trim(mode_text) AS mode,
    coalesce(TRY_CAST(replace(weight_text, ',', '') AS DOUBLE), 0) AS w, coalesce(TRY_CAST(replace(stone_text, ',', '') AS DOUBLE), 0) AS s,
    sku <> '' AND row_number() OVER (PARTITION BY sku ORDER BY id) > 1 AS again
  FROM store WHERE status = 'publish' AND id > 0),
found AS (
  SELECT 'zero_visible' AS label, id, sku, name, stock_quantity FROM facts WHERE manage_stock AND stock_quantity = 0 AND catalog_visibility <> 'hidden'
  UNION ALL SELECT 'negative_stock', id, sku, name, stock_quantity FROM facts WHERE stock_quantity < 0
  UNION ALL SELECT 'missing_weight_meta', id, sku, name, stock_quantity FROM facts WHERE mode IN ('silver_weight_only', 'silver_weight_plus_stone') AND w <= 0
  UNION ALL SELECT 'missing_stone_value', id, sku, name, stock_quantity FROM facts WHERE mode = 'silver_weight_plus_stone' AND s < 1
  UNION ALL SELECT 'mode_no_manage_stock', id, sku, name, stock_quantity FROM facts WHERE mode IN ('silver_weight_only', 'silver_weight_plus_stone') AND NOT manage_stock
  UNION ALL SELECT 'duplicate_sku', id, sku, name, stock_quantity FROM facts WHERE again)
"""


def _found(spark, folder):
    from shelfwise import constants as K
    from shelfwise.sources.reading import published_products

    return A.anomaly_rows(published_products(V.store(spark, folder), K.MODE_KEYS + K.WEIGHT_KEYS + K.STONE_VALUE_KEYS))


@query("anomaly_rows", _ANOMALIES + "SELECT * FROM found")
def anomaly_rows(spark, folder):
    return _found(spark, folder)


@query("anomaly_buckets", _ANOMALIES + "SELECT label, count(*) AS n FROM found GROUP BY label")
def anomaly_buckets(spark, folder):
    return A.anomaly_counts(_found(spark, folder))


@query("anomaly_top_per_bucket", _ANOMALIES + """
SELECT label, id, sku, name, stock_quantity, rank, greatest(n - 50, 0) AS more FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY label ORDER BY id) AS INT) AS rank, count(*) OVER (PARTITION BY label) AS n FROM found) WHERE rank <= 50""")
def anomaly_top_per_bucket(spark, folder):
    return A.anomaly_report(_found(spark, folder))


@query("first_wins_sku", f"""WITH store AS ({V.as_sql(V.STORE)})
SELECT id, sku, sku <> '' AND row_number() OVER (PARTITION BY sku ORDER BY id) > 1 AS repeated FROM store""")
def first_wins_sku(spark, folder):
    rows = V.view(spark, folder, V.STORE).select("id", "sku")
    return mark_repeats(rows, F.nullif(F.col("sku"), F.lit("")), ["id"], "repeated")


@query("first_wins_line", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey) > 1 AS repeated FROM lineitem""")
def first_wins_line(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return mark_repeats(lines, F.col("l_partkey"), ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"], "repeated")


_CURRENCY = f"WITH orders_view AS ({V.as_sql(V.ORDERS)})"


@query("currency_violations", _CURRENCY + " SELECT currency, count(*) AS n FROM orders_view WHERE currency <> 'IRT' GROUP BY currency")
def currency_violations(spark, folder):
    return A.currency_violations(V.view(spark, folder, V.ORDERS))


_PRICES = """SELECT p_partkey AS id, p_partkey * 1000 AS final_price, CASE WHEN p_partkey % 10 = 1 THEN NULL ELSE p_partkey * 1000 END AS regular_price,
  CASE WHEN p_partkey % 15 = 2 THEN 5 ELSE p_partkey * 1000 END AS current_price, CASE WHEN p_partkey % 21 = 3 THEN 7 END AS sale_price FROM {part}"""


@query("single_price_violations", f"""WITH prices AS ({V.as_sql(_PRICES)}) SELECT id, final_price, regular_price, current_price, sale_price FROM prices
WHERE regular_price IS DISTINCT FROM final_price OR current_price IS DISTINCT FROM final_price OR sale_price IS NOT NULL""")
def single_price_violations(spark, folder):
    return A.single_price_violations(V.view(spark, folder, _PRICES))


@query("duplicate_codes", f"WITH c AS ({V.as_sql(V.CANDIDATES)}) SELECT lower(code) AS code, count(*) AS n FROM c WHERE code IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_codes(spark, folder):
    return D.duplicate_codes(V.view(spark, folder, V.CANDIDATES), F.col("code"))


_LINKS = f"WITH links AS ({V.as_sql(V.LINKS)})"


@query("round_robin", _LINKS + """, ranked AS (SELECT *, row_number() OVER (PARTITION BY group_no ORDER BY position) AS rank FROM links),
sizes AS (SELECT rank, sum(count(*)) OVER (ORDER BY rank) AS taken FROM ranked GROUP BY rank),
kept AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY rank, group_no) AS seen FROM ranked
  WHERE rank <= (SELECT coalesce(min(rank) FILTER (taken >= 100), max(rank)) FROM sizes))
SELECT url, CAST(rank AS INT) AS round_no, group_no FROM kept WHERE seen = 1""")
def round_robin(spark, folder):
    return D.round_robin(V.view(spark, folder, V.LINKS), 100)


@query("first_per_category", _LINKS + " SELECT group_no, arg_min(url, position) AS url FROM links GROUP BY group_no")
def first_per_category(spark, folder):
    return D.first_per_group(V.view(spark, folder, V.LINKS))


_WALK = f"""
WITH RECURSIVE candidates AS ({V.as_sql(V.CANDIDATES)}),
c AS (SELECT row_no, legacy_id, code, sku, row_number() OVER (ORDER BY row_no) AS k FROM candidates),
walk AS (
  SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS ids, CAST([] AS VARCHAR[]) AS codes, CAST([] AS VARCHAR[]) AS skus,
    CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS conflicts_with
  UNION ALL
  SELECT k, CASE WHEN reason IS NULL THEN list_append(ids, legacy_id) ELSE ids END, CASE WHEN reason IS NULL THEN list_append(codes, code) ELSE codes END,
    CASE WHEN reason IS NULL THEN list_append(skus, sku) ELSE skus END, reason,
    CASE reason WHEN 'DUPLICATE_LEGACY_CODE' THEN CAST(ids[list_position(codes, code)] AS VARCHAR)
      WHEN 'NORMALIZED_SKU_CONFLICT' THEN CAST(ids[list_position(skus, sku)] AS VARCHAR) END
  FROM (
    SELECT c.k, w.ids, w.codes, w.skus, CAST(c.legacy_id AS BIGINT) AS legacy_id, CAST(c.code AS VARCHAR) AS code, CAST(c.sku AS VARCHAR) AS sku,
      CASE WHEN c.code IS NULL OR c.sku IS NULL THEN 'MISSING_LEGACY_CODE' WHEN list_contains(w.ids, CAST(c.legacy_id AS BIGINT)) THEN 'DUPLICATE_LEGACY_ID'
        WHEN list_contains(w.codes, CAST(c.code AS VARCHAR)) THEN 'DUPLICATE_LEGACY_CODE' WHEN list_contains(w.skus, CAST(c.sku AS VARCHAR)) THEN 'NORMALIZED_SKU_CONFLICT' END AS reason
    FROM walk w JOIN c ON c.k = w.k + 1)
),
claims AS (SELECT c.row_no, c.legacy_id, c.code, c.sku, w.reason, w.conflicts_with FROM c JOIN walk w ON w.k = c.k)
"""


@query("greedy_dedup", _WALK + "SELECT * FROM claims")
def greedy_dedup(spark, folder):
    return D.greedy_claims(V.view(spark, folder, V.CANDIDATES), "row_no", "legacy_id", "code", "sku")


@query("greedy_run_summary", _WALK + """
SELECT 10000 AS requested_limit, count(*) FILTER (reason IS NULL) AS accepted, count(*) FILTER (reason IS NOT NULL) AS skipped, count(*) AS candidates,
  CASE WHEN count(*) FILTER (reason IS NULL) < 10000 THEN concat('only ', count(*) FILTER (reason IS NULL), ' unique-code products collected from ', count(*), ' candidates') END AS incomplete_reason
FROM claims""")
def greedy_run_summary(spark, folder):
    claims = D.greedy_claims(V.view(spark, folder, V.CANDIDATES), "row_no", "legacy_id", "code", "sku")
    return D.run_summary(claims, 10_000)
