"""CSV import rules, decisions and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import importing as M, upsert as U
from shelfwise.queries import views as V
from shelfwise.registry import query, table

_FROM, _TO = "۰۱۲۳۴۵۶۷۸۹٫٬, ", "0123456789."


def _num(column: str) -> str:
    return f"translate(trim({column}), '{_FROM}', '{_TO}')"


def _bad_int(column: str) -> str:
    return f"WHEN {_num(column)} <> '' AND NOT regexp_matches({_num(column)}, '^[0-9]+$') THEN '{column} must be a non-negative integer'"


_VALIDATED = f"""
WITH raw AS ({V.as_sql(V.IMPORT_FILE)}),
typed AS (
  SELECT *, upper(trim(sku)) AS k, lower(trim(category)) AS cat, TRY_CAST({_num('weight_grams')} AS DECIMAL(18,4)) AS w,
    TRY_CAST({_num('stone_value_toman')} AS BIGINT) AS sv, TRY_CAST({_num('legacy_price_toman')} AS BIGINT) AS lp,
    TRY_CAST({_num('manual_price_toman')} AS BIGINT) AS mp,
    [trim(x) FOR x IN string_split(image_filenames, '|') IF trim(x) <> ''] AS images
  FROM raw),
ruled AS (
  SELECT *,
    CASE WHEN contains(k, 'SAMPLE') THEN 'SAMPLE row detected; replace sample SKU/content before import'
      WHEN NOT regexp_matches(k, '^SKU-(RNG|NEC|BRC)-(W|M|U)-[0-9]{{4,}}$') THEN 'sku must match SKU-(RNG|NEC|BRC)-(W|M|U)-NNNN' END AS early,
    CASE WHEN trim(title_fa) = '' THEN 'title_fa is required' WHEN short_description = '' THEN 'short_description is required'
      WHEN long_description = '' THEN 'long_description is required'
      WHEN cat NOT IN ('rings', 'necklaces', 'bracelets') THEN 'category must be rings, necklaces, or bracelets'
      WHEN substring(k, 5, 3) <> CASE cat WHEN 'rings' THEN 'RNG' WHEN 'necklaces' THEN 'NEC' ELSE 'BRC' END THEN 'SKU category code does not match category column'
      WHEN {_num('silver_purity')} = '' THEN 'silver_purity is required'
      {_bad_int('silver_purity')}
      WHEN {_num('silver_purity')} <> '925' THEN 'silver_purity must equal 925'
      WHEN pricing_mode NOT IN ('silver_weight_only', 'silver_weight_plus_stone', 'legacy_mirror', 'manual_locked') THEN 'pricing_mode is not one of the four official modes'
      WHEN {_num('weight_grams')} <> '' AND w IS NULL THEN 'weight_grams must be a decimal number'
      WHEN w < 0 THEN 'weight_grams must be a non-negative decimal'
      {_bad_int('stone_value_toman')} {_bad_int('legacy_price_toman')} {_bad_int('manual_price_toman')} {_bad_int('stock')}
      WHEN pricing_mode LIKE 'silver_weight%' AND coalesce(w, 0) <= 0 THEN 'weight_grams must be positive for weight pricing modes'
      WHEN pricing_mode = 'silver_weight_plus_stone' AND stone_type = '' THEN 'stone_type is required for silver_weight_plus_stone'
      WHEN pricing_mode = 'silver_weight_plus_stone' AND coalesce(sv, 0) <= 0 THEN 'stone_value_toman must be positive for silver_weight_plus_stone'
      WHEN pricing_mode = 'legacy_mirror' AND coalesce(lp, 0) <= 0 THEN 'legacy_price_toman must be positive for legacy_mirror'
      WHEN pricing_mode = 'manual_locked' AND coalesce(mp, 0) <= 0 THEN 'manual_price_toman must be positive for manual_locked'
      WHEN len([x FOR x IN images IF NOT regexp_matches(x, '^[A-Za-z0-9][A-Za-z0-9._-]*\\.(jpe?g|png|webp)$')]) > 0 THEN '{M.IMAGE_MESSAGE}'
      WHEN len(list_distinct(images)) < len(images) THEN 'duplicate image filename' END AS late
  FROM typed),
claims AS (SELECT k, min(row_number) AS owner FROM ruled WHERE early IS NULL AND late IS NULL GROUP BY k),
rowwise AS (
  SELECT r.*, coalesce(early, CASE WHEN c.owner < r.row_number THEN concat('duplicate SKU in CSV: ', r.k) END, late) AS row_error
  FROM ruled r LEFT JOIN claims c ON r.k = c.k),
names AS (SELECT row_number, unnest(images) AS image, generate_subscripts(images, 1) AS pos FROM rowwise WHERE row_error IS NULL),
owners AS (SELECT image, min(row_number) AS owner FROM names GROUP BY image),
reused AS (SELECT n.row_number, string_agg(n.image, ', ' ORDER BY n.pos) AS again FROM names n JOIN owners o ON n.image = o.image AND o.owner < n.row_number GROUP BY 1),
validated AS (
  SELECT v.*, coalesce(row_error, concat('image filename(s) reused by another CSV row: ' || again)) AS error
  FROM rowwise v LEFT JOIN reused u ON v.row_number = u.row_number)
"""
_EMPTY_ERROR = "nullif(error, '') AS error"


def _validated(spark, folder):
    return M.validate_rows(V.view(spark, folder, V.IMPORT_FILE))


@query("import_validate", _VALIDATED + f"""
SELECT row_number, k AS sku, cat AS category, CAST(w AS DOUBLE) AS weight, pricing_mode AS mode,
  CASE WHEN {_num('stock')} = '' THEN 1 ELSE TRY_CAST(regexp_extract({_num('stock')}, '^[0-9]+$') AS BIGINT) END AS stock_level, {_EMPTY_ERROR} FROM validated""")
def import_validate(spark, folder):
    rows = _validated(spark, folder)
    return rows.select("row_number", "sku", "category", F.col("weight").cast("double").alias("weight"), "mode", "stock_level", "error")


@query("import_error_counts", _VALIDATED + """
SELECT regexp_replace(error, ': .*$', '') AS kind, count(*) AS n FROM validated WHERE nullif(error, '') IS NOT NULL GROUP BY 1""")
def import_error_counts(spark, folder):
    _, errors = M.batch_gate(_validated(spark, folder))
    return errors.groupBy(F.regexp_replace("error", ": .*$", "").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("import_gate", _VALIDATED + """
SELECT count(*) FILTER (nullif(error, '') IS NOT NULL) AS errors, CASE WHEN count(*) FILTER (nullif(error, '') IS NOT NULL) > 0 THEN 0 ELSE count(*) END AS accepted,
  coalesce(bool_or(pricing_mode LIKE 'silver_weight%'), false) AS needs_rate FROM validated""")
def import_gate(spark, folder):
    rows = _validated(spark, folder)
    accepted, errors = M.batch_gate(rows)
    return M.needs_rate(rows).select(
        errors.agg(F.count(F.lit(1))).scalar().alias("errors"), accepted.agg(F.count(F.lit(1))).scalar().alias("accepted"), "needs_rate"
    )


@query("import_prices", _VALIDATED + """
SELECT row_number, k AS sku, CAST(CASE pricing_mode
  WHEN 'silver_weight_only' THEN greatest(CAST(floor((w * 85000 + 5000) / 10000) AS BIGINT) * 10000, 10000)
  WHEN 'silver_weight_plus_stone' THEN CAST(floor(w * 85000 + sv + 0.5) AS BIGINT)
  WHEN 'legacy_mirror' THEN lp ELSE mp END AS BIGINT) AS price
FROM validated WHERE nullif(error, '') IS NULL""")
def import_prices(spark, folder):
    fine = _validated(spark, folder).filter(F.col("error").isNull())
    return M.price_rows(fine, V.rate(spark)).select("row_number", "sku", "price")


_STORE_SKUS = "SELECT p_partkey + 90000 AS product_id, concat('SKU-RNG-U-', CAST(p_partkey * 2 + 10000 AS STRING)) AS sku FROM {part}"


@query("import_actions", _VALIDATED + f""", known AS ({V.as_sql(_STORE_SKUS)})
SELECT v.row_number, v.k AS sku, k2.product_id AS existing_id, CASE WHEN k2.product_id IS NULL THEN 'CREATE' ELSE 'UPDATE' END AS action,
  CASE WHEN k2.product_id IS NULL THEN 'draft' ELSE 'preserve' END AS target_status
FROM validated v LEFT JOIN known k2 ON v.k = k2.sku WHERE nullif(v.error, '') IS NULL""")
def import_actions(spark, folder):
    fine = _validated(spark, folder).filter(F.col("error").isNull())
    acted = M.upsert_actions(fine, V.view(spark, folder, _STORE_SKUS))
    return acted.select("row_number", "sku", "existing_id", "action", "target_status")


@query("file_presence", _VALIDATED + f""", files AS (SELECT DISTINCT image FROM ({V.as_sql(V.FILES)})),
listed AS (SELECT row_number, unnest(images) AS image, generate_subscripts(images, 1) AS pos FROM typed)
SELECT l.row_number, coalesce(string_agg(l.image, '|' ORDER BY pos) FILTER (f.image IS NOT NULL), '') AS present_images,
  coalesce(string_agg(l.image, '|' ORDER BY pos) FILTER (f.image IS NULL), '') AS missing_images
FROM listed l LEFT JOIN files f ON l.image = f.image GROUP BY l.row_number""")
def file_presence(spark, folder):
    rows = V.view(spark, folder, V.IMPORT_FILE).select("row_number", M.image_list(F.col("image_filenames")).alias("images"))
    found = M.image_presence(rows, V.view(spark, folder, V.FILES))
    return found.select(
        "row_number", F.concat_ws("|", "present_images").alias("present_images"), F.concat_ws("|", "missing_images").alias("missing_images")
    )


_ATTACHED = """SELECT p_partkey AS attachment_id, concat('S', CAST(p_partkey % 400 AS STRING), '|img-', CAST(p_partkey AS STRING), '.jpg') AS import_key FROM {part} WHERE p_partkey % 2 = 0"""
_IMAGES = """SELECT concat('S', CAST(p_partkey % 400 AS STRING)) AS sku, concat('img-', CAST(p_partkey AS STRING), '.jpg') AS image FROM {part}"""


@query("attachment_lookup", f"""
WITH images AS ({V.as_sql(_IMAGES)}), attached AS ({V.as_sql(_ATTACHED)})
SELECT i.sku, i.image, a.attachment_id, CASE WHEN a.attachment_id IS NULL THEN 'CREATE' ELSE 'REUSE' END AS action
FROM images i LEFT JOIN attached a ON concat(i.sku, '|', i.image) = a.import_key""")
def attachment_lookup(spark, folder):
    return M.attachment_actions(V.view(spark, folder, _IMAGES), V.view(spark, folder, _ATTACHED)).select("sku", "image", "attachment_id", "action")


def store_keys(spark, folder):
    """Store products with their legacy id under one or two alias keys."""
    meta = F.create_map(F.lit("legacy_id"), F.col("plain_id"), F.lit("_legacy_store_id"), F.col("historic_id"))
    return V.view(spark, folder, V.STORE_KEYS).withColumn("meta", U.present_meta(meta)).drop("plain_id", "historic_id")


_ALIASES = f"""
WITH keys AS ({V.as_sql(V.STORE_KEYS)}),
ids AS (SELECT product_id, plain_id AS legacy_id FROM keys WHERE plain_id <> '' UNION SELECT product_id, historic_id FROM keys WHERE historic_id <> ''),
grouped AS (SELECT legacy_id, min(product_id) AS product_id, count(*) AS n FROM ids GROUP BY legacy_id)
"""


@query("alias_key_lookup", _ALIASES + "SELECT legacy_id, product_id FROM grouped WHERE n = 1")
def alias_key_lookup(spark, folder):
    return M.alias_lookup(M.alias_ids(store_keys(spark, folder)))[0]


@query("alias_key_clashes", _ALIASES + "SELECT legacy_id, n FROM grouped WHERE n > 1")
def alias_key_clashes(spark, folder):
    return M.alias_lookup(M.alias_ids(store_keys(spark, folder)))[1]


_DECIDED = _ALIASES + f""", records AS ({V.as_sql(V.RECORDS)}), skus AS (SELECT sku, min(product_id) AS product_id FROM keys GROUP BY sku)"""


_HELD = """, open_rows AS (SELECT *, row_number() OVER (PARTITION BY legacy_id ORDER BY row_no) AS a FROM records WHERE coalesce(action, '') NOT LIKE 'SKIP_%'),
turns AS (SELECT row_no, a, CASE WHEN a = 1 THEN row_number() OVER (PARTITION BY lower(sku), a = 1 ORDER BY row_no) END AS b FROM open_rows)
"""


@query("import_decisions", _DECIDED + _HELD + """
SELECT r.row_no, r.legacy_id, r.sku, CASE WHEN r.action LIKE 'SKIP_%' THEN r.action WHEN t.a > 1 THEN 'SKIP_DUPLICATE_BATCH_LEGACY_ID'
  WHEN t.b > 1 THEN 'SKIP_DUPLICATE_BATCH_SKU' WHEN g.product_id IS NOT NULL THEN 'SKIP_EXISTING_LEGACY_ID'
  WHEN s.product_id IS NOT NULL THEN 'SKIP_SKU_CONFLICT' ELSE 'CREATE_DRAFT' END AS decision,
  CASE WHEN r.action LIKE 'SKIP_%' OR t.a > 1 OR t.b > 1 THEN NULL WHEN g.product_id IS NOT NULL THEN g.product_id ELSE s.product_id END AS existing_product,
  CASE WHEN r.action LIKE 'SKIP_%' THEN '' WHEN t.a > 1 THEN 'DUPLICATE_BATCH_LEGACY_ID' WHEN t.b > 1 THEN 'DUPLICATE_BATCH_SKU'
    WHEN g.product_id IS NULL AND s.product_id IS NOT NULL THEN 'STORE_SKU_CONFLICT' ELSE '' END AS review_flags
FROM records r LEFT JOIN turns t ON r.row_no = t.row_no LEFT JOIN (SELECT * FROM grouped WHERE n = 1) g ON r.legacy_id = g.legacy_id LEFT JOIN skus s ON r.sku = s.sku""")
def import_decisions(spark, folder):
    by_id, _ = M.alias_lookup(M.alias_ids(store_keys(spark, folder)))
    records = V.view(spark, folder, V.RECORDS).withColumn("review_flags", F.array().cast("array<string>"))
    decided = M.import_decisions(records, by_id, store_keys(spark, folder).select("sku", "product_id"))
    return decided.select("row_no", "legacy_id", "sku", "decision", "existing_product", F.concat_ws("|", "review_flags").alias("review_flags"))


@query("import_blockers", _DECIDED + """, wanted AS (
  SELECT *, row_number() OVER (PARTITION BY legacy_id ORDER BY row_no) AS a, row_number() OVER (PARTITION BY lower(sku) ORDER BY row_no) AS b
  FROM records WHERE import_action = 'CREATE_DRAFT')
SELECT w.row_no, w.legacy_id, w.sku, CASE WHEN a > 1 THEN 'STOP_DUPLICATE_LEGACY_ID' WHEN b > 1 THEN 'STOP_DUPLICATE_SKU' ELSE 'STOP_SKU_CONFLICT' END AS decision,
  coalesce(g.product_id, s.product_id) AS existing_product
FROM wanted w LEFT JOIN (SELECT * FROM grouped WHERE n = 1) g ON w.legacy_id = g.legacy_id LEFT JOIN skus s ON w.sku = s.sku
WHERE a > 1 OR b > 1 OR (g.product_id IS NULL AND s.product_id IS NOT NULL)""")
def import_blockers(spark, folder):
    by_id, _ = M.alias_lookup(M.alias_ids(store_keys(spark, folder)))
    _, blockers = M.stop_all_decisions(V.view(spark, folder, V.RECORDS), by_id, store_keys(spark, folder).select("sku", "product_id"))
    return blockers


@query("stop_all_decisions", _DECIDED + """, fine AS (SELECT * FROM records WHERE import_action IS NULL OR import_action <> 'CREATE_DRAFT' OR row_no % 2 = 0),
fresh AS (SELECT min(row_no) AS row_no FROM fine WHERE import_action = 'CREATE_DRAFT' GROUP BY legacy_id),
apart AS (SELECT f.* FROM fine f WHERE import_action IS NULL OR import_action <> 'CREATE_DRAFT' OR row_no IN (SELECT row_no FROM fresh))
SELECT f.row_no, f.legacy_id, concat('N-', CAST(f.row_no AS VARCHAR)) AS sku, CASE WHEN import_action = 'CREATE_DRAFT' AND g.product_id IS NOT NULL THEN 'SKIP_EXISTING_LEGACY_ID'
  ELSE import_action END AS decision, CASE WHEN import_action = 'CREATE_DRAFT' THEN g.product_id END AS existing_product
FROM apart f LEFT JOIN (SELECT * FROM grouped WHERE n = 1) g ON f.legacy_id = g.legacy_id""")
def stop_all_decisions(spark, folder):
    """A batch without repeats or conflicts, so every decision comes through."""
    by_id, _ = M.alias_lookup(M.alias_ids(store_keys(spark, folder)))
    records = V.view(spark, folder, V.RECORDS)
    create = F.col("import_action") == "CREATE_DRAFT"
    fine = records.filter(~F.coalesce(create, F.lit(False)) | (F.col("row_no") % 2 == 0))
    fresh = fine.filter(create).groupBy("legacy_id").agg(F.min("row_no").alias("row_no")).select("row_no")
    apart = fine.filter(create).join(fresh, "row_no", "left_semi").unionByName(fine.filter(~F.coalesce(create, F.lit(False))))
    apart = apart.withColumn("sku", F.concat(F.lit("N-"), F.col("row_no").cast("string"))).withColumns(
        {"image_qa_run": F.lit(True), "selected_media": F.lit(1), "final_price": F.lit(1000)}
    )
    return M.stop_all_decisions(apart, by_id, store_keys(spark, folder).select("sku", "product_id"))[0]


@query("create_only_rows", _DECIDED + """
SELECT r.row_no, r.legacy_id, r.sku FROM records r
WHERE NOT EXISTS (SELECT 1 FROM ids i WHERE i.legacy_id = r.legacy_id) AND NOT EXISTS (SELECT 1 FROM keys k WHERE k.sku = r.sku)""")
def create_only_rows(spark, folder):
    store = store_keys(spark, folder)
    return U.create_only(V.view(spark, folder, V.RECORDS), M.alias_ids(store), store).select("row_no", "legacy_id", "sku")


_CATEGORY_DIM = """SELECT DISTINCT CASE s_suppkey % 3 WHEN 0 THEN 'rings' WHEN 1 THEN 'necklaces' ELSE 'bracelets' END AS slug,
  CASE s_suppkey % 3 WHEN 0 THEN 17 WHEN 1 THEN 18 ELSE 99 END AS category_id FROM {supplier}"""
_CATEGORY_ROWS = """SELECT p_partkey AS row_number, CASE p_size % 4 WHEN 0 THEN 'rings' WHEN 1 THEN 'necklaces' WHEN 2 THEN 'bracelets' ELSE 'sets' END AS category FROM {part}"""
_CATEGORY_JOIN = f"""WITH rows AS ({V.as_sql(_CATEGORY_ROWS)}), dim AS ({V.as_sql(_CATEGORY_DIM)}),
joined AS (SELECT r.*, CAST(d.category_id AS INT) AS category_id FROM rows r LEFT JOIN dim d ON r.category = d.slug)"""


@query("category_lookup", _CATEGORY_JOIN + " SELECT * FROM joined")
def category_lookup(spark, folder):
    return M.resolve_categories(V.view(spark, folder, _CATEGORY_ROWS), V.view(spark, folder, _CATEGORY_DIM))[0]


@query("category_violations", _CATEGORY_JOIN + """ SELECT category, category_id, count(*) AS n FROM joined
WHERE category_id IS NULL OR category_id <> CASE category WHEN 'rings' THEN 17 WHEN 'necklaces' THEN 18 ELSE 19 END GROUP BY 1, 2""")
def category_violations(spark, folder):
    return M.resolve_categories(V.view(spark, folder, _CATEGORY_ROWS), V.view(spark, folder, _CATEGORY_DIM))[1]
