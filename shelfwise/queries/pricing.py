"""Safe prices, prepared products, identities and media gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import classify as C, identity as I, media as G, pricing as R, text as T
from shelfwise.operators import media as M, prepared as Q
from shelfwise.operators.staging import computed
from shelfwise.queries import views as V
from shelfwise.registry import query, table

_DIGITS, _PLAIN = "۰۱۲۳۴۵۶۷۸۹٫٬, ", "0123456789."
_SAFE = f"""
WITH raw AS ({V.as_sql(V.SAFE)}),
typed AS (
  SELECT *, lower(trim(category)) AS cat, lower(coalesce(nullif(stone_class, ''), 'uncertain')) AS stone,
    least(1.0, greatest(0.0, coalesce(TRY_CAST(confidence AS DOUBLE), 0.0))) AS conf,
    TRY_CAST(translate(weight, '{_DIGITS}', '{_PLAIN}') AS DECIMAL(12,4)) AS w0,
    TRY_CAST(regexp_extract(replace(translate(legacy_price, '{_DIGITS}', '{_PLAIN}'), 'تومان', ''), '^[0-9]+$') AS BIGINT) AS l0
  FROM raw),
ranged AS (
  SELECT *, CASE WHEN w0 > 0 AND w0 <= 500 THEN w0 END AS w, CASE WHEN l0 BETWEEN 50000 AND 10000000000 THEN l0 END AS l,
    CASE WHEN cat NOT IN ('rings', 'necklaces', 'bracelets') THEN '{R.WARN_CATEGORY}'
      WHEN cat = 'rings' AND stone = 'large_stone' AND conf < 0.85 THEN '{R.WARN_CONFIDENCE}'
      WHEN cat = 'rings' AND stone NOT IN ('large_stone', 'no_stone', 'small_stone') THEN '{R.WARN_SIZE}' END AS rw
  FROM typed),
rated AS (SELECT *, CASE WHEN cat = 'rings' AND stone = 'large_stone' AND conf >= 0.85 THEN 590000 ELSE 650000 END AS rate FROM ranged),
calc AS (SELECT *, CAST(w * rate AS DOUBLE) AS c FROM rated),
priced AS (
  SELECT id, CASE WHEN rw IS NOT NULL THEN 'uncertain' WHEN cat <> 'rings' THEN 'not_applicable' ELSE stone END AS effective_class, rate, l AS legacy_price,
    CAST(ceil(c) AS BIGINT) AS calculated_price, CAST(ceil(greatest(coalesce(l, 0), coalesce(c, 0)) / 50000) AS BIGINT) * 50000 AS f,
    CASE WHEN l IS NULL AND c IS NULL THEN 'INVALID_DATA_REVIEW' WHEN l IS NULL THEN 'LEGACY_MISSING_USED_CALCULATED'
      WHEN c IS NULL THEN 'WEIGHT_MISSING_USED_LEGACY_REVIEW' WHEN l > c THEN 'LEGACY_PRICE_HIGHER' WHEN c > l THEN 'CALCULATED_FLOOR_HIGHER' ELSE 'EQUAL' END AS reason,
    concat_ws('|', rw, CASE WHEN weight <> '' AND w IS NULL THEN '{R.WARN_WEIGHT}' END, CASE WHEN legacy_price <> '' AND l IS NULL THEN '{R.WARN_PRICE}' END,
      CASE WHEN l IS NULL AND c IS NOT NULL THEN '{R.WARN_NO_PRICE}' WHEN l IS NOT NULL AND c IS NULL THEN '{R.WARN_NO_WEIGHT}' WHEN l IS NULL THEN '{R.WARN_NOTHING}' END) AS warnings
  FROM calc)
"""


def _safe(spark, folder):
    return Q.with_safe_price(V.view(spark, folder, V.SAFE), "category", "stone_class", "confidence", "weight", "legacy_price")


@query("safe_price", _SAFE + """
SELECT id, effective_class, CAST(rate AS BIGINT) AS rate, legacy_price, calculated_price, CASE WHEN reason <> 'INVALID_DATA_REVIEW' THEN f END AS final_price,
  reason, warnings, warnings <> '' AS review FROM priced""")
def safe_price(spark, folder):
    p = _safe(spark, folder).select("id", "price.*")
    return p.select(
        "id", "effective_class", "rate", "legacy_price", "calculated_price", "final_price", "reason", F.concat_ws("|", "warnings").alias("warnings"), "review"
    )


@query("price_gap_flags", _SAFE + f"""
SELECT flag, count(*) AS n FROM (SELECT CASE WHEN abs(legacy_price - calculated_price) * 100 >= greatest(1, least(legacy_price, calculated_price)) * 30
  THEN CASE WHEN legacy_price > calculated_price THEN '{R.FLAG_ABOVE}' ELSE '{R.FLAG_BELOW}' END END AS flag
  FROM priced WHERE legacy_price IS NOT NULL AND calculated_price IS NOT NULL) GROUP BY flag""")
def price_gap_flags(spark, folder):
    p = _safe(spark, folder).filter("price.legacy_price is not null and price.calculated_price is not null")
    return p.groupBy(R.difference_flag(F.col("price.legacy_price"), F.col("price.calculated_price")).alias("flag")).agg(F.count(F.lit(1)).alias("n"))


_TITLES = """SELECT p_partkey AS id, concat(p_name, ' ', CASE p_size % 10 WHEN 0 THEN 'بدون نگین' WHEN 1 THEN 'با نگین درشت' WHEN 2 THEN 'نگین ریز'
  WHEN 3 THEN 'عقيق بزرگ' WHEN 4 THEN 'سنگ' WHEN 5 THEN 'agate' WHEN 6 THEN 'بی نگین و سنگ درشت' WHEN 7 THEN 'نگین کاری ظریف' ELSE 'ساده' END) AS title FROM {part}"""


def _first(text: str, patterns: tuple[str, ...]) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({text}, '{p}') THEN '{p}'" for p in patterns) + " END"


@query("stone_text_classes", f"""WITH t AS ({V.as_sql(_TITLES)}), n AS (SELECT id, translate(lower(title), 'يك', 'یک') AS t FROM t),
h AS (SELECT *, regexp_matches(t, '(بدون|فاقد|بی) *(نگین|سنگ)') AS a,
  regexp_matches(t, '(نگین|سنگ) *(بسیار *)?(درشت|بزرگ)|(درشت|بزرگ) *(نگین|سنگ)|(فیروزه|عقیق|اونیکس|یاقوت|زمرد) *(درشت|بزرگ)') AS b,
  regexp_matches(t, '(نگین|سنگ) *(ریز|کوچک)|(ریز|کوچک) *(نگین|سنگ)|نگین *کاری *(ریز|ظریف)') AS c,
  regexp_matches(t, 'نگین|سنگ|فیروزه|عقیق|اونیکس|یاقوت|زمرد|agate|turquoise|onyx|gem') AS g FROM n)
SELECT id, CASE WHEN CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) > 1 THEN 'uncertain' WHEN a THEN 'no_stone' WHEN b THEN 'large_stone' WHEN c THEN 'small_stone' WHEN g THEN 'uncertain' END AS stone_class,
  CASE WHEN CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) > 1 THEN 0.25 WHEN a THEN 0.98 WHEN b THEN 0.92 WHEN c THEN 0.94 WHEN g THEN 0.55 END::DOUBLE AS confidence,
  CASE WHEN CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) > 1
      THEN concat_ws(' | ', 'matched no_stone: ' || {_first("t", C.NO_STONE)}, 'matched large_stone: ' || {_first("t", C.LARGE_STONE)}, 'matched small_stone: ' || {_first("t", C.SMALL_STONE)})
    WHEN a OR b OR c THEN concat('matched explicit text pattern: ', coalesce({_first("t", C.NO_STONE)}, {_first("t", C.LARGE_STONE)}, {_first("t", C.SMALL_STONE)}))
    WHEN g THEN 'text mentions a stone but does not establish size' END AS evidence FROM h""")
def stone_text_classes(spark, folder):
    verdict = V.view(spark, folder, _TITLES).withColumn("v", C.classify_text(F.col("title")))
    evidence = F.when(F.col("v").isNotNull(), F.concat_ws(" | ", "v.evidence"))
    return verdict.select("id", F.col("v.stone_class").alias("stone_class"), F.col("v.confidence").alias("confidence"), evidence.alias("evidence"))


_PREPARE = f"""SELECT p_partkey AS id, CASE WHEN p_partkey % 31 = 0 THEN '' ELSE CAST(p_partkey AS STRING) END AS legacy_id, CAST(p_partkey % 900 AS STRING) AS code,
  CASE WHEN p_partkey % 37 = 0 THEN '' ELSE concat('S', CAST(p_partkey AS STRING)) END AS sku, CASE p_partkey % 4 WHEN 0 THEN 'Rings' WHEN 1 THEN 'necklaces' WHEN 2 THEN 'rings' ELSE 'watches' END AS category,
  CASE p_partkey % 3 WHEN 0 THEN 'انگشتر بدون نگین' WHEN 1 THEN 'انگشتر ساده' ELSE 'نگین' END AS title, p_name AS description, '' AS short_description,
  CASE WHEN p_partkey % 7 = 0 THEN '' ELSE CAST(p_size AS STRING) END AS weight_text, CASE WHEN p_partkey % 9 = 0 THEN '' ELSE CAST(p_partkey * 500 + 60000 AS STRING) END AS legacy_price_text,
  p_partkey % 5 AS images, CASE WHEN p_partkey % 41 = 0 THEN 1 ELSE 0 END AS missing_images, 3 AS readable_views, p_partkey % 4 AS qualifying_views,
  CASE WHEN p_partkey % 2 = 0 THEN 'PASS' ELSE 'FAIL' END AS qa_status FROM {{part}}"""


@query("prepared_products", f"""WITH p AS ({V.as_sql(_PREPARE)}),
s AS (SELECT *, lower(category) = 'rings' AS ring, contains(title, 'بدون نگین') AS none, contains(title, 'نگین') AS mention,
  images > 0 AND qualifying_views >= 2 AND qualifying_views * 100 >= 198 AS vote FROM p),
c AS (SELECT *, CASE WHEN NOT ring THEN 'uncertain' WHEN none THEN 'no_stone' WHEN mention THEN 'uncertain' WHEN vote THEN 'large_stone' ELSE 'uncertain' END AS stone_class,
  CASE WHEN NOT ring THEN 'not_applicable' WHEN none THEN 'text' WHEN mention THEN 'text_generic' WHEN images > 0 THEN 'multi_image_heuristic' ELSE 'insufficient_evidence' END AS stone_source,
  TRY_CAST(nullif(weight_text, '') AS BIGINT) AS w, TRY_CAST(nullif(legacy_price_text, '') AS BIGINT) AS l FROM s),
f AS (SELECT *, CASE WHEN w IS NULL AND l IS NULL THEN NULL
  ELSE CAST(ceil(greatest(coalesce(l, 0), coalesce(w * CASE WHEN ring AND stone_class = 'large_stone' THEN 590000 ELSE 650000 END, 0)) / 50000) AS BIGINT) * 50000 END AS final_price FROM c)
SELECT id, stone_class, stone_source, final_price, p_desc AS short_description,
  CASE WHEN final_price IS NULL OR lower(category) = 'watches' OR legacy_id = '' OR sku = '' OR images = 0 OR missing_images > 0 THEN 'SKIP_INVALID_REVIEW' ELSE 'CREATE_DRAFT' END AS import_action,
  CASE WHEN qa_status = 'PASS' THEN 'OPTIMIZED_OUTPUT_APPROVED' ELSE 'UNTOUCHED_ORIGINAL_FALLBACK' END AS image_action
FROM (SELECT *, description AS p_desc FROM f)""")
def prepared_products(spark, folder):
    return _prepared(spark, folder).select(
        "id", F.col("stone.stone_class").alias("stone_class"), F.col("stone.source").alias("stone_source"),
        F.col("price.final_price").alias("final_price"), "short_description", "import_action", "image_action",
    )


_PREPARED = f"""WITH p AS ({V.as_sql(_PREPARE)}),
s AS (SELECT *, lower(category) AS cat, lower(category) = 'rings' AS ring, contains(title, 'بدون نگین') AS none, contains(title, 'نگین') AS mention,
  qualifying_views >= 2 AND qualifying_views * 100 >= readable_views * 66 AS vote, qa_status <> 'PASS' AS refused,
  TRY_CAST(nullif(weight_text, '') AS BIGINT) AS w, TRY_CAST(nullif(legacy_price_text, '') AS BIGINT) AS l FROM p),
c AS (SELECT *, CASE WHEN NOT ring THEN 'not_applicable' WHEN none THEN 'text' WHEN mention THEN 'text_generic' WHEN images > 0 THEN 'multi_image_heuristic' ELSE 'insufficient_evidence' END AS how FROM s),
k AS (SELECT *, CASE WHEN how = 'text' THEN 'no_stone' WHEN how = 'multi_image_heuristic' AND vote THEN 'large_stone' ELSE 'uncertain' END AS stone FROM c),
r AS (SELECT *, CASE WHEN ring AND stone = 'large_stone' THEN 590000 ELSE 650000 END AS rate FROM k),
m AS (SELECT *, w * rate AS raw, greatest(l, w * rate) AS chosen FROM r),
x AS (SELECT *, CAST(ceil(chosen / 50000.0) AS BIGINT) * 50000 AS final,
  CASE WHEN chosen IS NULL OR cat = 'watches' OR legacy_id = '' OR sku = '' OR images = 0 OR missing_images > 0 THEN 'SKIP_INVALID_REVIEW' ELSE 'CREATE_DRAFT' END AS action,
  concat_ws(' | ',
    CASE WHEN how = 'text_generic' THEN 'text mentions a stone but does not establish size' WHEN how = 'multi_image_heuristic' AND NOT vote THEN '{Q.IMAGES_UNCLEAR}'
      WHEN how = 'insufficient_evidence' THEN 'no explicit text or readable image evidence' END,
    CASE WHEN cat = 'watches' THEN '{R.WARN_CATEGORY}' WHEN ring AND stone = 'uncertain' THEN '{R.WARN_SIZE}' END,
    CASE WHEN l IS NULL AND raw IS NOT NULL THEN '{R.WARN_NO_PRICE}' WHEN l IS NOT NULL AND raw IS NULL THEN '{R.WARN_NO_WEIGHT}' WHEN l IS NULL THEN '{R.WARN_NOTHING}' END,
    CASE WHEN abs(l - raw) * 100 >= greatest(1, least(l, raw)) * 30 AND l IS NOT NULL AND raw IS NOT NULL THEN CASE WHEN l > raw THEN '{R.FLAG_ABOVE}' ELSE '{R.FLAG_BELOW}' END END,
    CASE WHEN cat = 'watches' THEN 'unsupported category' END, CASE WHEN chosen IS NULL THEN 'no safe final price' END, CASE WHEN images = 0 THEN 'no archived original images' END,
    CASE WHEN missing_images > 0 THEN 'archived original image missing' END, CASE WHEN refused THEN 'optimized media rejected; original selected' END) AS reasons FROM m)
"""


def _prepared(spark, folder):
    rows = V.view(spark, folder, _PREPARE).withColumn("review_reasons", F.array().cast("array<string>"))
    return Q.prepare(rows, qa_run=True)


@query("prepared_summary", _PREPARED + """SELECT count(*) AS rows, count(*) FILTER (reasons <> '') AS needing_review,
  count(*) FILTER (refused) AS fallbacks, count(*) FILTER (action = 'CREATE_DRAFT') AS creatable FROM x""")
def prepared_summary(spark, folder):
    return Q.report_summary(_prepared(spark, folder))


_LINE = {
    "legacy_id": "legacy_id", "legacy_code_raw": "''", "legacy_code": "code", "sku": "sku", "product_url": "''", "title": "title", "category": "cat", "weight_grams": "w",
    "legacy_price_toman": "l", "stone_class": "stone", "stone_confidence": """CASE how WHEN 'not_applicable' THEN '1.0' WHEN 'text' THEN '0.98' WHEN 'text_generic' THEN '0.55'
      WHEN 'insufficient_evidence' THEN '0.0' ELSE CASE WHEN NOT vote THEN '0.3' WHEN qualifying_views = 2 THEN '0.85' ELSE '0.87' END END""",
    "stone_source": "how", "rate_toman_per_gram": "rate", "calculated_price_toman": "raw", "selected_pre_round_toman": "chosen", "final_price_toman": "final",
    "selection_reason": """CASE WHEN chosen IS NULL THEN 'INVALID_DATA_REVIEW' WHEN l IS NULL THEN 'LEGACY_MISSING_USED_CALCULATED' WHEN raw IS NULL THEN 'WEIGHT_MISSING_USED_LEGACY_REVIEW'
      WHEN l > raw THEN 'LEGACY_PRICE_HIGHER' WHEN raw > l THEN 'CALCULATED_FLOOR_HIGHER' ELSE 'EQUAL' END""",
    "image_qa_status": "qa_status", "optimized_featured_approved": "'False'", "image_integrity_action": "CASE WHEN refused THEN 'UNTOUCHED_ORIGINAL_FALLBACK' ELSE 'OPTIMIZED_OUTPUT_APPROVED' END",
    "conflict": "''", "requires_review": "CASE WHEN reasons <> '' THEN 'True' ELSE 'False' END", "review_reasons": "reasons", "import_action": "action",
    "wordpress_product_id": "''", "attachment_ids": "''",
}


@query("prepared_report", _PREPARED + "SELECT id, " + ", ".join(f"coalesce(CAST({shown} AS VARCHAR), '') AS {name}" for name, shown in _LINE.items()) + " FROM x")
def prepared_report(spark, folder):
    lines = Q.report(_prepared(spark, folder), (("id", "id", ""), *Q.PREPARED_REPORT))
    return lines.withColumn("id", F.col("id").cast("bigint"))


_CODES = """SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN concat('AB-', CAST(p_partkey AS STRING), '.7') WHEN 1 THEN concat(' ', CAST(p_partkey AS STRING), ' ')
  WHEN 2 THEN translate(CAST(p_partkey AS STRING), '0123456789', '۰۱۲۳۴۵۶۷۸۹') WHEN 3 THEN concat('کد ویژه/', p_name) WHEN 4 THEN '' ELSE concat('[', p_name, ']') END AS code FROM {part}"""


@query("code_to_sku", f"""WITH c AS ({V.as_sql(_CODES)}), n AS (SELECT id, trim(code) AS raw, trim(trim(translate(code, '۰۱۲۳۴۵۶۷۸۹', '0123456789')), '.:：،,؛;#()[]{{}}') AS tok FROM c),
r AS (SELECT *, CASE WHEN raw = '' THEN 'MISSING_CODE' WHEN regexp_full_match(raw, '[A-Za-z0-9][A-Za-z0-9._-]{{0,99}}') THEN 'EXACT_LEGACY_CODE'
  WHEN regexp_full_match(tok, '[A-Za-z0-9][A-Za-z0-9._-]{{0,99}}') THEN 'DIGIT_OR_CHARACTER_NORMALIZATION' ELSE 'DETERMINISTIC_SAFE_SKU' END AS reason,
  trim(regexp_replace(tok, '[^A-Za-z0-9._-]+', '-', 'g'), '-._') AS base, upper(substring(sha256(raw), 1, 10)) AS digest FROM n)
SELECT id, reason, CASE reason WHEN 'EXACT_LEGACY_CODE' THEN raw WHEN 'DIGIT_OR_CHARACTER_NORMALIZATION' THEN tok
  WHEN 'DETERMINISTIC_SAFE_SKU' THEN concat_ws('-', 'LEGACY', nullif(substring(base, 1, 70), ''), digest) END AS sku FROM r""")
def code_to_sku(spark, folder):
    coded = V.view(spark, folder, _CODES).withColumn("i", I.code_to_sku(F.col("code")))
    return coded.select("id", F.col("i.reason").alias("reason"), F.col("i.sku").alias("sku"))


@query("encoded_codes", f"""WITH c AS ({V.as_sql(_CODES)}) SELECT id, to_base64(encode(code)) AS encoded, to_base64(encode(repeat(code, 20))) AS encoded_long FROM c""")
def encoded_codes(spark, folder):
    codes = V.view(spark, folder, _CODES)
    return codes.select("id", I.base64_text(F.col("code")).alias("encoded"), I.base64_text(F.repeat("code", 20)).alias("encoded_long"))


@query("amount_texts", """
SELECT o_orderkey AS id, translate(format('{:,}', CAST(floor(o_totalprice) AS BIGINT) - 200000), '0123456789', '۰۱۲۳۴۵۶۷۸۹') AS toman FROM orders""")
def amount_texts(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", F.col("o_orderkey").alias("id"), T.toman_text(F.floor("o_totalprice") - 200_000).alias("toman")).drop("o_orderkey")


@query("media_vote", """
WITH l AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(abs(CAST(x AS DOUBLE)) * 1000) AS BIGINT)) AS levels FROM embeddings),
t AS (SELECT *, len(levels) AS n, CAST(list_sum(levels) AS BIGINT) AS total FROM l),
v AS (SELECT vec_id // 5 AS product_id, vec_id % 7 <> 0 AS readable, CAST(len(list_filter(levels, lambda x: x * n > 2 * total)) AS DOUBLE) / n AS share,
  CAST(list_max(levels) * n AS DOUBLE) / total AS concentration FROM t),
n AS (SELECT product_id, count(*) AS views, count(*) FILTER (readable) AS readable, count(*) FILTER (readable AND share BETWEEN 0.008 AND 0.12 AND concentration >= 1.8) AS qualifying FROM v GROUP BY product_id),
a AS (SELECT *, readable >= 2 AND qualifying >= 2 AND qualifying * 100 >= readable * 66 AS agreed FROM n)
SELECT product_id, views, readable, qualifying, CASE WHEN agreed THEN 'large_stone' ELSE 'uncertain' END AS stone_class,
  CASE WHEN agreed THEN least(0.89, round(0.85 + 0.02 * (qualifying - 2), 2)) WHEN readable > 0 THEN 0.3 ELSE 0.0 END::DOUBLE AS confidence, 'multi_image_heuristic' AS source, NOT agreed AS review, concat(qualifying, ' of ', readable, ' readable views qualify') AS evidence FROM a""")
def media_vote(spark, folder):
    levels = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1000))
    rows = computed(table(spark, folder, "embeddings").select("vec_id", "embedding"), levels=levels, n=F.size("embedding"))
    summed = computed(rows, total=F.aggregate("levels", F.lit(0).cast("bigint"), lambda acc, x: acc + x))
    strong = F.size(F.filter("levels", lambda x: x * F.col("n") > 2 * F.col("total")))
    views = summed.select(
        F.expr("vec_id div 5").alias("product_id"),
        (F.col("vec_id") % 7 != 0).alias("readable"),
        (strong.cast("double") / F.col("n")).alias("share"),
        ((F.array_max("levels") * F.col("n")).cast("double") / F.col("total")).alias("concentration"),
    )
    return M.view_votes(views).withColumn("evidence", F.concat_ws("|", "evidence"))


_METRICS = """SELECT l_orderkey AS product_id, l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey AS position, CAST(l_partkey AS STRING) AS original_path, concat('w', CAST(l_partkey AS STRING)) AS processed_path,
  l_discount * 65 AS mean_drift, l_tax * 260 AS p95_drift, l_discount * 31 AS channel_drift, 0.7 + l_tax * 8 AS detail_ratio, l_quantity <> 7 AS same_size,
  l_returnflag = 'R' AND l_quantity > 45 AS icc_lost, l_quantity = 9 AS alpha_lost, false AS checksum_changed FROM {lineitem}"""
_GATED = f"""WITH m AS ({V.as_sql(_METRICS)}), g AS (SELECT *, concat_ws('|', CASE WHEN NOT same_size THEN 'dimension mismatch' END, CASE WHEN mean_drift > 6 THEN 'mean color drift exceeds gate' END,
  CASE WHEN p95_drift > 20 THEN 'p95 color drift exceeds gate' END, CASE WHEN channel_drift > 3 THEN 'channel color drift exceeds gate' END,
  CASE WHEN NOT detail_ratio BETWEEN 0.72 AND 1.30 THEN 'detail retention ratio exceeds gate' END, CASE WHEN icc_lost THEN 'embedded ICC profile was not retained' END,
  CASE WHEN alpha_lost THEN 'alpha channel was not retained' END) AS reasons FROM m)"""


@query("media_gate", _GATED + """ SELECT product_id, position, CASE WHEN reasons = '' THEN 'PASS' ELSE 'FAIL' END AS status, reasons,
CASE WHEN reasons = '' THEN processed_path ELSE original_path END AS import_path FROM g""")
def media_gate(spark, folder):
    return M.image_verdicts(V.view(spark, folder, _METRICS)).withColumn("reasons", F.concat_ws("|", "reasons")).drop("fallback_to_original")


@query("media_rollup", _GATED + """ SELECT product_id, count(*) AS images, CASE WHEN count(*) FILTER (reasons <> '') = 0 THEN 'PASS' ELSE 'FAIL' END AS qa_status,
arg_min(reasons = '', position) AS featured_approved, count(*) FILTER (reasons <> '') AS fallbacks FROM g GROUP BY product_id""")
def media_rollup(spark, folder):
    return M.media_rollup(M.image_verdicts(V.view(spark, folder, _METRICS)))


@query("histogram_p95", """
WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
h AS (SELECT doc_id, least(length(word), 255) AS level, count(*) AS c FROM w GROUP BY doc_id, level),
r AS (SELECT doc_id, level, sum(c) OVER (PARTITION BY doc_id ORDER BY level) AS running, sum(c) OVER (PARTITION BY doc_id) AS total FROM h)
SELECT doc_id, CAST(min(level) AS DOUBLE) AS p95 FROM r WHERE running >= CAST(total AS DOUBLE) * 0.95::DOUBLE GROUP BY doc_id""")
def histogram_p95(spark, folder):
    """The length below which 95 % of a document's words lie; the channels are words by their first letter's code."""
    words = table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("word"))
    bins = F.least(F.char_length("word"), F.lit(255)) + 256 * (F.ascii("word") % 3)
    counts = words.groupBy("doc_id", bins.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("bin", "n"))).alias("found"))
    none = F.lit(0).cast("bigint")
    before = F.concat(F.array(F.lit(-1)), F.col("found.bin"))
    filled = F.transform("found", lambda x, i: F.concat(F.array_repeat(none, x["bin"] - F.get(before, i) - 1), F.array(x["n"])))
    levels = F.concat(F.flatten(filled), F.array_repeat(none, 767 - F.element_at("found.bin", -1)))
    rows = computed(found, histogram=levels)
    return M.histogram_percentile(rows, "histogram", 0.95, "p95").select("doc_id", "p95")


_MASKS = """SELECT p_partkey AS id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_partkey % 40 END AS lft, p_partkey % 30 AS top, 60 + p_partkey % 140 AS rgt, 40 + p_partkey % 160 AS bottom,
  200 AS width, 200 AS height, (p_partkey * 97) % 40001 AS nonzero, (p_partkey * 53) % 20001 AS soft_px FROM {part}"""


@query("mask_gate", f"""WITH m AS ({V.as_sql(_MASKS)}), w AS (SELECT *, nonzero / 40000.0 < 0.005 OR nonzero / 40000.0 > 0.98 AS bad,
  lft <= 2 OR top <= 2 OR rgt >= 198 OR bottom >= 198 AS touches, CASE WHEN nonzero > 0 THEN CAST(soft_px AS DOUBLE) / nonzero ELSE 0 END > 0.35 AS soft, rgt - lft < 24 OR bottom - top < 24 AS small FROM m)
SELECT id, CASE WHEN lft IS NULL OR bad THEN 'REJECT' WHEN touches OR soft OR small THEN 'REVIEW' ELSE 'PASS' END AS status,
  CASE WHEN lft IS NULL THEN 1 ELSE CAST(touches AS INT) + CAST(soft AS INT) + CAST(small AS INT) + CAST(bad AS INT) END AS warnings FROM w""")
def mask_gate(spark, folder):
    gate = G.mask_gate(*[F.col(c) for c in ("lft", "top", "rgt", "bottom", "width", "height", "nonzero", "soft_px")])
    masks = V.view(spark, folder, _MASKS).withColumn("g", gate)
    return masks.select("id", F.col("g.status").alias("status"), F.size("g.warnings").alias("warnings"))


@query("resize_plan", """
WITH d AS (SELECT p_partkey AS id, p_partkey * 3 + 1 AS w, p_size * 100 + 1 AS h FROM part), s AS (SELECT *, least(1.0::DOUBLE, 1600.0::DOUBLE / greatest(w, h)) AS scale FROM d)
SELECT id, CAST(greatest(1, round_even(w * scale, 0)) AS INT) AS width, CAST(greatest(1, round_even(h * scale, 0)) AS INT) AS height FROM s""")
def resize_plan(spark, folder):
    sizes = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 3 + 1).alias("w"), (F.col("p_size") * 100 + 1).alias("h"))
    planned = sizes.withColumn("r", G.resize_plan(F.col("w"), F.col("h")))
    return planned.select("id", F.col("r.width").alias("width"), F.col("r.height").alias("height"))
