"""Catalog profile, pricing plan and newest-N selection over the derived sheet."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import constants as K
from shelfwise.operators import profile as P, selection as S
from shelfwise.operators.staging import computed
from shelfwise.queries import views as V
from shelfwise.registry import query

_FROM = "۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩يك‌"
_TO = "01234567890123456789یک "


def norm(cell: str) -> str:
    """Checking SQL of the collapsed normal form."""
    return f"trim(regexp_replace(translate(coalesce({cell}, ''), '{_FROM}', '{_TO}'), '[ \\t\\r\\n]+', ' ', 'g'))"


def number(cell: str, comma: bool = False) -> str:
    text = f"translate(replace(replace(replace(lower({norm(cell)}), 'تومان', ''), 'ریال', ''), 'گرم', ''), '٫٬ ', '.')"
    if comma:
        text = f"regexp_replace({text}, '^([-+]?[0-9]+),([0-9]{{1,3}})$', '\\1.\\2')"
    return f"TRY_CAST(regexp_extract(replace({text}, ',', ''), '[-+]?[0-9]+(\\.[0-9]+)?') AS DECIMAL(38,10))"


_ROWS = f"""
WITH sheet AS ({V.as_sql(V.SHEET)}),
cells AS (
  SELECT *, {number('id_cell')} AS idn, {number('price_cell')} AS pn, {number('weight_cell', True)} AS wn,
    {number('availability_cell')} AS an, {number('active_cell')} AS cn, {number('stock_cell')} AS sn,
    {number('pre_discount_cell')} AS dn, lower({norm('availability_cell')}) AS aw, lower({norm('active_cell')}) AS cw,
    {norm('weight_cell')} AS wt
  FROM sheet),
parsed AS (
  SELECT *,
    CASE WHEN idn > 0 AND idn = floor(idn) THEN CAST(idn AS BIGINT) END AS legacy_id,
    CASE WHEN an = 1 OR aw = 'موجود' THEN 'موجود' WHEN an = 0 OR aw = 'ناموجود' THEN 'ناموجود'
      WHEN aw = '' THEN 'نامشخص' ELSE aw END AS availability,
    CASE WHEN cn = 1 OR cw IN ('true', 'yes', 'فعال', 'بله') THEN true
      WHEN cn = 0 OR cw IN ('false', 'no', 'غیرفعال', 'خیر') THEN false END AS active,
    nullif(trim(regexp_replace(coalesce(category_cell, ''), '[ \\t\\r\\n]+', ' ', 'g')), '') AS category,
    CASE WHEN pn >= 0 THEN pn END AS price, CASE WHEN wn > 0 THEN wn END AS weight,
    wt NOT IN ('', '-', '—', '–', 'null', 'none', 'nan') AS weight_present
  FROM cells),
rows AS (SELECT * FROM parsed WHERE legacy_id IS NOT NULL)
"""
_STATS = """count(price) AS price_count, count(*) FILTER (price IS NULL) AS price_missing,
  CAST(min(price) AS DOUBLE) AS price_min, CAST(max(price) AS DOUBLE) AS price_max, round(CAST(avg(price) AS DOUBLE), 1) AS price_avg,
  count(*) FILTER (weight_present) AS weight_present, count(*) FILTER (NOT weight_present) AS weight_missing,
  round(CAST(count(*) FILTER (weight_present) AS DOUBLE) * 100 / count(*), 4) AS weight_coverage"""


def _rows(spark, folder):
    return P.catalog_rows(P.drop_blank_rows(V.sheet(spark, folder)))


def _valid(spark, folder):
    return P.valid_rows(_rows(spark, folder))


def _counts(spark, folder):
    return P.category_counts(_valid(spark, folder))


def _doubles(df):
    return df.select(
        *[
            F.round(F.col(n).cast("double"), 1 if n == "price_avg" else 4).alias(n) if t.startswith("decimal") else F.col(n)
            for n, t in df.dtypes
        ]
    )


@query("catalog_rows", _ROWS + """
SELECT row_no, legacy_id, coalesce(nullif(trim(regexp_replace(coalesce(title_cell, ''), '[ \\t\\r\\n]+', ' ', 'g')), ''), '(بدون عنوان)') AS title,
  category, CAST(price AS DOUBLE) AS price, CAST(weight AS DOUBLE) AS weight, weight_present, availability, active,
  concat_ws('|', CASE WHEN legacy_id IS NULL THEN 'INVALID_LEGACY_ID' END, CASE WHEN pn < 0 THEN 'NEGATIVE_PRICE' END,
    CASE WHEN wn <= 0 THEN 'NON_POSITIVE_WEIGHT' END) AS warnings
FROM parsed""")
def catalog_rows(spark, folder):
    return _doubles(_rows(spark, folder)).withColumn("warnings", F.concat_ws("|", "warnings"))


@query("catalog_warnings", _ROWS + """
SELECT row_no, legacy_id, unnest([w FOR w IN [CASE WHEN legacy_id IS NULL THEN 'INVALID_LEGACY_ID' END,
  CASE WHEN pn < 0 THEN 'NEGATIVE_PRICE' END, CASE WHEN wn <= 0 THEN 'NON_POSITIVE_WEIGHT' END] IF w IS NOT NULL]) AS warning
FROM parsed""")
def catalog_warnings(spark, folder):
    return P.row_warnings(_rows(spark, folder))


@query("profile_totals", _ROWS + f"""
SELECT count(*) AS total_rows, count(DISTINCT category) AS category_count, count(*) FILTER (category IS NULL) AS missing_category,
  min(legacy_id) AS id_min, max(legacy_id) AS id_max, count(weight) AS weight_valid,
  count(*) FILTER (weight_present) - count(weight) AS weight_present_invalid, {_STATS},
  count(*) FILTER (active) AS active, count(*) FILTER (NOT active) AS inactive, count(*) FILTER (active IS NULL) AS unknown
FROM rows""")
def profile_totals(spark, folder):
    return _doubles(P.profile_totals(_valid(spark, folder)))


@query("profile_category_counts", _ROWS + """
SELECT category, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, category) AS rank
FROM rows WHERE category IS NOT NULL GROUP BY category""")
def profile_category_counts(spark, folder):
    return P.ranked_categories(_counts(spark, folder))


@query("profile_availability", _ROWS + "SELECT availability, count(*) AS n FROM rows GROUP BY availability")
def profile_availability(spark, folder):
    return P.availability_counts(_valid(spark, folder))


@query("profile_id_windows", _ROWS + f"""
, low AS (SELECT * FROM rows ORDER BY legacy_id, row_no LIMIT 1000), high AS (SELECT * FROM rows ORDER BY legacy_id DESC, row_no LIMIT 1000),
both_ends AS (SELECT 'lowest' AS "window", * FROM low UNION ALL SELECT 'highest', * FROM high)
SELECT "window", count(*) AS n, min(legacy_id) AS id_min, max(legacy_id) AS id_max, {_STATS} FROM both_ends GROUP BY "window" """)
def profile_id_windows(spark, folder):
    return _doubles(P.window_stats(_valid(spark, folder)))


def _like(word: str) -> str:
    return f"contains(t, '{word}')"


_CATEGORIES = _ROWS + f""", counts AS (SELECT category, count(*) AS n, lower({norm('category')}) AS t
FROM rows WHERE category IS NOT NULL GROUP BY category)"""


def _pattern_rows(patterns) -> str:
    from shelfwise.functions.classify import pattern_variants

    return ", ".join(f"('{label}', '{v}')" for label, variants in pattern_variants(patterns) for v in dict.fromkeys(variants))


def _pattern_oracle(patterns) -> str:
    return _CATEGORIES + f""", patterns(pattern, variant) AS (VALUES {_pattern_rows(patterns)}),
hits AS (SELECT DISTINCT pattern, category, n FROM patterns JOIN counts ON contains(t, variant))
SELECT p.pattern, count(h.category) AS category_count, CAST(coalesce(sum(h.n), 0) AS BIGINT) AS product_count
FROM (SELECT DISTINCT pattern FROM patterns) p LEFT JOIN hits h ON p.pattern = h.pattern GROUP BY p.pattern"""


@query("pattern_summary", _pattern_oracle(K.GEMSTONE_PATTERNS))
def pattern_summary(spark, folder):
    return P.pattern_summary(_counts(spark, folder), K.GEMSTONE_PATTERNS)


@query("pattern_summary_audience", _pattern_oracle(K.AUDIENCE_PATTERNS))
def pattern_summary_audience(spark, folder):
    return P.pattern_summary(_counts(spark, folder), K.AUDIENCE_PATTERNS)


@query("pattern_categories", _CATEGORIES + f""", patterns(pattern, variant) AS (VALUES {_pattern_rows(K.STYLE_PATTERNS + K.AUDIENCE_PATTERNS)})
SELECT DISTINCT pattern, category, n FROM patterns JOIN counts ON contains(t, variant)""")
def pattern_categories(spark, folder):
    return P.pattern_categories(_counts(spark, folder), K.STYLE_PATTERNS + K.AUDIENCE_PATTERNS)


def _labels(patterns) -> str:
    from shelfwise.functions.classify import pattern_variants

    cases = [
        f"CASE WHEN {' OR '.join(_like(v) for v in variants)} THEN '{label}' END" for label, variants in pattern_variants(patterns)
    ]
    return ", ".join(cases)


_AUDIENCE = f"coalesce({_labels(K.AUDIENCE_PATTERNS)}, '{K.AUDIENCE_DEFAULT}')"
_TAXONOMY = _CATEGORIES + f""", tax AS (
SELECT category, n,
  CASE WHEN {_like('انگشتر')} THEN 'انگشتر' WHEN {_like('دستبند')} THEN 'دستبند'
    WHEN {_like('گردنبند')} OR {_like('سینه ریز')} OR {_like('مدال')} OR {_like('آویز')} OR {_like('اویز')} OR {_like('زنجیر')} THEN 'گردنبند و آویز'
    WHEN {_like('گوشواره')} THEN 'گوشواره' WHEN regexp_matches(t, '(^| )(نیم *ست|ست)( |$)') THEN 'ست و نیم‌ست'
    WHEN {_like('نگین')} OR {_like('سنگ')} OR coalesce({_labels(K.GEMSTONE_PATTERNS)}) IS NOT NULL THEN 'سنگ و نگین'
    ELSE 'سایر/نیازمند بررسی' END AS parent,
  CASE WHEN {_like('انگشتر')} OR {_like('دستبند')} THEN {_AUDIENCE}
    WHEN {_like('گردنبند')} OR {_like('سینه ریز')} THEN 'گردنبند'
    WHEN {_like('مدال')} OR {_like('آویز')} OR {_like('اویز')} THEN 'مدال و آویز' WHEN {_like('زنجیر')} THEN 'زنجیر'
    WHEN {_like('گوشواره')} OR regexp_matches(t, '(^| )(نیم *ست|ست)( |$)') THEN {_AUDIENCE}
    WHEN {_like('نگین')} OR {_like('سنگ')} OR coalesce({_labels(K.GEMSTONE_PATTERNS)}) IS NOT NULL
      THEN coalesce({_labels(K.GEMSTONE_PATTERNS)}, 'سایر سنگ‌ها') ELSE 'بررسی دستی' END AS child,
  concat_ws('|', {_labels(K.AUDIENCE_PATTERNS)}, {_labels(K.GEMSTONE_PATTERNS)}, {_labels(K.STYLE_PATTERNS)}) AS facets
FROM counts)"""


@query("taxonomy_mapping", _TAXONOMY + " SELECT * FROM tax")
def taxonomy_mapping(spark, folder):
    return P.taxonomy_mapping(_counts(spark, folder)).withColumn("facets", F.concat_ws("|", "facets"))


@query("taxonomy_tree", _TAXONOMY + """
SELECT parent, child, CAST(sum(n) AS BIGINT) AS n FROM tax GROUP BY GROUPING SETS ((parent, child), (parent))""")
def taxonomy_tree(spark, folder):
    return P.taxonomy_tree(_counts(spark, folder))


@query("duplicate_ids_sample", _ROWS + """
SELECT legacy_id, count(*) AS n, count(*) OVER () AS repeated_ids FROM rows GROUP BY legacy_id HAVING count(*) > 1 ORDER BY legacy_id LIMIT 20""")
def duplicate_ids_sample(spark, folder):
    return P.repeated_ids_shown(_valid(spark, folder))


@query("duplicate_ids", _ROWS + " SELECT legacy_id, count(*) AS n FROM rows GROUP BY legacy_id HAVING count(*) > 1")
def duplicate_ids(spark, folder):
    return P.repeated_ids(_valid(spark, folder))


_GAP = "[ ‌]*"
_LABEL = f"شناسه{_GAP}کالا|کد(?:{_GAP}(?:مدل|محصول))?"
_SUFFIX = f"(?:^|[ \\-–—|:：]+)({_LABEL}){_GAP}[:：]?{_GAP}([0-9۰-۹٠-٩]{{2,8}}){_GAP}$"
_PLAN = _ROWS + f""", titled AS (
  SELECT *, regexp_replace(trim(CASE WHEN {norm('title_cell')} IN ('', '-') THEN concat('محصول ', CAST(legacy_id AS VARCHAR)) ELSE title_cell END), ' +', ' ', 'g') AS display
  FROM rows),
matched AS (
  SELECT *, regexp_extract(display, '{_SUFFIX}', 1) AS label,
    translate(regexp_extract(display, '{_SUFFIX}', 2), '{_FROM[:20]}', '{_TO[:20]}') AS tcode,
    trim(regexp_replace(display, '{_SUFFIX}', ''), ' -–—|:：') AS head
  FROM titled),
cleaned AS (
  SELECT *, CASE WHEN label <> '' AND head <> '' THEN head ELSE display END AS title,
    CASE WHEN label <> '' AND head = '' THEN 'REVIEW' WHEN label <> '' THEN 'CLEANED'
      WHEN regexp_matches(display, '({_LABEL}){_GAP}[:：]?{_GAP}[^ ]+{_GAP}$') THEN 'REVIEW' ELSE 'UNCHANGED' END AS title_status,
    replace({norm('code_cell')}, ' ', '') AS ccode
  FROM matched),
coded AS (
  SELECT *, CASE WHEN pn > 0 THEN CAST(floor(pn) AS BIGINT) END AS sheet_price,
    CASE WHEN dn > 0 THEN CAST(floor(dn) AS BIGINT) END AS pre_discount_price,
    CASE WHEN wn > 0 AND wn <= 500 THEN CAST(wn AS DECIMAL(12,4)) END AS w,
    CASE WHEN tcode <> '' THEN 'TITLE_CODE' WHEN regexp_matches(ccode, '^[0-9]+$') AND TRY_CAST(ccode AS BIGINT) BETWEEN 1 AND 99999
      THEN 'COL27_VALIDATED' ELSE 'FALLBACK_LEGACY_ID' END AS sku_source,
    CASE WHEN regexp_matches({norm('category')}, 'انگشتر') THEN 'rings' WHEN regexp_matches({norm('category')}, 'گردنبند|مدال') THEN 'necklaces'
      WHEN regexp_matches({norm('category')}, 'دستبند') THEN 'bracelets' END AS known,
    CASE WHEN regexp_matches(title, '(بدون|فاقد|بی) *(نگین|سنگ)') THEN 'no_stone'
      WHEN regexp_matches(title, '(نگین|عقیق).{{0,20}}(درشت|بزرگ)|(درشت|بزرگ).{{0,20}}(نگین|عقیق)') THEN 'large_stone' ELSE 'uncertain' END AS stone_class
  FROM cleaned),
rated AS (
  SELECT *, CASE WHEN stone_class = 'large_stone' THEN 590000 ELSE 650000 END AS rate_used FROM coded),
priced AS (
  SELECT *, CASE sku_source WHEN 'TITLE_CODE' THEN tcode WHEN 'COL27_VALIDATED' THEN ccode ELSE concat('NM-', CAST(legacy_id AS VARCHAR)) END AS sku,
    CASE WHEN sheet_price IS NOT NULL THEN CAST(w * rate_used AS DOUBLE) END AS calc,
    CASE WHEN sheet_price IS NULL THEN 'INVALID_REVIEW' WHEN w IS NULL THEN 'EXCEL_ONLY'
      WHEN sheet_price >= w * rate_used THEN 'MAX_EXCEL' ELSE 'MAX_CALCULATED' END AS price_source,
    CASE WHEN sheet_price IS NOT NULL THEN CAST(ceil(greatest(CAST(sheet_price AS DOUBLE), coalesce(CAST(w * rate_used AS DOUBLE), 0)) / 50000) AS BIGINT) * 50000 END AS final_price,
    CASE WHEN sn IS NULL THEN 'STOCK_MISSING_OR_INVALID' WHEN sn < 0 THEN 'STOCK_NEGATIVE_CLAMPED_TO_ZERO' WHEN sn <> floor(sn) THEN 'STOCK_FRACTION_FLOORED' END AS f1,
    CASE WHEN sn IS NULL OR sn < 0 THEN 0 ELSE CAST(floor(sn) AS BIGINT) END AS stock,
    coalesce(active, false) AND availability <> 'ناموجود' AS eligible
  FROM rated),
plan AS (
  SELECT row_no, legacy_id, title, title_status, tcode AS title_code, coalesce(known, 'rings') AS category, sheet_price, pre_discount_price,
    CAST(w AS DOUBLE) AS weight, stock, availability, active, sku, sku_source, concat(CAST(legacy_id AS VARCHAR), ':', sku) AS identity_key,
    CASE WHEN tcode = '' THEN 'NOT_APPLICABLE' ELSE 'YES' END AS sku_title_match, stone_class, CAST(rate_used AS BIGINT) AS rate_used,
    calc AS computed_price, final_price, price_source, eligible,
    concat_ws('|', f1, CASE WHEN known IS NULL THEN 'UNKNOWN_CATEGORY_DEFAULTED_TO_RINGS' END,
      CASE WHEN sheet_price IS NULL THEN 'EXCEL_PRICE_MISSING_OR_INVALID' END,
      CASE WHEN label <> '' AND head = '' THEN 'TITLE_CLEANUP_WOULD_EMPTY_TITLE' WHEN title_status = 'REVIEW' THEN 'TRAILING_CODE_LABEL_UNPARSED' END,
      CASE WHEN weight_present AND w IS NULL THEN 'WEIGHT_PRESENT_BUT_INVALID' END) AS review_flags
  FROM priced)
"""
_PLAN_COLUMNS = """row_no, legacy_id, title, title_status, title_code, category, sheet_price, pre_discount_price, weight, stock, availability,
  active, sku, sku_source, identity_key, sku_title_match, stone_class, rate_used, computed_price, final_price, price_source, eligible, review_flags"""


def _records(spark, folder):
    return S.priced_records(V.sheet(spark, folder))


def _plan_view(df):
    names = [c.strip() for c in _PLAN_COLUMNS.split(",")]
    extra = ["action"] if "action" in df.columns else []
    return _doubles(df.select(*names, *extra)).withColumn("review_flags", F.concat_ws("|", "review_flags"))


@query("catalog_price_plan", _PLAN + f"SELECT {_PLAN_COLUMNS} FROM plan")
def catalog_price_plan(spark, folder):
    return _plan_view(_records(spark, folder))


_SELECTED = _PLAN + """, chosen AS (SELECT * FROM plan WHERE eligible ORDER BY legacy_id DESC, row_no LIMIT 1000),
turns AS (SELECT *, row_number() OVER (PARTITION BY legacy_id ORDER BY legacy_id DESC, row_no) AS a,
  row_number() OVER (PARTITION BY lower(sku) ORDER BY legacy_id DESC, row_no) AS b FROM chosen),
selected AS (SELECT *, CASE WHEN a > 1 THEN 'SKIP_DUPLICATE_BATCH_LEGACY_ID' WHEN b > 1 THEN 'SKIP_DUPLICATE_BATCH_SKU'
  WHEN final_price IS NULL THEN 'SKIP_INVALID_PRICE' ELSE 'PLAN_CREATE_DRAFT' END AS action FROM turns)
"""


@query("select_newest", _SELECTED + f"""
SELECT {_PLAN_COLUMNS.replace('review_flags', '')}
  concat_ws('|', nullif(review_flags, ''), CASE WHEN a > 1 THEN 'DUPLICATE_BATCH_LEGACY_ID' WHEN b > 1 THEN 'DUPLICATE_BATCH_SKU' END) AS review_flags,
  action FROM selected""")
def select_newest(spark, folder):
    return _plan_view(S.select_newest(_records(spark, folder), 1000))


@query("batch_dedup_actions", _SELECTED + "SELECT action, count(*) AS n FROM selected GROUP BY action")
def batch_dedup_actions(spark, folder):
    return S.select_newest(_records(spark, folder), 1000).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("selection_summary", _PLAN + """
SELECT count(*) AS sheet_rows, count(*) FILTER (NOT coalesce(active, false)) AS inactive_skipped,
  count(*) FILTER (coalesce(active, false) AND availability = 'ناموجود') AS unavailable_skipped,
  count(*) FILTER (eligible) AS eligible_rows, least(count(*) FILTER (eligible), 1000) AS selected_rows FROM plan""")
def selection_summary(spark, folder):
    return S.selection_summary(_records(spark, folder), 1000)


@query("selection_preview", _SELECTED + """
SELECT legacy_id, row_no, sku, final_price, action, (SELECT greatest(count(*) - 20, 0) FROM selected) AS remaining
FROM selected ORDER BY legacy_id DESC, row_no LIMIT 20""")
def selection_preview(spark, folder):
    shown = S.preview(S.select_newest(_records(spark, folder), 1000), 20)
    return shown.select("legacy_id", "row_no", "sku", "final_price", "action", "remaining")


@query("catalog_scan", f"""WITH sheet AS ({V.as_sql(V.SHEET)}) SELECT row_no, id_cell, title_cell, category_cell, price_cell, weight_cell, code_cell, seo_description_cell FROM sheet""")
def catalog_scan(spark, folder):
    from shelfwise.sources.reading import POSITIONS, catalog_cells

    cells = V.view(spark, folder, V.SHEET)
    by_position = {position: name for name, position in POSITIONS.items()}
    by_position[K.COLUMN_TITLE] = "title_cell"
    wide = cells.select("row_no", *[F.col(by_position[i]).alias(f"c{i}") if i in by_position else F.lit("").alias(f"c{i}") for i in range(1, 30)])
    read = catalog_cells(wide, row_no="row_no", min_columns=K.IMPORT_MIN_COLUMNS)
    return read.select("row_no", "id_cell", "title_cell", "category_cell", "price_cell", "weight_cell", "code_cell", "seo_description_cell")


# What the report shows of a planned record; a record without a page shows the rest as its layout says
_SHOWN = {
    "new_public_title": "p.title", "title": "p.title", "title_cleanup_applied": "CASE WHEN p.title_status = 'CLEANED' THEN 'True' ELSE 'False' END",
    "title_cleanup_status": "p.title_status", "extracted_title_code": "p.title_code", "current_sku": "p.sku", "sku": "p.sku", "sku_source": "p.sku_source",
    "sku_title_match": "p.sku_title_match", "legacy_product_id": "p.legacy_id", "legacy_id": "p.legacy_id", "legacy_raw_code": "trim(q.code_cell)",
    "identity_key": "p.identity_key", "category_raw": "q.category", "category": "p.category", "weight_grams": "rtrim(rtrim(CAST(q.w AS VARCHAR), '0'), '.')",
    "excel_price_toman": "p.sheet_price", "pre_discount_price_toman": "p.pre_discount_price", "computed_price_toman": "CASE WHEN p.sheet_price IS NOT NULL THEN CAST(q.w * p.rate_used AS BIGINT) END",
    "final_price_toman": "p.final_price", "regular_price_toman": "p.final_price", "price_source": "p.price_source", "rate_used": "p.rate_used",
    "stone_class": "p.stone_class", "weight_source": "CASE WHEN q.w IS NULL THEN 'MISSING' ELSE 'EXCEL' END", "stock": "p.stock",
    "review_flags": "replace(p.review_flags, '|', ' | ')", "specs_found_count": "'0'", "images_found": "'0'", "price_changed": "'False'", "description_source": "'SEO_FALLBACK'",
    "wp_id": "''", "old_public_title": "''", "legacy_url": "''", "description_updated": "''", "stone_type": "''", "stone_color": "''", "band_type": "''",
    "silver_purity": "''", "spec_weight": "''", "unknown_spec_labels_seen": "''", "image_status": "''", "image_discovery_strategy": "''", "action": "''",
    "wordpress_product_id": "''",
}


@query("catalog_report", _PLAN + "SELECT p.row_no, " + ", ".join(f"coalesce(CAST({shown} AS VARCHAR), '') AS {name}" for name, shown in _SHOWN.items())
    + " FROM plan p JOIN priced q ON p.row_no = q.row_no")
def catalog_report(spark, folder):
    from shelfwise.operators.prepared import SHEET_REPORT, report

    shown = report(_records(spark, folder), (("row_no", "row_no", ""), *SHEET_REPORT))
    return shown.withColumn("row_no", F.col("row_no").cast("bigint"))
