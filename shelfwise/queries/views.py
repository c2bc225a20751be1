"""Shop-shaped inputs derived from the supplied tables.

Each text is plain SQL that Spark and the checking engine read alike: it only lays out input cells, never results.
``{name}`` stands for a source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise import constants as K
from shelfwise.operators.staging import computed, spread
from shelfwise.registry import table

FA = "translate(CAST({0} AS STRING), '0123456789', '۰۱۲۳۴۵۶۷۸۹')"


def fa(expression: str) -> str:
    return FA.format(expression)


# Store products with their metadata as text columns.
STORE = """
SELECT
  p_partkey AS id,
  p_name AS name,
  CASE WHEN p_partkey % 23 = 0 THEN '' ELSE concat('SKU-', CAST(p_partkey % 1500 AS STRING)) END AS sku,
  CASE WHEN p_partkey % 17 = 0 THEN 'draft' ELSE 'publish' END AS status,
  CASE p_partkey % 6
    WHEN 0 THEN ''
    WHEN 1 THEN concat(CAST(1 + p_partkey % 9 AS STRING), ',', CAST(100 + p_partkey % 900 AS STRING), ',000')
    WHEN 2 THEN 'abc'
    WHEN 3 THEN concat(CAST(450000 + p_partkey % 1000 AS STRING), '.5')
    ELSE CAST(700000 + (p_partkey * 37) % 5000000 AS STRING) END AS regular_price,
  CASE
    WHEN p_partkey % 29 = 0 THEN ''
    WHEN p_partkey % 31 = 0 THEN 'other_mode'
    WHEN p_type = 'ECONOMY' THEN 'silver_weight_only'
    WHEN p_type = 'STANDARD' THEN ' silver_weight_plus_stone '
    WHEN p_type = 'PROMO' THEN 'legacy_mirror'
    WHEN p_type = 'SMALL' THEN 'manual_locked'
    WHEN p_type = 'LARGE' THEN 'silver_weight_plus_stone'
    ELSE 'silver_weight_only' END AS mode_text,
  CASE
    WHEN p_partkey % 7 = 0 THEN ''
    WHEN p_partkey % 11 = 0 THEN 'bad'
    WHEN p_partkey % 13 = 0 THEN concat('1,0', CAST(10 + p_size AS STRING))
    WHEN p_partkey % 19 = 0 THEN '-3'
    ELSE concat(CAST(p_size AS STRING), '.', CAST(p_partkey % 100 AS STRING)) END AS weight_text,
  CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN '-5' WHEN 2 THEN 'none'
    ELSE concat(CAST(100000 + p_partkey % 900000 AS STRING), '.25') END AS stone_text,
  CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 9 = 0 THEN '0'
    ELSE concat(CAST(300000 + (p_partkey * 13) % 900000 AS STRING), '.5') END AS legacy_text,
  p_partkey % 3 <> 0 AS manage_stock,
  CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_partkey % 5 - 1 END AS stock_quantity,
  CASE WHEN p_partkey % 14 = 1 THEN 'hidden' ELSE 'visible' END AS catalog_visibility
FROM {part}
"""

# Catalog sheet cells, digits and letters mixed on purpose.
SHEET = f"""
SELECT
  p_partkey + 2 AS row_no,
  CASE WHEN p_partkey % 97 = 5 THEN 'نامعتبر' WHEN p_partkey % 41 = 7 THEN CAST(p_partkey - 1 AS STRING)
    WHEN p_partkey % 10 = 3 THEN {fa('p_partkey')} ELSE CAST(p_partkey AS STRING) END AS id_cell,
  CASE WHEN p_partkey % 101 = 7 THEN NULL ELSE CASE p_partkey % 8
    WHEN 0 THEN concat('انگشتر نقره ', p_name, ' کد ', {fa('p_partkey % 500 + 10')})
    WHEN 1 THEN concat('گردنبند ', p_name, ' - کد مدل ', CAST(p_partkey % 500 + 10 AS STRING))
    WHEN 2 THEN concat('دستبند ', p_name, ' | کد محصول ', CAST(p_partkey % 700 + 10 AS STRING))
    WHEN 3 THEN concat('انگشتر با نگین درشت عقیق ', p_name)
    WHEN 4 THEN concat('انگشتر بدون نگین ', p_name)
    WHEN 5 THEN concat('  ', p_name, '   نقره عیار 925 ')
    WHEN 6 THEN concat('مدال نقره: شناسه کالا ', {fa('p_partkey % 900 + 10')})
    ELSE concat('کد ', CAST(p_partkey + 10 AS STRING)) END END AS title_cell,
  CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE concat(CASE p_size % 10
    WHEN 0 THEN 'انگشتر عقيق مردانه' WHEN 1 THEN 'انگشتر زنانه' WHEN 2 THEN 'گردنبند فیروزه زنانه'
    WHEN 3 THEN 'مدال نقره' WHEN 4 THEN 'دستبند حدید مردانه' WHEN 5 THEN 'زنجیر'
    WHEN 6 THEN 'گوشواره یاقوت' WHEN 7 THEN 'نیم ست' WHEN 8 THEN 'سنگ زمرد' ELSE 'سایر زیورآلات' END,
    ' ', p_brand) END AS category_cell,
  CASE p_partkey % 9 WHEN 0 THEN NULL WHEN 1 THEN {fa('400000 + (p_partkey * 7919) % 9000000')}
    WHEN 2 THEN concat({fa('400000 + (p_partkey * 7919) % 9000000')}, ' تومان') WHEN 3 THEN '-5000' WHEN 4 THEN 'نامشخص'
    WHEN 5 THEN concat(CAST(1 + p_partkey % 9 AS STRING), ',', CAST(100 + p_partkey % 900 AS STRING), ',000')
    WHEN 6 THEN concat({fa('1 + p_partkey % 9')}, '٬', {fa('100 + p_partkey % 900')}, '٬۰۰۰')
    ELSE CAST(400000 + (p_partkey * 7919) % 9000000 AS STRING) END AS price_cell,
  CASE WHEN p_partkey % 4 = 0 THEN CAST(p_partkey * 1000 AS STRING) ELSE '' END AS pre_discount_cell,
  CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '-2' WHEN 2 THEN '5.7' WHEN 3 THEN {fa('p_partkey % 5')}
    ELSE CAST(p_partkey % 5 AS STRING) END AS stock_cell,
  CASE p_partkey % 5 WHEN 0 THEN 'موجود' WHEN 1 THEN 'ناموجود' WHEN 2 THEN '1' WHEN 3 THEN '۰' ELSE 'محدود' END AS availability_cell,
  CASE p_partkey % 7 WHEN 0 THEN '0' WHEN 1 THEN 'فعال' WHEN 2 THEN 'غیرفعال' WHEN 3 THEN '?' WHEN 4 THEN '۱' ELSE '1' END AS active_cell,
  CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN concat(CAST(p_size AS STRING), ',25 گرم')
    WHEN 2 THEN concat({fa('p_size')}, '٫5') WHEN 3 THEN 'نامشخص' WHEN 4 THEN '0'
    WHEN 5 THEN concat(CAST(p_size AS STRING), '.75') ELSE CAST(p_size * 20 AS STRING) END AS weight_cell,
  CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(p_partkey % 1200 + 900 AS STRING) WHEN 2 THEN '2079000.0000000002'
    WHEN 3 THEN {fa('p_partkey % 500 + 10')} ELSE concat('قیمت ', CAST(p_partkey AS STRING)) END AS code_cell,
  CASE WHEN p_partkey % 3 = 0 THEN concat('خرید ', p_name) ELSE '' END AS seo_title_cell,
  CASE WHEN p_partkey % 2 = 0 THEN concat('توضیح ', p_name, ' ', p_brand) ELSE '' END AS seo_description_cell
FROM {{part}}
"""

SOURCES = ("part", "supplier", "orders", "lineitem", "customer", "nation", "documents", "pages", "embeddings", "events")


def view(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Run a view text on Spark."""
    used = {name: table(spark, folder, name) for name in SOURCES if "{" + name + "}" in sql}
    return spark.sql(sql, **used)


def as_sql(sql: str) -> str:
    """The same view text for the checking engine."""
    return sql.format(**{name: name for name in SOURCES})


def store(spark: SparkSession, folder: str) -> DataFrame:
    """Store snapshot with its metadata as a map, half of it under historic keys."""
    columns = view(spark, folder, STORE)
    odd = F.col("id") % 2 == 1

    def key(current: str, historic: str):
        return F.when(odd, historic).otherwise(current)

    meta = F.create_map(
        key(*K.MODE_KEYS), F.col("mode_text"),
        key(K.WEIGHT_KEYS[0], K.WEIGHT_KEYS[1]), F.col("weight_text"),
        key(*K.STONE_VALUE_KEYS), F.col("stone_text"),
        key(*K.LEGACY_PRICE_KEYS), F.col("legacy_text"),
    )
    return columns.withColumn("meta", meta).drop("mode_text", "weight_text", "stone_text", "legacy_text")


def sheet(spark: SparkSession, folder: str) -> DataFrame:
    """Sheet cells as if read from storage: their layout expressions are not inlined into the parsing.

    A whole sheet fits one row group, so its rows are dealt over the tasks before they are laid out and parsed.
    """
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    cells = spark.sql(SHEET, part=spread(parts))
    return computed(cells, **{c: F.col(c) for c in cells.columns})


def rate(spark: SparkSession, value: int = 85_000) -> DataFrame:
    return spark.range(1).select(F.lit(value).cast("bigint").alias("rate"))


# Import file rows, most of them fine, some breaking each rule.
IMPORT_FILE = f"""
SELECT
  p_partkey + 2 AS row_number,
  CASE WHEN p_partkey % 50 = 1 THEN 'SAMPLE-1' WHEN p_partkey % 47 = 2 THEN 'no sku'
    ELSE concat('sku-', CASE p_partkey % 3 WHEN 0 THEN 'rng' WHEN 1 THEN 'NEC' ELSE 'BRC' END, '-U-',
      CAST(CASE WHEN p_partkey % 40 = 7 THEN p_partkey + 9997 ELSE p_partkey + 10000 END AS STRING)) END AS sku,
  CASE WHEN p_partkey % 60 = 1 THEN ' ' ELSE p_name END AS title_fa,
  CASE WHEN p_partkey % 70 = 2 THEN 'earrings' WHEN p_partkey % 71 = 3 THEN 'Rings'
    ELSE CASE p_partkey % 3 WHEN 0 THEN 'rings' WHEN 1 THEN 'necklaces' ELSE 'bracelets' END END AS category,
  CASE WHEN p_partkey % 33 = 0 THEN '' WHEN p_partkey % 95 = 6 THEN 'abc' WHEN p_partkey % 96 = 7 THEN '-1'
    ELSE concat({fa('p_size')}, '٫۵') END AS weight_grams,
  CASE WHEN p_partkey % 80 = 3 THEN '900' WHEN p_partkey % 81 = 4 THEN '' WHEN p_partkey % 82 = 5 THEN 'x' ELSE '۹۲۵' END AS silver_purity,
  CASE WHEN p_partkey % 44 = 1 THEN '' ELSE 'عقیق' END AS stone_type,
  CASE WHEN p_partkey % 55 = 1 THEN '0' WHEN p_partkey % 56 = 5 THEN '1.5' ELSE concat(CAST(100 + p_partkey % 900 AS STRING), ',000') END AS stone_value_toman,
  CASE WHEN p_partkey % 90 = 5 THEN 'weird' ELSE CASE p_partkey % 4 WHEN 0 THEN 'silver_weight_only'
    WHEN 1 THEN 'silver_weight_plus_stone' WHEN 2 THEN 'legacy_mirror' ELSE 'manual_locked' END END AS pricing_mode,
  CASE WHEN p_partkey % 99 = 7 THEN '-1' WHEN p_partkey % 5 = 0 THEN '' ELSE CAST(p_partkey % 7 AS STRING) END AS stock,
  CASE WHEN p_partkey % 66 = 2 THEN '' ELSE CAST(300000 + p_partkey AS STRING) END AS legacy_price_toman,
  CASE WHEN p_partkey % 67 = 3 THEN '0' ELSE CAST(2500000 + p_partkey AS STRING) END AS manual_price_toman,
  CASE WHEN p_partkey % 120 = 8 THEN '' ELSE concat('short ', p_name) END AS short_description,
  CASE WHEN p_partkey % 121 = 9 THEN '' ELSE concat('long ', p_brand) END AS long_description,
  CASE WHEN p_partkey % 45 = 9 THEN concat('img-', CAST(p_partkey - 1 AS STRING), '-a.jpg') WHEN p_partkey % 130 = 10 THEN 'a b.gif'
    WHEN p_partkey % 140 = 11 THEN 'x.jpg|x.jpg' WHEN p_partkey % 6 = 0 THEN ''
    ELSE concat('img-', CAST(p_partkey AS STRING), '-a.jpg | img-', CAST(p_partkey AS STRING), '-b.png') END AS image_filenames
FROM {{part}}
"""
FILES = "SELECT concat('img-', CAST(p_partkey AS STRING), CASE WHEN p_partkey % 2 = 0 THEN '-a.jpg' ELSE '-b.png' END) AS image FROM {part}"

# Planned records and two key views of an existing store.
RECORDS = """
SELECT p_partkey AS row_no, CAST(p_partkey % 1800 AS STRING) AS legacy_id, concat('C', CAST(p_partkey % 1900 AS STRING)) AS sku,
  CASE WHEN p_partkey % 11 = 0 THEN 'SKIP_INVALID_PRICE' ELSE 'PLAN_CREATE_DRAFT' END AS action,
  CASE WHEN p_partkey % 13 = 0 THEN 'SKIP_INVALID_REVIEW' ELSE 'CREATE_DRAFT' END AS import_action
FROM {part}
"""
STORE_KEYS = """
SELECT p_partkey + 50000 AS product_id, CASE WHEN p_partkey % 4 = 0 THEN concat('C', CAST(p_partkey * 2 AS STRING)) ELSE concat('Z', CAST(p_partkey AS STRING)) END AS sku,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey % 900 AS STRING) ELSE '' END AS plain_id,
  CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey AS STRING) ELSE '' END AS historic_id
FROM {part}
"""

# Legacy feed and the mapping table of an earlier sync.
FEED = f"""
SELECT p_partkey AS legacy_id, concat(' ', p_name, ' كد ', CAST(p_partkey AS STRING), ' ') AS title,
  CAST(1000000 + p_partkey * 10 AS STRING) AS price, CASE WHEN p_partkey % 9 = 0 THEN -3 WHEN p_partkey % 10 = 0 THEN NULL ELSE p_partkey % 6 END AS stock,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS weight_g, p_partkey % 5 = 0 AS is_special_gemstone,
  CASE WHEN p_partkey % 3 = 0 THEN 500000 ELSE 0 END AS stone_value, p_partkey % 23 = 0 AS price_locked,
  CASE p_partkey % 6 WHEN 0 THEN 'rng' WHEN 1 THEN ' NEC ' WHEN 2 THEN 'BRC' WHEN 3 THEN 'SET' WHEN 4 THEN 'EAR' ELSE 'XXX' END AS cat_code,
  CASE p_partkey % 4 WHEN 0 THEN 'w' WHEN 1 THEN 'M' WHEN 2 THEN 'U' ELSE '?' END AS gender_code,
  concat('https://img.example.com/', CAST(p_partkey AS STRING), '.jpg?size=320') AS image_url
FROM {{part}}
"""
MAPPING = """
SELECT p_partkey * 2 AS legacy_id, concat('OLD-', CAST(p_partkey AS STRING)) AS sku, p_partkey * 7 + 500 AS product_id,
  CASE WHEN p_partkey % 3 = 0 THEN 'publish' ELSE 'draft' END AS wc_status, p_partkey % 5 AS exact_stock,
  'legacy_mirror' AS pricing_mode, '2024-01-01T00:00:00' AS last_sync_utc
FROM {part}
"""

# Links by group, candidates with three keys.
LINKS = """
SELECT CAST(substring(p_brand, 7, 3) AS INT) AS group_no, p_partkey AS position,
  concat('https://shop.example.com/product/', CAST(p_partkey % 700 AS STRING), '/') AS url
FROM {part}
"""
CANDIDATES = """
SELECT p_partkey AS row_no, (p_partkey * 7) % 1500 AS legacy_id,
  CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE concat('k', CAST((p_partkey * 11) % 1300 AS STRING)) END AS code,
  concat('s', CAST((p_partkey * 13) % 1700 AS STRING)) AS sku
FROM {part}
"""

# Watched orders with the city of the customer's nation.
ORDERS = """
SELECT o.o_orderkey AS id, CASE o.o_orderstatus WHEN 'F' THEN 'processing' WHEN 'O' THEN 'on-hold' ELSE 'pending' END AS status,
  CAST(CAST(round(o.o_totalprice * 10) AS BIGINT) AS STRING) AS total, CASE WHEN o.o_orderkey % 9 = 0 THEN 'usd' ELSE 'IRT' END AS currency,
  CASE WHEN c.c_custkey % 3 = 0 THEN '' ELSE n.n_name END AS shipping_city, CASE WHEN c.c_custkey % 6 = 0 THEN '' ELSE c.c_mktsegment END AS billing_city
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""
ITEM_LINES = """
SELECT l_orderkey AS id, (l_linenumber * 1000000000000 + l_partkey * 100000 + l_suppkey) * 100 + CAST(l_quantity AS INT) AS position, l_partkey AS item, CAST(l_quantity AS INT) AS quantity FROM {lineitem}
"""
ITEMS = """
SELECT l.l_orderkey AS id, (l.l_linenumber * 1000000000000 + l.l_partkey * 100000 + l.l_suppkey) * 100 + CAST(l.l_quantity AS INT) AS position, p.p_name AS name, CAST(l.l_quantity AS INT) AS quantity
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""


# Raw text inputs of the safe price.
SAFE = f"""
SELECT p_partkey AS id,
  CASE p_partkey % 5 WHEN 0 THEN 'Rings ' WHEN 1 THEN 'necklaces' WHEN 2 THEN 'rings' WHEN 3 THEN 'bracelets' ELSE 'watches' END AS category,
  CASE p_partkey % 6 WHEN 0 THEN 'large_stone' WHEN 1 THEN 'no_stone' WHEN 2 THEN 'LARGE_STONE' WHEN 3 THEN 'small_stone' WHEN 4 THEN '' ELSE 'odd' END AS stone_class,
  CASE p_partkey % 7 WHEN 0 THEN '0.849' WHEN 1 THEN '0.85' WHEN 2 THEN 'x' WHEN 3 THEN '7' ELSE '0.9' END AS confidence,
  CASE p_partkey % 11 WHEN 0 THEN '' WHEN 1 THEN '-1' WHEN 2 THEN 'bad' WHEN 3 THEN '700' ELSE concat({fa('p_size')}, '٫', {fa('p_partkey % 10')}) END AS weight,
  CASE p_partkey % 13 WHEN 0 THEN '' WHEN 1 THEN '10' WHEN 2 THEN 'none' WHEN 3 THEN CAST(p_size * 650000 AS STRING)
    ELSE concat({fa('1 + p_partkey % 40')}, '٬', {fa('100 + p_partkey % 900')}, '٬۰۰۰ تومان') END AS legacy_price
FROM {{part}}
"""

# Product pages: a filled shop template around every stored page, the stored page included whole.
PRODUCT_PAGES = f"""
SELECT page_id, concat('https://shop.example.com/product/', CAST(page_id + 1000 AS STRING), '/item') AS url,
  concat('<html><head><meta name="description" content="متا ', {fa('page_id')}, '">',
    '<script type="application/ld+json">{{{{"@graph":[{{{{"@type":"Product","name":"نام ', CAST(page_id AS STRING), '","offers":{{{{"price":"', CAST(900000 + page_id AS STRING),
    '","priceCurrency":"', CASE WHEN page_id % 2 = 0 THEN 'IRR' ELSE 'IRT' END, '"}}}}}}}}]}}}}</script></head><body>',
    '<a href="/category/2/x/">', CASE page_id % 4 WHEN 0 THEN 'انگشتر مردانه' WHEN 1 THEN 'مدال یا گردنبند' WHEN 2 THEN 'دستبند' ELSE 'ساعت' END, '</a>',
    '<h1>نقره <b>۹۲۵</b> نمونه کد ', {fa('page_id + 100')}, '</h1>',
    CASE WHEN page_id % 7 = 0 THEN '' ELSE concat('<div class="product-specs">وزن تقریبی: ', {fa('page_id % 90 + 1')}, '٫۵ گرم</div>') END,
    CASE WHEN page_id % 5 = 0 THEN '' ELSE concat('<div class="sale-price">', {fa('page_id % 9 + 1')}, '٬', {fa('page_id % 900 + 100')}, '٬۰۰۰ تومان</div>') END,
    '<div class="product-description">شرح &amp; ', CAST(page_id AS STRING), '</div>',
    '<img src="/assets/logo.png"><img data-large_image="/product-images/', CAST(page_id AS STRING), '-a.jpg" src="/product-images/', CAST(page_id AS STRING), '-a-150x150.jpg?x=1">',
    '<img srcset="/product-images/', CAST(page_id AS STRING), '-b-300x300.jpg 300w, /product-images/', CAST(page_id AS STRING), '-c.jpg 1600w">',
    CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN concat('<section><h2>مشخصات</h2><p>دسته‌بندی: انگشتر مردانه · وزن:', {fa('page_id % 50 + 1')}, ' گرم · نوع سنگ:عقیق • عیار نقره:925 · طرح ویژه:شیر</p></section>')
      WHEN 2 THEN concat('<h3>مشخصات</h3><dl><dt>نوع سنگ</dt><dd>فیروزه</dd><dt>وزن</dt><dd>', CAST(page_id % 50 + 1 AS STRING), '</dd><dt>طرح</dt><dd>بیضی</dd></dl>')
      ELSE '<table><tr><td>رنگ نگین:</td><td>سبز</td></tr><tr><td>سایز</td><td>دلخواه</td></tr></table>' END,
    replace(replace(html, '<h1>', '<h2>'), '</h1>', '</h2>'), '</body></html>') AS html
FROM {{pages}}
"""
DRAFTS = """
SELECT p_partkey + 70000 AS product_id, p_partkey * 2 AS legacy_id, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('عنوان ', p_name, ' کد ', CAST(p_partkey % 90 + 10 AS STRING)) END AS public_title,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_partkey % 90 + 10 AS STRING) END AS sku, '' AS legacy_original_title, CAST(p_retailprice * 1000 AS BIGINT) AS price
FROM {part}
"""
