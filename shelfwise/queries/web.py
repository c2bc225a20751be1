"""Page extraction, discovery, enrichment and document gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import urls as U
from shelfwise.functions import text as T
from shelfwise.operators import documents as D, enrich as E, pages as P, patterns as PT, selection as S
from shelfwise.queries import catalog as C, views as V
from shelfwise.registry import query, table

SITE = "shop.example.com"


def _entities(text: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return text


@query("page_title_fields", f"""
SELECT page_id, trim(regexp_replace({_entities("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '[ \\t\\r\\n\\x{{a0}}]+', ' ', 'g')) AS heading
FROM pages""")
def page_title_fields(spark, folder):
    return P.walk_pages(table(spark, folder, "pages")).select("page_id", "heading")


_LINK_BASE = "regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1)"


@query("page_links", f"""
WITH raw AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1)) AS link,
  generate_subscripts(regexp_extract_all(html, '(?i)href=["'']([^"'']+)["'']', 1), 1) - 1 AS position FROM pages)
SELECT page_id, CASE WHEN starts_with(l, '/') THEN concat({_LINK_BASE}, l) ELSE l END AS target, CAST(min(position) AS INT) AS position
FROM (SELECT *, {_entities('link')} AS l FROM raw) GROUP BY 1, 2""")
def page_links(spark, folder):
    return P.page_links(table(spark, folder, "pages"), P.ANY_HREF)


_RULES = [(False, "/fr/8"), (True, "/fr/"), (False, "/en/4"), (False, "/es/"), (True, "/en/"), (False, "/de/1")]
_RULE_SQL = " ".join(f"WHEN starts_with(path, '{p}') THEN {str(ok).lower()}" for ok, p in _RULES)


@query("robots_filter", f"""
SELECT page_id, url FROM (SELECT page_id, url, coalesce(nullif(regexp_extract(url, '://[^/?#]*(/[^#]*)', 1), ''), '/') AS path FROM pages)
WHERE CASE {_RULE_SQL} ELSE true END""")
def robots_filter(spark, folder):
    return table(spark, folder, "pages").filter(P.robots_allowed(F.col("url"), _RULES)).select("page_id", "url")


@query("page_canonical_urls", """
SELECT page_id, CASE WHEN page_id % 3 = 1 THEN NULL ELSE concat('https://shop.example.com', regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '/img-', CAST(page_id AS VARCHAR), '.JPG') END AS canonical
FROM pages""")
def page_canonical_urls(spark, folder):
    pages = table(spark, folder, "pages")
    host = F.when(F.col("page_id") % 3 == 1, "http://other.example.com").otherwise("http://shop.example.com")
    image = F.concat(host, U.path(F.col("url")), F.lit("/img-"), F.col("page_id").cast("string"), F.lit("-300x200.JPG?size=1#top"))
    return pages.select("page_id", U.canonical_image_url(image, SITE).alias("canonical"))


@query("page_iri_to_uri", """
WITH i AS (SELECT page_id, concat(url, '/', regexp_extract(html, '<h1>([^<]*)', 1), '/%D9%85?q=', regexp_extract(html, '<title>([^<]*)', 1)) AS iri FROM pages),
parts AS (SELECT page_id, regexp_extract(iri, '^https?://[^/?#]*') AS site, regexp_extract(iri, '^https?://[^/?#]*([^?#]*)', 1) AS names,
  regexp_extract(iri, '^[^?#]*[?]([^#]*)', 1) AS asked, regexp_extract(iri, '(?s)^[^#]*#(.*)$', 1) AS mark FROM i),
coded AS (SELECT page_id, site, replace(replace(url_encode(names), '%2F', '/'), '%25', '%') AS names, replace(url_encode(mark), '%25', '%') AS mark,
  replace(replace(replace(url_encode(asked), '%3D', '='), '%26', '&'), '%25', '%') AS asked FROM parts)
SELECT page_id, concat(site, names, CASE WHEN asked <> '' THEN concat('?', asked) ELSE '' END, CASE WHEN mark <> '' THEN concat('#', mark) ELSE '' END) AS uri FROM coded""")
def page_iri_to_uri(spark, folder):
    def inner(tag):
        return F.regexp_extract("html", f"<{tag}>([^<]*)", 1)

    iri = F.concat("url", F.lit("/"), inner("h1"), F.lit("/%D9%85?q="), inner("title"))
    return table(spark, folder, "pages").select("page_id", U.iri_to_uri(iri).alias("uri"))


def _walked(spark, folder):
    return P.walk_pages(V.view(spark, folder, V.PRODUCT_PAGES))


_PAGE = "WITH p AS (SELECT page_id, page_id AS k FROM pages)"


@query("page_product_fields", _PAGE + """
SELECT page_id, CAST(k + 1000 AS VARCHAR) AS legacy_id, concat('نقره 925 نمونه کد ', k + 100) AS title,
  CASE k % 4 WHEN 0 THEN 'انگشتر مردانه' WHEN 1 THEN 'مدال یا گردنبند' WHEN 2 THEN 'دستبند' ELSE 'ساعت' END AS raw_category,
  CASE k % 4 WHEN 0 THEN 'rings' WHEN 1 THEN 'necklaces' WHEN 2 THEN 'bracelets' END AS category,
  CASE WHEN k % 5 = 0 THEN 900000 + k ELSE (k % 9 + 1) * 1000000 + (k % 900 + 100) * 1000 END AS price,
  CASE WHEN k % 5 <> 0 THEN 'visible_price' WHEN k % 2 = 0 THEN 'jsonld_irr_label_but_amount_toman_review' ELSE 'jsonld_irt' END AS price_source,
  CASE WHEN k % 7 <> 0 THEN k % 90 + 1.5 WHEN k % 4 = 1 THEN k % 50 + 1.0 WHEN k % 4 = 2 THEN k % 50 + 1.0 END::DOUBLE AS weight,
  concat('شرح & ', k) AS description, concat('متا ', k) AS short_description,
  concat('https://shop.example.com/product-images/', k, '-a-150x150.jpg') AS image_urls, CAST(k + 100 AS VARCHAR) AS code, CAST(k + 100 AS VARCHAR) AS sku
FROM p""")
def page_product_fields(spark, folder):
    fields = P.product_fields(_walked(spark, folder), SITE)
    return fields.select(
        "page_id", "legacy_id", "title", "raw_category", "category", "price", "price_source", "weight", "description",
        "short_description", F.concat_ws("|", "image_urls").alias("image_urls"), "code", "sku",
    )


@query("page_gallery", _PAGE + """
SELECT page_id, unnest([concat('https://shop.example.com/product-images/', k, '-a.jpg'), concat('https://shop.example.com/product-images/', k, '-c.jpg')]) AS image,
  unnest([0, 1]) AS position FROM p""")
def page_gallery(spark, folder):
    gallery = P.gallery_urls(F.col("gallery"), F.col("gallery_marked"), SITE)
    return _walked(spark, folder).select("page_id", F.posexplode(gallery).alias("position", "image"))


_SPECS = _PAGE + """, specs AS (SELECT page_id,
  CASE k % 4 WHEN 1 THEN 'انگشتر مردانه' ELSE '' END AS category, CASE k % 4 WHEN 1 THEN concat(k % 50 + 1, ' گرم') WHEN 2 THEN CAST(k % 50 + 1 AS VARCHAR) ELSE '' END AS weight_display,
  CASE WHEN k % 4 IN (1, 2) THEN CAST(k % 50 + 1 AS DOUBLE) END AS weight_grams, CASE k % 4 WHEN 1 THEN 'عقیق' WHEN 2 THEN 'فیروزه' ELSE '' END AS stone_type,
  CASE k % 4 WHEN 3 THEN 'سبز' ELSE '' END AS stone_color, CASE k % 4 WHEN 1 THEN '925' ELSE '' END AS silver_purity, CASE k % 4 WHEN 3 THEN 'دلخواه' ELSE '' END AS size,
  CASE k % 4 WHEN 1 THEN 'طرح ویژه' WHEN 2 THEN 'طرح' ELSE '' END AS unknown_labels FROM p WHERE k % 4 <> 0)"""


def _specs(spark, folder):
    return P.best_specs(P.spec_rows(P.walk_pages(P.may_have_specs(V.view(spark, folder, V.PRODUCT_PAGES)))))


@query("page_specs", _SPECS + " SELECT * FROM specs")
def page_specs(spark, folder):
    return _specs(spark, folder).select(
        "page_id", "category", "weight_display", F.col("weight_grams").cast("double").alias("weight_grams"), "stone_type", "stone_color",
        "silver_purity", "size", F.concat_ws("|", "unknown_labels").alias("unknown_labels"),
    )


@query("page_unknown_labels", _SPECS + " SELECT unknown_labels AS label, count(*) AS n FROM specs WHERE unknown_labels <> '' GROUP BY 1")
def page_unknown_labels(spark, folder):
    return P.unknown_label_counts(_specs(spark, folder))


_SITEMAPS = """SELECT s_suppkey AS sitemap_id, concat('<urlset><url><loc>https://shop.example.com/product/', CAST(s_suppkey AS STRING), '/a</loc></url><url><loc> https://shop.example.com/p/',
  CAST(s_suppkey + 5 AS STRING), ' </loc></url><url><loc>https://shop.example.com/sitemap-', CAST(s_suppkey AS STRING), '.xml</loc></url></urlset>') AS xml FROM {supplier}"""


@query("sitemap_products", """
SELECT s_suppkey AS sitemap_id, unnest([0, 1]) AS position, unnest([concat('https://shop.example.com/product/', s_suppkey, '/a'), concat('https://shop.example.com/p/', s_suppkey + 5)]) AS target,
  unnest([s_suppkey, s_suppkey + 5]) AS legacy_id FROM supplier""")
def sitemap_products(spark, folder):
    return P.sitemap_products(P.sitemap_urls(V.view(spark, folder, _SITEMAPS), SITE))


@query("product_links", """
WITH o AS (SELECT DISTINCT l_orderkey % 500 AS a, l_partkey AS b FROM lineitem)
SELECT a AS page_id, b AS legacy_id, CASE WHEN b % 2 = 0 THEN concat('https://shop.example.com/product/', b, '/x?y=1') ELSE concat('https://shop.example.com/?a=b&product_id=', b) END AS target
FROM o WHERE b % 3 <> 0""")
def product_links(spark, folder):
    lines = table(spark, folder, "lineitem").select((F.col("l_orderkey") % 500).alias("page_id"), F.col("l_partkey").alias("b")).distinct()
    b = F.col("b").cast("string")
    site = F.when(F.col("b") % 3 == 0, "http://other.example.com").otherwise("http://shop.example.com")
    rest = F.when(F.col("b") % 2 == 0, F.concat(F.lit("/product/"), b, F.lit("/x?y=1#z"))).otherwise(F.concat(F.lit("/?a=b&product_id="), b))
    links = lines.select("page_id", F.concat(site, rest).alias("target"))
    return P.links_for_products(links, SITE).select("page_id", "legacy_id", "target")


_BASE = "https://shop.example.com"
_FOUND = """SELECT CASE p_partkey % 5 WHEN 0 THEN concat('https://shop.example.com/product/', CAST(p_partkey AS STRING), '/')
  WHEN 1 THEN concat('https://shop.example.com/p/', CAST(p_partkey AS STRING), '/') WHEN 2 THEN concat('https://shop.example.com/found/', CAST(p_partkey AS STRING))
  ELSE concat('https://shop.example.com/none/', CAST(p_partkey AS STRING)) END AS url FROM {part}"""


@query("page_discovery", """
SELECT p_partkey AS row_no, p_partkey AS legacy_id, CASE p_partkey % 5 WHEN 0 THEN concat('https://shop.example.com/product/', p_partkey, '/')
  WHEN 1 THEN concat('https://shop.example.com/p/', p_partkey, '/') WHEN 2 THEN concat('https://shop.example.com/found/', p_partkey) ELSE '' END AS legacy_url,
  CASE p_partkey % 5 WHEN 0 THEN 'DIRECT_ID_PATTERN' WHEN 1 THEN 'DIRECT_ID_PATTERN' WHEN 2 THEN 'SITEMAP_CACHE' ELSE 'NOT_FOUND' END AS strategy FROM part""")
def page_discovery(spark, folder):
    records = table(spark, folder, "part").select(F.col("p_partkey").alias("row_no"), F.col("p_partkey").alias("legacy_id"))
    extra = records.select(
        "legacy_id", F.lit(3).alias("strategy_rank"), F.lit(0).alias("position"), F.concat(F.lit(_BASE + "/found/"), F.col("legacy_id").cast("string")).alias("target")
    )
    candidates = P.direct_candidates(records, _BASE).unionByName(extra)
    return P.discover(records, candidates, V.view(spark, folder, _FOUND))


_DRAFT_SQL = C._PLAN + f""", drafts AS ({V.as_sql(V.DRAFTS)}),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY legacy_id ORDER BY row_no DESC) AS turn FROM plan) WHERE turn = 1)"""


@query("enrich_missing", _DRAFT_SQL + """
SELECT legacy_id, product_id, 'SKIP_LEGACY_ID_NOT_IN_EXCEL' AS action FROM drafts WHERE legacy_id NOT IN (SELECT legacy_id FROM plan)""")
def enrich_missing(spark, folder):
    return E.split_drafts(V.view(spark, folder, V.DRAFTS), S.priced_records(V.sheet(spark, folder)))[1]


def _matched(spark, folder):
    matched, _ = E.split_drafts(V.view(spark, folder, V.DRAFTS), S.priced_records(V.sheet(spark, folder)))
    return E.enrichment_plan(matched)


@query("enrich_matched", _DRAFT_SQL + """
SELECT d.product_id, d.legacy_id, coalesce(nullif(d.sku, ''), l.sku) AS current_sku, l.final_price, l.price_source,
  concat(CAST(d.legacy_id AS VARCHAR), ':', coalesce(nullif(d.sku, ''), l.sku)) AS identity_key,
  CASE WHEN l.title_code = '' THEN 'NOT_APPLICABLE' WHEN l.title_code = coalesce(nullif(d.sku, ''), l.sku) THEN 'YES' ELSE 'NO' END AS sku_title_match
FROM drafts d JOIN latest l ON d.legacy_id = l.legacy_id""")
def enrich_matched(spark, folder):
    return _matched(spark, folder).select(
        "product_id", "legacy_id", "current_sku", "final_price", "price_source", "identity_key", "sku_title_match"
    )


_SPEC_WEIGHTS = """SELECT p_partkey * 2 AS page_id, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE concat(CAST(p_size AS STRING), '.5') END AS weight_text, 'x' AS dummy FROM {part} WHERE p_partkey % 6 <> 0"""


@query("weight_reconcile", _DRAFT_SQL + f""", w AS ({V.as_sql(_SPEC_WEIGHTS)}),
linked AS (SELECT d.product_id, l.*, w.page_id IS NOT NULL AS has_specs, TRY_CAST(nullif(w.weight_text, '') AS DOUBLE) AS live
  FROM drafts d JOIN latest l ON d.legacy_id = l.legacy_id LEFT JOIN w ON w.page_id = d.legacy_id),
redone AS (SELECT *, CASE WHEN weight IS NULL AND live IS NOT NULL AND sheet_price IS NOT NULL
    THEN CAST(ceil(greatest(sheet_price, live * (CASE stone_class WHEN 'large_stone' THEN 590000 ELSE 650000 END)) / 50000) AS BIGINT) * 50000 ELSE final_price END AS new_final FROM linked)
SELECT product_id, CASE WHEN weight IS NOT NULL THEN 'EXCEL' WHEN live IS NOT NULL THEN 'LIVE_PAGE' ELSE 'MISSING' END AS weight_source,
  coalesce(weight, live) AS weight, new_final AS final_price, weight IS NULL AND live IS NOT NULL AS price_reconciled,
  coalesce(abs(weight - live) > 0.5, false) AS mismatch, weight IS NULL AND live IS NOT NULL AND new_final IS DISTINCT FROM final_price AS recalculated,
  NOT has_specs AS specs_missing
FROM redone""")
def weight_reconcile(spark, folder):
    specs = V.view(spark, folder, _SPEC_WEIGHTS).select(
        F.col("page_id").alias("legacy_id"),
        F.create_map(F.lit("وزن"), F.col("weight_text")).alias("specs"),
        F.array().cast("array<string>").alias("unknown_labels"),
        F.col("weight_text").try_cast("decimal(12,4)").alias("weight_grams"),
        F.col("weight_text").alias("weight_display"),
        *[F.lit("").alias(n) for n in E.SPEC_FIELDS if n != "weight_display"],
    )
    records = _matched(spark, folder).withColumn("sku", F.col("current_sku"))
    done = E.reconcile(E.with_specs(records, specs, "legacy_id", ["product_id"], counted=V.view(spark, folder, V.DRAFTS)), "فروشگاه")

    def has(flag: str):
        return F.array_contains("review_flags", flag)

    return done.select(
        "product_id", "weight_source", F.col("weight").cast("double").alias("weight"), "final_price", "price_reconciled",
        has("WEIGHT_MISMATCH").alias("mismatch"), has("PRICE_RECALCULATED_FROM_LIVE_WEIGHT").alias("recalculated"),
        has("SPECS_MISSING_SEO_FALLBACK").alias("specs_missing"),
    )


_ODD = "[ \\t\\r\\n\\x{0b}\\x{0c}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


@query("doc_normalize", f"""
SELECT doc_id, md5(trim(regexp_replace(translate(text, '{C._FROM}', '{C._TO}'), '{_ODD}', ' ', 'g'))) AS plain_md5,
  length(trim(regexp_replace(text, '{_ODD}', ' ', 'g'))) AS title_length,
  md5(translate(text, '0123456789', '۰۱۲۳۴۵۶۷۸۹')) AS persian_md5
FROM documents""")
def doc_normalize(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id",
        F.md5(T.normalize_text(text)).alias("plain_md5"),
        F.length(T.title_whitespace(text)).cast("bigint").alias("title_length"),
        F.md5(T.persian_digits(text)).alias("persian_md5"),
    )


_SECRETS = ["token = ", "abc", "que les", "tion the", "erland"]


@query("doc_redact", """
SELECT doc_id, md5(replace(replace(replace(replace(text, 'token = ', '********'), 'que les', '********'), 'tion the', '********'), 'erland', '********')) AS text_md5 FROM documents""")
def doc_redact(spark, folder):
    return D.redacted(table(spark, folder, "documents"), _SECRETS).select("doc_id", F.md5("text").alias("text_md5"))


@query("doc_secret_hits", """
SELECT doc_id, concat_ws('|', CASE WHEN regexp_matches(text, 'gh[pousr]_[A-Za-z0-9]{20,}') THEN 'github_token' END,
  CASE WHEN regexp_matches(text, 'AKIA[0-9A-Z]{16}') THEN 'aws_key' END, CASE WHEN regexp_matches(text, '-----BEGIN (RSA|OPENSSH|EC) PRIVATE KEY-----') THEN 'private_key' END,
  CASE WHEN regexp_matches(text, 'token = "[0-9a-f]{16,}') THEN 'token' END) AS kinds
FROM documents WHERE regexp_matches(text, 'gh[pousr]_[A-Za-z0-9]{20,}|AKIA[0-9A-Z]{16}|-----BEGIN (RSA|OPENSSH|EC) PRIVATE KEY-----|token = "[0-9a-f]{16,}')""")
def doc_secret_hits(spark, folder):
    from shelfwise import constants as K

    hits = D.secret_hits(table(spark, folder, "documents"), (*K.SECRET_PATTERNS, ("token", 'token = "[0-9a-f]{16,}')))
    return hits.select("doc_id", F.concat_ws("|", "secret_kinds").alias("kinds"))


@query("marker_gate", """
SELECT doc_id, CASE WHEN contains(text, 'token = ') THEN 'token = ' ELSE '###' END AS marker FROM documents WHERE contains(text, 'token = ') OR contains(text, '###')""")
def marker_gate(spark, folder):
    return D.marker_hits(table(spark, folder, "documents"), ("token = ", "###")).select("doc_id", "marker")


@query("doc_public_section", """
WITH body AS (SELECT doc_id, regexp_replace(regexp_replace(text, '^([ \\t]*\\n)+', ''), '(\\n[ \\t]*)+$', '') AS b FROM documents)
SELECT doc_id, CASE WHEN doc_id % 5 = 1 OR doc_id % 5 = 2 OR trim(b) = '' THEN NULL ELSE md5(b) END AS body_md5,
  CASE WHEN doc_id % 5 = 1 THEN 'required section not found' WHEN doc_id % 5 = 2 THEN 'duplicate section heading' WHEN trim(b) = '' THEN 'section is empty' END AS error FROM body""")
def doc_public_section(spark, folder):
    text = F.col("text")
    wrapped = (
        F.when(F.col("doc_id") % 5 == 1, F.concat(F.lit("# x\n## Other\n"), text))
        .when(F.col("doc_id") % 5 == 2, F.concat(F.lit("## Content\n"), text, F.lit("\n## content:\nmore")))
        .otherwise(F.concat(F.lit("# x\nintro\n## Page Content\n"), text, F.lit("\n\n## SEO notes:\nhidden\n## Content\n")))
    )
    cut = D.public_sections(table(spark, folder, "documents").select("doc_id", wrapped.alias("text")))
    return cut.select("doc_id", F.md5("body").alias("body_md5"), "error")


# Phrases of five words: all of the benchmark items and the first of every conversation turn.
_PHRASES = """
p AS (
  SELECT DISTINCT array_to_string(list_slice(w, i, i + 4), ' ') AS pattern
  FROM (SELECT w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT string_split(text, ' ') AS w FROM benchmark) WHERE len(w) >= 5)
  UNION
  SELECT array_to_string(list_slice(string_split(text, ' '), 1, 5), ' ') FROM conversations WHERE len(string_split(text, ' ')) >= 5
)"""


def _phrases(spark, folder):
    words = F.split("text", " ")
    every = F.transform(F.sequence(F.lit(1), F.size("w") - 4), lambda i: F.array_join(F.slice("w", i, F.lit(5)), " "))
    items = table(spark, folder, "benchmark").select(words.alias("w")).filter(F.size("w") >= 5).select(F.explode(every).alias("pattern"))
    turns = table(spark, folder, "conversations").select(words.alias("w")).filter(F.size("w") >= 5)
    return items.unionByName(turns.select(F.array_join(F.slice("w", 1, 5), " ").alias("pattern"))).distinct()


@query("phrase_matches", f"WITH {_PHRASES.strip()} SELECT doc_id, pattern FROM documents JOIN p ON contains(text, pattern)")
def phrase_matches(spark, folder):
    """Documents and the phrases they contain, thousands of phrases at once."""
    return PT.matches(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", "text", _phrases(spark, folder))


@query("phrase_redact", f"""WITH {_PHRASES.strip()}, m AS (
  SELECT doc_id, list(pattern ORDER BY length(pattern) DESC, pattern) AS own FROM documents JOIN p ON contains(text, pattern) GROUP BY doc_id)
SELECT d.doc_id, sha256(coalesce(list_reduce(list_prepend(d.text, own), lambda t, s: replace(t, s, '********')), d.text)) AS text_sha256
FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id""")
def phrase_redact(spark, folder):
    """Documents with every phrase replaced."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    clean = PT.redacted(docs, "doc_id", "text", _phrases(spark, folder), "pattern")
    return clean.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
