"""Page extraction: one worker-side tag walk per page, then every rule as DataFrame expressions."""

from __future__ import annotations

import html
import urllib.parse
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from shelfwise import constants as K
from shelfwise.functions import identity as I, parsing as P, text as T, urls as U
from shelfwise.functions.classify import page_category
from shelfwise.functions.htmlwalk import walk_page
from shelfwise.operators.keys import HOT_ROWS, lookup
from shelfwise.operators.staging import computed

PAGE_FIELDS = (
    "page_id bigint, url string, heading string, body_text string, price_parts array<string>, description_text string, "
    "meta_description string, jsonld_name string, jsonld_description string, jsonld_price string, jsonld_currency string, "
    "links array<struct<href:string,text:string>>, photos array<string>, gallery array<string>, gallery_marked boolean, "
    "spec_chunks array<string>, cell_runs array<struct<heading:string,cells:array<string>>>, walk_error string"
)
_STOP = f"(?s)\\n[{K.WHITESPACE}]*(?:توضیحات|نظرات|دیدگاه|محصولات مرتبط)[{K.WHITESPACE}]*\\n.*"
_LABEL_EDGE = " .،؛:：-"
_VALUE_EDGE = " .،؛"
_PAIRS_BLOCK = -1  # label cells come after every numbered section on equal merit
_SLICE = 64

# Image names and paths
_SKIP_NAMES = "logo|icon|avatar|placeholder"
_PRODUCT_PATHS = "product-images|product_images|/products/|/product/|/uploads/"


def walk_pages(pages: DataFrame) -> DataFrame:
    """Raw fields of every page. Rows are taken a few at a time, so a batch of large pages stays small."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(PAGE_FIELDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                rows = batch.slice(start, _SLICE).to_pylist()
                out = [{"page_id": r["page_id"], **walk_page(r["url"], r["html"])} for r in rows]
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return pages.select("page_id", "url", "html").mapInArrow(run, PAGE_FIELDS)


def visible_price(parts: Column) -> Column:
    """Smallest amount of at least 1000 in the price parts."""
    runs = F.flatten(F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit(f"[0-9][0-9,٬{K.WHITESPACE}]{{3,}}"), F.lit(0))))
    amounts = F.transform(runs, lambda r: F.regexp_replace(r, "[^0-9]", "").try_cast("bigint"))
    return F.array_min(F.filter(amounts, lambda a: a >= 1000))


def _jsonld_amount(price: Column) -> Column:
    return F.translate(T.normalize_digits(price), ",٬", "").try_cast("double").try_cast("bigint")


def product_fields(walked: DataFrame, site_host: str, visible_only: bool = False) -> DataFrame:
    """Product fields per page; ``error`` says why a page is not a product page."""
    amount, currency = _jsonld_amount(F.col("jsonld_price")), F.col("jsonld_currency")
    source_tag = (
        F.when(amount.isNull(), "missing")
        .when(currency == "IRT", "jsonld_irt")
        .when(currency == "IRR", "jsonld_irr_label_but_amount_toman_review")
        .otherwise(F.concat(F.lit("jsonld_"), F.coalesce(F.nullif(F.lower(currency), F.lit("")), F.lit("unknown")), F.lit("_review")))
    )
    staged = walked.select(
        "page_id",
        "url",
        F.regexp_extract("url", "/product/([0-9]+)/", 1).alias("legacy_id"),
        F.coalesce(F.nullif("heading", F.lit("")), F.nullif("jsonld_name", F.lit(""))).alias("title"),
        F.coalesce(
            F.get(F.transform(F.filter("links", lambda x: x["href"].contains("/category/") & (x["text"] != "")), lambda x: x["text"]), 0),
            F.lit(""),
        ).alias("raw_category"),
        visible_price(F.col("price_parts")).alias("visible"),
        amount.alias("jsonld_amount"),
        source_tag.alias("jsonld_source"),
        F.regexp_extract(
            "body_text",
            f"وزن(?:[{K.WHITESPACE}]+تقریبی)?[{K.WHITESPACE}]*[:：]?[{K.WHITESPACE}]*([0-9]+(?:[٫.][0-9]+)?)",
            1,
        ).alias("weight_text"),
        F.coalesce(
            F.nullif("description_text", F.lit("")), F.nullif("jsonld_description", F.lit("")), F.col("meta_description")
        ).alias("description"),
        F.col("meta_description").alias("short_description"),
        "body_text",
        photo_urls(F.col("photos"), site_host).alias("image_urls"),
    )
    if visible_only:
        price, source = F.col("visible"), F.when(F.col("visible").isNotNull(), "visible_price_toman").otherwise("missing_visible_toman_review")
    else:
        price = F.coalesce("visible", "jsonld_amount")
        source = F.when(F.col("visible").isNotNull(), "visible_price").otherwise(F.col("jsonld_source"))
    priced = staged.withColumns({"price": price, "price_source": source})
    coded = computed(priced, code_text=I.extract_code(F.col("title"), F.col("body_text")))
    coded = computed(coded, identity=I.code_to_sku(F.col("code_text")), category=page_category(F.col("raw_category"), F.col("title")))
    return coded.select(
        "page_id",
        "url",
        "legacy_id",
        "title",
        "raw_category",
        "category",
        "price",
        "price_source",
        F.translate("weight_text", "٫", ".").try_cast("double").alias("weight"),
        "description",
        "short_description",
        "image_urls",
        F.col("identity.code").alias("code"),
        F.col("identity.code_raw").alias("code_raw"),
        F.col("identity.sku").alias("sku"),
        F.col("identity.reason").alias("sku_reason"),
        F.when(F.col("legacy_id") == "", "product URL has no numeric legacy ID")
        .when(F.col("title").isNull(), "no product title found")
        .alias("error"),
    )


def photo_urls(photos: Column, site_host: str) -> Column:
    """Same-host product photos without query, first-seen order."""
    own = F.filter(photos, lambda u: (U.host(u) == site_host) & U.path(u).contains("product-images"))
    return F.array_distinct(F.transform(own, lambda u: F.concat(F.lit("https://"), U.authority(u), U.path(u))))


def gallery_urls(gallery: Column, marked: Column, site_host: str) -> Column:
    """Canonical gallery in page order: product paths win, others only on pages marked as a product."""
    encoded = F.transform(gallery, U.iri_to_uri)
    canonical = F.array_distinct(F.array_compact(F.transform(encoded, lambda u: U.canonical_image_url(u, site_host))))
    wanted = F.filter(canonical, lambda u: ~F.lower(U.base_name(U.path(u))).rlike(_SKIP_NAMES))
    targeted = F.filter(wanted, lambda u: F.lower(U.path(u)).rlike(_PRODUCT_PATHS))
    other = F.filter(wanted, lambda u: ~F.lower(U.path(u)).rlike(_PRODUCT_PATHS))
    none = F.array().cast("array<string>")
    return F.when(F.size(targeted) > 0, targeted).when(marked, other).otherwise(none)


def split_spec_text(chunk: Column) -> Column:
    """Segments of a specification block: middle dots, bullets and line ends separate them."""
    dots = F.replace(chunk, F.lit("•"), F.lit("·"))
    return F.split(dots, f"[{K.WHITESPACE}]*·[{K.WHITESPACE}]*|[\\r\\n]+")


def cell_pairs(runs: Column) -> Column:
    """Labels and values of tables and description lists: a heading cell and the cells after it, two by two."""
    def paired(run: Column) -> Column:
        cells = F.concat(F.filter(F.array(run["heading"]), lambda heading: heading != ""), run["cells"])
        labels, values = F.filter(cells, lambda _, i: i % 2 == 0), F.filter(cells, lambda _, i: i % 2 == 1)
        both = F.zip_with(labels, values, lambda label, value: F.struct(label.alias("label"), value.alias("value")))
        return F.filter(both, lambda pair: pair["value"].isNotNull())

    return F.flatten(F.transform(runs, paired))


def _clean_pairs(rows: DataFrame, label_max: int | None, value_max: int | None) -> DataFrame:
    """Normalised labels and values; longer ones than asked for are left out."""
    label = F.trim(T.normalize_text(F.col("raw_label")), F.lit(_LABEL_EDGE))
    rest = F.trim(F.trim(F.substring(label, F.lit(len(K.SPEC_HEADING) + 1), F.length(label))), F.lit(_LABEL_EDGE))
    cleaned = computed(
        rows,
        label=F.when(label.startswith(K.SPEC_HEADING), rest).otherwise(label),
        value=F.trim(T.normalize_text(F.col("raw_value")), F.lit(_VALUE_EDGE)),
    )
    return (
        cleaned.filter(
            (F.col("label") != "")
            & (F.col("value") != "")
            & (F.lit(True) if label_max is None else F.length("label") <= label_max)
            & (F.lit(True) if value_max is None else F.length("value") <= value_max)
        )
        .select("page_id", "block", "position", "label", "value")
    )


def may_have_specs(pages: DataFrame) -> DataFrame:
    """Pages with a heading word, a known label or label cells; the others are dropped before any tag walk."""
    return pages.filter(F.col("html").rlike(f"{K.SPEC_HEADING}|وزن|بندی|نوع رکاب|نوع سنگ|عیار نقره|(?i:<(?:td|dd)[\\s>])|&(?:amp;)?#"))


def spec_rows(walked: DataFrame, label_max: int | None = K.SPEC_LABEL_MAX, value_max: int | None = None) -> DataFrame:
    """(page_id, block, position, label, value) of every candidate block; the walked pages are read once.

    A label of more than ``label_max`` characters is prose with a colon in it, not a label; values have no limit by default.
    """
    chunks = F.flatten(
        F.transform(
            "spec_chunks",
            lambda chunk, block: F.transform(
                split_spec_text(F.regexp_replace(chunk, _STOP, "")),
                lambda segment, i: F.struct(
                    block.alias("block"), i.alias("position"), F.lit(None).cast("string").alias("label"), segment.alias("value")
                ),
            ),
        )
    )
    cells = F.transform(
        cell_pairs(F.col("cell_runs")),
        lambda pair, i: F.struct(
            F.lit(_PAIRS_BLOCK).alias("block"), i.alias("position"), pair["label"].alias("label"), pair["value"].alias("value")
        ),
    )
    entries = walked.select("page_id", F.inline(F.concat(chunks, cells)))
    segments = computed(entries, segment=T.normalize_text(F.col("value")))
    is_text = F.col("label").isNull()
    parted = segments.filter(~is_text | F.col("segment").rlike("[:：]")).select(
        "page_id",
        "block",
        "position",
        F.when(is_text, F.regexp_extract("segment", "^(.*?)[:：]", 1)).otherwise(F.col("label")).alias("raw_label"),
        F.when(is_text, F.regexp_extract("segment", "^.*?[:：](.*)$", 1)).otherwise(F.col("value")).alias("raw_value"),
    )
    return _clean_pairs(parted, label_max, value_max)


def best_specs(rows: DataFrame) -> DataFrame:
    """One row of specifications per page: the block with most known labels, then most labels, then the first.

    All three steps group by page, so the rows are shuffled once.
    """
    known_labels = [label for label, _ in K.SPEC_LABELS]
    labels = (
        rows.repartition("page_id")
        .groupBy("page_id", "block", "label")
        .agg(F.min_by("value", "position").alias("value"), F.min("position").alias("position"))
    )
    is_known = F.col("label").isin(*known_labels)
    entry = F.struct("position", "label", "value")
    blocks = labels.groupBy("page_id", "block").agg(
        F.count_if(is_known).alias("known"),
        F.count(F.lit(1)).alias("total"),
        F.sort_array(F.collect_list(entry)).alias("entries"),
    )
    best = (
        blocks.groupBy("page_id")
        .agg(F.max_by(F.struct("known", "entries"), F.struct("known", "total", F.when(F.col("block") >= 0, -F.col("block")).otherwise(F.lit(-(1 << 31)).cast("bigint")))).alias("best"))
        .filter(F.col("best.known") >= 1)
    )
    specs = best.select(
        "page_id",
        F.map_from_entries(F.transform("best.entries", lambda e: F.struct(e["label"], e["value"]))).alias("specs"),
        F.transform("best.entries", lambda e: e["label"]).alias("labels"),
    )
    fields = [
        F.coalesce(F.try_element_at("specs", F.lit(label)), F.lit("")).alias("weight_display" if name == "weight" else name)
        for label, name in K.SPEC_LABELS
    ]
    unknown = F.array_except("labels", F.array(*[F.lit(label) for label in known_labels]))
    return specs.select("page_id", "specs", *fields, unknown.alias("unknown_labels")).withColumn(
        "weight_grams", P.parse_weight(F.col("weight_display"))
    )


def unknown_label_counts(specs: DataFrame) -> DataFrame:
    return specs.select(F.explode("unknown_labels").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@F.pandas_udf(StringType())
def resolve_link(base: pd.Series, link: pd.Series) -> pd.Series:
    """Entity-decoded link resolved against its page."""
    def one(b: str, x: str) -> str | None:
        try:
            return urllib.parse.urljoin(b, html.unescape(x))
        except ValueError:
            return None

    return pd.Series([one(b, x) for b, x in zip(base, link)])


def raw_links(pages: DataFrame, pattern: str) -> DataFrame:
    """(page_id, url, position, link) for every ``href`` the pattern's first group captures; JVM side only."""
    found = F.regexp_extract_all("html", F.lit(pattern), F.lit(1))
    return pages.select("page_id", "url", F.posexplode(found).alias("position", "link"))


ANY_HREF = "(?i)href=[\"']([^\"']+)[\"']"
PRODUCT_HREF = "href=[\"']([^\"']*/product/[0-9]+/[^\"']*)[\"']"


def page_links(pages: DataFrame, pattern: str = PRODUCT_HREF) -> DataFrame:
    """Resolved links per page, each once, with the position of its first use."""
    resolved = raw_links(pages, pattern).withColumn("target", resolve_link("url", "link"))
    return resolved.filter(F.col("target").isNotNull()).groupBy("page_id", "target").agg(F.min("position").alias("position"))


def links_for_products(links: DataFrame, site_host: str) -> DataFrame:
    """Same-host links with the product id they point at (path or ``product_id`` parameter), https, no fragment."""
    target = F.col("target")
    by_query = F.regexp_extract(U.query(target), "(?:^|&)product_id=([0-9]+)(?:&|$)", 1).try_cast("bigint")
    own = links.filter(U.host(target) == site_host).withColumn("legacy_id", F.coalesce(U.product_id_in_path(target), by_query))
    q = U.query(target)
    clean = F.concat(F.lit("https://"), U.authority(target), U.path(target), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    return own.filter(F.col("legacy_id").isNotNull()).withColumn("target", clean)


def sitemap_urls(sitemaps: DataFrame, site_host: str) -> DataFrame:
    """(sitemap_id, position, target) of every ``loc``; bare same-host urls where the file has no such tags."""
    locs = F.regexp_extract_all("xml", F.lit("<(?:[A-Za-z0-9_-]+:)?loc>\\s*([^<]*?)\\s*</"), F.lit(1))
    bare = F.regexp_extract_all("xml", F.lit("(https://" + site_host.replace(".", "\\.") + "/[^<\\s]+)"), F.lit(1))
    found = F.when(F.size(locs) > 0, locs).otherwise(bare)
    distinct = F.array_distinct(F.transform(found, T.unescape_basic_entities))
    return sitemaps.select("sitemap_id", F.posexplode(distinct).alias("position", "target"))


def sitemap_products(locations: DataFrame) -> DataFrame:
    """Product pages listed in sitemaps, by id; nested sitemap files are left out."""
    nested = F.lower("target").endswith(".xml") | F.lower("target").contains("sitemap")
    return (
        locations.filter(~nested)
        .withColumn("legacy_id", U.product_id_in_path(F.col("target")))
        .filter(F.col("legacy_id").isNotNull())
    )


# Lookup strategies in order
STRATEGIES = ("DIRECT_ID_PATTERN", "SITE_SEARCH", "SITEMAP_CACHE")


def direct_candidates(records: DataFrame, base_url: str) -> DataFrame:
    """The four direct addresses of a product id."""
    id_text = F.col("legacy_id").cast("string")
    forms = [("/product/", "/"), ("/product/", ""), ("/p/", "/"), ("/?product_id=", "")]
    addresses = F.array(*[F.concat(F.lit(base_url + head), id_text, F.lit(tail)) for head, tail in forms])
    return records.select("legacy_id").distinct().select(
        "legacy_id", F.lit(1).alias("strategy_rank"), F.posexplode(addresses).alias("position", "target")
    )


def discover(records: DataFrame, candidates: DataFrame, found_pages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """First candidate address per record whose page has product assets, and the strategy that found it.

    ``candidates``: legacy_id, strategy_rank, position, target. ``found_pages``: url of pages with assets.
    """
    stored = found_pages.select(F.col("url").alias("target")).distinct().withColumn("stored", F.lit(True))
    hits = candidates.join(stored, "target")
    best = (
        hits.groupBy("legacy_id")
        .agg(F.min(F.struct("strategy_rank", "position", "target")).alias("hit"))
        .select("legacy_id", F.col("hit.strategy_rank").alias("hit_rank"), F.col("hit.target").alias("hit_target"))
    )
    names = F.array(*[F.lit(name) for name in STRATEGIES])
    return lookup(records, best, "legacy_id", ["row_no"], hot_rows=hot_rows).select(
        *records.columns,
        F.coalesce(F.col("hit_target"), F.lit("")).alias("legacy_url"),
        F.coalesce(F.get(names, F.col("hit_rank") - 1), F.lit("NOT_FOUND")).alias("strategy"),
    )


def robots_rules(robots_txt: str) -> list[tuple[bool, str]]:
    """(allowed, path prefix) rules for all agents, in file order. One small text file, read on the driver."""
    rules: list[tuple[bool, str]] = []
    applies = False
    for line in robots_txt.splitlines():
        name, _, value = line.split("#", 1)[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "user-agent":
            applies = value == "*"
        elif applies and name in ("allow", "disallow"):
            rules.append((name == "allow" or not value, value))
    return rules


def robots_allowed(url: Column, rules: list[tuple[bool, str]]) -> Column:
    """First rule whose prefix matches decides; no match allows."""
    target = F.concat(
        F.coalesce(F.nullif(U.path(url), F.lit("")), F.lit("/")),
        F.when(U.query(url) != "", F.concat(F.lit("?"), U.query(url))).otherwise(""),
    )
    verdicts = [F.when(target.startswith(prefix), F.lit(allowed)) for allowed, prefix in rules]
    return F.coalesce(*verdicts, F.lit(True))
