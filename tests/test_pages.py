import pytest
from pyspark.sql import functions as F

from shelfwise.operators import documents as D, enrich as E, pages as P

SITE = "shop.example.com"
BLOCKS = [
    "وزن: ۲۱ گرم · نوع سنگ: یاقوت · رنگ نگین: سرخ · نوع رکاب: دستی · عیار نقره: 925 · سایز: 62 · دسته‌بندی: انگشتر زنانه",
    "سایز: 18 • رنگ نگین: کبود • نوع سنگ: لاجورد • عیار نقره: 925 • وزن: 4.75 • دسته‌بندی: پلاک",
    "عیار نقره: 925\nوزن: ۳۰ گرم\nسایز: آزاد\nنوع سنگ: یشم\nرنگ نگین: سبز",
]
PRODUCTS = {
    4101: '''<html><head><script type="application/ld+json">[{"@type":["Thing","Product"],"name":"بدون نام","offers":[{"lowPrice":"99000000","priceCurrency":"IRT"}]}]</script></head>
<body><nav><a href="/category/9/r/">انگشتر زنانه</a></nav><h1>انگشتر یاقوت کد ۴۱۰۱</h1><p>وزن: ۷٫۲۵ گرم</p><b class="amount">۴٬۸۰۰٬۰۰۰</b><div id="description">ساده و سبک</div><img src="/m/product-images/r1.png?w=9"></body></html>''',
    4102: '''<body><a href="/category/30/n/">گردنبند</a><h1>گردنبند موج کد 4102</h1><ul><li>وزن تقریبی 11 گرم</li></ul><span id="price">2,150,000 تومان</span></body>''',
    4103: '''<a href="/category/5/b/">دستبند</a><h1>دستبند بافت کد ٤١٠٣</h1><script type="application/ld+json">{"@graph":[{"@type":"Product","offers":{"price":"1350000","priceCurrency":"IRR"}}]}</script>
<img data-lazy-src="https://shop.example.com/m/product-images/w.jpeg"><img src="//cdn.example.net/product-images/no.jpeg">''',
}


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")


def test_product_fields(spark):
    walked = P.walk_pages(pages(spark, [(f"https://{SITE}/product/{i}/x/", h) for i, h in PRODUCTS.items()] + [("https://x/y", "<h1>t</h1>")]))
    got = {r.page_id: r for r in P.product_fields(walked, SITE).collect()}
    assert [(got[i].category, got[i].price, got[i].weight, len(got[i].image_urls), got[i].sku) for i in range(3)] == [
        ("rings", 4_800_000, 7.25, 1, "4101"), ("necklaces", 2_150_000, 11.0, 0, "4102"), ("bracelets", 1_350_000, None, 1, "4103")]
    assert got[0].image_urls == [f"https://{SITE}/m/product-images/r1.png"] and got[0].title == "انگشتر یاقوت کد 4101"
    assert got[0].description == "ساده و سبک" and got[2].price_source == "jsonld_irr_label_but_amount_toman_review"
    assert got[3].error == "product URL has no numeric legacy ID"


def test_a_malformed_page_yields_an_error_row(spark):
    rows = [("https://x/1", "<h1>before</h1><![foo[x]]><h1>after</h1>"), ("https://x/2", '<img srcset="/a.jpg ²w, /b.jpg 3w"><h1>fine</h1>'), ("http://[bad", '<a href="x">t</a>'), (None, None)]
    got = {r.page_id: r for r in P.walk_pages(pages(spark, rows)).collect()}
    assert len(got) == 4 and got[0].walk_error.startswith("AssertionError") and got[0].heading == "before"
    assert got[1].walk_error is None and got[1].gallery == ["https://x/b.jpg"] and got[1].heading == "fine"


def test_sections_end_at_the_next_heading_not_at_a_length(spark):
    long = " ".join("متن" for _ in range(2000))
    found = specs_of(spark, f"<h2>مشخصات</h2><p>{long}</p><p>نوع سنگ: یشم</p><p>وزن: 9 گرم</p>")
    assert (found.stone_type, found.weight_grams) == ("یشم", 9)
    value = " ".join("الف" for _ in range(300))
    assert specs_of(spark, f"<h2>مشخصات</h2><p>نوع سنگ: {value}</p>").stone_type == value
    two = specs_of(spark, "<h2>مشخصات</h2><p>وزن: 3</p><h2>مشخصات</h2><p>وزن: 4</p><p>سایز: 7</p>")
    assert (two.weight_grams, two.size) == (4, "7")


def specs_of(spark, html):
    return P.best_specs(P.spec_rows(P.walk_pages(P.may_have_specs(pages(spark, [("https://x/", html)]))))).first()


@pytest.mark.parametrize("i, stone, color, band, weight", [(0, "یاقوت", "سرخ", "دستی", 21), (1, "لاجورد", "کبود", "", 4.75), (2, "یشم", "سبز", "", 30)])
def test_spec_blocks(spark, i, stone, color, band, weight):
    s = specs_of(spark, f"<article><h3>مشخصات فنی</h3><div>{BLOCKS[i]} · بسته:جعبه چوبی</div></article>")
    assert (s.stone_type, s.stone_color, s.band_type, float(s.weight_grams), s.silver_purity) == (stone, color, band, weight, "925")
    assert s.size == ("62", "18", "آزاد")[i] and s.unknown_labels == ["بسته"] and s.specs["بسته"] == "جعبه چوبی"


def test_cells_are_paired_after_their_heading(spark):
    def pairs(html):
        walked = P.walk_pages(pages(spark, [("https://x/", html)]))
        return [tuple(p) for p in walked.select(P.cell_pairs(F.col("cell_runs")).alias("p")).first().p]

    assert pairs("<table><tr><td>a:</td><td>1</td><td>b</td><td>2</td></tr><tr><td>c</td><td></td><td>3</td></tr></table>") == [("a:", "1"), ("b", "2"), ("c", "3")]
    assert pairs("<tr><th>a</th><td>1</td><td>b</td></tr><tr><td>2</td></tr><tr><th>c</th></tr><tr><th></th><td>d</td><td>4</td></tr>") == [("a", "1"), ("b", "2"), ("d", "4")]
    assert pairs("<dl><dd>0</dd><dt>a</dt><dd> </dd><dd>1</dd><dd>2</dd><dt></dt><dd>3</dd><dt>b</dt><dt>c</dt><dd>4</dd></dl>") == [("a", "1"), ("c", "4")]
    assert pairs("<p>none</p>") == [] and pairs("<td>alone</td>") == []


def test_gallery_links_are_encoded(spark):
    walked = P.walk_pages(pages(spark, [(f"https://{SITE}/p/1/", '<img src="/uploads/جام نو.jpg"><img src="http://[x/uploads/a.jpg">')]))
    found = walked.select(P.gallery_urls(F.col("gallery"), F.col("gallery_marked"), SITE).alias("g")).first().g
    assert found == [f"https://{SITE}/uploads/%D8%AC%D8%A7%D9%85%20%D9%86%D9%88.jpg"]


def test_other_spec_sources(spark):
    dl = specs_of(spark, "<h3>مشخصات</h3><dl><dt>نوع سنگ</dt><dd>فیروزه</dd><dt>وزن</dt><dd>۹.۵ گرم</dd><dt>طرح</dt><dd>بیضی</dd></dl>")
    assert (dl.stone_type, float(dl.weight_grams), dl.specs["طرح"]) == ("فیروزه", 9.5, "بیضی")
    assert specs_of(spark, f"<p>{BLOCKS[1]}</p>").stone_type == "لاجورد"
    cut = specs_of(spark, "<h2>مشخصات</h2><p>وزن: 5</p>\n<h2>توضیحات</h2>\n<p>سایز: 9</p>")
    assert cut.size == "" and cut.weight_grams == 5
    assert specs_of(spark, "<p>none</p>") is None and specs_of(spark, "<h2>مشخصات</h2><p>foo: 1</p>") is None
    first = specs_of(spark, "<h2>مشخصات</h2><p>وزن: 5 · وزن: 7</p>")
    assert first.weight_grams == 5


def test_gallery_order(spark):
    html = '''<div id="product-gallery"><a href="/uploads/cup-top.png"><img data-zoom-image="/uploads/cup-top.png" src="/uploads/cup-top-90x90.png"></a>
<img data-srcset="/uploads/cup-side-90x90.png 90w, /uploads/cup-side.png 800w"><img src="/uploads/site-icon.png"><meta name="twitter:image" content="/uploads/cup-back-640x480.png"></div>'''
    walked = P.walk_pages(pages(spark, [(f"https://{SITE}/product/88/cup/", html), ("https://x/", '<img src="/a.jpg">')]))
    got = [r.g for r in walked.select(P.gallery_urls(F.col("gallery"), F.col("gallery_marked"), SITE).alias("g")).collect()]
    assert got == [[f"https://{SITE}/uploads/cup-{n}.png" for n in ("top", "side", "back")], []]


def test_links_sitemaps_and_robots(spark):
    html = f'<a href="/product/1001/a/">x</a><a href="https://{SITE}/product/1002/b/">y</a><a href="/product/1001/a/">z</a><a href="../q?product_id=7&amp;a=1">w</a>'
    page = pages(spark, [(f"https://{SITE}/c/d/", html)])
    assert [r.target for r in P.page_links(page).orderBy("position").collect()] == [f"https://{SITE}/product/1001/a/", f"https://{SITE}/product/1002/b/"]
    every = P.links_for_products(P.page_links(page, P.ANY_HREF), SITE)
    assert {(r.legacy_id, r.target) for r in every.collect()} >= {(7, f"https://{SITE}/c/q?product_id=7&a=1"), (1001, f"https://{SITE}/product/1001/a/")}
    xml = f'<?xml version="1.0"?><urlset xmlns="http://s"><url><loc>https://{SITE}/product/5/x/</loc></url><url><loc>https://{SITE}/sitemap-product.xml</loc></url></urlset>'
    maps = spark.createDataFrame([(1, xml), (2, f"broken https://{SITE}/p/9 <")], "sitemap_id int, xml string")
    assert {r.legacy_id for r in P.sitemap_products(P.sitemap_urls(maps, SITE)).collect()} == {5, 9}
    rules = P.robots_rules("User-agent: *\nDisallow: /admin/\nDisallow: /cart/\nSitemap: x")
    urls = spark.createDataFrame([("https://h/admin/x",), ("https://h/a",), ("https://h",)], "u string")
    assert [r[0] for r in urls.select(P.robots_allowed(F.col("u"), rules)).collect()] == [False, True, True]


def test_discovery_prefers_direct_addresses(spark):
    records = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "row_no bigint, legacy_id bigint")
    extra = spark.createDataFrame([(10, 2, 0, "https://h/s"), (11, 2, 1, "https://h/s"), (11, 3, 0, "https://h/m")], "legacy_id bigint, strategy_rank int, position int, target string")
    found = spark.createDataFrame([("https://h/s",), ("https://h/p/10/",), ("https://h/m",)], "url string")
    got = P.discover(records, P.direct_candidates(records, "https://h").unionByName(extra), found, hot_rows=1)
    assert {(r.legacy_id, r.legacy_url, r.strategy) for r in got.collect()} == {
        (10, "https://h/p/10/", "DIRECT_ID_PATTERN"), (11, "https://h/s", "SITE_SEARCH"), (12, "", "NOT_FOUND")}


def test_reconciliation(spark):
    base = spark.createDataFrame(
        [(3643, "انگشتر نقره", "1058", "انگشتر های خطی", "rings", 7_689_000, None, 7_700_000), (3641, "دستبند نقره", "1059", "دستبند مردانه", "bracelets", 1_000_000, 1.0, 1_000_000), (3000, "x", "1", "", "rings", 5, None, 50_000)],
        "legacy_id bigint, title string, sku string, category_raw string, category string, sheet_price bigint, weight double, final_price bigint",
    ).withColumn("weight", F.col("weight").cast("decimal(12,4)")).withColumn("regular_price", F.col("final_price")).withColumn("price_source", F.lit("EXCEL_ONLY")).withColumn(
        "computed_price", F.lit(None).cast("decimal(38,6)")).withColumn("rate_used", F.lit(650_000).cast("bigint")).withColumn("stone_class", F.lit("uncertain")).withColumn(
        "seo_fallback_description", F.lit("متن سئو")).withColumn("review_flags", F.array().cast("array<string>"))
    specs = P.best_specs(P.spec_rows(P.walk_pages(pages(spark, [("a", f"<h2>مشخصات</h2><p>{BLOCKS[0]}</p>"), ("b", f"<h2>مشخصات</h2><p>{BLOCKS[1]}</p>")])))).withColumn(
        "legacy_id", F.when(F.col("page_id") == 0, 3643).otherwise(3641).cast("bigint"))
    got = {r.legacy_id: r for r in E.reconcile(E.with_specs(base, specs, "legacy_id", ["legacy_id"]), "فروشگاه").collect()}
    one = got[3643]
    assert (one.weight_source, one.computed_price, one.final_price, one.price_reconciled) == ("LIVE_PAGE", 13_650_000, 13_650_000, True)
    assert "PRICE_RECALCULATED_FROM_LIVE_WEIGHT" in one.review_flags and "SPEC_CATEGORY_MISMATCH" in one.review_flags
    assert "- وزن تقریبی: 21 گرم" in one.description and "- کد مدل: 1058" in one.description and "فروشگاه" in one.description
    two = got[3641]
    assert (two.weight, two.final_price, two.requires_review) == (1, 1_000_000, "YES") and "WEIGHT_MISMATCH" in two.review_flags
    assert got[3000].description == "متن سئو" and got[3000].review_flags == ["SPECS_MISSING_SEO_FALLBACK"]


def test_public_sections(spark):
    docs = spark.createDataFrame(
        [(1, "# t\n## Content\n\nline\n## Other\nmore\n\n## SEO:\nhidden"), (2, "nothing"), (3, "## Content\n## content again\nx"), (4, "## Content\n \n## trust notes"), (5, "## Content\r\na")],
        "id int, text string")
    got = {r.id: (r.body, r.error) for r in D.public_sections(docs).collect()}
    assert got == {1: ("line\n## Other\nmore", None), 2: (None, "required section not found"), 3: (None, "duplicate section heading"), 4: (None, "section is empty"), 5: ("a", None)}
    hits = D.marker_hits(spark.createDataFrame([("a […] shop-placeholder",), ("x shop-placeholder",), ("…",)], "text string"), D.placeholder_markers())
    assert [r.marker for r in hits.collect()] == ["[…]", "shop-placeholder"]
    keys = spark.createDataFrame([("ghp_" + "a" * 20,), ("AKIA" + "A" * 16,), ("-----BEGIN RSA PRIVATE KEY-----",), ("ghp_short",)], "text string")
    assert [r.secret_kinds for r in D.secret_hits(keys).collect()] == [["github_token"], ["aws_key"], ["private_key"]]
