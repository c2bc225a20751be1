from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import classify as C, identity as I, media as G, parsing as P, pricing as R, text as T, urls as U


def test_normalisers_differ_on_purpose(value):
    raw = "  كد‌مدل  ۱٢3  "
    assert value(T.normalize_text, raw) == "کد مدل 123"
    assert value(T.normalize_digits, raw) == "  کد‌مدل  123  "
    assert value(T.normalize_identity_digits, raw) == "  كد‌مدل  123  "
    assert value(T.title_whitespace, raw) == "كد‌مدل ۱٢3"
    assert value(T.display_text, " a \t b c ") == "a b c"
    assert value(T.persian_title, " كد ۱0٢ ") == "کد ۱۰۲"
    assert value(lambda a, b: T.classifier_text(a, b), "Aۀ", "ي") == "aه ی"
    assert value(T.normalize_space, "۱ &amp; ٢") == "1 & 2"
    assert value(T.clean_numeric, " ۱۲٬۳۴۵ تومان ") == "12345"
    assert value(T.clean_number, "۷٫۵") == "7.5"


@pytest.mark.parametrize("raw, blank", [("", True), ("—", True), ("null", True), ("NULL", False), (None, True), (" - ", True), ("0", False)])
def test_blank_tokens_are_case_sensitive(value, raw, blank):
    assert value(T.is_blank, raw) is blank


def test_amount_texts(value):
    assert value(lambda c: T.toman_text(c.cast("bigint")), "-2490000") == "-۲,۴۹۰,۰۰۰"
    assert value(lambda c: T.decimal_text(c.cast("decimal(12,4)"), 2), "1234.565") == "1,234.57"
    assert value(lambda c: T.decimal_text(c.cast("decimal(12,4)")), None) == "—"
    assert value(lambda c: T.plain_decimal_text(c.cast("decimal(12,4)")), "16.5000") == "16.5"
    assert value(lambda c: T.redact(c, ["secret1", "abc"]), "x secret1 abc") == "x ******** abc"


@pytest.mark.parametrize(
    "raw, comma, expected",
    [
        ("۲۰۰٬۰۰۰ تومان", False, 200000), ("7,25 گرم", True, Decimal("7.25")), ("7,250", False, 7250), ("1,234,567", True, 1234567),
        ("نامشخص", False, None), ("-5000", False, -5000), ("حدود 12 تا 15", False, 12), ("۱٫۰", True, 1), ("2079000.0000000002", False, Decimal("2079000.0000000002")),
    ],
)
def test_parse_decimal(value, raw, comma, expected):
    got = value(lambda c: P.parse_decimal(c, comma), raw)
    assert got == (None if expected is None else Decimal(expected))


def test_cell_parsing(value):
    assert value(P.parse_id, "۳۶۴۳") == 3643 and value(P.parse_id, "0") is None and value(P.parse_id, "1.5") is None
    assert [value(P.parse_active, x) for x in ("۱", "0", "بله", "خیر", "?")] == [True, False, True, False, None]
    assert [value(P.normalize_availability, x) for x in ("1", "۰", "In Stock", "ناموجود در انبار", "محدود", "")] == [
        "موجود", "ناموجود", "موجود", "ناموجود", "محدود", "نامشخص"]
    assert value(P.parse_weight, "۱٫۰") == 1 and value(P.parse_weight, "501") is None and value(P.parse_weight, "1۶ گرم") == 16
    assert [tuple(value(P.parse_stock, x)) for x in ("۲", None, "-1", "5.7")] == [
        (2, None), (0, "STOCK_MISSING_OR_INVALID"), (0, "STOCK_NEGATIVE_CLAMPED_TO_ZERO"), (5, "STOCK_FRACTION_FLOORED")]
    assert value(P.parse_plausible_toman, "۱۲٬۳۴۵٬۶۷۸ تومان") == 12345678 and value(P.parse_plausible_toman, "49999") is None
    assert [float(value(P.parse_confidence, x)) for x in ("x", "7", "-1", "0.85", None)] == [0, 1, 0, 0.85, 0]
    assert value(P.joined_toman, "1,900,000 تومان") == 1900000
    assert [value(P.safe_int, x) for x in ("5.9", "-5.9", "x", "", "1,000")] == [5, -5, 0, 0, 1000]


TITLES = [
    ("پلاک نقره طرح کبوتر کد 2206", "پلاک نقره طرح کبوتر", "2206", "کد"),
    ("زنجیر بافت ریز کد۲۲۰۷", "زنجیر بافت ریز", "2207", "کد"),
    ("انگشتر یشم عیار 9۲۵ کد: 22۰۸", "انگشتر یشم عیار 9۲۵", "2208", "کد"),
    ("دستبند بافت - کد مدل 2209", "دستبند بافت", "2209", "کد مدل"),
    ("گوشواره حلقه | کد محصول 2210", "گوشواره حلقه", "2210", "کد محصول"),
    ("انگشتر ساده — شناسه کالا 2211", "انگشتر ساده", "2211", "شناسه کالا"),
    ("آویز گل: کد مدل 22۱۲", "آویز گل", "2212", "کد مدل"),
]


@pytest.mark.parametrize("raw, cleaned, code, label", TITLES)
def test_titles_lose_labelled_codes(value, raw, cleaned, code, label):
    got = value(I.clean_title, raw)
    assert (got.cleaned, got.code, got.label, got.applied, got.status) == (cleaned, code, label, True, "CLEANED")
    assert got.original == raw


@pytest.mark.parametrize("raw", ["نقره عیار 925", "انگشتر 925 مردانه", "طرح 12 پر", "گردنبند مدل 2024", "انگشتر نقره عیار 9۲۵"])
def test_meaningful_numbers_stay(value, raw):
    got = value(I.clean_title, raw)
    assert (got.cleaned, got.code, got.applied, got.status) == (raw, "", False, "UNCHANGED")


def test_title_never_becomes_empty(value):
    assert value(lambda c: I.clean_title(c, "fallback"), "").cleaned == "fallback"
    only_code = value(I.clean_title, "کد 1058")
    assert only_code.cleaned == "کد 1058" and only_code.status == "REVIEW" and only_code.flag == "TITLE_CLEANUP_WOULD_EMPTY_TITLE"


def test_identities(value):
    assert value(I.identity_key, "۳۶۴۲", "۱۰۵۸") == "3642:1058" and value(I.identity_key, "", "1") is None
    assert value(I.code_to_sku, "AB-12.7").sku == "AB-12.7"
    local = value(I.code_to_sku, "۱۲۳۴")
    assert (local.code_raw, local.sku, local.normalized) == ("۱۲۳۴", "1234", True)
    made = value(I.code_to_sku, "کد ویژه/الف")
    assert made.sku.startswith("LEGACY-") and made == value(I.code_to_sku, "کد ویژه/الف")
    assert value(I.code_to_sku, " ").reason == "MISSING_CODE"
    assert value(I.extract_code, "کد 5", "شناسه کالا: A-9 ، code 7") == "A-9"
    assert value(I.extract_code, "انگشتر كد: ۵۶.", "code 7") == "۵۶"
    assert value(I.extract_code, "x", "Code #77") == "77" and value(I.extract_code, "x", "y") is None
    picks = [tuple(value(lambda t, c, i: I.derive_sku(t, c, i), *x)) for x in (("1058", "9", "1"), ("", "۱۰۵۹", "2"), ("", "1058.0", "51"), ("", "100000", "3"))]
    assert picks == [("1058", "TITLE_CODE"), ("1059", "COL27_VALIDATED"), ("NM-51", "FALLBACK_LEGACY_ID"), ("NM-3", "FALLBACK_LEGACY_ID")]
    assert value(lambda a, b, c: I.shop_sku(a, b, c, "AB"), " nec", "x", "7") == "AB-NEC-U-7"


def test_base64_text_is_one_line(value):
    import base64

    for text in ("", "کد ویژه/الف", "x" * 500):
        assert value(I.base64_text, text) == base64.b64encode(text.encode()).decode()


def test_stone_text(value):
    def stone(text):
        got = value(C.classify_text, text)
        return got and (got.stone_class, got.confidence, got.review)

    assert stone("انگشتر بدون نگین") == ("no_stone", 0.98, False)
    assert stone("نگین بسیار درشت") == ("large_stone", 0.92, False)
    assert stone("نگین کاری ظریف") == ("small_stone", 0.94, False)
    assert stone("بدون سنگ با نگین ریز") == ("uncertain", 0.25, True)
    assert stone("عقیق") == ("uncertain", 0.55, True) and stone("نقره") is None
    assert value(C.classify_text, "نگین درشت").evidence == [f"matched explicit text pattern: {C.LARGE_STONE[0]}"]
    assert value(C.classify_text, "فاقد سنگ و نگین ریز").evidence == [f"matched no_stone: {C.NO_STONE[1]}", f"matched small_stone: {C.SMALL_STONE[0]}"]
    assert value(C.classify_text, "عقیق").evidence == [C.EVIDENCE_MENTION]

    def product(category, text, images):
        return value(lambda c, t, n: C.classify_product(c, [t], n, n, n), category, text, images)

    assert product("Necklaces", "نگین", 2).evidence == [C.EVIDENCE_RINGS] and product("rings", "x", 0).evidence == [C.EVIDENCE_NONE]
    assert product("rings", "x", 3).evidence == ["3 of 3 readable views qualify"]
    assert value(C.stone_from_title, "انگشتر با نگین درشت عقیق") == "large_stone"
    assert value(C.stone_from_title, "انگشتر فاقد نگین درشت") == "no_stone"


def test_taxonomy_and_categories(value):
    got = value(C.infer_taxonomy, "انگشتر عقیق مردانه")
    assert (got.parent, got.child) == ("انگشتر", "مردانه") and got.facets == ["مردانه", "عقیق"]
    assert value(C.infer_taxonomy, "نیم ست زنانه").parent == "ست و نیم‌ست"
    assert tuple(value(C.infer_taxonomy, "زمرد"))[:2] == ("سنگ و نگین", "زمرد")
    assert tuple(value(C.sheet_category, "سایر زیورآلات")) == ("rings", "UNKNOWN_CATEGORY_DEFAULTED_TO_RINGS")
    assert value(C.page_category, "انگشتر", "دستبند") == "bracelets" and value(C.page_category, "ساعت", "") is None


def test_rounding(value):
    def near(x):
        return value(lambda c: R.round_to_nearest(c.cast("decimal(18,4)")), x)

    assert [near(x) for x in ("425000", "424999", "1", "0", "-5")] == [430000, 420000, 10000, 0, 0]
    assert value(lambda c: R.round_up(c.cast("decimal(18,4)")), "5900001") == 5950000
    assert value(lambda c: R.round_up(c.cast("decimal(18,4)")), "1306500.00") == 1350000
    plan = value(lambda w, h: G.resize_plan(w.cast("int"), h.cast("int")), "3200", "1001")
    assert (plan.width, plan.height) == (1600, 500)


def test_urls(value):
    site = "shop.example.com"
    assert value(lambda u: U.canonical_image_url(u, site), "http://shop.example.com/a/x-300x200.JPG?s=1#t") == "https://shop.example.com/a/x.JPG"
    assert value(lambda u: U.canonical_image_url(u, site), "https://other.example.com/x.jpg") is None
    assert value(U.iri_to_uri, "https://h/محصول/%D9?q=ا&r=1#ب") == "https://h/%D9%85%D8%AD%D8%B5%D9%88%D9%84/%D9?q=%D8%A7&r=1#%D8%A8"
    assert value(U.iri_to_uri, "HTTP://h/a b~*+(c)?x=1+2&y=%41*#") == "http://h/a%20b~%2A%2B%28c%29?x=1%2B2&y=%41%2A"
    assert value(U.iri_to_uri, "//h/é?#é") == "//h/%C3%A9#%C3%A9" and value(U.iri_to_uri, "é:b/c?") == "%C3%A9%3Ab/c"
    assert value(U.iri_to_uri, "") == "" and value(U.iri_to_uri, "http://[h/x") is None
    assert value(U.product_id_in_path, "https://h/p/12") == 12 and value(U.product_id_in_path, "https://h/product/x") is None


def test_media_gates(spark):
    rows = spark.createDataFrame([(10, 10, 100, 100, 200, 200, 10000, 100), (0, 10, 100, 100, 200, 200, 10000, 9000), (10, 10, 20, 100, 200, 200, 39900, 0)], "l int, t int, r int, b int, w int, h int, n int, s int")
    got = [r.g for r in rows.select(G.mask_gate(*[F.col(c) for c in "ltrbwhns"]).alias("g")).collect()]
    assert [g.status for g in got] == ["PASS", "REVIEW", "REJECT"] and len(got[1].warnings) == 2
