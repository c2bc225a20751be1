"""Word lists, codes, limits and message texts the results are defined by."""

# Digits and letter forms
ASCII_DIGITS = "0123456789"
PERSIAN_DIGITS = "۰۱۲۳۴۵۶۷۸۹"
ARABIC_DIGITS = "٠١٢٣٤٥٦٧٨٩"
ZWNJ = "‌"
# Every character Python's ``\s`` matches, spelled out so Java regular expressions agree.
WHITESPACE = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WHITESPACE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
BLANK_TOKENS = ("", "-", "—", "–", "null", "none", "nan")

# Catalog sheet positions (1-based) and header names
COLUMN_ID = 1
COLUMN_TITLE = 2
COLUMN_CATEGORY = 5
COLUMN_PRICE = 9
COLUMN_PRE_DISCOUNT = 10
COLUMN_STOCK = 11
COLUMN_AVAILABILITY = 12
COLUMN_ACTIVE = 13
COLUMN_WEIGHT = 22
COLUMN_CODE = 27
COLUMN_SEO_TITLE = 28
COLUMN_SEO_DESCRIPTION = 29
PROFILE_MIN_COLUMNS = 22
IMPORT_MIN_COLUMNS = 29
TITLE_HEADERS = ("عنوان محصول", "نام محصول", "عنوان کالا", "نام کالا", "عنوان", "نام")
UNTITLED = "(بدون عنوان)"

# Availability and activity words
IN_STOCK = "موجود"
OUT_OF_STOCK = "ناموجود"
AVAILABILITY_UNKNOWN = "نامشخص"
IN_STOCK_WORDS = ("موجود", "instock", "in_stock", "1", "true", "yes")
OUT_OF_STOCK_WORDS = ("ناموجود", "ناموجوددرانبار", "outofstock", "out_of_stock", "0", "false", "no")
ACTIVE_WORDS = ("true", "yes", "فعال", "بله")
INACTIVE_WORDS = ("false", "no", "غیرفعال", "خیر")

# Category patterns, label -> variants
GEMSTONE_PATTERNS = (
    ("عقیق", ("عقیق",)),
    ("فیروزه", ("فیروزه",)),
    ("حدید", ("حدید",)),
    ("در نجف", ("در نجف", "دُر نجف", "درّ نجف")),
    ("یاقوت", ("یاقوت",)),
    ("زمرد", ("زمرد",)),
    ("زبرجد", ("زبرجد",)),
    ("اونیکس", ("اونیکس", "اونکس")),
    ("شرف‌الشمس", ("شرف الشمس", "شرف‌الشمس")),
    ("نگین/سنگ", ("نگین", "سنگ")),
)
AUDIENCE_PATTERNS = (
    ("مردانه", ("مردانه",)),
    ("زنانه", ("زنانه",)),
    ("بچگانه", ("بچگانه", "کودک")),
    ("اسپرت/مشترک", ("اسپرت", "مشترک", "یونیسکس")),
)
STYLE_PATTERNS = (
    ("خطی", ("خطی", "خط نوشته", "خط‌نوشته")),
    ("قلم‌زنی", ("قلمزنی", "قلم‌زنی")),
    ("شبکه", ("شبکه", "شبکه‌ای")),
    ("رکاب", ("رکاب",)),
    ("حرز", ("حرز",)),
    ("دست‌ساز", ("دست ساز", "دست‌ساز")),
)
AUDIENCE_DEFAULT = "عمومی/نیازمند تعیین"

# Prices and weights (Toman, grams)
STANDARD_RATE = 650_000
LARGE_STONE_RATE = 590_000
LARGE_STONE_MIN_CONFIDENCE = "0.85"
CEILING_STEP = 50_000
NEAREST_STEP = 10_000
MIN_PLAUSIBLE_PRICE = 50_000
MAX_PLAUSIBLE_PRICE = 10_000_000_000
MAX_WEIGHT_GRAMS = 500
CURRENCY = "IRT"
SILVER_PURITY = 925

# Pricing modes and metadata keys (canonical name first, then the historic ones)
MODE_WEIGHT_ONLY = "silver_weight_only"
MODE_WEIGHT_PLUS_STONE = "silver_weight_plus_stone"
MODE_LEGACY_MIRROR = "legacy_mirror"
MODE_MANUAL_LOCKED = "manual_locked"
PRICING_MODES = (MODE_WEIGHT_ONLY, MODE_WEIGHT_PLUS_STONE, MODE_LEGACY_MIRROR, MODE_MANUAL_LOCKED)
MODE_KEYS = ("pricing_mode", "_pricing_mode")
WEIGHT_KEYS = ("silver_weight_grams", "weight_grams", "_silver_weight_grams", "_silver_weight_g")
STONE_VALUE_KEYS = ("stone_fixed_value_toman", "_stone_fixed_value_toman")
LEGACY_PRICE_KEYS = ("legacy_price_toman", "_legacy_price_toman")
MANUAL_PRICE_KEYS = ("manual_price_toman", "_manual_price_toman")
ALIAS_ID_KEYS = ("legacy_id", "_legacy_store_id")

# Product categories
CATEGORIES = ("rings", "necklaces", "bracelets")
CATEGORY_CODES = (("rings", "RNG"), ("necklaces", "NEC"), ("bracelets", "BRC"))
CATEGORY_IDS = (("rings", 17), ("necklaces", 18), ("bracelets", 19))
SKU_CATEGORY_CODES = ("RNG", "NEC", "BRC", "SET", "EAR")
SKU_GENDER_CODES = ("W", "M", "U")
SKU_PREFIX = "SKU"

# Import file columns
IMPORT_COLUMNS = (
    "sku",
    "title_fa",
    "category",
    "weight_grams",
    "silver_purity",
    "stone_type",
    "stone_value_toman",
    "pricing_mode",
    "stock",
    "legacy_price_toman",
    "manual_price_toman",
    "short_description",
    "long_description",
    "image_filenames",
)

# Specification labels -> field
SPEC_LABELS = (
    ("دسته بندی", "category"),
    ("وزن", "weight"),
    ("نوع رکاب", "band_type"),
    ("رنگ نگین", "stone_color"),
    ("نوع سنگ", "stone_type"),
    ("نوع حکاکی", "engraving_type"),
    ("عیار نقره", "silver_purity"),
    ("سایز", "size"),
)
SPEC_HEADING = "مشخصات"
SPEC_LABEL_MAX = 80
SPEC_VALUE_MAX = 500
SPEC_WINDOW = 3000
SPEC_FALLBACK_WINDOW = 2500

# orders
WATCHED_STATUSES = ("processing", "on-hold")
ORDER_POLL_LIMIT = 200
ORDER_LOOKBACK = 50
STATUS_TEXT = (("processing", "در حال پردازش"), ("on-hold", "در انتظار بررسی"))

# Document headings that end the public section
INTERNAL_HEADINGS = ("trust notes", "owner fill later", "internal link suggestions", "seo", "page purpose")

# Committed-secret patterns
SECRET_PATTERNS = (
    ("github_token", "gh[pousr]_[A-Za-z0-9]{20,}"),
    ("aws_key", "AKIA[0-9A-Z]{16}"),
    ("private_key", "-----BEGIN (RSA|OPENSSH|EC) PRIVATE KEY-----"),
)

# Image gate limits
IMAGE_MAX_EDGE = 1600
MAX_MEAN_DRIFT = 6.0
MAX_P95_DRIFT = 20.0
MAX_CHANNEL_DRIFT = 3.0
MIN_DETAIL_RATIO = 0.72
MAX_DETAIL_RATIO = 1.30

# Inventory findings, in report order
ANOMALY_LABELS = (
    "zero_visible",
    "negative_stock",
    "missing_weight_meta",
    "missing_stone_value",
    "mode_no_manage_stock",
    "duplicate_sku",
)
