"""Stone classes, shop categories, taxonomy and sync modes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise import constants as K
from shelfwise.functions import text as T

_S = f"[{K.WHITESPACE}]*"

# Text patterns per stone class, the first that matches is named in the evidence
NO_STONE = (
    r"بدون\s*(?:نگین|سنگ)",
    r"فاقد\s*(?:نگین|سنگ)",
    r"بی\s*(?:نگین|سنگ)",
)
LARGE_STONE = (
    r"(?:نگین|سنگ)\s*(?:بسیار\s*)?(?:درشت|بزرگ)",
    r"(?:درشت|بزرگ)\s*(?:نگین|سنگ)",
    r"(?:فیروزه|عقیق|اونیکس|یاقوت|زمرد)\s*(?:درشت|بزرگ)",
)
SMALL_STONE = (
    r"(?:نگین|سنگ)\s*(?:ریز|کوچک)",
    r"(?:ریز|کوچک)\s*(?:نگین|سنگ)",
    r"نگین\s*کاری\s*(?:ریز|ظریف)",
)
ANY_STONE = "نگین|سنگ|فیروزه|عقیق|اونیکس|یاقوت|زمرد|agate|turquoise|onyx|gem"
TITLE_NO_STONE = f"(?:بدون|فاقد|بی){_S}(?:نگین|سنگ)"
TITLE_LARGE_STONE = "(?:نگین|عقیق).{0,20}(?:درشت|بزرگ)|(?:درشت|بزرگ).{0,20}(?:نگین|عقیق)"


# Evidence where no pattern is named
EVIDENCE_MENTION = "text mentions a stone but does not establish size"
EVIDENCE_RINGS = "gemstone pricing classification applies only to rings"
EVIDENCE_NONE = "no explicit text or readable image evidence"


def _regex(pattern: str) -> str:
    return pattern.replace("\\s*", _S)


def _any(text: Column, patterns: tuple[str, ...]) -> Column:
    return text.rlike("|".join(map(_regex, patterns)))


def _first_match(text: Column, patterns: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.when(text.rlike(_regex(p)), F.lit(p)) for p in patterns])


def _verdict(stone_class: str, confidence: float, source: str, review: bool, *evidence: Column) -> Column:
    return F.struct(
        F.lit(stone_class).alias("stone_class"),
        F.lit(confidence).alias("confidence"),
        F.lit(source).alias("source"),
        F.lit(review).alias("review"),
        F.array_compact(F.array(*evidence)).alias("evidence"),
    )


def classify_text(*parts: Column) -> Column:
    """struct(stone_class, confidence, source, review, evidence); null when the text says nothing about stones."""
    text = T.classifier_text(*parts)
    none, large, small = _any(text, NO_STONE), _any(text, LARGE_STONE), _any(text, SMALL_STONE)
    hits = none.cast("int") + large.cast("int") + small.cast("int")

    named = (("no_stone", NO_STONE), ("large_stone", LARGE_STONE), ("small_stone", SMALL_STONE))
    each = [F.concat(F.lit(f"matched {name}: "), _first_match(text, patterns)) for name, patterns in named]
    clear = {name: F.concat(F.lit("matched explicit text pattern: "), _first_match(text, patterns)) for name, patterns in named}
    return (
        F.when(hits > 1, _verdict("uncertain", 0.25, "text_conflict", True, *each))
        .when(none, _verdict("no_stone", 0.98, "text", False, clear["no_stone"]))
        .when(large, _verdict("large_stone", 0.92, "text", False, clear["large_stone"]))
        .when(small, _verdict("small_stone", 0.94, "text", False, clear["small_stone"]))
        .when(text.rlike(ANY_STONE), _verdict("uncertain", 0.55, "text_generic", True, F.lit(EVIDENCE_MENTION)))
    )


def classify_images(readable: Column, qualifying: Column) -> Column:
    """Verdict from per-product view counts: two readable, two qualifying, 66 % agreement."""
    agreed = (readable >= 2) & (qualifying >= 2) & (qualifying * 100 >= readable * 66)
    confidence = F.least(F.lit(0.89), F.round(F.lit(0.85) + (qualifying - 2) * F.lit(0.02), 2))
    return F.struct(
        F.when(agreed, "large_stone").otherwise("uncertain").alias("stone_class"),
        F.when(agreed, confidence).when(readable > 0, 0.30).otherwise(0.0).alias("confidence"),
        F.lit("multi_image_heuristic").alias("source"),
        F.when(agreed, False).otherwise(True).alias("review"),
        F.array(F.concat_ws(" ", qualifying.cast("string"), F.lit("of"), readable.cast("string"), F.lit("readable views qualify"))).alias("evidence"),
    )


def classify_product(category: Column, text_parts: list[Column], readable: Column, qualifying: Column, images: Column) -> Column:
    """Rings only; explicit text wins over images, images over nothing. ``evidence`` says what decided."""
    is_ring = F.lower(T.strip(T.text_or_empty(category))) == "rings"
    return F.coalesce(
        F.when(~is_ring, _verdict("uncertain", 1.0, "not_applicable", False, F.lit(EVIDENCE_RINGS))),
        classify_text(*text_parts),
        F.when(images > 0, classify_images(readable, qualifying)),
        _verdict("uncertain", 0.0, "insufficient_evidence", True, F.lit(EVIDENCE_NONE)),
    )


def stone_from_title(title: Column) -> Column:
    return stone_from_text(T.normalize_text(title))


def stone_from_text(text: Column) -> Column:
    """``stone_from_title`` of a title that is already in normal form."""
    return (
        F.when(text.rlike(TITLE_NO_STONE), "no_stone")
        .when(text.rlike(TITLE_LARGE_STONE), "large_stone")
        .otherwise("uncertain")
    )


def sheet_category(raw: Column) -> Column:
    """struct(category, flag): unknown categories count as rings and are flagged."""
    return category_from_text(T.normalize_text(raw))


def category_from_text(text: Column) -> Column:
    """``sheet_category`` of a name that is already in normal form."""
    known = (
        F.when(text.contains("انگشتر"), "rings")
        .when(text.contains("گردنبند") | text.contains("مدال"), "necklaces")
        .when(text.contains("دستبند"), "bracelets")
    )
    return F.struct(
        F.coalesce(known, F.lit("rings")).alias("category"),
        F.when(known.isNull(), "UNKNOWN_CATEGORY_DEFAULTED_TO_RINGS").alias("flag"),
    )


def page_category(raw: Column, title: Column) -> Column:
    """Bracelets first, null when nothing matches."""
    text = F.concat_ws(" ", T.text_or_empty(raw), T.text_or_empty(title))
    return (
        F.when(text.contains("دستبند"), "bracelets")
        .when(text.rlike("گردنبند|مدال|آویز|اویز"), "necklaces")
        .when(text.contains("انگشتر"), "rings")
    )


def pattern_variants(patterns) -> list[tuple[str, list[str]]]:
    """Patterns with their variants normalised the way category text is."""
    def plain(word: str) -> str:
        return " ".join(word.replace(K.ZWNJ, " ").split()).lower()

    return [(label, [plain(v) for v in variants]) for label, variants in patterns]


def matched_labels(category: Column, patterns) -> Column:
    """Labels whose variants occur in the category, in pattern order."""
    text = F.lower(T.normalize_text(category))
    hits = []
    for label, variants in pattern_variants(patterns):
        found = F.lit(False)
        for variant in variants:
            found = found | text.contains(variant)
        hits.append(F.when(found, label))
    return F.array_compact(F.array(*hits))


def infer_taxonomy(category: Column) -> Column:
    """struct(parent, child, facets) of a source category name."""
    text = T.normalize_text(category)
    audiences = matched_labels(text, K.AUDIENCE_PATTERNS)
    gems = matched_labels(text, K.GEMSTONE_PATTERNS)
    styles = matched_labels(text, K.STYLE_PATTERNS)
    audience = F.coalesce(F.get(audiences, 0), F.lit(K.AUDIENCE_DEFAULT))
    gem = F.get(gems, 0)
    # Parent and child names, first rule that applies
    rules = [
        (text.contains("انگشتر"), "انگشتر", audience),
        (text.contains("دستبند"), "دستبند", audience),
        (text.contains("گردنبند") | text.contains("سینه ریز"), "گردنبند و آویز", F.lit("گردنبند")),
        (text.rlike("مدال|آویز|اویز"), "گردنبند و آویز", F.lit("مدال و آویز")),
        (text.contains("زنجیر"), "گردنبند و آویز", F.lit("زنجیر")),
        (text.contains("گوشواره"), "گوشواره", audience),
        (text.rlike("(?:^| )(?:نیم *ست|ست)(?: |$)"), "ست و نیم‌ست", audience),
        (
            text.contains("نگین") | text.contains("سنگ") | (F.size(gems) > 0),
            "سنگ و نگین",
            F.coalesce(gem, F.lit("سایر سنگ‌ها")),
        ),
    ]
    parent, child = F, F
    for condition, parent_name, child_value in rules:
        parent = parent.when(condition, F.lit(parent_name))
        child = child.when(condition, child_value)
    return F.struct(
        parent.otherwise("سایر/نیازمند بررسی").alias("parent"),
        child.otherwise("بررسی دستی").alias("child"),
        F.array_distinct(F.concat(audiences, gems, styles)).alias("facets"),
    )


def sync_pricing_mode(weight: Column, special_gem: Column, stone_value: Column, locked: Column) -> Column:
    has_stone = F.coalesce(stone_value, F.lit(0)) > 0
    has_weight = F.coalesce(weight, F.lit(0)) > 0
    return (
        F.when(F.coalesce(locked, F.lit(False)) | (F.coalesce(special_gem, F.lit(False)) & ~has_stone), K.MODE_MANUAL_LOCKED)
        .when(has_weight & has_stone, K.MODE_WEIGHT_PLUS_STONE)
        .when(has_weight, K.MODE_WEIGHT_ONLY)
        .otherwise(K.MODE_LEGACY_MIRROR)
    )


def sync_stock(stock: Column) -> Column:
    """Exact stock; missing, invalid or negative counts as zero."""
    return F.greatest(F.coalesce(stock.try_cast("bigint"), F.lit(0)), F.lit(0))
