"""Price rules on exact decimals. Weights keep ten decimal places up to the product, prices are whole Toman (bigint)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise import constants as K
from shelfwise.functions import parsing as P, text as T

MONEY = "decimal(36,10)"

# Warning texts
WARN_CATEGORY = "unsupported or missing category"
WARN_CONFIDENCE = "large-stone confidence below 0.85; higher rate enforced"
WARN_SIZE = "stone size uncertain; higher rate enforced"
WARN_WEIGHT = "weight is missing or implausible"
WARN_PRICE = "legacy Toman price is missing or implausible"
WARN_NO_PRICE = "legacy price unavailable; calculated floor used"
WARN_NO_WEIGHT = "weight unavailable; legacy price retained for review"
WARN_NOTHING = "neither a valid weight nor a valid legacy Toman price exists"
FLAG_ABOVE = "source price significantly above calculated floor"
FLAG_BELOW = "source price significantly below calculated floor"


def round_to_nearest(amount: Column, step: int = K.NEAREST_STEP) -> Column:
    """Half-up to the step; zero or less gives 0, anything positive at least one step."""
    if step <= 0:
        return F.round(amount, 0).cast("bigint")
    units = F.round(amount / F.lit(step).cast("decimal(10,0)"), 0).cast("bigint")
    return F.when(amount <= 0, F.lit(0).cast("bigint")).otherwise(F.greatest(units * step, F.lit(step)).cast("bigint"))


def round_up(amount: Column, step: int = K.CEILING_STEP) -> Column:
    """Ceiling to the step; a negative amount is refused with null."""
    units = F.ceil(amount / F.lit(step).cast("decimal(10,0)")).cast("bigint")
    return F.when(amount >= 0, (units * step).cast("bigint"))


def price_reason(mode: Column, weight: Column, stone_value: Column, legacy_price: Column) -> Column:
    """How a product is priced under its mode, or why it is skipped."""
    known = mode.isin(K.MODE_WEIGHT_ONLY, K.MODE_WEIGHT_PLUS_STONE)
    return (
        F.when(mode == "", "skip-missing-mode")
        .when(mode == K.MODE_MANUAL_LOCKED, "skip-manual-locked")
        .when((mode == K.MODE_LEGACY_MIRROR) & (legacy_price > 0), "mirror-legacy")
        .when(mode == K.MODE_LEGACY_MIRROR, "skip-missing-legacy-price")
        .when(~known, "skip-unknown-mode")
        .when(weight.isNull(), "skip-missing-or-bad-weight")
        .when(mode == K.MODE_WEIGHT_ONLY, "calc-weight")
        .when(stone_value > 0, "calc-weight-stone")
        .otherwise("skip-missing-or-bad-stone")
    )


def mode_price(reason: Column, weight: Column, stone_value: Column, legacy_price: Column, rate: Column) -> Column:
    """New price for a ``price_reason``; null when the product is skipped."""
    by_weight = (weight.try_cast(P.WEIGHT) * rate.try_cast("decimal(12,0)")).try_cast(MONEY)
    return (
        F.when(reason == "mirror-legacy", legacy_price)
        .when(reason == "calc-weight", round_to_nearest(by_weight))
        .when(reason == "calc-weight-stone", F.round(by_weight + stone_value, 0).cast("bigint"))
    )


def delta_percent(old: Column, new: Column) -> Column:
    return F.when((old > 0) & new.isNotNull(), (new - old).cast("double") / old.cast("double") * 100.0).otherwise(F.lit(0.0))


def import_price(mode: Column, weight: Column, stone_value: Column, legacy_price: Column, manual_price: Column, rate: Column) -> Column:
    """Price of an import row; null where an input the mode needs is missing."""
    by_weight = (weight.try_cast(P.WEIGHT) * rate.try_cast("decimal(12,0)")).try_cast(MONEY)
    return (
        F.when(mode == K.MODE_WEIGHT_ONLY, round_to_nearest(by_weight))
        .when(mode == K.MODE_WEIGHT_PLUS_STONE, F.round(by_weight + stone_value, 0).cast("bigint"))
        .when((mode == K.MODE_LEGACY_MIRROR) & (legacy_price > 0), legacy_price)
        .when((mode == K.MODE_MANUAL_LOCKED) & (manual_price > 0), manual_price)
    )


def sheet_price(stone: Column, price: Column, weight: Column) -> Column:
    """struct(rate_used, computed, final_price, regular_price, price_source) for a stone class.

    ``price`` is whole Toman or null, ``weight`` grams or null; the larger of price and weight x rate wins.
    """
    rate = F.when(stone == "large_stone", K.LARGE_STONE_RATE).otherwise(K.STANDARD_RATE)
    computed = F.when(price.isNotNull(), (weight.try_cast(P.WEIGHT) * rate.cast("decimal(7,0)")).try_cast(MONEY))
    final = F.when(price.isNotNull(), round_up(F.greatest(price.cast(MONEY), computed)))
    return F.struct(
        rate.cast("bigint").alias("rate_used"),
        computed.alias("computed"),
        final.alias("final_price"),
        final.alias("regular_price"),
        F.when(price.isNull(), "INVALID_REVIEW")
        .when(weight.isNull(), "EXCEL_ONLY")
        .when(price >= computed, "MAX_EXCEL")
        .otherwise("MAX_CALCULATED")
        .alias("price_source"),
    )


def choose_rate(category: Column, stone_class: Column, confidence: Column) -> Column:
    """struct(rate, effective_class, review, warning). ``confidence`` is an exact decimal."""
    category = F.lower(T.strip(T.text_or_empty(category)))
    stone = F.lower(T.strip(F.coalesce(F.nullif(stone_class, F.lit("")), F.lit("uncertain"))))
    supported = category.isin(*K.CATEGORIES)
    ring = category == "rings"
    sure = confidence >= F.lit(K.LARGE_STONE_MIN_CONFIDENCE).cast("decimal(6,5)")
    large = ring & (stone == "large_stone")
    warning = (
        F.when(~supported, WARN_CATEGORY)
        .when(large & ~sure, WARN_CONFIDENCE)
        .when(ring & ~stone.isin("large_stone", "no_stone", "small_stone"), WARN_SIZE)
    )
    return F.struct(
        F.when(large & sure, K.LARGE_STONE_RATE).otherwise(K.STANDARD_RATE).cast("bigint").alias("rate"),
        F.when(warning.isNotNull(), "uncertain").when(~ring, "not_applicable").otherwise(stone).alias("effective_class"),
        warning.isNotNull().alias("review"),
        warning.alias("warning"),
    )


def difference_flag(legacy: Column, calculated: Column) -> Column:
    """Flag a gap of 30 % or more of the smaller price; null when either price is missing."""
    gap = F.abs(legacy - calculated) * 100 >= F.greatest(F.lit(1), F.least(legacy, calculated)) * 30
    both = legacy.isNotNull() & calculated.isNotNull()
    return F.when(both & gap, F.when(legacy > calculated, FLAG_ABOVE).otherwise(FLAG_BELOW))
