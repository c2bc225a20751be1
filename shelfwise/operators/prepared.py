"""Prepared products: classification, safe price, review reasons, import action; report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import parsing as P, pricing as R, text as T
from shelfwise.functions.classify import EVIDENCE_MENTION, EVIDENCE_NONE, classify_product
from shelfwise.operators.importing import blocked_action

# Review texts, and characters of a description shown as the short one
IMAGES_UNCLEAR = "images do not establish stone size with high confidence"
MIXED_TEXT = "conflicting stone patterns in text"
SHORT_LENGTH = 500


def with_safe_price(df: DataFrame, category: str, stone_class: str, confidence: str, weight: str, legacy_price: str) -> DataFrame:
    """Add ``price``: the larger of legacy price and weight x rate, rounded up, with reason, review and warnings.

    The raw text columns are parsed once; each later step reads the parsed columns.
    """
    raw_weight, raw_price = T.strip(T.text_or_empty(F.col(weight))), T.strip(T.text_or_empty(F.col(legacy_price)))
    staged = (
        df.withColumn("__confidence", P.parse_confidence(F.col(confidence)))
        .withColumn("__weight", P.parse_weight_grams(F.col(weight)))
        .withColumn("__legacy", P.parse_plausible_toman(F.col(legacy_price)))
        .withColumn("__rate", R.choose_rate(F.col(category), F.col(stone_class), F.col("__confidence")))
        .withColumn("__raw", (F.col("__weight") * F.col("__rate.rate").cast("decimal(7,0)")).cast(R.MONEY))
    )
    w, legacy, raw = F.col("__weight"), F.col("__legacy"), F.col("__raw")
    selected = F.greatest(legacy.cast(R.MONEY), raw)
    reason = (
        F.when(legacy.isNull() & raw.isNull(), "INVALID_DATA_REVIEW")
        .when(legacy.isNull(), "LEGACY_MISSING_USED_CALCULATED")
        .when(raw.isNull(), "WEIGHT_MISSING_USED_LEGACY_REVIEW")
        .when(legacy > raw, "LEGACY_PRICE_HIGHER")
        .when(raw > legacy, "CALCULATED_FLOOR_HIGHER")
        .otherwise("EQUAL")
    )
    warnings = F.array_distinct(
        F.array_compact(
            F.array(
                F.col("__rate.warning"),
                F.when((raw_weight != "") & w.isNull(), R.WARN_WEIGHT),
                F.when((raw_price != "") & legacy.isNull(), R.WARN_PRICE),
                F.when(legacy.isNull() & raw.isNotNull(), R.WARN_NO_PRICE),
                F.when(legacy.isNotNull() & raw.isNull(), R.WARN_NO_WEIGHT),
                F.when(legacy.isNull() & raw.isNull(), R.WARN_NOTHING),
            )
        )
    )
    price = F.struct(
        F.col("__rate.effective_class").alias("effective_class"),
        F.col("__confidence").alias("confidence"),
        F.col("__rate.rate").alias("rate"),
        w.alias("weight"),
        legacy.alias("legacy_price"),
        F.ceil(raw).cast("bigint").alias("calculated_price"),
        F.ceil(selected).cast("bigint").alias("selected_price"),
        R.round_up(selected).alias("final_price"),
        reason.alias("reason"),
        (F.size(warnings) > 0).alias("review"),
        warnings.alias("warnings"),
    )
    return staged.withColumn("price", price).drop("__confidence", "__weight", "__legacy", "__rate", "__raw")


def prepare(products: DataFrame, qa_run: bool, short_length: int = SHORT_LENGTH) -> DataFrame:
    """Assemble prepared products.

    ``products``: legacy_id, code, sku, title, category, short_description, description, weight_text,
    legacy_price_text, images, missing_images, readable_views, qualifying_views, qa_status, featured_approved,
    review_reasons. A product without a short description shows the first ``short_length`` characters of its description.
    """
    named = (
        products.withColumn("title", T.strip(T.text_or_empty(F.col("title"))))
        .withColumn("category", F.lower(T.text_or_empty(F.col("category"))))
        .withColumn("__description", T.strip(T.text_or_empty(F.col("description"))))
        .withColumn("__short", T.strip(T.text_or_empty(F.col("short_description"))))
        .withColumn(
            "stone",
            classify_product(
                F.col("category"),
                [F.col("title"), F.col("short_description"), F.col("description")],
                F.coalesce("readable_views", F.lit(0)),
                F.coalesce("qualifying_views", F.lit(0)),
                F.coalesce("images", F.lit(0)),
            ),
        )
        .withColumn("__class", F.col("stone.stone_class"))
        .withColumn("__confidence_text", F.col("stone.confidence").cast("string"))
    )
    priced = with_safe_price(named, "category", "__class", "__confidence_text", "weight_text", "legacy_price_text")
    evidence = F.when(
        F.col("stone.review"),
        F.when(F.col("stone.source") == "text_conflict", MIXED_TEXT)
        .when(F.col("stone.source") == "text_generic", EVIDENCE_MENTION)
        .when(F.col("stone.source") == "multi_image_heuristic", IMAGES_UNCLEAR)
        .otherwise(EVIDENCE_NONE),
    )
    qa_failed = F.lit(qa_run) & (F.coalesce("qa_status", F.lit("FAIL")) != "PASS")
    reasons = F.array_distinct(
        F.concat(
            "review_reasons",
            F.array_compact(F.array(evidence)),
            "price.warnings",
            F.array_compact(
                F.array(
                    R.difference_flag(F.col("price.legacy_price"), F.col("price.calculated_price")),
                    F.when(~F.col("category").isin(*K.CATEGORIES), "unsupported category"),
                    F.when(F.col("price.final_price").isNull(), "no safe final price"),
                    F.when(F.coalesce("images", F.lit(0)) == 0, "no archived original images"),
                    F.when(F.coalesce("missing_images", F.lit(0)) > 0, "archived original image missing"),
                    F.when(qa_failed, "optimized media rejected; original selected"),
                )
            ),
        )
    )
    action = blocked_action(
        F.col("price.final_price"),
        F.col("category"),
        F.col("legacy_id"),
        F.col("code"),
        F.col("sku"),
        F.col("images"),
        F.col("missing_images"),
        F.lit(qa_run),
    )
    short = F.coalesce(F.nullif("__short", F.lit("")), F.nullif(F.substring("__description", 1, short_length), F.lit("")), F.col("title"))
    return (
        priced.withColumn("review_reasons", reasons)
        .withColumn("requires_review", F.size("review_reasons") > 0)
        .withColumn("import_action", action)
        .withColumn("short_description", short)
        .withColumn("description", F.coalesce(F.nullif("__description", F.lit("")), F.nullif("short_description", F.lit("")), F.col("title")))
        .withColumn(
            "image_action",
            F.when(~F.lit(qa_run), "NOT_RUN").when(qa_failed, "UNTOUCHED_ORIGINAL_FALLBACK").otherwise("OPTIMIZED_OUTPUT_APPROVED"),
        )
        .withColumn("image_qa_status", F.when(F.lit(qa_run), F.coalesce("qa_status", F.lit("FAIL"))).otherwise("NOT_RUN"))
        .drop("__description", "__short", "__class", "__confidence_text")
    )


def skipped_rows(skipped: DataFrame) -> DataFrame:
    """Refused candidates in the shape of prepared products. ``skipped``: legacy_id, code, sku, url, reason, detail."""
    conflict = F.when(F.col("reason").contains("DUPLICATE") | F.col("reason").contains("CONFLICT"), F.col("reason")).otherwise("")
    return skipped.select(
        "legacy_id",
        "code",
        "sku",
        F.lit("NOT_RUN").alias("image_qa_status"),
        F.lit("NOT_RUN").alias("image_action"),
        conflict.alias("conflict"),
        F.lit(True).alias("requires_review"),
        F.array_compact(F.array(F.nullif("reason", F.lit("")), F.nullif("detail", F.lit("")))).alias("review_reasons"),
        F.lit("SKIP_SCRAPE").alias("import_action"),
    )


def report_rows(prepared: DataFrame, skipped: DataFrame) -> DataFrame:
    """Prepared and refused rows together; fields a row lacks are null."""
    return prepared.unionByName(skipped, allowMissingColumns=True)


def report_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("requires_review")).alias("needing_review"),
        F.count_if(F.col("image_action") == "UNTOUCHED_ORIGINAL_FALLBACK").alias("fallbacks"),
        F.count_if(F.col("import_action") == "CREATE_DRAFT").alias("creatable"),
    )


def sheet_summary(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count_if(F.col("image_status") == "MISSING").alias("missing_images"),
        F.count_if(F.col("description_source") == "SPECS_TEMPLATE").alias("described_from_specs"),
        F.count_if(F.size("review_flags") > 0).alias("needing_review"),
    )


# Report columns in order, with the field each one shows and its text when the field is absent
SHEET_REPORT = (
    ("wp_id", "product_id", ""),
    ("old_public_title", "old_title", ""),
    ("new_public_title", "title", ""),
    ("title_cleanup_applied", "title_cleanup_applied", "False"),
    ("extracted_title_code", "title_code", ""),
    ("current_sku", "sku", ""),
    ("sku_title_match", "sku_title_match", "NOT_APPLICABLE"),
    ("legacy_product_id", "legacy_id", ""),
    ("legacy_raw_code", "raw_code", ""),
    ("legacy_url", "legacy_url", ""),
    ("identity_key", "identity_key", ""),
    ("title_cleanup_status", "title_status", ""),
    ("description_updated", "description_updated", ""),
    ("specs_found_count", "specs_found_count", "0"),
    ("price_changed", "price_changed", "False"),
    ("legacy_id", "legacy_id", ""),
    ("sku", "sku", ""),
    ("sku_source", "sku_source", ""),
    ("title", "title", ""),
    ("category_raw", "category_raw", ""),
    ("category", "category", ""),
    ("weight_grams", "weight", ""),
    ("excel_price_toman", "sheet_price", ""),
    ("pre_discount_price_toman", "pre_discount_price", ""),
    ("computed_price_toman", "computed_price", ""),
    ("final_price_toman", "final_price", ""),
    ("regular_price_toman", "regular_price", ""),
    ("price_source", "price_source", ""),
    ("rate_used", "rate_used", ""),
    ("stone_class", "stone_class", ""),
    ("stone_type", "spec_stone_type", ""),
    ("stone_color", "spec_stone_color", ""),
    ("band_type", "spec_band_type", ""),
    ("silver_purity", "spec_silver_purity", ""),
    ("spec_weight", "spec_weight", ""),
    ("weight_source", "weight_source", "MISSING"),
    ("description_source", "description_source", "SEO_FALLBACK"),
    ("unknown_spec_labels_seen", "spec_unknown", ""),
    ("stock", "stock", "0"),
    ("images_found", "images_found", "0"),
    ("image_status", "image_status", ""),
    ("image_discovery_strategy", "strategy", ""),
    ("action", "action", ""),
    ("review_flags", "review_flags", ""),
    ("wordpress_product_id", "product_id", ""),
)
PREPARED_REPORT = (
    ("legacy_id", "legacy_id", ""),
    ("legacy_code_raw", "code_raw", ""),
    ("legacy_code", "code", ""),
    ("sku", "sku", ""),
    ("product_url", "url", ""),
    ("title", "title", ""),
    ("category", "category", ""),
    ("weight_grams", "price.weight", ""),
    ("legacy_price_toman", "price.legacy_price", ""),
    ("stone_class", "stone.stone_class", ""),
    ("stone_confidence", "stone.confidence", ""),
    ("stone_source", "stone.source", ""),
    ("rate_toman_per_gram", "price.rate", ""),
    ("calculated_price_toman", "price.calculated_price", ""),
    ("selected_pre_round_toman", "price.selected_price", ""),
    ("final_price_toman", "price.final_price", ""),
    ("selection_reason", "price.reason", ""),
    ("image_qa_status", "image_qa_status", ""),
    ("optimized_featured_approved", "featured_approved", "False"),
    ("image_integrity_action", "image_action", ""),
    ("conflict", "conflict", ""),
    ("requires_review", "requires_review", ""),
    ("review_reasons", "review_reasons", ""),
    ("import_action", "import_action", ""),
    ("wordpress_product_id", "product_id", ""),
    ("attachment_ids", "attachment_ids", ""),
)


def report(rows: DataFrame, layout: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """Every report column as text in fixed order: arrays joined, decimals plain, missing values as given."""
    present = [(out, field, default) for out, field, default in layout if field.split(".")[0] in rows.columns]
    types = {out: rows.select(F.col(field)).dtypes[0][1] for out, field, _ in present}

    def cell(out: str, field: str, default: str) -> Column:
        kind = types.get(out)
        if kind is None:
            return F.lit(default).alias(out)
        value = F.col(field)
        if kind.startswith("array<"):
            text = F.concat_ws("," if field == "spec_unknown" else " | ", value)
        elif kind.startswith("decimal"):
            text = T.plain_decimal_text(value)
        elif kind == "boolean":
            text = F.initcap(value.cast("string"))
        else:
            text = value.cast("string")
        return F.coalesce(text, F.lit(default)).alias(out)

    return rows.select(*[cell(*line) for line in layout])


def metadata(prepared: DataFrame, namespace: str, keep_empty: bool = False) -> DataFrame:
    """Store metadata of each prepared product; empty values are dropped unless asked for."""
    def text(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit(""))

    entries = [
        ("pricing_mode", F.lit(K.MODE_MANUAL_LOCKED)),
        ("silver_purity", F.lit(str(K.SILVER_PURITY))),
        ("silver_weight_grams", T.plain_decimal_text(F.col("price.weight"))),
        ("stone_type", F.coalesce("stone.stone_class", F.lit("uncertain"))),
        ("stone_fixed_value_toman", F.lit("0")),
        ("legacy_price_toman", F.col("price.legacy_price")),
        ("manual_price_toman", F.col("price.final_price")),
        ("price_locked", F.lit("1")),
        ("rounding_step_toman", F.lit(str(K.CEILING_STEP))),
        ("legacy_id", F.col("legacy_id")),
        ("_legacy_store_id", F.col("legacy_id")),
        ("_legacy_product_code", F.col("code")),
        (f"{namespace}_requires_review", F.when(F.col("requires_review"), "1").otherwise("0")),
        (f"{namespace}_review_reasons", F.concat_ws(" | ", "review_reasons")),
        (f"{namespace}_rate_toman_per_gram", F.col("price.rate")),
        (f"{namespace}_calculated_floor_toman", F.col("price.calculated_price")),
        (f"{namespace}_price_selection_reason", F.col("price.reason")),
        (f"{namespace}_image_qa_status", F.col("image_qa_status")),
    ]
    pairs = F.create_map(*[part for key, value in entries for part in (F.lit(key), text(value))])
    meta = pairs if keep_empty else F.map_filter(pairs, lambda k, v: v != "")
    return prepared.select("legacy_id", "sku", meta.alias("meta"))
