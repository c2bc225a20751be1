"""Sheet rows to priced records, newest-N selection and in-batch first-wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfwise import constants as K
from shelfwise.functions import identity as I, parsing as P, text as T
from shelfwise.functions.classify import category_from_text, stone_from_text
from shelfwise.functions.pricing import sheet_price
from shelfwise.operators.staging import computed


def priced_records(cells: DataFrame, title_fallback: str = "محصول نقره") -> DataFrame:
    """Parse, classify and price every sheet row with a valid id.

    Staged as a few projections so that no parsed value is computed twice and no generated method grows beyond what the
    JVM compiles.
    """
    numbers = cells.select(
        "row_no",
        P.parse_decimal(F.col("id_cell")).alias("id_number"),
        "title_cell",
        T.display_text(F.col("category_cell")).alias("category_raw"),
        P.parse_decimal(F.col("price_cell")).alias("price_number"),
        P.parse_decimal(F.col("pre_discount_cell")).alias("pre_discount_number"),
        P.parse_decimal(F.col("stock_cell")).alias("stock_number"),
        P.parse_decimal(F.col("availability_cell")).alias("availability_number"),
        P.word(F.col("availability_cell")).alias("availability_word"),
        P.parse_decimal(F.col("active_cell")).alias("active_number"),
        P.word(F.col("active_cell")).alias("active_word"),
        P.parse_decimal(F.col("weight_cell"), decimal_comma=True).alias("weight_number"),
        (~T.is_blank(F.col("weight_cell"))).alias("weight_present"),
        "code_cell",
        T.display_text(F.col("seo_title_cell")).alias("seo_title"),
        T.display_text(F.col("seo_description_cell")).alias("seo_description"),
    )
    parsed = computed(
        numbers,
        legacy_id=P.positive_whole(F.col("id_number")),
        sheet_price=P.positive_floor(F.col("price_number")),
        pre_discount_price=P.positive_floor(F.col("pre_discount_number")),
        availability=P.availability_from(F.col("availability_number"), F.col("availability_word")),
        active=P.active_from(F.col("active_number"), F.col("active_word")),
        weight=P.weight_in_range(F.col("weight_number")),
        stock_choice=P.stock_from_number(F.col("stock_number")),
    ).filter(F.col("legacy_id").isNotNull())
    raw_title = F.when(
        T.is_blank(F.col("title_cell")), F.concat(F.lit("محصول "), F.col("legacy_id").cast("string"))
    ).otherwise(T.strip(F.col("title_cell")))
    matched = computed(
        parsed,
        raw_title=raw_title,
        category_text=T.normalize_text(F.col("category_raw")),
        code_digits=I.code_digits(F.col("code_cell")),
    )
    matched = computed(matched, title_match=I.title_match(F.col("raw_title")))
    titled = computed(matched, identity=I.cleaned_title(F.col("raw_title"), F.col("title_match"), title_fallback))
    titled = computed(titled, title_text=T.normalize_text(F.col("identity.cleaned")))
    priced = computed(
        titled,
        sku_choice=I.sku_from_digits(F.col("identity.code"), F.col("code_digits"), F.col("legacy_id")),
        shop=category_from_text(F.col("category_text")),
        stone=stone_from_text(F.col("title_text")),
    )
    priced = computed(priced, decision=sheet_price(F.col("stone"), F.col("sheet_price"), F.col("weight")))
    flags = F.array_distinct(
        F.array_compact(
            F.array(
                F.col("stock_choice.flag"),
                F.col("shop.flag"),
                F.when(F.col("sheet_price").isNull(), "EXCEL_PRICE_MISSING_OR_INVALID"),
                F.col("identity.flag"),
                F.when(F.col("weight_present") & F.col("weight").isNull(), "WEIGHT_PRESENT_BUT_INVALID"),
            )
        )
    )
    fallback_text = F.coalesce(
        F.nullif("seo_description", F.lit("")), F.nullif("seo_title", F.lit("")), F.col("identity.cleaned")
    )
    return priced.select(
        "row_no",
        "legacy_id",
        F.col("identity.cleaned").alias("title"),
        F.col("identity.original").alias("original_title"),
        F.col("identity.code").alias("title_code"),
        F.col("identity.label").alias("title_code_label"),
        F.col("identity.applied").alias("title_cleanup_applied"),
        F.col("identity.status").alias("title_status"),
        "category_raw",
        F.col("shop.category").alias("category"),
        "sheet_price",
        "pre_discount_price",
        "weight",
        F.when(F.col("weight").isNotNull(), "EXCEL").otherwise("MISSING").alias("weight_source"),
        F.col("stock_choice.stock").alias("stock"),
        "availability",
        "active",
        T.raw_trace(F.col("code_cell")).alias("raw_code"),
        F.col("sku_choice.sku").alias("sku"),
        F.col("sku_choice.source").alias("sku_source"),
        I.identity_key(F.col("legacy_id"), F.col("sku_choice.sku")).alias("identity_key"),
        I.title_matches_sku(F.col("identity.code"), F.col("sku_choice.sku")).alias("sku_title_match"),
        "seo_title",
        fallback_text.alias("seo_fallback_description"),
        F.col("stone").alias("stone_class"),
        F.col("decision.rate_used").alias("rate_used"),
        F.col("decision.computed").alias("computed_price"),
        F.col("decision.final_price").alias("final_price"),
        F.col("decision.regular_price").alias("regular_price"),
        F.col("decision.price_source").alias("price_source"),
        flags.alias("review_flags"),
        (F.coalesce(F.col("active"), F.lit(False)) & (F.col("availability") != K.OUT_OF_STOCK)).alias("eligible"),
    )


def select_newest(records: DataFrame, limit: int) -> DataFrame:
    """The newest ``limit`` eligible records with their planned action."""
    if limit < 1:
        raise ValueError("limit must be at least 1")
    chosen = records.filter("eligible").orderBy(F.desc("legacy_id"), F.asc("row_no")).limit(limit)
    order = [F.desc("legacy_id"), F.asc("row_no")]
    by_id = F.row_number().over(Window.partitionBy("legacy_id").orderBy(*order))
    by_sku = F.row_number().over(Window.partitionBy(F.lower("sku")).orderBy(*order))
    return (
        chosen.withColumn("id_turn", by_id)
        .withColumn("sku_turn", by_sku)
        .withColumn(
            "action",
            F.when(F.col("id_turn") > 1, "SKIP_DUPLICATE_BATCH_LEGACY_ID")
            .when(F.col("sku_turn") > 1, "SKIP_DUPLICATE_BATCH_SKU")
            .when(F.col("final_price").isNull(), "SKIP_INVALID_PRICE")
            .otherwise("PLAN_CREATE_DRAFT"),
        )
        .withColumn(
            "review_flags",
            F.array_distinct(
                F.concat(
                    "review_flags",
                    F.array_compact(
                        F.array(
                            F.when(F.col("action") == "SKIP_DUPLICATE_BATCH_LEGACY_ID", "DUPLICATE_BATCH_LEGACY_ID"),
                            F.when(F.col("action") == "SKIP_DUPLICATE_BATCH_SKU", "DUPLICATE_BATCH_SKU"),
                        )
                    ),
                )
            ),
        )
        .drop("id_turn", "sku_turn")
    )


def selection_summary(records: DataFrame, limit: int) -> DataFrame:
    active = F.coalesce(F.col("active"), F.lit(False))
    eligible = F.count_if(F.col("eligible"))
    return records.agg(
        F.count(F.lit(1)).alias("sheet_rows"),
        F.count_if(~active).alias("inactive_skipped"),
        F.count_if(active & (F.col("availability") == K.OUT_OF_STOCK)).alias("unavailable_skipped"),
        eligible.alias("eligible_rows"),
        F.least(eligible, F.lit(limit)).alias("selected_rows"),
    )


def preview(selected: DataFrame, size: int = 20) -> DataFrame:
    """First rows of the plan plus how many more there are."""
    remaining = selected.agg(F.greatest(F.count(F.lit(1)) - size, F.lit(0)).alias("remaining"))
    first = selected.orderBy(F.desc("legacy_id"), F.asc("row_no")).limit(size)
    return first.withColumn("remaining", remaining.scalar())
