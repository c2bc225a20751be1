"""Existing drafts meet catalog rows and page specifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import identity as I, parsing as P, text as T
from shelfwise.functions.classify import stone_from_title
from shelfwise.functions.pricing import sheet_price
from shelfwise.operators.keys import HOT_ROWS, lookup
from shelfwise.operators.staging import computed

# Description sentences; {shop} and {category} are filled in
INTROS = (
    "این {category} از مجموعه {shop} با مشخصات واقعی زیر ارائه می‌شود:",
    "در این قطعه {category} از {shop}، جزئیات ساخت و نگین چنین است:",
    "برای مدل حاضر از گروه {category}، مشخصات ثبت‌شده محصول عبارت است از:",
)
CONCLUSIONS = (
    "موجودی این قطعه محدود است؛ وزن دقیق ممکن است اندکی با مقدار درج‌شده تفاوت داشته باشد که از ویژگی‌های طبیعی ساخت محصولات نقره است.",
    "این مدل با موجودی محدود عرضه می‌شود. به‌دلیل ماهیت ساخت زیورآلات نقره، اختلاف جزئی وزن با مقدار تقریبی طبیعی است.",
    "تعداد این قطعه محدود است و وزن نهایی می‌تواند در بازه‌ای اندک با عدد ثبت‌شده تفاوت داشته باشد؛ این موضوع در محصولات نقره طبیعی است.",
)
CATEGORY_TEXT = (("rings", "انگشتر نقره"), ("necklaces", "گردنبند و مدال نقره"), ("bracelets", "دستبند نقره"))
CATEGORY_TEXT_DEFAULT = "زیورآلات نقره"


def latest_by_id(records: DataFrame) -> DataFrame:
    """One catalog row per legacy id, the last one in sheet order.

    Each column is an aggregate of its own, so that columns nobody reads are neither sorted nor shuffled. All of them see the
    rows in the same order and take the same one.
    """
    last = [F.max_by(c, "row_no").alias(c) for c in records.columns if c != "legacy_id"]
    return records.groupBy("legacy_id").agg(*last)


def split_drafts(drafts: DataFrame, records: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(drafts joined to their catalog row, drafts without one). ``drafts``: product_id, legacy_id, public_title, sku, ..."""
    latest = latest_by_id(records).withColumn("__matched", F.lit(True))
    renamed = latest.select(
        "legacy_id", "__matched", *[F.col(c).alias(f"sheet_{c}") for c in latest.columns if c not in ("legacy_id", "__matched")]
    )
    joined = lookup(drafts, renamed, "legacy_id", ["product_id"], hot_rows=hot_rows)
    matched = joined.filter("__matched").drop("__matched")
    missing = joined.filter("__matched is null").select(
        "legacy_id", "product_id", F.lit("SKIP_LEGACY_ID_NOT_IN_EXCEL").alias("action")
    )
    return matched, missing


def enrichment_plan(matched: DataFrame, title_fallback: str = "محصول نقره") -> DataFrame:
    """Titles, SKU agreement and flags of matched drafts. Values the store already has win over the sheet's."""
    def stored(name: str, fallback: str) -> Column:
        return F.coalesce(F.nullif(F.col(name), F.lit("")), F.col(fallback))

    base = computed(
        matched.withColumn("current_sku", stored("sku", "sheet_sku"))
        .withColumn(
            "source_title",
            F.coalesce(
                F.nullif("legacy_original_title", F.lit("")),
                F.nullif("sheet_original_title", F.lit("")),
                F.nullif("public_title", F.lit("")),
                F.col("sheet_title"),
            ),
        )
        .withColumn("old_title", stored("public_title", "sheet_title"))
        .withColumn("title_match", I.title_match(F.col("source_title"))),
        identity=I.cleaned_title(F.col("source_title"), F.col("title_match"), title_fallback),
        code=T.strip(T.normalize_identity_digits(F.col("current_sku"))),
    )
    agreement = I.title_matches_sku(F.col("identity.code"), F.col("code"))
    flags = F.array_distinct(
        F.concat(
            "sheet_review_flags",
            F.array_compact(F.array(F.col("identity.flag"), F.when(agreement == "NO", "SKU_TITLE_MISMATCH"))),
        )
    )
    return base.select(
        "product_id",
        "legacy_id",
        "current_sku",
        "old_title",
        F.col("identity.cleaned").alias("title"),
        (T.normalize_text(F.col("old_title")) != T.normalize_text(F.col("identity.cleaned"))).alias("title_cleanup_applied"),
        F.col("identity.code").alias("title_code"),
        agreement.alias("sku_title_match"),
        F.when((agreement == "NO") | F.col("identity.flag").isNotNull(), "REVIEW").otherwise(F.col("identity.status")).alias("title_status"),
        I.identity_key(F.col("legacy_id"), F.col("code")).alias("identity_key"),
        flags.alias("review_flags"),
        F.when(F.size(flags) > 0, "YES").otherwise("NO").alias("requires_review"),
        F.col("price").alias("current_price"),
        *[F.col(f"sheet_{c}").alias(c) for c in ("category_raw", "category", "sheet_price", "weight", "final_price", "regular_price", "price_source", "computed_price", "rate_used", "stone_class", "seo_fallback_description")],
    )


SPEC_FIELDS = ("category", "weight_display", "band_type", "stone_color", "stone_type", "engraving_type", "silver_purity", "size")


def with_specs(
    records: DataFrame, specs: DataFrame, key: str, spread: list[str], hot_rows: int = HOT_ROWS, counted: DataFrame | None = None
) -> DataFrame:
    """Left join of page specifications (one row per ``key``), absent ones as empty text."""
    prefixed = specs.select(
        key,
        F.lit(True).alias("specs_found"),
        F.col("specs").alias("spec_map"),
        F.col("unknown_labels").alias("spec_unknown"),
        F.col("weight_grams").alias("spec_weight"),
        *[F.col(name).alias(f"spec_{name}") for name in SPEC_FIELDS],
    )
    joined = lookup(records, prefixed, key, spread, hot_rows=hot_rows, counted=counted)
    return joined.withColumns(
        {
            "specs_found": F.coalesce("specs_found", F.lit(False)),
            "spec_unknown": F.coalesce("spec_unknown", F.array().cast("array<string>")),
            **{f"spec_{name}": F.coalesce(f"spec_{name}", F.lit("")) for name in SPEC_FIELDS},
        }
    )


def reconcile(records: DataFrame, shop: str = "") -> DataFrame:
    """Catalog weight wins (mismatch over half a gram is flagged); else the page weight fills in and the price is redone.

    Needs the columns of ``with_specs`` plus title, sku, sheet_price, weight, final_price, ... Flags are appended
    once at the end.
    """
    sheet_weight, page_weight = F.col("weight"), F.col("spec_weight")
    use_page = sheet_weight.isNull() & page_weight.isNotNull()
    redone = computed(
        records.withColumn("__stone", stone_from_title(F.col("title"))),
        redone=sheet_price(F.col("__stone"), F.col("sheet_price"), page_weight),
    )

    def repriced(name: str, new: str) -> Column:
        return F.when(use_page, F.col(f"redone.{new}")).otherwise(F.col(name))

    new_flags = F.array_compact(
        F.array(
            F.when(
                (F.col("spec_category") != "") & (T.normalize_text(F.col("spec_category")) != T.normalize_text(F.col("category_raw"))),
                "SPEC_CATEGORY_MISMATCH",
            ),
            F.when(sheet_weight.isNotNull() & (F.abs(sheet_weight - page_weight) > F.lit("0.5").cast("decimal(3,1)")), "WEIGHT_MISMATCH"),
            F.when(use_page, "LIVE_PAGE_WEIGHT_USED_FOR_PRICING"),
            F.when(use_page & ~F.col("final_price").eqNullSafe(F.col("redone.final_price")), "PRICE_RECALCULATED_FROM_LIVE_WEIGHT"),
            F.when(~F.col("specs_found"), "SPECS_MISSING_SEO_FALLBACK"),
        )
    )
    flags = F.array_distinct(F.concat("review_flags", new_flags))
    out = redone.withColumns(
        {
            "review_flags": flags,
            "weight_source": F.when(sheet_weight.isNotNull(), "EXCEL").when(page_weight.isNotNull(), "LIVE_PAGE").otherwise("MISSING"),
            "price_reconciled": use_page,
            "stone_class": F.when(use_page, F.col("__stone")).otherwise(F.col("stone_class")),
            "rate_used": repriced("rate_used", "rate_used"),
            "computed_price": repriced("computed_price", "computed"),
            "price_source": repriced("price_source", "price_source"),
            "regular_price": repriced("regular_price", "regular_price"),
            "final_price": repriced("final_price", "final_price"),
            "weight": F.coalesce("weight", "spec_weight"),
        }
    ).drop("redone", "__stone")
    return out.withColumns(
        {
            "requires_review": F.when(F.size("review_flags") > 0, "YES").otherwise("NO"),
            "description": description(shop),
            "description_source": F.when(F.col("specs_found"), "SPECS_TEMPLATE").otherwise("SEO_FALLBACK"),
        }
    )


def _labelled(label: str, name: str) -> Column:
    return F.when(F.col(name) != "", F.concat(F.lit(label), F.col(name)))


def description(shop: str) -> Column:
    """Template text chosen by id, a bullet only for fields that are present; the sheet's text without specs."""
    names = F.lit(None)
    for code, words in CATEGORY_TEXT:
        names = F.coalesce(names, F.when(F.col("category") == code, words))
    category = F.coalesce(
        F.nullif("spec_category", F.lit("")), F.nullif(T.display_text(F.col("category_raw")), F.lit("")), names, F.lit(CATEGORY_TEXT_DEFAULT)
    )
    turn = F.pmod(F.col("legacy_id").cast("bigint"), F.lit(3)).cast("int")
    intro = F.get(F.array(*[F.lit(s.replace("{shop}", shop)) for s in INTROS]), turn)
    stone = F.when(
        F.col("spec_stone_type") != "",
        F.concat(
            F.lit("- نوع سنگ: "),
            F.col("spec_stone_type"),
            F.when(F.col("spec_stone_color") != "", F.concat(F.lit("، رنگ "), F.col("spec_stone_color"))).otherwise(""),
        ),
    ).otherwise(_labelled("- رنگ نگین: ", "spec_stone_color"))
    weight = F.when(
        F.col("spec_weight_display") != "",
        F.concat(
            F.lit("- وزن تقریبی: "),
            F.col("spec_weight_display"),
            F.when(F.col("spec_weight").isNotNull() & ~F.col("spec_weight_display").contains("گرم"), " گرم").otherwise(""),
        ),
    )
    extra = F.transform(
        "spec_unknown", lambda label: F.concat(F.lit("- "), label, F.lit(": "), F.try_element_at(F.col("spec_map"), label))
    )
    bullets = F.concat_ws(
        "\n",
        F.when(F.col("spec_silver_purity") != "", F.concat(F.lit("- جنس: نقره عیار "), F.col("spec_silver_purity"), F.lit(" اصل"))),
        stone,
        _labelled("- نوع رکاب: ", "spec_band_type"),
        weight,
        _labelled("- نوع حکاکی: ", "spec_engraving_type"),
        F.coalesce(_labelled("- سایز: ", "spec_size"), F.lit("- سایز: امکان انتخاب سایز دلخواه هنگام ثبت سفارش")),
        extra,
        _labelled("- کد مدل: ", "sku"),
    )
    text = F.concat_ws(
        "\n\n",
        T.display_text(F.col("title")),
        F.replace(intro, F.lit("{category}"), category),
        bullets,
        F.get(F.array(*[F.lit(s) for s in CONCLUSIONS]), turn),
    )
    return F.when(F.col("specs_found"), text).otherwise(
        T.display_text(F.coalesce(F.nullif("seo_fallback_description", F.lit("")), F.col("title")))
    )


def price_update_needed(reconciled: Column, final_price: Column, current_price: Column) -> Column:
    """Only prices redone from page weight, and only when they differ from the store's."""
    return reconciled & final_price.isNotNull() & ~current_price.eqNullSafe(final_price)
