"""Catalog profile: counts, coverage, price statistics, id windows, taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import parsing as P, text as T
from shelfwise.functions.classify import infer_taxonomy, matched_labels
from shelfwise.operators.keys import dense_order, repeated_values
from shelfwise.operators.staging import computed

WINDOW_SIZE = 1000


def catalog_rows(cells: DataFrame) -> DataFrame:
    """Typed rows from sheet cells, one ``warning`` list per row; rows without a valid id keep a null id.

    Input columns: row_no, id_cell, title_cell, category_cell, price_cell, availability_cell, active_cell,
    weight_cell.
    """
    numbers = cells.select(
        "row_no",
        P.parse_decimal(F.col("id_cell")).alias("id_number"),
        F.coalesce(F.nullif(T.display_text(F.col("title_cell")), F.lit("")), F.lit(K.UNTITLED)).alias("title"),
        F.nullif(T.display_text(F.col("category_cell")), F.lit("")).alias("category"),
        P.parse_decimal(F.col("price_cell")).alias("price_number"),
        P.parse_decimal(F.col("weight_cell"), decimal_comma=True).alias("weight_number"),
        (~T.is_blank(F.col("weight_cell"))).alias("weight_present"),
        P.parse_decimal(F.col("availability_cell")).alias("availability_number"),
        P.word(F.col("availability_cell")).alias("availability_word"),
        P.parse_decimal(F.col("active_cell")).alias("active_number"),
        P.word(F.col("active_cell")).alias("active_word"),
    )
    rows = computed(
        numbers,
        legacy_id=P.positive_whole(F.col("id_number")),
        price=F.when(F.col("price_number") >= 0, F.col("price_number")),
        weight=P.positive(F.col("weight_number")),
        availability=P.availability_from(F.col("availability_number"), F.col("availability_word")),
        active=P.active_from(F.col("active_number"), F.col("active_word")),
    )
    return rows.select(
        "row_no",
        "legacy_id",
        "title",
        "category",
        "price",
        "weight",
        "weight_present",
        "availability",
        "active",
        F.array_compact(
            F.array(
                F.when(F.col("legacy_id").isNull(), "INVALID_LEGACY_ID"),
                F.when(F.col("price_number") < 0, "NEGATIVE_PRICE"),
                F.when(F.col("weight_number") <= 0, "NON_POSITIVE_WEIGHT"),
            )
        ).alias("warnings"),
    )


def drop_blank_rows(cells: DataFrame) -> DataFrame:
    """Remove rows whose cells are all blank (``row_no`` aside)."""
    present = F.lit(False)
    for name in cells.columns:
        if name != "row_no":
            present = present | ~T.is_blank(F.col(name))
    return cells.filter(present)


def valid_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("legacy_id").isNotNull())


def row_warnings(rows: DataFrame) -> DataFrame:
    return rows.select("row_no", "legacy_id", F.explode("warnings").alias("warning"))


def _price_stats() -> list[Column]:
    return [
        F.count("price").alias("price_count"),
        F.count_if(F.col("price").isNull()).alias("price_missing"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        F.round(F.avg(F.col("price").try_cast("decimal(38,4)")), 2).alias("price_avg"),
    ]


def _weight_stats() -> list[Column]:
    present = F.count_if(F.col("weight_present"))
    total = F.count(F.lit(1))
    return [
        present.alias("weight_present"),
        (total - present).alias("weight_missing"),
        F.when(total > 0, present.cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)")).otherwise(0).alias("weight_coverage"),
    ]


def profile_totals(rows: DataFrame) -> DataFrame:
    """One row with every whole-catalog figure, in one aggregation."""
    valid = F.count_if(F.col("weight").isNotNull())
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct("category").alias("category_count"),
        F.count_if(F.col("category").isNull()).alias("missing_category"),
        F.min("legacy_id").alias("id_min"),
        F.max("legacy_id").alias("id_max"),
        *_weight_stats(),
        valid.alias("weight_valid"),
        (F.count_if(F.col("weight_present")) - valid).alias("weight_present_invalid"),
        *_price_stats(),
        F.count_if(F.col("active")).alias("active"),
        F.count_if(~F.col("active")).alias("inactive"),
        F.count_if(F.col("active").isNull()).alias("unknown"),
    )


def category_counts(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("category").isNotNull()).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def ranked_categories(counts: DataFrame) -> DataFrame:
    """Rank by count descending, then name, without one task seeing every category."""
    return dense_order(counts, [F.desc("n"), F.asc("category")], "rank")


def availability_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("availability").agg(F.count(F.lit(1)).alias("n"))


def id_windows(rows: DataFrame, size: int = WINDOW_SIZE) -> DataFrame:
    """Rows of the ``size`` lowest and highest ids (ties by sheet row), labelled."""
    low = rows.orderBy(F.asc("legacy_id"), F.asc("row_no")).limit(size).withColumn("window", F.lit("lowest"))
    high = rows.orderBy(F.desc("legacy_id"), F.asc("row_no")).limit(size).withColumn("window", F.lit("highest"))
    return low.unionByName(high)


def window_stats(rows: DataFrame, size: int = WINDOW_SIZE) -> DataFrame:
    return id_windows(rows, size).groupBy("window").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("legacy_id").alias("id_min"),
        F.max("legacy_id").alias("id_max"),
        *_price_stats(),
        *_weight_stats(),
    )


def _pattern_names(df: DataFrame, patterns) -> DataFrame:
    names = F.array(*[F.lit(label) for label, _ in patterns])
    return df.sparkSession.range(1).select(F.explode(names).alias("pattern"))


def pattern_categories(counts: DataFrame, patterns) -> DataFrame:
    """(pattern, category, n) for every match; a category may match several patterns."""
    return counts.select(F.explode(matched_labels(F.col("category"), patterns)).alias("pattern"), "category", "n")


def pattern_summary(counts: DataFrame, patterns) -> DataFrame:
    """Categories and products per pattern; patterns without a match keep a zero row."""
    totals = (
        pattern_categories(counts, patterns)
        .groupBy("pattern")
        .agg(F.count(F.lit(1)).alias("category_count"), F.sum("n").alias("product_count"))
    )
    return (
        _pattern_names(counts, patterns)
        .join(totals, "pattern", "left")
        .select(
            "pattern",
            F.coalesce("category_count", F.lit(0)).alias("category_count"),
            F.coalesce("product_count", F.lit(0)).alias("product_count"),
        )
    )


def taxonomy_mapping(counts: DataFrame) -> DataFrame:
    """Source category -> parent, child, facets, over distinct categories rather than products."""
    return counts.withColumn("t", infer_taxonomy(F.col("category"))).select(
        "category", "n", F.col("t.parent").alias("parent"), F.col("t.child").alias("child"), F.col("t.facets").alias("facets")
    )


def taxonomy_tree(counts: DataFrame) -> DataFrame:
    """Products per parent and child, with a total row (null child) per parent."""
    return (
        taxonomy_mapping(counts)
        .rollup("parent", "child")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("parent").isNotNull())
    )


def repeated_ids(rows: DataFrame) -> DataFrame:
    """Every id that occurs more than once, with its count."""
    return repeated_values(rows, F.col("legacy_id"), "legacy_id")


def repeated_ids_shown(rows: DataFrame, shown: int = 20) -> DataFrame:
    """The smallest repeated ids for the report, each with the number of repeated ids in all."""
    repeated = repeated_ids(rows)
    total = repeated.agg(F.count(F.lit(1)).alias("n"))
    return repeated.orderBy("legacy_id").limit(shown).withColumn("repeated_ids", total.scalar())
