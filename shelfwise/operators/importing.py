"""CSV import: row rules, cross-row rules, batch gate, decisions, image presence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import parsing as P, text as T
from shelfwise.functions.pricing import import_price
from shelfwise.operators.dedup import greedy_accept
from shelfwise.operators.keys import HOT_ROWS, lookup, mark_repeats
from shelfwise.session import cut_lineage

IMAGE_NAME = "(?i)^[A-Za-z0-9][A-Za-z0-9._-]*\\.(?:jpe?g|png|webp)$"
IMAGE_MESSAGE = "image_filenames accepts basename-only JPG/JPEG/PNG/WebP names separated by |"


def missing_columns(df: DataFrame, required=K.IMPORT_COLUMNS) -> list[str]:
    return [name for name in required if name not in df.columns]


def _field(name: str) -> Column:
    return T.strip(T.text_or_empty(F.col(name)))


def _whole(name: str) -> Column:
    text = T.clean_number(F.col(name))
    return F.when(text.rlike("^[0-9]+$"), text).try_cast("bigint")


def _whole_error(name: str, required: bool = False) -> Column:
    text = T.clean_number(F.col(name))
    error = F.when((text != "") & ~text.rlike("^[0-9]+$"), f"{name} must be a non-negative integer")
    return F.coalesce(F.when(text == "", f"{name} is required"), error) if required else error


def _decimal_error(name: str) -> Column:
    text = T.clean_number(F.col(name))
    number = text.try_cast(P.DECIMAL)
    return (
        F.when((text != "") & number.isNull(), f"{name} must be a decimal number")
        .when(number < 0, f"{name} must be a non-negative decimal")
    )


def image_list(raw: Column) -> Column:
    """Trimmed, non-empty names of a ``|`` separated list."""
    return F.filter(F.transform(F.split(T.text_or_empty(raw), "\\|"), T.strip), lambda name: name != "")


def _sku_pattern(prefix: str) -> str:
    return f"^{prefix}-(RNG|NEC|BRC)-(W|M|U)-[0-9]{{4,}}$"


def _typed(raw: DataFrame) -> DataFrame:
    return raw.select(
        "row_number",
        F.upper(_field("sku")).alias("sku"),
        _field("title_fa").alias("title_fa"),
        F.lower(_field("category")).alias("category"),
        T.clean_number(F.col("weight_grams")).try_cast(P.DECIMAL).alias("weight"),
        _whole("silver_purity").alias("purity"),
        _field("stone_type").alias("stone_type"),
        _whole("stone_value_toman").alias("stone_value"),
        _field("pricing_mode").alias("mode"),
        F.when(T.clean_number(F.col("stock")) == "", F.lit(1).cast("bigint")).otherwise(_whole("stock")).alias("stock_level"),
        _whole("legacy_price_toman").alias("legacy_price"),
        _whole("manual_price_toman").alias("manual_price"),
        _field("short_description").alias("short_description"),
        _field("long_description").alias("long_description"),
        image_list(F.col("image_filenames")).alias("images"),
        F.coalesce(
            _decimal_error("weight_grams"),
            _whole_error("stone_value_toman"),
            _whole_error("legacy_price_toman"),
            _whole_error("manual_price_toman"),
            _whole_error("stock"),
        ).alias("number_error"),
        _whole_error("silver_purity", required=True).alias("purity_error"),
    )


def validate_rows(raw: DataFrame, prefix: str = K.SKU_PREFIX, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Typed rows with the first failing rule in ``error`` (null when the row is fine).

    ``raw`` holds the import columns as text and a unique ascending ``row_number``. A SKU or an image name
    belongs to the first row that passes the row rules; later rows that use it fail.
    """
    typed = _typed(raw)
    code_of = F.create_map(*[F.lit(v) for pair in K.CATEGORY_CODES for v in pair])
    pattern = _sku_pattern(prefix)
    before_repeat = (
        F.when(F.col("sku").contains("SAMPLE"), "SAMPLE row detected; replace sample SKU/content before import")
        .when(~F.col("sku").rlike(pattern), f"sku must match {prefix}-(RNG|NEC|BRC)-(W|M|U)-NNNN")
    )
    weight_mode = F.col("mode").isin(K.MODE_WEIGHT_ONLY, K.MODE_WEIGHT_PLUS_STONE)
    names_ok = F.forall("images", lambda name: name.rlike(IMAGE_NAME))
    after_repeat = F.coalesce(
        F.when(F.col("title_fa") == "", "title_fa is required"),
        F.when(F.col("short_description") == "", "short_description is required"),
        F.when(F.col("long_description") == "", "long_description is required"),
        F.when(~F.col("category").isin(*K.CATEGORIES), "category must be rings, necklaces, or bracelets"),
        F.when(
            F.regexp_extract("sku", pattern, 1) != F.try_element_at(code_of, F.col("category")),
            "SKU category code does not match category column",
        ),
        F.col("purity_error"),
        F.when(F.col("purity") != K.SILVER_PURITY, "silver_purity must equal 925"),
        F.when(~F.col("mode").isin(*K.PRICING_MODES), "pricing_mode is not one of the four official modes"),
        F.col("number_error"),
        F.when(
            weight_mode & ~F.coalesce(F.col("weight") > 0, F.lit(False)),
            "weight_grams must be positive for weight pricing modes",
        ),
        F.when(
            (F.col("mode") == K.MODE_WEIGHT_PLUS_STONE) & (F.col("stone_type") == ""),
            "stone_type is required for silver_weight_plus_stone",
        ),
        F.when(
            (F.col("mode") == K.MODE_WEIGHT_PLUS_STONE) & ~F.coalesce(F.col("stone_value") > 0, F.lit(False)),
            "stone_value_toman must be positive for silver_weight_plus_stone",
        ),
        F.when(
            (F.col("mode") == K.MODE_LEGACY_MIRROR) & ~F.coalesce(F.col("legacy_price") > 0, F.lit(False)),
            "legacy_price_toman must be positive for legacy_mirror",
        ),
        F.when(
            (F.col("mode") == K.MODE_MANUAL_LOCKED) & ~F.coalesce(F.col("manual_price") > 0, F.lit(False)),
            "manual_price_toman must be positive for manual_locked",
        ),
        F.when(~names_ok, IMAGE_MESSAGE),
        F.when(F.size(F.array_distinct("images")) < F.size("images"), "duplicate image filename"),
    )
    # Claims, repeats and image reuse all read the ruled rows; they are written once instead of being parsed again.
    ruled = cut_lineage(typed.withColumn("early_error", before_repeat).withColumn("late_error", after_repeat))
    claims = (
        ruled.filter(F.col("early_error").isNull() & F.col("late_error").isNull())
        .groupBy("sku")
        .agg(F.min("row_number").alias("claimed_by"))
    )
    checked = lookup(ruled, claims, "sku", ["row_number"], hot_rows=hot_rows)
    repeated = F.when(F.col("claimed_by") < F.col("row_number"), F.concat(F.lit("duplicate SKU in CSV: "), F.col("sku")))
    rowwise = cut_lineage(checked.withColumn("row_error", F.coalesce("early_error", repeated, "late_error")))
    reused = reused_images(rowwise.filter(F.col("row_error").isNull()), hot_rows=hot_rows)
    return (
        rowwise.join(reused, "row_number", "left")
        .withColumn(
            "error",
            F.coalesce(
                "row_error",
                F.when(
                    F.col("reused_images").isNotNull(),
                    F.concat(F.lit("image filename(s) reused by another CSV row: "), F.concat_ws(", ", "reused_images")),
                ),
            ),
        )
        .drop("early_error", "late_error", "row_error", "claimed_by", "number_error", "purity_error", "reused_images")
    )


def reused_images(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(row_number, reused_images) for rows that list an image an earlier row already uses."""
    names = rows.select("row_number", F.posexplode("images").alias("position", "image"))
    owners = names.groupBy("image").agg(F.min("row_number").alias("owner"))
    return (
        lookup(names, owners, "image", ["row_number", "position"], hot_rows=hot_rows)
        .filter(F.col("owner") < F.col("row_number"))
        .groupBy("row_number")
        .agg(F.sort_array(F.collect_list(F.struct("position", "image"))).alias("hits"))
        .select("row_number", F.col("hits.image").alias("reused_images"))
    )


def batch_gate(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, errors): one failing row refuses the whole batch."""
    errors = validated.filter(F.col("error").isNotNull()).select("row_number", "error")
    accepted = validated.filter(errors.agg(F.count(F.lit(1))).scalar() == 0).drop("error")
    return accepted, errors


def needs_rate(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.coalesce(F.bool_or(F.col("mode").isin(K.MODE_WEIGHT_ONLY, K.MODE_WEIGHT_PLUS_STONE)), F.lit(False)).alias("needs_rate")
    )


def price_rows(rows: DataFrame, rate: DataFrame) -> DataFrame:
    return rows.withColumn("rate", rate.select("rate").scalar()).withColumn(
        "price",
        import_price(
            F.col("mode"), F.col("weight"), F.col("stone_value"), F.col("legacy_price"), F.col("manual_price"), F.col("rate")
        ),
    )


def upsert_actions(rows: DataFrame, store: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """CREATE, or UPDATE with the product id that already has the SKU. ``store``: sku, product_id."""
    existing = store.groupBy("sku").agg(F.min("product_id").alias("existing_id"))
    return (
        lookup(rows, existing, "sku", ["row_number"], hot_rows=hot_rows)
        .withColumn("action", F.when(F.col("existing_id").isNotNull(), "UPDATE").otherwise("CREATE"))
        .withColumn("target_status", F.when(F.col("existing_id").isNotNull(), "preserve").otherwise("draft"))
    )


def image_presence(rows: DataFrame, files: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Present and missing image names per row, in list order. ``files``: the stored names (column ``image``)."""
    names = rows.select("row_number", F.posexplode("images").alias("position", "image"))
    stored = files.select("image").distinct().withColumn("present", F.lit(True))
    found = lookup(names, stored, "image", ["row_number", "position"], hot_rows=hot_rows)
    entry = F.struct("position", "image")
    grouped = found.groupBy("row_number").agg(
        F.sort_array(F.collect_list(F.when(F.col("present"), entry))).alias("present"),
        F.sort_array(F.collect_list(F.when(F.col("present").isNull(), entry))).alias("missing"),
    )
    return grouped.select("row_number", F.col("present.image").alias("present_images"), F.col("missing.image").alias("missing_images"))


def attachment_actions(images: DataFrame, attachments: DataFrame) -> DataFrame:
    """Reuse the attachment stored under ``sku|filename`` or create one."""
    keyed = images.withColumn("import_key", F.concat_ws("|", "sku", "image"))
    known = attachments.groupBy("import_key").agg(F.min("attachment_id").alias("attachment_id"))
    row = F.monotonically_increasing_id()  # spreads a hot key's rows; any number does
    return lookup(keyed.withColumn("__row", row), known, "import_key", ["__row"]).drop("__row").withColumn(
        "action", F.when(F.col("attachment_id").isNotNull(), "REUSE").otherwise("CREATE")
    )


def alias_ids(store: DataFrame, keys=K.ALIAS_ID_KEYS) -> DataFrame:
    """(legacy_id, product_id) for every product and alias key that carries an id; replaces an OR join."""
    pairs = F.array(*[F.try_element_at("meta", F.lit(key)) for key in keys])
    return (
        store.select("product_id", F.explode(F.array_distinct(F.array_compact(pairs))).alias("legacy_id"))
        .filter(F.col("legacy_id") != "")
        .distinct()
    )


def alias_lookup(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one product per legacy id, legacy ids claimed by several products)."""
    grouped = ids.groupBy("legacy_id").agg(F.min("product_id").alias("product_id"), F.count(F.lit(1)).alias("n"))
    return grouped.filter("n = 1").drop("n"), grouped.filter("n > 1").select("legacy_id", "n")


def resolve_categories(rows: DataFrame, dimension: DataFrame, expected=K.CATEGORY_IDS) -> tuple[DataFrame, DataFrame]:
    """(rows with category_id, violations). The dimension holds one row per shop category slug.

    Only the expected slugs are read from it, so the broadcast side has at most that many rows.
    """
    want = F.create_map(*[F.lit(v) for pair in expected for v in pair])
    small = (
        dimension.filter(F.col("slug").isin(*[slug for slug, _ in expected]))
        .groupBy("slug")
        .agg(F.min("category_id").alias("category_id"))
    )
    joined = rows.join(F.broadcast(small), F.col("category") == F.col("slug"), "left").drop("slug")
    bad = (
        joined.filter(F.col("category_id").isNull() | (F.col("category_id") != F.try_element_at(want, F.col("category"))))
        .groupBy("category", "category_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return joined, bad


def _decided(records: DataFrame, by_id: DataFrame, by_sku: DataFrame, hot_rows: int) -> DataFrame:
    ids = by_id.groupBy("legacy_id").agg(F.min("product_id").alias("id_product"))
    skus = by_sku.groupBy("sku").agg(F.min("product_id").alias("sku_product"))
    first = lookup(records, ids, "legacy_id", ["row_no"], hot_rows=hot_rows)
    return lookup(first, skus, "sku", ["row_no"], hot_rows=hot_rows, counted=records)


def batch_repeats(records: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Records with ``batch_repeat``: the skip action of a record whose id or SKU an earlier one of the batch holds.

    Records are walked by ``row_no``. One that already carries a SKIP action holds nothing; one whose id repeats does not hold
    its SKU; SKUs compare without case.
    """
    open_rows = records.filter(~F.coalesce(F.col("action"), F.lit("")).startswith("SKIP_"))
    keyed = open_rows.select("row_no", F.col("legacy_id").alias("__id"), F.lower("sku").alias("__sku"))
    holders = cut_lineage(greedy_accept(keyed, "row_no", ["__id", "__sku"], hot_rows))
    marked = records.withColumn("__sku", F.lower("sku"))
    for key, column in (("legacy_id", "__id"), ("__sku", "__sku")):
        owner = holders.filter(F.col(column).isNotNull()).select(F.col(column).alias(key), F.col("row_no").alias(f"__{column}_owner"))
        marked = lookup(marked, owner, key, ["row_no"], hot_rows=hot_rows)
    repeat = F.when(F.col("____id_owner") < F.col("row_no"), "SKIP_DUPLICATE_BATCH_LEGACY_ID").when(
        F.col("____sku_owner") < F.col("row_no"), "SKIP_DUPLICATE_BATCH_SKU"
    )
    return marked.withColumn("batch_repeat", repeat).drop("__sku", "____id_owner", "____sku_owner")


def import_decisions(records: DataFrame, by_id: DataFrame, by_sku: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Planned records against the batch and the store: repeats inside the batch skip, then an existing id, then a SKU conflict
    (flagged), else create.

    Records that already carry a SKIP action keep it; one without an action is open. Everything is decided on four written
    columns; the wide records meet their decisions once, by ``row_no``.
    """
    narrow = cut_lineage(records.select("row_no", "legacy_id", "sku", "action"))
    joined = _decided(batch_repeats(narrow, hot_rows), by_id, by_sku, hot_rows)
    skipped = F.coalesce(F.col("action"), F.lit("")).startswith("SKIP_")
    decision = (
        F.when(skipped, F.col("action"))
        .when(F.col("batch_repeat").isNotNull(), F.col("batch_repeat"))
        .when(F.col("id_product").isNotNull(), "SKIP_EXISTING_LEGACY_ID")
        .when(F.col("sku_product").isNotNull(), "SKIP_SKU_CONFLICT")
        .otherwise("CREATE_DRAFT")
    )
    flag = (
        F.when(F.col("decision") == "SKIP_SKU_CONFLICT", "STORE_SKU_CONFLICT")
        .when(F.col("decision") == "SKIP_DUPLICATE_BATCH_LEGACY_ID", "DUPLICATE_BATCH_LEGACY_ID")
        .when(F.col("decision") == "SKIP_DUPLICATE_BATCH_SKU", "DUPLICATE_BATCH_SKU")
    )
    existing = F.when(F.col("decision") == "SKIP_EXISTING_LEGACY_ID", F.col("id_product")).when(F.col("decision") == "SKIP_SKU_CONFLICT", F.col("sku_product"))
    decided = joined.withColumn("decision", decision).select("row_no", "decision", existing.alias("existing_product"))
    return records.join(decided, "row_no").withColumn("review_flags", F.array_distinct(F.concat("review_flags", F.array_compact(F.array(flag)))))


def stop_all_decisions(records: DataFrame, by_id: DataFrame, by_sku: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """(decisions, blockers): any failed stop check, SKU conflict or repeat inside the batch empties the decisions.

    ``records``: row_no, legacy_id, sku, import_action, and for the stop checks image_qa_run (boolean), selected_media (a count) and
    final_price; a check whose column is absent is not made. A record without an action is kept as it is.
    """
    wanted = records.filter(F.col("import_action") == "CREATE_DRAFT")
    marked = mark_repeats(wanted, F.nullif(F.col("legacy_id"), F.lit("")), ["row_no"], "repeat_id")
    marked = mark_repeats(marked, F.nullif(F.lower("sku"), F.lit("")), ["row_no"], "repeat_sku")
    joined = _decided(cut_lineage(marked), by_id, by_sku, hot_rows)
    has = lambda name: name in records.columns
    unsafe = F.coalesce(
        F.when((T.text_or_empty(F.col("legacy_id")) == "") | (T.text_or_empty(F.col("sku")) == ""), "STOP_MISSING_IDENTITY"),
        F.when(~F.coalesce(F.col("image_qa_run"), F.lit(False)), "STOP_IMAGE_QA_NOT_RUN") if has("image_qa_run") else F.lit(None),
        F.when(F.coalesce(F.col("selected_media"), F.lit(0)) == 0, "STOP_NO_SELECTED_MEDIA") if has("selected_media") else F.lit(None),
        F.when(F.col("final_price").isNull(), "STOP_NO_FINAL_PRICE") if has("final_price") else F.lit(None),
    )
    decided = joined.withColumn(
        "decision",
        F.when(unsafe.isNotNull(), unsafe)
        .when(F.col("repeat_id"), "STOP_DUPLICATE_LEGACY_ID")
        .when(F.col("repeat_sku"), "STOP_DUPLICATE_SKU")
        .when(F.col("id_product").isNotNull(), "SKIP_EXISTING_LEGACY_ID")
        .when(F.col("sku_product").isNotNull(), "STOP_SKU_CONFLICT")
        .otherwise("CREATE_DRAFT"),
    ).withColumn("existing_product", F.coalesce("id_product", "sku_product"))
    blockers = decided.filter(F.col("decision").startswith("STOP_")).select("row_no", "legacy_id", "sku", "decision", "existing_product")
    others = records.filter(~F.col("import_action").eqNullSafe("CREATE_DRAFT")).select(
        "row_no", "legacy_id", "sku", F.col("import_action").alias("decision"), F.lit(None).cast("bigint").alias("existing_product")
    )
    kept = decided.select("row_no", "legacy_id", "sku", "decision", "existing_product").unionByName(others)
    return kept.filter(blockers.agg(F.count(F.lit(1))).scalar() == 0), blockers


def blocked_action(final_price: Column, category: Column, legacy_id: Column, code: Column, sku: Column, images: Column, missing: Column, qa_run: Column) -> Column:
    """Import action of a prepared product."""
    blocked = (
        final_price.isNull()
        | ~F.coalesce(category.isin(*K.CATEGORIES), F.lit(False))
        | (T.text_or_empty(legacy_id) == "")
        | (T.text_or_empty(code) == "")
        | (T.text_or_empty(sku) == "")
        | (F.coalesce(images, F.lit(0)) == 0)
        | (F.coalesce(missing, F.lit(0)) > 0)
    )
    return F.when(blocked, "SKIP_INVALID_REVIEW").when(~qa_run, "BLOCKED_IMAGE_QA_REQUIRED").otherwise("CREATE_DRAFT")
