"""Titles, legacy codes and SKUs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise import constants as K
from shelfwise.functions import text as T

# Code labels and the characters that may separate them
_GAP = "[ " + K.ZWNJ + "]*"
_LABEL = f"شناسه{_GAP}کالا|کد(?:{_GAP}(?:مدل|محصول))?"
CODE_SUFFIX = f"(?:^|[ \\-–—|:：]+)({_LABEL}){_GAP}[:：]?{_GAP}([0-9۰-۹٠-٩]{{2,8}}){_GAP}$"
TRAILING_LABEL = f"(?:{_LABEL}){_GAP}[:：]?{_GAP}[^{K.WHITESPACE}]+{_GAP}$"
TITLE_EDGE = " -–—|:："
CODE_EDGE = ".:：،,؛;#()[]{}"
SAFE_SKU = "^[A-Za-z0-9][A-Za-z0-9._-]{0,99}$"
_TOKEN = "([A-Za-z0-9۰-۹٠-٩._/-]{1,100})"
_SPACES = f"[{K.WHITESPACE}]*"
EXPLICIT_CODE = f"(?i)شناسه{_SPACES}کالا{_SPACES}[:：#-]?{_SPACES}{_TOKEN}"
CODE_MARK = f"(?i)(?:کد|code){_SPACES}[:：#-]?{_SPACES}{_TOKEN}"


def title_match(raw: Column) -> Column:
    """struct(display, head, label, code) of a raw title; label and code are empty without a trailing code."""
    display = T.title_whitespace(raw)
    head = F.regexp_extract(display, f"^(.*?){CODE_SUFFIX}", 1)
    return F.struct(
        display.alias("display"),
        F.trim(T.title_whitespace(head), F.lit(TITLE_EDGE)).alias("head"),
        F.regexp_extract(display, CODE_SUFFIX, 1).alias("label"),
        T.ascii_digits(F.regexp_extract(display, CODE_SUFFIX, 2)).alias("code"),
    )


def cleaned_title(raw: Column, match: Column, fallback: str = "محصول نقره") -> Column:
    """struct(original, cleaned, code, label, applied, flag, status) from a ``title_match``.

    A labelled code of 2 to 8 digits at the end is cut off; the title never becomes empty.
    """
    display, head, label = match["display"], match["head"], match["label"]
    applied = (label != "") & (head != "")
    flag = (
        F.when(display == "", "EMPTY_ORIGINAL_TITLE_FALLBACK")
        .when((label != "") & (head == ""), "TITLE_CLEANUP_WOULD_EMPTY_TITLE")
        .when((label == "") & display.rlike(TRAILING_LABEL), "TRAILING_CODE_LABEL_UNPARSED")
    )
    return F.struct(
        T.text_or_empty(raw).alias("original"),
        F.when(display == "", fallback).when(applied, head).otherwise(display).alias("cleaned"),
        match["code"].alias("code"),
        label.alias("label"),
        applied.alias("applied"),
        flag.alias("flag"),
        F.when(flag.isNotNull(), "REVIEW").when(applied, "CLEANED").otherwise("UNCHANGED").alias("status"),
    )


def clean_title(raw: Column, fallback: str = "محصول نقره") -> Column:
    return cleaned_title(raw, title_match(raw), fallback)


def identity_key(legacy_id: Column, code: Column) -> Column:
    """``id:code``; null when either part is empty."""
    left = T.strip(T.normalize_identity_digits(legacy_id))
    right = T.strip(T.normalize_identity_digits(code))
    return F.when((left != "") & (right != ""), F.concat_ws(":", left, right))


def extract_code(title: Column, visible_text: Column) -> Column:
    """Explicit product-id marker in the text, then a code marker in the title, then in the text."""
    def token(source: Column, pattern: str) -> Column:
        letters = F.translate(T.text_or_empty(source), "يك", "یک")
        return F.nullif(F.trim(F.regexp_extract(letters, pattern, 1), F.lit(CODE_EDGE)), F.lit(""))

    return F.coalesce(token(visible_text, EXPLICIT_CODE), token(title, CODE_MARK), token(visible_text, CODE_MARK))


def base64_text(value: Column) -> Column:
    """Base64 of the UTF-8 bytes on one line, the form in which a code is passed on safely."""
    return F.replace(F.base64(F.encode(value, "UTF-8")), F.lit("\r\n"))


def code_to_sku(code: Column) -> Column:
    """struct(code_raw, code, sku, normalized, reason, review)."""
    raw = T.strip(T.text_or_empty(code))
    token = F.trim(T.strip(T.normalize_digits(raw)), F.lit(CODE_EDGE))
    base = F.substring(F.trim(F.regexp_replace(token, "[^A-Za-z0-9._-]+", "-"), F.lit("-._")), 1, 70)
    digest = F.upper(F.substring(F.sha2(raw, 256), 1, 10))
    reason = (
        F.when(raw == "", "MISSING_CODE")
        .when(raw.rlike(SAFE_SKU), "EXACT_LEGACY_CODE")
        .when(token.rlike(SAFE_SKU), "DIGIT_OR_CHARACTER_NORMALIZATION")
        .otherwise("DETERMINISTIC_SAFE_SKU")
    )
    return F.struct(
        F.nullif(raw, F.lit("")).alias("code_raw"),
        F.when(raw != "", F.coalesce(F.nullif(token, F.lit("")), raw)).alias("code"),
        F.when(reason == "EXACT_LEGACY_CODE", raw)
        .when(reason == "DIGIT_OR_CHARACTER_NORMALIZATION", token)
        .when(reason == "DETERMINISTIC_SAFE_SKU", F.concat_ws("-", F.lit("LEGACY"), F.nullif(base, F.lit("")), digest))
        .alias("sku"),
        reason.isin("DIGIT_OR_CHARACTER_NORMALIZATION", "DETERMINISTIC_SAFE_SKU").alias("normalized"),
        reason.alias("reason"),
        (reason == "MISSING_CODE").alias("review"),
    )


def derive_sku(title_code: Column, raw_code: Column, legacy_id: Column) -> Column:
    """struct(sku, source): title code, else a small whole number from the code column, else the id."""
    return sku_from_digits(title_code, code_digits(raw_code), legacy_id)


def code_digits(raw_code: Column) -> Column:
    return F.replace(T.normalize_text(raw_code), F.lit(" "), F.lit(""))


def sku_from_digits(title_code: Column, digits: Column, legacy_id: Column) -> Column:
    """``derive_sku`` from a column that holds the ``code_digits``, so that they are computed once."""
    number = F.when(digits.rlike("^[0-9]+$"), digits).try_cast("bigint")
    valid = number.between(1, 99_999)
    return F.struct(
        F.when(title_code != "", title_code)
        .when(valid, digits)
        .otherwise(F.concat(F.lit("NM-"), legacy_id.cast("string")))
        .alias("sku"),
        F.when(title_code != "", "TITLE_CODE")
        .when(valid, "COL27_VALIDATED")
        .otherwise("FALLBACK_LEGACY_ID")
        .alias("source"),
    )


def shop_sku(category_code: Column, gender_code: Column, legacy_id: Column, prefix: str = K.SKU_PREFIX) -> Column:
    category = T.strip(F.upper(category_code))
    gender = T.strip(F.upper(gender_code))
    return F.concat_ws(
        "-",
        F.lit(prefix),
        F.when(category.isin(*K.SKU_CATEGORY_CODES), category).otherwise("RNG"),
        F.when(gender.isin(*K.SKU_GENDER_CODES), gender).otherwise("U"),
        legacy_id.cast("string"),
    )


def title_matches_sku(title_code: Column, sku: Column) -> Column:
    return F.when(title_code == "", "NOT_APPLICABLE").when(title_code == sku, "YES").otherwise("NO")
