"""Cell and metadata parsing. Bad input becomes null, never an exception (``try_cast`` throughout)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise import constants as K
from shelfwise.functions import text as T

DECIMAL = "decimal(38,10)"
WEIGHT = "decimal(20,10)"
_FIRST_NUMBER = "[-+]?[0-9]+(?:\\.[0-9]+)?"


def parse_decimal(value: Column, decimal_comma: bool = False) -> Column:
    """First number in the cell. With ``decimal_comma``, ``7,25`` alone means 7.25."""
    cleaned = F.lower(T.normalize_text(value))
    for word in ("تومان", "ریال", "گرم"):
        cleaned = F.replace(cleaned, F.lit(word), F.lit(""))
    cleaned = F.translate(cleaned, "٫٬ ", ".")
    if decimal_comma:
        cleaned = F.regexp_replace(cleaned, "^([-+]?[0-9]+),([0-9]{1,3})$", "$1.$2")
    cleaned = F.replace(cleaned, F.lit(","), F.lit(""))
    return F.regexp_extract(cleaned, _FIRST_NUMBER, 0).try_cast(DECIMAL)


# From an already parsed number. Jobs parse each cell once into a column and apply these to it.


def positive_whole(number: Column) -> Column:
    return F.when((number > 0) & (number == F.floor(number)), number.try_cast("bigint"))


def positive_floor(number: Column) -> Column:
    return F.when(number > 0, F.floor(number).try_cast("bigint"))


def weight_in_range(number: Column) -> Column:
    return F.when((number > 0) & (number <= K.MAX_WEIGHT_GRAMS), number.try_cast(WEIGHT))


def stock_from_number(number: Column) -> Column:
    """struct(stock, flag)."""
    return F.struct(
        F.when(number.isNull() | (number < 0), F.lit(0)).otherwise(F.floor(number)).try_cast("bigint").alias("stock"),
        F.when(number.isNull(), "STOCK_MISSING_OR_INVALID")
        .when(number < 0, "STOCK_NEGATIVE_CLAMPED_TO_ZERO")
        .when(number != F.floor(number), "STOCK_FRACTION_FLOORED")
        .alias("flag"),
    )


def active_from(number: Column, word: Column) -> Column:
    """``word`` is the cell in lower-case normal form."""
    return (
        F.when(number == 1, True)
        .when(number == 0, False)
        .when(word.isin(*K.ACTIVE_WORDS), True)
        .when(word.isin(*K.INACTIVE_WORDS), False)
    )


def availability_from(number: Column, word: Column) -> Column:
    compact = F.replace(word, F.lit(" "), F.lit(""))
    return (
        F.when(number == 1, K.IN_STOCK)
        .when(number == 0, K.OUT_OF_STOCK)
        .when(compact.isin(*K.IN_STOCK_WORDS), K.IN_STOCK)
        .when(compact.isin(*K.OUT_OF_STOCK_WORDS), K.OUT_OF_STOCK)
        .when(word == "", K.AVAILABILITY_UNKNOWN)
        .otherwise(word)
    )


def word(value: Column) -> Column:
    return F.lower(T.normalize_text(value))


# Straight from a cell.


def parse_id(value: Column) -> Column:
    return positive_whole(parse_decimal(value))


def parse_active(value: Column) -> Column:
    return active_from(parse_decimal(value), word(value))


def normalize_availability(value: Column) -> Column:
    return availability_from(parse_decimal(value), word(value))


def positive_toman(value: Column) -> Column:
    return positive_floor(parse_decimal(value))


def parse_weight(value: Column) -> Column:
    return weight_in_range(parse_decimal(value, decimal_comma=True))


def parse_stock(value: Column) -> Column:
    return stock_from_number(parse_decimal(value))


def parse_plausible_toman(value: Column) -> Column:
    """Whole Toman inside the plausible price range; never scaled."""
    cleaned = T.clean_numeric(value)
    number = F.when(cleaned.rlike("^[0-9]+$"), cleaned).try_cast("bigint")
    return F.when(number.between(K.MIN_PLAUSIBLE_PRICE, K.MAX_PLAUSIBLE_PRICE), number)


def parse_weight_grams(value: Column) -> Column:
    return weight_in_range(T.clean_numeric(value).try_cast(DECIMAL))


def parse_confidence(value: Column) -> Column:
    number = T.ascii_digits(T.strip(T.text_or_empty(value))).try_cast(DECIMAL)
    return F.least(F.lit(1), F.greatest(F.lit(0), F.coalesce(number, F.lit(0)))).cast("decimal(6,5)")


def joined_toman(value: Column) -> Column:
    """All digit runs joined into one number (page prices)."""
    return F.regexp_replace(T.normalize_digits(value), "[^0-9]", "").try_cast("bigint")


def meta_number(value: Column) -> Column:
    """Number of a metadata text: thousands commas dropped, nothing else tolerated."""
    return T.ascii_digits(F.replace(T.strip(T.text_or_empty(value)), F.lit(","), F.lit(""))).try_cast(DECIMAL)


def positive(number: Column) -> Column:
    return F.when(number > 0, number)


def nonnegative_whole(number: Column) -> Column:
    """Half-up to whole Toman, null when negative or missing."""
    return F.when(number >= 0, F.round(number, 0).try_cast("bigint"))


def whole_or_zero(number: Column) -> Column:
    return F.coalesce(F.round(number, 0).try_cast("bigint"), F.lit(0))


def safe_int(value: Column) -> Column:
    """Truncate to an integer, zero when it is not a number."""
    number = F.replace(T.text_or_empty(value), F.lit(","), F.lit("")).try_cast("double")
    return F.coalesce(number.try_cast("bigint"), F.lit(0))


def meta_value(meta: Column, keys: tuple[str, ...], default: str = "") -> Column:
    """First non-empty value among alias keys."""
    values = [F.nullif(F.try_element_at(meta, F.lit(key)), F.lit("")) for key in keys]
    return F.coalesce(*values, F.lit(default))


def meta_keys(base: tuple[str, ...], namespace: str | None = None) -> tuple[str, ...]:
    """Alias list with a shop-specific historic key put right after the canonical one."""
    if namespace is None:
        return base
    return (base[0], f"{namespace}_{base[0]}", *base[1:])
