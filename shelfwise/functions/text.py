"""Text normalisers. Each differs on purpose; pick by name, do not merge them.

All take and return a Column and stay inside generated code (``translate``, ``regexp_replace``, ``trim``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise import constants as K

def text_or_empty(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def strip(value: Column) -> Column:
    """Remove any Unicode whitespace at both ends (plain ``trim`` removes only U+0020)."""
    return F.trim(value, F.lit(K.WHITESPACE_CHARS))


# Any character beyond ASCII and Latin letters. Scanning for it is far cheaper than translating character by
# character, so text without such characters skips the translation.
_BEYOND_LATIN = "[^\\x00-\\x7f\\u00a1-\\u024f]"


def _translate_rare(value: Column, source: str, target: str) -> Column:
    return F.when(value.rlike(_BEYOND_LATIN), F.translate(value, source, target)).otherwise(value)


def _single_spaces(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, "[\\s\\x1c-\\x1f]+", " "))


def collapse(value: Column) -> Column:
    """Runs of whitespace become one space; ends are trimmed."""
    return _single_spaces(_translate_rare(value, K.WHITESPACE_CHARS, " " * len(K.WHITESPACE_CHARS)))


def ascii_digits(value: Column) -> Column:
    return _translate_rare(value, K.PERSIAN_DIGITS + K.ARABIC_DIGITS, K.ASCII_DIGITS * 2)


def persian_digits(value: Column) -> Column:
    return F.translate(value.cast("string"), K.ASCII_DIGITS, K.PERSIAN_DIGITS)


def normalize_text(value: Column) -> Column:
    """ASCII digits, Persian letters, joiner as space, collapsed."""
    return _single_spaces(
        _translate_rare(
            text_or_empty(value),
            K.PERSIAN_DIGITS + K.ARABIC_DIGITS + "يك" + K.ZWNJ + K.WHITESPACE_CHARS,
            K.ASCII_DIGITS * 2 + "یک" + " " + " " * len(K.WHITESPACE_CHARS),
        )
    )


def normalize_digits(value: Column) -> Column:
    """ASCII digits and Persian letters; spacing untouched."""
    return _translate_rare(
        text_or_empty(value), K.PERSIAN_DIGITS + K.ARABIC_DIGITS + "يك", K.ASCII_DIGITS * 2 + "یک"
    )


def normalize_identity_digits(value: Column) -> Column:
    """ASCII digits only; letters untouched."""
    return ascii_digits(text_or_empty(value))


def unescape_basic_entities(value: Column) -> Column:
    """The five XML entities and the no-break space; the page job decodes the full set on workers."""
    for entity, char in (
        ("&nbsp;", " "),
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&#39;", "'"),
        ("&apos;", "'"),
        ("&amp;", "&"),
    ):
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def normalize_space(value: Column) -> Column:
    """``normalize_digits`` plus entity decoding plus collapse."""
    return collapse(unescape_basic_entities(normalize_digits(value)))


def classifier_text(*parts: Column) -> Column:
    """Joined, case-folded text for stone classification (digits untouched)."""
    joined = F.lower(F.concat_ws(" ", *[text_or_empty(p) for p in parts]))
    return F.translate(joined, "يكۀ" + K.ZWNJ, "یکه" + " ")


def display_text(value: Column) -> Column:
    """Collapse layout whitespace only; letters and joiners keep their form."""
    return strip(F.regexp_replace(text_or_empty(value), "[ \\t\\r\\n]+", " "))


def persian_title(value: Column) -> Column:
    """Persian letters and Persian digits, trimmed."""
    return strip(
        F.translate(
            text_or_empty(value),
            "يك" + K.ASCII_DIGITS + K.ARABIC_DIGITS,
            "یک" + K.PERSIAN_DIGITS * 2,
        )
    )


def clean_number(value: Column) -> Column:
    """Strip thousands marks and spaces, Persian decimal mark to a dot."""
    return F.translate(
        strip(text_or_empty(value)),
        K.PERSIAN_DIGITS + K.ARABIC_DIGITS + "٫" + "٬, ",
        K.ASCII_DIGITS * 2 + ".",
    )


def clean_numeric(value: Column) -> Column:
    """``clean_number`` that also drops the currency word."""
    return F.replace(clean_number(value), F.lit("تومان"), F.lit(""))


def title_whitespace(value: Column) -> Column:
    return collapse(text_or_empty(value))


def is_blank(value: Column) -> Column:
    return normalize_text(value).isin(*K.BLANK_TOKENS)


def raw_trace(value: Column) -> Column:
    return strip(text_or_empty(value))


def toman_text(amount: Column) -> Column:
    """Thousands separators and Persian digits, minus sign kept in front."""
    return persian_digits(F.format_number(amount.cast("bigint"), 0))


def decimal_text(value: Column, places: int = 0) -> Column:
    """Half-up rounding with thousands separators; an em dash stands for null."""
    return F.coalesce(F.format_number(F.round(value, places), places), F.lit("—"))


def plain_decimal_text(value: Column) -> Column:
    """Decimal as text without exponent or trailing zeros."""
    return F.regexp_replace(F.regexp_replace(value.cast("string"), "(\\.[0-9]*?)0+$", "$1"), "\\.$", "")


def redact(text: Column, secrets: list[str], mask: str = "********") -> Column:
    """Replace known secret values of six characters or more, in the order given."""
    for secret in secrets:
        if len(secret) >= 6:
            text = F.replace(text, F.lit(secret), F.lit(mask))
    return text


def tehran_stamp(moment: Column, micros: bool = False) -> Column:
    """Run stamp in local time with its offset; ``moment`` is a UTC instant."""
    pattern = "yyyyMMdd'T'HHmmss" + ("SSSSSS" if micros else "")
    local = F.from_utc_timestamp(moment, "Asia/Tehran")
    minutes = ((F.unix_timestamp(local) - F.unix_timestamp(moment)) / 60).cast("int")
    offset = F.format_string("%s%02d%02d", F.when(minutes < 0, "-").otherwise("+"), F.abs(F.floor(minutes / 60)), F.abs(minutes) % 60)
    return F.concat(F.date_format(local, pattern), offset)


def utc_iso(moment: Column) -> Column:
    return F.concat(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
