"""Document gates: public section, placeholder markers, committed secrets, redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise import constants as K
from shelfwise.functions import text as T
from shelfwise.operators.staging import computed


def placeholder_markers(css_prefix: str = "shop") -> tuple[str, ...]:
    """Bracketed ellipsis first, then the class name of unresolved placeholders."""
    return ("[…]", f"{css_prefix}-placeholder")


def marker_hits(documents: DataFrame, markers: tuple[str, ...], text: str = "text") -> DataFrame:
    """Documents that contain a marker, with the first marker that matches."""
    first = F.coalesce(*[F.when(F.contains(F.col(text), F.lit(m)), m) for m in markers])
    return documents.withColumn("marker", first).filter(F.col("marker").isNotNull())


def secret_hits(documents: DataFrame, patterns=K.SECRET_PATTERNS, text: str = "text") -> DataFrame:
    """Documents with a credential pattern, with the names of all patterns that match."""
    names = F.array_compact(F.array(*[F.when(F.col(text).rlike(p), name) for name, p in patterns]))
    return documents.withColumn("secret_kinds", names).filter(F.size("secret_kinds") > 0)


def redacted(documents: DataFrame, secrets: list[str], text: str = "text") -> DataFrame:
    return documents.withColumn(text, T.redact(F.col(text), secrets))


def public_sections(documents: DataFrame, text: str = "text", start_word: str = "content", stops=K.INTERNAL_HEADINGS) -> DataFrame:
    """Add ``body`` and ``error``: the lines after the one ``## ... <start_word>`` heading up to the first internal heading.

    Works on the lines of each document inside its row, so nothing is shuffled; every array is computed once.
    """
    lines = F.split(text, "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]")
    split = computed(documents, __lines=lines)
    keyed = computed(split, __keys=F.transform("__lines", lambda line: F.lower(T.strip(line))))
    starts = F.filter(
        F.transform("__keys", lambda k, i: F.when(k.startswith("## ") & k.contains(start_word), i)), lambda i: i.isNotNull()
    )
    started = computed(keyed, __starts=starts).withColumn("__start", F.get("__starts", 0))
    stop = "|".join(stops)

    def is_stop(key: Column, i: Column) -> Column:
        name = F.trim(F.rtrim(F.trim(F.substring(key, F.lit(4), F.length(key))), F.lit(":")))
        internal = key.startswith("## ") & ~key.contains(start_word) & name.rlike(stop)
        return F.when((i > F.col("__start")) & internal, i)

    end = F.coalesce(F.array_min(F.transform("__keys", is_stop)), F.size("__lines"))
    bounded = computed(started, __end=end)
    first_line = F.col("__start") + 1
    filled = F.transform(
        "__keys", lambda key, i: F.when((i >= first_line) & (i < F.col("__end")) & (key != ""), i)
    )
    trimmed = computed(bounded, __first=F.array_min(filled), __last=F.array_max(filled))
    error = (
        F.when(F.col("__start").isNull(), "required section not found")
        .when(F.size(F.filter("__starts", lambda i: i < F.col("__end"))) > 1, "duplicate section heading")
        .when(F.col("__first").isNull(), "section is empty")
    )
    body = F.array_join(F.slice("__lines", F.col("__first") + 1, F.col("__last") - F.col("__first") + 1), "\n")
    return (
        trimmed.withColumn("error", error)
        .withColumn("body", F.when(F.col("error").isNull(), body))
        .drop("__lines", "__keys", "__starts", "__start", "__end", "__first", "__last")
    )
