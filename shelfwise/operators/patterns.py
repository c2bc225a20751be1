"""Many patterns against many texts: which texts contain which, first marker, and redaction.

Texts are read once into a few of their grams, each with the characters around it. A gram meets the patterns in an equi-join and a
pattern is compared with these characters at once, so that pairs which only share a gram are never written. Before the shuffle,
nearly all grams that no pattern has are dropped by a bit table that grows with the patterns' grams, up to a bounded size. The work
follows the texts and the matches, not texts times patterns.

Of a text only every ``stride``-th gram is taken: a pattern of at least ``least`` characters holds a gram at each of
``least - gram + 1`` places in a row, one of which falls on the stride wherever the pattern stands, so a pattern is known by
all of these grams. The gram of a class covers most of its shortest pattern: what shares it is nearly the pattern. A short
pattern is known by the one of its grams that fewest patterns share, or by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.session import cut_lineage

GRAM = 6
LONG = ((40, 33), (32, 25), (24, 18), (18, 13), (14, 10), (10, 7))  # least length of a pattern and the gram it is known by, longest first
PIECE = 1 << 11
HEAD = 256  # characters of a pattern that are compared around its gram; what is longer is then compared with the whole text
WORDS = (1 << 21, 1 << 23)  # least and most words of 64 bits in the table of the grams that patterns have
LOAD = 4  # grams a word, at most, while the table can grow
ROW = 64  # words in a row of the table


def grams(text: Column, size: int, stride: int = 1) -> Column:
    """Every ``stride``-th run of ``size`` characters of a text, in one scan."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}})).{{1,{stride}}}"), F.lit(1))


def pieces(text: Column, overlap: int) -> Column:
    """A text in pieces of ``PIECE`` characters and the ``overlap`` after them, in one scan."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{PIECE + overlap}}})).{{1,{PIECE}}}"), F.lit(1))


def anchored(patterns: DataFrame, pattern: str, size: int = GRAM, long: Sequence[tuple[int, int]] = LONG) -> DataFrame:
    """The distinct non-empty patterns by the grams they are found by.

    pattern, ``head`` (its first ``HEAD`` characters), ``n`` (their number), ``gram``, ``place`` (of the gram in the head, from 0),
    ``width`` (the gram's length) and ``stride``.
    """
    known = patterns.select(F.col(pattern).alias("pattern")).filter("pattern <> ''").distinct()
    known = known.withColumn("head", F.substring("pattern", 1, HEAD)).withColumn("n", F.char_length("head"))
    found, below = [], None
    for least, width in long:
        own = known.filter(F.col("n") >= least) if below is None else known.filter((F.col("n") >= least) & (F.col("n") < below))
        held = F.array(*[F.substring("head", i, width) for i in range(1, least - width + 2)])
        found.append(own.select("pattern", "head", "n", F.posexplode(held).alias("place", "gram"), F.lit(width).alias("width"), F.lit(least - width + 1).alias("stride")))
        below = least
    short = known if below is None else known.filter(F.col("n") < below)
    own = F.when(F.col("n") >= size, grams(F.col("head"), size)).otherwise(F.array("head"))
    rows = short.select("pattern", F.explode(F.array_distinct(own)).alias("gram"))
    shared = rows.groupBy("gram").agg(F.count(F.lit(1)).alias("shared"))
    best = rows.join(shared, "gram").groupBy("pattern").agg(F.min_by("gram", F.struct("shared", F.xxhash64("gram"))).alias("gram"))
    head = F.substring("pattern", 1, HEAD)
    found.append(best.select("pattern", head.alias("head"), F.char_length(head).alias("n"), (F.instr(head, F.col("gram")) - 1).alias("place"), "gram", F.char_length("gram").alias("width"), F.lit(1).alias("stride")))
    return reduce(DataFrame.unionByName, found)


def marks(gram: Column, words: int) -> tuple[Column, Column, Column]:
    """Row, word and four bits of a gram's hash in the table of grams."""
    part = lambda k: F.shiftrightunsigned(gram, 6 * k).bitwiseAND(63).cast("int")
    bits = reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), part(k)) for k in range(4)])
    return F.shiftrightunsigned(gram, 30).bitwiseAND(words // ROW - 1), part(4), bits


def marked(index: DataFrame, words: int) -> DataFrame:
    """The bit table of the grams: ``__row`` and its ``ROW`` words, ``__words``. Of several bits a gram, so that few others have all of them set."""
    row, word, bits = marks(F.col("gram"), words)
    own = index.select(row.alias("__row"), word.alias("__word"), bits.alias("__bits")).groupBy("__row", "__word").agg(F.bit_or("__bits").alias("__bits"))
    rows = own.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("__word", "__bits"))).alias("__own"))
    every = F.sequence(F.lit(0), F.lit(ROW - 1))
    return rows.select("__row", F.transform(every, lambda i: F.coalesce(F.try_element_at("__own", i), F.lit(0).cast("long"))).alias("__words"))


def hashed(text: Column, width: int, stride: int) -> Column:
    """Hash and place of every ``stride``-th gram."""
    return F.transform(grams(text, width, stride), lambda g, i: F.struct(F.xxhash64(g).alias("gram"), (i * stride).alias("at")))


def matches(
    texts: DataFrame, row_id: str, text: str, patterns: DataFrame, pattern: str = "pattern", size: int = GRAM, long: Sequence[tuple[int, int]] = LONG
) -> DataFrame:
    """row_id and ``pattern`` for every pattern a text contains. ``row_id`` is unique; null texts and empty patterns match nothing."""
    index = cut_lineage(anchored(patterns, pattern, size, long).withColumn("gram", F.xxhash64("gram")))
    kinds = index.groupBy("width", "stride").agg(F.max("place").alias("before"), F.max("n").alias("n"), F.max(F.char_length("pattern")).alias("whole"), F.count(F.lit(1)).alias("held")).collect()
    if not kinds:  # at most size + number of long classes
        return texts.select(row_id, F.lit("").alias("pattern")).limit(0)
    before, after = max(k.before for k in kinds), max(k.n for k in kinds)
    known = texts.select(row_id, F.col(text).alias("__text")).filter("__text <> ''")
    every = F.concat(*[hashed(F.col("__piece"), k.width, k.stride) for k in sorted(kinds)])
    cut = known.select(row_id, F.explode(pieces(F.col("__text"), after)).alias("__piece"))
    held = cut.select(row_id, "__piece", F.inline(every)).withColumnsRenamed({"gram": "__gram", "at": "__at"})
    words = min(max(1 << (sum(k.held for k in kinds) // LOAD).bit_length(), WORDS[0]), WORDS[1])
    row, word, bits = marks(F.col("__gram"), words)
    some = held.join(F.broadcast(marked(index, words)), row == F.col("__row")).filter(F.bitwise_not(F.col("__words")[word]).bitwiseAND(bits) == 0)
    start = F.greatest(F.col("__at") - before, F.lit(0))
    nearby = F.coalesce(F.substring(F.col("__piece"), start + 1, F.lit(before + after)), F.lit(""))  # never null: else a null check of it runs for each gram
    around = some.select(row_id, F.col("__gram").alias("gram"), (F.col("__at") - start).alias("__lead"), nearby.alias("__around"))
    own = index.select("gram", "pattern", "head", "place", "n")
    same = (F.col("__lead") >= F.col("place")) & (F.substring(F.col("__around"), F.col("__lead") - F.col("place") + 1, F.col("n")) == F.col("head"))
    likely = around.join(own, "gram").filter(same).select(row_id, "pattern").distinct()
    if max(k.whole for k in kinds) <= HEAD:
        return likely
    sure = F.char_length("pattern") <= HEAD
    longer = likely.filter(~sure).join(known, row_id).filter(F.contains("__text", "pattern")).select(row_id, "pattern")
    return likely.filter(sure).unionByName(longer)


def first_marker(texts: DataFrame, row_id: str, text: str, markers: DataFrame) -> DataFrame:
    """row_id and the contained marker of least ``rank`` of each text that has one. ``markers``: marker, rank."""
    found = matches(texts, row_id, text, markers, "marker")
    ranked = found.join(markers.groupBy(F.col("marker").alias("pattern")).agg(F.min("rank").alias("rank")), "pattern")
    return ranked.groupBy(row_id).agg(F.min_by("pattern", F.struct("rank", "pattern")).alias("marker"))


def redacted(texts: DataFrame, row_id: str, text: str, secrets: DataFrame, secret: str = "secret", least: int = 6, mask: str = "********") -> DataFrame:
    """Texts with every secret of at least ``least`` characters replaced, longer ones first."""
    usable = secrets.filter(F.char_length(secret) >= least)
    found = matches(texts, row_id, text, usable, secret)
    own = found.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct((-F.char_length("pattern")).alias("n"), "pattern"))).alias("__own"))
    clean = F.aggregate("__own", F.col(text), lambda t, s: F.replace(t, s["pattern"], F.lit(mask)))
    return texts.join(own, row_id, "left").withColumn(text, F.when(F.col("__own").isNull(), F.col(text)).otherwise(clean)).drop("__own")
