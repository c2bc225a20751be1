"""I-Match document fingerprints.

The lexicon keeps the terms whose share of documents lies in a band (equivalently: whose inverse document frequency
lies in one). A lower bound on the share bounds the lexicon: a document of t distinct terms adds 1/N to t shares, so no
more than (mean distinct terms) / ``low`` terms can reach ``low``, however many documents there are. It is held as a table
of 64-bit term hashes, a constant of the plan, in which a term has two possible places.

Terms of the lexicon are dealt to ``subsets`` randomised subsets by their hash. A text's fingerprint holds, per subset, a
hash of its sorted distinct terms in that subset, or dashes if there are none. Two fingerprints are alike in the share of
equal parts among those that at least one of them has.

A text with no term of the lexicon uses all its distinct terms in place of those (too short, or in a language of its own),
and a text without any term has a fingerprint of dashes, which is like only another one of dashes. Nulls are empty texts.
Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.operators.staging import computed
from shelfwise.session import cut_lineage

LOW, HIGH = 0.01, 0.2
SUBSETS, DIGITS = 32, 6
NONE = "-" * DIGITS
SPAN = 1024


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct lower-case words (ASCII letters, digits and all characters beyond ASCII)."""
    words = F.split(F.lower(text), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.transform(F.array_distinct(F.array_remove(words, "")), lambda t: F.xxhash64(t))


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH) -> list[int]:
    """Sorted hashes of the terms within the band over all documents; at most (mean distinct terms) / ``low`` of them."""
    counts = docs.select(F.explode(term_hashes(F.col(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = docs.agg(F.count(F.lit(1)).alias("n"))
    share = F.col("df") / F.greatest(total.scalar(), F.lit(1))
    return sorted(r.term for r in counts.filter((share >= low) & (share <= high)).select("term").collect())


class Lexicon:
    """Membership of a term hash as an expression over a constant cuckoo table: a term sits in one of two slots."""

    def __init__(self, hashes: list[int]):
        self.size, slots = 1024, None
        while slots is None:
            slots = self._filled(hashes) if self.size >= 3 * len(hashes) else None
            self.size *= 1 if slots else 2
        # a free slot holds a number that belongs to another slot, so nothing is found there
        numbers = [str((i + 1) % self.size if h is None else h) for i, h in enumerate(slots)]
        self.table = F.split(F.lit(",".join(numbers)), ",").cast("array<bigint>")

    def _filled(self, hashes: list[int]) -> list[int | None] | None:
        slots: list[int | None] = [None] * self.size
        for h in hashes:
            at = h % self.size
            for _ in range(200):
                slots[at], h = h, slots[at]
                if h is None:
                    break
                first, second = h % self.size, (h >> 32) % self.size
                at = second if at == first else first
            else:
                return None
        return slots

    def has(self, h: Column) -> Column:
        size = F.lit(self.size)
        return (F.get(self.table, F.pmod(h, size)) == h) | (F.get(self.table, F.pmod(F.shiftright(h, 32), size)) == h)


def parts(used: Column, subsets: int = SUBSETS) -> Column:
    """One number per subset from its sorted terms, null without any; subsets go by the hash's leading bits."""
    code = F.lit((1 << (4 * DIGITS)) - 1)
    members = lambda i: F.filter(used, lambda h: F.pmod(F.shiftright(h, 20), F.lit(subsets)) == i)
    own = F.transform(F.sequence(F.lit(0), F.lit(subsets - 1)), members)
    return F.transform(own, lambda m: F.when(F.size(m) > 0, F.xxhash64(m).bitwiseAND(code).cast("int")))


def fingerprint(numbers: Column) -> Column:
    """The parts as text, ``DIGITS`` hexadecimal digits each."""
    return F.array_join(F.transform(numbers, lambda n: F.coalesce(F.lpad(F.hex(n), DIGITS, "0"), F.lit(NONE))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among the parts at least one has; 1 if neither has any, null if one is missing altogether."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), x.eqNullSafe(y)))
    value = F.aggregate(same, F.lit(0), lambda n, s: n + F.coalesce(s.cast("int"), F.lit(0)))
    count = F.aggregate(same, F.lit(0), lambda n, s: n + s.isNotNull().cast("int"))
    return F.when(a.isNotNull() & b.isNotNull(), F.when(count == 0, 1.0).otherwise(value / count))


def with_parts(docs: DataFrame, text: str, words: Lexicon, name: str) -> DataFrame:
    """Add ``name``, the parts of the text's fingerprint; every step is worked out once per row."""
    staged = computed(docs, __hashes=term_hashes(F.coalesce(F.col(text), F.lit(""))))
    staged = computed(staged, __band=F.filter("__hashes", words.has))
    used = F.sort_array(F.when(F.size("__band") > 0, F.col("__band")).otherwise(F.col("__hashes")))
    staged = computed(staged, __used=used).drop("__hashes", "__band")
    return computed(staged, **{name: parts(F.col("__used"))}).drop("__used")


def with_followers(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """``rows`` (doc_id, text) with ``run`` and ``follower`` false, and for each run one row more (``follower`` true): the text
    that comes after the run's last one in descending doc_id (nulls last; ties by text), after the last run the first text.

    Ids are cut into runs of ``span`` consecutive values, so a run holds at most ``span`` distinct ids whatever the
    input. Runs find the next one that has rows the same way, over runs of runs; texts do not move for that, the first text of a
    run is picked in each task before the shuffle.
    """
    rows = rows.withColumn("run", F.floor(F.col("doc_id") / span))
    first = F.min_by("text", F.struct(-F.coalesce(F.col("doc_id"), F.lit(0)), F.col("text")))
    heads = cut_lineage(rows.groupBy("run").agg(first.alias("text")))
    above = heads.select("run", F.floor(F.col("run") / span).alias("block"))
    in_block = Window.partitionBy("block").orderBy(F.desc_nulls_last("run"))
    all_blocks = Window.orderBy(F.desc_nulls_last("block"))
    everything = all_blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = above.groupBy("block").agg(F.max("run").alias("block_head")).select(
        "block",
        F.lead("block_head").over(all_blocks).alias("next_head"),
        F.lead(F.lit(1)).over(all_blocks).isNull().alias("final"),
        F.first("block_head").over(everything).alias("very_first"),
    )
    inner = above.select("run", "block", F.lead("run").over(in_block).alias("in_next"), F.lead(F.lit(1)).over(in_block).isNull().alias("last_in"))
    following = F.when(~F.col("last_in"), F.col("in_next")).when(F.col("final"), F.col("very_first")).otherwise(F.col("next_head"))
    linked = inner.join(blocks, inner.block.eqNullSafe(blocks.block)).select("run", following.alias("next_run"))
    texts = heads.select(F.col("run").alias("of_run"), "text")
    followers = linked.join(texts, F.col("next_run").eqNullSafe(F.col("of_run")))
    no_id = F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id")
    return rows.withColumn("follower", F.lit(False)).unionByName(followers.select(no_id, "text", "run", F.lit(True).alias("follower")))


def with_next(rows: DataFrame) -> DataFrame:
    """Rows of ``with_followers``, with whatever columns were added, each with ``next``: a struct of the added columns and the
    text of the row after it. One shuffle by run."""
    others = [c for c in rows.columns if c not in ("doc_id", "run", "follower")]
    order = [F.asc("follower"), F.desc_nulls_last("doc_id"), F.asc("text")]
    following = F.lead(F.struct(*others)).over(Window.partitionBy("run").orderBy(*order))
    return rows.withColumn("next", following).filter("not follower").select("doc_id", *others, "next")


def edited(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down) replaced by as many leading characters of the following one, or all it has."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    kept = F.substring(text, F.lit(1), F.char_length(text) - half)
    return F.concat(kept, F.substring(following, F.lit(1), half))


def compare_with_edited(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """doc_id, text, edited, fingerprint, edited_fingerprint, near_edited and near_next of every document."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = Lexicon(lexicon(rows, low=low, high=high))
    rows = with_next(with_parts(with_followers(rows), "text", words, "own"))
    rows = with_parts(rows.withColumn("edited", edited(F.col("text"), F.col("next.text"))), "edited", words, "changed")
    return rows.select(
        "doc_id", "text", "edited", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next.own")).alias("near_next"),
    )
