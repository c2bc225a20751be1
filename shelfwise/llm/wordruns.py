"""Runs of words that also occur in another document.

A word lies in a shared run if ``run`` consecutive words around it occur in another document too. Words are lower-cased (A-Z) runs
of letters, digits and bytes beyond ASCII, so spacing and punctuation do not matter.

*Anchors.* Of the ``GRAM``-word grams of each run the one of least hash (the last on a tie) is its anchor, so equal runs have
equal anchors wherever they lie; neighbouring runs with one anchor are one row, named by the anchor's gram (``core``) and by all words
of these runs (``un``). Rows of equal surroundings in two documents are shared as a whole and need no text. Only where
one core has different surroundings are the texts read again: each run of one row per surroundings is hashed, and a hash met in two
documents is a shared run. Runs of one anchor overlap, so the least and the last shared one bound what is covered.

Two documents are told apart by the least and the largest document key, which are combined before the shuffle: no group of
documents is gathered, no pair is built. Joins on cores and surroundings go through ``lookup``, which spreads hot ones.

Defined results: null and empty texts, and texts of fewer than ``run`` words, have no shared words; repeats within one
document, and rows that repeat one doc_id with one text, are no other document; equal texts under different ids share all
their words. Runs are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.shared import bitmap_of, is_marked, slices
from shelfwise.llm.words import ALNUM, Words, lower_table, mix
from shelfwise.operators.keys import lookup
from shelfwise.session import cut_lineage

RUN, GRAM = 50, 12
BITMAP_BITS = 24
PIECE = 1 << 20
_BASE = 0xD6E8FEB86659FD93
_BASE_INV = np.uint64(pow(_BASE, -1, 1 << 64))
_MASK = np.uint64((1 << 24) - 1)


class Spans:
    """Hashes of word spans in constant time each, from prefix sums."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, b, dtype=np.uint64)])) for b in (np.uint64(_BASE), _BASE_INV))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:n], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.down[begin] ^ ((end - begin).astype(np.uint64) << np.uint64(48)))


def anchored(words: Words, run: int = RUN) -> tuple[Spans, np.ndarray, np.ndarray, np.ndarray]:
    """Span hashes, and of every run: its first word, the word where its anchor begins, and its row."""
    spans = Spans(words.hash)
    gram = min(GRAM, run)
    window = run - gram + 1
    first, anchor = [], []
    for low in range(0, max(len(words) - run + 1, 0), PIECE):
        n = min(len(words) - gram + 1 - low, PIECE + window - 1)
        at = np.arange(low, low + n)
        ranked = (spans(at, at + gram) & ~_MASK) | (_MASK - np.arange(n, dtype=np.uint64))
        padded = np.full(-(-n // window) * window, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:n] = ranked
        blocks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = np.arange(n - window + 1)
        least = np.minimum(behind[starts], ahead[starts + window - 1])
        first.append(starts + low)
        anchor.append((_MASK - (least & _MASK)).astype(np.int64) + low)
    if not first:
        none = np.empty(0, np.int64)
        return spans, none, none, none
    first, anchor = np.concatenate(first), np.concatenate(anchor)
    row = np.searchsorted(words.row, first, side="right") - 1
    inside = first + run <= words.row[row + 1]
    return spans, first[inside], anchor[inside], row[inside]


def _grouped(words: Words, run: int):
    """Runs in rows of one anchor: span hashes, all first words, where each row begins, core, surroundings and text."""
    spans, first, anchor, row = anchored(words, run)
    new = np.ones(len(first), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(first))
    a, b, p = first[begin], (first[last - 1] if len(first) else first) + run, anchor[begin]
    core = spans(p, p + min(GRAM, run))
    un = mix(spans(a, b) + (p - a).astype(np.uint64))
    return spans, a, b, core, un, row[begin]


def _found(run: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                words = Words(part.column("text"), ALNUM, lower_table(), spans=False)
                _, a, b, core, un, row = _grouped(words, run)
                columns = [core.view(np.int64), un.view(np.int64), part.column("dk").to_numpy()[row], a - words.row[row], (b - a - run).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["core", "un", "dk", "at", "more"])

    return scan


def _runs(run: int):
    """Every run of the rows asked for: surroundings, place among the runs of its anchor, hash, and the documents that hold it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                words = Words(part.column("text"), ALNUM, lower_table(), spans=False)
                spans = Spans(words.hash)
                wants = part.column("wants")
                flat = wants.flatten()
                row = np.repeat(np.arange(part.num_rows), pa.compute.list_value_length(wants).to_numpy())
                un, at, more, d1, d2 = (flat.field(name).to_numpy() for name in ("un", "at", "more", "d1", "d2"))
                sizes = more.astype(np.int64) + 1
                which = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                start = (words.row[row] + at)[which] + place
                columns = [un[which], place.astype(np.int32), spans(start, start + run).view(np.int64), d1[which], d2[which]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["un", "place", "hash", "d1", "d2"])

    return scan


def _marked(bitmap):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_marked(bitmap.value, batch.column("dk").to_numpy() & ((1 << BITMAP_BITS) - 1))))

    return scan


def _covered() -> Column:
    """Words covered by the spans (start, end) of a document, overlaps once."""

    def step(state: Column, span: Column) -> Column:
        fresh = F.greatest(span["end"] - F.greatest(span["start"], state["reach"]), F.lit(0).cast("long"))
        return F.struct((state["n"] + fresh).alias("n"), F.greatest(state["reach"], span["end"]).alias("reach"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    return F.aggregate(F.sort_array("spans"), zero, step, lambda s: s["n"])


def shared_words(rows: DataFrame, run: int = RUN) -> DataFrame:
    """dk, n_shared_words of the documents that hold words in shared runs. ``rows``: dk (key of document and text), text (not null)."""
    found = cut_lineage(rows.select("dk", "text").mapInArrow(_found(run), "core long, un long, dk long, at long, more int"))
    place = F.min(F.struct("dk", "at", "more")).alias("place")
    kinds = cut_lineage(found.groupBy("core", "un").agg(F.min("dk").alias("d1"), F.max("dk").alias("d2"), place))
    whole = kinds.filter("d1 != d2").select("un", F.lit(0).alias("low"), F.col("place.more").alias("high"))

    # one core in several surroundings, some of which only one document has
    cores = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("d1").alias("c1"), F.max("d2").alias("c2"), F.min(F.col("d1") != F.col("d2")).alias("all_shared"))
    cores = cores.filter("kinds > 1 and c1 != c2 and not all_shared").select("core")
    mixed = cut_lineage(lookup(kinds, cores, "core", ["un"], how="inner").select("un", "d1", "d2", "place.*"))
    wants = mixed.groupBy("dk").agg(F.collect_list(F.struct("un", "at", "more", "d1", "d2")).alias("wants"))
    spot = F.col("dk").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).cast("int")
    marks = rows.sparkSession.sparkContext.broadcast(bitmap_of(mixed.select(spot.alias("spot")), BITMAP_BITS))
    near = rows.select("dk", "text").mapInArrow(_marked(marks), "dk long, text string").dropDuplicates(["dk"])
    runs = cut_lineage(near.join(wants, "dk").mapInArrow(_runs(run), "un long, place int, hash long, d1 long, d2 long"))
    twice = runs.groupBy("hash").agg(F.min("d1").alias("d1"), F.max("d2").alias("d2")).filter("d1 != d2").select("hash")
    partly = lookup(runs.filter("d1 = d2"), twice, "hash", ["un", "place"], how="inner").groupBy("un").agg(F.min("place").alias("low"), F.max("place").alias("high"))

    hits = lookup(found.select("un", "dk", "at"), cut_lineage(whole.unionByName(partly)), "un", ["dk", "at"], how="inner")
    spans = F.collect_set(F.struct((F.col("at") + F.col("low")).alias("start"), (F.col("at") + F.col("high") + run).alias("end")))
    return hits.groupBy("dk").agg(spans.alias("spans")).select("dk", _covered().alias("n_shared_words"))
