"""Benchmark decontamination by winnowing.

Both sides keep, in every run of ``span`` words, the smallest hash of ``k`` consecutive words (all of them on a tie),
so a run of ``span`` shared words always has a kept hash in common at the same place. Documents are scanned against
the kept hashes of the benchmark; every common one is extended word by word in both directions, and a run of at least
``span`` equal words is a hit. Items shorter than ``span`` words are one window of their own length (winnowing with a
window of one hash).

The benchmark is the small side of a stated query set: it is read in blocks of about ``block_bytes``, and each block is
one pass over the documents within the same stage, whatever its number. Documents never move between executors.

Defined results: a null text has no words; an item without an id or without words takes no part; items sharing an id
count once; an empty benchmark leaves every document clean; an input column named like an added one is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from shelfwise.llm.shared import slices
from shelfwise.llm.words import ALNUM, Words, lower_table, shingles

SPAN = 10
K = 5
BLOCK_BYTES = 32 << 20
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
])
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = bytes(lower_table())


def plain_words(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().translate(_FOLD))


def winnowed(hashes: np.ndarray, begin: np.ndarray, window: int) -> np.ndarray:
    """Mask of the hashes kept: the smallest ones of every run of ``window`` hashes of a row (of a shorter row: its smallest)."""
    keep = np.zeros(len(hashes), dtype=bool)
    if not len(hashes):
        return keep
    per_row = np.diff(begin)
    full = np.repeat(np.maximum(per_row - window + 1, 0), per_row)
    inside = np.arange(len(hashes)) - np.repeat(begin[:-1], per_row)
    at = np.flatnonzero(inside < full)
    least = hashes[at]
    for j in range(1, window):
        least = np.minimum(least, hashes[at + j])
    for j in range(window):
        keep[at[hashes[at + j] == least] + j] = True
    few = np.flatnonzero((per_row > 0) & (per_row < window))
    for r in few.tolist():
        part = hashes[begin[r] : begin[r + 1]]
        keep[begin[r] : begin[r + 1]] = part == part.min()
    return keep


class Block:
    """Windows of one block of benchmark items, prepared once per worker."""

    def __init__(self, items: Sequence[tuple[str, str]], span: int, k: int):
        self.span, self.k = span, k
        self.items = [(item, words) for item, text in items if (words := plain_words(text))]
        self.names = [item for item, _ in self.items]
        column = pa.array([b" ".join(words).decode() for _, words in self.items], pa.string())
        words = Words(column, ALNUM, lower_table())
        counts = words.counts()
        self.at: dict[int, list[tuple[int, int]]] = defaultdict(list)
        hashes, begin = shingles(words, k, short=False)
        kept = np.flatnonzero(winnowed(hashes, begin, span - k + 1))
        row = np.searchsorted(begin, kept, side="right") - 1
        for h, r, p in zip(hashes[kept].tolist(), row.tolist(), (kept - begin[row]).tolist()):
            if counts[r] >= span:
                self.at[h].append((r, p))
        self.short: dict[int, dict[int, list[int]]] = {}
        for n in sorted({int(c) for c in counts if c < span}):
            grams, first = shingles(words, n, short=False)
            table: dict[int, list[int]] = defaultdict(list)
            for r in np.flatnonzero(counts == n).tolist():
                table[int(grams[first[r]])].append(r)
            self.short[n] = table
        self.keys = np.array(sorted(self.at), dtype=np.uint64)
        self.short_keys = {n: np.array(sorted(t), dtype=np.uint64) for n, t in self.short.items()}

    def scan(self, words: Words) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
        """By row with hits: the covered word spans (merged) and the items."""
        found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        hashes, begin = shingles(words, self.k, short=False)
        for n, keys, kept in [
            (0, self.keys, winnowed(hashes, begin, self.span - self.k + 1)),
            *[(n, keys, None) for n, keys in self.short_keys.items()],
        ]:
            if n:
                hashes, begin = shingles(words, n, short=False)
            at = np.arange(len(hashes)) if kept is None else np.flatnonzero(kept)
            at = at[_among(hashes[at], keys)]
            row = np.searchsorted(begin, at, side="right") - 1
            for r, p, h in zip(row.tolist(), (at - begin[row]).tolist(), hashes[at].tolist()):
                found[r].append((n, p, h))
        out = {}
        for r, hits in found.items():
            spans, names = self._extend([w.translate(_FOLD) for w in words.words(r)], hits)
            if spans:
                out[r] = (merged(spans), names)
        return out

    def _extend(self, doc: list[bytes], hits: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int]], set[str]]:
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        reached: dict[tuple[int, int], int] = {}  # by item and diagonal: end of the last run
        for n, p, h in hits:
            for r, q in [(r, 0) for r in self.short[n].get(h, ())] if n else self.at.get(h, ()):
                item = self.items[r][1]
                if n:
                    if doc[p : p + n] == item:
                        spans.append((p, p + n))
                        names.add(self.names[r])
                    continue
                if reached.get((r, p - q), -1) > p:
                    continue
                low = 0
                while low < min(p, q) and doc[p - low - 1] == item[q - low - 1]:
                    low += 1
                high, most = 0, min(len(doc) - p, len(item) - q)
                while high < most and doc[p + high] == item[q + high]:
                    high += 1
                reached[r, p - q] = p + high
                if low + high >= self.span:
                    spans.append((p - low, p + high))
                    names.add(self.names[r])
        return spans, names


def _among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(values), dtype=bool)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items with an id and a text, in blocks of about ``block_bytes``; one block at a time is on the driver."""
    items = benchmark.filter(F.col(item).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text")
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield [(r.item, r.text) for r in part.collect()]


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    k: int = K,
    block_bytes: int = BLOCK_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (merged word spans, end exclusive) and ``hit_items`` (distinct ids as strings) to every document."""
    if not 0 < k <= span:
        raise ValueError("k must lie between 1 and span")
    out = docs.select([c for c in docs.columns if c not in ADDED.names])
    for number, items in enumerate(benchmark_blocks(benchmark, item, item_text, block_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        schema = out.schema if number else T.StructType([*out.schema.fields, *ADDED.fields])
        out = out.mapInArrow(_scanner(shared, text, span, k), schema)
    return out if keep_text else out.drop(text)


def _scanner(shared, text: str, span: int, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(shared.value, span, k)
        for batch in batches:
            for part in slices(batch, text):
                words = Words(part.column(text), ALNUM, lower_table())
                found = block.scan(words)
                n = part.num_rows
                spans: list[list] = [[] for _ in range(n)]
                names: list[list] = [[] for _ in range(n)]
                earlier = "hit_spans" in part.schema.names
                if earlier:
                    spans, names = part.column("hit_spans").to_pylist(), part.column("hit_items").to_pylist()
                for r, (runs, items) in found.items():
                    runs = merged([*runs, *[(s["start"], s["end"]) for s in spans[r]]])
                    spans[r] = [{"start": a, "end": b} for a, b in runs]
                    names[r] = sorted(items.union(names[r]))
                added = [pa.array(words.counts(), pa.int64()), pa.array(spans, _SPANS), pa.array(names, pa.list_(pa.string()))]
                kept = [x for x in part.schema.names if x not in ADDED.names]
                yield pa.RecordBatch.from_arrays([*[part.column(x) for x in kept], *added], [*kept, *ADDED.names])

    return scan


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents no benchmark window occurs in, with their own columns."""
    marked = mark(docs, benchmark, **options).filter(F.size("hit_spans") == 0)
    return marked.select([c for c in docs.columns if c not in ADDED.names])
