"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are shuffled by their whole text (copies are counted before the shuffle, so a text with a third of all rows
is one row a task). Every distinct text is encoded by both tokenizers and cut into groups at the byte offsets where
tokens of both end; tokens of a group whose bytes overlap are linked. The links of a text are kept as pairs of ids with
their number of occurrences. The corpus-wide count of a pair is the number of documents that hold it: the sum of the
copies over the distinct texts. Pairs then bring their counts back to the texts, and each document finds the measures of its
text by the text's SHA-256.

Counts come back in two ways. The most frequent pairs (at most ``FREQUENT``, chosen by a threshold on the count) are broadcast
and meet the links where they lie; all other pairs are held by few documents each and are joined by shuffle, so no pair is a
hot key. Measures are joined to documents by a salted lookup.

Inside a text, a single space between two other characters always begins a token of both tokenizers (``Pair`` checks this of
its files, and else keeps texts whole). The words between such spaces repeat a lot, so a worker aligns a word once and puts texts
together from words; it forgets its words beyond ``WORDS``. Memory follows the longest text and the slice of about 4 MB
of texts in work.

Defined results: null and empty texts, and texts that one of the tokenizers does not give back byte by byte (the piece
model reads U+2581 as a space), have no tokens and zeros; strings of special tokens are plain text; repeated rows and ids are
documents of their own; an empty table gives no rows; input columns named like added ones are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.shared import slices
from shelfwise.operators.keys import HOT_ROWS, lookup
from shelfwise.session import cut_lineage

FOLDER = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
FREQUENT = 1 << 19
WORDS = 250_000
MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
ADDED = (*MEASURES, "groups_sha256")

_SPACE = re.compile(r"(?<=\S) (?=\S)")
_LINE = "\N{LOWER ONE EIGHTH BLOCK}"  # how piece models write a space


def byte_letters() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the others are numbered from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class Table:
    """Byte strings of a vocabulary as one buffer."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.size = np.array([len(e) for e in entries], dtype=np.int64)
        digits = [str(i).encode() for i in range(len(entries))]
        self.width = len(digits[-1])
        self.digits = np.frombuffer(b"".join(d.ljust(self.width) for d in digits), dtype=np.uint8).reshape(-1, self.width)
        self.length = np.array([len(d) for d in digits])


class Pair:
    """Both tokenizers with the bytes of their entries."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(byte_path)
        self.first.encode_special_tokens = True
        letters = byte_letters()
        spelled = lambda entry: bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        names = {i: entry for entry, i in self.first.get_vocab(with_added_tokens=True).items()}
        self.a = Table([spelled(names.get(i, "")) for i in range(max(names) + 1)])
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        byte_of = lambda i, p: bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace(_LINE, " ").encode()
        self.b = Table([byte_of(i, p) for i, p in enumerate(pieces)])
        with open(byte_path, encoding="utf-8") as file:
            split = json.load(file).get("pre_tokenizer") or {}
        self.cuts = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not any(_LINE in p.lstrip(_LINE) for p in pieces)

    def words(self, text: str) -> list[str]:
        return _SPACE.split(text) if self.cuts else [text]

    def encode(self, words: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        first = self.first.encode_batch_fast([f" {w}" for w in words], add_special_tokens=False)
        return [e.ids for e in first], self.second.encode(words, num_threads=1)


@lru_cache(maxsize=2)
def pair_of(byte_path: str, piece_path: str) -> Pair:
    return Pair(byte_path, piece_path)


class Aligned:
    """Words aligned so far: ids to be linked, group text and measures of each."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.at: dict[str, int] = {}
        self.texts: list[bytes] = []
        self.measures = np.empty((0, 4), dtype=np.int64)  # tokens of both, groups, 1 if not given back
        self.links, self.begin = np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)

    def forget(self, fresh: list[str]) -> None:
        """Keep the first ``WORDS`` words."""
        for word in fresh[WORDS - len(self.at) :]:
            del self.at[word]
        self.texts, self.measures = self.texts[:WORDS], self.measures[:WORDS]
        self.begin = self.begin[: WORDS + 1]
        self.links = self.links[: self.begin[-1]]

    def learn(self, words: list[str]) -> None:
        """Align words not met before."""
        pair = self.pair
        plain = [f" {w}".encode() for w in words]
        sizes = np.array([len(p) for p in plain], dtype=np.int64)
        base = np.concatenate([[0], np.cumsum(sizes)])
        sides, flats, counts = pair.encode(words), [], []
        good = np.ones(len(words), dtype=bool)
        for table, side in zip((pair.a, pair.b), sides):
            count = np.array([len(x) for x in side], dtype=np.int64)
            flat = np.fromiter(chain.from_iterable(side), dtype=np.int64, count=int(count.sum()))
            upto = np.concatenate([[0], np.cumsum(table.size[flat])])[np.cumsum(count)]
            back = b"".join([table.entries[i] for i in flat.tolist()])
            if not np.array_equal(upto, base[1:]) or back != b"".join(plain):
                good &= np.array([b"".join([table.entries[i] for i in x]) == p for x, p in zip(side, plain)], dtype=bool)
            flats.append(flat)
            counts.append(count)
        ids, ends = [], []
        for side, table in enumerate((pair.a, pair.b)):
            ids.append(flats[side][np.repeat(good, counts[side])])
            counts[side] = np.where(good, counts[side], 0)
            total = np.cumsum(table.size[ids[side]])
            before = np.concatenate([[0], total])[np.cumsum(counts[side]) - counts[side]]
            ends.append(total + np.repeat(base[:-1] - before, counts[side]))
        marks = np.zeros(int(base[-1]) + 1, dtype=np.uint8)
        for bit, end in zip((1, 2), ends):
            marks[end] |= bit
        bounds = np.flatnonzero(marks)  # every stretch between two ends is one token of each side, and one link
        kind = marks[bounds]
        at = [np.cumsum(kind & bit > 0) - (kind & bit > 0) for bit in (1, 2)]
        links = ids[0][at[0]] * len(pair.b.entries) + ids[1][at[1]]
        word_of = np.searchsorted(base, bounds, side="left") - 1
        common = kind == 3
        groups = np.bincount(word_of[common], minlength=len(words))
        text, begin = self._spelled(ids, ends, bounds[common])
        lead = np.concatenate([[0], np.cumsum(counts[0] + counts[1])])
        for k in range(len(words)):
            self.texts.append(text[begin[lead[k]] : max(begin[lead[k]], begin[lead[k + 1]] - 1)])
        self.at.update(zip(words, range(len(self.at), len(self.at) + len(words))))
        self.measures = np.concatenate([self.measures, np.stack([counts[0], counts[1], groups, ~good], axis=1)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.bincount(word_of, minlength=len(words)))])
        self.links = np.concatenate([self.links, links])

    def _spelled(self, ids: list[np.ndarray], ends: list[np.ndarray], common: np.ndarray) -> tuple[bytes, np.ndarray]:
        """``a,a|b;a|b,b;`` for all groups, and where each token begins in it."""
        group = [np.searchsorted(common, e, side="left") for e in ends]
        upto = [np.concatenate([[0], np.cumsum(np.bincount(g, minlength=len(common)))]) for g in group]
        place = [np.arange(len(ids[0])) + upto[1][group[0]], np.arange(len(ids[1])) + upto[0][group[1] + 1]]
        tables = (self.pair.a, self.pair.b)
        width, total = max(t.width for t in tables) + 1, len(ids[0]) + len(ids[1])
        cells, sizes = np.zeros((total, width), dtype=np.uint8), np.zeros(total, dtype=np.int64)
        for side, last in ((0, b"|"), (1, b";")):
            table = tables[side]
            rows = np.zeros((len(ids[side]), width), dtype=np.uint8)
            rows[:, : table.width] = table.digits[ids[side]]
            length = table.length[ids[side]]
            rows[np.arange(len(rows)), length] = np.where(ends[side] == common[group[side]], ord(last), ord(","))
            cells[place[side]], sizes[place[side]] = rows, length + 1
        kept = np.arange(width) < sizes[:, None]
        return cells[kept].tobytes(), np.concatenate([[0], np.cumsum(sizes)])

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Measures and group digest of each text; its distinct links, their occurrences, and where those of each text begin."""
        words = [self.pair.words(t) for t in texts]
        fresh = list(dict.fromkeys([w for ws in words for w in ws if w not in self.at]))
        if fresh:
            self.learn(fresh)
        at = np.array([self.at[w] for ws in words for w in ws], dtype=np.int64)
        begin = np.concatenate([[0], np.cumsum([len(ws) for ws in words])])
        measures = np.add.reduceat(self.measures[at], begin[:-1], axis=0)
        good = measures[:, 3] == 0
        digests = [
            hashlib.sha256(b";".join([self.texts[i] for i in at[a:b].tolist()])).hexdigest() if ok else ""
            for a, b, ok in zip(begin[:-1].tolist(), begin[1:].tolist(), good)
        ]
        text = np.repeat(np.arange(len(texts)), np.diff(begin))
        at, text = at[good[text]], text[good[text]]
        size = self.begin[at + 1] - self.begin[at]
        spot = np.repeat(self.begin[at] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
        codes = len(self.pair.a.entries) * len(self.pair.b.entries)
        links, times = np.unique(np.repeat(text, size) * codes + self.links[spot], return_counts=True)
        bounds = np.searchsorted(links, np.arange(len(texts) + 1) * codes)
        n_links = np.bincount(np.repeat(text, size), minlength=len(texts))
        out = np.column_stack([measures[:, :3], n_links])
        out[~good] = 0
        if len(self.at) > WORDS:
            self.forget(fresh)
        return out, digests, links % codes, times, bounds


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def aligned_texts(docs: DataFrame, text: str = "text", folder: str = FOLDER, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE) -> DataFrame:
    """key, copies, n_a, n_b, n_groups, n_links, groups_sha256, links (ids as a * size of b + b) and times of each distinct text."""
    paths = (f"{folder}/{byte_file}", f"{folder}/{piece_file}")
    texts = docs.select(F.col(text).cast("string").alias("text")).filter("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    schema = "key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<long>, times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Aligned(pair_of(*paths))
        for batch in batches:
            for part in slices(batch, "text"):
                measures, digests, links, times, bounds = words.align(part.column("text").to_pylist())
                bounds = pa.array(bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"), part.column("copies"), *[pa.array(m) for m in measures.T], pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(bounds, pa.array(links)), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                    ],
                    ["key", "copies", *MEASURES[:4], "groups_sha256", "links", "times"],
                )

    return texts.select(text_key(F.col("text")).alias("key"), "copies", "text").mapInArrow(run, schema)


def pair_counts(texts: DataFrame, b_size: int) -> DataFrame:
    """pair, count (documents that hold it) and best (no pair of its A id has a higher count)."""
    counts = cut_lineage(texts.select(F.explode("links").alias("pair"), "copies").groupBy("pair").agg(F.sum("copies").alias("count")))
    own = F.floor(F.col("pair") / b_size).alias("a")  # ids are below 2^53 / size of b
    highest = counts.groupBy(own).agg(F.max("count").alias("highest"))  # one row an A id
    joined = counts.withColumn("a", own).join(F.broadcast(highest), "a")
    return joined.select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """Least count above which there are at most ``most`` pairs, to an eighth of a power of two."""
    step = F.floor(F.log2("count") * 8).cast("int").alias("step")
    found = sorted((r.step, r.n) for r in counts.groupBy(step).agg(F.count(F.lit(1)).alias("n")).collect())  # at most 512 rows
    least, total = found[-1][0] + 1 if found else 0, 0
    for at, n in reversed(found):
        total += n
        if total > most:
            break
        least = at
    return int(np.ceil(2.0 ** (least / 8) - 1e-9))


def text_measures(texts: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """key, n_best and count_sum of every text with links."""
    links = texts.select("key", F.explode(F.arrays_zip("links", "times")).alias("x")).select("key", F.col("x.links").alias("pair"), F.col("x.times").alias("times"))
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")]
    least = frequent_from(counts, frequent)
    known = F.broadcast(counts.filter(F.col("count") >= least))
    rare = counts.filter(F.col("count") < least)
    near = links.join(known, "pair").groupBy("key").agg(*sums)
    far = links.join(known.select("pair"), "pair", "left_anti").join(rare, "pair").groupBy("key").agg(*sums)
    return near.unionByName(far).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", folder: str = FOLDER, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE,
    frequent: int = FREQUENT, hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(every document's id with its measures and group digest, the pairs of ids with their counts)."""
    b_size = len(pair_of(f"{folder}/{byte_file}", f"{folder}/{piece_file}").b.entries)
    texts = cut_lineage(aligned_texts(docs, text, folder, byte_file, piece_file))
    counts = cut_lineage(pair_counts(texts, b_size))
    measures = texts.drop("links", "times", "copies").join(text_measures(texts, counts, frequent), "key", "left")
    names = docs.select(F.col(doc_id).alias("doc_id"), F.nullif(F.col(text).cast("string"), F.lit("")).alias("t"))
    names = cut_lineage(names.select("doc_id", text_key(F.col("t")).alias("key"), F.xxhash64(F.rand(7)).alias("__row")))
    found = lookup(names, measures, "key", ["__row"], hot_rows=hot_rows)
    zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in MEASURES]
    pairs = counts.select(F.floor(F.col("pair") / b_size).cast("int").alias("a"), (F.col("pair") % b_size).cast("int").alias("b"), "count", "best")
    return found.select("doc_id", *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), pairs
