"""License scan: MinHash bands over overlapping text windows find templates, exact shingle containment confirms them.

Words are lower-cased and digits read alike, so version numbers do not matter. A template of t words belongs to the window
class of the least L = 8, 16, 32, ... that is not below t; windows of a class are 2L shingles long and start every L, so each
run of L shingles lies within one window. A window that holds a share ``least`` of a template's shingles has at least the
Jaccard similarity ``floor_of`` with it, and the number of one-hash bands is chosen so that such a window and the template meet in a
band with a probability of ``1 - miss``. Every meeting is then checked on the shingles themselves.

Minimum hashes are taken over blocks of 8 shingles once and combined into the blocks of the longer classes, so a text costs
one pass per hash, whatever the templates. Templates are a small stated query set; documents never move.

Defined results: null texts and texts without words match nothing; a template of fewer words than a shingle is one shingle of
all of them; templates without words are refused; repeated template names are one license; input columns named like
added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from shelfwise.llm.shared import slices
from shelfwise.llm.words import ALNUM, Words, lower_table, mix, shingles

SHINGLE, BLOCK, LEAST, MISS = 3, 8, 0.8, 1e-6

# Public license notices looked for unless others are given.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
)

ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("license", T.StringType()), T.StructField("containment", T.DoubleType()), T.StructField("word", T.LongType()),
    ]))),
])
_MATCHES = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("word", pa.int64())]))


def fold_table() -> np.ndarray:
    table = lower_table()
    table[48:58] = 48
    return table


def window_class(words: int) -> int:
    """Window class of a template by its number of words."""
    return max(BLOCK, 1 << math.ceil(math.log2(max(1, words))))


def floor_of(distinct: int, length: int, least: float) -> float:
    """Least Jaccard similarity of a window (2 * length shingles at most) that holds ``least`` of ``distinct`` shingles."""
    held = math.ceil(least * distinct - 1e-9)
    return held / (2 * length + distinct - held)


def bands_for(similarity: float, miss: float) -> int:
    """One-hash bands for which sets of this similarity miss each other with a probability of ``miss`` at most."""
    return max(1, math.ceil(math.log(miss) / math.log1p(-min(similarity, 1 - 1e-12))))


class Library:
    def __init__(self, templates: Sequence[tuple[str, str]], least: float, miss: float):
        self.names = [name for name, _ in templates]
        words = Words(pa.array([text for _, text in templates], pa.string()), ALNUM, fold_table())
        counts = words.counts()
        if not len(templates) or (counts == 0).any():
            raise ValueError("every template needs words")
        hashes, begin = shingles(words, SHINGLE)
        self.sets = [np.unique(hashes[a:b]) for a, b in zip(begin[:-1], begin[1:])]
        self.need = [math.ceil(least * len(s) - 1e-9) for s in self.sets]
        self.classes: dict[int, list[int]] = {}
        for i, n in enumerate(counts.tolist()):
            self.classes.setdefault(window_class(n), []).append(i)
        self.bands = {
            length: max(bands_for(floor_of(len(self.sets[i]), length, least), miss) for i in members) for length, members in self.classes.items()
        }
        most = max(self.bands.values())
        self.salt = mix(np.arange(most, dtype=np.uint64))
        self.odd = mix(self.salt) | np.uint64(1)
        self.marks = [np.array([self.permuted(s, k).min() for k in range(most)], dtype=np.uint64) for s in self.sets]

    def permuted(self, hashes: np.ndarray, k: int) -> np.ndarray:
        return (hashes ^ self.salt[k]) * self.odd[k]

    def met(self, hashes: np.ndarray, begin: np.ndarray) -> set[tuple[int, int, int]]:
        """(row, block, template): windows, named by their first block, that share a band with a template."""
        if not len(hashes):
            return set()
        per_row = np.diff(begin)
        blocks = -(-per_row // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        row = np.repeat(np.arange(len(blocks)), blocks)
        at = begin[:-1][row] + (np.arange(first[-1]) - first[:-1][row]) * BLOCK
        layers = {}
        length, inside, count = BLOCK, np.arange(first[-1]) - first[:-1][row], blocks
        owner = row
        while True:
            layers[length] = (owner, inside, count)
            if length >= max(self.classes):
                break
            length *= 2
            pick = inside % 2 == 0
            owner, inside, count = owner[pick], inside[pick] // 2, -(-count // 2)
        found: set[tuple[int, int, int]] = set()
        for k in range(len(self.salt)):
            least = np.minimum.reduceat(self.permuted(hashes, k), at)
            length = BLOCK
            while True:
                owner, inside, _ = layers[length]
                members = self.classes.get(length, ())
                if k < self.bands.get(length, 0):
                    for t in members:
                        # the block that holds the minimum names the windows that may have it as their minimum
                        for b in np.flatnonzero(least == self.marks[t][k]).tolist():
                            for start in (b - 1, b):
                                other = b - 1 if start < b else b + 1
                                same = 0 <= other < len(least) and owner[other] == owner[b]
                                if (start == b or same) and not (same and least[other] < least[b]):
                                    found.add((int(owner[b]), int(inside[start]), t))
                if length >= max(self.classes):
                    break
                even = np.flatnonzero(inside % 2 == 0)
                paired = even + 1
                has = (paired < len(least)) & (owner[np.minimum(paired, len(least) - 1)] == owner[even])
                after = np.where(has, least[np.minimum(paired, len(least) - 1)], np.uint64(0xFFFFFFFFFFFFFFFF))
                least = np.minimum(least[even], after)
                length *= 2
        return found

    def scan(self, words: Words) -> dict[int, list[dict]]:
        hashes, begin = shingles(words, SHINGLE)
        best: dict[tuple[int, str], tuple[float, int]] = {}
        for row, block, t in sorted(self.met(hashes, begin)):
            length = window_class_of(self, t)
            low = begin[row] + block * length
            window = hashes[low : min(low + 2 * length, begin[row + 1])]
            inside = np.isin(window, self.sets[t])
            held = len(np.unique(window[inside]))
            if held >= self.need[t]:
                name, share = self.names[t], held / len(self.sets[t])
                word = int(block * length + np.flatnonzero(inside)[0])
                old = best.get((row, name))
                if old is None or (-share, word) < (-old[0], old[1]):
                    best[row, name] = (share, word)
        out: dict[int, list[dict]] = {}
        for (row, name), (share, word) in sorted(best.items()):
            out.setdefault(row, []).append({"license": name, "containment": share, "word": word})
        return out


def window_class_of(library: Library, template: int) -> int:
    return next(length for length, members in library.classes.items() if template in members)


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, text: str = "text", least: float = LEAST, miss: float = MISS) -> DataFrame:
    """Add ``n_words`` and ``matches`` (license, best containment and where it begins, by name) to every document."""
    library = Library(templates, least, miss)
    shared = docs.sparkSession.sparkContext.broadcast(library)
    out = docs.select([c for c in docs.columns if c not in ADDED.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            for part in slices(batch, text):
                words = Words(part.column(text), ALNUM, fold_table(), spans=False)
                found = held.scan(words)
                matches = pa.array([found.get(r, []) for r in range(part.num_rows)], _MATCHES)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(words.counts(), pa.int64()), matches], [*part.schema.names, *ADDED.names])

    return out.mapInArrow(run, T.StructType([*out.schema.fields, *ADDED.fields]))
