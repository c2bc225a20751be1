"""Vectorised words and hashes over the UTF-8 buffers of Arrow text columns (helpers of the worker-side operators).

A batch of texts is one byte buffer with row offsets. Words are runs of bytes of a class; as every byte of a
multi-byte character is at least 0x80, classes that contain all such bytes cut no character. Work runs in pieces of
about ``PIECE`` bytes cut between words, so memory follows the piece and the words of one batch, not the power of
a text's length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 18

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, dtype=np.uint64) + _GOLD
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1] from mixed 64-bit values."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / 9007199254740992.0)


_BYTE = mix(np.arange(256, dtype=np.uint64)) | np.uint64(1)
_P = 0x9E6C63D0876A68EF | 1
_P_INV = pow(_P, -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """First n powers; a table of a piece's length is kept, a longer one (a very long word) is made for the call."""
    kept = _POWERS.get(base)
    if kept is not None and n <= len(kept):
        return kept[:n]
    out = np.full(max(n, PIECE), np.uint64(base), dtype=np.uint64)
    out[0] = 1
    out = np.multiply.accumulate(out)
    if n <= PIECE:
        _POWERS[base] = out
    return out[:n]


def lower_table() -> np.ndarray:
    """Bytes with A-Z mapped to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def byte_class(pattern_ranges: list[tuple[int, int]], inside: bool = True) -> np.ndarray:
    """Byte membership table of inclusive ranges; ``inside`` false gives the complement."""
    table = np.zeros(256, dtype=bool)
    for low, high in pattern_ranges:
        table[low : high + 1] = True
    return table if inside else ~table


ALNUM = byte_class([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])
NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)], inside=False)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    kind = np.int64 if wide else np.int32
    if n == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


class Words:
    """Words of a batch: byte span, 64-bit hash and, by row, where its words begin."""

    def __init__(self, column: pa.Array, inside: np.ndarray, fold: np.ndarray | None = None, spans: bool = True):
        data, rows = buffers(column)
        fold = np.arange(256, dtype=np.uint8) if fold is None else fold
        member = inside[fold]
        value = _BYTE[fold]
        starts, ends, hashes = [], [], []
        for low, high in _pieces(data, rows, member):
            part = data[low:high]
            word = member[part]
            first = word.copy()
            first[1:] &= ~word[:-1]
            cuts = rows[np.searchsorted(rows, low) : np.searchsorted(rows, high)] - low
            first[cuts] = word[cuts]
            s = np.flatnonzero(first)
            last = word.copy()
            last[:-1] &= ~word[1:] | first[1:]
            e = np.flatnonzero(last) + 1
            n = high - low
            total = np.empty(n + 1, dtype=np.uint64)
            total[0] = 0
            np.cumsum(value[part] * _powers(_P, n), out=total[1:])
            h = (total[e] - total[s]) * _powers(_P_INV, n)[s]
            hashes.append(mix(h ^ ((e - s).astype(np.uint64) << np.uint64(40))))
            starts.append(s + low)
            ends.append(e + low)
        self.data, self.rows = data, rows
        self.hash = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.start = np.concatenate(starts) if starts else np.empty(0, np.int64)
        self.end = np.concatenate(ends) if ends else np.empty(0, np.int64)
        self.row = np.searchsorted(self.start, rows)  # first word of each row; the last entry is the total
        if not spans:
            del self.end

    def __len__(self) -> int:
        return len(self.hash)

    def counts(self) -> np.ndarray:
        return np.diff(self.row)

    def row_of(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.rows) - 1), self.counts())

    def words(self, row: int) -> list[bytes]:
        a, b = self.row[row], self.row[row + 1]
        return [self.data[s:e].tobytes() for s, e in zip(self.start[a:b].tolist(), self.end[a:b].tolist())]


def _pieces(data: np.ndarray, rows: np.ndarray, member: np.ndarray):
    """Cuts of the buffer at row starts or between words, about ``PIECE`` bytes apart."""
    low, n = 0, len(data)
    while low < n:
        high = min(n, low + PIECE)
        if high < n:
            k = np.searchsorted(rows, high, side="right") - 1
            if rows[k] > low:
                high = int(rows[k])
            else:  # inside a long text: the next byte outside words
                step = high
                while step < n:
                    gap = np.flatnonzero(~member[data[step : step + PIECE]])
                    if len(gap):
                        step += int(gap[0])
                        break
                    step += PIECE
                high = min(n, step)
        yield low, high
        low = high


def shingles(words: Words, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of a row and, by row, where they begin.

    A row with fewer words, but not none, gives one shingle of all of them if ``short``.
    """
    counts = words.counts()
    per_row = np.maximum(counts - size + 1, 0)
    if short:
        per_row = np.where((counts > 0) & (counts < size), 1, per_row)
    begin = np.concatenate([[0], np.cumsum(per_row)])
    total = int(begin[-1])
    row = np.repeat(np.arange(len(counts)), per_row)
    at = words.row[:-1][row] + (np.arange(total) - begin[:-1][row])
    span = np.minimum(size, counts[row])
    out = np.zeros(total, dtype=np.uint64)
    padded = np.concatenate([words.hash, np.zeros(size, np.uint64)])
    few = np.flatnonzero(span < size) if short else np.empty(0, np.int64)
    for k in range(size):
        part = padded[at + k]
        part[few[span[few] <= k]] = 0
        out = (out ^ (out >> np.uint64(29))) * np.uint64(_P) + part
    return mix(out), begin
