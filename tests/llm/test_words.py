"""Worker-side helpers against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import bagminhash, bwtmerge, licenses, words as W

TEXTS = ["Hello wörld, a", "", None, "b b B  x", "a" * 300 + " é9 " * 50, "  ", "a", "漢字 abc漢 1-2"]


@pytest.mark.parametrize("piece", [61, 1 << 18])
def test_words_equal_a_regular_expression(monkeypatch, piece):
    monkeypatch.setattr(W, "PIECE", piece)
    fold = bytes(W.lower_table())
    found = W.Words(pa.array(TEXTS), W.ALNUM, W.lower_table())
    by_hash = {}
    for i, text in enumerate(TEXTS):
        plain = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(fold))
        assert [w.translate(fold) for w in found.words(i)] == plain
        for word, h in zip(plain, found.hash[found.row[i] : found.row[i + 1]].tolist()):
            assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_shingles_of_short_rows():
    found = W.Words(pa.array(["a b c d e f", "a b", None, "a b c d e"]), W.ALNUM)
    hashes, begin = W.shingles(found, 5)
    assert np.diff(begin).tolist() == [2, 1, 0, 1]
    assert hashes[0] == hashes[3] and hashes[0] != hashes[1]
    assert np.diff(W.shingles(found, 5, short=False)[1]).tolist() == [2, 0, 0, 1]


def test_signature_estimates_weighted_jaccard():
    rng = np.random.default_rng(3)
    keys = W.mix(np.arange(500, dtype=np.uint64))
    weights = rng.integers(1, 20, 500)
    a, b = {int(k): int(w) for k, w in zip(keys[:400], weights[:400])}, {int(k): int(w) for k, w in zip(keys[60:], weights[60:])}
    b.update({k: w + 3 for k, w in list(b.items())[:50]})
    both = [(k, w, r) for r, bag in ((0, a), (1, b)) for k, w in sorted(bag.items())]
    marks = bagminhash.signatures(np.array([x[0] for x in both], np.uint64), np.array([x[1] for x in both]), np.array([x[2] for x in both]), 2, 4096)
    exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in a) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a.keys() | b.keys())
    assert abs((marks[0] == marks[1]).mean() - exact) < 4 * (exact * (1 - exact) / 4096) ** 0.5


def test_interleave_equals_brute_force():
    rng = np.random.default_rng(5)
    for trial in range(150):
        span, n = int(rng.integers(0, 11)), int(rng.integers(1, 30))
        group = np.sort(rng.integers(0, 4, n))
        side = lambda: bytes(rng.choice(list(b"ab" if trial % 2 else b"a"), span if rng.random() < 0.8 else int(rng.integers(0, span + 1))).tolist())
        left, right = [side() for _ in range(n)], [side() for _ in range(n)]
        low, high = bwtmerge.repeats(group, left, right, span)
        strings = [
            {x: (int(group[i]), x, left[i][len(left[i]) - x :], right[i][: span - x]) for x in range(span + 1) if x <= len(left[i]) and span - x <= len(right[i])}
            for i in range(n)
        ]
        for i in range(n):
            others = {s for j in range(n) if j != i for s in strings[j].values()}
            xs = [x for x, s in strings[i].items() if s in others]
            assert (low[i], high[i]) == ((min(xs), max(xs)) if xs else (-1, -1))


def test_anchor_in_every_string_at_the_same_offset():
    rng = np.random.default_rng(2)
    core = bytes(rng.integers(97, 123, 2900).tolist())
    texts = [core, b"x" * 37 + core + b"tail" * 20, b"ab" * 700, b"short"]
    column = pa.array([t.decode() for t in texts])
    data, rows = W.buffers(column)
    at, row = bwtmerge.anchors(data, rows)
    places = [set((at[row == r] - rows[r]).tolist()) for r in range(4)]
    assert not places[3]
    for r, text in enumerate(texts[:3]):
        for p in range(len(text) - 399):
            assert any(p <= a <= p + 368 for a in places[r])
    inner = {a for a in places[0] if 368 < a < 2500}
    assert inner and inner <= {a - 37 for a in places[1]}


def test_bands_meet_the_promised_probability():
    for similarity in (0.1, 0.19, 0.5, 1.0):
        bands = licenses.bands_for(similarity, 1e-6)
        assert (1 - similarity) ** bands <= 1e-6 * 1.0001
    with pytest.raises(ValueError):
        licenses.Library([("none", "...")], 0.8, 1e-6)
