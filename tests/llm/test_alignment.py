"""Token alignment against both tokenizers run over whole texts, one by one."""

import hashlib
import os
from collections import Counter

import pytest

from shelfwise.llm import alignment as A

pytestmark = pytest.mark.skipif(not os.path.exists(f"{A.FOLDER}/{A.BYTE_FILE}"), reason="tokenizer files are absent")


def linked(pair, text):
    """Tokens of both, groups and links of a text; none if a tokenizer does not give it back."""
    whole = f" {text}".encode()
    a, b = pair.first.encode(f" {text}", add_special_tokens=False).ids, pair.second.encode(text)
    spans = []
    for ids, table in ((a, pair.a), (b, pair.b)):
        if b"".join(table.entries[i] for i in ids) != whole:
            return None
        end, out = 0, []
        for i in ids:
            out.append((end, end := end + len(table.entries[i])))
        spans.append(out)
    links = Counter((a[i], b[j]) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if max(x[0], y[0]) < min(x[1], y[1]))
    groups, low = [], 0
    for high in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
        groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own) if low <= s and e <= high) for ids, own in zip((a, b), spans)))
        low = high
    return len(a), len(b), groups, links


def rows_of(text_of):
    long = " ".join(text_of(9, 400).split())
    odd = ["x ▁ y", " lead", " ", "trail  ", "a\n\nb  c\td", "<|endoftext|> is <s> text </s>", "éè 中文 \U0001f642 z", "can't  stop", "　wide gap x", "1 2 33 .. !"]
    return [(i, t) for i, t in enumerate(odd)] + [(20, None), (21, ""), (22, long), (22, long), (None, long)] + [(30 + i, "hot copy text") for i in range(40)] + [(80, text_of(3, 30)), (81, text_of(4, 30))]


@pytest.mark.parametrize("frequent, words", [(1 << 19, A.WORDS), (20, A.WORDS), (0, 7)])
def test_alignment_equals_whole_texts(spark, documents, text_of, monkeypatch, frequent, words):
    pair, rows = A.pair_of(f"{A.FOLDER}/{A.BYTE_FILE}", f"{A.FOLDER}/{A.PIECE_FILE}"), rows_of(text_of)
    found = {i: linked(pair, t) if t else None for i, (_, t) in enumerate(rows)}
    count = Counter(p for f in found.values() if f for p in f[3])
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    want = []
    for i, (doc_id, _) in enumerate(rows):
        if found[i] is None:
            want.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = found[i]
        want.append((
            doc_id, n_a, n_b, len(groups), sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]),
            sum(n * count[p] for p, n in links.items()), hashlib.sha256(";".join(groups).encode()).hexdigest(),
        ))
    documents_, pairs = A.align(documents(rows, n_a="clash"), frequent=frequent, hot_rows=10)
    assert sorted(map(tuple, documents_.collect()), key=repr) == sorted(want, key=repr)
    assert {(r.a, r.b): (r["count"], r.best) for r in pairs.collect()} == {p: (n, n == best[p[0]]) for p, n in count.items()}
    monkeypatch.setattr(A, "WORDS", words)
    texts = [t for _, t in rows if t]
    known = A.Aligned(pair)
    for _ in range(2):
        measures, digests, *_ = known.align(texts)
        assert digests == [w[-1] for (_, t), w in zip(rows, want) if t] and measures[:, 3].tolist() == [w[4] for (_, t), w in zip(rows, want) if t]


def test_empty_table(spark, documents):
    found, pairs = A.align(documents([(1, "x")]).limit(0))
    assert found.count() == 0 and pairs.count() == 0
    found, _ = A.align(documents([(1, None), (2, "")]))
    assert [tuple(r)[1:] for r in found.collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
