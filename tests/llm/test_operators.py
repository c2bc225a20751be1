"""The operators against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfwise.llm import bagminhash, bwtmerge, cotraining, decontaminate, imatch, licenses, logbilinear, mixing, preference, sharding, wordruns

FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(FOLD))


# 1 decontamination


def test_decontamination_equals_all_windows(spark, documents, text_of):
    items = [("7", text_of(1, 30)), ("9", text_of(2, 12)), ("12", "one two three"), (None, text_of(3, 20)), ("13", None), ("14", "..."), ("7", text_of(4, 10))]
    leak = text_of(1, 30).split()
    rows = [
        (1, text_of(10, 40)), (2, " ".join([*text_of(11, 9).split(), *leak[5:17], "end"])), (3, "ONE, two -- three four"), (4, None), (5, ""),
        (6, " ".join(leak[3:12])), (7, text_of(2, 12) + " " + text_of(4, 10)), (7, text_of(2, 12)), (8, " ".join(leak * 30)), (9, text_of(3, 20)), (None, text_of(2, 12)),
    ]
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = documents(rows, hit_items="clash")
    for block_bytes in (1 << 20, 200):  # one block and several
        got = sorted((r.doc_id or 0, r.text or "", r.n_words, [tuple(s) for s in r.hit_spans], r.hit_items) for r in decontaminate.mark(docs, bench, block_bytes=block_bytes).collect())
        expected = []
        for doc_id, text in rows:
            doc, hit, names = words(text), set(), set()
            for item, body in items:
                w = words(body)
                if item is None or not w:
                    continue
                n = min(10, len(w))
                windows = {tuple(w[p : p + n]) for p in range(len(w) - n + 1)}
                for p in range(len(doc) - n + 1):
                    if tuple(doc[p : p + n]) in windows:
                        hit.update(range(p, p + n))
                        names.add(item)
            spans = decontaminate.merged([(h, h + 1) for h in hit])
            expected.append((doc_id or 0, text or "", len(doc), spans, sorted(names)))
        assert got == sorted(expected)
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == [c for c in docs.columns if c != "hit_items"]
    assert sorted(r.doc_id for r in clean.collect()) == [1, 4, 5, 6, 9]
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.mark(docs.limit(0), bench).count() == 0


# 2 quality


def test_cotraining_learns_and_keeps_clean(spark, documents, text_of):
    junk = lambda i: " ".join(w.upper() + "!!" for w in text_of(i, 60).split())
    rows = [(i, junk(i) if i % 5 == 0 else text_of(i, 60 + i % 30)) for i in range(400)] + [(1000, None), (1001, ""), (None, text_of(5000, 50)), (3, text_of(3, 63))]
    docs = documents(rows, quality_score="clash")
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 400, 2)] + [(None, 1, 0), (1, None, 0), (3, 0, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    found = cotraining.score(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.quality_score <= 1 for r in found)
    odd = [r for r in found if r.doc_id is not None and r.doc_id < 400]
    assert sum((r.quality_score >= 0.5) == (r.doc_id % 5 != 0) for r in odd) >= 0.99 * len(odd)
    for some in (labels.limit(0), labels.filter("quality = 1")):
        assert {r.quality_score for r in cotraining.score(docs, some).collect()} == {0.5}
    assert cotraining.keep_good(docs, labels.limit(0)).columns == docs.columns
    assert cotraining.score(docs.limit(0), labels).count() == 0


def test_toxic_texts_are_found_and_dropped(spark, documents, text_of):
    toxic = lambda i: i % 7 == 0
    slip = lambda i, text: " ".join([*text.split()[:40], ("Vile!", "nasty,")[i // 14 % 2], *text.split()[40:]])
    rows = [(i, slip(i, text_of(i, 80)) if toxic(i) else text_of(i, 81)) for i in range(600)]
    docs = documents(rows)
    labels = spark.createDataFrame([(i, int(i % 6 != 0), int(toxic(i))) for i in range(0, 600, 2)], "doc_id long, quality int, toxic int")
    found = cotraining.score(docs, labels).collect()
    assert sum((r.toxic_score > 0.5) == toxic(r.doc_id) for r in found) >= 0.99 * len(found)
    only = labels.withColumn("quality", F.lit(1))
    left = {r.doc_id for r in cotraining.keep_good(docs, only).collect()}
    assert len(left ^ {i for i, _ in rows if not toxic(i)}) <= 6
    assert {r.toxic_score for r in cotraining.score(docs, labels.drop("toxic")).collect()} == {0.5}


def test_repeats_of_one_id_leave_the_sample_whole(spark, documents, text_of):
    junk = lambda i: " ".join(w.upper() + "!!" for w in text_of(i, 60).split())
    rows = [(i, junk(i) if i % 5 == 0 else text_of(i, 60)) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    least = cotraining.sample_of(labels, 1).first().doc_id
    found = cotraining.score(documents(rows + [rows[least]] * 100), labels, labelled=100).collect()
    assert sum((r.quality_score >= 0.5) == (r.doc_id % 5 != 0) for r in found) >= 0.98 * len(found)


# 3 sharding


def test_sharding_is_even_gapless_and_whole(spark, documents):
    rows = [(i, f"text {i}") for i in range(1003)] + [(5, "text 5"), (5, None), (None, "x"), (None, None)]
    found = sharding.shard_documents(documents(rows, shard="clash", slot=1)).collect()
    assert len(found) == len(rows)
    counts = Counter(r.shard for r in found)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))
    assert sorted(r["size"] for r in found) == sorted(len((t or "").encode()) + 1 for _, t in rows)
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}
    assert sum(r.hops == 0 for r in found) > 0.7 * len(found)
    assert sharding.shard_documents(documents(rows).limit(0)).count() == 0


def test_sharding_with_slack_follows_the_ring(spark):
    rows = spark.range(3000).select(F.col("id").alias("k"))
    loose = sharding.assign(rows, F.col("k"), 5, [F.col("k")], slack=3.0)
    assert loose.filter("hops > 0").count() == 0
    nodes = sharding.ring_nodes(spark, 5, sharding.REPLICAS)
    cells = {r.k: r.cell for r in rows.select("k", sharding.cell_of(sharding.ring_order(F.col("k"))).alias("cell")).collect()}
    home = {k: next((s for c, s in nodes if c >= cell), nodes[0][1]) for k, cell in cells.items()}
    assert {r.k: r.shard for r in loose.collect()} == home
    tight = {r.k: (r.shard, r.hops) for r in sharding.assign(rows, F.col("k"), 5, [F.col("k")]).collect()}
    assert all(s == home[k] for k, (s, hops) in tight.items() if hops == 0)


def test_placements_keep_capacities():
    prefs = [[0, 1, 2], [1, 2, 0], [2, 0, 1]]
    plan = sharding.placements([9, 0, 0], prefs, [3, 3, 3])
    assert plan == [(0, 0, 3, 0), (0, 1, 3, 1), (0, 2, 3, 2)]


# 4 near duplicates


def near_copy(text, *at):
    w = text.split()
    for i in at:
        w[i % len(w)] = f"edit{i}"
    return " ".join(w)


def test_near_duplicates_equal_brute_force(spark, documents, text_of):
    base = text_of(1, 200)
    rows = [(i, text_of(100 + i, 80)) for i in range(10)]
    rows += [(20 + i, near_copy(base, 13 * i + 1, 29 * i + 3)) for i in range(12)]  # alike by way of the base only, or directly
    rows += [(50, base), (51, base), (52, base + " "), (53, None), (54, ""), (55, "!!"), (56, "one two"), (57, "two one"), (58, "One two.")]
    rows += [(60, "spam egg ham jam rum " * 40), (61, "spam egg ham jam rum " * 37), (62, "spam egg ham jam rum " * 20), (50, base), (None, base), (None, text_of(999, 30))]
    found = bagminhash.classify(documents(rows, class_id="clash", nid="clash")).collect()
    bags = []
    for doc_id, text in rows:
        w = words(text)
        bags.append((doc_id, text or "", Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, ti, bi) in enumerate(bags):
        for j, (_, tj, bj) in enumerate(bags[:i]):
            common = sum((bi & bj).values())
            if ti == tj or (common and common >= 0.8 * sum((bi | bj).values())):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _, _) in enumerate(bags):
        groups.setdefault(root(i), []).append(doc_id)
    expected = sorted((doc_id or -1, min((g for g in groups[root(i)] if g is not None), default=-1), len(groups[root(i)])) for i, (doc_id, _, _) in enumerate(bags))
    assert sorted((r.doc_id or -1, -1 if r.class_id is None else r.class_id, r.class_size) for r in found) == expected
    docs = documents(rows, class_id="clash")
    kept = bagminhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(groups)
    assert bagminhash.classify(docs.limit(0)).count() == 0


def test_part_sums_rule_out_no_similar_texts(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = []
    for _ in range(400):
        a = np.bincount(rng.integers(0, 300, 400), minlength=300) * rng.integers(0, 3, 300)
        b = np.where(rng.random(300) < rng.random() / 2, rng.permutation(a), a)
        parts = [np.bincount(np.arange(300) % bagminhash.PARTS, weights=x, minlength=bagminhash.PARTS).astype(int).tolist() for x in (a, b)]
        alike = float(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        rows.append((alike, *parts, int(a.sum()), int(b.sum())))
    table = spark.createDataFrame(rows, "alike double, a array<int>, b array<int>, ta long, tb long")
    kept = table.select("alike", bagminhash.parts_match(F.col("a"), F.col("b"), F.col("ta"), F.col("tb"), 0.8).alias("possible")).collect()
    assert all(r.possible for r in kept if r.alike >= 0.8)
    assert 0 < sum(r.alike >= 0.8 for r in kept) and not all(r.possible for r in kept)


def test_part_sums_are_worked_out_once_for_a_pair(spark):
    sides = spark.createDataFrame([([1, 2], [2, 1], 3, 3)], "a array<int>, b array<int>, ta long, tb long").alias("x"), spark.range(3)
    possible = bagminhash.parts_match(F.col("a"), F.col("b"), F.col("ta"), F.col("tb"), 0.5)
    joined = sides[0].join(sides[1], (F.col("ta") == F.col("id") + 1) & possible)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with(") == 1  # named twice, it would be worked out for every pair before the other terms
    assert [r.id for r in joined.collect()] == [2]


def test_rounds_without_new_pairs_relabel_nothing(spark, documents, text_of, monkeypatch):
    # texts of one bucket that are alike to its first member in shares too far apart, so that no pair of a later round is tested
    base = text_of(1, 200).split()
    rows = [(0, " ".join(base)), *((1 + i, " ".join(base[:160] + text_of(50 + i, 40).split())) for i in range(6))]
    calls = []
    relabelled = bagminhash.relabelled
    monkeypatch.setattr(bagminhash, "relabelled", lambda labels, found: calls.append(found.count()) or relabelled(labels, found))
    found = bagminhash.classify(documents(rows)).collect()
    assert len(found) == len(rows) and 0 not in calls[1:]


# 5 repeats


def brute_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id or -1, len(b), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("bucket", [256, 2])
def test_repeats_equal_brute_force(spark, documents, text_of, bucket):
    shared, header = text_of(1, 90), text_of(2, 50)
    rows = [(i, f"{text_of(20 + i, 10 + 7 * i)} {shared} {text_of(40 + i, 60)}") for i in range(5)]
    rows += [(10 + i, f"{header} {text_of(60 + i, 70)}") for i in range(6)]  # a common head shorter than a string
    rows += [(20, shared), (21, shared[:399]), (22, shared[:400]), (23, "é" * 500), (24, "ab" * 450), (25, None), (26, ""), (27, text_of(70, 400)), (28, text_of(70, 399)), (28, text_of(70, 399)), (None, shared)]
    rows += [(30 + i, near_copy(text_of(90, 260), 40 * i + 5, 40 * i + 25)) for i in range(5)]
    found = bwtmerge.repeated_spans(documents(rows, removed="clash"), bucket=bucket).collect()
    got = sorted((r.doc_id or -1, r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), r.kept_sha256) for r in found)
    assert got == brute_repeats(rows, 400)
    if bucket == 2:
        assert bwtmerge.repeated_spans(documents(rows).limit(0)).count() == 0


def brute_shared_words(rows, run):
    runs = {}
    for i, (doc_id, text) in enumerate(rows):
        w = words(text)
        for k in range(len(w) - run + 1):
            runs.setdefault(tuple(w[k : k + run]), set()).add((doc_id, text or ""))
    out = []
    for doc_id, text in rows:
        w = words(text)
        hit = set()
        for k in range(len(w) - run + 1):
            if len(runs[tuple(w[k : k + run])]) > 1:
                hit.update(range(k, k + run))
        out.append((doc_id or -1, len(hit)))
    return sorted(out)


@pytest.mark.parametrize("run", [50, 20, 5])
def test_shared_word_runs_equal_brute_force(spark, documents, text_of, run):
    passage = text_of(1, 55)
    rows = [(i, f"{text_of(20 + i, 10 + 7 * i)} {passage} {text_of(40 + i, 60)}") for i in range(5)]
    rows += [(10 + i, near_copy(text_of(90, 260), 40 * i + 5, 40 * i + 25)) for i in range(5)]
    rows += [(20, passage), (21, text_of(1, 50)), (22, text_of(1, 49)), (23, f"{text_of(5, 60)} {text_of(5, 60)}"), (24, None), (25, "")]
    rows += [(26, text_of(6, 80)), (26, text_of(6, 80)), (27, text_of(7, 80)), (28, text_of(7, 80).upper().replace(" ", ", ")), (None, passage), (29, "a " * 200), (30, "a " * 120)]
    rows += [(40, f"{text_of(91, 30)} {text_of(92, 70)}"), (41, f"{text_of(92, 70)} {text_of(93, 30)}"), (42, f"{text_of(94, 9)} {' '.join(text_of(92, 70).split()[12:63])} {text_of(95, 9)}")]
    rows += [(50, f"{text_of(96, 150_000)} {passage}")]
    keys = bwtmerge.keyed(documents(rows, dk="clash"))
    found = keys.join(wordruns.shared_words(keys.select("dk", "text"), run), "dk", "left").select("doc_id", "n_shared_words").collect()
    assert sorted((r.doc_id or -1, r.n_shared_words or 0) for r in found) == brute_shared_words(rows, run)
    if run == 50:
        assert wordruns.shared_words(keys.select("dk", "text").limit(0), run).count() == 0


# 6 preference pairs


def test_preference_pairs(spark):
    schema = "pair_id long, turn int, role string, text string"
    a = [(1, 0, "user", "hi"), (1, 1, "assistant", "good day"), (2, 0, "user", None), (2, 1, None, "x"), (3, 0, "user", "only"), (None, 0, "user", "z"), (5, 1, "assistant", "b"), (5, 0, "user", "a")]
    b = [(1, 0, "user", "hi"), (1, 1, "assistant", "bad day"), (1, 2, "user", "why"), (2, 0, "user", None), (2, 1, None, "x"), (4, 0, "assistant", "late"), (5, 0, "user", "a"), (5, 1, "assistant", "b"), (5, 1, "assistant", "b")]
    found = {r.pair_id: r for r in preference.format_pairs(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)).collect()}
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    assert set(found) == {1, 2, 3, 4, 5}
    assert (found[1].n_prompt_turns, found[1].prompt, found[1].chosen) == (1, turn("user", "hi"), turn("assistant", "good day"))
    assert found[1].rejected == turn("assistant", "bad day") + turn("user", "why")
    assert [found[1].rejected[s.start : s.end] for s in found[1].rejected_spans] == ["bad day<|im_end|>"]
    assert (found[2].prompt, found[2].chosen, found[2].rejected) == (turn("user", "") + turn("", "x"), "", "")
    assert (found[3].prompt, found[3].chosen, found[3].rejected, found[3].chosen_spans) == ("", turn("user", "only"), "", [])
    assert [found[4].rejected[s.start : s.end] for s in found[4].rejected_spans] == ["late<|im_end|>"]
    assert (found[5].n_prompt_turns, found[5].chosen, found[5].rejected) == (2, "", turn("assistant", "b"))
    empty = spark.createDataFrame([], schema)
    assert preference.format_pairs(empty, empty).count() == 0


# 7 fingerprints


def test_imatch_edits_and_fingerprints(spark, documents, text_of):
    rows = [(i * 700, text_of(i, 40 + i)) for i in range(30)] + [(21001, None), (21002, ""), (21003, "é" * 7), (5 * 700, text_of(5, 45)), (None, "last one"), (10**12, text_of(3, 43)), (-4, "minus four words here")]
    docs = documents(rows, next="clash", own=1)
    key = lambda i: -(10**9) if i is None else i
    found = imatch.compare_with_edited(docs, low=0.05, high=0.6).collect()
    order = sorted(((key(i), t or "") for i, t in rows), key=lambda x: (-x[0], x[1]))
    half = [(len(t) // 2, order[(k + 1) % len(order)][1]) for k, (_, t) in enumerate(order)]
    assert sorted((key(r.doc_id), r.text, r.edited) for r in found) == sorted((i, t, t[: len(t) - h] + after[:h]) for (i, t), (h, after) in zip(order, half))
    by_text = {}
    for r in found:
        assert by_text.setdefault(r.text, r.fingerprint) == r.fingerprint
        assert len(r.fingerprint) == len(r.edited_fingerprint) == imatch.SUBSETS * imatch.DIGITS
        assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint) and 0 <= r.near_next <= 1
    assert by_text[""] == imatch.NONE * imatch.SUBSETS
    whole = [r for r in found if len(r.text) > 100]
    assert sum(r.near_edited for r in whole) > sum(r.near_next for r in whole)

    hashes = imatch.lexicon(docs, low=0.05, high=0.6)
    shares = Counter(w for _, t in rows for w in {x.decode() for x in words((t or "").lower())})
    terms = spark.createDataFrame([(w, 0.05 <= n / len(rows) <= 0.6) for w, n in shares.items()], "w string, inside boolean").withColumn("h", F.xxhash64("w"))
    assert sorted(r.h for r in terms.filter("inside").collect()) == hashes
    assert terms.filter(imatch.Lexicon(hashes).has(F.col("h")) != F.col("inside")).count() == 0
    assert imatch.compare_with_edited(docs.limit(0)).count() == 0
    one = imatch.compare_with_edited(docs.filter("doc_id = 21003")).first()
    assert one.edited == "é" * 7 and one.near_edited == one.near_next == 1


# 8 mixing


def test_mixing_settles_shortages_among_siblings_first(spark):
    supply = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "x", 500), ("b", "y", 500), ("c", "x", 5)], "d string, l string, tokens long")
    found = {(r.d, r.l): r.target_tokens for r in mixing.leaf_targets(supply, ["d", "l"], {"d": {"a": 2.0}}, 400, 1).collect()}
    # roots: c is short (5 of 100), a and b share the rest 2:1; within a, x is short and y takes its part
    assert found[("c", "x")] == 5 and found[("a", "x")] == 10
    assert found[("a", "y")] == 253 and found[("b", "x")] == found[("b", "y")] == 65
    all_of_it = {(r.d, r.l): r.target_tokens for r in mixing.leaf_targets(supply, ["d", "l"], {}, 10**9, 2).collect()}
    assert all_of_it[("a", "y")] == 2000
    none = {(r.d, r.l): r.target_tokens for r in mixing.leaf_targets(supply, ["d", "l"], {"d": {"a": 0.0}}, 100, 1).collect()}
    assert none[("a", "x")] == none[("a", "y")] == 0 and none[("c", "x")] == 5


def test_mixing_takes_seeded_prefixes(spark, documents, text_of):
    rows = [(i, text_of(i, 5 + i % 7)) for i in range(200)] + [(300, None), (301, " "), (7, text_of(7, 5)), (None, "some words")]
    docs = documents(rows, tokens="clash", epoch=9)
    taken = mixing.mix(docs, ["source"], {"source": {"src0": 3.0}}, 0.5, epochs=2, seed=4).collect()
    by_source = {}
    for r in taken:
        by_source.setdefault(r.source, []).append(r)
    total = sum(len((t or "").split()) for _, t in rows)
    assert abs(sum(r.take_tokens for r in taken) - total / 2) <= 3
    for source, rs in by_source.items():
        assert sum(r.take_tokens for r in rs) == rs[0].target_tokens
        assert sum(r.take_tokens < r.tokens for r in rs) <= 1
        order = lambda i, e: (e, hashlib.md5(f"4:{e}:{'' if i is None else i}".encode()).hexdigest())
        stream = sorted(order(i, e) for i, t in rows if (t or "").split() and f"src{(i or 0) % 3}" == source for e in (1, 2))
        assert sorted(order(r.doc_id, r.epoch) for r in rs) == stream[: len(rs)]
    assert mixing.mix(docs.limit(0), ["source"], {}, 0.5).count() == 0


# 9 licenses


def test_license_scan_equals_all_windows(spark, documents, text_of):
    mit, gpl = licenses.TEMPLATES[1][1], licenses.TEMPLATES[4][1]
    rows = [
        (1, text_of(1, 100) + ". Released under the MIT License. " + text_of(2, 77)), (2, text_of(3, 41) + " " + mit.upper() + " " + text_of(4, 90)),
        (3, gpl.replace("3", "2")), (4, None), (5, ""), (6, "under the mit"), (7, text_of(5, 300)), (8, " ".join(mit.split()[:19])), (9, " ".join(mit.split()[:8])),
        (10, (text_of(6, 5) + " Licensed under CC BY-NC 4.0. ") * 300), (1, "Licensed under the Apache License, Version 2.0. and Released under the MIT License."),
    ]
    found = licenses.scan(documents(rows, matches="clash"))
    got = sorted((r.doc_id, r.n_words, [m.license for m in r.matches], [m.containment for m in r.matches]) for r in found.collect())
    expected = []
    for doc_id, text in rows:
        w = [re.sub(rb"[0-9]", b"0", x) for x in words(text)]
        grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [tuple(w)] if w else []
        best = {}
        for name, body in licenses.TEMPLATES:
            t = [re.sub(rb"[0-9]", b"0", x) for x in words(body)]
            want, length = {tuple(t[k : k + 3]) for k in range(len(t) - 2)}, licenses.window_class(len(t))
            for low in range(0, len(grams), length):
                share = len(want & set(grams[low : low + 2 * length])) / len(want)
                if share >= 0.8:
                    best[name] = max(best.get(name, 0), share)
        expected.append((doc_id, len(w), sorted(best), [best[n] for n in sorted(best)]))
    assert got == sorted(expected)
    assert licenses.scan(documents(rows).limit(0)).count() == 0


# 10 language model


def test_language_model_is_normalised_and_learns(spark, documents):
    import random

    rng = random.Random(1)
    chain = {w: rng.sample("abcdefghij", 2) for w in "abcdefghij"}

    def walk(n):
        w, out = "a", []
        for _ in range(n):
            out.append("w" + w)
            w = rng.choice(chain[w])
        return " ".join(out)

    rows = [(i, walk(80)) for i in range(1500)] + [(2000, None), (2001, ""), (2002, "unseen Words"), (None, "wa\twb"), (2001, "")]
    found = {r.doc_id: r for r in logbilinear.score(documents(rows, score="clash"), classes=16, known=8).collect()}
    import zlib
    import math

    held = {i for i, _ in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1}
    counts = Counter()
    for i, t in rows:
        if i not in held:
            counts.update([*(t or "").lower().split(), "</s>"])
    total, kinds = sum(counts.values()), len(counts)
    for i, t in rows:
        tokens, r = [*(t or "").lower().split(), "</s>"], found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens, r.n_known) == (i in held, len(tokens), total, sum(x in counts for x in tokens))
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in tokens), rel_tol=1e-9)
    unseen = [r for i, r in found.items() if i in held and i is not None and i < 1500]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) * 0.75
    assert logbilinear.score(documents(rows).limit(0)).count() == 0
    alone = logbilinear.score(documents([(i, "x y") for i in sorted(held - {None})[:3]]))
    assert {(r.n_known, r.train_tokens) for r in alone.collect()} == {(0, 0)}


def test_language_model_probabilities_sum_to_one():
    import numpy as np

    share = np.array([0, 0.1, 0.2, 0.3, 0.4])
    one, two, norm = logbilinear.Model.fresh(share, 4, 1).tables()
    total = np.exp(one[:, None, :] + two[None, :, :] - norm[:, :, None])[..., 1:].sum(axis=2)
    assert np.allclose(total, 1, atol=1e-4)


def test_language_model_vocabulary_grows_with_the_counts():
    import numpy as np

    n = np.arange(400, 0, -1)
    counts = logbilinear.Counts(np.arange(1, 401, dtype=np.uint64), n, int(n.sum()) + 50, 430, 24)
    layout = counts.layout()
    assert layout.own == 385 and len(set(counts.id_of(np.arange(400)).tolist())) == 386  # all that occur 16 times, and "other"
    rng = np.random.default_rng(3)
    model = logbilinear.Model.fresh(counts.class_share(), 8, 1, layout, counts.member_logs())
    share, ids = counts.class_share(), rng.integers(3, 3 + layout.own, 20_000)
    one = np.roll(ids, 1)
    logbilinear.train(model, share, iter([(ids, one, np.roll(ids, 2))]), 1)
    score = logbilinear.Scorer(model, 30)
    every = np.concatenate([[logbilinear.END, logbilinear.OTHER], np.arange(3, 3 + layout.own)])
    for c1, c2 in ((5, 7), (300, 9), (387, 350), (logbilinear.OTHER, logbilinear.START)):
        logs = score(every, np.full(len(every), c1), np.full(len(every), c2)).astype(np.float64)
        assert abs(np.exp(logs).sum() - 1) < 1e-3
    assert not np.allclose(score(every, np.full(len(every), 300), np.full(len(every), 9)), score(every, np.full(len(every), 301), np.full(len(every), 9)))


def test_language_model_steps_equal_a_slow_loop(monkeypatch):
    import numpy as np

    n = np.arange(400, 0, -1)
    counts = logbilinear.Counts(np.arange(1, 401, dtype=np.uint64), n, int(n.sum()) + 50, 430, 24)
    layout, share, dim, noise = counts.layout(), counts.class_share(), 8, 6
    ids = np.random.default_rng(3).integers(3, 3 + layout.own, 60)
    streams = [(ids, np.roll(ids, 1), np.roll(ids, 2))]
    start = logbilinear.Model.fresh(share, dim, 1, layout, counts.member_logs()).flat
    flat, squares, met = start.astype(float), np.full(start.shape, 1e-2), Counter()
    at_u, at_q = layout.size, layout.size + layout.bins * layout.width
    at_c = at_q + layout.classes
    squares[layout.cut : at_q] = 1e-5
    rng = np.random.default_rng(7)
    pool = rng.choice(len(share), size=1 << 16, p=share)
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for low in range(0, len(ids), 25):
        t, c1, c2 = (x[low : low + 25] for x in streams[0])
        s = pool[rng.integers(0, len(pool), noise)]
        far = np.flatnonzero(t >= layout.cut)
        bins = (t[far] - layout.cut) // layout.width
        peers = bins[:, None] * layout.width + (rng.random((len(far), logbilinear.PEERS)) * layout.members()[bins][:, None]).astype(int)
        peers = dict(zip(far.tolist(), peers.tolist()))
        step = np.zeros(flat.shape)
        for i in range(len(t)):
            r1, r2 = flat[c1[i], :dim], flat[c2[i], :dim]
            h = np.append(r1 @ flat[at_c : at_c + dim, :dim] + r2 @ flat[at_c + dim :, :dim], 1)
            back = np.zeros(dim + 1)

            def pull(row, wanted, log_noise):
                weight = wanted - sigmoid(h @ flat[row] - log_noise)
                step[row] += weight * h
                back[:] += weight * flat[row]
                met[row] += 1

            for row, wanted in ((layout.class_of(t[i : i + 1])[0], 1), *((x, 0) for x in s)):
                pull(at_q + row, wanted, np.log(noise * share[row] if share[row] else noise * 1e-12))
                met[at_q + row] -= not wanted and i > 0  # a noise class counts once a batch
            for row, wanted in ((t[i] - layout.cut, 1), *((x, 0) for x in peers[i])) if i in peers else ():
                pull(at_u + row, wanted, np.log(logbilinear.PEERS / layout.members()[(t[i] - layout.cut) // layout.width]))
            for row, vector, mixer in ((c1[i], r1, at_c), (c2[i], r2, at_c + dim)):
                step[row, :dim] += flat[mixer : mixer + dim, :dim] @ back[:dim]
                step[mixer : mixer + dim, :dim] += np.outer(vector, back[:dim])
                met[row] += 1
        step /= len(t)
        squares += step**2
        flat += 0.2 * step / np.sqrt(squares)
    kinds, exp = set(), np.exp
    monkeypatch.setattr(np, "exp", lambda x, *a, **k: kinds.add(x.dtype) or exp(x, *a, **k))
    model = logbilinear.Model(start.copy(), layout, dim)
    seen, found = logbilinear.train(model, share, iter(streams), 7, noise, 25, 0.2)
    assert kinds == {np.dtype(np.float32)}  # in double precision a step costs nearly twice as much
    assert seen == len(ids) and {i: x for i, x in enumerate(found[:at_c].tolist()) if x} == {i: x for i, x in met.items() if x}
    assert np.allclose(model.flat, flat, atol=1e-4)


def test_language_model_normalisers_of_all_sizes():
    import numpy as np

    rng = np.random.default_rng(5)
    for scale in (0.5, 20):  # the larger scores overflow unless they are scaled down
        h, rows = (rng.normal(0, scale, (n, 6)).astype(np.float32) for n in (40, 30))
        bias = np.append(rng.normal(0, 1, 29), -1e4).astype(np.float32)
        x = h.astype(float) @ rows.T.astype(float) + bias
        expected = np.log(np.exp(x - x.max(axis=1, keepdims=True)).sum(axis=1)) + x.max(axis=1)
        assert np.allclose(logbilinear.log_sums(h, rows, bias, 64), expected, rtol=1e-5, atol=1e-5)


def test_language_model_rows_are_packed_as_they_are():
    import numpy as np

    values = np.arange(12, dtype=np.float32).reshape(4, 3)
    one = logbilinear.packed(np.arange(4), np.arange(1, 5), values)
    assert one.column("value").to_pylist() == [x.tobytes() for x in values]
    assert (logbilinear.unpacked(one.slice(1, 2).column("value")) == values[1:3]).all()


def test_language_model_pairs_share_the_rows_of_their_contexts(monkeypatch):
    import numpy as np

    n = np.arange(400, 0, -1)
    counts = logbilinear.Counts(np.arange(1, 401, dtype=np.uint64), n, int(n.sum()) + 50, 430, 24)
    layout, share = counts.layout(), counts.class_share()
    rng = np.random.default_rng(4)
    c1, c2 = np.divmod(rng.permutation(layout.size**2)[:40_000], layout.size)  # no pair comes twice
    ids = rng.choice([logbilinear.END, logbilinear.OTHER, *range(3, layout.cut)], len(c1))
    for spread in (1, 60):  # with the larger scores nearly all of some products vanishes
        model = logbilinear.Model.fresh(share, 8, 1, layout, counts.member_logs())
        model.r *= spread
        score = logbilinear.Scorer(model, 30, 200)
        made, exp = [], np.exp
        with monkeypatch.context() as patch:
            patch.setattr(np, "exp", lambda x, *a, **k: made.append(x.size) or exp(x, *a, **k))
            found = score(ids, c1, c2)
        # rows of scores worked out: of pairs of two rare contexts, and of each rare context once
        rare = ((c1 >= 200) & (c2 >= 200)).sum() + 2 * layout.size
        assert spread > 1 or sum(made) <= rare * layout.classes
        one, two, q, b = (x.astype(float) for x in (model.r @ model.c1, model.r @ model.c2, model.q, model.b))
        x = (one[c1] + two[c2]) @ q.T + b
        x[:, logbilinear.START] = -np.inf
        most = x.max(axis=1)
        expected = x[np.arange(len(ids)), ids] - np.log(np.exp(x - most[:, None]).sum(axis=1)) - most
        assert np.allclose(found, expected, rtol=1e-4, atol=1e-4)


def test_language_model_steps_run_over_whole_arrays(monkeypatch):
    import numpy as np

    # parameters and sums of squared steps lie apart: halves of longer rows would be walked row by row
    share = np.full(12, 1 / 12)
    ids = np.random.default_rng(3).integers(3, 12, 3000)
    roots, sqrt = [], np.sqrt
    monkeypatch.setattr(np, "sqrt", lambda x, *a, **k: roots.append(x.flags["C_CONTIGUOUS"]) or sqrt(x, *a, **k))
    model = logbilinear.Model.fresh(share, 4, 1)
    seen, met = logbilinear.train(model, share, iter([(ids, np.roll(ids, 1), np.roll(ids, 2)), (ids[:0],) * 3]), 1, noise=5)
    assert roots and all(roots)
    assert seen == 3000 and met[:12].sum() == 6000 and met[12:24].sum() == 3000 + 3 * 5
