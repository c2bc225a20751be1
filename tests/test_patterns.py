"""Pattern joins against plain substring search."""

import random

import pytest

from shelfwise.operators import patterns as P

TEXTS = [(0, None), (1, ""), (2, "a"), (3, "abcabcabd"), (4, "x\ny secret-token z"), (5, "é\U0001f642ü secret-tok"), (6, "b" * 200_000 + "needle"), (7, "abcabcabd")]
PATTERNS = ["", None, "a", "ab", "abd", "bcabcab", "secret-token", "secret-tok", "\ny", "\U0001f642ü s", "needle", "missing pattern", "abd"]


def frames(spark, texts, patterns):
    return spark.createDataFrame(texts, "id long, t string").repartition(3), spark.createDataFrame([(p,) for p in patterns], "pattern string")


@pytest.mark.parametrize("size, long, piece", [(1, (), P.PIECE), (3, ((7, 4),), 20), (P.GRAM, P.LONG, P.PIECE), (4, ((6, 4), (5, 2)), 16)])
def test_matches_equal_the_search(spark, monkeypatch, size, long, piece):
    monkeypatch.setattr(P, "PIECE", piece)
    rng = random.Random(size)
    texts = TEXTS + [(100 + i, "".join(rng.choice("abc d") for _ in range(60))) for i in range(40)]
    patterns = PATTERNS + ["".join(rng.choice("abc d") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    patterns += [t[k : k + rng.randint(8, 40)] for _, t in texts[9:] for k in (rng.randrange(30),)]
    want = {(i, p) for i, t in texts if t for p in patterns if p and p in t}
    got = [tuple(r) for r in P.matches(*[frames(spark, texts, patterns)[0], "id", "t", frames(spark, texts, patterns)[1]], size=size, long=long).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_texts_never_meet_all_patterns(spark):
    texts, patterns = frames(spark, TEXTS, PATTERNS)
    plan = P.matches(texts, "id", "t", patterns)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pairs_that_only_share_a_gram_are_dropped_before_any_shuffle_of_pairs(spark):
    """The join on grams compares the pattern itself: texts are not joined again, and no pair is dealt out that is not a match."""
    texts, patterns = frames(spark, TEXTS, [*PATTERNS, "x" * 40 + "common words" + "y" * 40])
    plan = P.matches(texts, "id", "t", patterns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and "Contains" not in plan and "isnotnull(coalesce" not in plan.lower() and "isnotnull(substring" not in plan.lower()


def test_long_patterns_and_piece_borders(spark):
    rng = random.Random(5)
    body = "".join(rng.choice("ab ") for _ in range(9000))
    texts = [(1, body), (2, body[:3000] + "!" + body[3000:]), (3, body[100:])]
    patterns = [body[k : k + n] for k in (0, 2040, 2900, 4090, 8000) for n in (10, 50, P.HEAD, P.HEAD + 1, 900)]
    want = {(i, p) for i, t in texts for p in patterns if p in t}
    got = [tuple(r) for r in P.matches(*[frames(spark, texts, patterns)[0], "id", "t", frames(spark, texts, patterns)[1]]).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def nodes(plan):
    """The nodes of an executed plan, those of its stages too."""
    kind, children = plan.getClass().getSimpleName(), plan.children()
    if kind == "AdaptiveSparkPlanExec":
        return nodes(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return nodes(plan.plan())
    return [plan, *(n for i in range(children.size()) for n in nodes(children.apply(i)))]


def test_grams_of_no_pattern_are_dropped_however_many_patterns_there_are(spark):
    """250,000 grams of texts against 40,000 of patterns, a few of them shared: with one bit a gram 69 rows were dealt out, a number that grew with texts times patterns."""
    rng = random.Random(3)
    some = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))
    secrets = [some(12) for _ in range(10_000)]
    texts, patterns = frames(spark, [(i, some(2000)) for i in range(500)] + [(500, secrets[0])], secrets)
    found = P.matches(texts, "id", "t", patterns)
    assert [tuple(r) for r in found.collect()] == [(500, secrets[0])]
    probes = [n for n in nodes(found._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("BroadcastHashJoin") and "shiftrightunsigned(__gram" in n.simpleString(100)]
    assert len(probes) == 1 and probes[0].metrics().apply("numOutputRows").value() <= 10


@pytest.mark.parametrize("words, load", [((P.ROW, P.ROW), 1), ((P.ROW, 1 << 12), 1), ((P.ROW, 1 << 12), 1 << 20)])
def test_the_table_of_grams_loses_no_match_at_any_size(spark, monkeypatch, words, load):
    monkeypatch.setattr(P, "WORDS", words)
    monkeypatch.setattr(P, "LOAD", load)
    rng = random.Random(9)
    texts = [(i, "".join(rng.choice("abcd ") for _ in range(300))) for i in range(20)]
    patterns = [t[k : k + rng.randint(1, 45)] for _, t in texts for k in rng.sample(range(250), 20)] + ["".join(rng.choice("abcd ") for _ in range(20)) for _ in range(100)]
    want = {(i, p) for i, t in texts for p in patterns if p in t}
    got = [tuple(r) for r in P.matches(*[frames(spark, texts, patterns)[0], "id", "t", frames(spark, texts, patterns)[1]]).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_first_marker_and_redaction(spark):
    texts, _ = frames(spark, TEXTS, [])
    markers = spark.createDataFrame([("secret", 2), ("abd", 1), ("abc", 3), ("needle", 0)], "marker string, rank int")
    assert {r.id: r.marker for r in P.first_marker(texts, "id", "t", markers).collect()} == {3: "abd", 4: "secret", 5: "secret", 6: "needle", 7: "abd"}
    secrets = spark.createDataFrame([("secret-tok",), ("secret-token",), ("abcabc",), ("a",)], "secret string")
    got = {r.id: r.t for r in P.redacted(texts, "id", "t", secrets).collect()}
    assert got[4] == "x\ny ******** z" and got[5].endswith("********") and got[3] == "********abd" and got[0] is None and got[2] == "a" and len(got) == len(TEXTS)
    assert P.matches(texts, "id", "t", secrets.limit(0), "secret").count() == 0
