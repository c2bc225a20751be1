"""Language identification: kernels against brute force, held-out accuracy and defined results."""

import numpy as np
import pyarrow as pa

from shelfwise.llm import stringkernel as S

WORDS = {
    "en": "the and that with from this have which their would there about other when your some time into than them",
    "de": "der und nicht mit eine auch sich werden über nach schon wenn können müssen für zwischen größe straße durch gegen",
    "fr": "les des une dans pour avec est qui que sont mais été être où leurs après même très français depuis",
    "el": "και το να της που με για από είναι στην δεν τους θα αυτό όπως μετά έχει πολύ χρόνια ήταν",
}


def prose(lang, seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang].split(), n))


def grams(text):
    raw = bytes(b if 97 <= b <= 122 or b >= 128 else 0 for b in text.encode().lower())
    while b"\0\0" in raw:
        raw = raw.replace(b"\0\0", b"\0")
    return {raw[i : i + n] for n in (1, 2, 3) for i in range(len(raw) - n + 1)}


def test_kernels_equal_brute_force(monkeypatch):
    landmarks = [prose("en", 1, 30), prose("de", 2, 30), "x"]
    texts = ["", "Q", prose("fr", 3, 50), "The AND, that... 12 with", prose("de", 4, 400)]
    for piece in (S.PIECE, 64):
        monkeypatch.setattr(S, "PIECE", piece)
        kernel = S.Kernel([S.gram_set(t.encode()) for t in landmarks])
        got = kernel.against(pa.record_batch([pa.array(texts)], ["t"]), "t")
        every = set.union(*map(grams, landmarks))
        want = [[len(grams(t) & grams(m)) / (len(grams(t) & every) or 1) ** 0.5 / len(grams(m)) ** 0.5 for m in landmarks] for t in texts]
        assert np.allclose(got, want, atol=1e-5)


def test_held_out_texts_get_their_language(spark, documents):
    rows = [(i, prose(lang, i * 7 + k, 3 + i % 40)) for k, lang in enumerate(WORDS) for i in range(k, 480, 4)]
    named = documents(rows, lang_pred="clash", score="clash").drop("lang")
    langs = spark.createDataFrame([(i, lang) for k, lang in enumerate(WORDS) for i in range(k, 480, 4)], "doc_id long, lang string")
    found = S.identify(named.join(langs, "doc_id"), landmarks=16, learnt=120).collect()
    assert len(found) == 480 and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert 80 < len(held) < 160 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_texts_without_letters_and_tables_without_languages(spark, documents):
    rows = [(1, prose("en", 1, 20)), (1, prose("en", 1, 20)), (2, None), (3, ""), (4, "12 .. 3"), (None, prose("en", 2, 9)), (5, "Ω"), (6, prose("en", 3, 200_000))]
    found = S.identify(documents(rows), landmarks=4, learnt=16).collect()
    assert [(r.doc_id, r.lang_pred) for r in found if r.lang_pred == "und"] == [(2, "und"), (3, "und"), (4, "und")]
    assert {r.lang_pred for r in found} == {"en", "und"} and len(found) == len(rows)
    bare = documents(rows).drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {(r.lang_pred, r.score) for r in S.identify(bare).collect()} == {("und", 0.0)}
    assert S.identify(documents(rows).limit(0)).count() == 0
    assert "text" not in S.identify(documents(rows), keep_text=False, landmarks=4, learnt=16).columns


def test_copies_of_one_text_leave_the_sample_whole(spark, documents):
    rows = [(i, "the the the") for i in range(300)] + [(1000 + i, prose("en", i, 20)) for i in range(40)]
    picked = S.training_texts(documents(rows), "text", "lang", 30).collect()
    assert len(picked) == 30 == len({r.text for r in picked})
