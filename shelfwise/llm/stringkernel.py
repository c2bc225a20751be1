"""Language identification with a blended-spectrum string kernel.

Texts are folded to lower-case letters (every other ASCII byte is one gap, runs of gaps are one) and read as UTF-8 bytes. The
kernel of two texts is the number of n-grams of 1, 2 and 3 bytes that both hold (presence, not counts), over the root of the
product of their own numbers, so a long text weighs no more than a short one. Only n-grams that some landmark holds take part: those
are the only ones a kernel against a landmark can see.

Landmarks are ``LANDMARKS`` distinct training texts, as many of each language. With K the kernel among them, a text's
Nyström features are its kernels with the landmarks times the inverse root of K; one ridge regression for each language against
all others is fitted on at most ``LEARNT`` distinct training texts. A batch of texts is scored by two matrix products:
presence by landmark, and kernel by regression weights. The training texts are picked by the hash of the text, the same number of each language
where it has as many. What meets on the driver is bounded by these two parameters and ``LANGUAGES``, the most frequent values of
``lang`` that are learnt: the landmarks' n-gram sets (2^24 codes of three bytes at most) and one row of kernels for each
training text.

Prediction sees nothing but the text. Whole texts are read, in pieces of ``PIECE`` bytes that overlap by two, so memory
does not follow the longest text.

Defined results: a null text, or one without a letter of any script, has the language ``und`` and score 0; so have all texts if no
training row has a language. A language is a value of ``lang`` in the training rows; of equal scores the first in
alphabetical order wins. The score is the winner's share of the regressions' values (below 0 counts as 0), 0 if none is above 0.
Repeated rows and ids are documents of their own; an empty table gives no rows; input columns named like added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfwise.llm.shared import slices
from shelfwise.llm.words import buffers, byte_class, lower_table
from shelfwise.operators.keys import top_per_group
from shelfwise.session import cut_lineage

LANDMARKS = 128
LEARNT = 4096
LANGUAGES = 512
ROWS = 512
RIDGE = 1e-3
PIECE = 1 << 20
CODES = 256 + (1 << 16) + (1 << 24)
UNKNOWN = "und"
ADDED = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

_LETTER = byte_class([(0x61, 0x7A), (0x80, 0xFF)])
_LOWER = lower_table()


def folded(text: np.ndarray) -> np.ndarray:
    """Lower-case letter bytes, and one zero for each run of other bytes."""
    low = _LOWER[text]
    low = np.where(_LETTER[low], low, 0).astype(np.uint8)
    twice = np.zeros(len(low), dtype=bool)
    twice[1:] = (low[1:] == 0) & (low[:-1] == 0)
    return low[~twice]


def gram_codes(text: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of 1, 2 and 3 bytes: each length has a range of its own."""
    c = text.astype(np.int32)
    two = (c[:-1] << 8) | c[1:]
    three = (two[:-1] << 8) | c[2:]
    return np.concatenate([c, two + 256, three + (256 + (1 << 16))])


def gram_set(text: bytes) -> np.ndarray:
    """Distinct n-grams of a whole text."""
    raw, found = np.frombuffer(text, dtype=np.uint8), np.empty(0, dtype=np.int32)
    for low in range(0, max(len(raw), 1), PIECE):
        found = np.union1d(found, gram_codes(folded(raw[max(0, low - 2) : low + PIECE])))
    return found


class Kernel:
    """Presence over the landmarks' n-grams, and kernels of texts with the landmarks."""

    def __init__(self, sets: list[np.ndarray]):
        self.grams = np.unique(np.concatenate(sets)).astype(np.int32)
        held = np.zeros((len(sets), len(self.grams)), dtype=np.float32)
        for row, own in enumerate(sets):
            held[row, np.searchsorted(self.grams, own)] = 1
        self.landmarks = np.ascontiguousarray((held / np.sqrt(held.sum(axis=1, keepdims=True))).T)
        self.spot: np.ndarray | None = None

    def places(self) -> np.ndarray:
        """Place of every code among the landmarks' n-grams, one beyond them for the others; made once per worker."""
        if self.spot is None:
            self.spot = np.full(CODES, len(self.grams), dtype=np.int32)
            self.spot[self.grams] = np.arange(len(self.grams), dtype=np.int32)
        return self.spot

    def presence(self, part: pa.RecordBatch, column: str) -> np.ndarray:
        """One row for each text: which of the landmarks' n-grams it holds."""
        data, rows = buffers(part.column(column))
        spot, held = self.places(), np.zeros((part.num_rows, len(self.grams) + 1), dtype=np.float32)
        for row, (low, high) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist())):
            for at in range(low, high, PIECE):
                held[row, spot[gram_codes(folded(data[max(low, at - 2) : min(high, at + PIECE)]))]] = 1
        return held[:, :-1]

    def against(self, part: pa.RecordBatch, column: str) -> np.ndarray:
        """Kernels of the texts with the landmarks, ``ROWS`` texts at a time."""
        out = [np.empty((0, self.landmarks.shape[1]), dtype=np.float32)]
        for low in range(0, part.num_rows, ROWS):
            held = self.presence(part.slice(low, ROWS), column)
            out.append(held @ self.landmarks / np.sqrt(np.maximum(held.sum(axis=1, keepdims=True), 1)))
        return np.concatenate(out)

    def among(self) -> np.ndarray:
        return (self.landmarks.T @ self.landmarks).astype(np.float64)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "spot": None}


class Model:
    """Kernel, languages and the regression weights of each on kernels with the landmarks."""

    def __init__(self, kernel: Kernel, langs: list[str], seen: np.ndarray, lang: np.ndarray, ridge: float):
        self.kernel, self.langs = kernel, langs
        values, vectors = np.linalg.eigh(kernel.among())
        kept = values > 1e-6 * values[-1]
        root = vectors[:, kept] / np.sqrt(values[kept])  # inverse root of the kernel among the landmarks
        features = np.column_stack([seen @ root, np.ones(len(seen))])
        own = (lang[:, None] == np.arange(len(langs))).astype(np.float64)
        weight = (1.0 / np.maximum(own.sum(axis=0), 1))[lang][:, None] / len(langs)  # languages count alike
        grams = features.T @ (features * weight) + ridge * np.eye(features.shape[1]) / len(root)
        solved = np.linalg.solve(grams, features.T @ (own * weight))
        self.weights, self.bias = (root @ solved[:-1]).astype(np.float32), solved[-1]

    def predict(self, part: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
        """Place of the language and score of each text."""
        values = self.kernel.against(part, column) @ self.weights + self.bias
        share = np.maximum(values, 0)
        total = share.sum(axis=1)
        best = values.argmax(axis=1)
        return best, np.where(total > 0, share[np.arange(len(best)), best] / np.where(total > 0, total, 1), 0.0)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def training_texts(rows: DataFrame, text: str, lang: str, each: int) -> DataFrame:
    """At most ``each`` distinct texts of a language, those of the least hashes; ``turn`` numbers them from 1."""
    key = F.struct(F.xxhash64(F.lit("language"), text), F.sha2(F.col(text).cast("binary"), 256))
    keyed = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), key.alias("key"))
    distinct = keyed.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n"))
    picked = top_per_group(distinct, ["lang"], [F.asc("key")], each).select("lang", "key", F.col("rank").alias("turn"))
    return keyed.join(F.broadcast(picked), ["lang", "key"]).groupBy("lang", "turn").agg(F.min("text").alias("text"))


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", landmarks: int = LANDMARKS, learnt: int = LEARNT, ridge: float = RIDGE) -> Model | None:
    """A model of the languages in ``rows``; none if there are none."""
    spark = rows.sparkSession
    named = rows.filter(F.col(lang).isNotNull() & has_letter(F.col(text)))
    langs = sorted(r[0] for r in named.groupBy(lang).count().orderBy(F.desc("count"), lang).limit(LANGUAGES).collect())
    if not langs:
        return None
    picked = cut_lineage(training_texts(named.filter(F.col(lang).isin(langs)), text, lang, max(1, learnt // len(langs))))
    sets = picked.filter(F.col("turn") <= max(1, landmarks // len(langs))).select("lang", "turn", "text").mapInArrow(_sets, "lang string, turn int, grams array<int>").orderBy("lang", "turn").toArrow()
    kernel = Kernel([np.array(g, dtype=np.int32) for g in sets.column("grams").to_pylist()])
    shared = spark.sparkContext.broadcast(kernel)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = shared.value.against(part, "text").astype(np.float64)
                begin = pa.array((np.arange(part.num_rows + 1) * found.shape[1]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("turn"), pa.ListArray.from_arrays(begin, pa.array(found.ravel()))], ["lang", "turn", "kernels"])

    table = picked.mapInArrow(seen, "lang string, turn int, kernels array<double>").orderBy("lang", "turn").toArrow()
    kernels = np.array(table.column("kernels").to_pylist(), dtype=np.float64)
    return Model(kernel, langs, kernels, np.searchsorted(np.array(langs), table.column("lang").to_numpy(zero_copy_only=False).astype(str)), ridge)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            found = [gram_set(t.encode()) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("turn"), pa.array(found, pa.list_(pa.int32()))], ["lang", "turn", "grams"])


def predict(docs: DataFrame, model: Model | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row with its columns (without the text if not ``keep_text``), ``lang_pred`` and ``score``."""
    rows = docs.drop(*ADDED.names)
    if model is None:
        rows = rows if keep_text else rows.drop(text)
        return rows.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    kept = [f for f in rows.schema.fields if keep_text or f.name != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known = F.when(has_letter(F.col(text)), F.col(text).cast("string")).alias("__read")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*shared.value.langs, UNKNOWN])
        for batch in batches:
            for part in slices(batch, "__read"):
                best, score = shared.value.predict(part, "__read")
                none = part.column("__read").is_null().to_numpy(zero_copy_only=False)
                best[none], score[none] = len(names) - 1, 0.0
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], names.take(pa.array(best)), pa.array(score)], [*[f.name for f in kept], *ADDED.names])

    return rows.select(*[f.name for f in kept], known).mapInArrow(run, T.StructType([*kept, *ADDED.fields]))


def identify(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", keep_text: bool = True, **options) -> DataFrame:
    """Every document with its columns, ``held_out``, ``lang_pred`` and ``score``; learnt from those that are not held out."""
    model = fit(docs.filter(~held_out(F.col(doc_id))).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")), **options)
    return predict(docs.withColumn("held_out", held_out(F.col(doc_id))), model, text, keep_text)
