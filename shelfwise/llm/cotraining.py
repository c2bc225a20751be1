"""Quality classifier by co-training: a view of the text and a view of the page's metadata teach each other.

* Content view: byte trigrams of the raw text, hashed into ``CONTENT`` bins; naive Bayes, read as the mean log-odds per
  trigram so that length does not inflate it.
* Metadata view: source, language and layout figures (length, lines, line length, shares of capitals, symbols, digits
  and blanks, repeated words, words equal to the one before), each cut into a few values; naive Bayes.

Both start from a bounded sample of labelled rows (``labelled``, the least hashes of doc_id); a quarter of it is held back
for calibration. In each round all documents are scored, and those one view is sure of are counted under that label for the
other view. Naive Bayes needs only such counts, so a round is one pass whose tasks give two count vectors of fixed size,
and the pseudo-labels cover the whole corpus. In the end both views are calibrated by Platt scaling and combined by a logistic
model of the two, and all documents are scored.

The same views are fitted a second time on ``toxic``. A toxic text holds few toxic words, which the mean trigram odds hardly
show, so its content view has two more figures: the strongest and the sum of the odds of its words (runs of letters and
digits, lower-cased, by 64-bit hash). A word's odds are those of the labelled documents that hold it, less two standard errors,
and only words above zero count. Both targets share every pass.

Defined results: null and empty texts are scored by their metadata and the calibrated base rate; null source or language is a
value of its own; ids labelled both ways, null ids and null labels take no part, for each target on its own; of the documents of one
labelled id one is learnt from; repeated documents are scored each; without labels of both kinds every score of that
target is 0.5 and drops no document.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfwise.llm.shared import slices
from shelfwise.llm.words import ALNUM, NOT_SPACE, Words, buffers, byte_class, lower_table, mix
from shelfwise.session import cut_lineage

CONTENT, VALUES, LABELLED, ROUNDS, SURE, KEEP, TOXIC = 2048, 64, 4000, 2, 0.995, 0.5, 0.5
SURE_BY = 2  # standard errors a word's odds are lowered by
FIELDS = ("source", "lang", "length", "lines", "line_length", "capitals", "symbols", "digits", "blanks", "repeats", "doubled")
ADDED = T.StructType([T.StructField(c, T.DoubleType()) for c in ("content_score", "metadata_score", "quality_score", "toxic_score")])


def content_view(part: pa.RecordBatch) -> np.ndarray:
    """Share of each trigram bin in each text (rows x CONTENT)."""
    data, rows = buffers(part.column("__text"))
    n = part.num_rows
    out = np.zeros((n, CONTENT), dtype=np.float32)
    if len(data) < 3:
        return out
    wide = data.astype(np.uint32)
    gram = (wide[:-2] * np.uint32(65599) + wide[1:-1]) * np.uint32(65599) + wide[2:]
    bins = ((gram * np.uint32(2654435761)) >> np.uint32(32 - 11)).astype(np.int64)
    row = np.repeat(np.arange(n), np.diff(rows))[:-2]
    inside = np.arange(len(gram)) + 2 < rows[1:][row]
    out[:] = np.bincount(row[inside] * CONTENT + bins[inside], minlength=n * CONTENT).reshape(n, CONTENT)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def word_view(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words of each text, and their rows."""
    words = Words(part.column("__text"), ALNUM, lower_table(), spans=False)
    owner = words.row_of()
    first = np.sort(np.unique(words.hash ^ mix(owner), return_index=True)[1])
    return words.hash[first], owner[first]


class WordOdds:
    """Words that speak for a label: sorted hashes and their odds."""

    def __init__(self, keys: np.ndarray, odds: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.odds = keys[order], odds[order]

    def figures(self, part: pa.RecordBatch) -> np.ndarray:
        """Strongest odds, and logarithm of one and their sum, in each text (rows x 2)."""
        out = np.zeros((part.num_rows, 2))
        if len(self.keys):
            words = Words(part.column("__text"), ALNUM, lower_table(), spans=False)
            at = np.minimum(np.searchsorted(self.keys, words.hash), len(self.keys) - 1)
            met = np.flatnonzero(self.keys[at] == words.hash)
            owner = words.row_of()[met]
            first = np.unique(words.hash[met] ^ mix(owner), return_index=True)[1]  # each word of a text once
            np.maximum.at(out[:, 0], owner[first], self.odds[at[met[first]]])
            out[:, 1] = np.log1p(np.bincount(owner[first], weights=self.odds[at[met[first]]], minlength=part.num_rows))
        return out


_MARKS = byte_class([(33, 47), (58, 64), (91, 96), (123, 126)])


def metadata_view(part: pa.RecordBatch) -> np.ndarray:
    """Value of each field (rows x fields), each below VALUES."""
    data, rows = buffers(part.column("__text"))
    n = part.num_rows
    size = np.diff(rows)
    full = np.flatnonzero(size)

    def total(mask: np.ndarray) -> np.ndarray:
        out = np.zeros(n, dtype=np.int64)
        if len(full):
            out[full] = np.add.reduceat(mask, rows[full], dtype=np.int32)
        return out

    share = lambda mask: total(mask) / np.maximum(size, 1)
    lines = total(data == 10) + 1
    ascii_mark = _MARKS[data]
    words = Words(part.column("__text"), NOT_SPACE, spans=False)
    count = words.counts()
    owner = words.row_of()
    first = np.unique(words.hash ^ mix(owner), return_index=True)[1]  # each word of a text once
    distinct = np.bincount(owner[first], minlength=n)
    again = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])  # words equal to the one before
    doubled = np.bincount(owner[1:][again], minlength=n)
    log = lambda x: np.minimum(np.log2(np.maximum(x, 1)) * 2, VALUES - 1)
    step = lambda x: np.minimum(np.sqrt(x) * (VALUES - 1), VALUES - 1)
    named = lambda c: np.array([hash_value(v) for v in part.column(c).to_pylist()], dtype=np.float64)
    fields = [
        named("__source"), named("__lang"), log(size), log(lines), log(size / lines), step(share((data >= 65) & (data <= 90))), step(share(ascii_mark)),
        step(share((data >= 48) & (data <= 57))), step(share((data == 32) | (data == 10))), step(1 - distinct / np.maximum(count, 1)), step(doubled / np.maximum(count, 1)),
    ]
    return np.stack(fields, axis=1).astype(np.int64)


@lru_cache(maxsize=1 << 16)
def hash_value(value: str | None) -> int:
    if value is None:
        return 0
    folded = 0
    for byte in value.encode():
        folded = (folded * 257 + byte) % (1 << 61)
    return 1 + int(mix(np.array([folded], dtype=np.uint64))[0] % np.uint64(VALUES - 1))


class Views:
    """Class counts of both views: content (2 x CONTENT), metadata (2 x fields x VALUES)."""

    def __init__(self, content: np.ndarray | None = None, metadata: np.ndarray | None = None):
        self.content = np.zeros((2, CONTENT)) if content is None else content
        self.metadata = np.zeros((2, len(FIELDS), VALUES)) if metadata is None else metadata

    def add(self, label: np.ndarray, content: np.ndarray | None = None, metadata: np.ndarray | None = None) -> None:
        for y in (0, 1):
            if content is not None:
                self.content[y] += content[label == y].sum(axis=0)
            if metadata is not None:
                for f in range(len(FIELDS)):
                    self.metadata[y, f] += np.bincount(metadata[label == y, f], minlength=VALUES)

    def plus(self, flat: np.ndarray) -> Views:
        cut = self.content.size
        return Views(self.content + flat[:cut].reshape(self.content.shape), self.metadata + flat[cut:].reshape(self.metadata.shape))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.content.ravel(), self.metadata.ravel()])

    def odds(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """Log-odds of quality from each view (rows x 2), without the prior."""
        smooth = self.content + 0.01 * (self.content.sum(axis=1, keepdims=True) + 1) / CONTENT
        logs = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        near = self.metadata.copy()  # a value lends to its neighbours: the figures are cut from continuous ones
        near[:, 2:, 1:] += 0.5 * self.metadata[:, 2:, :-1]
        near[:, 2:, :-1] += 0.5 * self.metadata[:, 2:, 1:]
        near += 0.5
        meta = np.log(near / near.sum(axis=2, keepdims=True))
        ratio = meta[1] - meta[0]
        return np.stack([content @ (logs[1] - logs[0]), ratio[np.arange(len(FIELDS)), metadata].sum(axis=1)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, decay: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights (last: intercept) of a logistic model of a few columns, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - decay * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + decay * np.eye(len(w))
        move = np.linalg.solve(curve, slope)
        w = w + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-8:
            break
    return w


def probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ w, -30, 30)))


class Calibrated:
    """Both views with their Platt scales, and the combination; ``words``: figures of the content view beside the trigrams."""

    def __init__(self, views: Views, content: np.ndarray, metadata: np.ndarray, label: np.ndarray, words: np.ndarray | None = None):
        self.views = views
        raw = self.raw(content, metadata, words)
        self.scale, self.each = raw.std(axis=0) + 1e-9, []
        self.columns = ([0, *range(2, raw.shape[1])], [1])
        for own in self.columns:
            self.each.append(logistic(raw[:, own] / self.scale[own], label))
        self.both = logistic(self.logits(raw), label, decay=1.0)

    def raw(self, content: np.ndarray, metadata: np.ndarray, words: np.ndarray | None) -> np.ndarray:
        odds = self.views.odds(content, metadata)
        return odds if words is None else np.column_stack([odds, words])

    def logits(self, raw: np.ndarray) -> np.ndarray:
        return np.stack([np.clip(raw[:, own] / self.scale[own] @ w[:-1] + w[-1], -12, 12) for own, w in zip(self.columns, self.each)], axis=1)

    def scores(self, content: np.ndarray, metadata: np.ndarray, words: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        z = self.logits(self.raw(content, metadata, words))
        return 1 / (1 + np.exp(-z[:, 0])), 1 / (1 + np.exp(-z[:, 1])), probability(z, self.both)


class Fitted:
    """The calibrated views of each target (none without labels of both kinds), and the words of the second."""

    def __init__(self, quality: Calibrated | None, toxic: Calibrated | None, words: WordOdds):
        self.quality, self.toxic, self.words = quality, toxic, words

    def scores(self, part: pa.RecordBatch, content: np.ndarray, metadata: np.ndarray) -> tuple[list, list]:
        """Scores of a batch by content, by metadata and by both, for each target."""
        none = [np.full(part.num_rows, 0.5)] * 3
        quality = self.quality.scores(content, metadata) if self.quality else none
        toxic = self.toxic.scores(content, metadata, self.words.figures(part)) if self.toxic else none
        return list(quality), list(toxic)


def prepared(docs: DataFrame) -> DataFrame:
    named = lambda c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
    return docs.select(
        *docs.columns, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"), named("source").alias("__source"), named("lang").alias("__lang")
    )


def label_order(doc_id: Column) -> Column:
    return F.xxhash64(F.lit("label"), doc_id)


def sample_of(labels: DataFrame, labelled: int, target: str = "quality") -> DataFrame:
    """At most ``labelled`` ids with one label of ``target``, those of the least hashes."""
    value = F.col(target) if target in labels.columns else F.lit(None).cast("int")
    rows = labels.select("doc_id", value.alias(target)).filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    one = rows.groupBy("doc_id").agg(F.min(target).alias("low"), F.max(target).alias("high")).filter("low = high")
    return one.select("doc_id", F.col("low").cast("int").alias(target), label_order(F.col("doc_id")).alias("order")).orderBy("order", "doc_id").limit(labelled)


def learnt(rows: DataFrame, sample: DataFrame) -> DataFrame:
    """One document of each sampled id."""
    own = F.struct("__text", "__source", "__lang")
    joined = rows.join(F.broadcast(sample), "doc_id")
    one = joined.groupBy("doc_id", "quality", "toxic", "order").agg(F.min_by(own, F.struct(F.xxhash64(own), own)).alias("own"))
    return one.select("quality", "toxic", "order", "own.*")


def word_odds(seen: DataFrame, taught: DataFrame, sizes: np.ndarray) -> WordOdds:
    """Words whose odds of label 1 are above 0 by more than ``SURE_BY`` standard errors, from ``sizes`` documents of each label."""
    rows = seen.select("order", F.explode("words").alias("word")).join(F.broadcast(taught), "order")
    counts = rows.groupBy("word").agg(*[F.count(F.when(F.col("label") == y, 1)).alias(f"n{y}") for y in (0, 1)])
    share = lambda y: (F.col(f"n{y}") + 0.5) / F.lit(float(sizes[y] + 1))
    error = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    found = counts.select("word", (F.log(share(1)) - F.log(share(0)) - SURE_BY * error).alias("odds")).filter("odds > 0").toArrow()
    return WordOdds(found.column("word").to_numpy().astype(np.int64).view(np.uint64), found.column("odds").to_numpy().astype(np.float64))


def held_back(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows for calibration and rows for teaching; all for both if the held ones are not of both kinds."""
    held = np.arange(len(label)) % 4 == 3
    if len(set(label[held].tolist())) < 2:
        held = np.ones(len(label), dtype=bool)
    return held, ~held if not held.all() else held


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, sure: float = SURE) -> Fitted | None:
    """The calibrated views; none if the labelled documents are not of both kinds for either target."""
    spark = docs.sparkSession
    rows = prepared(docs).select("doc_id", "__text", "__source", "__lang")
    picked = sample_of(labels, labelled).join(sample_of(labels, labelled, "toxic"), ["doc_id", "order"], "full").select("doc_id", "order", "quality", "toxic").toArrow()
    if not picked.num_rows:
        return None
    sample = spark.createDataFrame(picked)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                if part.num_rows:
                    a, b = content_view(part).astype(np.float16), metadata_view(part).astype(np.uint8)
                    words, owner = word_view(part)
                    begin = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("quality"), part.column("toxic"), part.column("order"), pa.array([x.tobytes() for x in a], pa.binary()), pa.array([x.tobytes() for x in b], pa.binary()),
                            pa.ListArray.from_arrays(pa.array(begin), pa.array(words.view(np.int64))),
                        ],
                        ["quality", "toxic", "order", "content", "metadata", "words"],
                    )

    views = cut_lineage(learnt(rows, sample).mapInArrow(seen, "quality int, toxic int, order long, content binary, metadata binary, words array<long>"))
    found = views.drop("words").orderBy("order").toArrow()
    content = np.frombuffer(b"".join(found.column("content").to_pylist()), np.float16).reshape(-1, CONTENT).astype(np.float64)
    metadata = np.frombuffer(b"".join(found.column("metadata").to_pylist()), np.uint8).reshape(-1, len(FIELDS)).astype(np.int64)
    order = found.column("order").to_numpy()
    words, targets, models = WordOdds(np.empty(0, np.uint64), np.empty(0)), {}, {}
    for target in ("quality", "toxic"):
        marked = found.column(target)
        at = np.flatnonzero(marked.is_valid().to_numpy())
        label = marked.drop_null().to_numpy().astype(np.int64)
        if len(set(label.tolist())) < 2:
            continue
        held, taught = held_back(label)
        figures = None
        if target == "toxic":
            known = pa.table({"order": order[at[taught]], "label": label[taught]})
            words = word_odds(views, spark.createDataFrame(known), np.bincount(label[taught], minlength=2))
            figures = word_figures(views, words, order[at[held]])
        own = Views()
        own.add(label[taught], content[at[taught]], metadata[at[taught]])
        targets[target] = (own, content[at[held]], metadata[at[held]], label[held], figures)
        models[target] = Calibrated(*targets[target])
    if not models:
        return None
    fitted = Fitted(models.get("quality"), models.get("toxic"), words)
    marks = sample.select("doc_id", *[F.col(t).isNotNull().alias(f"__{t}") for t in ("quality", "toxic")])
    unlabelled = rows.join(F.broadcast(marks), "doc_id", "left").filter("not coalesce(__quality and __toxic, false)")
    for _ in range(rounds):
        counts = pseudo_counts(unlabelled, fitted, sure)
        for target, (own, *rest) in targets.items():
            models[target] = Calibrated(own.plus(counts[target]), *rest)
        fitted = Fitted(models.get("quality"), models.get("toxic"), words)
    return fitted


def word_figures(views: DataFrame, words: WordOdds, order: np.ndarray) -> np.ndarray:
    """``WordOdds.figures`` of the sampled documents of these orders."""
    spark = views.sparkSession
    odds = spark.createDataFrame(pa.table({"word": words.keys.view(np.int64), "odds": words.odds}))
    met = views.select("order", F.explode("words").alias("word")).join(F.broadcast(odds), "word")
    found = met.groupBy("order").agg(F.max("odds").alias("most"), F.log1p(F.sum("odds")).alias("sum")).toArrow().to_pydict()
    by = dict(zip(found["order"], zip(found["most"], found["sum"])))
    return np.array([by.get(int(o), (0.0, 0.0)) for o in order]).reshape(-1, 2)


def pseudo_counts(rows: DataFrame, fitted: Fitted, sure: float) -> dict[str, np.ndarray]:
    """Counts each view of each target gets from the documents the other view is sure of, over all rows without that label."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)
    size = Views().flat().size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, both = shared.value, (Views(), Views())
        for batch in batches:
            for part in slices(batch, "__text"):
                if part.num_rows:
                    a, b = content_view(part), metadata_view(part)
                    for sums, scores, name in zip(both, held.scores(part, a, b), ("__quality", "__toxic")):
                        by_content, by_metadata, _ = scores
                        free = ~part.column(name).fill_null(False).to_numpy(zero_copy_only=False)
                        for p, to_content in ((by_metadata, True), (by_content, False)):
                            label = np.where(~free, -1, np.where(p >= sure, 1, np.where(p <= 1 - sure, 0, -1)))
                            sums.add(label, a if to_content else None, None if to_content else b)
        flat = np.concatenate([sums.flat() for sums in both])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], ["at", "value"])

    found = rows.select("__text", "__source", "__lang", "__quality", "__toxic").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(2 * size)
    out[found.column("at").to_numpy()] = found.column("value").to_numpy()
    return {"quality": out[:size], "toxic": out[size:]}


def score(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, rounds: int = ROUNDS, sure: float = SURE) -> DataFrame:
    """Every document with its columns, ``content_score``, ``metadata_score``, ``quality_score`` and ``toxic_score`` (0 to 1)."""
    model = fit(docs, labels, labelled, rounds, sure)
    rows = prepared(docs).drop(*ADDED.names)
    if model is None:
        return rows.drop("__text", "__source", "__lang").select("*", *[F.lit(0.5).alias(c) for c in ADDED.names])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in rows.schema.fields if f.name not in ("__text", "__source", "__lang")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                scores = [np.empty(0)] * 4
                if part.num_rows:
                    quality, toxic = shared.value.scores(part, content_view(part), metadata_view(part))
                    scores = [*quality, toxic[2]]
                yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], *map(pa.array, scores)], [*[f.name for f in kept], *ADDED.names])

    return rows.mapInArrow(run, T.StructType([*kept, *ADDED.fields]))


def keep_good(docs: DataFrame, labels: DataFrame, keep: float = KEEP, toxic: float = TOXIC, **options) -> DataFrame:
    """The documents not rejected for their quality or as toxic, with their own columns."""
    good = score(docs, labels, **options).filter((F.col("quality_score") >= keep) & (F.col("toxic_score") <= toxic))
    return good.select([c for c in docs.columns])
