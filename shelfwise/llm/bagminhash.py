"""BagMinHash near-duplicates: weighted-Jaccard signatures of word shingles, banding, exact multiset verification.

A text is the multiset of its 5-word shingles. Every shingle owns Poisson processes over dyadic weight intervals [0, 1), [1, 2),
[2, 4), ...; a point carries a time, a signature component and a weight coordinate, and counts for a text if the
coordinate lies below the shingle's weight there. A component keeps the point of least time, so two texts agree in a
component with the probability of their weighted Jaccard similarity, whatever the weights. Points come in order of time
and stop at the latest time a component still waits for, so long texts need about one point per shingle, not one per
shingle and component.

Equal texts are one node from the start. Nodes that agree in all components of a band share a bucket. A bucket is
never expanded into pairs: first the member met in most buckets is compared with all the others, which settles most
groups of near copies with one comparison per member. Where members of different classes are left, a bound decides who
can still match: a shingle that no other open text has is in no intersection and in every union. In each further round
``HUBS`` members of a bucket, those outside its largest class first, are compared with the members of other classes they
could match, and a bucket goes on until one class is left of those that had no turn. Two texts that share several buckets
meet in the first of them only, and not at all if their likenesses to the bucket's first member differ too much: weighted
Jaccard distance obeys the triangle inequality. Nor do they if they cannot share enough shingles even by the sums of their weights
over ``PARTS`` parts of the hash range, of which two texts have at most the lesser in common. So every link that could join two
classes is tested or ruled out, and none within a class is tested. Comparisons are exact on the shingle multisets (32-bit
shingle hashes). Classes are connected components over the links, by minimum labels.

Defined results: a text without words belongs only with equal texts; a text of fewer than five words is one shingle of all of
them; null and empty texts are equal; the class id is the least doc_id of the class (null if it has none); repeated
rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.shared import bitmap_of, is_marked, slices
from shelfwise.llm.words import ALNUM, Words, lower_table, mix, shingles, uniform
from shelfwise.operators.keys import top_per_group
from shelfwise.session import cut_lineage

SHINGLE, COMPONENTS, ROWS, SIMILAR = 5, 128, 4, 0.8
BITMAP_BITS = 23
PARTS = 128
_SLICE = 8 << 20


def bags(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each row: hash, weight (occurrences), row; sorted by row and hash."""
    hashes, begin = shingles(Words(column, ALNUM, lower_table()), size)
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    return hashes[first], np.diff(np.append(first, len(hashes))), row[first]


def signatures(hashes: np.ndarray, weights: np.ndarray, row: np.ndarray, rows: int, components: int = COMPONENTS) -> np.ndarray:
    """Signature (rows x components) of weighted sets; a row without elements keeps zeros."""
    times = np.full(rows * components, np.inf)
    marks = np.zeros(rows * components, dtype=np.uint64)
    key, low, width, weight, owner = [], [], [], [], []
    left, level, base, step = np.arange(len(hashes)), 0, 0.0, 1.0
    while len(left):
        key.append(mix(hashes[left] + mix(np.uint64(level))))
        low.append(np.full(len(left), base))
        width.append(np.full(len(left), step))
        weight.append(weights[left].astype(np.float64))
        owner.append(row[left])
        level, base, step = level + 1, base + step, step if level == 0 else step * 2
        left = left[weights[left] > base]
    if not key:
        return marks.reshape(rows, components)
    key, low, width, weight, owner = map(np.concatenate, (key, low, width, weight, owner))
    clock = np.zeros(len(key))
    latest = np.full(rows, np.inf)
    stride = np.array([0xD1342543DE82EF95], dtype=np.uint64)
    point = np.zeros(1, dtype=np.uint64)
    while len(key):
        point += stride
        draw = mix(key + point)
        clock = clock - np.log(uniform(draw)) / width
        alive = clock < latest[owner]
        if not alive.all():
            key, low, width, weight, owner, clock, draw = (x[alive] for x in (key, low, width, weight, owner, clock, draw))
            if not len(key):
                break
        place = mix(draw)
        counts = np.flatnonzero(low + uniform(place) * width < weight)
        slot = owner[counts] * components + (mix(place[counts]) % np.uint64(components)).astype(np.int64)
        at = clock[counts]
        np.minimum.at(times, slot, at)
        best = times[slot] == at
        marks[slot[best]] = draw[counts[best]]
        live = np.unique(owner)
        latest[live] = times.reshape(rows, components)[live].max(axis=1)
    return marks.reshape(rows, components)


def band_keys(marks: np.ndarray, per_band: int = ROWS) -> np.ndarray:
    """One 64-bit key per band (rows x bands)."""
    rows, components = marks.shape
    bands = components // per_band
    parts = marks[:, : bands * per_band].reshape(rows, bands, per_band)
    out = mix(np.arange(bands, dtype=np.uint64))[None, :].repeat(rows, axis=0)
    for k in range(per_band):
        out = mix(out ^ parts[:, :, k])
    return out


def likeness(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard of two sorted multisets."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    common = np.minimum(wa[i], wb[j]).sum()
    total = wa.sum() + wb.sum() - common
    return float(common / total) if total else 1.0


def nodes_of(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with ``nid``, the 16-byte digest that equal texts share."""
    return docs.withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit(""))).withColumn(
        "nid", F.unhex(F.md5(F.col("__text").cast("binary")))
    )


def _signed(components: int, per_band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", _SLICE):
                hashes, weights, row = bags(part.column("__text"))
                keys = band_keys(signatures(hashes, weights, row, part.num_rows, components), per_band)
                some = np.bincount(row, minlength=part.num_rows) > 0
                sizes = np.where(some, keys.shape[1], 0)
                values = pa.array(keys[some].ravel().view(np.int64))
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("nid"), bands], ["doc_id", "nid", "bands"])

    return run


def _bagged(bitmap):
    """Shingle multisets of the texts whose digest is marked in the bitmap (a superset of those wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text", _SLICE):
                part = part.filter(pa.array(is_marked(bitmap.value, part.column("spot").to_numpy())))
                if not part.num_rows:
                    continue
                hashes, weights, row = bags(part.column("__text"))
                short = (hashes >> np.uint64(32)).astype(np.uint32)
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1))
                packed, counted, totals, parts = [], [], [], []
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    values, at = np.unique(short[a:b], return_inverse=True)
                    w = np.bincount(at, weights=weights[a:b], minlength=len(values)).astype(np.uint32)
                    packed.append(values.tobytes())
                    counted.append(b"" if (w == 1).all() else w.tobytes())
                    totals.append(int(w.sum()))
                    parts.append(np.bincount(values % PARTS, weights=w, minlength=PARTS).astype(np.int32))
                columns = [part.column("nid"), pa.array(packed, pa.binary()), pa.array(counted, pa.binary()), pa.array(totals, pa.int64()), pa.array(parts, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["nid", "bag", "weights", "total", "parts"])

    return run


def bag(values: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    v = np.frombuffer(values, np.uint32)
    return v, np.frombuffer(weights, np.uint32).astype(np.int64) if weights else np.ones(len(v), np.int64)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per text and shingle."""
    for batch in batches:
        bags_ = [bag(v, w) for v, w in zip(batch.column("bag").to_pylist(), batch.column("weights").to_pylist())]
        owner = np.repeat(np.arange(len(bags_)), [len(v) for v, _ in bags_])
        shingle = np.concatenate([v for v, _ in bags_] or [np.empty(0, np.uint32)]).view(np.int32)
        weight = np.concatenate([w for _, w in bags_] or [np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays([batch.column("nid").take(pa.array(owner)), pa.array(shingle), pa.array(weight)], ["nid", "shingle", "weight"])


def own_weights(nids: DataFrame, bag_table: DataFrame) -> DataFrame:
    """nid, total, own: the weight of a text's shingles, and of those that no other text of ``nids`` has."""
    opened = bag_table.join(nids, "nid", "left_semi").select("nid", "bag", "weights").mapInArrow(_opened, "nid binary, shingle int, weight long")
    single = opened.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.first("nid").alias("nid"), F.first("weight").alias("weight")).filter("n = 1")
    own = single.groupBy("nid").agg(F.sum("weight").alias("own"))
    return bag_table.select("nid", "total").join(nids, "nid", "left_semi").join(own, "nid", "left").select("nid", "total", F.coalesce("own", F.lit(0)).alias("own"))


def could_match(total: Column, own: Column, other_total: Column, other_own: Column, least: float) -> Column:
    """Whether two texts can reach the similarity: what is a text's own is not common, and what is the other's own is in the union."""
    common = F.least(total - own, other_total - other_own)
    union = F.greatest(total + other_own, other_total + own)
    return common + 1e-9 >= least * union


def parts_match(parts: Column, other: Column, total: Column, other_total: Column, least: float) -> Column:
    """Whether the weights by part of the hash range, whose lesser ones bound what is common, allow the similarity.

    The sum over the parts is named once: what stands twice in a condition is worked out before it, for every pair, even for those
    that the terms before this one rule out.
    """
    common = F.aggregate(F.zip_with(parts, other, lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda n, x: n + x)
    return common * (1 + least) + 1e-6 >= least * (total + other_total)


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [batch.column(c).to_pylist() for c in ("bag_a", "weights_a", "bag_b", "weights_b")]
            alike = [likeness(*bag(va, wa), *bag(vb, wb)) for va, wa, vb, wb in zip(*cells)]
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(alike, pa.float64())], ["a", "b", "alike"])
            yield out.filter(pa.array(np.array(alike) >= least))

    return run


def spot_of(nid: str):
    return F.pmod(F.xxhash64(nid), F.lit(1 << BITMAP_BITS)).cast("int")


def components_of(links: DataFrame) -> DataFrame:
    """a, label: the least value of each connected component, over all linked values.

    Each round a value takes the least label among its own and its neighbours', then the label of its label; rounds are
    written out and end when nothing changes.
    """
    both = cut_lineage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label"))
    while True:
        near = both.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        met = labels.join(near, "a", "left").select("a", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("mid"))
        up = labels.select(F.col("a").alias("mid"), F.col("label").alias("up"))
        new = cut_lineage(met.join(up, "mid", "left").select("a", "old", F.least("mid", F.coalesce("up", "mid")).alias("label")))
        if new.filter(F.col("old") != F.col("label")).isEmpty():
            return new.select("a", "label")
        labels = new.select("a", "label")


def relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (nid, label) after new links between classes: only the labels that meet are worked on."""
    one, two = (labels.select(F.col("nid").alias(c), F.col("label").alias(f"label_{c}")) for c in "ab")
    met = found.join(one, "a").join(two, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).filter("a != b")
    changed = components_of(met).select(F.col("a").alias("label"), F.col("label").alias("new"))
    return cut_lineage(labels.join(changed, "label", "left").select("nid", F.coalesce("new", "label").alias("label")))


HUBS = 128


def classes_of(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", components: int = COMPONENTS, per_band: int = ROWS, least: float = SIMILAR) -> DataFrame:
    """nid, class_id, class_size, n_copies, keeper and first_id for every distinct text."""
    spark = docs.sparkSession
    source = nodes_of(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, nid binary, bands array<long>"
    signed = source.select("doc_id", "nid", "__text").mapInArrow(_signed(components, per_band), schema)
    nodes = cut_lineage(signed.groupBy("nid").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"), F.first("bands").alias("bands")))

    met = nodes.select("nid", F.explode("bands").alias("bucket"))
    shared = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    waiting = cut_lineage(met.join(shared, "bucket"))
    # every text that shares a bucket with another, with its shingles
    wanted = cut_lineage(waiting.select("nid").distinct())
    bitmap = spark.sparkContext.broadcast(bitmap_of(wanted.select(spot_of("nid").alias("spot")), BITMAP_BITS))
    marked = source.select("nid", spot_of("nid").alias("spot"), "__text").mapInArrow(_bagged(bitmap), "nid binary, bag binary, weights binary, total long, parts array<int>")
    once = marked.groupBy("nid").agg(*[F.first(c).alias(c) for c in ("bag", "weights", "total", "parts")])
    bag_table = cut_lineage(once.join(wanted, "nid", "left_semi"))
    sides = [bag_table.select(F.col("nid").alias(s), F.col("bag").alias(f"bag_{s}"), F.col("weights").alias(f"weights_{s}")) for s in ("a", "b")]

    verify = lambda pairs, least=least: cut_lineage(
        pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(_verified(least), "a binary, b binary, alike double")
    )
    pair = [F.least("nid", "hub").alias("a"), F.greatest("nid", "hub").alias("b")]

    traits = nodes.select("nid", "bands").join(bag_table.select("nid", "parts"), "nid")
    # first round: everyone in a bucket against its member met most
    degree = waiting.groupBy("nid").agg(F.sum("size").alias("degree"))
    hubs = waiting.join(degree, "nid").groupBy("bucket").agg(F.max_by("nid", F.struct("degree", "nid")).alias("hub"))
    first = cut_lineage(waiting.select("bucket", "nid").join(hubs, "bucket"))
    done = cut_lineage(first.filter("nid != hub").select(*pair).distinct())
    measured = verify(done, 0.0)
    labels = relabelled(wanted.withColumn("label", F.col("nid")), measured.filter(F.col("alike") >= least).select("a", "b"))
    near = F.col("alike").alias("near")
    left = cut_lineage(first.filter("nid != hub").select("bucket", "nid", *pair).join(measured, ["a", "b"]).select("bucket", "nid", near))
    weights = None
    while True:
        rest = left.join(labels, "nid")
        still = rest.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"))
        rest = cut_lineage(rest.join(still.filter("x != y").select("bucket"), "bucket"))
        if rest.isEmpty():
            break
        if weights is None:
            weights = cut_lineage(own_weights(rest.select("nid").distinct(), bag_table))
            rest = rest.join(weights, "nid")
            floor = rest.groupBy("bucket").agg(F.min("own").alias("floor"))
            # who could match no one in the bucket, whatever the other is, is settled
            rest = cut_lineage(rest.join(floor, "bucket").filter(F.col("total") - F.col("own") + 1e-9 >= least * (F.col("total") + F.col("floor"))))
        else:
            rest = rest.join(weights, "nid")
        sizes = rest.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("largest"))
        # members outside the largest class come first: once they have had their turn, one class is left
        ranked = rest.join(largest, "bucket").withColumn("inside", F.col("label") == F.col("largest"))
        turn = top_per_group(ranked, ["bucket"], [F.asc("inside"), F.asc("own"), F.asc("nid")], HUBS)
        chosen = cut_lineage(turn.join(traits, "nid").select("bucket", *[F.col(c).alias(f"hub_{c}") for c in ("label", "total", "own", "bands", "near", "parts")], F.col("nid").alias("hub")))
        possible = could_match(F.col("total"), F.col("own"), F.col("hub_total"), F.col("hub_own"), least)
        one, two = rest.join(traits, "nid").alias("one"), chosen.alias("two")
        # of all buckets two texts share, they meet in the first
        met_first = F.abs(F.col("near") - F.col("hub_near")) <= 1 - least + 1e-9
        met_first &= F.element_at(F.array_intersect("bands", "hub_bands"), 1) == F.col("one.bucket")
        alike = parts_match(F.col("parts"), F.col("hub_parts"), F.col("total"), F.col("hub_total"), least)
        tested = one.join(two, (F.col("one.bucket") == F.col("two.bucket")) & (F.col("label") != F.col("hub_label")) & possible & met_first & alike)
        # two texts that met in a bucket before need no second comparison
        fresh = cut_lineage(tested.select(*pair).distinct().join(done, ["a", "b"], "left_anti"))
        if not fresh.isEmpty():
            done = done.unionByName(fresh)
            labels = relabelled(labels, verify(fresh))
        left = cut_lineage(rest.select("bucket", "nid", "near").join(chosen.select("bucket", F.col("hub").alias("nid")), ["bucket", "nid"], "left_anti"))
    labelled = nodes.drop("bands").join(labels, "nid", "left").withColumn("label", F.coalesce("label", "nid"))
    sums = labelled.groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.sum("n_copies").alias("class_size"), F.min_by("nid", F.struct(F.col("doc_id").isNull(), "doc_id", "nid")).alias("keeper")
    )
    return labelled.join(sums, "label").select("nid", "class_id", "class_size", "n_copies", "keeper", F.col("doc_id").alias("first_id"))


def classify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, class_size, n_copies of every document."""
    table = cut_lineage(classes_of(docs, **options))
    names = nodes_of(docs.select("doc_id", "text")).select("doc_id", "nid")
    return names.join(table, "nid").select("doc_id", "class_id", "class_size", "n_copies")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents with their own columns, one row of each class: that of its least doc_id (nulls last)."""
    table = cut_lineage(classes_of(docs, **options).filter(F.col("nid") == F.col("keeper")).select("nid", "first_id"))
    marked = nodes_of(docs).withColumn("__id", F.struct(F.col("doc_id").alias("v")))
    kept = marked.join(table.select("nid", F.struct(F.col("first_id").alias("v")).alias("__id")), ["nid", "__id"], "left_semi")
    return kept.dropDuplicates(["nid", "__id"]).select(*docs.columns)
