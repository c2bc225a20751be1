"""Removal of repeated strings by merging Burrows-Wheeler transforms of text shards.

Every string of ``length`` bytes that starts at two places anywhere is removed at all of them (the union of such strings).

*Anchors.* Of every run of ``length - GRAM + 1`` consecutive 32-byte grams the one of least hash (the last on a tie) is an anchor, so each
string holds one, at the same offset wherever the string occurs. A string is then named by its anchor and by l, the
bytes of it left of the anchor, and l is cut into two ranges. All strings of a range share a core; their union is the
anchor's surroundings. Cores that occur once are done (no string of theirs repeats), and so are equal surroundings
(all strings of theirs repeat): what is left are cores that occur in different surroundings.

*Merge.* The surroundings of one core come from many shards. They stand column by column over each other, and the order of
all suffixes of one column follows from that of the next one by a stable distribution on the symbols before them, which
are the Burrows-Wheeler symbols: the interleave is refined column by column from the right end, no suffix is ever sorted by
its text, and the longest common prefixes of neighbours come along (1 + the least of those between them before, where the
symbols agree; 0 elsewhere). A string repeats where a neighbour's common prefix reaches ``length``; members that agree with no
other up to a column leave the merge there.

*Hot cores.* A core in more than ``bucket`` different surroundings is not gathered: its range of l is cut into four, each with a
longer core of its own, and the parts are settled anew, down to single strings, which counts alone decide. Nothing is
capped; equal surroundings are one row with a count before any shuffle that gathers them.

Texts move only where they must: a bitmap of fixed size marks the documents concerned (and a few more), the others are
finished where they are read.

Defined results: a null text is empty; texts shorter than ``length`` lose nothing; strings do not cross texts; a string that
overlaps its own repeat is removed as well; documents equal in doc_id and text are one entry counted as often as it occurs.
Cores, surroundings and documents are told apart by 64-bit hashes (surroundings by two).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.shared import bitmap_of, is_marked, row_key, slices
from shelfwise.llm.words import buffers, mix
from shelfwise.session import cut_lineage

LENGTH, GRAM, BUCKET, PARTS = 400, 32, 256, 4
BITMAP_BITS = 24
PIECE = 1 << 20  # bytes of text, and at most so many bytes of contexts, worked on at a time
_MASK = np.uint64((1 << 24) - 1)


def sides(length: int = LENGTH) -> list[tuple[int, int]]:
    """The two ranges of l, the bytes of a string left of its anchor."""
    most = length - GRAM
    return [(0, most // 2), (most // 2 + 1, most)]


def anchors(data: np.ndarray, rows: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions of the anchors of all texts of a buffer, and their rows."""
    window = length - GRAM + 1
    found, owner = [], []
    for low in range(0, max(len(data) - length + 1, 0), PIECE):
        high = min(len(data), low + PIECE + length - 1)
        part = data[low:high]
        grams = _gram_hashes(part)
        n = len(grams)
        ranked = (grams & ~_MASK) | (_MASK - np.arange(n, dtype=np.uint64))
        padded = np.full(-(-n // window) * window, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:n] = ranked
        blocks = padded.reshape(-1, window)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = np.arange(n - window + 1)
        least = np.minimum(behind[starts], ahead[starts + window - 1])
        row = np.searchsorted(rows, starts + low, side="right") - 1
        inside = starts + low + length <= rows[row + 1]
        at = (_MASK - (least[inside] & _MASK)).astype(np.int64) + low
        row = row[inside]
        new = np.ones(len(at), dtype=bool)
        new[1:] = at[1:] != at[:-1]
        found.append(at[new])
        owner.append(row[new])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at, row = np.concatenate(found), np.concatenate(owner)
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1]
    return at[new], row[new]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from every position on."""
    n = len(data) - GRAM + 1
    raw = data.tobytes()
    eight = np.empty(len(data) - 7, dtype=np.uint64)
    for o in range(8):
        part = np.frombuffer(raw, dtype="<u8", offset=o, count=(len(data) - o) // 8)
        eight[o::8] = part
    out = eight[:n] * np.uint64(0x9E3779B97F4A7C15)
    for k, odd in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (24, 0x27D4EB2F165667C5)):
        out = (out ^ (out >> np.uint64(29))) + eight[k : n + k] * np.uint64(odd)
    return mix(out)


def _found(length: int):
    """core, surroundings (un), document key and place (2 * anchor + side) of every anchor and side with a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                data, rows = buffers(part.column("text"))
                at, row = anchors(data, rows, length)
                view = memoryview(data.tobytes())
                first, last = rows[row], rows[row + 1]
                cores, unions, places, owners = [], [], [], []
                for side, (lo, hi) in enumerate(sides(length)):
                    some = np.maximum(lo, at + length - last) <= np.minimum(hi, at - first)
                    a, f, e = at[some], first[some], last[some]
                    left, right = np.maximum(a - hi, f), np.minimum(a + length - lo, e)
                    clip = ((left - (a - hi)) * 1024 + (a + length - lo - right)).tolist()
                    cores.append(np.array([digest(view[x:y]) for x, y in zip((a - lo).tolist(), (a + length - hi).tolist())], dtype=np.uint64))
                    unions.append(np.array([digest(view[x:y], c) for x, y, c in zip(left.tolist(), right.tolist(), clip)], dtype=np.uint64))
                    # the side is part of the core, so that strings of different sides never meet
                    cores[-1] = mix(cores[-1] + np.uint64(side))
                    places.append((a - f) * 2 + side)
                    owners.append(row[some])
                keys = part.column("dk").to_numpy()[np.concatenate(owners)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(cores).view(np.int64)), pa.array(np.concatenate(unions).view(np.int64)), pa.array(keys), pa.array(np.concatenate(places))],
                    ["core", "un", "dk", "at"],
                )

    return run


def _marked(bitmap, wanted: bool):
    """Rows whose document key is (not) marked in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = is_marked(bitmap.value, batch.column("dk").to_numpy() & ((1 << BITMAP_BITS) - 1))
            yield batch.filter(pa.array(mask if wanted else ~mask))

    return run


def spot_of(key: str):
    return F.col(key).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).cast("int")


CONTEXT = "core long, un long, core0 long, un0 long, x0 int, span int, n long, left binary, right binary"


def _contexts(length: int):
    """The bytes around the cores listed for each document: left of the longest core and right of the shortest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(length)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for text, wants in zip(batch.column("text").to_pylist(), batch.column("wants").to_pylist()):
                raw = text.encode()
                for w in wants:
                    lo, hi = both[w["at"] & 1]
                    a = w["at"] >> 1
                    cells = (w["core"], w["un"], 0, hi - lo, w["n"], raw[max(a - hi, 0) : a - lo], raw[a + length - hi : a + length - lo])
                    for column, value in zip(out, cells):
                        column.append(value)
            core, un, x0, span, n, left, right = out
            yield pa.RecordBatch.from_arrays(
                [pa.array(core, pa.int64()), pa.array(un, pa.int64()), pa.array(core, pa.int64()), pa.array(un, pa.int64()), pa.array(x0, pa.int32()),
                 pa.array(span, pa.int32()), pa.array(n, pa.int64()), pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                ["core", "un", "core0", "un0", "x0", "span", "n", "left", "right"],
            )

    return run


def _cut(parts: int):
    """Each context as up to ``parts`` contexts of narrower ranges with longer cores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                span, left, right = r["span"], r["left"], r["right"]
                step = -(-(span + 1) // parts)
                for x in range(0, span + 1, step):
                    y = min(x + step - 1, span)
                    if max(x, span - len(right)) > min(y, len(left)):
                        continue  # no string of this range lies within the text
                    near = left[len(left) - x :] + right[: span - y]
                    core = digest(r["core"].to_bytes(8, "little", signed=True) + near, (r["x0"] + x) * 1024 + y - x)
                    new_left, new_right = left[max(len(left) - y, 0) : len(left) - x], right[span - y : span - x]
                    un = digest(new_left + b"|" + new_right, len(new_left) * 1024 + len(new_right))
                    signed = [v - (1 << 64) if v >> 63 else v for v in (core, un)]
                    out.append({**r, "core": signed[0], "un": signed[1], "x0": r["x0"] + x, "span": y - x, "left": new_left, "right": new_right})
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)

    return run


def repeats(group: np.ndarray, left: list[bytes], right: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest x (-1: none) for which the string of each member occurs in another member of its group.

    The string x has the last x bytes of the left side, the core and the first span - x bytes of the right side. ``group`` is
    ascending. Common prefixes are counted without the core, which all members of a group share.
    """
    n = len(group)
    low, high = np.full(n, -1), np.full(n, -1)
    before = _matrix(left, span, flush_right=True)
    after = _matrix(right, span, flush_right=False)
    order = np.arange(n)
    common = np.zeros(n + 1, dtype=np.int64)
    common[:-1][np.concatenate([[True], group[1:] != group[:-1]])] = -1
    common[-1] = -1
    for c in range(span - 1, -1, -1):
        order, common = _refined(group, after[c], order, common)
    for x in range(span + 1):
        if x:
            order, common = _refined(group, before[span - x], order, common)
        near = np.maximum(common[:-1], common[1:])
        hit = order[near >= span]
        high[hit] = x
        low[hit[low[hit] < 0]] = x
        keep = np.flatnonzero(near >= x)
        if len(keep) < len(order):
            if not len(keep):
                break
            common = np.append(_gaps(common, keep), -1)
            order = order[keep]
    return low, high


def _gaps(common: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """Common prefix of each kept member with the kept one before it: the least over the gaps in between."""
    edges = np.empty(2 * len(keep), dtype=np.int64)
    edges[0::2] = np.concatenate([[0], keep[:-1] + 1])
    edges[1::2] = keep + 1
    return np.minimum.reduceat(common, edges)[0::2]


def _refined(group: np.ndarray, symbols: np.ndarray, order: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step to the left: the interleave redistributed by (group, preceding symbol), stably, and the new common prefixes."""
    own = group[order] * 257 + symbols[order]
    moved = np.argsort(own, kind="stable")
    key = own[moved]
    edges = np.empty(2 * len(moved), dtype=np.int64)
    edges[0] = 0
    edges[2::2] = moved[:-1] + 1
    edges[1::2] = moved + 1
    if len(moved) > 1:
        wrong = edges[0::2] >= edges[1::2]
        wrong[0] = True
        edges[0::2][wrong] = edges[1::2][wrong] - 1
    else:
        edges[0] = 0
    least = np.minimum.reduceat(common, edges)[0::2]
    out = np.empty(len(moved) + 1, dtype=np.int64)
    same = np.zeros(len(moved), dtype=bool)
    same[1:] = (key[1:] == key[:-1]) & (key[1:] % 257 > 0)
    border = np.ones(len(moved), dtype=bool)
    border[1:] = key[1:] // 257 != key[:-1] // 257
    out[:-1] = np.where(border, -1, np.where(same, least + 1, 0))
    out[-1] = -1
    return order[moved], out


def _matrix(texts: list[bytes], span: int, flush_right: bool) -> np.ndarray:
    """Symbols (byte + 1; 0 beyond the text) by column."""
    pad = (lambda t: t.rjust(span, b"\0")) if flush_right else (lambda t: t.ljust(span, b"\0"))
    if not span:
        return np.zeros((0, len(texts)), dtype=np.int16)
    out = np.frombuffer(b"".join(map(pad, texts)), dtype=np.uint8).reshape(len(texts), span).astype(np.int16) + 1
    sizes = np.array([len(t) for t in texts])
    lane = np.arange(span)
    out[(lane < span - sizes[:, None]) if flush_right else (lane >= sizes[:, None])] = 0
    return np.ascontiguousarray(out.T)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts sorted by core: the range of repeated strings of each."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        core = table.column("core").to_numpy()
        span = table.column("span").to_numpy()
        group = np.concatenate([[0], np.cumsum(core[1:] != core[:-1])]) if len(core) else np.empty(0, np.int64)
        left, right = table.column("left").to_pylist(), table.column("right").to_pylist()
        low, high = np.full(len(core), -1), np.full(len(core), -1)
        for s in np.unique(span).tolist():
            own = np.flatnonzero(span == s)
            low[own], high[own] = repeats(group[own], [left[i] for i in own], [right[i] for i in own], s)
        x0 = table.column("x0").to_numpy()
        some = low >= 0
        return pa.RecordBatch.from_arrays(
            [table.column("core0").combine_chunks().filter(pa.array(some)), table.column("un0").combine_chunks().filter(pa.array(some)),
             pa.array((low + x0)[some].astype(np.int32)), pa.array((high + x0)[some].astype(np.int32))],
            ["core0", "un0", "low", "high"],
        )

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= 1 << 13:
            table = pa.Table.from_batches(held)
            core = table.column("core").to_numpy()
            cut = int(np.flatnonzero(core != core[-1])[-1]) + 1 if (core != core[-1]).any() else 0
            if cut:
                yield settle(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            size = table.num_rows - cut
    if held:
        yield settle(pa.Table.from_batches(held))


def settled(contexts: DataFrame, bucket: int) -> DataFrame:
    """core0, un0, low, high: the repeated strings of contexts that the same core surrounds differently.

    ``contexts`` hold one row per core and surroundings; ``n`` above 1 marks those that are settled and only compared with.
    """
    result = None
    waiting = contexts
    while True:
        kinds = waiting.groupBy("core", "un").agg(F.sum("n").alias("together"), F.min(F.struct("core0", "un0")).alias("first"))
        cores = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("together") == 1).alias("single"))
        joined = cut_lineage(waiting.join(kinds, ["core", "un"]).join(cores, "core"))
        alone = F.col("together") == 1
        # equal surroundings repeat as a whole: every string of the range that lies within the text
        whole = joined.filter(~alone & (F.col("n") == 1)).select(
            "core0", "un0",
            (F.col("x0") + F.greatest(F.lit(0), F.col("span") - F.length("right"))).cast("int").alias("low"),
            (F.col("x0") + F.least(F.col("span"), F.length("left"))).cast("int").alias("high"),
        )
        # one row stands for equal surroundings
        mixed = joined.filter((F.col("kinds") > 1) & (F.col("single") > 0) & (alone | (F.struct("core0", "un0") == F.col("first"))))
        mixed = mixed.withColumn("n", F.col("together"))
        columns = [c.split()[0] for c in CONTEXT.split(", ")]
        small = mixed.filter(F.col("kinds") <= bucket).select(*columns)
        parts = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        merged = small.repartition(parts, "core").sortWithinPartitions("core").mapInArrow(_merged, "core0 long, un0 long, low int, high int")
        found = whole.unionByName(merged)
        result = found if result is None else result.unionByName(found)
        large = mixed.filter((F.col("kinds") > bucket) & (F.col("span") > 0)).select(*columns)
        waiting = cut_lineage(large.mapInArrow(_cut(PARTS), CONTEXT))
        if waiting.isEmpty():
            return result.groupBy("core0", "un0").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _removed(length: int):
    """doc_id, dk, n_bytes, spans and kept digest from the repeated strings of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(length)
        for batch in batches:
            sizes, spans, digests = [], [], []
            for text, hits in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist()):
                raw = text.encode()
                n = len(raw)
                runs: list[list[int]] = []
                for h in sorted(hits or (), key=lambda h: h["at"]):
                    lo, hi = both[h["at"] & 1]
                    a = h["at"] >> 1
                    few, many = max(lo + h["low"], a + length - n), min(lo + h["high"], a, hi)
                    runs.append([a - many, a - few + length])
                merged: list[list[int]] = []
                for start, end in sorted(runs):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                kept, last = hashlib.sha256(), 0
                for start, end in merged:
                    kept.update(raw[last:start])
                    last = end
                kept.update(raw[last:])
                sizes.append(n)
                spans.append([{"start": s, "end": e} for s, e in merged])
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("dk"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(digests, pa.string())],
                ["doc_id", "dk", "n_bytes", "removed", "kept_sha256"],
            )

    return run


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text (nulls empty) and dk, the key that equal rows share."""
    rows = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("dk", row_key(F.col("doc_id"), F.col("text")))


def repeated_spans(docs: DataFrame, length: int = LENGTH, bucket: int = BUCKET, text: str = "text") -> DataFrame:
    """doc_id, dk (see ``keyed``), n_bytes, removed (byte spans, end exclusive) and kept_sha256 of every document."""
    context = docs.sparkSession.sparkContext
    rows = keyed(docs, text)
    found = cut_lineage(rows.select("dk", "text").mapInArrow(_found(length), "core long, un long, dk long, at long"))
    twice = found.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("core")
    again = cut_lineage(found.join(twice, "core", "left_semi"))

    kinds = cut_lineage(again.groupBy("core", "un").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("dk", "at")).alias("place")))
    cores = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
    mixed = cut_lineage(kinds.join(cores.filter("kinds > 1 and single > 0"), "core").select("core", "un", "n", "place.*"))
    wants = mixed.groupBy("dk").agg(F.collect_list(F.struct("core", "un", "n", "at")).alias("wants"))
    marks = context.broadcast(bitmap_of(mixed.select(spot_of("dk").alias("spot")), BITMAP_BITS))
    near = rows.select("dk", "text").mapInArrow(_marked(marks, True), "dk long, text string").dropDuplicates(["dk"])
    contexts = cut_lineage(near.join(wants, "dk").mapInArrow(_contexts(length), CONTEXT))

    ranges = cut_lineage(settled(contexts, bucket)).withColumnsRenamed({"core0": "core", "un0": "un"})
    whole = kinds.filter("n > 1").select("core", "un", F.lit(0).alias("low"), F.lit(length).alias("high"))
    both = whole.unionByName(ranges.join(whole.select("core", "un"), ["core", "un"], "left_anti"))
    hits = cut_lineage(again.join(both, ["core", "un"]).groupBy("dk").agg(F.collect_set(F.struct("at", "low", "high")).alias("hits")))

    marks = context.broadcast(bitmap_of(hits.select(spot_of("dk").alias("spot")), BITMAP_BITS))
    kind = rows.schema["doc_id"].dataType.simpleString()
    layout = f"doc_id {kind}, dk long, text string"
    here = rows.select("doc_id", "dk", "text")
    none = F.lit(None).cast(hits.schema["hits"].dataType).alias("hits")
    apart = here.mapInArrow(_marked(marks, False), layout).select("doc_id", "dk", "text", none)
    moved = here.mapInArrow(_marked(marks, True), layout).join(hits, "dk", "left").select("doc_id", "dk", "text", "hits")
    out = f"doc_id {kind}, dk long, n_bytes long, removed array<struct<start:long,end:long>>, kept_sha256 string"
    return apart.mapInArrow(_removed(length), out).unionByName(moved.mapInArrow(_removed(length), out))
