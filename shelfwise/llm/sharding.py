"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 65,536 cells. Every shard owns ``replicas`` virtual nodes; the cells up to a virtual node form its arc, and
an arc prefers the distinct shards met clockwise from its node. A row's key falls into a cell by its hash. Shards have
capacities; all keys call on the shard of their arc, and those a full shard can't take (the last ones in ring order)
walk on clockwise, hop by hop, until a shard has room. With ``slack`` 0 the capacities add up to the row count, so counts
differ by one at most; with a larger slack fewer keys leave their home.

Who goes where depends only on how many keys each arc has: that table has at most shards * replicas rows, whatever the
input, and the walk is worked out on it. Rows then find their place by their rank in ring order: one range partitioning
of narrow rows, numbered inside partitions and shifted by the partitions' sizes. No shard, arc or key group ever meets in
one task, so a shard of a third of all rows is as spread as any other.

Defined results: a null key is a key of its own; rows with equal keys are ordered by size and checksum and may be split
between shards like any others; an empty table gives no rows; input columns named like added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise.operators.keys import dense_order

CELLS = 1 << 16
REPLICAS = 64
RUNS = 4096
ADDED = ("shard", "slot", "hops")


def ring_order(key: Column) -> Column:
    return F.xxhash64(key.isNull(), key)


def cell_of(order: Column) -> Column:
    return F.shiftrightunsigned(order, 48).cast("int")


def ring_nodes(spark: SparkSession, shards: int, replicas: int) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes clockwise; a cell claimed twice goes to the lower shard."""
    nodes = spark.range(shards * replicas).select(
        cell_of(F.xxhash64(F.lit("node"), F.col("id") % shards, F.floor(F.col("id") / shards))).alias("cell"),
        (F.col("id") % shards).cast("int").alias("shard"),
    )
    return sorted((r.cell, r.shard) for r in nodes.groupBy("cell").agg(F.min("shard").alias("shard")).collect())


def preferences(nodes: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """Distinct shards clockwise from each node; shards whose nodes all lost their cells come last."""
    out = []
    for i in range(len(nodes)):
        seen = dict.fromkeys(s for _, s in nodes[i:] + nodes[:i])
        out.append([*seen, *[s for s in range(shards) if s not in seen]])
    return out


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Rows each shard may take: an equal share, the first ones one more; with slack, that much above the mean for all."""
    if slack:
        return [int(-(-total * (1 + slack) // shards))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def placements(counts: list[int], prefs: list[list[int]], room: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, shard, keys, hops): how many keys of each arc, in ring order, stay at each shard they reach."""
    left, room, out = list(counts), list(room), []
    for hop in range(len(room)):
        for arc, shards in enumerate(prefs):
            taken = min(left[arc], room[shards[hop]])
            if taken:
                out.append((arc, shards[hop], taken, hop))
                left[arc] -= taken
                room[shards[hop]] -= taken
    return out


def assign(rows: DataFrame, key: Column, shards: int, tie: list[Column], replicas: int = REPLICAS, slack: float = 0.0) -> DataFrame:
    """Add ``shard``, ``slot`` (gapless from 0 within the shard) and ``hops`` (0: the key's home) to narrow ``rows``."""
    spark = rows.sparkSession
    if not 0 < shards * replicas <= CELLS:
        raise ValueError("between 1 and 65,536 virtual nodes are needed")
    base = rows.select([c for c in rows.columns if c not in ADDED]).withColumn("__ring", ring_order(key))
    # unsigned order of the hash: by cell, then by the remaining bits
    placed = [cell_of(F.col("__ring")), F.col("__ring").bitwiseAND(F.lit((1 << 48) - 1)), *tie]
    ranked = dense_order(base, placed, "__rank")

    nodes = ring_nodes(spark, shards, replicas)
    ends = [cell for cell, _ in nodes]
    # cells after the last node belong to the first one, as an arc of their own at the end of the rank order
    arcs = [*range(len(nodes)), 0]
    bounds = F.array(*[F.lit(e) for e in ends])
    per_cell = ranked.groupBy(cell_of(F.col("__ring")).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    arc = F.size(F.filter(bounds, lambda e: e < F.col("cell")))
    per_arc = {r.arc: r.n for r in per_cell.groupBy(arc.alias("arc")).agg(F.sum("n").alias("n")).collect()}
    counts = [per_arc.get(i, 0) for i in range(len(arcs))]
    prefs = preferences(nodes, shards)
    plan = placements(counts, [prefs[a] for a in arcs], capacities(sum(counts), shards, slack))

    start, filled, chunks = [0], [0] * shards, []
    for n in counts:
        start.append(start[-1] + n)
    used = [0] * len(arcs)
    for a, shard, n, hop in sorted(plan, key=lambda p: (p[0], p[3])):
        first = start[a] + used[a]
        chunks.append((first, first + n, shard, filled[shard] - first, hop))
        used[a] += n
        filled[shard] += n
    # each chunk is a run of ranks; runs are cut at cells of the rank line so that a row finds its run by equality
    step = max(1, -(-sum(counts) // RUNS))
    cut = [(c, *x) for x in chunks for c in range(x[0] // step, (x[1] - 1) // step + 1)]
    table = spark.createDataFrame(cut, "__cut long, __from long, __to long, shard int, __shift long, hops int")
    rank = F.col("__rank") - 1
    found = ranked.withColumn("__cut", F.floor(rank / step)).join(F.broadcast(table), "__cut").filter(
        (rank >= F.col("__from")) & (rank < F.col("__to"))
    )
    return found.withColumn("slot", rank + F.col("__shift")).drop("__cut", "__from", "__to", "__shift", "__rank", "__ring")


def shard_documents(docs: DataFrame, shards: int = 8, replicas: int = REPLICAS, slack: float = 0.0) -> DataFrame:
    """doc_id, size (text bytes plus 1), text_crc32, law, shard, slot, grown_shard, hops of every document.

    Tight capacities give the law ``rows``: counts differ by one at most. ``grown_shard`` belongs to the law ``key`` only
    and is null here.
    """
    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = assign(narrow, F.col("doc_id"), shards, [F.col("doc_id"), F.col("size"), F.col("text_crc32")], replicas, slack)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hops"
    )
