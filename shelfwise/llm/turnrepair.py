"""Repair of conversations: the cheapest edits that give turns of a system, then user and assistant in exchange.

Rows of a conversation are kept (free), given the role the place needs (1), deleted (2), or empty turns are put between them (5); a
blank or repeated row must go, and a truncated one that stays costs 5 more. Allowed are the role initials ``(s?(ua)+)?``.
Of the cheapest edits those whose audit (initials D, I, K, R in order) comes first in ASCII are taken.

A place in a conversation is a node: a row and one of four states (nothing yet, after system, user, assistant). A cost
DP from the end gives each node its cost to go, and the arcs that keep it are the optimal ones; arcs out of a node
have different initials. Optimal arcs are ranked by their first initial, then by prefix doubling: an arc's rank over
2^(k+1) initials is the rank of its pair of ranks over 2^k, its own and that of the arc its pointer names, and
pointers double with them. The arc of least rank out of the first node begins the least path, whose t-th arc
is reached over the doubled pointers of the bits of t.

No conversation is ever in one task. Equal rows of a conversation (same turn, role and text) are one row with a count before
anything is sorted. Rows are numbered over a range partitioning and cut into slices of ``SLICE`` rows that take one
byte a row; a slice works on all its conversations at once. Where a conversation crosses slices, its part of a slice is a
4 x 4 table of costs from state to state; these tables (a ``SLICE``-th of a conversation) are chained from the end to
get the cost to go behind every part, and then states are handed on from the first part to the last. Roles and texts do
not take part: edits find their rows by number.

Defined results: a null role or text is one space (a null text is blank); rows are in order of turn (nulls first), then role and
text; a null ``conv_id`` is a conversation; a role counts by its first character; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.operators.keys import dense_order, mark_repeats
from shelfwise.session import cut_lineage

SLICE = 1 << 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACES = " \t\n\x0b\x0c\r"
FAR = 1 << 40  # more than any cost that can be reached

_D, _I, _K, _R = range(4)  # initials in ASCII order
_LETTERS = np.frombuffer(b"DIKR", dtype=np.uint8)
_NONE, _SYSTEM, _USER, _ASSISTANT = range(4)
_AFTER = np.array([_USER, _USER, _ASSISTANT, _USER])  # what may come after each state by rerole or insert
_ROLE_BITS, _GONE, _CUT = 3, 4, 8  # a row's byte: initial (s, u, a, other), must go, truncated


def initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def conversation(conv_id: Column) -> Column:
    """Key of a conversation; null is one of its own."""
    return F.when(conv_id.isNull(), "").otherwise(F.concat(F.lit("="), conv_id.cast("string")))


def _steps(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost and next state of keep, by row and state (``FAR`` where not allowed); rerole has keep's cost of a truncated row and 1."""
    role = code & _ROLE_BITS
    fits = np.zeros((4, 4), dtype=bool)  # initial by state
    fits[0, _NONE] = True
    fits[1, [_NONE, _SYSTEM, _ASSISTANT]] = True
    fits[2, _USER] = True
    stay = np.where(code & _GONE, FAR, np.where(code & _CUT, TRUNCATED, 0)).astype(np.int64)
    return np.where(fits[role], stay[:, None] + KEEP, FAR), stay + REROLE


def _inserted(cost: np.ndarray) -> np.ndarray:
    """Costs of the four states (second axis) once inserts may come first."""
    user = np.minimum(cost[:, _USER], cost[:, _ASSISTANT] + INSERT)
    assistant = np.minimum(cost[:, _ASSISTANT], cost[:, _USER] + INSERT)
    out = np.minimum(cost, user[:, None] + INSERT)
    out[:, _USER], out[:, _ASSISTANT] = user, assistant
    return out


END = np.array([0, FAR, FAR, 0], dtype=np.int64)  # a conversation may end after nothing or an assistant


class Slice:
    """Rows of a slice and its parts of conversations: ``starts`` holds where each begins, and the number of rows."""

    def __init__(self, code: np.ndarray, starts: np.ndarray):
        self.code, self.starts = code, starts
        self.size = np.diff(starts)
        self.keep, self.rerole = _steps(code)
        self.into = np.array([_SYSTEM, _USER, _ASSISTANT, _NONE])[code & _ROLE_BITS]

    def to_go(self, end: np.ndarray) -> np.ndarray:
        """Cost to go before each row by state; ``end`` is the same behind each part (parts, states, tables)."""
        out = np.empty((len(self.code), *end.shape[1:]), dtype=np.int64)
        order = np.argsort(-self.size, kind="stable")
        live = np.searchsorted(-self.size[order], -np.arange(1, self.size.max(initial=0) + 1), side="right")
        now = end[order].copy()
        for step, n in enumerate(live):  # all parts that still have a row, from their last one backwards
            row = self.starts[order[:n]] + self.size[order[:n]] - 1 - step
            after, keep, into = now[:n], self.keep[row], self.into[row]
            kept = np.take_along_axis(after, into.reshape(n, *[1] * (after.ndim - 1)), axis=1)
            wide = (n, 4, *[1] * (after.ndim - 2))
            best = np.minimum(after + DELETE, keep.reshape(wide) + kept)
            best = np.minimum(best, self.rerole[row].reshape(n, *[1] * (after.ndim - 1)) + after[:, _AFTER])
            now[:n] = out[row] = np.minimum(_inserted(best), FAR)
        return out

    def tables(self) -> np.ndarray:
        """Costs from state (before the part) to state (behind it) of each part."""
        unit = np.full((len(self.size), 4, 4), FAR, dtype=np.int64)
        unit[:, np.arange(4), np.arange(4)] = 0
        return self.to_go(unit)[self.starts[:-1]]

    def arcs(self, end: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """Optimal arcs: node they leave, initial, node they reach, and where each node's arcs begin; the number of inner nodes.

        Nodes are numbered row by row and state by state, then the places behind the parts. Behind a conversation's last row inserts may
        still come; behind other parts a node is left to the next slice.
        """
        n, parts = len(self.code), len(self.size)
        part = np.repeat(np.arange(parts), self.size)
        cost = np.concatenate([self.to_go(end), end])
        state = np.tile(np.arange(4), n + parts)
        flat = cost.reshape(-1)
        node = np.arange(4 * (n + parts))
        row = node[: 4 * n] // 4
        closing = np.zeros(n, dtype=bool)
        closing[self.starts[1:] - 1] = True
        behind = np.where(closing[row], n + part[row], row + 1) * 4
        here = state[: 4 * n]
        found = []

        def add(letter: int, leave: np.ndarray, reach: np.ndarray, price: np.ndarray) -> None:
            ok = (price + flat[reach] == flat[leave]) & (flat[leave] < FAR)
            found.append((leave[ok], np.full(int(ok.sum()), letter), reach[ok]))

        inner = node[: 4 * n]
        add(_D, inner, behind + here, np.full(4 * n, DELETE))
        free = np.concatenate([np.ones(4 * n, dtype=bool), np.repeat(last, 4)])
        add(_I, node[free], node[free] - state[free] + _AFTER[state[free]], np.full(int(free.sum()), INSERT))
        add(_K, inner, behind + self.into[row], self.keep.reshape(-1))
        add(_R, inner, behind + _AFTER[here], np.repeat(self.rerole, 4))
        leave, letter, reach = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((letter, leave))
        leave, letter, reach = leave[order], letter[order], reach[order]
        return leave, letter, reach, np.searchsorted(leave, np.arange(len(node) + 1)), 4 * n

    def paths(self, end: np.ndarray, last: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, ...]:
        """Least paths from ``states`` (a state before each part): path of each arc, its node, initial and next node, in order of path."""
        leave, letter, reach, begin, inner = self.arcs(end, last)
        closing = len(leave)  # one arc more, before all others in rank, that leads to itself: the end
        letter = np.concatenate([letter, [_D]])
        rank = np.concatenate([letter[:-1] + 1, [0]])
        none = begin[reach] == begin[reach + 1]

        def least(node: np.ndarray) -> np.ndarray:
            """The arc of least rank out of each node."""
            out = np.full(len(node), closing)
            for k in range(4):
                arc = begin[node] + k
                held = arc < begin[node + 1]
                arc = np.where(held, arc, closing)
                better = held & ((out == closing) | (rank[arc] < rank[out]))
                out = np.where(better, arc, out)
            return out

        pointers = [np.concatenate([np.where(none, closing, least(reach)), [closing]])]
        while (pointers[-1] != closing).any():
            to = pointers[-1]
            pair = rank * (rank.max() + 1) + rank[to]
            rank = np.unique(pair, return_inverse=True)[1]
            pointers.append(to[to])
        first = least(self.starts[:-1] * 4 + states)
        length = np.zeros(len(first), dtype=np.int64)
        at = first.copy()
        for bit in range(len(pointers) - 1, -1, -1):  # arcs of each path: the longest way that does not reach the end
            further = pointers[bit][at] != closing
            length += further * (1 << bit)
            at = np.where(further, pointers[bit][at], at)
        length += first != closing
        path = np.repeat(np.arange(len(first)), length)
        turn = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        arc = first[path]
        for bit, to in enumerate(pointers):
            arc = np.where(turn >> bit & 1, to[arc], arc)
        return path, leave[arc], letter[arc], reach[arc]


def with_codes(rows: DataFrame) -> DataFrame:
    """conv, conv_id, turn, role, text and n of the distinct rows of each conversation, with ``again``, ``blank``, ``truncated`` and ``pos``.

    ``rows``: conv_id, turn, role, text.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    keyed = rows.select(conversation(F.col("conv_id")).alias("conv"), "conv_id", "turn", space("role"), space("text"))
    distinct = keyed.groupBy("conv", "conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    numbered = dense_order(distinct, [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()], "pos")
    numbered = mark_repeats(cut_lineage(numbered.withColumn("pos", F.col("pos") - 1)), F.struct("conv", "role", "text"), ["pos"], "again")
    seen = F.rtrim(F.col("text"), F.lit(SPACES))
    return numbered.withColumn("blank", seen == "").withColumn("truncated", ~F.substring(seen, -1, 1).isin(".", "!", "?"))


def packed(rows: DataFrame, rows_each: int) -> DataFrame:
    """slice, codes (a byte a row), starts of its parts, and the conversations of its first and last part."""
    role = F.when(initial(F.col("role")) == "s", 0).when(initial(F.col("role")) == "u", 1).when(initial(F.col("role")) == "a", 2).otherwise(3)
    gone = F.col("blank") | F.col("again")
    code = role + F.when(gone, _GONE).otherwise(0) + F.when(F.col("truncated"), _CUT).otherwise(0)
    narrow = rows.select(F.floor(F.col("pos") / rows_each).alias("slice"), "pos", code.cast("int").alias("code"), "conv")
    return narrow.groupBy("slice").applyInArrow(_packed, "slice long, codes binary, starts array<int>, conv_first string, conv_last string")


def _packed(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("pos").combine_chunks()
    conv = rows.column("conv")
    starts = np.concatenate([[0], np.flatnonzero(pc.not_equal(conv[1:], conv[:-1]).to_numpy()) + 1])
    codes = rows.column("code").to_numpy().astype(np.uint8)
    return pa.table({
        "slice": rows.column("slice")[:1], "codes": pa.array([codes.tobytes()], pa.binary()), "starts": pa.array([starts], pa.list_(pa.int32())), "conv_first": conv[:1], "conv_last": conv[-1:],
    })


def _slice_of(record: dict) -> Slice:
    codes = np.frombuffer(record["codes"], dtype=np.uint8)
    return Slice(codes, np.array([*record["starts"], len(codes)], dtype=np.int64))


def _edge_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost tables of the parts that may go on in another slice: the first and the last."""
    for batch in batches:
        for record in batch.to_pylist():
            tables = _slice_of(record).tables()
            ends = [(0, "conv_first")] if len(tables) == 1 else [(0, "conv_first"), (len(tables) - 1, "conv_last")]
            yield pa.RecordBatch.from_pylist(
                [{"slice": record["slice"], "part": part, "conv": record[name], "table": tables[part].ravel().tolist()} for part, name in ends],
                pa.schema([("slice", pa.int64()), ("part", pa.int32()), ("conv", pa.string()), ("table", pa.list_(pa.int64()))]),
            )


def _chained_costs(group: pa.Table) -> pa.Table:
    """Cost to go behind each part of one conversation that crosses slices."""
    group = group.sort_by("slice")
    now, out = _inserted(END[None])[0], []
    for table in reversed(group.column("table").to_pylist()):
        out.append(now.tolist())
        now = np.minimum((np.array(table).reshape(4, 4) + now).min(axis=1), FAR)
    ends = pa.array(out[::-1], pa.list_(pa.int64()))
    last = pa.array([False] * (len(out) - 1) + [True])
    return group.select(["slice", "part"]).append_column("end", ends).append_column("closes", last)


def _chained_states(group: pa.Table) -> pa.Table:
    """State before each part of one conversation that crosses slices."""
    group = group.sort_by("slice")
    now, out = _NONE, []
    for exits in group.column("exits").to_pylist():
        out.append(now)
        now = exits[now]
    return group.select(["slice", "part"]).append_column("state", pa.array(out, pa.int32()))


def _borders(record: dict, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost to go behind each part, whether its conversation ends there, and the state before it."""
    end, last, state = np.repeat(_inserted(END[None]), parts, axis=0), np.ones(parts, dtype=bool), np.full(parts, _NONE)
    for edge in record["edges"] or []:
        end[edge["part"]], last[edge["part"]] = edge["end"], edge["closes"]
        state[edge["part"]] = edge.get("state") or 0
    return end, last, state


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State behind each crossing part for each of the four states before it."""
    schema = pa.schema([("slice", pa.int64()), ("part", pa.int32()), ("conv", pa.string()), ("exits", pa.list_(pa.int32()))])
    for batch in batches:
        for record in batch.to_pylist():
            own = _slice_of(record)
            end, last, _ = _borders(record, len(own.size))
            exits = np.zeros((len(own.size), 4), dtype=np.int64)
            for state in range(4):
                path, _, _, reach = own.paths(end, last, np.full(len(own.size), state))
                exits[path, state] = reach % 4  # the last arc of a path is written last
            conv = lambda part: record["conv_first"] if part == 0 else record["conv_last"]  # noqa: E731, B023
            yield pa.RecordBatch.from_pylist([{"slice": record["slice"], "part": e["part"], "conv": conv(e["part"]), "exits": exits[e["part"]].tolist()} for e in record["edges"]], schema)


def _edits(rows_each: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Edits of each row: inserts before it, its own initial, its role after a rerole, and inserts behind it."""
        names = np.array(["", "s", "u", "a"], dtype=object)
        for batch in batches:
            for record in batch.to_pylist():
                own = _slice_of(record)
                path, node, letter, reach = own.paths(*_borders(record, len(own.size)))
                n = len(own.code)
                lead, tail, act, role = (np.full(n, "", dtype=object) for _ in range(4))
                added, inner = letter == _I, node < 4 * n
                for i in np.flatnonzero(added & inner):
                    lead[node[i] // 4] += names[reach[i] % 4]
                for i in np.flatnonzero(added & ~inner):
                    tail[own.starts[path[i] + 1] - 1] += names[reach[i] % 4]
                row = node[~added] // 4
                act[row] = np.array(list("DIKR"), dtype=object)[letter[~added]]
                moved = letter[~added] == _R
                role[row[moved]] = names[reach[~added][moved] % 4]
                pos = record["slice"] * rows_each + np.arange(n)
                yield pa.RecordBatch.from_arrays([pa.array(pos), *[pa.array(x, pa.string()) for x in (lead, act, role, tail)]], ["pos", "lead", "act", "new_role", "tail"])

    return run


def edits(rows: DataFrame, rows_each: int = SLICE) -> DataFrame:
    """pos, lead, act, new_role and tail of each row of ``with_codes``: role initials of the turns put before and behind it, the
    initial of its own edit, and the initial of the role it is given."""
    slices = cut_lineage(packed(rows, rows_each))
    parts = slices.mapInArrow(_edge_tables, "slice long, part int, conv string, table array<long>")
    several = parts.groupBy("conv").agg(F.min("slice").alias("low"), F.max("slice").alias("high")).filter("low < high")
    crossing = parts.join(several.select("conv"), "conv", "left_semi")
    costs = cut_lineage(crossing.groupBy("conv").applyInArrow(_chained_costs, "slice long, part int, end array<long>, closes boolean"))

    def joined(edges: DataFrame, fields: list[Column], how: str) -> DataFrame:
        each = edges.groupBy("slice").agg(F.collect_list(F.struct("part", *fields)).alias("edges"))  # two at most
        return slices.join(each, "slice", how)

    bare = [F.col("end"), F.col("closes")]
    exits = joined(costs, bare, "inner").mapInArrow(_exits, "slice long, part int, conv string, exits array<int>")
    states = exits.groupBy("conv").applyInArrow(_chained_states, "slice long, part int, state int")
    known = joined(cut_lineage(costs.join(states, ["slice", "part"])), [*bare, F.col("state")], "left")
    return known.mapInArrow(_edits(rows_each), "pos long, lead string, act string, new_role string, tail string")


def repair(rows: DataFrame, rows_each: int = SLICE) -> DataFrame:
    """Distinct rows in order with their edits: conv_id, turn, role, text, n, blank, again, truncated, pos, lead, act, new_role, tail.

    Of ``n`` equal rows the first has the edit ``act`` and the others go. ``turns`` gives the repaired turns, ``audits`` the
    figures of each conversation.
    """
    coded = cut_lineage(with_codes(rows))
    return coded.join(edits(coded, rows_each), "pos")


def _named(letter: Column, kept: Column | None = None) -> Column:
    named = F.when(letter == "u", "user").when(letter == "a", "assistant")
    return named if kept is None else F.coalesce(named, kept)


def turns(repaired: DataFrame) -> DataFrame:
    """conv_id, pos, part, role and text of the turns after repair, in order of pos and part."""
    empty = F.lit("")
    added = lambda c: F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.struct(_named(x).alias("role"), empty.alias("text")))
    own = F.when(F.col("act") == "D", F.array().cast("array<struct<role:string,text:string>>")).otherwise(F.array(F.struct(_named(F.col("new_role"), F.col("role")).alias("role"), "text")))
    return repaired.select("conv", "conv_id", "pos", F.posexplode(F.concat(added("lead"), own, added("tail"))).alias("part", "x")).select("conv", "conv_id", "pos", "part", "x.*")


def audits(repaired: DataFrame) -> DataFrame:
    """gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation with rows.

    The audit and the digest are one text of a whole conversation by their nature; all other figures are combined before they meet.
    """
    more = F.col("n") - 1
    gone = F.col("act") == "D"
    inserts = F.char_length("lead") + F.char_length("tail")
    cost = (
        F.when(gone, DELETE).otherwise(F.when(F.col("truncated"), TRUNCATED).otherwise(0)) + F.when(F.col("act") == "R", REROLE).otherwise(0) + more * DELETE + inserts * INSERT
    )
    runs = lambda text, times: F.expr(f"repeat('{text}', cast({times} as int))")
    letters = F.concat(runs("I", "char_length(lead)"), F.col("act"), runs("D", "n - 1"), runs("I", "char_length(tail)"))
    after = repaired.select("conv", (F.col("pos") - 1).alias("pos"), initial(F.col("role")).alias("next"))
    pairs = repaired.select("conv", "pos", initial(F.col("role")).alias("own")).join(after, ["conv", "pos"])
    broken = pairs.groupBy("conv").agg(F.count_if(~F.concat("own", "next").isin("su", "ua", "au")).alias("broken"))
    distinct = repaired.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg(F.count("turn").alias("turns"), F.min("turn").alias("low"), F.max("turn").alias("high"))
    sums = repaired.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("again"), F.col("n")).otherwise(more)).alias("duplicate"),
        F.count_if(~F.col("blank") & ~F.col("again") & F.col("truncated")).alias("truncated"),
        F.sum(more).alias("equal_pairs"),  # equal rows side by side are never a legal pair
        F.sum(cost).alias("cost"),
        F.array_sort(F.collect_list(F.struct("pos", letters.alias("x")))).alias("letters"),
    )
    lines = turns(repaired).groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "part", F.concat_ws(":", "role", "text").alias("x")))).alias("lines"))
    found = sums.join(distinct, "conv").join(broken, "conv", "left").join(lines, "conv", "left")
    text = F.array_join(F.transform(F.coalesce("lines", F.array().cast("array<struct<pos:bigint,part:int,x:string>>")), lambda r: r["x"]), "\n")
    gaps = F.when(F.col("turns") > 0, F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(0)
    return found.select(
        "conv", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated",
        (F.coalesce("broken", F.lit(0)) + F.col("equal_pairs")).cast("long").alias("illegal"), F.col("cost").cast("long").alias("cost"),
        F.array_join(F.transform("letters", lambda r: r["x"]), "").alias("audit"), F.sha2(text.cast("binary"), 256).alias("repaired_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """A seeded fifth of the rows damaged by the checksum of ``conv_id:turn``: dropped, emptied, without sentence marks, repeated, or as user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = (F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20).alias("kind")
    known = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return known.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair_damaged(conversations: DataFrame, rows_each: int = SLICE) -> DataFrame:
    """The figures of ``audits`` for every ``conv_id`` once its rows were damaged; zeros and empty texts where no row is left."""
    everyone = conversations.select(conversation(F.col("conv_id")).alias("conv"), "conv_id").distinct()
    found = audits(cut_lineage(repair(damaged(conversations.select("conv_id", "turn", "role", "text")), rows_each)))
    zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return everyone.join(found, "conv", "left").select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), digest)
