"""Conversation repair against a search over single edits, for whole and cut conversations."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from shelfwise.llm import turnrepair

AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """Edits of (role, text, gone, truncated) rows by the least (cost, audit)."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, audit, lines
        to = AFTER[state]
        heapq.heappush(heap, (cost + 5, audit + "I", at, to, (*lines, f"{NAMES[to]}:")))
        if at < len(rows):
            role, text, gone, truncated = rows[at]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, lines))
            if not gone:
                if role[:1] == to or (state == "" and role[:1] == "s"):
                    heapq.heappush(heap, (cost + 5 * truncated, audit + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 1 + 5 * truncated, audit + "R", at + 1, to, (*lines, f"{NAMES[to]}:{text}")))


def expected(table):
    out = []
    for conv in {r[0] for r in table}:
        rows = []
        for c, turn, role, text in table:
            kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if c == conv and kind:
                role, text = " " if role is None else role, " " if text is None else text
                role, text = "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
                rows += [(turn is not None, turn or 0, role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        faults, seen, marked = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), []
        for _, _, role, text in rows:
            shown = text.strip(" \t\n\x0b\x0c\r")
            cut = shown[-1:] not in (".", "!", "?") or not shown
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if cut else None
            seen.add((role, text))
            faults[fault] = faults.get(fault, 0) + 1
            marked.append((role, text, fault in ("blank", "duplicate"), cut))
        turns = {t for known, t, _, _ in rows if known}
        cost, audit, lines = cheapest(marked)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations():
    rng = random.Random(5)
    texts = ["a b.", "c d!", "cut", "", " \t", None, "e?", "f. ", "g. \n", "x" * 300_000 + "."]
    table = [(rng.choice([None, *range(40)]), rng.choice([None, *range(9)]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""]), rng.choice(texts)) for _ in range(500)]
    table += [(100, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(150)]  # one long conversation
    table += [(101, 3, "user", "same.")] * 60 + [(102, t, "user", "same.") for t in range(40)]
    dropped = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*table, (dropped, 0, "user", "gone.")]


@pytest.mark.parametrize("rows_each", [turnrepair.SLICE, 11])
def test_repairs_equal_the_search(spark, rows_each):
    table = conversations()
    frame = spark.createDataFrame([(*r, "clash", 1) for r in table], "conv_id long, turn long, role string, text string, conv string, pos int").repartition(3)
    got = sorted((tuple(r) for r in turnrepair.repair_damaged(frame, rows_each).collect()), key=repr)
    assert got == expected(table)


def test_repaired_turns_fit_and_empty_tables_pass(spark):
    frame = spark.createDataFrame([(1, 0, "assistant", "a."), (1, 1, "user", "b."), (2, 0, "system", "s."), (2, 1, "user", "u.")], "conv_id long, turn long, role string, text string")
    fixed = turnrepair.turns(turnrepair.repair(frame)).orderBy("conv", "pos", "part").collect()
    for conv in (1, 2):
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in fixed if r.conv_id == conv))
    assert turnrepair.repair_damaged(frame.limit(0)).count() == 0
