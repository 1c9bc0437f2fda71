"""Repair of conversations against a search over all edit sequences."""

import hashlib
import random
import zlib
from collections import defaultdict
from heapq import heappop, heappush

from doclake.llm.chat_repair import damaged, repair, repair_report

WHITE = "\x20\t\n\x0b\x0c\r"
GOOD = {"s0": 1, "u0": 2, "u1": 2, "a2": 3, "u3": 2}


def key(row):
    return (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode())


def cheapest(rows):
    """Dijkstra over (rows done, state), keyed by cost and then by the letters: ``rows`` hold (role, text, fault)."""
    queue, done = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, i, state, lines = heappop(queue)
        if i == len(rows) and state in (0, 3):
            return cost, audit, "\n".join(lines)
        if (i, state) in done:
            continue
        done.add((i, state))
        fill = "assistant" if state == 2 else "user"
        heappush(queue, (cost + 2, audit + "I", i, GOOD[fill[0] + str(state)], (*lines, f"{fill}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heappush(queue, (cost + 3, audit + "D", i + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                to = GOOD.get(role[:1] + str(state))
                if to is not None:
                    heappush(queue, (cost + late, audit + "K", i + 1, to, (*lines, f"{role}:{text}")))
                heappush(queue, (cost + 2 + late, audit + "R", i + 1, GOOD[fill[0] + str(state)], (*lines, f"{fill}:{text}")))


def brute(rows, harmful=True):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        harm = zlib.crc32(":".join(shown).encode()) % 20 if harmful else 9
        text = "" if harm == 1 else "".join(c for c in text if c not in ".!?") if harm == 2 else text
        role = "user" if harm == 4 else role
        convs[conv] += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    out = []
    for conv, own in convs.items():
        own.sort(key=key)
        seen, faults = set(), []
        for _, role, text in own:
            solid = text.strip(WHITE)
            faults.append(
                "blank" if not solid else "duplicate" if (role, text) in seen else None if solid[-1] in ".!?" else "truncated"
            )
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = cheapest([(r, t, f) for (_, r, t), f in zip(own, faults)])
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def told(turns, **how):
    return sorted((tuple(r) for r in repair_report(turns, **how).collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, conv string, cls int, ways string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 7, "w") for r in rows], SCHEMA)


def test_random_conversations(spark):
    rnd = random.Random(5)
    roles = ["system", "user", "assistant", "tool", "", "User", None]
    texts = ["Yes.", "No!", "Why? ", "cut off", "", " \t\n", None, "x.\x0b", "é…", "no "]
    rows = [
        (conv, rnd.choice([None, *range(9)]), rnd.choice(roles), rnd.choice(texts))
        for conv in [None, *range(400)] for _ in range(rnd.randrange(1, 9))
    ]
    assert told(frame(spark, rows)) == brute(rows)


def test_whole_table(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert told(turns) == brute(rows)


def test_giant_conversation_is_streamed_over_batches(spark):
    rnd = random.Random(6)
    rows = [(1, i, rnd.choice(["user", "assistant", "tool"]), rnd.choice(["So.", f"Part {i}.", f"cut {i}"])) for i in range(3000)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        assert told(frame(spark, rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Hello."), (1, 2, "user", ""), (2, 0, "user", "Long " * 200_000 + ".")]
    edits = repair(frame(spark, rows)).collect()
    lines = [(r.conv_id, r.edit, r.role, len(r.text)) for r in sorted(edits, key=lambda r: r.conv_id) if r.edit != "D"]
    assert lines == [
        (1, "R", "user", 3), (1, "K", "assistant", 6), (2, "K", "user", 1_000_001), (2, "I", "assistant", 0),
    ]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair(empty).count() == 0 and repair_report(empty).count() == 0 and damaged(empty).count() == 0
