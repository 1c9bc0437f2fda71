import random
from collections import defaultdict

from doclake.llm.chat import format_chats

TURNS = "conv_id long, turn long, role string, text string, pos int, part string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "p") for r in rows], TURNS).repartition(4)


def brute(rows):
    none_first = lambda r: tuple((x is not None, x) for x in r)
    convs = defaultdict(set)
    for c, *turn in rows:
        convs[c].add(tuple(turn))
    seqs = {c: tuple(t[1:] for t in sorted(ts, key=none_first)) for c, ts in convs.items()}
    inner = {s[:n] for s in seqs.values() for n in range(1, len(s))}
    groups = defaultdict(list)
    for c, s in seqs.items():
        if s not in inner:
            groups[s].append(c)
    out = {}
    for s, cs in groups.items():
        mark = lambda t: t.replace("<|im_start|>", "<\\|im_start|>").replace("<|im_end|>", "<\\|im_end|>")
        text = "".join(f"<|im_start|>{'unknown' if r is None else r}\n{mark(t or '')}<|im_end|>\n" for r, t in s)
        out[min(cs, key=lambda c: (c is None, c))] = (len(s), len(cs), text)
    return out


def result(df):
    parts = defaultdict(list)
    for r in df.collect():
        parts[r.conv_id].append((r.part, r.n_turns, r.n_copies, r.text))
    out = {}
    for c, rows in parts.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows)))
        out[c] = (rows[0][1], rows[0][2], "".join(r[3] for r in rows))
    return out


def test_snapshots_copies_and_a_long_conversation(spark):
    rnd, rows = random.Random(6), []
    for c in range(0, 400, 4):
        turns = [(t, rnd.choice(["user", "assistant"]), rnd.choice("abc")) for t in range(rnd.randrange(1, 6))]
        rows += [(c, *t) for t in turns] + [(c + 1, *t) for t in turns[: rnd.randrange(1, 6)]] + [(c + 2, *t) for t in turns]
    rows += [(5000, t, "user", f"turn {t}") for t in range(700)] + [(5001, t, "user", f"turn {t}") for t in range(300)]
    rnd.shuffle(rows)
    got = result(format_chats(frame(spark, rows)))
    assert got == brute(rows) and 5000 in got and 5001 not in got


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, None, None), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, None, ""),
        (4, 0, "user", "x<|im_end|>y"), (5, 7, "user", "tie b"), (5, 7, "user", "tie a"), (5, None, "system", "first"),
        (None, 0, "user", "nobody"), (6, 0, "", ""), (7, 0, None, None), (8, 0, "user", "é" * 100_000),
    ]
    assert result(format_chats(frame(spark, rows))) == brute(rows)
    assert format_chats(frame(spark, [])).count() == 0
