"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from doclake.llm.runs import flagged, fragments, numbered, periodic_runs, planted, run_report, tiles, z_function


def all_runs(words):
    """Every (start, length, period), by trying all periods and leaving out multiples of smaller ones."""
    n, found = len(words), []
    w = np.array(numbered([x if isinstance(x, bytes) else str(x).encode() for x in words]))
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = e - s + q
            if length >= max(6, 4 * q) and not any(p < q and s >= a and s + length <= a + m for a, m, p in found):
                found.append((s, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def search(words, core):
    """The operator's own steps without Spark."""
    doc, pieces = numbered(words), []
    for _, size, at in flagged([doc]):
        for s, start, places, tile in tiles(doc, size, at, core):
            pieces += [(q, start + a, start + b) for q, a, b in fragments(s, places, tile)]
    out = []
    for q, a, b in sorted(pieces):
        if out and out[-1][0] == q and a <= out[-1][2] - q:
            out[-1][2] = max(out[-1][2], b)
        else:
            out.append([q, a, b])
    return sorted(((a, b - a, q) for q, a, b in out if b - a >= max(6, 4 * q)), key=lambda r: (r[0], r[2]))


def test_z_function():
    s = list(b"abaababaab")
    assert z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
    assert z_function([]) == []


blocks = st.lists(
    st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=9), st.integers(1, 14)), max_size=6
)


@settings(deadline=None, max_examples=400)
@given(blocks, st.sampled_from([1, 4, 16, 4096]))
def test_all_runs_of_small_alphabets(parts, core):
    words = [w for block, times in parts for w in block * times]
    assert search(words, core) == all_runs(words)


def test_long_periods_and_many_tiles():
    rnd = random.Random(3)
    for _ in range(60):
        words, n = [], 0
        for _ in range(rnd.randrange(1, 5)):
            block = [b"%d" % rnd.randrange(40) for _ in range(rnd.choice([1, 2, 7, 16, 33, 100, 255]))]
            times = rnd.uniform(1, 9)
            words += (block * 10)[: int(len(block) * times)]
        assert search(words, rnd.choice([8, 64, 4096])) == all_runs(words)


def brute(doc_id, text, harmful=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if harmful and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs([w.encode() for w in words])
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    text = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join("%d,%d,%d\n" % r for r in runs)
    return (doc_id, len(runs), *top, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, text)))


def reported(docs, **how):
    return sorted((tuple(r) for r in run_report(docs, **how).collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted((brute(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert reported(docs, prepare=planted) == want
    assert reported(docs.repartition(3), prepare=planted, core=16, chunk=700) == want


def test_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    assert reported(odd_docs) == sorted((brute(r.doc_id, r.text, False) for r in rows), key=repr)
    assert periodic_runs(no_docs).count() == 0


def test_very_long_and_all_equal(spark):
    line = " ".join(f"w{i}" for i in range(1000))
    texts = [("x " * 50_000, 1), ("start " + f"{line} " * 60 + "end", 2), (" \t\n", 3)]
    docs = spark.createDataFrame([(i, t) for t, i in texts], "doc_id long, text string")
    got = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(0, 50_000, 1)] and got[1].collapsed == "x"
    assert [tuple(x) for x in got[2].runs] == [(1, 60_000, 1000)] and got[2].collapsed == f"start {line} end"
    assert got[3].runs == [] and got[3].collapsed is None and got[3].n_words == 0
