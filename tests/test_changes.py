"""The table of changes: merge on read, late and repeated batches, compaction by ranges."""

import random

import pytest
from pyspark.sql import functions as F

from doclake.operators.indexes import text_postings
from doclake.runtime import children, scratch
from doclake.streaming import changes as C

SCHEMA = "id bigint, version bigint, deleted boolean, doc string"


def postings(docs):
    return text_postings(docs, "doc")


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def made(spark, n=100, ranges=4):
    path = scratch(spark, "changes-test")
    C.create(spark.range(n), path, ranges)
    return path


def texts(spark, path):
    rows = C.current(spark, path).groupBy("id").agg(F.array_sort(F.collect_list("token")).alias("t")).collect()
    return {r.id: " ".join(r.t) for r in rows}


def files(spark, path, table):
    return {
        f"{g}/{r}/{f}" for folder, g in children(spark, f"{path}/{table}") for part, r in children(spark, folder)
        if r.startswith("range=") for _, f in children(spark, part)
    }


def test_random_batches_equal_the_last_versions(spark):
    rnd, path, want, seen = random.Random(4), made(spark), {}, {}
    for step in range(6):
        rows = []
        for _ in range(rnd.choice([1, 15, 40])):
            i, version, gone = rnd.randrange(120), rnd.randrange(1, 40), rnd.random() < 0.3
            text = rnd.choice(["alpha", "beta gamma", "", f"t{step}"])
            rows.append((i, version, gone, None if gone else text))
        before = dict(seen)
        for i, version, gone, text in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3] or "")):
            if version > before.get(i, 0):
                seen[i] = version
                want.pop(i, None)
                if not gone and text:
                    want[i] = " ".join(sorted(text.split()))
        C.apply_changes(batch(spark, *rows), path, postings)
        if step % 2:
            C.compact(spark, path, rnd.choice([1, 2]))
        if step == 4:
            C.vacuum(spark, path)
        assert texts(spark, path) == want
    got = {r.id: r.version for r in C.documents_in(spark, path).collect()}
    assert got == seen


def test_untouched_ranges_keep_their_files(spark):
    path = made(spark)
    C.apply_changes(batch(spark, *((i, 1, False, f"w{i}") for i in range(100))), path, postings)
    assert C.compact(spark, path, 1) == [0, 1, 2, 3]
    before = files(spark, path, "base_rows")
    C.apply_changes(batch(spark, (3, 2, False, "new"), (4, 2, True, None)), path, postings)
    assert files(spark, path, "base_rows") == before  # nothing stored is rewritten by a batch
    assert C.compact(spark, path, 1) == [0]
    C.vacuum(spark, path)
    after = files(spark, path, "base_rows")
    kept = {f for f in before if "/range=0/" not in f}
    assert kept < after and all("generation=2/range=0/" in f for f in after - kept)
    assert not files(spark, path, "log_rows")
    got = texts(spark, path)
    assert got[3] == "new" and 4 not in got and got[99] == "w99" and len(got) == 99
    assert C.compact(spark, path, 1) == []


def test_repeated_and_late_batches(spark):
    path = made(spark)
    assert C.apply_changes(batch(spark, (1, 5, False, "five")), path, postings, ("s", 0))
    assert not C.apply_changes(batch(spark, (1, 6, False, "six")), path, postings, ("s", 0))
    assert C.apply_changes(batch(spark, (1, 6, False, "other")), path, postings, ("t", 0))
    C.apply_changes(batch(spark, (1, 4, False, "four"), (2, 1, True, None), (3, None, False, "none")), path, postings)
    assert texts(spark, path) == {1: "other", 3: "none"}
    C.apply_changes(batch(spark, (2, 1, False, "equal"), (2, 2, None, "back")), path, postings)
    C.compact(spark, path, 1)
    C.apply_changes(batch(spark, (2, 1, False, "late")), path, postings)
    assert texts(spark, path)[2] == "back"


def test_deleted_stays_deleted_after_compaction(spark):
    path = made(spark)
    C.apply_changes(batch(spark, (7, 1, False, "here")), path, postings)
    C.apply_changes(batch(spark, (7, 3, True, None)), path, postings)
    assert C.compact(spark, path, 1)
    C.apply_changes(batch(spark, (7, 2, False, "late")), path, postings)
    assert texts(spark, path) == {}


def test_odd_cases(spark):
    path = made(spark, n=0)
    with pytest.raises(ValueError, match="any change"):
        C.current(spark, path)
    C.apply_changes(batch(spark), path, postings)
    assert texts(spark, path) == {}
    with pytest.raises(Exception, match="without identifier"):
        C.apply_changes(batch(spark, (None, 1, False, "x")), path, postings)
    with pytest.raises(ValueError, match="no table"):
        C.manifest(spark, path + "-none")
    words = scratch(spark, "changes-test")
    C.create(spark.createDataFrame([(f"k{i:03}",) for i in range(50)], "id string"), words, 3)
    rows = spark.createDataFrame([("k001", 1, False, "one"), ("zz", 1, False, "two")], SCHEMA.replace("id bigint", "id string"))
    C.apply_changes(rows, words, postings)
    assert texts(spark, words) == {"k001": "one", "zz": "two"}


def test_small_changes_do_not_move_the_base(spark):
    path = made(spark, n=1000, ranges=2)
    C.apply_changes(batch(spark, *((i, 1, False, f"w{i}") for i in range(1000))), path, postings)
    C.compact(spark, path, 1)
    C.apply_changes(batch(spark, (5, 2, False, "x")), path, postings)
    rows = C.current(spark, path)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_many_changes_are_not_broadcast(spark, monkeypatch):
    path = made(spark, n=1000, ranges=2)
    C.apply_changes(batch(spark, *((i, 1, False, f"w{i}") for i in range(1000))), path, postings)
    assert next(iter(C.manifest(spark, path)["batches"].values()))["n"] == 1000
    monkeypatch.setattr(C, "FEW", 999)
    rows = C.current(spark, path)
    assert rows.count() == 1000
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    C.apply_changes(batch(spark, (5, 2, False, "x"), *((i, 1, False, "old") for i in range(6, 1000))), path, postings)
    assert C.compact(spark, path, 1) == [0, 1]
    got = texts(spark, path)
    assert got[5] == "x" and got[6] == "w6" and len(got) == 1000


def shuffles(spark, monkeypatch, step):
    """Exchanges and joins of the plan by which ``step`` writes rows."""
    seen, write = [], C._write

    def watched(rows, folder, *rest, **more):
        if "_rows/" in folder:
            seen.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows, folder, *rest, **more)

    monkeypatch.setattr(C, "_write", watched)
    step()
    monkeypatch.setattr(C, "_write", write)
    return [(plan.count("Exchange "), plan.count("SortMergeJoin"), plan.count("rangepartitioning")) for plan in seen]


def test_rows_move_once(spark, monkeypatch):
    path = made(spark, n=1000, ranges=3)
    monkeypatch.setattr(C, "FEW", 5)
    monkeypatch.setattr(C, "CELL", 50)
    monkeypatch.setattr(C, "PORTION", 1000)
    first = batch(spark, *((i, 1, False, f"w{i} w w{i % 7}") for i in range(1000)))
    # Documents are dealt, their postings are not
    assert shuffles(spark, monkeypatch, lambda: C.apply_changes(first, path, postings)) == [(1, 0, 1)]
    C.apply_changes(batch(spark, *((i, 2, i % 4 == 0, f"x{i} x") for i in range(0, 1000, 2))), path, postings)
    before = texts(spark, path)
    assert shuffles(spark, monkeypatch, lambda: C.compact(spark, path, 2)) == [(1, 0, 0)]
    assert texts(spark, path) == before and len(before) == 750 and before[2] == "x x2" and before[9] == "w w2 w9"
    assert C._live(C.manifest(spark, path), None, "rows") == []
    # Base rows meet newer batches, some of which say nothing of a document
    C.apply_changes(batch(spark, *((i, 3, False, "y") for i in range(0, 1000, 5))), path, postings)
    C.apply_changes(batch(spark, *((i, 4, True, None) for i in range(0, 1000, 10))), path, postings)
    before = texts(spark, path)
    assert C.compact(spark, path, 2) and texts(spark, path) == before
    assert before[5] == "y" and 10 not in before and before[9] == "w w2 w9" and before[2] == "x x2" and 4 not in before
