import hashlib
import random

from pyspark.sql import functions as F

from doclake.llm.fixity import audit, leaves, tree, warc_records

RECORDS = "page_id long, file long, offset long, length long, digest string, hash int"


def replica(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], RECORDS)


def test_finds_exactly_what_was_harmed(spark):
    rnd = random.Random(9)
    good, at = [], 0
    for i in range(3000):
        size = rnd.randrange(1, 5000)
        good.append((i, at // 10**6, at % 10**6, size, hashlib.sha256(str(i).encode()).hexdigest()))
        at += size
    bad, want = [], {}
    for r in good:
        harm = rnd.randrange(150)
        if harm == 0:
            want[r[0]] = "missing"
        elif harm == 1:
            want[r[0]] = "changed"
            bad.append((*r[:4], "0" * 64))
        else:
            bad.append(r)
    bad.append((9999, 77, 5, 10, "f" * 64))
    want[9999] = "extra"
    found = audit(replica(spark, good), replica(spark, bad)).collect()
    assert {r.page_id: r.status for r in found} == want and len(found) == len(want)
    where = {r[0]: r[1:3] for r in good + bad}
    assert all((r.file, r.offset) == where[r.page_id] for r in found)


def test_equal_and_empty_replicas(spark):
    rows = [(1, 0, 0, 10, "a"), (2, 0, 10, 5, "b"), (2, 0, 10, 5, "b"), (None, 3, 0, 1, "c")]
    a, none = replica(spark, rows), replica(spark, [])
    assert audit(a, a).count() == 0 and audit(none, none).count() == 0
    assert {r.status for r in audit(a, none).collect()} == {"missing"} and audit(none, a).count() == 4


def test_root_by_hand(spark):
    rows = [(1, 0, 0, 10, "aa"), (2, 0, 10, 5, "bb"), (3, 0, 1 << 17, 5, "cc")]
    levels = tree(leaves(replica(spark, rows)), 1)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    low = {0: sha("0:10:aa|10:5:bb"), 2: sha(f"{1 << 17}:5:cc")}
    assert {r.node: r.hash for r in levels[0].collect()} == low
    assert [r.hash for r in levels[1].collect()] == [sha(f"0:{low[0]}|2:{low[2]}")]


def test_layout_and_odd_rows(spark):
    pages = spark.createDataFrame(
        [(2, "u", "<p>é</p>", 1), (1, None, None, 1), (None, "v", "", 1), (1, None, None, 1), (3, "w", "x" * 5000, 1)],
        "page_id long, url string, html string, offset int",
    )
    rows = sorted(warc_records(pages, file_bytes=1000).collect(), key=lambda r: (r.file, r.offset))
    assert [r.page_id for r in rows] == [None, 1, 1, 2, 3]
    at = 0
    for r in rows:
        assert (r.file, r.offset) == (at // 1000, at % 1000)
        at += r.length
    text = "WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:2>\r\nWARC-Target-URI: u\r\nContent-Type: text/html\r\nContent-Length: 9\r\n\r\n<p>é</p>\r\n\r\n"
    assert (rows[3].length, rows[3].digest) == (len(text.encode()), hashlib.sha256(text.encode()).hexdigest())
    assert warc_records(pages.filter(F.lit(False))).count() == 0
