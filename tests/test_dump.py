"""Dump folders: catalog, exact splitting whatever the bytes, cut files, samples."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from doclake.plans.chunks import chunk_plan, clamp_buffer_mb
from doclake.queries.fixtures import ObjectId, encode
from doclake.sources import dump as D


def record(n, rnd):
    kind = rnd.random()
    if kind < 0.2:  # a payload that itself looks like records
        payload = b"".join(encode({"fake": k, "s": "x" * rnd.randrange(9)}) for k in range(rnd.randrange(1, 30)))
        return encode({"_id": n, "blob": payload})
    if kind < 0.25:
        return encode({"_id": n, "big": "y" * rnd.randrange(2000, 9000)})
    if kind < 0.3:
        return encode({"_id": n, "zeros": bytes(rnd.randrange(400)), "tail": rnd.randbytes(rnd.randrange(60))})
    return encode({"_id": n, "sub": [{"a": 1, "b": "t"}] * rnd.randrange(4)})


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("dump")
    rnd = random.Random(5)
    plain = [record(n, rnd) for n in range(600)]
    (base / "plain.bson").write_bytes(b"".join(plain))
    (base / "plain.metadata.json").write_text('{"indexes":[{"name":"_id_","key":{"_id":1},"ns":"x"}]}')
    zipped = [encode({"_id": ObjectId(n.to_bytes(12, "big")), "v": n}) for n in range(300)]
    half = len(zipped) // 2
    (base / "zipped.bson.gz").write_bytes(gzip.compress(b"".join(zipped[:half])) + gzip.compress(b"".join(zipped[half:])))
    (base / "zipped.metadata.json.gz").write_bytes(gzip.compress(b'{"indexes":[]}'))
    (base / "both.bson").write_bytes(encode({"_id": 1}))
    (base / "both.bson.gz").write_bytes(gzip.compress(encode({"_id": 2})))
    (base / "empty.bson").write_bytes(b"")
    (base / "truncated.bson").write_bytes(b"".join(plain[:10]) + plain[10][:-3])
    (base / "cutgz.bson.gz").write_bytes(gzip.compress(plain[0] + plain[1][:-2]))
    (base / "bad.bson").write_bytes(encode({"_id": 1}) + b"\x0b\0\0\0\x42ab\0zz\0" + encode({"_id": 3}))
    (base / "UPPER.BSON").write_bytes(encode({"_id": 9}))
    (base / "a.b.bson").write_bytes(encode({"_id": 4}))
    (base / "other.txt").write_text("no")
    return base, [len(r) for r in plain]


def test_catalog(spark, folder):
    base, lengths = folder
    rows = {r["collection"]: r for r in D.dump_catalog(spark, str(base)).collect()}
    assert set(rows) == {"plain", "zipped", "both", "empty", "truncated", "cutgz", "bad", "UPPER", "a.b"}
    assert rows["plain"]["length"] == sum(lengths) and not rows["both"]["is_gz"] and rows["zipped"]["is_gz"]


def test_metadata(spark, folder):
    rows = {r["collection"]: r["indexes"] for r in D.dump_metadata(spark, str(folder[0])).collect()}
    assert [i["name"] for i in rows["plain"]] == ["_id_"]
    assert rows["zipped"] == [] and rows["both"] == [] and len(rows) == 9


@pytest.mark.parametrize("block_bytes", [97, 1000, 5003, 1 << 20])
def test_splitting_is_exact(spark, folder, block_bytes):
    base, lengths = folder
    got = D.bson_offsets(spark, str(base), block_bytes).filter(F.col("path").endswith("/plain.bson"))
    rows = sorted((r["offset"], r["length"]) for r in got.collect())
    at, want = 0, []
    for n in lengths:
        want.append((at, n))
        at += n
    assert rows == want


def test_read(spark, folder):
    rows = D.read_bson(spark, str(folder[0]), block_bytes=3000)
    per = {r["collection"]: (r["n"], r["bad"]) for r in rows.groupBy("collection").agg(
        F.count_if(F.col("doc").isNotNull()).alias("n"), F.count("error").alias("bad")).collect()}
    assert per == {
        "plain": (600, 0), "zipped": (300, 0), "both": (1, 0), "truncated": (10, 1), "cutgz": (1, 1),
        "bad": (2, 1), "UPPER": (1, 0), "a.b": (1, 0),
    }
    assert rows.filter("collection = 'both'").first()["id"] == "1"
    oid = rows.filter("collection = 'zipped'").agg(F.max("id"), F.max("oid")).first()
    assert oid[0] == oid[1] == (299).to_bytes(12, "big").hex()


def test_sample_takes_first_records_of_each_file(spark, folder):
    rows = D.read_bson(spark, str(folder[0]), ["plain", "zipped", "truncated"], block_bytes=3000, sample=25)
    ids = {}
    for r in rows.collect():
        ids.setdefault(r["collection"], []).append(r)
    assert sorted(int(r["id"]) for r in ids["plain"]) == list(range(25))
    assert len(ids["zipped"]) == 25
    assert sum(r["error"] is not None for r in ids["truncated"]) == 1 and len(ids["truncated"]) == 11


def test_fail_mode(spark, folder):
    with pytest.raises(Exception, match="unknown element type 66"):
        D.read_bson(spark, str(folder[0]), ["bad"], on_error="fail").collect()
    with pytest.raises(ValueError):
        D.read_bson(spark, str(folder[0]), on_error="other")


def greedy(lengths, max_bytes, max_docs, sample=None):
    """The chunk rule stated record by record."""
    out, start, docs, size, at = [], 0, 0, 0, 0
    for i, n in enumerate(lengths, 1):
        if i == sample:
            out.append((start, docs + 1, size + n))
            docs = 0
            break
        if size + n > max_bytes:
            out.append((start, docs, size))
            start, docs, size = at, 1, n
        else:
            docs, size = docs + 1, size + n
            if docs == max_docs:
                out.append((start, docs, size))
                start, docs, size = at + n, 0, 0
        at += n
    if docs:
        out.append((start, docs, size))
    return [c for c in out if c[1]]


@pytest.mark.parametrize("max_bytes,max_docs,segment,sample", [
    (10_000, 100_000, 30_000, None), (300, 1000, 700, None), (10_000, 7, 4_000, None), (100, 5, 400, None),
    (2_000, 40, 5_000, 333), (128 << 20, 100_000, None, None),
])
def test_chunk_plan(spark, folder, max_bytes, max_docs, segment, sample):
    base, lengths = folder
    offsets = D.bson_offsets(spark, str(base)).filter(F.col("path").endswith("/plain.bson"))
    rows = chunk_plan(offsets, max_bytes, max_docs, sample, segment).orderBy("chunk_no").collect()
    assert [(r["start_offset"], r["n_docs"], r["n_bytes"]) for r in rows] == greedy(lengths, max_bytes, max_docs, sample)
    assert [r["slot"] for r in rows] == [i % 256 for i in range(len(rows))]


def test_chunk_examples(spark):
    def plan(lengths):
        at, rows = 0, []
        for n in lengths:
            rows.append(("f", at, n))
            at += n
        df = spark.createDataFrame(rows, "path string, offset bigint, length bigint")
        return [(r["start_offset"], r["n_docs"], r["n_bytes"]) for r in chunk_plan(df, 128).orderBy("chunk_no").collect()]

    assert plan([60, 60, 60, 60]) == [(0, 2, 120), (120, 2, 120)]
    assert plan([200, 10]) == [(0, 1, 200), (200, 1, 10)]


def test_buffer_clamp():
    assert [clamp_buffer_mb(n) for n in (1, 16, 128, 9999)] == [16, 16, 128, 2047]


def test_guide_from_parts_equals_guide_from_leaves(spark, folder):
    from doclake.operators import guide as G

    names = ["plain", "zipped", "bad", "truncated"]
    rows = D.read_bson(spark, str(folder[0]), names, leaves=True, block_bytes=3000)
    want = G.guide_of(G.flatten_leaves(rows, ("collection",)), ("collection",)).collect()
    staged = D.read_bson_and_parts(spark, str(folder[0]), names, block_bytes=3000)
    got = G.merge_parts(staged.filter("parts is not null"), ("collection",)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) > 8
    assert staged.filter("doc is not null").count() == rows.filter("doc is not null").count()


def test_many_paths_are_handed_out_early(spark, tmp_path, monkeypatch):
    from doclake.operators import guide as G
    from doclake.sources.bson import Decoder, GuideParts

    docs = [encode({"m": {"k%d" % (n * 7 + k): k for k in range(5)}, "same": [1.5, -2.0, 10]}) for n in range(40)]
    (tmp_path / "m.bson").write_bytes(b"".join(docs))
    staged = D.read_bson_and_parts(spark, str(tmp_path))
    guide = {r["path"]: r for r in G.merge_parts(staged.filter("parts is not null")).collect() if r["type"] != "number"}
    assert guide["$.m"]["n_docs"] == 40 and guide["$.same[*]"]["n_values"] == 80
    assert (guide["$.same[*]"]["low"], guide["$.same[*]"]["high"]) == ("-2.0", "1.5")
    monkeypatch.setattr(D, "MAX_PARTS", 20)
    records = D._Records("parts", False)
    for raw in docs:
        records.add("f", 0, raw)
    records.end("f")
    handed = [r["parts"] for r in records.rows if "parts" in r]
    assert len(handed) > 5 and sum(p["n_docs"] for ps in handed for p in ps if p["path"] == "$.m") == 40
    whole, decoder = GuideParts(), Decoder(leaves=True)
    for raw in docs:
        whole.add(decoder.decode(raw)[3])
    assert sum(len(ps) for ps in handed) >= len(whole.rows)


def test_cut_gz_gives_its_whole_records(tmp_path):
    import gzip

    from doclake.sources.dump import gz_records

    records = [encode({"_id": i, "text": str(i * 7919) * 50}) for i in range(4000)]
    packed = gzip.compress(b"".join(records[:2000])) + gzip.compress(b"".join(records[2000:]))
    whole, cut = tmp_path / "a.bson.gz", tmp_path / "b.bson.gz"
    whole.write_bytes(packed)
    cut.write_bytes(packed[: len(packed) * 3 // 4])
    assert [r for _, r, _ in gz_records(str(whole))] == records
    *good, last = gz_records(str(cut))
    assert [r for _, r, _ in good] == records[: len(good)] and len(good) > 2000
    assert last[1] is None and last[0] == sum(map(len, records[: len(good)]))
    long = [encode({"_id": 1, "text": "x" * (5 << 20)}), encode({"_id": 2})]
    whole.write_bytes(gzip.compress(b"".join(long)))
    assert [r for _, r, _ in gz_records(str(whole))] == long


def test_structure_of_deep_records():
    from doclake.sources.bson import well_formed

    deep = b"\x05\0\0\0\0"
    for _ in range(5000):
        deep = (len(deep) + 8).to_bytes(4, "little") + b"\x03a\0" + deep + b"\0"
    assert well_formed(deep, 0, len(deep))
    broken = bytearray(deep)
    broken[-2500] ^= 1
    assert not well_formed(bytes(broken), 0, len(broken))
    assert not well_formed(deep, 0, len(deep) - 1)


def test_batches_are_bounded_by_bytes():
    records = D._Records("docs", False)
    raw = encode({"_id": 1, "text": "x" * (1 << 20)})
    sizes = []
    for i in range(100):
        records.add("f", i, raw)
        sizes += [b.num_rows for b in records.batches(D.BATCH)]
    assert sizes and max(sizes) * len(raw) <= D.BATCH_BYTES + len(raw)
    assert sum(sizes) + sum(b.num_rows for b in records.batches(1)) == 100
