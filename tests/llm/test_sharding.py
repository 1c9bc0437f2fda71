import random
from zlib import crc32

from doclake.llm.sharding import BestFit, RoomTree, pack, pack_into, plan_shards, shard, with_shards


def test_tree_takes_the_least_room_that_suffices():
    rnd, tree, held = random.Random(2), RoomTree(), []
    for i in range(4000):
        if rnd.random() < 0.6:
            room = rnd.randrange(100)
            tree.insert(room, i)
            held.append((room, i))
        else:
            size = rnd.randrange(120)
            fitting = [x for x in held if x[0] >= size]
            assert tree.take(size) == (min(fitting) if fitting else None)
            if fitting:
                held.remove(min(fitting))


def test_best_fit_decreasing_by_hand():
    assert pack([4, 8, 1, 4, 2, 1], 10) == [1, 0, 1, 1, 0, 1]
    bins = BestFit(5)
    assert [bins.put(s) for s in (9, 3, 2, 1)] == [0, 1, 1, 2]


def test_pack_into_is_even_and_isolates_what_is_too_large():
    rnd = random.Random(4)
    sizes = [rnd.randrange(1, 400) for _ in range(3000)]
    loads = [0] * 16
    for s, b in zip(sizes, pack_into(sizes, 16)):
        loads[b] += s
    assert max(loads) <= 1.005 * sum(sizes) / 16 and min(loads) > 0.9 * sum(sizes) / 16
    out = pack_into([10**6] + sizes, 16)
    assert out.count(out[0]) == 1 and len(set(out)) == 16
    assert pack_into([], 4) == [] and set(pack_into([5, 5], 4)) <= set(range(4))


def check(docs, rows, shards):
    data = docs.collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 1, crc32((r.text or "").encode())) for r in data)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in rows) == want
    of, slots = {}, {}
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        assert of.setdefault((r["size"], r.text_crc32), r.shard) == r.shard  # groups are whole
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = shard(docs).collect()
    check(docs, rows, 16)
    loads = [sum(r["size"] for r in rows if r.shard == s) for s in range(16)]
    assert max(loads) <= 1.05 * sum(loads) / 16 and min(loads) >= 0.9 * sum(loads) / 16


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs, shard(odd_docs, 3).collect(), 3)
    placed = with_shards(odd_docs, 3)
    assert placed.columns == [c for c in odd_docs.columns if c != "shard"] + ["shard"] and placed.count() == odd_docs.count()
    assert shard(no_docs).count() == 0 and with_shards(no_docs).count() == 0


def test_capacity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = plan_shards(docs, 200_000).collect()
    sizes = {}
    for r in docs.collect():
        text = (r.text or "").encode()
        sizes[crc32(text), len(text) + 1] = sizes.get((crc32(text), len(text) + 1), 0) + len(text) + 1
    loads = {}
    for r in plan:
        loads[r.shard] = loads.get(r.shard, 0) + sizes[r.text_crc32, r["size"]]
    assert max(loads.values()) <= 200_000 and sum(loads.values()) == sum(sizes.values())
    assert len(loads) <= 1.05 * sum(loads.values()) / 200_000 + 1
