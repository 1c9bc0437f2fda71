"""The whole life cycle on a small dump folder, and the streams."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from doclake.job import read_documents, run
from doclake.operators.indexes import document_frequency
from doclake.queries.fixtures import encode
from doclake.runtime import children, shared_dir
from doclake.streaming import sync


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "dump"
    folder.mkdir()
    orders = [
        {"_id": n, "status": "FO"[n % 2], "at": datetime(2024, 1, 1 + n % 28), "tags": ["t%d" % (n % 3), "all"],
         "lines": [{"part": n * 10 + k} for k in range(n % 4)], "loc": {"type": "Point", "coordinates": [float(n % 90), 1.0]},
         "dup": n // 2}
        for n in range(200)
    ]
    bad = b"\x0b\0\0\0\x42ab\0zz\0"
    (folder / "orders.bson").write_bytes(b"".join(encode(o) for o in orders) + bad)
    keys = [
        {"name": "_id_", "key": {"_id": 1}}, {"name": "status_1", "key": {"status": 1}}, {"name": "at_-1", "key": {"at": -1}},
        {"name": "tags_1", "key": {"tags": 1}}, {"name": "status_part", "key": {"status": 1, "lines.part": -1}},
        {"name": "geo", "key": {"loc": "2dsphere"}}, {"name": "txt", "key": {"_fts": "text", "_ftsx": 1}},
        {"name": "dup_1", "key": {"dup": 1}, "unique": True}, {"name": "nope_1", "key": {"nope": 1}},
    ]
    (folder / "orders.metadata.json").write_text(json.dumps({"indexes": keys}))
    (folder / "007.bson").write_bytes(encode({"_id": "x", "v": 1}) + encode({"_id": "y", "v": 2}))
    return str(folder)


def test_life_cycle(spark, source, tmp_path):
    dest = str(tmp_path / "lake")
    result = run(spark, source, dest, block_bytes=2000)
    assert (result.loaded, result.skipped) == (["007", "orders"], [])
    report = {r["collection"]: r for r in result.collections.collect()}
    assert (report["orders"]["n_docs"], report["007"]["n_docs"]) == (200, 2)
    assert report["orders"]["n_indexes"] == 7 and report["orders"]["n_failed"] == 2
    assert report["orders"]["table_bytes"] > 0 and report["007"]["key_chars"] == 2 * 4
    rejected = spark.read.parquet(f"{dest}/rejected").collect()
    assert len(rejected) == 1 and "unknown element type" in rejected[0]["error"]

    indexes = {r["table_name"]: r for r in result.indexes.collect()}
    assert indexes["orders$dup_1"]["status"] == "failed" and "violated" in indexes["orders$dup_1"]["reasons"]
    assert indexes["orders$nope_1"]["reasons"] == "unknown type"
    assert indexes["orders$status_part"]["kind"] == "compound_mv" and indexes["orders$status_part"]["n_bytes"] > 0

    read = lambda name: spark.read.parquet(f"{dest}/indexes/orders${name}")
    assert read("_id_").count() == 200
    assert dict(read("at_-1").dtypes)["at"] == "timestamp" and read("at_-1").filter("at is null").count() == 0
    assert read("status_part").count() == sum(max(1, n % 4) for n in range(200))
    assert read("tags_1").count() == 400
    assert read("geo").filter("cell_x = 5").count() == sum(n % 90 == 5 for n in range(200))
    assert document_frequency(read("txt")).filter("token = 'all'").first()["n_docs"] == 200

    again = run(spark, source, dest)
    assert (again.loaded, again.skipped) == ([], ["007", "orders"])
    sampled = run(spark, source, dest, collections="orders", if_exists="drop", sample=5, indexes="skip")
    assert sampled.collections.first()["n_docs"] == 5 and sampled.collections.first()["sampled"]
    assert read_documents(spark, dest, ["007"]).count() == 2
    only = run(spark, source, dest, collections="orders", indexes="only", multivalue=True)
    assert read("_id_").count() == 5
    kinds = {r["index_name"]: r["kind"] for r in only.plan.collect()}
    assert kinds["tags_1"] == "multivalue" and set(read("tags_1").columns) == {"value", "id"}


def write_dump(folder, name, docs, indexes=()):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.bson").write_bytes(b"".join(encode(d) for d in docs))
    (folder / f"{name}.metadata.json").write_text(json.dumps({"indexes": list(indexes)}))


def test_reload_replaces_everything_even_by_nothing(spark, tmp_path):
    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    keys = [{"name": "_id_", "key": {"_id": 1}}, {"name": "v_1", "key": {"v": 1}}]
    write_dump(folder, "a", [{"_id": n, "v": n} for n in range(20)], keys)
    write_dump(folder, "b", [{"_id": 1, "v": 1}], keys)
    (folder / "a.bson").write_bytes((folder / "a.bson").read_bytes() + b"\x0b\0\0\0\x42ab\0zz\0")
    run(spark, str(folder), dest)
    names = lambda: sorted(p.name for p in (tmp_path / "lake" / "indexes").iterdir())
    assert names() == ["a$_id_", "a$v_1", "b$_id_", "b$v_1"]
    write_dump(folder, "a", [], keys[:1])
    run(spark, str(folder), dest, collections="a", if_exists="drop")
    assert [r["collection"] for r in read_documents(spark, dest).collect()] == ["b"]
    assert "a$v_1" not in names() and names()[-2:] == ["b$_id_", "b$v_1"]
    for table in ("rejected", "guide", "key_chars"):
        assert not (tmp_path / "lake" / table / "collection=a").exists()


def test_index_names_that_differ_by_dot_and_underscore(spark, tmp_path):
    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    keys = [{"name": "a.b_1", "key": {"a.b": 1}}, {"name": "a_b_1", "key": {"a_b": -1}}]
    write_dump(folder, "c", [{"_id": n, "a": {"b": n}, "a_b": str(n)} for n in range(9)], keys)
    plan = {r["index_name"]: r for r in run(spark, str(folder), dest).plan.collect()}
    assert {n: r["status"] for n, r in plan.items()} == {"a_b_1": "build", "a_b_1~2": "build"}
    assert spark.read.parquet(f"{dest}/indexes/c$a_b_1").columns == ["id", "a.b"]
    assert spark.read.parquet(f"{dest}/indexes/c$a_b_1~2").columns == ["id", "a_b"]


def test_rebuilding_indexes_keeps_the_types_of_the_load(spark, tmp_path):
    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    keys = [{"name": "at_1", "key": {"at": 1}}, {"name": "geo", "key": {"status": 1, "loc": "2dsphere"}}]
    point = {"type": "Point", "coordinates": [1.5, 2.5]}
    write_dump(folder, "c", [{"_id": n, "at": datetime(2024, 1, 1 + n), "status": "x", "loc": point} for n in range(9)], keys)
    held = [p for p, _ in children(spark, f"{shared_dir(spark)}/doclake")]
    first = run(spark, str(folder), dest)
    left = {n.rsplit("-", 1)[0] for p, n in children(spark, f"{shared_dir(spark)}/doclake") if p not in held}
    assert left <= {"plan", "package"}  # nothing of the size of the data stays
    before = spark.read.parquet(f"{dest}/indexes/c$at_1").dtypes
    again = run(spark, str(folder), dest, indexes="only")
    assert spark.read.parquet(f"{dest}/indexes/c$at_1").dtypes == before and ("at", "timestamp") in before
    assert spark.read.parquet(f"{dest}/indexes/c$geo").filter("cell_x = 1 and cell_y = 2").count() == 9
    assert first.collections.collect()[0]["key_chars"] == again.collections.collect()[0]["key_chars"]


def test_key_method_and_duplicate_keys(spark, tmp_path):
    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    write_dump(folder, "a", [{"_id": n} for n in range(3)])
    write_dump(folder, "b", [{"_id": n} for n in range(3)])
    run(spark, str(folder), dest, key_methods={"a": "UUID"}, indexes="skip")
    ids = {c: {r["id"] for r in read_documents(spark, dest, [c]).collect()} for c in "ab"}
    assert ids["b"] == {"0", "1", "2"} and len(ids["a"]) == 3 and all(len(i) == 36 for i in ids["a"])
    with pytest.raises(ValueError):
        run(spark, str(folder), dest, key_methods={"a": "OTHER"})


def test_bad_options(spark, source, tmp_path):
    for options in ({"indexes": "only", "if_exists": "drop"}, {"indexes": "x"}, {"if_exists": "x"}):
        with pytest.raises(ValueError):
            run(spark, source, str(tmp_path / "l"), **options)


def test_text_stream_is_incremental_and_exact(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def add(rows):
        spark.createDataFrame(rows, "id bigint, value string").write.mode("append").parquet(source)
        docs = sync.stream_documents(spark, source, "id bigint, value string", files_per_trigger=1)
        sync.start_text_sync(docs, out, checkpoint, every=None).awaitTermination()

    add([(1, "The cat, the CAT"), (2, "dog")])
    add([(3, "cat dog cat")])
    got = {tuple(r) for r in sync.synced_postings(spark, out).collect()}
    assert got == {("the", 1, 2), ("cat", 1, 2), ("dog", 2, 1), ("cat", 3, 2), ("dog", 3, 1)}


def test_view_stream(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    rows = [(1, '{"s":"a","t":[1,2]}'), (2, '{"s":"b"}')]
    spark.createDataFrame(rows, "id bigint, doc string").write.parquet(source)
    docs = sync.stream_documents(spark, source, "id bigint, doc string")
    keys = [("s", "string"), ("t", "number")]
    sync.start_view_sync(docs, out, checkpoint, keys, {"t"}, {"t": "int"}, every=None).awaitTermination()
    got = sorted([tuple(r) for r in spark.read.parquet(out).collect()], key=repr)
    assert got == sorted([(1, "a", 1), (1, "a", 2), (2, "b", None)], key=repr)


def test_counts_are_stable_under_repartition(spark, source, tmp_path):
    from doclake.sources.dump import read_bson

    rows = read_bson(spark, source, ["orders"], block_bytes=700).repartition(13)
    assert rows.agg(F.count("doc")).first()[0] == 200


def test_no_folder_of_our_own_on_a_cluster():
    from types import SimpleNamespace

    from doclake.runtime import shared_dir

    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://head:7077"),
    )
    with pytest.raises(RuntimeError):
        shared_dir(session)


def test_keys_of_one_text_and_build_durations(spark, tmp_path):
    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    write_dump(folder, "c", [{"_id": 1}, {"_id": "1"}, {"_id": 2}], [{"name": "_id_", "key": {"_id": 1}}])
    report = run(spark, str(folder), dest).indexes.first()
    assert report["status"] == "build" and report["build_ms"] > 0
    assert spark.read.parquet(f"{dest}/indexes/c$_id_").count() == 3


def test_numbers_are_indexed_as_they_are(spark, tmp_path):
    from decimal import Decimal

    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    keys = [{"name": f"{k}_1", "key": {k: 1}} for k in ("wide", "fine", "odd", "plain")]
    wide, fine = Decimal(10) ** 25, Decimal("0.123456789012")
    write_dump(folder, "c", [{"_id": n, "wide": wide + n, "fine": fine + n, "odd": float("nan") if n else 0.5, "plain": n} for n in range(9)], keys)
    plan = {r["index_name"]: r["status"] for r in run(spark, str(folder), dest).plan.collect()}
    assert set(plan.values()) == {"build"}
    read = lambda k: [r[k] for r in spark.read.parquet(f"{dest}/indexes/c${k}_1").orderBy("id").collect()]
    assert read("wide") == [wide + n for n in range(9)]
    assert read("fine") == [fine + n for n in range(9)]
    assert read("odd")[0] == 0.5 and all(x != x for x in read("odd")[1:])
    assert read("plain") == list(range(9))
