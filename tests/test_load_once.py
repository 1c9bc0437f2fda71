"""A load reads a dump once and writes documents once, shredded; misread blocks are put right."""

import json
import os
import random
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from doclake.job import documents_path, read_documents, run
from doclake.operators.indexes import path_index
from doclake.queries.fixtures import encode
from doclake.sources import dump as D


def write(folder: Path, name: str, docs, keys=()):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.bson").write_bytes(b"".join(encode(d) for d in docs))
    (folder / f"{name}.metadata.json").write_text(json.dumps({"indexes": list(keys)}))


def test_every_byte_is_read_once(spark, tmp_path):
    folder = tmp_path / "dump"
    write(folder, "c", [{"_id": n, "text": f"{n} " * 400} for n in range(8000)])
    size = os.path.getsize(folder / "c.bson")
    rows = D.read_once(spark, str(folder), block_bytes=3 << 20)
    n_read = rows.filter("block IS NOT NULL").agg(F.sum("block.n_read"), F.count("block"), F.sum("block.n_docs")).first()
    assert n_read[1] == -(-size // (3 << 20)) and n_read[2] == 8000
    assert n_read[0] <= 1.1 * size


def test_documents_are_written_once_and_shredded(spark, tmp_path):
    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    keys = [{"name": "k_1", "key": {"cust.key": 1}}]
    write(folder, "c", [{"_id": n, "cust": {"key": n % 50}, "text": "".join(random.Random(n).choices("abcdefgh ", k=600))} for n in range(3000)], keys)
    run(spark, str(folder), dest)
    parts = [p.name for p in (tmp_path / "lake/documents/collection=c").iterdir() if p.is_dir()]
    assert parts == ["part=documents"]
    files = list((tmp_path / "lake/documents/collection=c/part=documents").glob("*.parquet"))
    columns = {pq.ParquetFile(f).schema.column(i).path for f in files for i in range(len(pq.ParquetFile(f).schema))}
    assert "data.typed_value.cust.typed_value.key.typed_value" in columns

    # The bytes that an index on one path needs are few of those stored
    def weight(only=None):
        metas = [pq.ParquetFile(f).metadata for f in files]
        chunks = [m.row_group(g).column(c) for m in metas for g in range(m.num_row_groups) for c in range(m.num_columns)]
        return sum(c.total_compressed_size for c in chunks if only is None or c.path_in_schema.startswith(only))

    assert weight("data.typed_value.cust") < weight() / 20
    rows = path_index(read_documents(spark, dest), [("cust.key", "number")], spark_types={"cust.key": "bigint"})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema"):]
    assert "data:struct<0:variant>" in scan and "doc:string" not in scan
    assert rows.count() == 3000
    assert spark.read.parquet(f"{dest}/indexes/c$k_1").agg(F.sum("`cust.key`")).first()[0] == sum(n % 50 for n in range(3000))


def nasty(n):
    """Payloads that look like records, so that guesses go wrong."""
    fake = b"".join(encode({"_id": 10**6 + i, "fake": "x" * (i % 7)}) for i in range(60))
    return {"_id": n, "v": n % 5, "payload": fake if n % 3 else b"", "pad": "p" * (n % 90)}


def test_misread_blocks_are_put_right(spark, tmp_path):
    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    write(folder, "c", [nasty(n) for n in range(80)], [{"name": "v_1", "key": {"v": 1}}])
    write(folder, "fine", [{"_id": n} for n in range(300)])
    (folder / "c.bson").write_bytes((folder / "c.bson").read_bytes() + b"\x0b\0\0\0\x42ab\0zz\0")
    facts = D.read_once(spark, str(folder), block_bytes=1500).filter("block IS NOT NULL").select("block.*")
    assert D.misread(facts, 1500) is not None
    run(spark, str(folder), dest, block_bytes=1500)
    got = read_documents(spark, dest, ["c"])
    want = D.read_bson(spark, str(folder), ["c"], block_bytes=1500).filter("doc IS NOT NULL")
    assert sorted(r.id for r in got.select("id").collect()) == sorted(str(n) for n in range(80))
    assert sorted(map(tuple, got.select("offset", "bson_len").collect())) == sorted(map(tuple, want.select("offset", "bson_len").collect()))
    assert read_documents(spark, dest, ["fine"]).count() == 300
    assert spark.read.parquet(f"{dest}/rejected").count() == 1
    assert spark.read.parquet(f"{dest}/guide").filter("collection = 'c' AND path LIKE '%fake%'").count() == 0
    counts = spark.read.parquet(f"{dest}/guide").filter("collection = 'c' AND path = '$._id'").first()
    assert counts["n_docs"] == 80
    assert not any(p.name != "part=documents" for p in Path(documents_path(dest), "collection=c").iterdir() if p.is_dir())


def test_misread_is_none_when_guesses_hold(spark, tmp_path):
    folder = tmp_path / "dump"
    write(folder, "c", [{"_id": n, "s": "x" * (n % 50)} for n in range(400)])
    facts = D.read_once(spark, str(folder), block_bytes=2000).filter("block IS NOT NULL").select("block.*")
    assert D.misread(facts, 2000) is None


def test_index_on_lines_and_areas(spark, tmp_path):
    from doclake.operators import geometry as Geo

    folder, dest = tmp_path / "dump", str(tmp_path / "lake")
    shapes = [
        {"type": "LineString", "coordinates": [[float(n), 0.0], [float(n) + 1, 5.0]]} if n % 2
        else {"type": "Point", "coordinates": [float(n), 1.0]} for n in range(60)
    ]
    write(folder, "c", [{"_id": n, "loc": s} for n, s in enumerate(shapes)], [{"name": "geo", "key": {"loc": "2dsphere"}}])
    result = run(spark, str(folder), dest)
    assert result.plan.first()["status"] == "build"
    index, parts = spark.read.parquet(f"{dest}/indexes/c$geo"), spark.read.parquet(f"{dest}/shapes/c$geo")
    found = Geo.intersecting(index, parts, Geo.box_query(spark, 9.5, 0.5, 11.5, 1.5))
    assert {r.id for r in found.collect()} == {"10", "11"}
    run(spark, str(folder), dest, if_exists="drop", indexes="skip")
    assert not list(Path(dest, "shapes").iterdir())
