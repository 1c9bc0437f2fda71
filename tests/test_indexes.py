"""Index planning and index tables."""

import json

import pytest
from pyspark.sql import functions as F

from doclake.functions.variants import only
from doclake.operators import guide as G
from doclake.operators import indexes as I
from doclake.operators.shape import materialise_id, parse_docs
from doclake.plans import index_plan as P


def docs(spark, *texts):
    return parse_docs(spark.createDataFrame(list(enumerate(texts)), "id bigint, doc string"))


INDEXES = [
    {"name": "_id_", "key": {"_id": 1}},
    {"name": "status_1", "key": {"status": 1}},
    {"name": "status_-1_cust.key_1", "key": {"status": -1, "cust.key": 1.0}},
    {"name": "wrapped", "key": {"date": {"$numberInt": "1"}, "_id": {"$numberDouble": "-1.0"}}},
    {"name": "lines.part_1", "key": {"lines.part": 1}, "unique": True},
    {"name": "status_part", "key": {"status": 1, "lines.part": -1}},
    {"name": "parallel", "key": {"lines.part": 1, "tags": 1}},
    {"name": "nested_ok", "key": {"a.x": 1, "a.b.y": 1}},
    {"name": "boundary", "key": {"tag": 1, "tags": 1}},
    {"name": "mixed", "key": {"mixed": 1}},
    {"name": "obj", "key": {"cust": 1}},
    {"name": "unknown", "key": {"nope": 1}},
    {"name": "two_reasons", "key": {"nope": 1, "mixed": 1}},
    {"name": "orphan", "key": {"never": 1}},
    {"name": "objects", "key": {"lines": 1}},
    {"name": "hashed", "key": {"cust.key": "hashed"}},
    {"name": "geo", "key": {"loc": "2dsphere"}},
    {"name": "txt", "key": {"_fts": "text", "_ftsx": 1}},
    {"name": "$**_1", "key": {"$**": 1}},
    {"name": "ttl", "key": {"date": 1}, "expireAfterSeconds": {"$numberLong": "60"}},
]
EXPECTED = {
    "_id_": ("primary_key", "build", []),
    "status_1": ("simple", "build", []),
    "status_-1_cust_key_1": ("compound", "build", []),
    "wrapped": ("compound", "build", []),
    "lines_part_1": ("simple_mv", "build", []),
    "status_part": ("compound_mv", "build", []),
    "parallel": ("compound", "failed", ["parallel arrays"]),
    "nested_ok": ("compound_mv", "build", []),
    "boundary": ("compound_mv", "build", []),
    "mixed": ("simple", "failed", ["multitype"]),
    "obj": ("simple", "failed", ["object"]),
    "unknown": ("simple", "failed", ["unknown type"]),
    "two_reasons": ("compound", "failed", ["unknown type", "multitype"]),
    "orphan": ("simple", "failed", ["orphan array"]),
    "objects": ("simple", "failed", ["orphan array"]),
    "hashed": ("sharded", "failed", ["sharded"]),
    "geo": ("geo_json", "build", []),
    "txt": ("json_search", "build", []),
    "$**_1": ("json_search", "skipped", ["merged search index"]),
    "ttl": ("ttl", "skipped", ["ttl"]),
}


@pytest.fixture(scope="module")
def planned(spark):
    guide = G.data_guide(docs(
        spark,
        '{"_id":1,"status":"F","date":"d","cust":{"key":5},"lines":[{"part":3},{"part":4}],"tags":["a"],"tag":"t","mixed":1,'
        '"never":[],"a":[{"x":1,"b":[{"y":2}]}]}',
        '{"_id":2,"status":"OO","date":"d","cust":{"key":6},"mixed":"s"}',
    )).withColumn("collection", F.lit("c"))
    meta = spark.createDataFrame([("c", json.dumps({"indexes": INDEXES})), ("none", None)], "collection string, metadata string")
    keys = P.index_keys(P.parse_metadata(meta))
    return keys, guide


def test_keys(planned):
    keys = {r["index_name"]: r for r in planned[0].collect()}
    cols = lambda n: [(c["pos"], c["path"], c["asc"]) for c in keys[n]["columns"]]
    assert cols("status_-1_cust_key_1") == [(0, "status", False), (1, "cust.key", True)]
    assert cols("wrapped") == [(0, "date", True), (1, "_id", False)]
    assert cols("hashed") == [] and keys["hashed"]["is_hashed"]
    assert cols("txt") == [] and keys["txt"]["is_text"]
    assert cols("geo") == [(0, "loc", True)] and keys["geo"]["is_spatial"]
    assert keys["ttl"]["is_ttl"] and keys["ttl"]["ttl_seconds"] == 60
    assert keys["lines_part_1"]["is_unique"] and not keys["status_1"]["is_unique"]


def test_plan(planned):
    plan = P.index_plan(*planned).collect()
    assert {r["index_name"]: (r["kind"], r["status"], r["reasons"]) for r in plan} == EXPECTED
    single = P.index_plan(*planned, multivalue=True).filter("kind = 'multivalue'").collect()
    assert [r["index_name"] for r in single] == ["lines_part_1"]


def test_expected(planned):
    assert P.expected_indexes(planned[0]).first()["expected_indexes"] == len(INDEXES) - 1


def test_spec(planned):
    plan = P.index_plan(*planned)
    typed = {r["index_name"]: json.loads(r["spec"]) for r in P.index_spec(plan).collect()}
    assert typed["status_part"] == {
        "name": "c$status_part", "unique": False, "multivalue": True,
        "fields": [{"path": "status", "order": "asc", "datatype": "string", "maxlength": 2},
                   {"path": "lines.part", "order": "desc", "datatype": "number"}],
    }
    plain = {r["index_name"]: json.loads(r["spec"]) for r in P.index_spec(plan, "json").collect()}
    assert plain["status_1"]["fields"] == [{"path": "status", "order": "asc", "datatype": "json"}]
    assert "geo" not in typed


def test_view_over_nested_arrays(spark):
    df = docs(
        spark,
        '{"s":"x","a":[{"x":1,"b":[{"y":1},{"y":2}]},{"x":2,"b":[]},{"x":3}]}', '{"s":"y","a":[]}', '{"s":"z"}', '{"s":"w","a":null}',
    )
    keys = [("a.b.y", "number"), ("s", "string"), ("a.x", "number")]
    view = I.array_view(df, keys, {"a", "a.b"}, spark_types={"a.b.y": "int", "a.x": "int"})
    assert view.columns == ["id", "a.b.y", "s", "a.x"]
    rows = sorted([tuple(r) for r in view.collect()], key=repr)
    assert rows == sorted([
        (0, 1, "x", 1), (0, 2, "x", 1), (0, None, "x", 2), (0, None, "x", 3), (1, None, "y", None),
        (2, None, "z", None), (3, None, "w", None),
    ], key=repr)
    with pytest.raises(ValueError, match="parallel"):
        I.array_view(df, [("a.x", "number"), ("c.y", "number")], {"a", "c"})


def test_scalar_array_and_lone_value(spark):
    df = docs(spark, '{"t":["a","b","a"]}', '{"t":"solo"}', '{"t":[]}', "{}")
    view = sorted([tuple(r) for r in I.array_view(df, [("t", "string")], {"t"}).collect()], key=repr)
    assert view == sorted([(0, "a"), (0, "b"), (0, "a"), (1, "solo"), (2, None), (3, None)], key=repr)
    multi = sorted(tuple(r) for r in I.multivalue_index(df, "t", "string", {"t"}).select("value", "id").collect())
    assert multi == [("a", 0), ("b", 0), ("solo", 1)]


@pytest.mark.parametrize("text,gtype,want", [
    ('{"v":"5"}', "number", "error"), ('{"v":5}', "number", 5), ('{"v":null}', "number", None), ("{}", "number", None),
    ('{"v":5}', "string", "error"), ('{"v":true}', "boolean", True), ('{"v":"true"}', "boolean", "error"),
    ('{"v":{"a":1}}', "string", "error"), ('{"v":"0aFF"}', "binary", b"\x0a\xff"), ('{"v":"zz"}', "binary", "error"),
    ('{"v":"not a date"}', "timestamp", "error"),
])
def test_strict_types(spark, text, gtype, want):
    df = docs(spark, text)
    if want == "error":
        with pytest.raises(Exception, match="is not a"):
            df.select(only(F.col("data"), "v", gtype)).collect()
        assert df.select(only(F.col("data"), "v", gtype, strict=False)).first()[0] is None
    else:
        assert df.select(only(F.col("data"), "v", gtype)).first()[0] == want


def test_odd_names(spark):
    df = docs(spark, '{"a b":{"c-d":1}}')
    assert df.select(only(F.col("data"), "a b.c-d", "number", spark_type="int")).first()[0] == 1


def test_unique(spark):
    rows = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, `a.b` string")
    assert [tuple(r) for r in I.unique_violations(rows, ["a.b"]).collect()] == [(None, 2)]
    with pytest.raises(ValueError, match="violated"):
        I.unique_violations(rows, ["a.b"], fail=True)
    check = I.primary_key(spark.createDataFrame([(1,), (1,), (None,), (None,), (4,)], "id int")).first()
    assert tuple(check) == (5, 2, 1)


def test_index_table_spreads_a_hot_key(spark):
    rows = spark.range(20_000).select("id", F.lit("hot").alias("k"))
    parts = I.index_table(rows, [("k", True)], partitions=8).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 6_000


def test_index_table_order(spark):
    rows = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, k string")
    ids = lambda asc: [r["id"] for r in I.index_table(rows, [("k", asc)], partitions=1).collect()]
    assert ids(True) == [3, 1, 4, 2] and ids(False) == [2, 1, 4, 3]


def test_geo(spark):
    df = docs(spark, '{"p":{"type":"Point","coordinates":[-0.5,51.5]}}', "{}", '{"p":null}')
    assert [tuple(r) for r in I.spatial_index(df, "p").collect()] == [(-1, 51, -0.5, 51.5, 0)]
    bad = docs(spark, '{"p":{"type":"Point","coordinates":[500,1]}}')
    with pytest.raises(Exception, match="GeoJSON"):
        I.spatial_index(bad, "p").collect()
    assert I.spatial_index(bad, "p", strict=False).count() == 0
    assert I.points_only(df, "p", 1).first()[0] and not I.points_only(df, "p", 2).first()[0]


def test_materialise_id_refuses_arrays_and_missing(spark):
    assert materialise_id(docs(spark, '{"_id":{"a":1}}').drop("id")).first()["id"] == '{"a":1}'
    for text, message in (('{"_id":[1]}', "array"), ('{"a":1}', "without _id")):
        with pytest.raises(Exception, match=message):
            materialise_id(docs(spark, text).drop("id")).collect()
