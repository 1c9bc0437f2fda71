"""Schema inference on documents built to be awkward."""

import pytest
from pyspark.sql import functions as F

from doclake.operators import guide as G
from doclake.operators.shape import parse_docs


def docs(spark, *texts):
    return parse_docs(spark.createDataFrame(list(enumerate(texts)), "id bigint, doc string"))


def guide_rows(df, **options):
    return {(r["path"], r["type"]): r for r in G.data_guide(df, **options).collect()}


def test_paths_types_and_counts(spark):
    g = guide_rows(docs(
        spark,
        '{"a":1,"b":{"c":"x","d":null},"t":["p","qq"],"l":[{"k":1},{"k":2.5,"m":true}],"odd name":1,"x.y":2}',
        '{"a":"text","b":{},"t":[],"l":[]}',
        '{"a":1.0E30,"l":[{"k":[7,8]}],"n":[[1,2],[3]]}',
    ))
    assert (g["$.a", "number"]["n_docs"], g["$.a", "string"]["n_docs"], g["$.a", "double"]["n_docs"]) == (1, 1, 1)
    assert g["$.b", "object"]["n_docs"] == 2 and g["$.b.d", None]["n_values"] == 1
    assert (g["$.t[*]", "string"]["n_docs"], g["$.t[*]", "string"]["n_values"]) == (1, 2)
    assert g["$.t[*]", "string"]["length"] == 2 and g["$.t[*]", "string"]["high"] == "qq"
    assert (g["$.l.k", "number"]["n_docs"], g["$.l.k", "number"]["n_values"]) == (1, 2)
    assert g["$.l.k", "number"]["low"] == "1" and g["$.l.k", "number"]["high"] == "2.5"
    assert ("$.l.k[*]", "number") in g and ("$.n[*]", "number") in g and g["$.n[*]", "number"]["n_values"] == 3
    assert ("$.\"odd name\"", "number") in g and ("$.\"x.y\"", "number") in g


def test_numbers_compare_as_numbers(spark):
    g = guide_rows(docs(spark, '{"a":9}', '{"a":10}', '{"a":-3}', '{"b":9007199254740993}', '{"b":9007199254740992}'))
    assert (g["$.a", "number"]["low"], g["$.a", "number"]["high"]) == ("-3", "10")
    assert (g["$.b", "number"]["low"], g["$.b", "number"]["high"]) == ("9007199254740992", "9007199254740993")


def test_documents_count_across_bitmap_buckets(spark):
    n = 100_000
    df = spark.range(n).select("id", F.format_string('{"l":[{"k":%d},{"k":1}]}', "id").alias("doc"))
    g = guide_rows(parse_docs(df), max_depth=3)
    assert (g["$.l.k", "number"]["n_docs"], g["$.l.k", "number"]["n_values"]) == (n, 2 * n)


def test_depth(spark):
    assert G.document_depth(docs(spark, '{"a{":"]]}}}\\\\"}', '{"b":"\\\\\\"{{["}')) == 1
    assert G.document_depth(docs(spark, '{"a":[{"c":[1]},5,"{"]}')) == 4
    assert G.document_depth(docs(spark, '{"a":' + "[" * 40 + "]" * 40 + "}")) == 41
    df = docs(spark, '{"a":[[{"b":{}}]]}', '{"`<":"<<"}', "{}")
    assert G.document_depth(df) == 5
    with pytest.raises(Exception, match="nested deeper"):
        G.data_guide(df, max_depth=2).collect()
    assert ("$.a.b", "object") in guide_rows(df)


def test_depth_is_one_row_of_spark(spark):
    assert [tuple(r) for r in G.deepest(docs(spark, '{"a":[{"c":[1]}]}')).collect()] == [(4,)]
    assert [tuple(r) for r in G.deepest(docs(spark, "{}").limit(0)).collect()] == [(0,)]


def test_empty_collection(spark):
    assert guide_rows(docs(spark, "{}")) == {}
    assert G.data_guide(docs(spark, "{}").limit(0)).count() == 0


def test_key_types(spark):
    g = G.data_guide(docs(spark, '{"a":1,"b":"s","c":1,"d":[1]}', '{"a":1.0E40,"b":2,"c":7,"d":[2.5]}'))
    t = {r["key"]: (r["type"], r["spark_type"]) for r in G.key_types(g).collect()}
    assert t == {
        "a": ("double", "double"), "b": ("multitype", None), "c": ("number", "bigint"), "d": ("array", None),
        "d[*]": ("number", "decimal(38,10)"),
    }


def test_mat_paths(spark):
    g = G.data_guide(docs(spark, '{"a":{"x":1},"ab":2,"l":[{"y":{"z":1}}]}'))
    got = {r["key"]: r["path_type"] for r in G.mat_paths(g).collect()}
    assert got == {"a": "OTHER", "a.x": "OTHER", "ab": "OTHER", "l": "ARRAY", "l.y": "ARRAY", "l.y.z": "ARRAY"}
    assert G.mat_paths(G.data_guide(docs(spark, '{"a":1}'))).count() == 0


def test_key_volume(spark):
    df = docs(spark, '{"ab":[{"c":1},5],"d":{"efg":2}}')
    assert G.key_volume(df).first()[0] == 2 + 1 + 1 + 3
    assert G.key_volume(df, count_positions=True).first()[0] == 2 + 1 + 1 + 3 + 2


def test_cache_follows_row_count(spark, tmp_path):
    first = G.cached_data_guide(docs(spark, '{"a":1}'), str(tmp_path), "c")
    again = G.cached_data_guide(docs(spark, '{"zzz":1}'), str(tmp_path), "c")  # same count: the kept one
    other = G.cached_data_guide(docs(spark, '{"a":1}', '{"b":1}'), str(tmp_path), "c")
    assert [r["path"] for r in first.collect()] == [r["path"] for r in again.collect()] == ["$.a"]
    assert other.count() == 2


def test_geometries_are_recognised(spark):
    line = '{"type":"LineString","coordinates":[[1,2],[3,4]]}'
    texts = [
        '{"a":%s,"l":[%s,{"type":"Point","coordinates":[1,2]}]}' % (line, line),
        '{"a":{"type":"Point","coordinates":[1]},"b":{"type":"GeometryCollection","geometries":[%s]}}' % line,
        '{"a":null,"b":{"type":"Polygon","coordinates":[]}}',
    ]
    docs = parse_docs(spark.createDataFrame(list(enumerate(texts)), "id bigint, doc string"))
    rows = {(r["path"], r["type"]): (r["n_docs"], r["n_values"]) for r in G.data_guide(docs, geojson=True).collect()}
    assert rows == {
        ("$.a", "geojson"): (1, 1), ("$.a", "object"): (1, 1), ("$.a", None): (1, 1), ("$.a.type", "string"): (1, 1),
        ("$.a.coordinates", "array"): (1, 1), ("$.a.coordinates[*]", "number"): (1, 1), ("$.b", "geojson"): (2, 2),
        ("$.l", "array"): (1, 1),
    }
    plain = {(r["path"], r["type"]) for r in G.data_guide(docs).collect()}
    assert ("$.a.type", "string") in plain and ("$.a", "geojson") not in plain


def test_nodes_are_not_sorted_to_be_aggregated(spark):
    rows = G.flatten(docs(spark, '{"a":1,"l":["x"]}', '{"bcd":{"ef":2}}'), 2, ())
    guide = G.guide_of(rows, (), names=True)
    plan = guide._jdf.queryExecution().sparkPlan().toString()
    assert "ObjectHashAggregate" in plan and "bitmap_construct_agg" not in "".join(p for p in plan.splitlines() if "SortAggregate" in p)
    assert guide.agg(F.sum("key_chars")).first()[0] == 1 + 1 + 3 + 2


def test_hashed_puts_the_setting_back(spark):
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), G.hashed(spark):
        assert int(spark.conf.get(name)) == G.GROUPS
        raise ValueError
    assert spark.conf.get(name) == before


def test_walk_rows_are_flat(spark):
    texts = ['{"a":{"b":[]},"c":{}}', '{"l":[[1],{"k":null},-9223372036854775808,1.50,1.0E40,true,"x"],"o.d":1e-9}', "5", "[7,[8]]", "null"]
    nodes = G.walk(docs(spark, *texts), 3)
    plan = nodes._jdf.queryExecution().optimizedPlan().toString()
    assert "inline" not in plan and "struct(path" not in plan  # no node waits in an array while others are exploded
    got = sorted((r["id"], r["path"], r["key"] or "", -1 if r["pos"] is None else r["pos"], r["type"] or "", r["integral"], r["value"] or "", r["in_array"]) for r in nodes.collect())
    assert got == [
        (0, "$.a", "a", -1, "object", False, "", False), (0, "$.a.b", "b", -1, "array", False, "", False),
        (0, "$.c", "c", -1, "object", False, "", False), (1, '$."o.d"', "o.d", -1, "double", False, "1.0E-9", False), (1, "$.l", "", 0, "array", False, "", True),
        (1, "$.l", "", 1, "object", False, "", True), (1, "$.l", "l", -1, "array", False, "", False),
        (1, "$.l.k", "k", -1, "", False, "", True), (1, "$.l[*]", "", 0, "number", True, "1", True),
        (1, "$.l[*]", "", 2, "number", True, "-9223372036854775808", True), (1, "$.l[*]", "", 3, "number", False, "1.5", True),
        (1, "$.l[*]", "", 4, "double", False, "1.0E40", True), (1, "$.l[*]", "", 5, "boolean", False, "true", True),
        (1, "$.l[*]", "", 6, "string", False, "x", True),
        (3, "$", "", 1, "array", False, "", True), (3, "$[*]", "", 0, "number", True, "7", True), (3, "$[*]", "", 0, "number", True, "8", True),
    ]


@pytest.mark.parametrize("text", ['{"a":[[{"b":{"c":1}}]]}', '{"a":{"b":{"c":{"d":1}}}}'])
def test_names_alone_stop_at_deeper_documents_too(spark, text):
    with pytest.raises(Exception, match="nested deeper"):
        G.key_volume(docs(spark, text), max_depth=3).collect()
