"""Contract queries: shaping, schema inference, index planning, index tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, functions as F

from doclake.functions.ids import index_table_name, path_key, path_prefixes
from doclake.functions.variants import field, only
from doclake.operators import geometry as Geo
from doclake.operators import guide as G
from doclake.operators import indexes as I
from doclake.operators import shape as S
from doclake.operators import uniqueness as U
from doclake.plans import index_plan as P
from doclake.queries.documents import (
    event_docs, line_docs, order_docs, order_json, part_metadata, shape_docs, table, text_docs,
)
from doclake.queries.oracle_parts import LINE_NODES, LINES, PART_INDEXES, PART_PLAN, PATH_CELLS, SHAPES
from doclake.queries.registry import query
from doclake.runtime import scratch, stored

LINE_ARRAYS = {"charges", "flags", "empty"}
DEPTH = 3  # nesting of every derived collection


def line_guide(spark, sf) -> DataFrame:
    """Guide of the line collections, written once as a load would leave it."""
    with G.hashed(spark):
        return stored(G.data_guide(line_docs(spark, sf), max_depth=DEPTH, by=("collection",)), "guide")


def part_keys(spark, sf) -> DataFrame:
    return P.index_keys(P.parse_metadata(part_metadata(spark, sf)))


# --- array views and path indexes ------------------------------------------------------


@query("array_view", f"""
WITH {LINES}
SELECT id, status, c.amount AS amount FROM (
  SELECT id, l_returnflag AS status,
         unnest(CASE WHEN len(charges) > 0 THEN charges ELSE [NULL] END) AS c FROM lines)
""")
def array_view(spark, sf):
    view = I.array_view(
        line_docs(spark, sf), [("status", "string"), ("charges.amount", "number")], LINE_ARRAYS,
        spark_types={"charges.amount": "double"},
    )
    return view.withColumnRenamed("charges.amount", "amount")


@query("array_view_index", f"""
WITH {LINES}
SELECT id, part, c.kind AS kind FROM (
  SELECT id, l_partkey AS part,
         unnest(CASE WHEN len(charges) > 0 THEN charges ELSE [NULL] END) AS c FROM lines)
""")
def array_view_index(spark, sf):
    view = I.array_view(
        line_docs(spark, sf), [("charges.kind", "string"), ("item.part", "number")], LINE_ARRAYS,
        spark_types={"item.part": "bigint"},
    )
    placed = I.index_table(view, [("item.part", False), ("charges.kind", True)])
    return placed.withColumnsRenamed({"charges.kind": "kind", "item.part": "part"})


@query("array_view_refresh", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS status,
       unnest(string_split(o_orderpriority, '-')) AS tag
FROM orders WHERE o_orderkey % 11 <> 0
""")
def array_view_refresh(spark, sf):
    docs = order_docs(spark, sf)
    keys, arrays = [("status", "string"), ("tags", "string")], {"tags"}
    view = I.array_view(docs, keys, arrays)
    newer = F.regexp_replace("doc", '"status":"[^"]*"', '"status":"X"')
    changed = S.parse_docs(docs.filter((F.col("id") % 10 == 0) & (F.col("id") % 11 != 0)).withColumn("doc", newer))
    deleted = docs.filter(F.col("id") % 11 == 0).select("id")
    return I.refresh_array_view(view, changed, deleted, keys, arrays).withColumnRenamed("tags", "tag")


@query("path_index", """
SELECT event_id AS id, event_type AS kind, json_extract(props, '$.k')::BIGINT AS k FROM events
""")
def path_index(spark, sf):
    rows = I.path_index(
        event_docs(spark, sf), [("kind", "string"), ("props.k", "number")], spark_types={"props.k": "bigint"}
    )
    return I.index_table(rows, [("kind", True), ("props.k", False)]).withColumnRenamed("props.k", "k")


@query("typed_only", """
SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total, o_orderdate AS day,
       NULL::BIGINT AS status_number, NULL::VARCHAR AS custkey_text, o_custkey AS custkey FROM orders
""")
def typed_only(spark, sf):
    data = F.col("data")
    return order_docs(spark, sf).select(
        "id",
        only(data, "status", "string").alias("status"),
        only(data, "total", "number", spark_type="double").alias("total"),
        only(data, "date", "timestamp").cast("timestamp_ntz").alias("day"),
        only(data, "status", "number", strict=False, spark_type="bigint").alias("status_number"),
        only(data, "cust.key", "string", strict=False).alias("custkey_text"),
        only(data, "cust.key", "number", spark_type="bigint").alias("custkey"),
    )


@query("unique_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def unique_violations(spark, sf):
    return I.unique_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("append_violations", """
WITH k AS (SELECT l_partkey, l_suppkey, count(*) FILTER (l_orderkey % 2 = 0) AS n_stored, count(*) FILTER (l_orderkey % 2 <> 0) AS n_new
           FROM lineitem GROUP BY ALL)
SELECT * FROM k WHERE n_new > 0 AND n_stored + n_new > 1
""")
def append_violations(spark, sf):
    """The lines of odd orders, appended to those of even ones, against a key of part and supplier."""
    lines, cols = table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"]
    name = "keys_" + uuid.uuid4().hex
    U.store_keys(lines.filter("l_orderkey % 2 = 0"), cols, name, buckets=8)
    return U.append_violations(spark, lines.filter("l_orderkey % 2 <> 0"), cols, name)


@query("path_index_stored", """
SELECT event_id AS id, event_type AS kind, json_extract(props, '$.k')::BIGINT AS k FROM events
""")
def path_index_stored(spark, sf):
    """The same index from documents stored once as VARIANT: only the columns of its two paths are read."""
    docs = stored(event_docs(spark, sf).select("id", "data"), "variants")
    rows = I.path_index(docs, [("kind", "string"), ("props.k", "number")], spark_types={"props.k": "bigint"})
    return I.index_table(rows, [("kind", True), ("props.k", False)]).withColumnRenamed("props.k", "k")


@query("primary_key_check", """
SELECT count(*) AS n_rows, 0::BIGINT AS n_null, count(*) - count(DISTINCT event_id) AS n_duplicate_keys FROM events
""")
def primary_key_check(spark, sf):
    return I.primary_key(table(spark, sf, "events"), "event_id")


@query("multivalue_index", f"""
WITH {LINES}, v AS (SELECT id, unnest(charges) AS c FROM lines)
SELECT DISTINCT c.amount AS value, id FROM v
""")
def multivalue_index(spark, sf):
    return I.multivalue_index(line_docs(spark, sf), "charges.amount", "number", LINE_ARRAYS, "double")


@query("text_index", """
WITH s AS (
  SELECT doc_id AS id, unnest([lang, source, text]) AS v FROM documents),
t AS (SELECT id, unnest(string_split_regex(lower(v), '[^a-z0-9]+')) AS token FROM s)
SELECT token, id, count(*) AS tf FROM t WHERE token <> '' GROUP BY ALL
""")
def text_index(spark, sf):
    return I.text_index(text_docs(spark, sf), max_depth=1)


@query("text_index_frequency", """
WITH t AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS token FROM documents)
SELECT token, count(DISTINCT doc_id) AS n_docs, count(*) AS n_hits FROM t WHERE token <> '' GROUP BY ALL
""")
def text_index_frequency(spark, sf):
    return I.document_frequency(I.text_postings(table(spark, sf, "documents").withColumnRenamed("doc_id", "id"), "text"))


@query("spatial_index", """
WITH p AS (SELECT event_id AS id, (user_id % 360 - 180)::DOUBLE AS lon, greatest(-90, least(90, value)) AS lat
           FROM events WHERE event_id % 5 <> 0)
SELECT floor(lon / 10)::INTEGER AS cell_x, floor(lat / 10)::INTEGER AS cell_y, lon, lat, id FROM p
""")
def spatial_index(spark, sf):
    return I.index_table(I.spatial_index(event_docs(spark, sf), "loc", 10.0), [("cell_x", True), ("cell_y", True)])


@query("spatial_box", """
SELECT event_id AS id FROM events
WHERE event_id % 5 <> 0 AND user_id % 360 - 180 BETWEEN -175 AND -100 AND greatest(-90, least(90, value)) BETWEEN 5 AND 42
""")
def spatial_box(spark, sf):
    index = I.spatial_index(event_docs(spark, sf), "loc", 10.0)
    return I.in_box(index, -175.0, 5.0, -100.0, 42.0, 10.0).select("id")


@query("spatial_index_lines", f"""
WITH {PATH_CELLS}
SELECT code << (2 * (20 - k)) AS lo, ((code + 1) << (2 * (20 - k))) - 1 AS hi, id, 0 AS part FROM covered
""")
def spatial_index_lines(spark, sf):
    return Geo.spatial_shape_index(stored(Geo.shapes(shape_docs(spark, sf), "path"), "shapes"))


def shape_index(spark, sf, field: str) -> tuple[DataFrame, DataFrame]:
    parts = stored(Geo.shapes(shape_docs(spark, sf), field), "shapes")
    return stored(Geo.spatial_shape_index(parts), "shape-index"), parts


@query("spatial_lines_box", f"""
WITH {SHAPES}, moved AS (SELECT id, x1 + s AS x1, y1, x2 + s AS x2, y2 FROM edges, (SELECT unnest([-360, 0, 360]) AS s) WHERE shape = 'path'),
sides AS (SELECT *, [sign((x2 - x1) * (c.y - y1) - (y2 - y1) * (c.x - x1)) FOR c IN
    [{{x: 170.0, y: -10.0}}, {{x: 200.0, y: -10.0}}, {{x: 170.0, y: 35.0}}, {{x: 200.0, y: 35.0}}]] AS s
  FROM moved)
SELECT DISTINCT id FROM sides WHERE least(x1, x2) <= 200 AND greatest(x1, x2) >= 170 AND least(y1, y2) <= 35 AND greatest(y1, y2) >= -10
  AND list_min(s) <= 0 AND list_max(s) >= 0
""")
def spatial_lines_box(spark, sf):
    index, parts = shape_index(spark, sf, "path")
    return Geo.intersecting(index, parts, Geo.box_query(spark, 170.0, -10.0, -160.0, 35.0))


ROUTE = [(-120.5, 10.25), (-60.0, 40.0), (15.5, 22.0), (30.0, -35.5), (170.0, 12.5), (-170.0, 20.0)]


@query("spatial_polygons_line", f"""
WITH {SHAPES}, route AS (SELECT x1, y1, CASE WHEN x2 - x1 > 180 THEN x2 - 360 WHEN x2 - x1 < -180 THEN x2 + 360 ELSE x2 END AS x2, y2
  FROM (VALUES {", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(ROUTE, ROUTE[1:]))}) t(x1, y1, x2, y2)),
moved AS (SELECT x1 + s AS qx1, y1 AS qy1, x2 + s AS qx2, y2 AS qy2 FROM route, (SELECT unnest([-360, 0, 360]) AS s)),
crossing AS (SELECT id FROM edges, moved WHERE shape = 'area'
  AND greatest(x1, x2) >= least(qx1, qx2) AND greatest(qx1, qx2) >= least(x1, x2)
  AND greatest(y1, y2) >= least(qy1, qy2) AND greatest(qy1, qy2) >= least(y1, y2)
  AND sign((x2 - x1) * (qy1 - y1) - (y2 - y1) * (qx1 - x1)) * sign((x2 - x1) * (qy2 - y1) - (y2 - y1) * (qx2 - x1)) <= 0
  AND sign((qx2 - qx1) * (y1 - qy1) - (qy2 - qy1) * (x1 - qx1)) * sign((qx2 - qx1) * (y2 - qy1) - (qy2 - qy1) * (x2 - qx1)) <= 0),
holding AS (SELECT id FROM edges, (SELECT unnest([{ROUTE[0][0]} - 360, {ROUTE[0][0]}, {ROUTE[0][0]} + 360]) AS px) WHERE shape = 'area'
  AND (x1 <= px) <> (x2 <= px) AND y1 + (px - x1) * (y2 - y1) / (x2 - x1) > {ROUTE[0][1]} GROUP BY id HAVING count(*) % 2 = 1)
SELECT id FROM crossing UNION SELECT id FROM holding
""")
def spatial_polygons_line(spark, sf):
    index, parts = shape_index(spark, sf, "area")
    route = json.dumps({"type": "LineString", "coordinates": ROUTE})
    return Geo.intersecting(index, parts, Geo.geometry_query(spark, route))


@query("points_probe", "SELECT count(*) FILTER (event_id % 5 <> 0) >= 100 AS points_only FROM events")
def points_probe(spark, sf):
    return I.points_only(event_docs(spark, sf), "loc", 100)


@query("index_stats", f"""
WITH {LINES}, v AS (
  SELECT l_returnflag AS status, unnest(CASE WHEN len(charges) > 0 THEN charges ELSE [NULL] END) AS c FROM lines)
SELECT 'status' AS "column", count(*) AS n_rows, count(status) AS n_values, count(DISTINCT status) AS n_distinct,
       min(status) AS low, max(status) AS high FROM v
UNION ALL
SELECT 'charges.amount', count(*), count(c.amount), count(DISTINCT c.amount),
       min(c.amount)::VARCHAR, max(c.amount)::VARCHAR FROM v
""")
def index_stats(spark, sf):
    view = I.array_view(
        line_docs(spark, sf), [("status", "string"), ("charges.amount", "number")], LINE_ARRAYS,
        spark_types={"charges.amount": "double"},
    )
    return I.index_stats(view, ["status", "charges.amount"])


# --- schema inference ------------------------------------------------------------------


def _typed_value(rows: DataFrame) -> list:
    number = F.col("type").isin("number", "double")
    return [
        F.when(number, F.col("value").try_cast("double")).alias("num"),
        F.when(~number, F.col("value")).alias("txt"),
    ]


@query("flatten", """
SELECT id, path, type, num, txt FROM (
  SELECT o_orderkey AS id, '$._id' AS path, 'number' AS type, o_orderkey::DOUBLE AS num, NULL AS txt FROM orders
  UNION ALL SELECT o_orderkey, '$.status', 'string', NULL, o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, '$.total', 'number', o_totalprice, NULL FROM orders
  UNION ALL SELECT o_orderkey, '$.date', 'string', NULL, strftime(o_orderdate, '%Y-%m-%d') FROM orders
  UNION ALL SELECT o_orderkey, '$.cust', 'object', NULL, NULL FROM orders
  UNION ALL SELECT o_orderkey, '$.cust.key', 'number', o_custkey, NULL FROM orders
  UNION ALL SELECT o_orderkey, '$.cust.priority', 'string', NULL, o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey, '$.tags', 'array', NULL, NULL FROM orders
  UNION ALL SELECT o_orderkey, '$.tags[*]', 'string', NULL, unnest(string_split(o_orderpriority, '-')) FROM orders)
""")
def flatten(spark, sf):
    rows = G.flatten(order_docs(spark, sf), max_depth=2)
    return rows.select("id", "path", "type", *_typed_value(rows))


GUIDE_SQL = """
SELECT {by} path, type, max(strlen(txt)) AS length, min(num) AS low_num, max(num) AS high_num,
       min(txt) AS low_txt, max(txt) AS high_txt, count(DISTINCT doc) AS n_docs, count(*) AS n_values
FROM nodes GROUP BY {by} path, type
"""


def _comparable(guide: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    number = F.col("type").isin("number", "double")
    return guide.select(
        *by, "path", "type", F.when(~number, F.col("length")).alias("length"),
        F.when(number, F.col("low").try_cast("double")).alias("low_num"),
        F.when(number, F.col("high").try_cast("double")).alias("high_num"),
        F.when(~number, F.col("low")).alias("low_txt"),
        F.when(~number, F.col("high")).alias("high_txt"),
        "n_docs", "n_values",
    )


@query("data_guide", f"WITH {LINE_NODES} {GUIDE_SQL.format(by='')}")
def data_guide(spark, sf):
    return _comparable(G.data_guide(line_docs(spark, sf), max_depth=DEPTH))


@query("data_guide_by_collection", f"WITH {LINE_NODES} {GUIDE_SQL.format(by='collection,')}")
def data_guide_by_collection(spark, sf):
    return _comparable(line_guide(spark, sf), ("collection",))


EVENT_NODES = """
nodes AS (
  SELECT doc, '$._id' AS path, 'string' AS type, NULL::DOUBLE AS num,
         lower(printf('%08x', floor(epoch(ts))::BIGINT) || printf('%016x', doc)) AS txt FROM e
  UNION ALL SELECT doc, '$.user', 'number', user_id, NULL FROM e
  UNION ALL SELECT doc, '$.kind', 'string', NULL, event_type FROM e
  UNION ALL SELECT doc, '$.props', 'object', NULL, NULL FROM e
  UNION ALL SELECT doc, '$.props.k', 'number', json_extract(props, '$.k')::DOUBLE, NULL FROM e
  UNION ALL SELECT doc, '$.loc', 'object', NULL, NULL FROM e WHERE doc % 5 <> 0
  UNION ALL SELECT doc, '$.loc.type', 'string', NULL, 'Point' FROM e WHERE doc % 5 <> 0
  UNION ALL SELECT doc, '$.loc.coordinates', 'array', NULL, NULL FROM e WHERE doc % 5 <> 0
  UNION ALL SELECT doc, '$.loc.coordinates[*]', 'number',
                   unnest([(user_id % 360 - 180)::DOUBLE, greatest(-90, least(90, value))]), NULL FROM e WHERE doc % 5 <> 0)
"""


@query("data_guide_sampled", f"""
WITH e AS (SELECT event_id AS doc, * FROM events ORDER BY event_id LIMIT 1000), {EVENT_NODES}
{GUIDE_SQL.format(by='')}
""")
def data_guide_sampled(spark, sf):
    return _comparable(G.data_guide(event_docs(spark, sf), limit=1000, max_depth=DEPTH))


GEO_NODES = EVENT_NODES.replace("'$.loc', 'object', NULL, NULL FROM e WHERE doc % 5 <> 0", """'$.loc',
    CASE WHEN doc % 3 = 0 THEN 'object' ELSE 'geojson' END, NULL, NULL FROM e WHERE doc % 5 <> 0""").replace(
    "'Point' FROM e WHERE doc % 5 <> 0", "'Spot' FROM e WHERE doc % 5 <> 0 AND doc % 3 = 0"
).replace("'array', NULL, NULL FROM e WHERE doc % 5 <> 0", "'array', NULL, NULL FROM e WHERE doc % 5 <> 0 AND doc % 3 = 0").replace(
    "NULL FROM e WHERE doc % 5 <> 0)", "NULL FROM e WHERE doc % 5 <> 0 AND doc % 3 = 0)"
)


@query("data_guide_geo", f"""
WITH e AS (SELECT event_id AS doc, * FROM events), {GEO_NODES} {GUIDE_SQL.format(by='')}
""")
def data_guide_geo(spark, sf):
    """Points are recognised as geometries; objects of their shape but of another type are objects with all that is in them."""
    docs = event_docs(spark, sf)
    spot = F.replace(F.col("doc"), F.lit('"type":"Point"'), F.lit('"type":"Spot"'))
    docs = S.parse_docs(docs.withColumn("doc", F.when(F.col("id") % 3 == 0, spot).otherwise(F.col("doc"))))
    with G.hashed(spark):
        return _comparable(stored(G.data_guide(docs, max_depth=DEPTH, geojson=True), "guide"))


@query("data_guide_cache", f"""
WITH e AS (SELECT event_id AS doc, * FROM events), {EVENT_NODES} {GUIDE_SQL.format(by='')}
""")
def data_guide_cache(spark, sf):
    folder = scratch(spark, "guides")
    docs = event_docs(spark, sf)
    G.cached_data_guide(docs, folder, "events", max_depth=DEPTH)
    return _comparable(G.cached_data_guide(docs, folder, "events", max_depth=DEPTH))


@query("key_volume", """
SELECT sum(3 + 6 + 5 + 4 + 4 + 3 + 8 + 4)::BIGINT AS key_chars,
       sum(3 + 6 + 5 + 4 + 4 + 3 + 8 + 4
           + list_sum(list_transform(range(len(string_split(o_orderpriority, '-'))), lambda i: length(i::VARCHAR))))::BIGINT
         AS with_positions
FROM orders
""")
def key_volume(spark, sf):
    docs = order_docs(spark, sf)
    plain = G.key_volume(docs, max_depth=2)
    every = G.key_volume(docs, max_depth=2, count_positions=True)
    return plain.select("key_chars", every.select("key_chars").scalar().alias("with_positions"))


@query("document_depth", f"""
WITH {LINES} SELECT CASE WHEN max(len(charges)) > 0 THEN 3 ELSE 2 END AS depth FROM lines
""")
def document_depth(spark, sf):
    return G.deepest(line_docs(spark, sf))


@query("path_key", f"""
WITH {LINE_NODES} SELECT DISTINCT collection, path, substr(path, 3) AS key FROM nodes
""")
def path_key_query(spark, sf):
    return line_guide(spark, sf).select("collection", "path", path_key(F.col("path")).alias("key")).distinct()


@query("key_types", f"""
WITH {LINE_NODES}
SELECT collection, substr(path, 3) AS key,
       CASE WHEN count(DISTINCT type) > 1 THEN 'multitype' ELSE min(type) END AS type,
       max(CASE WHEN type = 'string' THEN strlen(txt) END) AS max_length
FROM nodes GROUP BY collection, path
""")
def key_types(spark, sf):
    rows = G.key_types(line_guide(spark, sf), ("collection",))
    text = F.col("type").isin("string", "multitype")
    return rows.select("collection", "key", "type", F.when(text, F.col("max_length")).alias("max_length"))


@query("path_prefixes", f"""
WITH {LINE_NODES}, k AS (SELECT DISTINCT collection, substr(path, 3) AS key FROM nodes)
SELECT collection, key, key AS prefix, '' AS suffix FROM k
UNION ALL SELECT collection, key, split_part(key, '.', 1), split_part(key, '.', 2) FROM k WHERE contains(key, '.')
""")
def path_prefixes_query(spark, sf):
    keys = G.key_types(line_guide(spark, sf), ("collection",)).select("collection", "key")
    return keys.select("collection", "key", F.inline(path_prefixes(F.col("key"))))


@query("mat_paths", f"""
WITH {LINE_NODES}
SELECT DISTINCT collection, substr(path, 3) AS key,
       CASE WHEN split_part(substr(path, 3), '.', 1) IN ('charges', 'flags', 'flags[*]', 'empty')
            THEN 'ARRAY' ELSE 'OTHER' END AS path_type
FROM nodes
""")
def mat_paths(spark, sf):
    return G.mat_paths(line_guide(spark, sf), ("collection",))


# --- index planning --------------------------------------------------------------------


@query("index_keys", f"""
WITH {PART_INDEXES}, c AS (
  SELECT collection, index_name, is_unique, is_ttl, is_text, is_spatial, is_hashed,
         unnest(CASE WHEN len(paths) > 0 THEN list_zip(range(len(paths)), paths, ascs) ELSE [NULL] END) AS k FROM ix)
SELECT collection, index_name, is_unique, is_ttl, is_text, is_spatial, is_hashed,
       k[1]::INTEGER AS pos, k[2] AS path, k[3] AS "asc" FROM c
""")
def index_keys(spark, sf):
    return P.key_columns(part_keys(spark, sf))


@query("index_names", """
SELECT 'lines_' || (p_partkey % 20) || '$ix_' || p_partkey AS table_name FROM part
""")
def index_names(spark, sf):
    return part_keys(spark, sf).select(index_table_name(F.col("collection"), F.col("source_name")).alias("table_name"))


@query("expected_indexes", f"""
WITH {PART_INDEXES}
SELECT collection, count(*) FILTER (NOT is_search) + max(is_search::INTEGER) AS expected_indexes FROM ix GROUP BY 1
""")
def expected_indexes(spark, sf):
    return P.expected_indexes(part_keys(spark, sf))


@query("parallel_arrays", f"""
WITH {PART_INDEXES} SELECT collection, index_name, shape = 5 AS is_parallel FROM ix WHERE len(paths) > 0
""")
def parallel_arrays(spark, sf):
    return P.parallel_arrays(part_keys(spark, sf), line_guide(spark, sf))


@query("index_plan", f"""
WITH {PART_PLAN}
SELECT collection, index_name, kind, status, reasons, is_unique, len(paths)::INTEGER AS n_fields,
       list_aggregate(paths, 'string_agg', ',') AS fields
FROM plan
""")
def index_plan(spark, sf):
    plan = P.index_plan(part_keys(spark, sf), line_guide(spark, sf))
    fields = F.array_join(F.transform("columns", lambda c: c["path"]), ",")
    return plan.select(
        "collection", "index_name", "kind", "status", F.array_join("reasons", ",").alias("reasons"), "is_unique",
        "n_fields", F.when(F.col("n_fields") > 0, fields).alias("fields"),
    )


@query("index_spec", f"""
WITH {PART_PLAN}, {LINES}, built AS (
  SELECT collection, index_name, is_unique, kind,
         unnest(list_zip(range(len(paths)), paths, ascs)) AS k
  FROM plan WHERE status = 'build' AND kind IN ('simple', 'compound', 'simple_mv', 'compound_mv')),
longest AS (
  SELECT collection, max(strlen(l_returnflag)) AS status_len, max(strlen(l_linestatus)) AS line_len,
         max(CASE WHEN l_linenumber = 7 THEN NULL WHEN l_discount > 0 THEN 8 WHEN l_tax > 0 THEN 3 END) AS kind_len
  FROM lines GROUP BY 1)
SELECT b.collection, index_name, is_unique, kind LIKE '%_mv' AS multivalue, k[1]::INTEGER AS pos, k[2] AS path,
       CASE WHEN k[3] THEN 'asc' ELSE 'desc' END AS "order",
       CASE WHEN k[2] IN ('status', 'charges.kind', 'flags') THEN 'string' ELSE 'number' END AS datatype,
       CASE k[2] WHEN 'status' THEN status_len WHEN 'charges.kind' THEN kind_len
                 WHEN 'flags' THEN greatest(status_len, line_len) END AS maxlength,
       b.collection || '$' || index_name AS name
FROM built b LEFT JOIN longest l USING (collection)
""")
def index_spec(spark, sf):
    specs = P.index_spec(P.index_plan(part_keys(spark, sf), line_guide(spark, sf)))
    schema = (
        "name string, fields array<struct<path:string,order:string,datatype:string,maxlength:bigint>>, "
        "unique boolean, multivalue boolean"
    )
    s = specs.withColumn("s", F.from_json("spec", schema))
    return s.select(
        "collection", "index_name", F.col("s.name").alias("name"), F.col("s.unique").alias("is_unique"),
        F.col("s.multivalue").alias("multivalue"), F.posexplode("s.fields").alias("pos", "f"),
    ).select("collection", "index_name", "name", "is_unique", "multivalue", "pos", "f.*")


# --- shaping ---------------------------------------------------------------------------


@query("json_extract", """
SELECT o_orderkey AS id, o_custkey AS custkey, o_orderpriority AS priority, o_totalprice::DECIMAL(38, 10) AS total FROM orders
""")
def json_extract(spark, sf):
    rows = S.extract(
        order_docs(spark, sf),
        {"custkey": ("cust.key", "number"), "priority": ("cust.priority", "string"), "total": ("total", "number")},
    )
    return rows.withColumn("custkey", F.col("custkey").cast("bigint"))


@query("doc_to_json", """
SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS custkey, len(string_split(o_orderpriority, '-'))::INTEGER AS n_tags
FROM orders
""")
def doc_to_json(spark, sf):
    text = S.to_json_text(order_docs(spark, sf).drop("doc"))
    back = F.from_json("doc", "status string, cust struct<key:bigint>, tags array<string>")
    return text.select("id", back.alias("d")).select(
        "id", F.col("d.status").alias("status"), F.col("d.cust.key").alias("custkey"), F.size("d.tags").alias("n_tags")
    )


@query("json_wrap_unwrap", f"""
WITH {LINES}
SELECT id, c.kind AS kind, c.amount AS amount FROM (
  SELECT id, unnest(CASE WHEN len(charges) > 0 THEN charges ELSE [NULL] END) AS c FROM lines)
""")
def json_wrap_unwrap(spark, sf):
    docs = line_docs(spark, sf)
    typed = F.try_variant_get(field(F.col("data"), "charges"), "$", "array<struct<kind:string,amount:double>>")
    wrapped = S.wrap(docs.select("id", typed.alias("charges")), "charges")
    return S.unwrap(wrapped, "kind string, amount double", ["id"])


@query("assign_id", """
SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS status, true AS has_uuid FROM orders
""")
def assign_id(spark, sf):
    docs = order_docs(spark, sf).drop("id")
    with_uuid = S.assign_id(docs, "uuid").withColumnRenamed("id", "generated")
    return S.assign_id(with_uuid).select(
        "id", only(F.col("data"), "status", "string").alias("status"),
        F.col("generated").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("has_uuid"),
    )


@query("system_columns", """
SELECT o_orderkey AS id, '1' AS version, true AS stamped FROM orders
""")
def system_columns(spark, sf):
    rows = S.with_system_columns(order_json(spark, sf))
    stamped = F.col("last_modified").isNotNull() & (F.col("last_modified") == F.col("created_on"))
    return rows.select("id", "version", stamped.alias("stamped"))


@query("materialise_id", """
SELECT lower(printf('%08x', floor(epoch(ts))::BIGINT) || printf('%016x', event_id)) AS id, user_id FROM events
""")
def materialise_id(spark, sf):
    rows = S.materialise_id(event_docs(spark, sf).drop("id"))
    return rows.select("id", only(F.col("data"), "user", "number", spark_type="bigint").alias("user_id"))


def broken_events(spark, sf) -> DataFrame:
    """Events whose text is cut on every 7th row and repeats a key on every 7th plus one."""
    n = F.pmod("event_id", F.lit(7))
    doc = F.when(n == 0, F.expr("substr(props, 1, length(props) - 1)")).when(
        n == 1, F.concat(F.expr("substr(props, 1, length(props) - 1)"), F.lit(',"k":-1}'))
    ).otherwise(F.col("props"))
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), doc.alias("doc"))


@query("invalid_docs", "SELECT event_id AS id FROM events WHERE event_id % 7 IN (0, 1)")
def invalid_docs(spark, sf):
    return S.invalid_docs(broken_events(spark, sf)).select("id")


@query("duplicate_keys", """
SELECT event_id AS id, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE json_extract(props, '$.k')::BIGINT END AS k
FROM events
""")
def duplicate_keys(spark, sf):
    lenient = spark.newSession()  # the policy is a session setting; the caller's stays as it is
    S.duplicate_key_policy(lenient, allow=True)
    docs = S.parse_docs(broken_events(lenient, sf))
    return docs.select("id", F.try_variant_get("data", "$.k", "bigint").alias("k"))

