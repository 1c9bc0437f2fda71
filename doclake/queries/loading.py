"""Contract queries: dump sources, split planning, selection, sinks, reports, streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from doclake.functions.ids import human_duration, human_size, oid_floor, oid_seconds
from doclake.job import read_documents, run
from doclake.operators import guide as G
from doclake.operators import report as R
from doclake.operators import select as C
from doclake.operators import shape as S
from doclake.operators import sinks as W
from doclake.plans import index_plan as P
from doclake.plans import ranges as B
from doclake.plans.chunks import chunk_plan
from doclake.queries.documents import event_oid, line_docs, order_json, seconds, table
from doclake.queries.fixtures import new_folder, write_dump, write_files
from doclake.queries.indexing import broken_events, line_guide, part_keys
from doclake.queries.oracle_parts import ORDER_BYTES, PART_PLAN
from doclake.queries.registry import query
from doclake.runtime import scratch, spread, stored
from doclake.sources import dump as D
from doclake.streaming import sync

BLOCK = 256 << 10  # small, so that even small dumps are split into several blocks


def order_rows(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "orders")).select(
        F.col("o_orderkey").alias("_id"), F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"), F.col("o_orderdate").alias("date"), F.col("o_orderpriority").alias("priority"),
    )


def order_dump(spark, sf, gz: bool = False) -> str:
    return write_dump(order_rows(spark, sf), "orders", gz)


# --- dump sources ----------------------------------------------------------------------


@query("dump_catalog", f"""
SELECT 'orders' AS family, sum({ORDER_BYTES})::BIGINT AS n_bytes, false AS any_gz FROM orders
""")
def dump_catalog(spark, sf):
    folder = order_dump(spark, sf)
    write_dump(order_rows(spark, sf), "orders", gz=True, folder=folder)  # each twin loses to its plain file
    return D.dump_catalog(spark, folder).groupBy(F.regexp_extract("collection", "^([a-z]+)-", 1).alias("family")).agg(
        F.sum("length").alias("n_bytes"), F.max("is_gz").alias("any_gz")
    )


@query("dump_metadata", """
SELECT 'supp_' || s_suppkey AS collection, (s_suppkey % 3 <> 0)::INTEGER * 2 AS n_indexes,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'by_' || s_name END AS second_name
FROM supplier
""")
def dump_metadata(spark, sf):
    folder = new_folder(spark)
    s = table(spark, sf, "supplier").select(F.concat(F.lit("supp_"), F.col("s_suppkey")).alias("c"), "s_suppkey", "s_name")
    write_files(s.select(F.concat("c", F.lit(".bson")).alias("name"), F.lit("\x05\0\0\0\0").alias("content")), folder)
    text = F.concat(
        F.lit('{"options":{},"indexes":[{"name":"_id_","key":{"_id":1}},{"name":"by_'), F.col("s_name"),
        F.lit('","key":{"s_name":-1},"unique":true}]}'),
    )
    described = s.filter("s_suppkey % 3 <> 0")
    write_files(described.select(F.concat("c", F.lit(".metadata.json")).alias("name"), text.alias("content")), folder)
    return D.dump_metadata(spark, folder).select(
        "collection", F.size("indexes").alias("n_indexes"), F.try_element_at("indexes", F.lit(2))["name"].alias("second_name")
    )


@query("bson_offsets", f"""
SELECT count(*) AS n, sum({ORDER_BYTES})::BIGINT AS n_bytes, min({ORDER_BYTES})::BIGINT AS shortest,
       max({ORDER_BYTES})::BIGINT AS longest FROM orders
""")
def bson_offsets(spark, sf):
    return D.bson_offsets(spark, order_dump(spark, sf), BLOCK).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("n_bytes"),
        F.min("length").alias("shortest"), F.max("length").alias("longest"),
    )


@query("bson_blocks", f"""
SELECT count(*) AS n_docs, sum({ORDER_BYTES})::BIGINT AS n_bytes, 0::BIGINT AS n_errors FROM orders
""")
def bson_blocks(spark, sf):
    files = D.dump_catalog(spark, order_dump(spark, sf))
    return D.bson_blocks(spark, files, BLOCK).agg(
        F.sum("n_docs").alias("n_docs"), F.sum(F.col("stop") - F.col("start")).alias("n_bytes"),
        F.count("error").alias("n_errors"),
    )


@query("chunk_plan", f"""
SELECT count(*) AS n_docs, sum({ORDER_BYTES})::BIGINT AS n_bytes, true AS within_limits FROM orders
""")
def chunk_plan_query(spark, sf):
    plan = chunk_plan(D.bson_offsets(spark, order_dump(spark, sf)), max_bytes=100_000, max_docs=900)
    return plan.agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_bytes").alias("n_bytes"),
        F.every((F.col("n_bytes") <= 100_000) & (F.col("n_docs") <= 900) & F.col("slot").between(0, 255)).alias("within_limits"),
    )


@query("chunk_rows", """
WITH RECURSIVE r AS (SELECT source AS path, strlen(text) + 5 AS length,
  row_number() OVER w - 1 AS i, sum(strlen(text) + 5) OVER w AS stop FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)),
n AS (SELECT a.path, a.i, a.stop - a.length AS start, least(a.i + 40, greatest(a.i, b.i) + 1) AS nxt
  FROM r a ASOF LEFT JOIN r b ON a.path = b.path AND b.stop <= a.stop - a.length + 60000),
c AS (SELECT path, 0 AS chunk_no, i, start, nxt FROM n WHERE i = 0
  UNION ALL SELECT n.path, chunk_no + 1, n.i, n.start, n.nxt FROM c JOIN n ON n.path = c.path AND n.i = c.nxt)
SELECT c.path, chunk_no::BIGINT AS chunk_no, start::BIGINT AS start_offset, count(*) AS n_docs, sum(length)::BIGINT AS n_bytes,
  (chunk_no % 256)::INTEGER AS slot
FROM c JOIN r ON r.path = c.path AND r.i >= c.i AND r.i < c.nxt GROUP BY ALL
""")
def chunk_rows(spark, sf):
    """Every chunk of the texts of each source, taken as files of records in the order of their numbers."""
    rows = table(spark, sf, "documents").select(
        F.col("source").alias("path"), "doc_id", (F.octet_length("text") + 5).cast("bigint").alias("length")
    )
    placed = R.running_sum(rows, ["path"], ["doc_id"], F.col("length"), "stop")
    return chunk_plan(placed.select("path", (F.col("stop") - F.col("length")).alias("offset"), "length"), max_bytes=60_000, max_docs=40)


ORDERS_BACK = """
SELECT o_orderkey AS id, o_custkey AS custkey, o_orderstatus AS status, o_totalprice AS total, o_orderdate AS day,
       o_orderpriority AS priority, {size}::BIGINT AS bson_len FROM orders
"""


def _orders_back(rows: DataFrame) -> DataFrame:
    doc = F.from_json("doc", "custkey bigint, status string, total double, date timestamp, priority string")
    return rows.select(F.col("id").cast("bigint").alias("id"), doc.alias("d"), "bson_len").select(
        "id", "d.custkey", "d.status", "d.total", F.col("d.date").cast("timestamp_ntz").alias("day"), "d.priority", "bson_len"
    )


@query("read_bson", ORDERS_BACK.format(size=ORDER_BYTES))
def read_bson(spark, sf):
    return _orders_back(D.read_bson(spark, order_dump(spark, sf), block_bytes=BLOCK))


@query("read_bson_gz", ORDERS_BACK.format(size=ORDER_BYTES))
def read_bson_gz(spark, sf):
    return _orders_back(D.read_bson(spark, order_dump(spark, sf, gz=True)))


DECODED = """
SELECT '$._id' AS path, 'number' AS type, count(*) AS n, min(o_orderkey)::VARCHAR AS sample FROM orders
UNION ALL SELECT '$.custkey', 'number', count(*), NULL FROM orders
UNION ALL SELECT '$.status', 'string', count(*), min(o_orderstatus) FROM orders
UNION ALL SELECT '$.total', 'double', count(*), NULL FROM orders
UNION ALL SELECT '$.date', 'timestamp', count(*), strftime(min(o_orderdate), '%Y-%m-%dT%H:%M:%S.000Z') FROM orders
UNION ALL SELECT '$.priority', 'string', count(*), min(o_orderpriority) FROM orders
"""


def _shown(guide: DataFrame) -> DataFrame:
    shown = F.col("path").isin("$._id", "$.status", "$.date", "$.priority")
    return guide.select("path", "type", F.col("n_docs").alias("n"), F.when(shown, F.col("low")).alias("sample"))


@query("decode_bson", DECODED)
def decode_bson(spark, sf):
    rows = D.read_bson(spark, order_dump(spark, sf), leaves=True, block_bytes=BLOCK)
    guide = G.guide_of(G.flatten_leaves(rows, ()))
    return _shown(guide)


@query("guide_while_loading", DECODED)
def guide_while_loading(spark, sf):
    rows = D.read_bson_and_parts(spark, order_dump(spark, sf), block_bytes=BLOCK)
    return _shown(G.merge_parts(rows.filter("parts is not null")))


@query("load_counters", f"""
SELECT count(*) AS n_docs, sum({ORDER_BYTES})::BIGINT AS source_bytes, 0::BIGINT AS n_errors FROM orders
""")
def load_counters(spark, sf):
    rows = D.read_bson(spark, order_dump(spark, sf), block_bytes=BLOCK)
    chunk = F.concat_ws("@", "file", F.floor(F.col("offset") / BLOCK).cast("string"))
    return R.merge_counters(R.load_counters(rows, chunk)).select("n_docs", "source_bytes", "n_errors")


@query("load_counters_failed", """
SELECT event_id // 1000 AS chunk, count(*) FILTER (event_id % 7 NOT IN (0, 1)) AS n_docs,
       count(*) FILTER (event_id % 7 IN (0, 1)) AS n_errors FROM events GROUP BY 1
""")
def load_counters_failed(spark, sf):
    rows = S.parse_docs(broken_events(spark, sf)).select(
        "id", "doc", F.octet_length("doc").alias("bson_len"),
        F.when(F.col("data").isNull(), F.lit("malformed")).alias("error"),
    )
    counters = R.load_counters(rows, F.floor(F.col("id") / 1000).cast("bigint"))
    return counters.select("chunk", "n_docs", "n_errors")


# --- split planning --------------------------------------------------------------------


@query("oid_seconds", """
SELECT event_id, floor(epoch(ts))::BIGINT AS second, rpad(printf('%08x', floor(epoch(ts))::BIGINT), 24, '0') AS edge FROM events
""")
def oid_seconds_query(spark, sf):
    second = oid_seconds(event_oid())
    return table(spark, sf, "events").select("event_id", second.alias("second"), oid_floor(second).alias("edge"))


@query("key_bounds", "SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi, count(o_orderkey) AS n FROM orders")
def key_bounds(spark, sf):
    return B.key_bounds(table(spark, sf, "orders"), "o_orderkey")


BUCKETS = """
b AS (SELECT min(floor(epoch(ts))::BIGINT) AS lo, max(floor(epoch(ts))::BIGINT) AS hi FROM events),
w AS (SELECT lo, hi, (SELECT min(8 * (1::BIGINT << i)) FROM range(40) r(i) WHERE (hi - lo) // (8 * (1::BIGINT << i)) + 1 <= {cap}) AS width FROM b)
"""


@query("bucket_size", f"WITH {BUCKETS.format(cap=100000)} SELECT lo, hi, width FROM w")
def bucket_size(spark, sf):
    bounds = B.key_bounds(table(spark, sf, "events"), seconds("ts"))
    return bounds.select("lo", "hi", B.bucket_size(F.col("lo"), F.col("hi")).alias("width"))


@query("bucket_counts", f"""
WITH {BUCKETS.format(cap=1000)}, c AS (
  SELECT (floor(epoch(ts))::BIGINT - lo) // width AS bucket, count(*) AS n FROM events, w GROUP BY 1)
SELECT bucket, lo + bucket * width AS lo, least(lo + (bucket + 1) * width, hi + 1) AS hi, n FROM c, w
""")
def bucket_counts(spark, sf):
    return B.bucket_counts(table(spark, sf, "events"), seconds("ts"), cap=1000)


@query("range_scan", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderkey >= (SELECT max(o_orderkey) // 4 FROM orders) AND o_orderkey < (SELECT max(o_orderkey) // 2 FROM orders)
""")
def range_scan(spark, sf):
    orders = table(spark, sf, "orders")
    hi = B.key_bounds(orders, "o_orderkey").first()["hi"]
    return S.range_scan(orders.select("o_orderkey", "o_totalprice"), "o_orderkey", hi // 4, hi // 2)


# --- selection -------------------------------------------------------------------------


@query("select_collections", "SELECT doc_id, source FROM documents WHERE source IN ('src0', 'src3', 'src12')")
def select_collections(spark, sf):
    return C.select_collections(table(spark, sf, "documents").select("doc_id", "source"), "src0, src3,src12", "source")


@query("sample_first", "SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 50")
def sample_first(spark, sf):
    return C.sample_first(table(spark, sf, "documents").select("doc_id", "source"), 50, ["doc_id"])


@query("emptiness", "SELECT count(*) = 0 AS is_empty FROM documents WHERE n_chars < 0")
def emptiness(spark, sf):
    return W.is_empty(table(spark, sf, "documents").filter("n_chars < 0"))


@query("collection_option", """
SELECT DISTINCT source AS collection,
       CASE WHEN source IN (SELECT source FROM documents WHERE doc_id % 40 = 0) THEN 'UUID' ELSE 'EMBEDDED_OID' END AS "ID"
FROM documents
""")
def collection_option(spark, sf):
    d = table(spark, sf, "documents")
    options = d.filter("doc_id % 40 = 0").select(F.concat("source", F.lit(".ID")).alias("key"), F.lit("UUID").alias("value"))
    return C.collection_option(d.select(F.col("source").alias("collection")).distinct(), options, "ID", "EMBEDDED_OID")


@query("catalog_counts", f"""
WITH {PART_PLAN}, c AS (SELECT DISTINCT 'lines_' || (l_partkey % 20) AS collection FROM lineitem)
SELECT collection, count(index_name) AS n_indexes FROM c LEFT JOIN plan USING (collection) GROUP BY 1
""")
def catalog_counts(spark, sf):
    collections = line_docs(spark, sf).select("collection").distinct()
    return C.catalog_counts(collections, part_keys(spark, sf))


# --- volumes and reports ---------------------------------------------------------------


@query("doc_count", "SELECT source, count(*) AS n_docs FROM documents GROUP BY 1")
def doc_count(spark, sf):
    return R.doc_count(table(spark, sf, "documents"), ("source",))


@query("volume", """
SELECT source, count(*) AS n_docs, sum(strlen(text))::BIGINT AS n_bytes, round(avg(strlen(text)), 6) AS avg_bytes,
       (count(*) * floor(avg(strlen(text))))::BIGINT AS estimated_bytes FROM documents GROUP BY 1
""")
def volume(spark, sf):
    d = table(spark, sf, "documents").select("source", F.octet_length("text").alias("bson_len"))
    return R.volume(d, by=("source",)).withColumn("avg_bytes", F.round("avg_bytes", 6))


@query("grouped_counts", "SELECT source, lang, count(*) AS n, sum(n_chars)::BIGINT AS total FROM documents GROUP BY ALL")
def grouped_counts(spark, sf):
    return C.grouped_counts(table(spark, sf, "documents"), ["source", "lang"], F.col("n_chars"))


@query("size_rollup", """
SELECT source AS owner, CASE WHEN lang = 'en' THEN 'table' ELSE 'index' END AS kind, sum(strlen(text))::BIGINT AS n_bytes
FROM documents GROUP BY ALL
""")
def size_rollup(spark, sf):
    d = table(spark, sf, "documents").select(
        F.concat_ws(":", "source", "lang").alias("segment"), "source", "lang", F.octet_length("text").alias("n_bytes")
    )
    owners = d.select(
        "segment", F.col("source").alias("owner"), F.when(F.col("lang") == "en", "table").otherwise("index").alias("kind")
    ).distinct()
    return R.size_rollup(d, owners)


@query("storage_sizes", "SELECT 'documents' AS collection, 'table' AS part, true AS has_bytes, count(*) AS n_rows FROM documents")
def storage_sizes(spark, sf):
    root = scratch(spark, "sizes")
    d = table(spark, sf, "documents")
    W.write_collection(d, f"{root}/documents/table")
    back = spark.read.parquet(f"{root}/documents/table").agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return R.storage_sizes(spark, root).select(
        "collection", "part", (F.col("n_bytes") > 0).alias("has_bytes"), back.alias("n_rows")
    )


COUNTER = """
e AS (SELECT event_type, ts, event_id, (round(value * 100)::BIGINT * 1000000) AS step FROM events),
c AS (SELECT *, sum(step) OVER (PARTITION BY event_type ORDER BY ts, event_id)::BIGINT AS total FROM e)
"""


def _counter(spark, sf) -> DataFrame:
    e = table(spark, sf, "events").select(
        "event_type", "ts", "event_id", (F.round(F.col("value") * 100).cast("bigint") * 1_000_000).alias("step")
    )
    return R.running_sum(e, ["event_type"], ["ts", "event_id"], F.col("step"), "total")


@query("running_sum", f"WITH {COUNTER} SELECT event_type, event_id, total FROM c")
def running_sum(spark, sf):
    return _counter(spark, sf).select("event_type", "event_id", "total")


@query("counter_rate", f"""
WITH {COUNTER}, l AS (
  SELECT *, row_number() OVER w AS turn, total - lag(total) OVER w AS delta,
         (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1000000.0 AS secs
  FROM c WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
r AS (SELECT *, CASE WHEN turn > 2 AND secs > 0 THEN delta / 1048576.0 / secs END AS rate FROM l)
SELECT event_type, event_id, round(rate, 6) AS rate,
       round(max(CASE WHEN rate >= 0 THEN rate END) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS max_rate
FROM r
""")
def counter_rate(spark, sf):
    rates = R.counter_rate(_counter(spark, sf), "event_type", "ts", "total", "event_id")
    return rates.select("event_type", "event_id", F.round("rate", 6).alias("rate"), F.round("max_rate", 6).alias("max_rate"))


@query("progress", """
WITH p AS (SELECT event_type AS collection, count(*) FILTER (event_id % 3 <> 0) AS n_loaded, count(*) AS n_target
           FROM events GROUP BY GROUPING SETS ((event_type), ()))
SELECT collection, n_loaded, n_target, round(100.0 * n_loaded / n_target, 1) AS percent FROM p
""")
def progress(spark, sf):
    e = table(spark, sf, "events").groupBy(F.col("event_type").alias("collection"))
    target = e.agg(F.count(F.lit(1)).alias("n"))
    loaded = e.agg(F.count_if(F.col("event_id") % 3 != 0).alias("n"))
    return R.progress(loaded, target)


@query("human_format", """
WITH v AS (SELECT doc_id, n_chars * 100003 * (1 + doc_id % 7 * doc_id) AS b, n_chars * (doc_id % 50 * 97 + 1) AS ms FROM documents)
SELECT doc_id,
  CASE WHEN b / 1073741824.0 > 1024 THEN printf('%.1f TB', b / 1099511627776.0)
       WHEN b / 1048576.0 > 1024 THEN printf('%.1f GB', b / 1073741824.0)
       ELSE printf('%.1f MB', b / 1048576.0) END AS size,
  CASE WHEN ms < 1000 THEN printf('0.%03ds', ms)
       ELSE trim(CASE WHEN ms // 3600000 > 0 THEN (ms // 3600000) || 'h ' ELSE '' END
              || CASE WHEN ms // 60000 % 60 > 0 THEN (ms // 60000 % 60) || 'm ' ELSE '' END
              || CASE WHEN ms // 1000 % 60 > 0 THEN (ms // 1000 % 60) || 's' ELSE '' END) END AS duration
FROM v
""")
def human_format(spark, sf):
    d = table(spark, sf, "documents")
    size = F.col("n_chars") * 100003 * (1 + F.col("doc_id") % 7 * F.col("doc_id"))
    millis = F.col("n_chars") * (F.col("doc_id") % 50 * 97 + 1)
    return d.select("doc_id", human_size(size).alias("size"), human_duration(millis).alias("duration"))


@query("index_report", f"""
WITH {PART_PLAN}
SELECT collection, collection || '$' || index_name AS table_name, kind, status, len(paths)::INTEGER AS n_fields,
       coalesce(list_aggregate(paths, 'string_agg', ','), '') AS fields, reasons,
       kind IN ('simple_mv', 'compound_mv') AS on_view, hash_bytes AS n_bytes
FROM plan LEFT JOIN (SELECT 'ix_' || p_partkey AS index_name, p_size::BIGINT AS hash_bytes FROM part WHERE p_size > 10) USING (index_name)
""")
def index_report(spark, sf):
    plan = P.index_plan(part_keys(spark, sf), line_guide(spark, sf))
    name = F.format_string("lines_%d$ix_%d", F.col("p_partkey") % 20, F.col("p_partkey"))
    sizes = table(spark, sf, "part").filter("p_size > 10").select(
        name.alias("table_name"), F.col("p_size").cast("bigint").alias("n_bytes")
    )
    return R.index_report(plan, sizes)


@query("failed_indexes", f"""
WITH {PART_PLAN}
SELECT collection, collection || '$' || index_name AS table_name, kind, reasons FROM plan WHERE status = 'failed'
""")
def failed_indexes(spark, sf):
    return R.failed_indexes(R.index_report(P.index_plan(part_keys(spark, sf), line_guide(spark, sf))))


@query("collection_report", f"""
WITH {PART_PLAN},
v AS (SELECT 'lines_' || (l_partkey % 20) AS collection, count(*) AS n_docs, sum(l_quantity)::BIGINT AS source_bytes,
             sum(l_linenumber)::BIGINT AS target_bytes, sum(l_suppkey)::BIGINT AS table_bytes,
             sum(3 + 6 + 3 + 5 + 4 + 4 + 4 + 5 + 5 + 5 + CASE WHEN l_linenumber <> 7 THEN 7 ELSE 0 END
                 + CASE WHEN l_linenumber <> 7 THEN 10 * ((l_discount > 0)::INTEGER + (l_tax > 0)::INTEGER) ELSE 0 END)::BIGINT AS key_chars
      FROM lineitem GROUP BY 1),
i AS (SELECT collection, count(*) FILTER (status = 'build') AS n_indexes, count(*) FILTER (status = 'failed') AS n_failed
      FROM plan GROUP BY 1)
SELECT collection, n_docs, false AS sampled, source_bytes,
       target_bytes, round(100.0 * target_bytes / source_bytes, 1) AS target_pct,
       key_chars, round(100.0 * key_chars / source_bytes, 1) AS key_pct,
       table_bytes, round(100.0 * table_bytes / source_bytes, 1) AS table_pct,
       coalesce(n_indexes, 0) AS n_indexes, coalesce(n_failed, 0) AS n_failed
FROM v LEFT JOIN i USING (collection)
""")
def collection_report(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("collection", F.format_string("lines_%d", F.col("l_partkey") % 20))
    volumes = li.groupBy("collection").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("l_quantity").cast("bigint").alias("n_bytes")
    )
    sizes = li.groupBy("collection").agg(
        F.sum("l_linenumber").alias("target_bytes"), F.sum("l_suppkey").alias("table_bytes")
    )
    nodes = G.flatten(line_docs(spark, sf), 3, ("collection",))
    with G.hashed(spark):  # one walk over the documents for both
        guide = stored(G.guide_of(nodes, ("collection",), names=True), "guide")
    chars = guide.groupBy("collection").agg(F.sum("key_chars").alias("key_chars"))
    plan = P.index_plan(part_keys(spark, sf), guide)
    return R.collection_report(volumes, chars, sizes, plan)


# --- sinks -----------------------------------------------------------------------------


@query("write_collection", """
SELECT o_orderkey AS id, '1' AS version, o_custkey AS custkey, 'created' AS outcome FROM orders
""")
def write_collection(spark, sf):
    path = scratch(spark, "orders")
    outcome = W.write_collection(S.with_system_columns(order_json(spark, sf)), path, level=1)
    docs = S.parse_docs(spark.read.parquet(path))
    return docs.select(
        "id", "version", F.try_variant_get("data", "$.cust.key", "bigint").alias("custkey"), F.lit(outcome).alias("outcome")
    )


@query("load_modes", """
SELECT 1 AS step, 'created' AS outcome, count(*) AS n FROM orders
UNION ALL SELECT 2, 'skipped', count(*) FROM orders
UNION ALL SELECT 3, 'appended', 2 * count(*) FROM orders
UNION ALL SELECT 4, 'replaced', count(*) FROM orders
""")
def load_modes(spark, sf):
    path = scratch(spark, "modes")
    docs = order_json(spark, sf)
    steps = []
    for step, mode in enumerate(("skip", "skip", "append", "drop"), 1):
        outcome = W.write_collection(docs, path, if_exists=mode, level=step - 1)
        # Kept, because the next step changes what there is to count
        n = stored(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")), "mode-count")
        steps.append(n.select(F.lit(step).alias("step"), F.lit(outcome).alias("outcome"), "n"))
    return reduce(DataFrame.unionByName, steps)


@query("json_text_sink", "SELECT o_orderkey AS id, o_custkey AS custkey FROM orders")
def json_text_sink(spark, sf):
    path = scratch(spark, "json")
    W.write_json(S.parse_docs(order_json(spark, sf)), path)
    back = spark.read.schema("_id bigint, cust struct<key:bigint>").json(path)
    return back.select(F.col("_id").alias("id"), F.col("cust.key").alias("custkey"))


@query("report_csv", "SELECT source, count(*) AS n_docs, sum(strlen(text))::BIGINT AS n_bytes FROM documents GROUP BY 1")
def report_csv(spark, sf):
    path = scratch(spark, "csv")
    d = table(spark, sf, "documents").select("source", F.octet_length("text").alias("bson_len"))
    W.write_report_csv(R.volume(d, by=("source",)).select("source", "n_docs", "n_bytes"), path)
    return spark.read.option("sep", ";").option("header", True).schema("source string, n_docs bigint, n_bytes bigint").csv(path)


# --- end to end and streaming ----------------------------------------------------------


def with_indexes(spark, folder: str, metadata: str) -> str:
    """The folder, with the same index metadata beside every collection's dump."""
    names = D.dump_catalog(spark, folder).select(F.concat("collection", F.lit(".metadata.json")).alias("name"))
    write_files(names.withColumn("content", F.lit(metadata)), folder)
    return folder


@query("load_dump", """
SELECT count(*) AS n_docs, sum(o_totalprice)::DECIMAL(20, 2) AS total, 'primary_key:build,simple:build,simple:failed' AS plan FROM orders
""")
def load_dump(spark, sf):
    metadata = (
        '{"indexes":[{"name":"_id_","key":{"_id":1}},{"name":"status_1","key":{"status":1}},{"name":"no","key":{"nope":1}}]}'
    )
    folder, dest = with_indexes(spark, order_dump(spark, sf), metadata), scratch(spark, "lake")
    result = run(spark, folder, dest, block_bytes=256 << 10)
    kinds = result.plan.agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws(":", "kind", "status"))), ",").alias("p"))
    docs = read_documents(spark, dest).select(F.try_variant_get("data", "$.total", "decimal(20,2)").alias("total"))
    return docs.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("total").cast("decimal(20,2)").alias("total")).withColumn(
        "plan", kinds.select("p").scalar()
    )


@query("reload_drop", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_totalprice AS DECIMAL(20, 2)) AS total FROM orders WHERE o_orderstatus = 'F'
""")
def reload_drop(spark, sf):
    """All orders loaded, then dropped for some of them: documents and index hold the second load only."""
    metadata = '{"indexes":[{"name":"total_1","key":{"total":1}}]}'
    some = write_dump(order_rows(spark, sf).filter("status = 'F'"), "orders")
    dest = scratch(spark, "lake")
    run(spark, with_indexes(spark, order_dump(spark, sf), metadata), dest, block_bytes=BLOCK)
    run(spark, with_indexes(spark, some, metadata), dest, if_exists="drop", block_bytes=BLOCK)
    index = spark.read.parquet(f"{dest}/indexes/*").select("id", F.col("total").cast("decimal(20,2)").alias("total"))
    return read_documents(spark, dest).select("id").join(index, "id", "full")


@query("index_name_twins", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS custkey, o_orderstatus AS status FROM orders
""")
def index_name_twins(spark, sf):
    """Index names that differ only by a dot and an underscore give two tables, each with its own key."""
    metadata = '{"indexes":[{"name":"k.1","key":{"custkey":1}},{"name":"k_1","key":{"status":1}}]}'
    dest = scratch(spark, "lake")
    run(spark, with_indexes(spark, order_dump(spark, sf), metadata), dest, block_bytes=BLOCK)
    first, second = (spark.read.parquet(f"{dest}/indexes/*${name}") for name in ("k_1", "k_1~2"))
    return first.join(second, "id", "full").select("id", "custkey", "status")


@query("index_only_types", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS total, CAST(o_orderdate AS TIMESTAMP) AS at FROM orders
""")
def index_only_types(spark, sf):
    """Indexes rebuilt from loaded documents have the types that the load found in the dump."""
    metadata = '{"indexes":[{"name":"at_1","key":{"date":1,"total":1}}]}'
    folder, dest = with_indexes(spark, order_dump(spark, sf), metadata), scratch(spark, "lake")
    run(spark, folder, dest, indexes="skip", block_bytes=BLOCK)
    run(spark, folder, dest, indexes="only")
    return spark.read.parquet(f"{dest}/indexes/*").select("id", "total", F.col("date").alias("at"))


@query("text_index_stream", """
WITH t AS (SELECT doc_id AS id, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS token FROM documents)
SELECT token, id, count(*) AS tf FROM t WHERE token <> '' GROUP BY ALL
""")
def text_index_stream(spark, sf):
    out, checkpoint = scratch(spark, "stream"), scratch(spark, "stream-checkpoint")
    # Braces make the path a pattern, which a stream takes for a single file as well as for a folder of files
    docs = sync.stream_documents(spark, f"{sf}/{{documents.parquet}}", "doc_id bigint, text string")
    docs = docs.withColumnRenamed("doc_id", "id")
    sync.start_text_sync(docs, out, checkpoint, "text", every=None).awaitTermination()
    return sync.synced_postings(spark, out)


@query("array_view_stream", """
SELECT o_orderkey AS id, o_orderstatus AS status, unnest(string_split(o_orderpriority, '-')) AS tag FROM orders
""")
def array_view_stream(spark, sf):
    source, out, checkpoint = scratch(spark, "docs"), scratch(spark, "view"), scratch(spark, "view-checkpoint")
    W.write_collection(order_json(spark, sf), source)
    docs = sync.stream_documents(spark, source, "id bigint, doc string")
    keys = [("status", "string"), ("tags", "string")]
    sync.start_view_sync(docs, out, checkpoint, keys, {"tags"}, every=None).awaitTermination()
    return spark.read.parquet(out).withColumnRenamed("tags", "tag")
