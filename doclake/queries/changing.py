"""Contract queries: derived rows under inserts, updates and deletions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from doclake.operators.indexes import array_view, text_postings
from doclake.operators.shape import parse_docs
from doclake.plans.ranges import key_at_share
from doclake.queries.documents import order_json, table
from doclake.queries.loading import COUNTER, _counter
from doclake.queries.registry import query
from doclake.runtime import scratch, ship_package, stored
from doclake.streaming import changes as C
from doclake.streaming.counters import stream_counter_rate

CHANGES = "id bigint, version bigint, deleted boolean, doc string"


def streamed(spark, name: str, ids: DataFrame, derive: C.Derive, steps: list[DataFrame], compact_after: int) -> DataFrame:
    """The table after a stream of changes that stops after each step and goes on from its checkpoint."""
    inbox, lake, checkpoint = scratch(spark, f"{name}-changes"), scratch(spark, name), scratch(spark, f"{name}-checkpoint")
    C.create(ids, lake)
    for step in steps:
        step.write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(CHANGES).parquet(inbox)
        C.start_change_sync(arriving, lake, checkpoint, derive, None, compact_after).awaitTermination()
    return C.current(spark, lake)


def change(rows: DataFrame, version: int, doc: Column, deleted: Column | None = None) -> DataFrame:
    gone = F.lit(False) if deleted is None else deleted
    return rows.select("id", F.lit(version).cast("bigint").alias("version"), gone.alias("deleted"), doc.alias("doc"))


@query("text_index_changes", """
WITH last AS (SELECT doc_id AS id, CASE WHEN doc_id % 77 = 0 THEN 'back again' WHEN doc_id % 11 = 0 THEN NULL
    WHEN doc_id % 10 = 0 THEN text || ' changed and changed' WHEN doc_id % 13 = 0 THEN 'written anew' ELSE text END AS text FROM documents),
t AS (SELECT id, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS token FROM last)
SELECT token, id, count(*) AS tf FROM t WHERE token <> '' GROUP BY ALL
""")
def text_index_changes(spark, sf):
    """Insertions; updates and deletions; older changes that come late; returning documents."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    n = F.col("id")
    steps = [
        change(docs, 1, F.col("text")),
        change(docs.filter((n % 10 == 0) | (n % 11 == 0)), 3, F.concat("text", F.lit(" changed and changed")), n % 11 == 0),
        change(docs.filter(n % 13 == 0), 2, F.lit("written anew")),
        change(docs.filter(n % 77 == 0), 4, F.lit("back again")),
    ]
    return streamed(spark, "postings", docs, lambda d: text_postings(d, "doc"), steps, 2)


@query("array_view_changes", """
WITH bounds AS (SELECT quantile_disc(o_orderkey, 0.25) AS low FROM orders),
last AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey <= low AND o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS status,
    o_orderpriority FROM orders, bounds WHERE NOT (o_orderkey <= low AND o_orderkey % 4 = 0))
SELECT id, status, unnest(string_split(o_orderpriority, '-')) AS tag FROM last
""")
def array_view_changes(spark, sf):
    """Changes in the first quarter of the orders only, as they come: twice there, compacted each time."""
    orders = order_json(spark, sf)
    low = key_at_share(orders.select("id"), "id", 0.25)
    first = orders.filter(F.col("id") <= F.lit(low).cast("bigint"))
    changed = F.regexp_replace("doc", '"status":"[^"]*"', '"status":"X"')

    def derive(docs: DataFrame) -> DataFrame:
        return array_view(parse_docs(docs), [("status", "string"), ("tags", "string")], {"tags"})

    steps = [
        change(orders, 1, F.col("doc")),
        change(first.filter(F.col("id") % 3 == 0), 2, changed),
        change(first.filter(F.col("id") % 4 == 0), 3, F.lit(None).cast("string"), F.lit(True)),
    ]
    return streamed(spark, "view", orders, derive, steps, 1).withColumnRenamed("tags", "tag")


PERIODS = ["2024-01-09", "2024-01-17", "2024-01-25", "2030-01-01"]


@query("counter_rate_stream", f"""
WITH {COUNTER}, p AS (SELECT *, CASE {" ".join(f"WHEN ts < '{d}' THEN {i}" for i, d in enumerate(PERIODS))} END AS period FROM c),
held AS (SELECT *, event_id % 97 = 0 AND period < 3 AND EXISTS (SELECT 1 FROM p o WHERE o.event_type = p.event_type AND o.period < 3
  AND o.event_id % 97 <> 0 AND (o.ts, o.event_id) > (p.ts, p.event_id)) AS late FROM p),
l AS (SELECT *, row_number() OVER w AS turn, total - lag(total) OVER w AS delta,
    (epoch_us(ts) - lag(epoch_us(ts)) OVER w) / 1000000.0 AS secs
  FROM held WHERE NOT late WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)),
r AS (SELECT *, CASE WHEN turn > 2 AND secs > 0 THEN delta / 1048576.0 / secs END AS rate FROM l)
SELECT event_type, event_id, round(rate, 6) AS rate,
  round(max(CASE WHEN rate >= 0 THEN rate END) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS max_rate, false AS late FROM r
UNION ALL SELECT event_type, event_id, NULL, NULL, true FROM held WHERE late
""")
def counter_rate_stream(spark, sf):
    """Samples that arrive in four steps, every 97th of the first three only with the last: too late, mostly."""
    ship_package(spark)
    samples = stored(_counter(spark, sf).select("event_type", "ts", "total", "event_id"), "samples")
    inbox, out, checkpoint = scratch(spark, "samples-in"), scratch(spark, "rates"), scratch(spark, "rates-checkpoint")
    withheld, before = (F.col("event_id") % 97 == 0) & (F.col("ts") < PERIODS[2]), "1970-01-01"
    for day in PERIODS:
        step = samples.filter((F.col("ts") >= before) & (F.col("ts") < day) & ~withheld)
        if day == PERIODS[-1]:
            step = step.unionByName(samples.filter(withheld))
        step.write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(samples.schema).parquet(inbox)
        rates = stream_counter_rate(arriving, "event_type", "ts", "total", "event_id")
        writer = rates.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        before = day
    back = spark.read.parquet(out)
    return back.withColumns({"rate": F.round("rate", 6), "max_rate": F.round("max_rate", 6)})
