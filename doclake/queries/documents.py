"""Document collections derived from the tables, row by row (no grouping, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doclake.operators.shape import parse_docs
from doclake.runtime import spread


COLLECTIONS = 20


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def seconds(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def line_json(spark: SparkSession, sf: str) -> DataFrame:
    """One document per line item, spread over collections `lines_0` … `lines_19` by part.

    {"_id", "status", "qty", "price", "item": {"part", "supp"},
     "charges": [{"kind", "amount"}], "flags": [..], "empty": [], "mixed": text or number}

    `charges` can be empty or missing, `flags` is a scalar array, `empty` has no
    element anywhere, `mixed` has two types.
    """
    li = spread(table(spark, sf, "lineitem"))

    def charge(kind: str, amount: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.col(amount).alias("amount"))

    charges = F.filter(
        F.array(charge("discount", "l_discount"), charge("tax", "l_tax")), lambda c: c["amount"] > 0
    )
    line_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    doc = F.struct(
        line_id.alias("_id"),
        F.col("l_returnflag").alias("status"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("price"),
        F.struct(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp")).alias("item"),
        F.when(F.col("l_linenumber") != 7, charges).alias("charges"),
        F.array("l_returnflag", "l_linestatus").alias("flags"),
    )
    mixed = F.when(F.col("l_linenumber") % 2 == 0, F.lit('"even"')).otherwise(F.col("l_linenumber").cast("string"))
    text = F.concat(F.lit('{"empty":[],"mixed":'), mixed, F.lit(","), F.substr(F.to_json(doc), F.lit(2)))
    return li.select(
        F.concat(F.lit("lines_"), F.pmod("l_partkey", F.lit(COLLECTIONS)).cast("string")).alias("collection"),
        line_id.alias("id"), text.alias("doc"),
    )


def line_docs(spark: SparkSession, sf: str) -> DataFrame:
    return parse_docs(line_json(spark, sf))


def order_json(spark: SparkSession, sf: str) -> DataFrame:
    """{"_id", "status", "total", "date", "cust": {"key", "priority"}, "tags": [..]}, one per order."""
    o = spread(table(spark, sf, "orders"))
    doc = F.struct(
        F.col("o_orderkey").alias("_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.struct(F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("priority")).alias("cust"),
        F.split("o_orderpriority", "-").alias("tags"),
    )
    return o.select(F.col("o_orderkey").alias("id"), F.to_json(doc).alias("doc"))


def order_docs(spark: SparkSession, sf: str) -> DataFrame:
    return parse_docs(order_json(spark, sf))


def event_oid() -> Column:
    """24 hex digits: creation second, then the event number."""
    return F.concat(F.lpad(F.lower(F.hex(seconds("ts"))), 8, "0"), F.lpad(F.lower(F.hex("event_id")), 16, "0"))


def event_docs(spark: SparkSession, sf: str) -> DataFrame:
    """{"_id": object id, "user", "kind", "props": {"k"}, "loc": GeoJSON point}, one per event; some lack `loc`."""
    e = spread(table(spark, sf, "events"))
    point = F.struct(
        F.lit("Point").alias("type"),
        F.array(
            (F.pmod("user_id", F.lit(360)) - 180).cast("double"),
            F.greatest(F.lit(-90.0), F.least(F.lit(90.0), F.col("value"))),
        ).alias("coordinates"),
    )
    doc = F.struct(
        event_oid().alias("_id"),
        F.col("user_id").alias("user"),
        F.col("event_type").alias("kind"),
        F.from_json("props", "k bigint").alias("props"),
        F.when(F.col("event_id") % 5 != 0, point).alias("loc"),
    )
    return parse_docs(e.select(F.col("event_id").alias("id"), F.to_json(doc).alias("doc")))


def shape_docs(spark: SparkSession, sf: str) -> DataFrame:
    """{"_id", "path": LineString, "area": Polygon}, one per event, some across the date line.

    Every fifth has no path, every seventh of the others one without coordinates.
    """
    e = spread(table(spark, sf, "events"))
    n = F.col("event_id")
    x, y = (F.pmod("user_id", F.lit(360)) - 180).cast("double"), F.greatest(F.lit(-90.0), F.least(F.lit(90.0), F.col("value")))

    def at(dx: Column, dy: Column) -> Column:
        return F.array((x + dx + 540) % 360 - 180, F.greatest(F.lit(-90.0), F.least(F.lit(90.0), y + dy)))

    none = F.lit(0)
    line = F.array(at(none, none), at(n % 37 - 18, n % 23 - 11), at(n % 61 - 30, -(n % 19)))
    path = F.struct(F.lit("LineString").alias("type"), F.when(n % 7 == 0, F.array().cast("array<array<double>>")).otherwise(line).alias("coordinates"))
    ring = F.array(at(none, none), at(2 + n % 11, none), at(2 + n % 11, 3 + n % 5), at(none, 3 + n % 5), at(none, none))
    area = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    doc = F.struct(n.alias("_id"), F.when(n % 5 != 0, path).alias("path"), area.alias("area"))
    return parse_docs(e.select(n.alias("id"), F.to_json(doc).alias("doc")))


def text_docs(spark: SparkSession, sf: str) -> DataFrame:
    """{"_id", "lang", "source", "text"}, one per document of the text table."""
    d = spread(table(spark, sf, "documents"))
    doc = F.struct(F.col("doc_id").alias("_id"), "lang", "source", "text")
    return parse_docs(d.select(F.col("doc_id").alias("id"), F.to_json(doc).alias("doc")))


def part_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Index metadata: one index per part, in the collections of `line_json`, of every shape an index can have."""
    p = spread(table(spark, sf, "part"))
    shape = F.pmod("p_partkey", F.lit(len(KEY_SHAPES)))
    key = F.element_at(F.array(*[F.lit(k) for k in KEY_SHAPES]), (shape + 1).cast("int"))
    extra = F.when(F.col("p_partkey") % 5 == 0, ',"unique":true').when(
        F.col("p_partkey") % 7 == 0, ',"expireAfterSeconds":{"$numberLong":"3600"}'
    ).otherwise("")
    text = F.concat(
        F.lit('{"indexes":[{"v":2,"name":"ix.'), F.col("p_partkey").cast("string"), F.lit('","key":'), key, extra,
        F.lit('}],"type":"collection"}'),
    )
    return p.select(
        F.concat(F.lit("lines_"), F.pmod("p_partkey", F.lit(COLLECTIONS)).cast("string")).alias("collection"),
        text.alias("metadata"),
    )


# Key documents in the order of the part number modulo their count.
KEY_SHAPES = [
    '{"status":1}',
    '{"status":-1,"item.part":1.0}',
    '{"qty":{"$numberInt":"1"},"price":{"$numberDouble":"-1.0"}}',
    '{"charges.amount":1}',
    '{"status":1,"charges.kind":-1}',
    '{"charges.kind":1,"flags":1}',
    '{"item":1}',
    '{"nope":1,"status":1}',
    '{"item.part":"hashed"}',
    '{"loc":"2dsphere"}',
    '{"_fts":"text","_ftsx":1}',
    '{"flags":1}',
    '{"charges":1}',
    '{"_id":1}',
    '{"mixed":1}',
    '{"empty":1,"status":1}',
    '{"$**":1}',
]
