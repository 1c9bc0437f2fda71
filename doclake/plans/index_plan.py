"""Index metadata: parse key documents, classify them against a data guide, describe them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from doclake.functions.ids import clean_index_name, index_table_name, path_prefixes
from doclake.operators.guide import key_types

METADATA = (
    "indexes array<struct<name:string,unique:boolean,key:map<string,string>,expireAfterSeconds:string>>"
)


def parse_metadata(df: DataFrame, text: str = "metadata") -> DataFrame:
    """``indexes`` column from metadata JSON; unknown fields ignored, missing text gives none."""
    parsed = F.from_json(F.col(text), METADATA)["indexes"]
    return df.withColumn("indexes", F.coalesce(parsed, F.expr(f"cast(array() as {METADATA.split(' ', 1)[1]})")))


def _direction(value: Column) -> Column:
    """Number behind a key value, bare or wrapped as ``{"$numberInt": "1"}``."""
    wrapped = F.coalesce(F.get_json_object(value, "$['$numberInt']"), F.get_json_object(value, "$['$numberDouble']"))
    return F.coalesce(wrapped, value).try_cast("double")


def index_keys(meta: DataFrame) -> DataFrame:
    """One row per index with its ordered key columns and flags.

    The key document keeps its order as a map. Entries from the text marker on
    are dropped, hashed entries give a flag but no column.
    """
    ix = meta.select("collection", F.posexplode("indexes").alias("index_pos", "ix"))
    entries = F.map_entries("ix.key")
    with_pos = F.transform(entries, lambda e, i: F.struct(i.alias("i"), e["key"].alias("k"), e["value"].alias("v")))
    text_at = F.array_min(
        F.transform(F.filter(with_pos, lambda e: (e["k"] == "_fts") & (e["v"] == "text")), lambda e: e["i"])
    )
    ix = ix.select("collection", "index_pos", "ix", with_pos.alias("entries"), text_at.alias("text_at"))
    live = F.filter("entries", lambda e: F.col("text_at").isNull() | (e["i"] < F.col("text_at")))
    ix = ix.withColumn("entries", live)
    plain = F.filter("entries", lambda e: e["v"] != "hashed")
    columns = F.transform(
        plain,
        lambda e, p: F.struct(
            p.alias("pos"), e["k"].alias("path"),
            ((e["v"] == "2dsphere") | F.coalesce(_direction(e["v"]) == 1, F.lit(False))).alias("asc"),
        ),
    )
    ttl = F.col("ix.expireAfterSeconds")
    # Names that differ only by `.` and `_` become one: the second gets a mark, so that each has a table of its own
    clean = clean_index_name(F.col("ix.name"))
    ix = ix.withColumn("twin", F.row_number().over(Window.partitionBy("collection", clean).orderBy("index_pos")))
    return ix.select(
        "collection",
        "index_pos",
        F.when(F.col("twin") > 1, F.concat(clean, F.lit("~"), F.col("twin").cast("string"))).otherwise(clean).alias("index_name"),
        F.col("ix.name").alias("source_name"),
        F.coalesce("ix.unique", F.lit(False)).alias("is_unique"),
        ttl.isNotNull().alias("is_ttl"),
        F.coalesce(F.get_json_object(ttl, "$['$numberLong']"), ttl).try_cast("bigint").alias("ttl_seconds"),
        F.col("text_at").isNotNull().alias("is_text"),
        F.exists("entries", lambda e: e["v"] == "2dsphere").alias("is_spatial"),
        F.get(F.filter("entries", lambda e: e["v"] == "2dsphere"), F.lit(0))["k"].alias("spatial_path"),
        F.exists("entries", lambda e: e["v"] == "hashed").alias("is_hashed"),
        columns.alias("columns"),
    )


def is_search(name: Column, is_text: Column, columns: Column) -> Column:
    """Text keys and wildcard indexes, the latter known by ``$**`` in their name or key."""
    return is_text | name.contains("$**") | F.exists(columns, lambda c: c["path"].contains("$**"))


def key_columns(keys: DataFrame) -> DataFrame:
    """One row per (index, key position)."""
    return keys.select(
        "collection", "index_name", "is_unique", "is_ttl", "is_text", "is_spatial", "is_hashed",
        F.inline_outer("columns"),
    )


def expected_indexes(keys: DataFrame) -> DataFrame:
    """Per collection: every non-search index plus one for all search indexes together."""
    search = is_search(F.col("source_name"), F.col("is_text"), F.col("columns"))
    return keys.groupBy("collection").agg(
        (F.count_if(~search) + F.max(search.cast("int"))).cast("bigint").alias("expected_indexes")
    )


def _longest(paths: Column) -> Column:
    return F.aggregate(paths, F.lit(""), lambda acc, p: F.when(F.length(p) > F.length(acc), p).otherwise(acc))


def is_parallel(array_paths: Column) -> Column:
    """True when array paths do not lie on one chain below the longest of them."""
    deepest = _longest(array_paths)
    return F.exists(
        array_paths, lambda p: ~((p == deepest) | F.startswith(deepest, F.concat(p, F.lit("."))))
    )


def _facts(keys: DataFrame, types: DataFrame) -> DataFrame:
    """Per index: its columns with types, and every array path its keys pass through.

    Each key path looks up itself, its element form and all its ancestors in
    one equi-join; groups are one index wide (an index has few columns).
    """
    cols = keys.select("collection", "index_name", F.inline("columns"))
    wanted = F.concat(
        F.transform(path_prefixes(F.col("path")), lambda p: p["prefix"]),
        F.array(F.concat("path", F.lit("[*]"))),
    )
    lookups = cols.select("*", F.explode(wanted).alias("key"))
    joined = lookups.join(
        types.select("collection", "key", F.col("type").alias("found"), "spark_type", "max_length"),
        ["collection", "key"],
        "left",
    )
    own, elem = F.col("key") == F.col("path"), F.col("key") == F.concat("path", F.lit("[*]"))
    per_column = joined.groupBy("collection", "index_name", "pos", "path", "asc").agg(
        F.max(F.when(own, F.col("found"))).alias("own_type"),
        F.max(F.when(elem, F.col("found"))).alias("elem_type"),
        F.max(F.when(own, F.col("spark_type"))).alias("own_spark"),
        F.max(F.when(elem, F.col("spark_type"))).alias("elem_spark"),
        F.max(F.when(own, F.col("max_length"))).alias("own_length"),
        F.max(F.when(elem, F.col("max_length"))).alias("elem_length"),
        F.sort_array(F.collect_set(F.when(~elem & (F.col("found") == "array"), F.col("key")))).alias("arrays"),
    )
    is_array = F.col("own_type") == "array"
    column = F.struct(
        "pos", "path", "asc",
        F.when(is_array, F.col("elem_type")).otherwise(F.col("own_type")).alias("type"),
        F.when(is_array, F.col("elem_spark")).otherwise(F.col("own_spark")).alias("spark_type"),
        F.when(is_array, F.col("elem_length")).otherwise(F.col("own_length")).alias("max_length"),
        "arrays",
    )
    return per_column.groupBy("collection", "index_name").agg(
        F.sort_array(F.collect_list(column)).alias("typed"),
        F.array_distinct(F.flatten(F.collect_list("arrays"))).alias("arrays"),
        F.max(F.col("own_type").isNull()).alias("has_unknown"),
        F.max(F.coalesce((F.col("own_type") == "multitype") | (F.col("elem_type") == "multitype"), F.lit(False))).alias("has_multi"),
        F.max(F.coalesce(F.col("own_type").isin("object", "geojson"), F.lit(False))).alias("has_object"),
        F.max(F.coalesce(is_array & F.col("elem_type").isNull(), F.lit(False))).alias("has_orphan"),
    )


def parallel_arrays(keys: DataFrame, guide: DataFrame) -> DataFrame:
    """Per index with columns: whether its keys run through arrays on different branches."""
    facts = _facts(keys, key_types(guide, ("collection",)))
    return facts.select("collection", "index_name", is_parallel(F.col("arrays")).alias("is_parallel"))


def index_plan(keys: DataFrame, guide: DataFrame, multivalue: bool = False) -> DataFrame:
    """What becomes of every index: kind, status, reasons and typed columns.

    ``guide`` carries a ``collection`` column. With ``multivalue`` a single
    array key gets a multivalue index instead of an array view.
    """
    facts = _facts(keys, key_types(guide, ("collection",)))
    j = keys.join(facts, ["collection", "index_name"], "left")
    n = F.size("columns")
    no = F.lit(False)
    parallel = F.coalesce(is_parallel(F.col("arrays")), no)
    in_array = F.coalesce(F.size("arrays") > 0, no)
    search = is_search(F.col("source_name"), F.col("is_text"), F.col("columns"))
    primary = (n == 1) & (F.col("columns")[0]["path"] == "_id")

    def when_found(flag: str, reason: str) -> Column:
        return F.when(~parallel & F.coalesce(F.col(flag), no), reason)

    rejections = F.filter(
        F.array(
            when_found("has_unknown", "unknown type"),
            when_found("has_multi", "multitype"),
            when_found("has_object", "object"),
            when_found("has_orphan", "orphan array"),
            F.when(parallel, "parallel arrays"),
        ),
        lambda r: r.isNotNull(),
    )
    j = j.withColumn(
        "reasons",
        F.when(F.col("is_ttl"), F.array(F.lit("ttl")))
        .when(search | F.col("is_spatial") | primary, F.array().cast("array<string>"))
        .when(n == 0, F.array(F.lit("sharded")))
        .otherwise(rejections),
    )
    single = n == 1
    kind = (
        F.when(F.col("is_ttl"), "ttl")
        .when(search, "json_search")
        .when(F.col("is_spatial"), "geo_json")
        .when(primary, "primary_key")
        .when(n == 0, "sharded")
        .when((F.size("reasons") == 0) & in_array & single, "multivalue" if multivalue else "simple_mv")
        .when((F.size("reasons") == 0) & in_array, "compound_mv")
        .when(single, "simple")
        .otherwise("compound")
    )
    status = F.when(F.col("is_ttl"), "skipped").when(F.size("reasons") > 0, "failed").otherwise("build")
    untyped = F.transform(
        "columns",
        lambda c: F.struct(
            c["pos"].alias("pos"), c["path"].alias("path"), c["asc"].alias("asc"),
            F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("spark_type"),
            F.lit(None).cast("bigint").alias("max_length"), F.array().cast("array<string>").alias("arrays"),
        ),
    )
    plan = j.select(
        "collection", "index_name", kind.alias("kind"), status.alias("status"), "reasons",
        "is_unique", n.alias("n_fields"), F.coalesce("typed", untyped).alias("columns"),
        "spatial_path", "index_pos",
    )
    # All search indexes of a collection are one: the first stays, the others are merged into it.
    # Taken from the keys alone, so that the guide is not computed a second time.
    first = keys.filter(~F.col("is_ttl") & search).groupBy("collection").agg(
        F.min(F.struct("index_pos", "index_name")).alias("first_search")
    )
    plan = plan.join(first, "collection", "left")
    merged = (F.col("kind") == "json_search") & (F.struct("index_pos", "index_name") > F.col("first_search"))
    return plan.withColumns(
        {
            "status": F.when(merged, "skipped").otherwise(F.col("status")),
            "reasons": F.when(merged, F.array(F.lit("merged search index"))).otherwise(F.col("reasons")),
        }
    ).drop("first_search", "index_pos")


def index_spec(plan: DataFrame, profile: str = "typed") -> DataFrame:
    """JSON description of every buildable path index, in key order.

    ``typed`` names each column's type and, for strings, its longest length;
    ``json`` leaves the type open.
    """
    if profile not in ("typed", "json"):
        raise ValueError(f"unknown profile {profile!r}: typed or json")
    build = plan.filter("status = 'build' and kind in ('simple', 'compound', 'simple_mv', 'compound_mv', 'multivalue')")

    def describe(c: Column) -> Column:
        text = c["type"] == "string"
        return F.struct(
            c["path"].alias("path"),
            F.when(c["asc"], "asc").otherwise("desc").alias("order"),
            (F.lit("json") if profile == "json" else c["type"]).alias("datatype"),
            (F.lit(None).cast("bigint") if profile == "json" else F.when(text, c["max_length"])).alias("maxlength"),
        )

    spec = F.struct(
        index_table_name(F.col("collection"), F.col("index_name")).alias("name"),
        F.transform("columns", describe).alias("fields"),
        F.col("is_unique").alias("unique"),
        F.col("kind").isin("multivalue", "simple_mv", "compound_mv").alias("multivalue"),
    )
    return build.select("collection", "index_name", spec.alias("s")).select(
        "collection", "index_name", F.to_json("s").alias("spec")
    )
