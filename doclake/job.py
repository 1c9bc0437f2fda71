"""One call from a dump folder to queryable tables, indexes and reports."""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from doclake.operators import geometry as Geo
from doclake.operators import guide as G
from doclake.operators import indexes as I
from doclake.operators import report as R
from doclake.operators.select import select_collections
from doclake.operators.shape import with_keys, with_system_columns
from doclake.operators.sinks import codec, read_collection
from doclake.plans.index_plan import expected_indexes, index_keys, index_plan, index_spec
from doclake.runtime import children, remove, scratch_scope, stored
from doclake.sources.dump import (
    BLOCK_BYTES, BLOCK_FACTS, PARTS, dump_catalog, dump_metadata, misread, read_bson_and_parts, read_once,
    without_blocks,
)

LOG = logging.getLogger(__name__)
# The schema is stated so that a collection named `007` stays text.
DOCUMENTS = (
    "id string, version string, data variant, doc string, bson_len bigint, json_len bigint, last_modified timestamp, "
    "created_on timestamp, file string, offset bigint, collection string, part string"
)
#: What a load writes in one go, by ``part``: documents stay, the rest is taken out and removed.
STAGED = DOCUMENTS.replace(", collection", ", error string, parts " + PARTS + ", block " + BLOCK_FACTS + ", collection")
PARALLEL_BUILDS = 4
DYNAMIC = {"partitionOverwriteMode": "dynamic"}


@dataclass
class Result:
    loaded: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    collections: DataFrame | None = None
    indexes: DataFrame | None = None
    plan: DataFrame | None = None
    specs: DataFrame | None = None  # JSON description of every index that was built on paths
    expected: DataFrame | None = None  # how many indexes each collection should have


def documents_path(dest: str) -> str:
    return f"{dest}/documents"


def read_documents(spark: SparkSession, dest: str, collections: list[str] | None = None) -> DataFrame:
    """Stored documents; only the folders of the named collections are read.

    ``data`` is the document as VARIANT. Parquet holds it shredded: Spark finds the common paths of a file when it writes
    it, and a query of a path reads that path's column only. ``doc`` is the text of a document that is no valid VARIANT,
    else null; ``json_len`` the bytes of the text.
    """
    stored_docs = spark.read.schema(DOCUMENTS).parquet(documents_path(dest)).filter("part = 'documents'").drop("part")
    return select_collections(stored_docs, collections)


def _clear(spark: SparkSession, dest: str, names: list[str], known: list[str], tables: tuple[str, ...]) -> None:
    """Remove what ``dest`` holds of the named collections: their part of each table, and their index tables.

    Overwriting replaces only partitions that get rows, so a collection that has become empty would keep its old ones.
    """
    for table in tables:
        for folder, name in children(spark, f"{dest}/{table}"):
            if name.removeprefix("collection=") in names and name.startswith("collection="):
                remove(spark, folder)
    for folder, name in children(spark, f"{dest}/indexes") + children(spark, f"{dest}/shapes"):
        # Of collections `a` and `a$b`, the longest that fits owns `a$b$c`
        owners = [c for c in {*names, *known} if name.startswith(f"{c}$")]
        if owners and max(owners, key=len) in names:
            remove(spark, folder)


def _load(
    spark, source, dest, names, if_exists, sample, level, block_bytes, key_methods, allow_duplicate_keys
) -> tuple[list[str], list[str], DataFrame | None]:
    filled = set()
    if read_collection(spark, documents_path(dest)) is not None:
        # One name per collection: catalog-sized, like the names themselves.
        there = read_documents(spark, dest, names).select("collection").distinct()
        filled = {r["collection"] for r in there.collect()}
    skipped = sorted(filled) if if_exists == "skip" else []
    for name in skipped:
        LOG.warning("collection %s already holds rows, skipped", name)
    todo = [n for n in names if n not in skipped]
    if not todo:
        return [], skipped, None
    _clear(spark, dest, todo, names, ("documents", "rejected", "guide", "key_chars"))
    options = {"allow_duplicate_keys": allow_duplicate_keys, "block_bytes": block_bytes}
    if sample is None:
        _write_staged(read_once(spark, source, todo, **options), dest, level, key_methods)
        amended = misread(_staged(spark, dest, todo, "blocks").select("block.*"), block_bytes, allow_duplicate_keys)
        if amended is not None:
            _replace_blocks(spark, dest, todo, level, key_methods, block_bytes, *amended)
    else:
        rows = read_bson_and_parts(spark, source, todo, sample=sample, **options)
        _write_staged(rows.withColumn("block", F.lit(None).cast(BLOCK_FACTS)), dest, level, key_methods)
    bad = _staged(spark, dest, todo, "rejected").select("collection", "file", "offset", "bson_len", "error")
    bad.write.mode("overwrite").options(**DYNAMIC).partitionBy("collection").parquet(f"{dest}/rejected")
    return todo, skipped, _staged(spark, dest, todo, "schema").select("collection", "parts")


def _write_staged(rows: DataFrame, dest: str, level: int, key_methods: dict[str, str], mode: str = "overwrite") -> None:
    """Documents, rejected records and what was learned of schema and blocks, decoded and written in one pass."""
    part = (
        F.when(F.col("doc").isNotNull(), "documents").when(F.col("block").isNotNull(), "blocks")
        .when(F.col("parts").isNotNull(), "schema").otherwise("rejected")
    )
    parsed = rows.withColumns({"part": part, "data": F.try_parse_json("doc")})
    keyed = with_keys(with_system_columns(parsed), key_methods)
    json_len, doc = F.octet_length("doc").cast("bigint"), F.when(F.col("data").isNull(), F.col("doc"))
    columns = [c.split()[0] for c in DOCUMENTS.split(", ")]
    shaped = keyed.withColumn("json_len", json_len).withColumn("doc", doc).select(*columns, "error", "parts", "block")
    shaped.write.mode(mode).options(**codec(level)).options(**DYNAMIC).partitionBy("collection", "part").parquet(documents_path(dest))


def _staged(spark: SparkSession, dest: str, names: list[str], part: str) -> DataFrame:
    rows = spark.read.schema(STAGED).parquet(documents_path(dest))
    return rows.filter(F.col("collection").isin(names) & (F.col("part") == part))


def _replace_blocks(
    spark: SparkSession, dest: str, names: list[str], level: int, key_methods: dict[str, str], block_bytes: int,
    gone: DataFrame, redone: DataFrame,
) -> None:
    """Put rows read again in the place of those of misread blocks; collections without such a block are left alone."""
    rows = spark.read.schema(STAGED).parquet(documents_path(dest)).filter(F.col("collection").isin(names))
    files = {r["path"] for r in gone.select("path").distinct().collect()}  # files, not blocks: catalog-sized
    touched = [r["collection"] for r in rows.filter(F.col("file").isin(sorted(files))).select("collection").distinct().collect()]
    kept = stored(without_blocks(rows.filter(F.col("collection").isin(touched)), gone, block_bytes), "kept")
    kept.write.mode("overwrite").options(**codec(level)).options(**DYNAMIC).partitionBy("collection", "part").parquet(documents_path(dest))
    # A folder of which nothing is kept gets no rows and would stay
    left = {(r["collection"], r["part"]) for r in kept.select("collection", "part").distinct().collect()}
    for folder, name in children(spark, documents_path(dest)):
        for inner, part in children(spark, folder):
            at = (name.removeprefix("collection="), part.removeprefix("part="))
            if at[0] in touched and at not in left:
                remove(spark, inner)
    _write_staged(redone, dest, level, key_methods, "append")


def _drop_staged(spark: SparkSession, dest: str, names: list[str]) -> None:
    """What a load kept beside the documents until everything was made of it."""
    for folder, name in children(spark, documents_path(dest)):
        if name.removeprefix("collection=") in names:
            for inner, part in children(spark, folder):
                if part.startswith("part=") and part != "part=documents":
                    remove(spark, inner)
            if not children(spark, folder):
                remove(spark, folder)


GUIDE = (
    "path string, type string, length bigint, low string, high string, n_docs bigint, n_values bigint, integral boolean, "
    "scale int, collection string"
)


def _kept_guide(spark: SparkSession, dest: str, names: list[str]) -> tuple[DataFrame, DataFrame] | None:
    if None in [read_collection(spark, f"{dest}/{t}") for t in ("guide", "key_chars")]:
        return None
    guide = spark.read.schema(GUIDE).parquet(f"{dest}/guide")
    chars = spark.read.schema("key_chars bigint, collection string").parquet(f"{dest}/key_chars")
    return select_collections(guide, names), select_collections(chars, names)


def _guide(spark: SparkSession, dest: str, docs: DataFrame, names: list[str], staged: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The data guide and the name characters per collection: from the pass that decoded the records, else from what an
    earlier run stored, else from the documents' text (which knows fewer types)."""
    kept = _kept_guide(spark, dest, names) if staged is None else None
    if kept is not None:
        of_guide, of_docs = ({r["collection"] for r in t.select("collection").distinct().collect()} for t in (kept[1], docs))
        if of_guide == of_docs:
            return kept
    if staged is not None:
        guide = G.merge_parts(staged, ("collection",))
        chars = staged.select("collection", F.inline("parts")).groupBy("collection").agg(F.sum("key_chars").alias("key_chars"))
    else:
        flat = G.flatten(docs, None, ("collection",))
        guide = G.guide_of(flat, ("collection",))
        chars = flat.groupBy("collection").agg(F.sum(F.length(F.coalesce("key", F.lit("")))).alias("key_chars"))
    with G.hashed(spark):
        guide = stored(guide, "guide")
    for table, rows in (("guide", guide), ("key_chars", chars)):
        rows.write.mode("overwrite").options(**DYNAMIC).partitionBy("collection").parquet(f"{dest}/{table}")
    return _kept_guide(spark, dest, names)


def _reason(failure: Exception) -> str:
    """The message of a failure, whole but for the engine's stack trace."""
    return str(failure).split("\n\tat ")[0].strip() or type(failure).__name__


def _keys(row: Row) -> tuple[list[I.Key], dict[str, str], set[str]]:
    columns = sorted(row["columns"], key=lambda c: c["pos"])
    keys = [(c["path"], c["type"]) for c in columns]
    types = {c["path"]: c["spark_type"] for c in columns if c["spark_type"]}
    arrays = {a for c in columns for a in c["arrays"] or []}
    return keys, types, arrays


def build_index(docs: DataFrame, row: Row, cell_deg: float = 1.0) -> DataFrame:
    """The index table of one planned index, placed in index order."""
    keys, types, arrays = _keys(row)
    order = [(c["path"], c["asc"]) for c in sorted(row["columns"], key=lambda c: c["pos"])]
    kind = row["kind"]
    if kind == "json_search":
        return I.index_table(I.text_index(docs), [("token", True)])
    if kind == "geo_json":
        return I.index_table(I.spatial_index(docs, row["spatial_path"], cell_deg), [("cell_x", True), ("cell_y", True)])
    if kind == "multivalue":
        path, gtype = keys[0]
        return I.index_table(I.multivalue_index(docs, path, gtype, arrays, types.get(path)), [("value", order[0][1])])
    if kind == "primary_key":
        # 1 and "1" are two keys although their text is one
        kind = F.schema_of_variant(F.try_variant_get("data", "$._id", "variant"))
        keyed = docs.withColumn("_key", F.when(F.col("id").isNotNull(), F.concat(F.coalesce(kind, F.lit("")), F.lit(":"), "id")))
        check = I.primary_key(keyed, "_key").first()
        if check["n_null"] or check["n_duplicate_keys"]:
            raise ValueError(f"primary key has {check['n_null']} nulls and {check['n_duplicate_keys']} duplicates")
        return I.index_table(docs.select("id"), [])
    if arrays:
        rows = I.array_view(docs, keys, arrays, True, types)
    else:
        rows = I.path_index(docs, keys, True, types)
    if row["is_unique"]:
        I.unique_violations(rows, [k for k, _ in keys], fail=True)
    return I.index_table(rows, order)


def run(
    spark: SparkSession,
    source: str,
    dest: str,
    collections: str | list[str] | None = None,
    if_exists: str = "skip",
    indexes: str = "all",
    sample: int | None = None,
    multivalue: bool = False,
    level: int = 2,
    cell_deg: float = 1.0,
    block_bytes: int = BLOCK_BYTES,
    key_methods: dict[str, str] | None = None,
    allow_duplicate_keys: bool = False,
) -> Result:
    """Load a dump folder, infer the schema, build what indexes can be built, report.

    ``if_exists``: ``skip`` or ``drop`` collections that already hold rows; dropping replaces their documents, rejected
    records, guide and indexes, also by nothing.
    ``indexes``: ``all``, ``skip`` (load only) or ``only`` (build from loaded documents, with the guide of their load).
    ``key_methods``: per collection ``EMBEDDED_OID`` (the default) or ``UUID``.
    ``allow_duplicate_keys``: the last of repeated keys of an object wins, instead of rejecting the record.
    """
    for name, method in (key_methods or {}).items():
        if method not in ("EMBEDDED_OID", "UUID"):
            raise ValueError(f"unknown key method {method!r} of {name}: EMBEDDED_OID or UUID")
    if if_exists not in ("skip", "drop"):
        raise ValueError(f"unknown if_exists {if_exists!r}: skip or drop")
    if indexes not in ("all", "skip", "only"):
        raise ValueError(f"unknown indexes {indexes!r}: all, skip or only")
    if indexes == "only" and if_exists == "drop":
        raise ValueError("indexes='only' builds from loaded documents and cannot drop them")
    started = time.monotonic()
    result = Result()
    catalog = select_collections(dump_catalog(spark, source), collections)
    names = sorted(r["collection"] for r in catalog.select("collection").collect())
    with scratch_scope(spark):  # the decoded dump goes once its documents and its guide are written
        if indexes == "only":
            result.loaded, staged = names, None
            _clear(spark, dest, names, names, ())
        else:
            result.loaded, result.skipped, staged = _load(
                spark, source, dest, names, if_exists, sample, level, block_bytes, key_methods or {}, allow_duplicate_keys
            )
        load_ms = int((time.monotonic() - started) * 1000)
        if not result.loaded:
            return result
        docs = read_documents(spark, dest, result.loaded)
        guide, chars = _guide(spark, dest, docs, result.loaded, staged)
        if staged is not None:
            _drop_staged(spark, dest, result.loaded)
    metadata = select_collections(dump_metadata(spark, source), result.loaded)
    keys = index_keys(metadata)
    result.expected = expected_indexes(keys)
    plan = stored(index_plan(keys, guide, multivalue), "plan")

    built = []
    if indexes != "skip":

        def build(row: Row) -> tuple[str, str, str | None, int]:
            table, begun, reason = f"{row['collection']}${row['index_name']}", time.monotonic(), None
            try:
                documents = read_documents(spark, dest, [row["collection"]])
                with scratch_scope(spark):
                    if row["kind"] == "geo_json" and not I.only_points(documents, row["spatial_path"]):
                        # Lines and areas: the index tells candidates, the shapes beside it decide
                        shapes = f"{dest}/shapes/{table}"
                        Geo.shapes(documents, row["spatial_path"]).write.mode("overwrite").options(**codec(level)).parquet(shapes)
                        rows = Geo.spatial_shape_index(spark.read.parquet(shapes))
                    else:
                        rows = build_index(documents, row, cell_deg)
                    rows.write.mode("overwrite").options(**codec(level)).parquet(f"{dest}/indexes/{table}")
            except Exception as e:  # whatever happens to one index, the others are built and all are reported
                LOG.warning("index %s failed: %s", table, e)
                reason = _reason(e)
            return row["collection"], row["index_name"], reason, int((time.monotonic() - begun) * 1000)

        # Index definitions are catalog-sized; every build is a distributed job, a few run side by side.
        with ThreadPoolExecutor(PARALLEL_BUILDS) as pool:
            outcomes = pool.map(inheritable_thread_target(spark)(build), plan.filter("status = 'build'").collect())
            built = list(outcomes)
    if built:
        done = spark.createDataFrame(built, "collection string, index_name string, reason string, build_ms bigint")
        plan = plan.join(done, ["collection", "index_name"], "left").withColumns(
            {
                "status": F.when(F.col("reason").isNotNull(), "failed").otherwise(F.col("status")),
                "reasons": F.when(F.col("reason").isNotNull(), F.array("reason")).otherwise(F.col("reasons")),
            }
        ).drop("reason")
    result.plan, result.specs = plan, index_spec(plan)

    total_ms = int((time.monotonic() - started) * 1000)
    per = docs.groupBy("collection").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("bson_len").alias("n_bytes"),
        F.sum("json_len").alias("target_bytes"),
    )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    listed = files.load(documents_path(dest)).select("path", "length")
    tables = listed.groupBy(F.url_decode(F.regexp_extract("path", "/collection=([^/]*)/", 1)).alias("collection")).agg(
        F.sum("length").alias("table_bytes")
    )
    sizes = per.select("collection", "target_bytes").join(tables, "collection", "left")
    durations = catalog.select("collection", F.lit(load_ms).alias("load_ms"), F.lit(total_ms).alias("total_ms"))
    result.collections = R.collection_report(
        per.select("collection", "n_docs", "n_bytes"), chars, sizes, plan, durations, sample is not None
    )
    index_sizes = None
    if indexes != "skip" and plan.filter("status = 'build'").limit(1).count():
        index_sizes = R.storage_sizes(spark, dest).filter("collection = 'indexes'").select(
            F.col("part").alias("table_name"), "n_bytes"
        )
    result.indexes = R.index_report(plan, index_sizes)
    return result
