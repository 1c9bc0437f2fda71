"""Derived rows (postings, array views) kept in step with inserts, updates and deletions of documents.

The rows of a table are kept by ranges of document identifiers. Each batch of changes writes what its documents give anew,
and a marker per document, deleted ones included; nothing stored is rewritten. Reading merges: stored rows of documents
that have a later marker are left out. Compaction folds the batches of a range into new files of that range only, so the
cost follows what changed, and files of other ranges stay as they are.

Layout: ``log_rows`` and ``log_ids`` by batch and range, ``base_rows`` and ``base_ids`` by generation and range,
``manifest/<n>`` telling which of them are valid. A manifest is written last, so a batch or a compaction counts wholly or
not at all, and a batch repeated after a failure is taken once. One writer at a time; readers see the manifest they began
with until ``vacuum`` removes what none refers to.

Changes are rows ``id, version, deleted, doc``; of several for one document the highest version counts (of equal versions,
deletion, then the greater text), also when an older one arrives later. A change without identifier raises. A document
that gives no rows has only its marker; a deleted one may come back with a higher version.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructType

from doclake.runtime import children, remove, scratch_scope, stored

Derive = Callable[[DataFrame], DataFrame]
RANGES = 32
FEW = 100_000  # identifiers that may be broadcast
CELL = 8192  # documents, about, whose rows are folded together
PORTION = 1 << 24  # bytes of documents, about, that a task makes rows of


# --- manifest --------------------------------------------------------------------------


def _manifests(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    found = [(int(name), folder) for folder, name in children(spark, f"{path}/manifest") if name.isdigit()]
    return sorted((n, f) for n, f in found if any(name == "_SUCCESS" for _, name in children(spark, f)))


def manifest(spark: SparkSession, path: str) -> dict:
    """What the table consists of: bounds of the ranges, batches since compaction, generation of each range."""
    there = _manifests(spark, path)
    if not there:
        raise ValueError(f"{path} is no table of changes")
    return json.loads(spark.read.text(there[-1][1]).first()["value"])


def _commit(spark: SparkSession, path: str, content: dict) -> None:
    there = _manifests(spark, path)
    at = f"{path}/manifest/{there[-1][0] + 1 if there else 0}"
    spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1).write.mode("overwrite").text(at)


def create(ids: DataFrame, path: str, ranges: int = RANGES) -> None:
    """An empty table whose ranges would hold about as many of ``ids`` each; more identifiers may come later."""
    spark = ids.sparkSession
    kind = ids.schema["id"].dataType.simpleString()
    dealt = ids.select("id").filter("id IS NOT NULL").repartitionByRange(ranges, "id")
    lows = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.min("id").alias("low")).orderBy("low").collect()
    bounds = sorted({r["low"] for r in lows})[1:]
    _commit(spark, path, {"type": kind, "bounds": bounds, "next": 0, "generation": 0, "batches": {}, "base": {}, "sources": {}, "rows": None})


def range_of(key: Column, kind: str, bounds: list) -> Column:
    """Number of the range a key lies in: a decision tree over the bounds."""

    def choose(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < F.lit(bounds[middle]).cast(kind), choose(low, middle)).otherwise(choose(middle + 1, high))

    return choose(0, len(bounds))


# --- reading ---------------------------------------------------------------------------


def _live(state: dict, ranges: set[int] | None, of: str) -> list[tuple[int, int]]:
    """``(batch, range)`` of the log folders that count."""
    out = []
    for batch, parts in state["batches"].items():
        for r in parts[of]:
            if (ranges is None or r in ranges) and int(batch) > state["base"].get(str(r), {"after": -1})["after"]:
                out.append((int(batch), r))
    return out


def _log(spark: SparkSession, path: str, state: dict, of: str, schema: StructType, ranges: set[int] | None) -> DataFrame:
    parts = [f"{path}/log_{of}/batch={b}/range={r}" for b, r in _live(state, ranges, of)]
    return _read(spark, f"{path}/log_{of}", parts, StructType([*schema.fields]).add("batch", LongType()).add("range", IntegerType()))


def _base(spark: SparkSession, path: str, state: dict, of: str, schema: StructType, ranges: set[int] | None) -> DataFrame:
    parts = [
        f"{path}/base_{of}/generation={b['generation']}/range={r}"
        for r, b in state["base"].items() if b[of] and (ranges is None or int(r) in ranges)
    ]
    return _read(spark, f"{path}/base_{of}", parts, StructType([*schema.fields]).add("generation", LongType()).add("range", IntegerType()))


def _read(spark: SparkSession, base: str, parts: list[str], schema: StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*parts)


def _ids_schema(state: dict) -> StructType:
    return StructType.fromDDL(f"id {state['type']}, version bigint, deleted boolean")


def _changed(state: dict, ranges: set[int] | None) -> int:
    """How many markers the live log has, at most; of batches that were written without their number, too many to tell."""
    return sum(state["batches"][str(b)].get("n", FEW + 1) for b in {b for b, _ in _live(state, ranges, "ids")})


def _joinable(few: DataFrame, n: int) -> DataFrame:
    """Rows to join by: sent to every task only if they are few by their number, else both sides are sorted.

    Spark would go by the size of the files, where sorted identifiers are a fraction of what they take in the driver.
    """
    return few if n <= FEW else few.hint("merge")


def _rows(spark: SparkSession, path: str, state: dict, ranges: set[int] | None) -> DataFrame:
    """Merged rows, with their range: base rows of unchanged documents, log rows of each changed document's last batch."""
    schema = StructType.fromJson(state["rows"])
    ids = _log(spark, path, state, "ids", _ids_schema(state), ranges)
    last = _joinable(ids.groupBy("id").agg(F.max("batch").alias("batch")), _changed(state, ranges))
    base = _base(spark, path, state, "rows", schema, ranges).join(last.select("id"), "id", "left_anti").drop("generation")
    log = _log(spark, path, state, "rows", schema, ranges).join(last, ["id", "batch"], "left_semi").drop("batch")
    return base.unionByName(log)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The rows as they are after all changes so far. Base rows move only if the changes are too many to broadcast."""
    state = manifest(spark, path)
    if state["rows"] is None:
        raise ValueError(f"{path} has not seen any change yet")
    return _rows(spark, path, state, None).drop("range")


def documents_in(spark: SparkSession, path: str) -> DataFrame:
    """``id, version, deleted`` of every document the table has seen."""
    return _markers(spark, path, manifest(spark, path), None).drop("range")


def _markers(spark: SparkSession, path: str, state: dict, ranges: set[int] | None) -> DataFrame:
    schema = _ids_schema(state)
    base = _base(spark, path, state, "ids", schema, ranges).withColumn("batch", F.lit(-1).cast("long")).drop("generation")
    every = base.unionByName(_log(spark, path, state, "ids", schema, ranges))
    last = every.groupBy("id", "range").agg(F.max(F.struct("batch", "version", "deleted")).alias("m"))
    return last.select("id", "m.version", "m.deleted", "range")


# --- writing ---------------------------------------------------------------------------


def _folded(spark: SparkSession, path: str, state: dict, ranges: set[int], n: int) -> DataFrame:
    """What ``_rows`` gives for ``n`` documents, dealt by range and, within it, into cells of ``CELL`` documents.

    Rows move once. If too many documents changed to be broadcast, their markers lie among the rows of the same document,
    which the sort that writing needs puts together.
    """
    cell = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-n // (CELL * len(ranges))))))
    if _changed(state, ranges) <= FEW:
        return _rows(spark, path, state, ranges).withColumn("_cell", cell).repartition("range", "_cell").drop("_cell")
    schema = StructType.fromJson(state["rows"])
    base = _base(spark, path, state, "rows", schema, ranges).drop("generation").withColumn("batch", F.lit(-1).cast("long"))
    rows = base.unionByName(_log(spark, path, state, "rows", schema, ranges)).withColumn("_row", F.lit(True))
    marks = _log(spark, path, state, "ids", _ids_schema(state), ranges).select("id", "batch", "range", F.lit(False).alias("_row"))
    dealt = rows.unionByName(marks, allowMissingColumns=True).withColumn("_cell", cell).repartition("range", "_cell")
    last = F.max("batch").over(Window.partitionBy("range", "id", "_cell"))
    return dealt.withColumn("_last", last).filter("_row AND batch = _last").drop("batch", "_row", "_cell", "_last")


def _write(rows: DataFrame, folder: str, spark: SparkSession, placed: bool = False) -> list[int]:
    """Write by range, sorted by identifier; the ranges that got files. Rows that are ``placed`` stay in their tasks."""
    placed = (rows if placed else rows.repartitionByRange("id")).sortWithinPartitions("range", "id")
    placed.write.mode("overwrite").option("compression", "zstd").partitionBy("range").parquet(folder)
    return sorted(int(name.removeprefix("range=")) for _, name in children(spark, folder) if name.startswith("range="))


def apply_changes(changes: DataFrame, path: str, derive: Derive, source: tuple[str, int] | None = None) -> bool:
    """Take in a batch of changes; False if ``source`` (a stream and its batch number) was taken before.

    ``derive`` makes the table's rows, with ``id``, of documents ``id, doc``. Only markers of the ranges that the batch
    falls into are read, to leave out changes that are older than what is stored.
    """
    spark = changes.sparkSession
    state = manifest(spark, path)
    if source is not None and state["sources"].get(source[0], -1) >= source[1]:
        return False
    with scratch_scope(spark):
        key = F.when(F.col("id").isNull(), F.raise_error(F.lit("a change without identifier")).cast(state["type"]))
        named = changes.select(
            key.otherwise(F.col("id").cast(state["type"])).alias("id"), F.col("version").cast("long").alias("version"),
            F.coalesce(F.col("deleted"), F.lit(False)).alias("deleted"), F.col("doc").cast("string").alias("doc"),
        )
        newest = named.groupBy("id").agg(F.max(F.struct("version", "deleted", "doc")).alias("c")).select("id", "c.*")
        newest = stored(newest.withColumn("range", range_of(F.col("id"), state["type"], state["bounds"])), "changes")
        size = F.sum(F.octet_length("doc")).alias("size")
        counts = {r["range"]: (r["n"], r["size"] or 0) for r in newest.groupBy("range").agg(F.count("id").alias("n"), size).collect()}
        n, bytes_ = (sum(c[i] for c in counts.values()) for i in (0, 1))
        fresh = newest
        if _live(state, set(counts), "ids") or any(str(r) in state["base"] for r in counts):
            known = _markers(spark, path, state, set(counts)).select("id", F.col("version").alias("stored"))
            if n <= FEW:
                known = known.join(F.broadcast(newest.select("id")), "id", "left_semi")
            known = known.hint("merge")
            later = F.col("stored").isNull() | (F.col("version") > F.col("stored"))
            fresh = stored(newest.join(known, "id", "left").filter(later).drop("stored"), "changes")
        batch = state["next"]
        ids = _write(fresh.select("id", "version", "deleted", "range"), f"{path}/log_ids/batch={batch}", spark)
        # Dealt by identifier before rows are made, which are many: rows of a document need no other task then
        tasks = max(spark.sparkContext.defaultParallelism, -(-bytes_ // PORTION))
        made = derive(fresh.filter("NOT deleted").select("id", "doc").repartitionByRange(tasks, "id"))
        made = made.withColumn("range", range_of(F.col("id"), state["type"], state["bounds"]))
        rows = _write(made, f"{path}/log_rows/batch={batch}", spark, placed=True)
        schema = StructType([f for f in made.schema if f.name != "range"])
        state["rows"] = state["rows"] or json.loads(schema.json())
        if ids:
            state["batches"][str(batch)] = {"ids": ids, "rows": rows, "n": n}
            state["next"] = batch + 1
        if source is not None:
            state["sources"][source[0]] = source[1]
        _commit(spark, path, state)
    return True


def compact(spark: SparkSession, path: str, min_batches: int = 2) -> list[int]:
    """Fold the batches of every range that has at least ``min_batches`` of them; the ranges that were rewritten."""
    state = manifest(spark, path)
    waiting: dict[int, int] = {}
    for _, r in _live(state, None, "ids"):
        waiting[r] = waiting.get(r, 0) + 1
    chosen = {r for r, n in waiting.items() if n >= min_batches}
    if not chosen:
        return []
    generation = state["generation"] + 1
    ids = _write(_markers(spark, path, state, chosen), f"{path}/base_ids/generation={generation}", spark)
    n = spark.read.schema(_ids_schema(state)).parquet(f"{path}/base_ids/generation={generation}").count()
    rows = _write(_folded(spark, path, state, chosen, n), f"{path}/base_rows/generation={generation}", spark, placed=True)
    for r in chosen:
        state["base"][str(r)] = {"generation": generation, "after": state["next"] - 1, "rows": r in rows, "ids": r in ids}
    state["generation"] = generation
    live = {b for b, _ in _live(state, None, "ids")}
    state["batches"] = {b: parts for b, parts in state["batches"].items() if int(b) in live}
    _commit(spark, path, state)
    return sorted(chosen)


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove folders and manifests that the newest manifest does not refer to; how many folders went."""
    state, gone = manifest(spark, path), 0
    kept = {f"log_{of}/batch={b}/range={r}" for of in ("ids", "rows") for b, r in _live(state, None, of)}
    kept |= {f"base_{of}/generation={b['generation']}/range={r}" for of in ("ids", "rows") for r, b in state["base"].items()}
    for table in ("log_ids", "log_rows", "base_ids", "base_rows"):
        for folder, name in children(spark, f"{path}/{table}"):
            for part, r in children(spark, folder):
                if r.startswith("range=") and f"{table}/{name}/{r}" not in kept:
                    remove(spark, part)
                    gone += 1
            if not any(r.startswith("range=") for _, r in children(spark, folder)):
                remove(spark, folder)
    for _, folder in _manifests(spark, path)[:-1]:
        remove(spark, folder)
    return gone


def start_change_sync(
    changes: DataFrame, path: str, checkpoint: str, derive: Derive, every: str | None = "1 second", compact_after: int | None = 8
) -> StreamingQuery:
    """Keep the table in step with a stream of changes; ``every=None`` drains the input and stops.

    Ranges with ``compact_after`` batches waiting are folded after a batch.
    """

    def take(batch: DataFrame, number: int) -> None:
        taken = apply_changes(batch, path, derive, (checkpoint, number))
        if taken and compact_after:
            compact(batch.sparkSession, path, compact_after)

    writer = changes.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
