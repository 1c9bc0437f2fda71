"""Volumes, counters, rates, progress and the two reports."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from doclake.functions.ids import index_table_name, percent_of
from doclake.runtime import stored


def doc_count(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"))


def volume(df: DataFrame, size: str = "bson_len", by: tuple[str, ...] = ()) -> DataFrame:
    """Documents, exact bytes, average size, and the estimate documents x whole average."""
    grouped = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(size).cast("bigint").alias("n_bytes"),
        F.avg(size).alias("avg_bytes"),
    )
    estimate = (F.col("n_docs") * F.floor(F.col("avg_bytes"))).cast("bigint")
    return grouped.withColumn("estimated_bytes", estimate)


def load_counters(rows: DataFrame, chunk: Column, source_bytes: str = "bson_len", doc: str = "doc") -> DataFrame:
    """Per chunk: source and target bytes, documents loaded, records that failed.

    Only rows really decoded count as loaded.
    """
    failed = F.col("error").isNotNull()
    return rows.groupBy(chunk.alias("chunk")).agg(
        F.sum(source_bytes).cast("bigint").alias("source_bytes"),
        F.coalesce(F.sum(F.octet_length(doc)), F.lit(0)).cast("bigint").alias("target_bytes"),
        F.count_if(~failed).alias("n_docs"),
        F.count_if(failed).alias("n_errors"),
    )


def merge_counters(counters: DataFrame) -> DataFrame:
    return counters.agg(*[F.sum(c).alias(c) for c in ("source_bytes", "target_bytes", "n_docs", "n_errors")])


def storage_sizes(spark: SparkSession, root: str) -> DataFrame:
    """``(collection, part, n_files, n_bytes)`` below ``root/<collection>/<part>/``; lists files, reads none."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet").load(root).select("path", "length")
    )
    # Folder names may hold characters a URI escapes, e.g. `$`.
    below = F.split(F.url_decode(F.substring_index("path", f"/{root.rstrip('/').rsplit('/', 1)[-1]}/", -1)), "/")
    return files.select(below[0].alias("collection"), below[1].alias("part"), "length").groupBy("collection", "part").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes")
    )


def size_rollup(segments: DataFrame, owners: DataFrame) -> DataFrame:
    """Bytes per owner from segment sizes: ``owners(segment, owner, kind)`` joined to ``segments(segment, n_bytes)``."""
    sums = segments.groupBy("segment").agg(F.sum("n_bytes").alias("n_bytes"))
    return (
        owners.join(sums, "segment", "left")
        .groupBy("owner", "kind")
        .agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).cast("bigint").alias("n_bytes"))
    )


# --- running values over long counters -------------------------------------------------


def _ranged(df: DataFrame, keys: list[str], order: list[str], partitions: int | None) -> DataFrame:
    """Rows cut into contiguous ranges of (keys, order), numbered ``_b`` in that order.

    The ranges hold about equally many rows whatever the keys and times are, so
    neither a hot key nor many rows at one instant make a large group. Written
    out, because every later step must see the same cut.
    """
    by = [*keys, *order]
    placed = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return stored(placed.withColumn("_b", F.spark_partition_id()), "ranges")


def _carry(per_range: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Aggregates over all earlier ranges of a key: one row per range, so the window is short."""
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    return per_range.select(*keys, "_b", *[c.over(before).alias(n) for n, c in aggs.items()])


def _with_carry(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Rows joined to the state carried into their range; a null key is a key like any other."""
    on = [*keys, "_b"]
    right = carried.withColumnsRenamed({k: f"_j_{k}" for k in on})
    same = reduce(and_, [rows[k].eqNullSafe(right[f"_j_{k}"]) for k in on])
    return rows.join(right, same).drop(*[f"_j_{k}" for k in on])


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, partitions: int | None = None
) -> DataFrame:
    """Cumulative sum per key in a total order, without putting a whole key into one task.

    Rows are summed inside ranges of the order; totals of earlier ranges are
    carried in.
    """
    rows = _ranged(df.withColumn("_x", value), keys, order, partitions)
    totals = rows.groupBy(*keys, "_b").agg(F.sum("_x").alias("_t"))
    carried = _carry(totals, keys, {"_c": F.sum("_t")})
    inside = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_s", F.sum("_x").over(inside))
    return _with_carry(summed, carried, keys).withColumn(
        out, F.col("_s") + F.coalesce("_c", F.lit(0))
    ).drop("_b", "_x", "_s", "_c")


def counter_rate(
    df: DataFrame, counter: str, ts: str, value: str, tie: str, partitions: int | None = None
) -> DataFrame:
    """MiB per second between samples of a cumulative counter, and the running maximum.

    Null for the first two samples and when no time passed. A counter that went
    back shows its negative rate but never raises the maximum. Works in ranges
    with carried-in state, so one long counter is many tasks.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    samples = df.select(counter, ts, value, tie, micros.alias("_us"))
    b = _ranged(samples, [counter], ["_us", tie], partitions)
    last = F.max(F.struct("_us", tie, value)).alias("_last")
    per = b.groupBy(counter, "_b").agg(F.count(F.lit(1)).alias("_n"), last)
    carried = _carry(per, [counter], {"_seen": F.sum("_n"), "_prev": F.max("_last")})
    # The carried sample precedes the first row of a range only.
    inside = Window.partitionBy(counter, "_b").orderBy("_us", tie)
    rows = _with_carry(b, carried, [counter]).select(
        "*",
        F.row_number().over(inside).alias("_r"),
        F.lag("_us").over(inside).alias("_lus"),
        F.lag(value).over(inside).alias("_lv"),
    )
    seconds = (F.col("_us") - F.coalesce("_lus", F.col("_prev._us"))) / F.lit(1_000_000.0)
    delta = F.col(value) - F.coalesce("_lv", F.col(f"_prev.{value}"))
    turn = F.coalesce("_seen", F.lit(0)) + F.col("_r")
    rate = F.when((turn > 2) & (seconds > 0), delta / F.lit(float(1 << 20)) / seconds)
    rows = rows.select(counter, ts, value, tie, "_us", "_b", rate.alias("rate"))
    # The maximum is carried the same way; only non-negative rates take part.
    peak = F.when(F.col("rate") >= 0, F.col("rate"))
    tops = rows.groupBy(counter, "_b").agg(F.max(peak).alias("_m"))
    top_before = _carry(tops, [counter], {"_m": F.max("_m")})
    running = F.max(peak).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return _with_carry(rows.withColumn("_run", running), top_before, [counter]).select(
        counter, ts, value, tie, "rate", F.greatest("_run", "_m").alias("max_rate")
    )


def progress(loaded: DataFrame, targets: DataFrame, key: str = "collection") -> DataFrame:
    """Percent loaded per collection and overall (key null); no target gives null."""
    done = loaded.groupBy(key).agg(F.sum("n").alias("n_loaded"))
    aim = targets.groupBy(key).agg(F.sum("n").alias("n_target"))
    both = aim.join(done, key, "left").select(key, F.coalesce("n_loaded", F.lit(0)).alias("n_loaded"), "n_target")
    whole = both.agg(F.sum("n_loaded").alias("n_loaded"), F.sum("n_target").alias("n_target")).select(
        F.lit(None).cast("string").alias(key), "n_loaded", "n_target"
    )
    return both.unionByName(whole).withColumn("percent", percent_of(F.col("n_loaded"), F.col("n_target")))


# --- reports ---------------------------------------------------------------------------


def collection_report(
    volumes: DataFrame, key_chars: DataFrame, sizes: DataFrame, plan: DataFrame, durations: DataFrame | None = None,
    sampled: bool = False,
) -> DataFrame:
    """One row per collection, sorted by name: volumes, ratios to the source, index counts, durations.

    ``volumes(collection, n_docs, n_bytes)``, ``key_chars(collection, key_chars)``,
    ``sizes(collection, target_bytes, table_bytes)``, ``plan`` from ``index_plan``,
    ``durations(collection, load_ms, total_ms)``.
    """
    built = plan.groupBy("collection").agg(
        F.count_if(F.col("status") == "build").alias("n_indexes"),
        F.count_if(F.col("status") == "failed").alias("n_failed"),
    )
    r = volumes.join(key_chars, "collection", "left").join(sizes, "collection", "left").join(built, "collection", "left")
    extra = []
    if durations is not None:
        r = r.join(durations, "collection", "left")
        extra = ["load_ms", "total_ms"]
    source = F.col("n_bytes")
    return r.select(
        "collection", "n_docs", F.lit(sampled).alias("sampled"), source.alias("source_bytes"),
        "target_bytes", percent_of(F.col("target_bytes"), source).alias("target_pct"),
        "key_chars", percent_of(F.col("key_chars"), source).alias("key_pct"),
        "table_bytes", percent_of(F.col("table_bytes"), source).alias("table_pct"),
        F.coalesce("n_indexes", F.lit(0)).alias("n_indexes"),
        F.coalesce("n_failed", F.lit(0)).alias("n_failed"),
        *extra,
    ).orderBy("collection")


def index_report(plan: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """One row per index: its table name, kind, status, fields, reasons, bytes.

    ``sizes(table_name, n_bytes)``. The primary key is listed under the name the
    source gave it. A plan with ``build_ms`` hands the durations on.
    """
    timed = ["build_ms"] if "build_ms" in plan.columns else []
    rows = plan.select(
        "collection",
        index_table_name(F.col("collection"), F.col("index_name")).alias("table_name"),
        "kind", "status", "n_fields",
        F.array_join(F.transform("columns", lambda c: c["path"]), ",").alias("fields"),
        F.array_join("reasons", "; ").alias("reasons"),
        F.col("kind").isin("simple_mv", "compound_mv").alias("on_view"),
        *timed,
    )
    if sizes is None:
        return rows.withColumn("n_bytes", F.lit(None).cast("bigint"))
    return rows.join(sizes.select("table_name", "n_bytes"), "table_name", "left").select(*rows.columns, "n_bytes")


def failed_indexes(report: DataFrame) -> DataFrame:
    return report.filter("status = 'failed'").select("collection", "table_name", "kind", "reasons")
