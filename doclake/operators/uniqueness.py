"""Unique keys of stored rows, kept in buckets, so that an append is checked without moving them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doclake.runtime import scratch

KEY = "_key"
BUCKET_ROWS = 1 << 20


def key_text(cols: list[str]) -> Column:
    """One text for a combination of key values; equal texts are equal keys, and nulls are values like others."""
    return F.to_json(F.struct(*(F.col(f"`{c}`") for c in cols)), {"ignoreNullFields": "false"})


def _pieces(rows: DataFrame, buckets: int) -> int:
    """``buckets`` doubled until each gets at most ``BUCKET_ROWS`` rows, so that what a task sorts does not grow."""
    n = rows.count()
    while n > buckets * BUCKET_ROWS:
        buckets *= 2
    return buckets


def store_keys(rows: DataFrame, cols: list[str], table: str, path: str | None = None, buckets: int = 64) -> None:
    """Keep the keys of ``rows`` as a table of sorted buckets (in a folder of the shared storage, or ``path``).

    Bucketing is by the whole key, and keys are counted first, so a key held by many rows is one row. Many rows
    get more buckets than ``buckets``.
    """
    spark = rows.sparkSession
    buckets = _pieces(rows, buckets)
    keyed = rows.select(key_text(cols).alias(KEY), *(F.col(f"`{c}`") for c in cols))
    counted = keyed.groupBy(KEY).agg(*(F.first(f"`{c}`").alias(c) for c in cols), F.count(F.lit(1)).alias("n"))
    placed = counted.repartition(buckets, KEY)
    placed.write.bucketBy(buckets, KEY).sortBy(KEY).mode("overwrite").option("path", path or scratch(spark, table)).saveAsTable(table)


def append_violations(spark: SparkSession, new: DataFrame, cols: list[str], table: str) -> DataFrame:
    """Keys that an append of ``new`` would leave with more than one row: the key columns, ``n_stored``, ``n_new``.

    Only the new rows are shuffled, into the buckets of the stored keys, which are read where they are, unless the new
    rows are too many for so few buckets; keys that were doubled before, and get no new row, are not listed.
    """
    held = spark.table(table).select(KEY, F.col("n").alias("n_stored"))
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()["data_type"])
    pieces = _pieces(new, buckets)
    if pieces > buckets:
        held = held.repartition(pieces, KEY)
    keyed = new.select(key_text(cols).alias(KEY), *(F.col(f"`{c}`") for c in cols)).repartition(pieces, KEY)
    counted = keyed.groupBy(KEY).agg(*(F.first(f"`{c}`").alias(c) for c in cols), F.count(F.lit(1)).alias("n_new"))
    both = counted.hint("merge").join(held, KEY, "left").withColumn("n_stored", F.coalesce("n_stored", F.lit(0)))
    return both.filter("n_stored + n_new > 1").select(*cols, "n_stored", "n_new")
