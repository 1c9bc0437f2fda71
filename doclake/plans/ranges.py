"""Range splitting of a collection by an orderable key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def key_bounds(df: DataFrame, key: Column | str) -> DataFrame:
    """Smallest and largest key, and how many rows have one (no sort, partial aggregates only)."""
    k = F.col(key) if isinstance(key, str) else key
    return df.agg(F.min(k).alias("lo"), F.max(k).alias("hi"), F.count(k).alias("n"))


def bucket_size(lo: Column, hi: Column, cap: int = 100_000, start: int = 8) -> Column:
    """Bucket width: ``start`` doubled until at most ``cap`` buckets cover ``lo..hi``."""
    span = hi - lo
    widths = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.lit(start).cast("bigint") * F.power(F.lit(2), i).cast("bigint"))
    # A width that overflowed is not positive; a valid one is always found before that.
    return F.get(F.filter(widths, lambda w: (w > 0) & (F.call_function("div", span, w) + 1 <= cap)), F.lit(0))


def bucket_plan(df: DataFrame, key: Column | str, cap: int = 100_000, start: int = 8) -> tuple[int, int, int] | None:
    """``(lo, hi, width)`` of a collection, or None when no row has a key. One small job."""
    b = key_bounds(df, key)
    row = b.select("lo", "hi", bucket_size(F.col("lo"), F.col("hi"), cap, start).alias("width")).first()
    return None if row["lo"] is None else (row["lo"], row["hi"], row["width"])


def with_bucket(df: DataFrame, key: Column | str, plan: tuple[int, int, int] | None) -> DataFrame:
    k = F.col(key) if isinstance(key, str) else key
    if plan is None:
        return df.withColumn("bucket", F.lit(None).cast("bigint"))
    lo, _, width = plan
    return df.withColumn("bucket", F.call_function("div", k - F.lit(lo), F.lit(width)))


def bucket_counts(df: DataFrame, key: Column | str, cap: int = 100_000, start: int = 8) -> DataFrame:
    """Rows per half-open bucket ``[lo, hi)``; empty buckets do not appear, null keys form their own.

    One aggregate over the collection in place of one count query per bucket.
    """
    plan = bucket_plan(df, key, cap, start)
    counted = with_bucket(df, key, plan).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    if plan is None:
        lo = hi = F.lit(None).cast("bigint")
    else:
        low, high, width = plan
        lo = F.lit(low) + F.col("bucket") * F.lit(width)
        hi = F.least(lo + F.lit(width), F.lit(high + 1))
        hi = F.when(F.col("bucket").isNotNull(), hi)
    return counted.select("bucket", lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"), "n")


def key_at_share(df: DataFrame, key: str, share: float, cap: int = 4096) -> int | None:
    """The smallest whole-number key that ``share`` of the rows with a key do not exceed; None when no row has one.

    Buckets are counted, then those within the one that holds the place, until they are one key wide: a few passes
    over the key, none of which holds more than ``cap`` counts.
    """
    b = key_bounds(df, key).first()
    if b["n"] == 0:
        return None
    lo, hi, place = b["lo"], b["hi"], max(1, math.ceil(share * b["n"]))
    while True:
        inside = df.filter(F.col(key).between(lo, hi))
        width = df.sparkSession.range(1).select(bucket_size(F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint"), cap, 1)).first()[0]
        counted = with_bucket(inside, key, (lo, hi, width)).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        for r in sorted(counted.collect()):
            if place <= r["n"]:
                break
            place -= r["n"]
        lo += r["bucket"] * width
        if width == 1:
            return lo
        hi = min(hi, lo + width - 1)


def range_predicates(column: str, plan: tuple[int, int, int] | None, reads: int) -> list[str]:
    """SQL conditions that tile a collection into about ``reads`` ranges of whole buckets.

    For sources read by condition, such as ``spark.read.jdbc(predicates=…)``. Rows
    without a key come first, so that nothing is left out.
    """
    conditions = [f"{column} IS NULL"]
    if plan is not None:
        lo, hi, width = plan
        buckets = (hi - lo) // width + 1
        step = -(-buckets // max(1, reads)) * width
        edges = [*range(lo, hi + 1, step), hi + 1]
        conditions += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
    return conditions
