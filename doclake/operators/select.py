"""Choosing collections, options and first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def select_collections(df: DataFrame, names: str | list[str] | None, column: str = "collection") -> DataFrame:
    """Rows of the named collections; an empty list means all. Names match exactly."""
    wanted = [n.strip() for n in names.split(",")] if isinstance(names, str) else list(names or [])
    wanted = [n for n in wanted if n]
    return df.filter(F.col(column).isin(wanted)) if wanted else df


def sample_first(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in file order: a top-n per partition and one small merge, never a full sort."""
    return df.orderBy(*order).limit(n)


def collection_option(df: DataFrame, options: DataFrame, name: str, default: str | None,
                      collection: str = "collection") -> DataFrame:
    """Adds the option ``<collection>.<name>`` from ``(key, value)`` rows, else the default."""
    values = options.groupBy("key").agg(F.max("value").alias("value"))
    key = F.concat(F.col(collection), F.lit("."), F.lit(name))
    return (
        df.withColumn("_key", key)
        .join(values.select(F.col("key").alias("_key"), F.col("value").alias("_value")), "_key", "left")
        .withColumn(name, F.coalesce("_value", F.lit(default)))
        .drop("_key", "_value")
    )


def catalog_counts(catalog: DataFrame, keys: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Per collection: how many indexes it has (collections without any give 0)."""
    chosen = select_collections(catalog, names)
    per = keys.groupBy("collection").agg(F.count(F.lit(1)).alias("n_indexes"))
    return chosen.select("collection").join(per, "collection", "left").select(
        "collection", F.coalesce("n_indexes", F.lit(0)).alias("n_indexes")
    )


def grouped_counts(df: DataFrame, by: list[str], total: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("total"))
