"""Structured Streaming: a text index and an array view kept in step with arriving documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from doclake.operators.indexes import Key, array_view, token_rows
from doclake.operators.shape import parse_docs


def stream_documents(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet",
                     files_per_trigger: int | None = None) -> DataFrame:
    """Documents as they arrive in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def start_text_sync(docs: DataFrame, out: str, checkpoint: str, text: str = "value",
                    every: str | None = "1 second") -> StreamingQuery:
    """Append token occurrences of new documents to ``out``; ``every=None`` drains the input and stops.

    The stream has no shuffle and no state: a document's tokens are cut and
    written in its own task, and the file sink commits each batch exactly once.
    """
    hits = token_rows(docs, text)
    writer = hits.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def synced_postings(spark: SparkSession, out: str) -> DataFrame:
    """Postings ``(token, id, tf)`` of everything synced so far."""
    return spark.read.parquet(out).groupBy("token", "id").agg(F.count(F.lit(1)).alias("tf"))


def start_view_sync(docs: DataFrame, out: str, checkpoint: str, keys: list[Key], arrays: set[str],
                    spark_types: dict[str, str] | None = None, every: str | None = "1 second") -> StreamingQuery:
    """Append array-view rows of new documents (``id``, ``doc``) to ``out``."""
    rows = array_view(parse_docs(docs), keys, arrays, True, spark_types)
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


