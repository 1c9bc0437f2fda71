"""Writing collections: modes, codecs, text, rejected rows."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from doclake.operators.shape import to_json_text

LOG = logging.getLogger(__name__)

# Compression level -> Parquet codec and its options.
CODECS = {
    0: {"compression": "none"},
    1: {"compression": "snappy"},
    2: {"compression": "zstd", "parquet.compression.codec.zstd.level": "3"},
    3: {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"},
}
RECORDS_PER_FILE = 5_000_000


def codec(level: int) -> dict[str, str]:
    """Writer options of a compression level; levels outside 0..3 are clamped."""
    return dict(CODECS[max(0, min(3, level))])


def is_empty(df: DataFrame) -> DataFrame:
    """One row telling whether there are no rows; the scan stops at the first."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))


def read_collection(spark: SparkSession, path: str) -> DataFrame | None:
    """A written collection, or None when there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_collection(
    df: DataFrame, path: str, if_exists: str = "skip", level: int = 2, records_per_file: int = RECORDS_PER_FILE
) -> str:
    """Write a collection and tell what happened: ``created``, ``replaced``, ``appended`` or ``skipped``.

    A destination without rows is always filled. One with rows is left alone
    (``skip``), replaced (``drop``) or added to (``append``). The write commits as
    a whole, so a lost task never leaves part of a chunk behind.
    """
    if if_exists not in ("skip", "drop", "append"):
        raise ValueError(f"unknown if_exists {if_exists!r}: skip, drop or append")
    there = read_collection(df.sparkSession, path)
    filled = there is not None and not there.isEmpty()
    if filled and if_exists == "skip":
        LOG.warning("%s already holds rows, skipped", path)
        return "skipped"
    mode = "append" if filled and if_exists == "append" else "overwrite"
    df.write.mode(mode).options(**codec(level)).option("maxRecordsPerFile", records_per_file).parquet(path)
    if there is None:
        return "created"
    return "appended" if mode == "append" else "replaced"


def write_json(df: DataFrame, path: str, source: str = "data", mode: str = "errorifexists") -> None:
    """One JSON document per line, null fields kept."""
    to_json_text(df, source, "value").select("value").write.mode(mode).text(path)


def write_report_csv(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``;``-separated quoted text with a header."""
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "struct")) else F.col(c) for c, t in report.dtypes]
    report.select(*flat).write.mode(mode).option("sep", ";").option("header", True).option("quoteAll", True).csv(path)
