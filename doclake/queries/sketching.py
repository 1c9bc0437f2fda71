"""Contract queries: statistics and ranges from mergeable sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from doclake.operators import sketches as S
from doclake.operators.indexes import index_stats
from doclake.queries.documents import table
from doclake.queries.registry import query
from doclake.runtime import stored

COLUMNS = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"]
RANGES = 16
FILE = "_metadata.file_path"


@query("sketch_statistics", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct, "
    "true AS estimate_close, 17 AS n_edges FROM lineitem" for c in COLUMNS
))
def sketch_statistics(spark, sf):
    """Statistics merged from the sketches of files, held against exact distinct counts (4 %: five deviations)."""
    rows = table(spark, sf, "lineitem")
    estimated = S.histograms(stored(S.part_sketches(rows, COLUMNS, FILE), "sketches"), RANGES)
    exact = index_stats(rows, COLUMNS).select("column", F.col("n_distinct").alias("exact"))
    return estimated.join(exact, "column").select(
        "column", "n_rows", "n_values", F.col("exact").alias("n_distinct"),
        (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.04 * F.col("exact")).alias("estimate_close"), F.size("edges").alias("n_edges"),
    )


def _ranges(rows: DataFrame, column: str) -> DataFrame:
    """Per range of ``column``: whether it holds its share of the rows (to 2 % of the table), and lies above the one before."""
    sketches = stored(S.part_sketches(rows, [column], FILE), "sketches")
    per_range = S.ranged(rows, column, "l_linenumber" if column == "l_orderkey" else "l_orderkey", sketches, RANGES).groupBy("_range").agg(
        F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
    )
    in_order = Window.orderBy("_range")  # over the ranges
    return per_range.select(
        F.lit(column).alias("column"), F.col("_range").cast("bigint").alias("range"), F.sum("n").over(Window.partitionBy()).alias("n_rows"),
        (F.abs(F.col("n") / F.sum("n").over(Window.partitionBy()) - 1 / RANGES) <= 0.02).alias("balanced"),
        F.coalesce(F.col("low") >= F.lag("high").over(in_order), F.lit(True)).alias("ordered"),
    )


@query("sketch_ranges", f"""
SELECT c.name AS "column", r.range AS "range", (SELECT count(*) FROM lineitem) AS n_rows, true AS balanced, true AS ordered
FROM range({RANGES}) AS r(range), (VALUES ('l_extendedprice'), ('l_quantity'), ('l_shipdate')) AS c(name)
""")
def sketch_ranges(spark, sf):
    """Ranges placed by sketches: of single values, and of values that hold more rows than a range."""
    rows = table(spark, sf, "lineitem")
    parts = [_ranges(rows, c) for c in ("l_extendedprice", "l_quantity", "l_shipdate")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
