"""Statistics and ranges from mergeable sketches."""

import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from doclake.operators import sketches as S

FILE = "_metadata.file_path"


def test_parts_merge_and_rank_error(spark, tmp_path):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.zipf(1.3, 30_000) % 100_000, rng.integers(-1000, 0, 30_000)])
    data = [(int(v), float(v) / 3, f"t{v}") for v in values]
    rows = spark.createDataFrame(data, "a int, b double, c string").repartition(6)
    rows.write.parquet(str(tmp_path / "old"))
    rows.limit(10_000).write.parquet(str(tmp_path / "new"))
    parts = [S.part_sketches(spark.read.parquet(str(tmp_path / p)), ["a", "b", "c"], FILE) for p in ("old", "new")]
    assert parts[0].count() == 18
    old = {r.column: r for r in S.histograms(parts[0], 20).collect()}
    for name, numbers in (("a", values), ("b", values / 3)):
        ordered = np.sort(numbers)
        for i, edge in enumerate(old[name].edges):
            low, high = np.searchsorted(ordered, edge, "left") / len(ordered), np.searchsorted(ordered, edge, "right") / len(ordered)
            assert low - 0.01 <= i / 20 <= high + 0.01
        assert abs(old[name].n_distinct / len(set(values.tolist())) - 1) < 0.04
    both = {r.column: r for r in S.histograms(parts[0].unionByName(parts[1]), 20).collect()}
    assert [both[c].n_rows for c in "abc"] == [70_000] * 3 and abs(both["c"].n_distinct / old["c"].n_distinct - 1) < 1e-9


def test_odd_columns(spark):
    day = datetime.date(2020, 1, 2)
    rows = spark.createDataFrame(
        [(1, None, float("nan"), "", day, [1]), (2, None, float("nan"), "é", None, [2]), (2, None, float("nan"), None, None, None)],
        "a long, empty int, nan double, t string, d date, arr array<int>",
    )
    got = {r.column: r for r in S.histograms(S.part_sketches(rows, rows.columns, "spark_partition_id()"), 2).collect()}
    assert [(c, got[c].n_values, got[c].n_distinct) for c in rows.columns] == [
        ("a", 3, 2), ("empty", 0, 0), ("nan", 3, 1), ("t", 2, 2), ("d", 1, 1), ("arr", 2, 2)
    ]
    assert got["empty"].edges == got["nan"].edges == got["arr"].edges == [] and got["a"].edges == [1, 2, 2]
    assert got["d"].edges == [(day - datetime.date(1970, 1, 1)).days] * 3
    none = rows.limit(0)
    assert S.histograms(S.part_sketches(none, ["a"], "'all'")).count() == 0
    sketches = S.part_sketches(rows, rows.columns, "'all'")
    assert S.ranged(none, "a", "t", S.part_sketches(none, ["a"], "'all'"), 4).count() == 0
    assert S.ranged(rows, "nan", "a", sketches, 4).count() == S.ranged(rows, "empty", "a", sketches, 4).count() == 3
    with pytest.raises(ValueError):
        S.ranged(rows, "arr", "a", sketches, 4)


def test_ranges_without_a_sampling_pass(spark):
    rows = spark.range(40_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 1000 == 1, None).otherwise((F.col("id") * 7919 % 40_000).cast("double")).alias("v"),
        F.when(F.col("id") % 2 == 0, "zz hot text").otherwise(F.concat(F.lit("w"), F.lpad((F.col("id") * 31 % 40_000).cast("string"), 5, "0"))).alias("t"),
        (F.col("id") * 31 % 5).alias("few"),
    )
    sketches = S.part_sketches(rows, ["v", "t", "few"], "spark_partition_id()")
    for column in ("v", "t", "few"):
        placed = S.ranged(rows, column, "id", sketches, 10)
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan and plan.count("Exchange") == 1
        tasks = placed.select("*", F.spark_partition_id().alias("task"))
        got = tasks.groupBy("_range").agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"), F.count_distinct("task").alias("tasks")
        ).orderBy("_range").collect()
        assert [r["_range"] for r in got] == list(range(10)) and all(r.tasks == 1 and abs(r.n - 4000) < 500 for r in got)
        assert all(a.high <= b.low for a, b in zip(got, got[1:]))
        assert sum(r.n for r in got) == 40_000
    assert math.isclose(placed.agg(F.sum("id")).first()[0], 40_000 * 39_999 / 2)
