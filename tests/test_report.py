"""Counters, ranges, formats, selection and sinks."""

import pytest
from pyspark.sql import functions as F

from doclake.functions.ids import hex_uuid, human_duration, human_size, oid_floor, oid_seconds, path_key, path_prefixes
from doclake.operators import report as R
from doclake.operators import select as C
from doclake.operators import sinks as W
from doclake.plans import ranges as B


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_sizes_and_durations(spark):
    sizes = {0: "0.0 MB", 1 << 20: "1.0 MB", 1 << 30: "1024.0 MB", (1 << 30) + (1 << 20): "1.0 GB", 1 << 40: "1024.0 GB", 3 << 40: "3.0 TB"}
    for n, want in sizes.items():
        assert one(spark, human_size(F.lit(n))) == want
    times = {0: "0.000s", 999: "0.999s", 1000: "1s", 61_999: "1m 1s", 3_600_000: "1h", 90_061_000: "25h 1m 1s"}
    for ms, want in times.items():
        assert one(spark, human_duration(F.lit(ms))) == want


def test_ids(spark):
    assert one(spark, oid_seconds(F.lit("4f4e000000000000000000aa"))) == 0x4F4E0000
    assert one(spark, oid_floor(F.lit(255).cast("bigint"))) == "000000ff" + "0" * 16
    assert one(spark, hex_uuid(F.unhex(F.lit("00112233445566778899AABBCCDDEEFF")))) == "00112233-4455-6677-8899-aabbccddeeff"
    assert one(spark, path_key(F.lit('$."a b".c'))) == "a b.c" and one(spark, path_key(F.lit("$"))) is None
    assert [tuple(r) for r in one(spark, path_prefixes(F.lit("a.b.c")))] == [("a", "b.c"), ("a.b", "c"), ("a.b.c", "")]


def test_bucket_sizes(spark):
    size = lambda lo, hi: one(spark, B.bucket_size(F.lit(lo), F.lit(hi)))
    assert (size(0, 14_999), size(0, 2_592_000), size(5, 5)) == (8, 32, 8)
    assert size(0, 1 << 62) > 0


def test_bucket_counts(spark):
    df = spark.createDataFrame([(0,), (7,), (8,), (40,), (None,)], "k bigint")
    got = sorted([tuple(r) for r in B.bucket_counts(df, "k").collect()], key=repr)
    assert got == sorted([(0, 0, 8, 2), (1, 8, 16, 1), (5, 40, 41, 1), (None, None, None, 1)], key=repr)
    assert [tuple(r) for r in B.bucket_counts(df.filter("k is null"), "k").collect()] == [(None, None, None, 1)]
    assert B.bucket_counts(df.limit(0), "k").count() == 0


@pytest.mark.parametrize("partitions", [None, 1, 3, 9])
def test_counter_with_reset(spark, partitions):
    mb = 1 << 20
    values = [0, 10 * mb, 30 * mb, 31 * mb, 5 * mb, 7 * mb, 107 * mb, 107 * mb]
    times = [0, 1, 3, 4, 5, 6, 7, 7]
    rows = [("c", f"2024-01-01 00:00:0{t}", v, i) for i, (t, v) in enumerate(zip(times, values))] + [("d", "2024-01-01", 5, 0)]
    df = spark.createDataFrame(rows, "c string, ts string, v bigint, i int").withColumn("ts", F.col("ts").cast("timestamp"))
    got = R.counter_rate(df, "c", "ts", "v", "i", partitions).orderBy("c", "i").collect()
    assert [r["rate"] for r in got] == [None, None, 10.0, 1.0, -26.0, 2.0, 100.0, None, None]
    assert [r["max_rate"] for r in got] == [None, None, 10.0, 10.0, 10.0, 10.0, 100.0, 100.0, None]


def test_running_sum(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 2 == 1, 1).alias("k"))  # a null key too
    got = R.running_sum(df, ["k"], ["id"], F.col("id"), "s", 7).collect()
    assert all(r["s"] == sum(i for i in range(r["id"] + 1) if i % 2 == (r["k"] or 0)) for r in got)
    assert len(got) == 100


def test_rows_at_one_instant_spread(spark):
    df = spark.range(20_000).select("id", F.lit("hot").alias("k"), F.lit(0).alias("t"))
    parts = R._ranged(df, ["k"], ["t", "id"], 8).groupBy("_b").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 6_000


def test_progress_and_ratio_of_nothing(spark):
    loaded = spark.createDataFrame([("a", 1), ("a", 1)], "collection string, n bigint")
    target = spark.createDataFrame([("a", 3), ("b", 0)], "collection string, n bigint")
    got = {r["collection"]: (r["n_loaded"], r["percent"]) for r in R.progress(loaded, target).collect()}
    assert got == {"a": (2, 66.7), "b": (0, None), None: (2, 66.7)}


def test_selection(spark):
    df = spark.createDataFrame([("a",), ("ab",), ("b",)], "collection string")
    names = lambda x: sorted(r[0] for r in C.select_collections(df, x).collect())
    assert names("a, b") == ["a", "b"] and names("") == names(None) == ["a", "ab", "b"] and names(["ab"]) == ["ab"]
    options = spark.createDataFrame([("a.ID", "UUID"), ("x.ID", "UUID"), ("b.other", "z")], "key string, value string")
    got = {r["collection"]: r["ID"] for r in C.collection_option(df, options, "ID", "EMBEDDED_OID").collect()}
    assert got == {"a": "UUID", "ab": "EMBEDDED_OID", "b": "EMBEDDED_OID"}


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(10).select("id", F.lit("{}").alias("doc"))
    count = lambda: spark.read.parquet(path).count()
    assert W.write_collection(df.limit(0), path) == "created"
    assert W.write_collection(df, path) == "replaced" and count() == 10  # empty destination is filled
    assert W.write_collection(df, path) == "skipped" and count() == 10
    assert W.write_collection(df, path, "append") == "appended" and count() == 20
    assert W.write_collection(df, path, "drop") == "replaced" and count() == 10
    with pytest.raises(ValueError):
        W.write_collection(df, path, "whatever")


def test_codec_levels():
    assert [W.codec(n)["compression"] for n in (-1, 0, 1, 2, 3, 9)] == ["none", "none", "snappy", "zstd", "zstd", "zstd"]


def test_files_are_bounded(spark, tmp_path):
    path = str(tmp_path / "c")
    W.write_collection(spark.range(1000).coalesce(1), path, records_per_file=100)
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 10 and all(r["count"] == 100 for r in sizes)


def test_range_predicates_tile_everything(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id") * 3).alias("k"))
    plan = B.bucket_plan(df, "k", cap=100)
    conditions = B.range_predicates("k", plan, 7)
    assert 2 <= len(conditions) <= 8
    assert sum(df.filter(c).count() for c in conditions) == 1000
    assert B.range_predicates("k", None, 7) == ["k IS NULL"]


def test_estimated_index_stats(spark):
    from doclake.operators.indexes import index_stats

    df = spark.range(1000).select((F.col("id") % 7).alias("a"), F.col("id").alias("b.c"))
    exact = {r["column"]: r["n_distinct"] for r in index_stats(df, ["a", "b.c"]).collect()}
    rough = {r["column"]: r["n_distinct"] for r in index_stats(df, ["a", "b.c"], exact=False).collect()}
    assert exact == {"a": 7, "b.c": 1000} and rough["a"] == 7 and 850 < rough["b.c"] < 1150
