"""Counter rates on a stream against the batch operator."""

from datetime import datetime, timedelta

from doclake.operators.report import counter_rate
from doclake.streaming.counters import stream_counter_rate

SCHEMA = "name string, at timestamp, total bigint, n bigint"
START = datetime(2024, 1, 1)


def fed(spark, folder, steps):
    for step in steps:
        spark.createDataFrame(step, SCHEMA).write.mode("append").parquet(f"{folder}/in")
        rates = stream_counter_rate(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), "name", "at", "total", "n")
        writer = rates.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck")
        writer.trigger(availableNow=True).start().awaitTermination()
    return {r["n"]: (r["rate"], r["max_rate"], r["late"]) for r in spark.read.parquet(f"{folder}/out").collect()}


def sample(name, second, total, n):
    return (name, START + timedelta(seconds=second), total << 20, n)


def test_steps_equal_one_batch(spark, tmp_path):
    rows = [sample("ab"[n % 2] if n % 7 else None, n // 3 * 2, n * n - (500 if n == 20 else 0), n) for n in range(40)]
    got = fed(spark, str(tmp_path), [rows[:15], rows[15:16], rows[:15:-1]])
    want = counter_rate(spark.createDataFrame(rows, SCHEMA), "name", "at", "total", "n").collect()
    assert got == {r["n"]: (r["rate"], r["max_rate"], False) for r in want}


def test_late_samples_change_nothing(spark, tmp_path):
    on_time = [sample("a", s, s * s, s) for s in (0, 1, 2, 5)]
    late = [sample("a", 3, 10_000, 103), sample("a", 5, 77, 4), sample("b", 1, 1, 200)]
    got = fed(spark, str(tmp_path), [on_time, late, [sample("a", 7, 49, 7)]])
    assert got[103] == (None, None, True) and got[4] == (None, None, True) and got[200] == (None, None, False)
    assert got[7] == (12.0, 12.0, False) and got[5] == (7.0, 7.0, False) and got[1] == (None, None, False)
