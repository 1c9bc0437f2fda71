"""Uniqueness of an append against stored keys."""

import re
import uuid

from doclake.operators.uniqueness import append_violations, store_keys


def found(spark, stored, new, buckets=4):
    name, schema = "keys_" + uuid.uuid4().hex, "a bigint, b string, other string"
    store_keys(spark.createDataFrame(stored, schema), ["a", "b"], name, buckets=buckets)
    return append_violations(spark, spark.createDataFrame(new, schema), ["a", "b"], name)


def test_keys_within_and_across(spark):
    stored = [(1, "x", "p"), (1, None, "p"), (None, None, "p"), (2, "y", "p"), (2, "y", "q"), (3, "", "p")]
    new = [(1, "x", "n"), (1, None, "n"), (None, None, "n"), (4, "z", "n"), (4, "z", "n"), (3, None, "n"), (5, "1", "n")]
    got = sorted((tuple(r) for r in found(spark, stored, new).collect()), key=repr)
    assert got == sorted([(1, "x", 1, 1), (1, None, 1, 1), (None, None, 1, 1), (4, "z", 0, 2)], key=repr)
    assert found(spark, [], new[:1]).count() == 0 and found(spark, stored, []).count() == 0


def test_stored_keys_are_not_moved(spark):
    rows = found(spark, [(n, "k", "") for n in range(2000)], [(n, "k", "") for n in range(0, 4000, 40)])
    assert rows.count() == 50
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    depth = len(re.match(r"[ :|+-]*", lines[scan]).group())
    above = [line for line in lines[:scan] if len(re.match(r"[ :|+-]*", line).group()) < depth]
    join = max(i for i, line in enumerate(above) if "Join" in line)
    assert not any("Exchange" in line or "ShuffleQueryStage" in line for line in above[join:])


def test_more_rows_get_more_buckets(spark, monkeypatch):
    from doclake.operators import uniqueness as U

    monkeypatch.setattr(U, "BUCKET_ROWS", 100)
    schema, name = "a bigint, b string, other string", "keys_" + uuid.uuid4().hex
    store_keys(spark.createDataFrame([(n, "k", "") for n in range(1500)], schema), ["a", "b"], name, buckets=4)
    said = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()["data_type"]
    assert said == "16"
    new = spark.createDataFrame([(n // 2, "k", "") for n in range(6000)], schema)
    got = {r.a: (r.n_stored, r.n_new) for r in append_violations(spark, new, ["a", "b"], name).collect()}
    assert got == {n: (int(n < 1500), 2) for n in range(3000)}
