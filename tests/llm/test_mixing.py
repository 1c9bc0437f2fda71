from collections import defaultdict

import pytest

from doclake.llm.mixing import mix_weights, mixed, probabilities, rake

SF = "/root/testdata/sf0.001/documents.parquet"
DIMS = ("source", "lang", "topic")


def brute_rake(cells, targets, sweeps=500):
    now = dict(cells)
    for _ in range(sweeps):
        for d in range(3):
            sums = defaultdict(float)
            for k, w in now.items():
                sums[k[d]] += w
            now = {k: w * targets[d][k[d]] / sums[k[d]] if sums[k[d]] else 0.0 for k, w in now.items()}
    return now


def test_raking_and_probabilities_like_brute_force(spark):
    cells = {("a", "x", "p"): 50, ("a", "y", "q"): 30, ("b", "x", "q"): 15, ("b", "y", "p"): 5, ("b", "y", "q"): 100, ("c", "x", "p"): 7}
    given = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 0.55, "q": 0.45}}
    table = spark.createDataFrame([(*k, w) for k, w in cells.items()], "source string, lang string, topic string, tokens long")
    fitted = rake(table, given, sweeps=100, tolerance=1e-6)
    want = brute_rake(cells, [given[d] for d in DIMS])
    got = {tuple(r[d] for d in DIMS): r for r in fitted.collect()}
    assert {k: r.raked for k, r in got.items()} == pytest.approx(want, rel=1e-4)
    chances = {tuple(r[d] for d in DIMS): r for r in probabilities(fitted, 0.5).collect()}
    assert sum(cells[k] * r.probability for k, r in chances.items()) == pytest.approx(0.5 * sum(cells.values()))
    scales = [r.probability / r.weight for r in chances.values() if r.probability < 1]
    assert max(scales) == pytest.approx(min(scales))  # one scale for all that are not kept whole
    assert all(r.weight * scales[0] >= 1 - 1e-9 for r in chances.values() if r.probability == 1)


def test_whole_table(spark):
    docs = spark.read.parquet(SF)
    rows = mix_weights(docs).collect()
    assert len(rows) == docs.count()
    tokens = sum(r.tokens for r in rows)
    assert sum(r.tokens * r.probability for r in rows) == pytest.approx(0.5 * tokens)
    for d in DIMS:
        present, weighed = defaultdict(float), defaultdict(float)
        for r in rows:
            present[r[d]] += r.tokens
            weighed[r[d]] += r.tokens * (r.weight or 0)
        aim = {k: v**0.7 for k, v in present.items() if v}
        for k, v in aim.items():
            assert weighed[k] == pytest.approx(v / sum(aim.values()), rel=1e-4)
    kept = mixed(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rows if r.sampled)


def test_odd_rows(odd_docs, no_docs):
    rows = mix_weights(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.probability <= 1 for r in rows)
    assert {r.topic for r in rows if r.tokens == 0} == {"none"}
    twice = [r.sampled for r in rows if r.doc_id == 2]
    assert len(twice) == 2 and len(set(twice)) == 1
    assert mixed(odd_docs).columns == odd_docs.columns
    assert mix_weights(no_docs).count() == 0 and mixed(no_docs).count() == 0
