"""The pipeline against what its stages must do, worked out by plain Python."""

import re

import corpus_pipeline
from doclake.runtime import stored

SF = "/root/testdata/sf0.001"


def five(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    text = {r.doc_id: r.text for r in docs.collect()}
    items = [five(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept, out = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        before = out
        out = stored(stage(spark, before, SF), f"test-{name}")
        kept[name] = {r.doc_id for r in out.collect()}
        assert kept[name] <= {r.doc_id for r in before.collect()}
        assert out.columns == docs.columns + ["shard"] * (name == "sharding")
        assert out.count() == len(kept[name])

    leak = {d for d, t in text.items() if any(i and len(i & five(t)) >= 0.8 * len(i) for i in items)}
    assert kept["decontamination"] == kept["near_dedup"] - leak
    assert all(re.search(r"[^\W\d_]", text[d] or "") for d in kept["language_id"])
    assert len(kept["language_id"]) >= 0.99 * len(text)
    by_words = {}
    for d in sorted(kept["language_id"]):
        by_words.setdefault(tuple(re.findall(r"\w+", text[d].lower())), []).append(d)
    assert all(len(set(ds) & kept["near_dedup"]) <= 1 for ds in by_words.values())
    assert 0 < len(kept["mixing"]) < len(kept["decontamination"]) and kept["sharding"] == kept["mixing"]
    assert {r.shard for r in out.collect()} <= set(range(16))
    whole = corpus_pipeline.run(spark, SF)
    assert sorted((r.doc_id, r.shard) for r in whole.collect()) == sorted((r.doc_id, r.shard) for r in out.collect())


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            expected = [c for c in docs.columns if c != "shard"] + ["shard"] if name == "sharding" else docs.columns
            assert out.columns == expected
            assert out.count() <= docs.count()
