import math
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from doclake.llm.language_id import accepted, blocks, fit, grams, held_out, identify

SF = "/root/testdata/sf0.01/documents.parquet"


def symbols(text):
    out = ""
    for c in text:
        out += c.lower()[0] if c.isalpha() else " "
    return " ".join(out.split()) + " " if out.split() else ""


def brute_model(texts, order=4):
    """Interpolated Kneser-Ney by the book."""
    top = defaultdict(int)
    for t in texts:
        s = "\0" * (order - 1) + symbols(t)
        for i in range(order - 1, len(s)):
            top[s[i - order + 1 : i + 1]] += 1
    levels = {order: top}
    for k in range(order - 1, 0, -1):
        levels[k] = defaultdict(int)
        for g in levels[k + 1]:
            levels[k][g[1:]] += 1
    facts = {}
    for k, counts in levels.items():
        n1, n2 = (sum(1 for c in counts.values() if c == x) for x in (1, 2))
        d = n1 / (n1 + 2 * n2) if n1 else 0.5
        total, followers = defaultdict(int), defaultdict(int)
        for g, c in counts.items():
            total[g[:-1]] += c
            followers[g[:-1]] += 1
        facts[k] = counts, d, total, followers

    def p(gram, k, unseen):
        if k == 0:
            return unseen
        counts, d, total, followers = facts[k]
        g = gram[-k:]
        below = p(gram, k - 1, unseen)
        if g[:-1] not in total:
            return below
        return max(counts.get(g, 0) - d, 0) / total[g[:-1]] + d * followers[g[:-1]] / total[g[:-1]] * below

    return p


def test_grams_of_pieces():
    found, piece = grams(["Ab, c", "", "é"])
    assert [chr(int(g) & 0xFFFF) for g in found] == list("ab c é ")
    assert list(piece) == [0, 0, 0, 0, 0, 2, 2]
    assert int(found[5]) >> 16 == 0  # no context from the piece before
    assert [n for ns, _ in blocks(["x", None, "", "y"]) for n in ns] == [0, 3]


def test_like_the_book(spark):
    docs = {"xx": ["abra cadabra", "Abra, abraxas!"], "yy": ["lorem ipsum", "dolor lorem"]}
    learn = spark.createDataFrame([(k, t) for k, ts in docs.items() for t in ts], "lang string, text string")
    models = fit(learn)
    cost, n = models.sums(["abra lorem", "zz", None])
    alphabet = {c for ts in docs.values() for t in ts for c in symbols(t)}
    for i, lang in enumerate(models.langs):
        p = brute_model(docs[lang])
        for j, text in enumerate(["abra lorem", "zz"]):
            s = "\0\0\0" + symbols(text)
            want = -sum(math.log(p(s[a - 3 : a + 1], 4, 1 / (len(alphabet) + 1))) for a in range(3, len(s)))
            assert np.isclose(cost[i, j], want, rtol=1e-5)
    assert list(n) == [11, 3, 0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF)
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    unseen = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in unseen) >= 0.99 * len(unseen)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.002 * len(rows)


def test_rejects_what_is_no_language(spark):
    docs = spark.read.parquet(SF).select("doc_id", "text", "lang")
    noise = "".join(chr(0x4E00 + (i * 7919) % 5000) for i in range(400))
    more = spark.createDataFrame([(10**6, noise, None), (10**6 + 1, "12 34", "en")], docs.schema)
    kept = {r.doc_id for r in accepted(docs.unionByName(more)).collect()}
    assert not kept & {10**6, 10**6 + 1} and len(kept) >= 0.998 * docs.count()


def test_odd_rows(spark, odd_docs, no_docs):
    rows = identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    letters = {r.doc_id: any(map(str.isalpha, r.text or "")) for r in odd_docs.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            assert (r.lang_pred != "und") == letters[r.doc_id] and (r.score == 0) == (not letters[r.doc_id])
    assert accepted(odd_docs).columns == odd_docs.columns
    assert identify(no_docs).count() == 0
    unlabelled = identify(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_held_out_rule(spark):
    from zlib import crc32

    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_pieces_have_the_grams_of_the_whole_text(monkeypatch):
    from hypothesis import example, given, settings
    from hypothesis import strategies as st

    from doclake.llm import language_id

    def found(texts, piece):
        monkeypatch.setattr(language_id, "PIECE", piece)
        out = [[] for _ in texts]
        for numbers, cut in blocks(texts):
            for gram, of in zip(*(x.tolist() for x in grams(*cut))):
                out[numbers[of]].append(gram)
        return out

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.text(" ab\u00c9.1", max_size=40), max_size=4), st.integers(1, 9))
    @example(["a" + " " * 30 + "b", " . ", "ab" * 9], 3)
    def check(texts, piece):
        assert found(texts, piece) == found(texts, 1 << 20)

    check()
