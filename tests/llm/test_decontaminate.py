import random
import re

from doclake.llm.decontaminate import find_leaks, without_leaks

ITEMS = "item_id long, text string, extra int"


def five(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    best = {}
    for d in docs:
        for i in items:
            own = five(i.text)
            if own and len(own & five(d.text)) >= 0.8 * len(own) - 1e-9:
                share = len(own & five(d.text)) / len(own)
                best[d.doc_id, i.item_id] = max(share, best.get((d.doc_id, i.item_id), 0))
    return {(d, i, round(c, 9)) for (d, i), c in best.items()}


def test_partial_copies_in_long_documents(spark):
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rnd.choice([3, 5, 9, 20, 40, 90]))), 0) for i in range(60)]
    docs = []
    for d in range(150):
        words = [word() for _ in range(rnd.choice([0, 30, 800]))]
        for _ in range(rnd.randrange(3)):
            copy = rnd.choice(items)[1].split()
            for _ in range(rnd.randrange(4)):
                copy[rnd.randrange(len(copy))] = word()
            at = rnd.randrange(len(words) + 1)
            words[at:at] = copy
        docs.append((d, " ".join(words).upper(), "x"))
    docs = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    items = spark.createDataFrame(items, ITEMS)
    want = brute(docs.collect(), items.collect())
    assert len(want) > 40
    for block in (1 << 24, 2000):  # one block of items, and several
        got = find_leaks(docs, items, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id, round(r.containment, 9)) for r in got} == want
        clean = without_leaks(docs, items, block_bytes=block)
        assert clean.columns == docs.columns
        assert {r.doc_id for r in clean.collect()} == set(range(150)) - {d for d, _, _ in want}


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame(
        [(1, "the same text twice over and AGAIN", 0), (1, "the same text twice over and AGAIN", 0), (None, "word0 and0 word1 and1 word2", 0),
         (2, None, 0), (3, "", 0), (4, "one two", 0)], ITEMS,
    )
    got = {(r.doc_id, r.item_id) for r in find_leaks(odd_docs, items).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (None, 1), (8, None), (9, None)}
    assert without_leaks(odd_docs, items).count() == odd_docs.count() - 7
    assert find_leaks(no_docs, items).count() == 0
    assert find_leaks(odd_docs, items.limit(0)).count() == 0
    assert without_leaks(odd_docs, items.limit(0)).count() == odd_docs.count()
