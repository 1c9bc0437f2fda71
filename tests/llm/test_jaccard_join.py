"""Jaccard join against all pairs."""

import random
import re
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from doclake.llm.jaccard_join import _Words, all_keys, bands, folded, jaccard_components, parity_sketch, shingle_set

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute(rows, percent=85):
    sets = [shingle_sets(r.text) for r in rows]
    by_set = defaultdict(list)
    for i, s in enumerate(sets):
        by_set[s].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders, distinct = defaultdict(list), [s for s in by_set if s]
    for k, s in enumerate(distinct):
        shared = defaultdict(int)
        for x in s:
            for other in holders[x]:
                shared[other] += 1
            holders[x].append(k)
        for other, n in shared.items():
            if 100 * n >= percent * (len(s) + len(distinct[other]) - n):
                root[find(by_set[s][0])] = find(by_set[distinct[other]][0])
    for s, own in by_set.items():
        for i in own[1:] if s else ():
            root[find(i)] = find(own[0])
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
    return sorted(
        ((r.doc_id, len(s), least.get(find(i)) if s else r.doc_id) for i, (r, s) in enumerate(zip(rows, sets))), key=repr
    )


def found(docs, **how):
    return sorted((tuple(r) for r in jaccard_components(docs, **how).collect()), key=repr)


def test_bands_hold_all_partners():
    first, allowed = bands(85)
    for n in range(1, 3000):
        for m in range(n, 100 * n // 85 + 1):
            one, two = (int(np.searchsorted(first, x, side="right")) - 1 for x in (n, m))
            assert two - one <= 1 and (n + m) * 15 // 185 <= allowed[two]


@settings(deadline=None, max_examples=300)
@given(st.integers(1, 400), st.integers(0, 2**32 - 1))
def test_sets_that_may_link_share_a_key_and_sketches_bound_the_difference(n, seed):
    rnd = np.random.default_rng(seed)
    a = np.unique(rnd.integers(0, 2**64, n, np.uint64))
    budget = 2 * len(a) * 15 // 185
    gone = int(rnd.integers(0, budget + 1))
    b = np.unique(np.concatenate([np.delete(a, rnd.permutation(len(a))[:gone]), rnd.integers(0, 2**64, budget - gone, np.uint64)]))
    if not len(b):
        return
    common = len(np.intersect1d(a, b))
    if 100 * common >= 85 * (len(a) + len(b) - common):
        assert len(np.intersect1d(all_keys(a, 85), all_keys(b, 85)))
    near = folded([parity_sketch(a), parity_sketch(b)])
    assert np.bitwise_count(near[0] ^ near[1]).sum() <= len(a) + len(b) - 2 * common


def test_shingles_are_ascii_lower_case():
    ids = _Words()
    assert (shingle_set("A b\x0bÉ c d", ids) == shingle_set("a B É C  d\n", ids)).all()
    assert len(shingle_set("É b c d", ids)) == 1 and len(np.union1d(shingle_set("É b", ids), shingle_set("é b", ids))) == 2


def family(rnd, words, copies, edits):
    out = []
    for _ in range(copies):
        own = list(words)
        for _ in range(rnd.randrange(edits)):
            own[rnd.randrange(len(own))] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def test_families_and_shared_passages(spark):
    """Copies with few and many edits, passages that many share, sizes from one word on; tiles of all sizes."""
    rnd = random.Random(2)
    texts = []
    for _ in range(25):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([3, 5, 9, 20, 60, 200]))]
        texts += family(rnd, base, rnd.choice([1, 2, 5, 30]), max(2, len(base) // 12))
    passages = [" ".join(f"p{k}x{i}" for i in range(40)) for k in range(9)]
    for _ in range(120):
        chosen = rnd.sample(passages, rnd.choice([1, 5, 7, 8]))
        texts += family(rnd, " ".join(chosen).split(), 1, 4)
    rnd.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = brute(docs.collect())
    assert found(docs) == want
    assert found(docs, tile=3) == want
    assert len({c for *_, c in want}) < len(texts)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert found(docs) == brute(docs.select("doc_id", "text").collect())


def test_odd_rows(spark, odd_docs, no_docs):
    assert found(odd_docs) == brute(odd_docs.collect())
    assert jaccard_components(no_docs).count() == 0
