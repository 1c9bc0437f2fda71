import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from doclake.llm.near_dedup import _longest_rise, components, labelled, linked, near_duplicates, without_near_duplicates

SCHEMA = "doc_id long, text string, v string, row int"


def sequence(text):
    words, seen, out = re.findall(r"\w+", (text or "").lower()), Counter(), []
    for i in range(max(1, len(words) - 4) if words else 0):
        s = tuple(words[i : i + 5])
        out.append((s, seen[s]))
        seen[s] += 1
    return out


def similarity(a, b):
    place = {s: i for i, s in enumerate(b)}
    common = _longest_rise(np.array([place[s] for s in a if s in place], int))
    return common / (len(a) + len(b) - common) if a and b else 0


def brute(rows, least=0.8):
    """Classes of row numbers, by all pairs."""
    seqs = [sequence(r.text) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    held = defaultdict(list)
    for i, s in enumerate(seqs):
        for x in s:
            held[x].append(i)
    common = Counter((i, j) for m in held.values() for i in m for j in m if i < j)
    for (i, j), n in common.items():
        if find(i) != find(j) and n >= 0.79 * max(len(seqs[i]), len(seqs[j])) and similarity(seqs[i], seqs[j]) >= least - 1e-9:
            root[find(i)] = find(j)
    classes = defaultdict(list)
    for i in range(len(rows)):
        classes[find(i)].append(i)
    return list(classes.values())


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        at, kind = rnd.randrange(len(words)), rnd.randrange(3)
        if kind == 0:
            words[at] = f"e{rnd.randrange(10**6)}"
        elif kind == 1 and len(words) > 10:
            del words[at]
        else:
            words.insert(at, f"e{rnd.randrange(10**6)}")
    return words


@pytest.mark.parametrize("with_original", [True, False])
def test_one_large_group(spark, with_original):
    """Copies at all distances around one text, chains of copies, and unrelated texts."""
    rnd = random.Random(3)
    first = [f"w{rnd.randrange(3000)}" for _ in range(150)]
    texts = [" ".join(first)] if with_original else []
    texts += [" ".join(edited(rnd, first, rnd.choice([1, 2, 4, 6, 9, 14]))) for _ in range(400)]
    chain = first
    for _ in range(12):  # each near to the one before, the ends far apart
        chain = edited(rnd, chain, 3)
        texts.append(" ".join(chain))
    texts += [" ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([1, 4, 30]))) for _ in range(100)]
    rnd.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    rows = sorted(docs.collect())
    want = {i: min(c) for c in brute(rows) for i in c}
    got = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    for c in brute(rows, 0.82):
        assert len({got[i] for i in c}) == 1
    within = defaultdict(set)
    for i, c in got.items():
        within[c].add(want[i])
    assert all(len(w) == 1 for w in within.values())  # no class joins what all pairs keep apart
    assert len(set(got.values())) - len(set(want.values())) <= 0.01 * len(rows)
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(got.values())


@pytest.mark.parametrize("edits", [0, 1])
def test_documents_of_shared_passages(spark, edits):
    """Texts put together from passages that many share, each with copies of one word changed: classes as by all pairs."""
    rnd = random.Random(7)
    passages = [[f"w{rnd.randrange(3000)}" for _ in range(22)] for _ in range(11)]
    texts = []
    for chosen in combinations(range(11), 8):
        stock = [w for i in chosen for w in passages[i]]
        texts += [" ".join(edited(rnd, stock, edits))] + [" ".join(edited(rnd, stock, 1)) for _ in range(2)]
    rnd.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    rows = sorted(docs.collect())
    classes = brute(rows)
    assert len(classes) > 100
    got = {(r.doc_id, r.class_id, r.class_size) for r in near_duplicates(docs).collect()}
    assert got == {(i, min(c), len(c)) for c in classes for i in c}
    assert {r.doc_id for r in without_near_duplicates(docs).collect()} == {min(c) for c in classes}


@pytest.mark.parametrize("with_original", [True, False])
def test_one_large_group_as_by_all_pairs(spark, with_original):
    """Class and size of every document, also where a single link at the threshold joins a class."""
    rnd = random.Random(3)
    first = [f"w{rnd.randrange(3000)}" for _ in range(150)]
    texts = [" ".join(first)] if with_original else []
    texts += [" ".join(edited(rnd, first, rnd.choice([1, 2, 4, 6, 9, 14]))) for _ in range(400)]
    chain = first
    for _ in range(12):
        chain = edited(rnd, chain, 3)
        texts.append(" ".join(chain))
    texts += [" ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([1, 4, 30]))) for _ in range(100)]
    rnd.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    classes = brute(sorted(docs.collect()))
    got = {(r.doc_id, r.class_id, r.class_size) for r in near_duplicates(docs).collect()}
    assert got == {(i, min(c), len(c)) for c in classes for i in c}


def test_alignment_is_ordered_and_banded():
    rnd = random.Random(5)
    words = np.array([rnd.randrange(2**32) for _ in range(200)], np.uint32)
    a = labelled(words)
    assert linked(a, a, np.argsort(a), 0.8)
    turned = labelled(np.concatenate([words[100:], words[:100]]))
    assert not linked(a, turned, np.argsort(turned), 0.8)  # the same shingles in another order
    assert len(set(labelled(np.full(50, 7, np.uint32)).tolist())) == 46  # repeats are told apart


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 200), (250, 300), (200, 250)]
    edges = [e if rnd.random() < 0.5 else e[::-1] for e in edges]
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 50)}, 250: 200, 300: 200}


def test_odd_rows(odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    sizes = Counter((r.class_id, r.class_size) for r in rows)
    assert sizes[1, 5] == 5 and sizes[8, 2] == 2  # the copies (one without an identifier), the long texts
    assert all(r.class_size == 1 for r in rows if r.doc_id in (4, 5, 6))
    kept = without_near_duplicates(odd_docs).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 4, 5, 6, 7, 8, 10, 11] and len(kept) == 9
    assert near_duplicates(no_docs).count() == 0 and without_near_duplicates(no_docs).count() == 0
