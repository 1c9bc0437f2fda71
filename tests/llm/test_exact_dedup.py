import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from doclake.llm.exact_dedup import Owners, PatriciaTrie, SortedTries, exact_duplicates, shared_prefix


@given(st.binary(max_size=30), st.binary(max_size=30))
def test_shared_prefix(a, b):
    n = shared_prefix(a, b)
    assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


@settings(deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=60))
def test_trie_keeps_every_string_once(keys):
    trie, seen = PatriciaTrie(), defaultdict(int)
    for k in keys:
        trie.insert(k, [0])[0] += 1
        seen[k] += 1
    assert {k: e[0] for k, e in trie.items()} == dict(seen)


def test_spill_by_subtree_changes_nothing():
    rnd = random.Random(1)
    keys = [bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(12))) for _ in range(3000)]
    want = defaultdict(lambda: [None, 0])
    for i, k in enumerate(keys):
        want[k] = [i, want[k][1] + 1]
    tries, groups = SortedTries(Owners("largest"), budget=2000), []
    for i, k in sorted(enumerate(keys), key=lambda x: (len(x[1]), hash(x[1]) % 7)):
        groups += tries.add((len(k), hash(k) % 7), k, i, 1, i)  # few hashes, so that different strings meet
    assert groups
    groups += tries.groups()
    assert sorted((o, n) for o, n, _ in groups) == sorted(map(tuple, want.values()))
    assert sorted(e for _, _, es in groups for e in es) == list(range(len(keys)))


def test_texts_beyond_the_budget_and_long_common_prefixes(spark):
    head = "x" * 3500
    texts = [head + str(i % 300) for i in range(400)] + ["y" * 30_000, "Y" * 30_000, "y" * 29_999] + ["z" * 2_000_000] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = exact_duplicates(docs, budget=20_000).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=repr) == brute(docs.collect())


def brute(rows, better=max):
    groups = defaultdict(list)
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for r in rows:
        groups[(r.text or "").translate(low)].append(r.doc_id)
    out = []
    for ids in groups.values():
        keep = better([i for i in ids if i is not None], default=None)
        out += [(i, keep, len(ids), i == keep) for i in ids]
    return sorted(out, key=repr)


def test_odd_rows(odd_docs, no_docs):
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_duplicates(odd_docs).collect()), key=repr)
    assert got == brute(odd_docs.collect())
    assert exact_duplicates(no_docs).count() == 0


def test_small_budget_and_smallest_owner(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    rows = docs.collect()
    got = exact_duplicates(docs, keep="smallest", budget=20_000).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=repr) == brute(rows, min)
