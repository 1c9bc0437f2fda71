"""Exact deduplication with Patricia-trie owners.

Two rounds of compressed radix tries over full byte strings. In the first, every input partition inserts its texts into
tries of its own; a terminal node counts the rows that end there and keeps their owner, so a group of copies leaves a
partition as one entry, however large it is. In the second, the entries are dealt out by length and content hash and
meet in the tries of their partition, whose terminals hold the owner among all rows. Rows find their owner through the
number of the entry they went into. Equality is that of the bytes; hashes only deal out.

Memory: a trie that outgrows its byte budget spills subtrees, as rows to whoever comes next, never to a file. In the first
round the largest one goes (the strings behind one edge of the root): its entries are handed on, since the second round
merges them. In the second the entries come sorted by length and hash, by Spark's own sort, which spills by itself; the
subtrees of the pairs of length and hash already passed are complete, so their groups are handed on. What stays is the
texts of one length and one hash: one text, as good as always, however long it is.

Texts are equal when identical after lower-casing A-Z only; null counts as the empty text. The owner is the largest
identifier (``keep="smallest"``: the smallest); a null identifier loses to any other, and owns only groups without one.
Repeated rows are counted each, and every row of the owner's identifier is kept. An empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm.common import map_arrow
from doclake.runtime import stored

BUDGET = 96 << 20  # bytes of strings a trie may hold before it spills
NODE_BYTES = 400  # what a node weighs besides its label


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    __slots__ = ("label", "children", "end")

    def __init__(self, label: bytes, end=None):
        self.label, self.end = label, end
        self.children: dict[int, Node] = {}


class PatriciaTrie:
    """Compressed radix trie from byte strings to mutable end values; ``weight`` estimates its bytes."""

    def __init__(self):
        self.root = Node(b"")
        self.weight = 0
        self.by_edge: dict[int, int] = {}

    def _grow(self, key: bytes, size: int) -> None:
        self.weight += size
        if key:
            self.by_edge[key[0]] = self.by_edge.get(key[0], 0) + size

    def insert(self, key: bytes, fresh):
        """The end value of ``key``: the one already there, or ``fresh``."""
        node, rest = self.root, key
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = Node(rest, fresh)
                self._grow(key, len(rest) + NODE_BYTES)
                return fresh
            n = shared_prefix(child.label, rest)
            if n < len(child.label):
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                node.children[rest[0]] = upper
                self._grow(key, NODE_BYTES)
                child = upper
            node, rest = child, rest[n:]
        if node.end is None:
            node.end = fresh
        return node.end

    def items(self, first: int | None = None) -> Iterator[tuple[bytes, object]]:
        """Strings and end values, of one edge of the root or of all."""
        if first is None and self.root.end is not None:
            yield b"", self.root.end
        below = self.root.children.values() if first is None else [self.root.children[first]]
        stack = [(b"", n) for n in below]
        while stack:
            before, node = stack.pop()
            key = before + node.label
            if node.end is not None:
                yield key, node.end
            stack.extend((key, n) for n in node.children.values())

    def cut(self) -> int:
        """First byte of the heaviest subtree."""
        return max(self.by_edge, key=self.by_edge.get)

    def drop(self, first: int) -> None:
        self.weight -= self.by_edge.pop(first)
        del self.root.children[first]


class Owners:
    """The better owner among identifiers, null being the worst."""

    def __init__(self, keep: str):
        if keep not in ("largest", "smallest"):
            raise ValueError(f"keep: {keep}")
        self.better = max if keep == "largest" else min

    def merge(self, a: int | None, b: int | None) -> int | None:
        if a is None or b is None:
            return b if a is None else a
        return self.better(a, b)


ENTRY = "doc_id long, entry long, text_sha256 string, text binary, owner long, n long"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("entry", pa.int64()), ("text_sha256", pa.string()),
    ("text", pa.large_binary()), ("owner", pa.int64()), ("n", pa.int64()),
])
FOUND = "entry long, keep_id long, group_size long"


def _entries(ends: Iterator[tuple[bytes, list]]) -> Iterator[pa.RecordBatch]:
    """Entries of tries as rows without a document, in batches of bounded bytes."""
    rows, size = [], 0
    for key, (entry, owner, n) in ends:
        rows.append((None, entry, None, key, owner, n))
        size += len(key)
        if size > 16 << 20 or len(rows) >= 10_000:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _local(batches: Iterator[pa.RecordBatch], owners: Owners, budget: int) -> Iterator[pa.RecordBatch]:
    """Round one: a row per document with its entry, and a row per entry with its text."""
    trie, entry = PatriciaTrie(), TaskContext.get().partitionId() << 40
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            key = (text or "").encode("utf-8").lower()
            fresh = [entry, None, 0]
            end = trie.insert(key, fresh)
            entry += end is fresh
            end[1], end[2] = owners.merge(end[1], doc_id), end[2] + 1
            rows.append((doc_id, end[0], hashlib.sha256(key).hexdigest(), None, None, None))
            while trie.weight > budget:
                first = trie.cut()
                yield from _entries(trie.items(first))
                trie.drop(first)
        if rows:
            yield _batch(rows)
    yield from _entries(trie.items())


class SortedTries:
    """Gathers (length and hash, string, owner, count, entry), sorted by the first, and gives each entry's group back."""

    def __init__(self, owners: Owners, budget: int):
        self.owners, self.budget = owners, budget
        self.weight, self.subtrees = 0, {}

    def add(self, place: tuple, key: bytes, owner: int | None, n: int, entry: int) -> Iterator[tuple[int | None, int, list[int]]]:
        """Takes a string in; the groups of complete subtrees, if there is too much at hand."""
        trie = self.subtrees.get(place)
        if trie is None:
            if self.weight > self.budget:
                yield from self.groups()
            trie = self.subtrees[place] = PatriciaTrie()
        before = trie.weight
        end = trie.insert(key, [None, 0, []])
        self.weight += trie.weight - before
        end[0], end[1] = self.owners.merge(end[0], owner), end[1] + n
        end[2].append(entry)

    def groups(self) -> Iterator[tuple[int | None, int, list[int]]]:
        """The groups of all subtrees, which are then forgotten."""
        for trie in self.subtrees.values():
            for _, (owner, n, entries) in trie.items():
                yield owner, n, entries
        self.weight, self.subtrees = 0, {}


def _global(batches: Iterator[pa.RecordBatch], owners: Owners, budget: int) -> Iterator[pa.RecordBatch]:
    """Round two: the group of every entry."""
    tries = SortedTries(owners, budget)
    rows: list[tuple] = []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("length", "hash", "text", "owner", "n", "entry"))
        for length, content, text, owner, n, entry in zip(*columns):
            for keep, size, entries in tries.add((length, content), text, owner, n, entry):
                rows.extend((e, keep, size) for e in entries)
        if len(rows) >= 50_000:
            yield _found(rows)
            rows = []
    for keep, size, entries in tries.groups():
        rows.extend((e, keep, size) for e in entries)
        if len(rows) >= 50_000:
            yield _found(rows)
            rows = []
    if rows:
        yield _found(rows)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in zip(*rows)], names=["entry", "keep_id", "group_size"]
    )


def exact_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", budget: int = BUDGET
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    owners = Owners(keep)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    local = stored(map_arrow(narrow, partial(_local, owners=owners, budget=budget), ENTRY), "trie-entries")
    named = {"length": F.octet_length("text"), "hash": F.xxhash64("text")}
    dealt = local.filter("text IS NOT NULL").select("entry", "text", "owner", "n").withColumns(named).repartition(
        _partitions(docs.sparkSession), "length", "hash"
    ).sortWithinPartitions("length", "hash")
    found = map_arrow(dealt, partial(_global, owners=owners, budget=budget), FOUND)
    rows = local.filter("text_sha256 IS NOT NULL").select("doc_id", "entry", "text_sha256")
    return rows.join(found, "entry").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
