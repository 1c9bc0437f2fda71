"""Benchmark decontamination: short test items found inside long documents.

Similarity between a short item and a long document says nothing; what counts is containment, the share of the item's
five-word shingles that stand in the document. Items are partitioned by size (number of distinct shingles, by powers of
two). In a partition whose largest item has n shingles every item is sketched by its ``floor((1 - t) n) + 1`` smallest
hashes. An item of s shingles contained by at least t misses at most ``floor((1 - t) s)`` of them, so at least
``sketch size - floor((1 - t) s) >= 1`` hashes of its sketch stand in the document, however long that is: fewer are no
candidate, and no match is missed. Candidates are verified by the words themselves, not by hashes.

Documents are read once per block of items and never shuffled. A block holds items of about ``block_bytes`` of text, so
what is broadcast is bounded whatever the number of items; more items make more blocks (one longer item is a block).

Words are runs of letters, digits and ``_``, lower-cased. Defined cases: null or empty texts, and items of fewer than
five words, match nothing; equal item rows count once; two texts under one item id are two items, of which a document
reports the better; rows of one document id are reported together; an empty table on either side gives no match. Further
columns are ignored by ``find_leaks`` and passed on by ``without_leaks``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import WORD, WordIds, map_arrow, matches, shingles, whole_row

K = 5
THRESHOLD = 0.8
BLOCK_BYTES = 16 << 20


class ItemIndex:
    """Sketches and shingles of one block of items."""

    def __init__(self, items: list[tuple[int, str]], threshold: float):
        ids = WordIds()
        self.ids, self.words, self.hashes = [], [], []
        for item_id, text in items:
            words = WORD.findall((text or "").lower())
            if len(words) < K:
                continue
            of = np.fromiter(map(ids.__getitem__, words), np.uint64)
            self.ids.append(item_id)
            self.words.append({tuple(words[i : i + K]) for i in range(len(words) - K + 1)})
            self.hashes.append(np.unique(shingles(of, K)))
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.allowed = np.floor((1 - threshold) * sizes + 1e-9).astype(np.int64)
        self.needed = np.ones(len(sizes), np.int64)
        keys, owners = [], []
        partition = np.frexp(sizes.astype(float))[1]
        for p in np.unique(partition):
            members = np.flatnonzero(partition == p)
            length = int(np.floor((1 - threshold) * sizes[members].max() + 1e-9)) + 1
            for i in members:
                sketch = self.hashes[i][:length]
                self.needed[i] = max(1, len(sketch) - self.allowed[i])
                keys.append(sketch)
                owners.append(np.full(len(sketch), i))
        all_keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        all_owners = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(all_keys, kind="stable")
        self.owners = all_owners[order]
        self.keys, self.starts = np.unique(all_keys[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(all_keys))

    def found_in(self, text: str | None, ids: WordIds) -> list[tuple[int, int, int]]:
        """(item number, shared shingles, shingles of the item) of the items that ``text`` contains."""
        if not text or not len(self.keys):
            return []
        words = ids.of(text)
        if len(words) < K:
            return []
        hashes = shingles(words, K)
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        hit = np.unique(at[self.keys[at] == hashes])
        if not len(hit):
            return []
        owners = np.concatenate([self.owners[self.starts[h] : self.ends[h]] for h in hit])
        numbers, hits = np.unique(owners, return_counts=True)
        numbers = numbers[hits >= self.needed[numbers]]
        if not len(numbers):
            return []
        spoken = list(matches(WORD, text.lower()))
        out = []
        for i in numbers:
            places = np.flatnonzero(np.isin(hashes, self.hashes[i]))
            shared = len({tuple(spoken[p : p + K]) for p in places} & self.words[i])
            if shared >= len(self.words[i]) - self.allowed[i]:
                out.append((int(i), shared, len(self.words[i])))
        return out


LEAKS = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"


def _find(batches: Iterator[pa.RecordBatch], index) -> Iterator[pa.RecordBatch]:
    items, ids = index.value, WordIds()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            best: dict[int, tuple[int, int]] = {}
            for i, shared, size in items.found_in(text, ids):
                item = items.ids[i]
                if item not in best or shared / size > best[item][0] / best[item][1]:
                    best[item] = shared, size
            rows += [(doc_id, item, shared, size, shared / size) for item, (shared, size) in best.items()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) if i == 4 else pa.array(c, pa.int64()) for i, c in enumerate(zip(*rows))],
                names=["doc_id", "item_id", "n_shared", "n_shingles", "containment"],
            )


def _keep_clean(batches: Iterator[pa.RecordBatch], index) -> Iterator[pa.RecordBatch]:
    items, ids = index.value, WordIds()
    for batch in batches:
        clean = [not items.found_in(t, ids) for t in batch.column("text").to_pylist()]
        yield batch.filter(pa.array(clean, pa.bool_()))


def item_blocks(items: DataFrame, threshold: float, block_bytes: int) -> Iterator:
    """Broadcast indexes of the items, block after block."""
    spark = items.sparkSession
    once = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL").distinct()
    size = once.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    for b in range(n):
        block = once.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).toArrow()
        rows = sorted(zip(*(block.column(c).to_pylist() for c in ("item_id", "text"))), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield spark.sparkContext.broadcast(ItemIndex(rows, threshold))


def find_leaks(
    docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and item (``item_id, text``) that it contains: ``doc_id, item_id, n_shared, n_shingles,
    containment``."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for index in item_blocks(items, threshold, block_bytes):
        part = map_arrow(narrow, partial(_find, index=index), LEAKS)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("n_shared", "n_shingles", "containment"), "containment").alias("best")
    ).select("doc_id", "item_id", "best.*")


def without_leaks(
    docs: DataFrame, items: DataFrame, *, text_col: str = "text", threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents, with all their columns, that contain no item."""
    packed = docs.select(whole_row(docs), F.col(text_col).cast("string").alias("text"))
    for index in item_blocks(items, threshold, block_bytes):
        packed = map_arrow(packed, partial(_keep_clean, index=index), packed.schema)
    return packed.select("row.*")
