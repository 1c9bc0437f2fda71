"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a pre-token stand in a linked list; a heap holds the adjacent pairs that have a rank. The pair of the
lowest rank (leftmost among equals) is popped and merged until no ranked pair is left. The count is the number of
initial symbols less the merges; identifiers are never looked up or emitted.

Null counts as the empty text: 0 bytes, 0 tokens. Repeated rows are counted each. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import partial
from heapq import heapify, heappop, heappush
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import map_arrow, matches

#: The pre-token pattern of the byte-level vocabulary, white space as in the Unicode property.
PRE_TOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs without white space and the space before, or white space: no pre-token crosses from one into the next.
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
REMEMBERED = 1_000_000  # chunks, and as many pre-tokens, whose count a task remembers (memory only)
LONG_WORD = 64  # longer ones are counted anew each time


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it is printable Latin-1, else the next free code from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def load_merges(path: str) -> tuple[list[tuple[str, str]], list[str]]:
    """Merges by rank and special strings of a byte-level BPE file of the ``tokenizers`` library."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    pre, model = spec["pre_tokenizer"], spec["model"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
    added = spec["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path}: special strings with conditions are not supported")
    return [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]], [t["content"] for t in added]


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of symbols left when no adjacent pair has a rank."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [
        (rank, i, pair)
        for i, pair in enumerate(zip(symbols, symbols[1:]))
        if (rank := ranks.get(pair)) is not None
    ]
    heapify(heap)
    merges = 0
    while heap:
        _, i, (left, right) = heappop(heap)
        j = after[i]
        if j >= n or symbols[i] != left or symbols[j] != right:
            continue  # one of the two was merged meanwhile
        symbols[i], symbols[j] = left + right, ""
        after[i] = follower = after[j]
        merges += 1
        if follower < n:
            before[follower] = i
            pair = (symbols[i], symbols[follower])
            if (rank := ranks.get(pair)) is not None:
                heappush(heap, (rank, i, pair))
        if (leader := before[i]) >= 0:
            pair = (symbols[leader], symbols[i])
            if (rank := ranks.get(pair)) is not None:
                heappush(heap, (rank, leader, pair))
    return n - merges


class WordCounts(dict):
    """Counts of pre-tokens, filled as they are met."""

    def __init__(self, merges: list[tuple[str, str]]):
        super().__init__()
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.symbols = byte_symbols()

    def __missing__(self, word: str) -> int:
        table = self.symbols
        count = merged_count([table[b] for b in word.encode("utf-8")], self.ranks)
        if len(word) <= LONG_WORD:
            self[word] = count
        return count


class TokenCounter(dict):
    """Counts of white-space-separated chunks, filled as they are met."""

    def __init__(self, merges: list[tuple[str, str]], special: list[str]):
        super().__init__()
        self.words = WordCounts(merges)
        self.pattern = regex.compile(PRE_TOKEN)
        longest_first = sorted(special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if special else None

    def __missing__(self, chunk: str) -> int:
        count = sum(map(self.words.__getitem__, matches(self.pattern, chunk)))
        if len(chunk) <= LONG_WORD:
            self[chunk] = count
        return count

    def count(self, text: str) -> int:
        for known in (self, self.words):
            if len(known) > REMEMBERED:
                known.clear()
        pieces = self.special.split(text) if self.special else [text]
        return len(pieces) - 1 + sum(sum(map(self.__getitem__, matches(CHUNK, p))) for p in pieces if p)


_held: dict[str, TokenCounter] = {}  # of this Python worker, which serves one task after another


def _count(batches: Iterator[pa.RecordBatch], name, merges, special) -> Iterator[pa.RecordBatch]:
    if name not in _held:
        _held.clear()
        _held[name] = TokenCounter(merges.value, special)
    counter = _held[name]
    for batch in batches:
        counts = [counter.count(t) if t else 0 for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )


def count_tokens(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row; ``path`` names the vocabulary file (read on the driver).

    The merge table is broadcast; its size is that of the vocabulary file, whatever the input.
    """
    merges, special = load_merges(path)
    name = hashlib.sha256(repr((merges, special)).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(merges)
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = map_arrow(narrow, partial(_count, name=name, merges=shared, special=special), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
