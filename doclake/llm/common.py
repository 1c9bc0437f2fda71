"""What the operators of this package share: Python stages, words and shingles."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.runtime import ship_package, stored

WORD = re.compile(r"\w+")
LONG_TEXT = 1 << 20  # texts beyond this many characters are walked match by match instead of as one list


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable on every executor."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def whole_row(df: DataFrame, *without: str) -> Column:
    """All columns of ``df`` in one struct ``row``, so that no name of theirs meets one of an operator's own."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns if c not in without)).alias("row")


def matches(pattern, text: str):
    """All matches of ``pattern``: a list, or a generator where the list would be large."""
    if len(text) < LONG_TEXT:
        return pattern.findall(text)
    return (m.group() for m in pattern.finditer(text))


class WordIds(dict):
    """64-bit hashes of words, remembered up to ``limit`` words (memory only: a forgotten word is hashed again)."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, text: str) -> np.ndarray:
        """Hashes of the words (runs of letters, digits, ``_``; lower-cased) in text order."""
        return np.fromiter(map(self.__getitem__, matches(WORD, text.lower())), np.uint64)


_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _SHIFT)) * _M1
    x = (x ^ (x >> _SHIFT)) * _M2
    return x ^ (x >> _SHIFT)


def shingles(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hashes of the runs of ``k`` words, in text order; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = words[:n].copy()
    for i in range(1, k):
        out = mix(out + _STEP) + words[i : i + n]
    return mix(out + np.uint64(k))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def components(edges: DataFrame) -> DataFrame:
    """``v, root`` of the vertices of ``a, b`` edges, the root being the smallest vertex of the component: every vertex
    hands the smallest neighbour it knows to the larger and then to the smaller ones, until nothing changes."""
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "near-edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()  # every edge now leads to a smaller vertex
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")
        )
        after = stored(small.select("e.*").filter("a <> b").distinct(), "near-edges")
        if not _changed(edges, after):
            return after.select(F.col("a").alias("v"), F.col("b").alias("root"))
        edges = after


def _changed(before: DataFrame, after: DataFrame) -> bool:
    """Whether a vertex has two edges or is both an end and a root: else the edges are stars and final."""
    twice = after.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
    roots = after.select(F.col("b").alias("a")).distinct()
    return not twice.isEmpty() or not after.join(roots, "a", "left_semi").isEmpty()
