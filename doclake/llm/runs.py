"""Periodic runs of words by scale-tiled search.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that no neighbouring word
extends. Runs of at least ``max(LEAST, TIMES * q)`` words are found, ``TIMES`` being 4.

Periods are treated by octaves: S <= q < 2S, S a power of two. A run of such a period is at least 4S words long, so
with a boundary at every multiple of S, the first boundary b in it has the 2S words from b repeated at b + q.

1. Screening: hashes of all stretches of 2S words come from those of S words by one step over the whole array, and one
   comparison of each boundary with the S positions behind it flags every boundary that can lie in a run. Unequal
   hashes prove unequal words, so nothing is missed; most documents flag nothing.
2. Flagged boundaries are exploded into overlapping tiles: ``core`` words of boundaries with S words before and 5S
   behind, as rows of exact word numbers. A document has about n / core tiles an octave, dealt out over all tasks.
3. Each tile is solved on its own: at each boundary, Z-functions forwards and backwards tell for all periods of the
   octave at once how far the period goes on either side, up to 3S and S words. A block of q words that is itself a
   repetition is left to the octave of its smaller period.
4. Fragments meet by (document, period) and are stitched where they overlap by q words or more. Fragments that were cut
   short by a tile always overlap the next one by that much, and two different runs of a period never do.

Defined cases: null and wordless texts have no runs; repeated rows and null identifiers are documents of their own; an
empty table gives an empty result; further columns are ignored. The words of one text are held in one task, as its row
is; arrays are built for ``CHUNK`` words, or one text, at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import map_arrow, mix
from doclake.runtime import stored

LEAST, TIMES = 6, 4
CORE = 4096  # words of boundaries in a tile
CHUNK = 1 << 19  # words screened at once
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: what is between the six ASCII white-space characters."""
    return (text or "").encode().split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers in order of first appearance: equal numbers are equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


def flagged(docs: list[np.ndarray]) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(document, S, boundaries)`` where a run with a period in [S, 2S) can be; documents in order of falling length."""
    salts = mix(np.arange(1, len(docs) + 1, dtype=np.uint64) * _STEP)
    ends = np.cumsum([len(d) for d in docs])
    starts = ends - [len(d) for d in docs]
    hashes = np.concatenate([mix(d.astype(np.uint64) + s) for d, s in zip(docs, salts)]) if docs else np.empty(0, np.uint64)
    size, alive = 1, len(docs)
    while True:
        while alive and len(docs[alive - 1]) < max(LEAST, TIMES * size):
            alive -= 1
        if not alive:
            return
        n = ends[alive - 1]
        # Stretches of 2 * size words; the last 2 * size - 1 positions have none
        hashes = mix(hashes[: n - size] + _STEP)[: max(0, n - 2 * size + 1)] + hashes[size:][: max(0, n - 2 * size + 1)]
        for doc, at in _equal(hashes, size, starts[:alive], ends[:alive]):
            yield doc, size, at
        size *= 2


def _equal(hashes: np.ndarray, size: int, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Boundaries (multiples of ``size``) whose stretch comes again at a distance of [size, 2 * size), by document."""
    count = (len(hashes) - size) // size  # boundaries that have all their partners
    hits = np.empty(0, np.int64)
    if count > 0:
        behind = hashes[size : size + count * size].reshape(count, size)
        hits = np.flatnonzero((behind == hashes[: count * size : size, None]).any(axis=1)) * size
    if len(hashes) > size + count * size or count <= 0:
        b = max(0, count) * size
        if b < len(hashes) and (hashes[b + size : b + 2 * size] == hashes[b]).any():
            hits = np.append(hits, b)
    if not len(hits):
        return
    docs = np.searchsorted(ends, hits, side="right")
    cuts = np.flatnonzero(np.diff(docs)) + 1
    for group, own in zip(np.split(docs, cuts), np.split(hits, cuts)):
        yield int(group[0]), own - starts[group[0]]


def tiles(doc: np.ndarray, size: int, boundaries: np.ndarray, core: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(size, start, boundaries, words)`` of the overlapping tiles around the boundaries, which are places in the text."""
    for part in np.split(boundaries, np.flatnonzero(np.diff(boundaries // max(core, size))) + 1):
        start = max(0, int(part[0]) - size)
        yield size, start, part - start, doc[start : int(part[-1]) + 6 * size]


def z_function(s: list[int]) -> list[int]:
    """Length of the longest common prefix of ``s`` and ``s[i:]``, for every i."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@lru_cache(1 << 16)
def prime_factors(n: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*out, n) if n > 1 else tuple(out)


def fragments(size: int, boundaries: np.ndarray, words: np.ndarray) -> list[tuple[int, int, int]]:
    """``(period, start, end)`` in the tile's own places, joined within the tile."""
    own = words.tolist()
    open_at: dict[int, list[int]] = {}
    out = []
    for b in boundaries.tolist():
        ahead = own[b : b + 6 * size]
        forward = z_function(ahead)
        periods = [q for q in range(size, min(2 * size, len(ahead))) if forward[q] >= 2 * size]
        periods = [q for q in periods if not any(forward[q // r] >= q - q // r for r in prime_factors(q))]
        if not periods:
            continue
        # Backwards: the common suffixes of what ends before b and before b + q
        low, top = max(0, b - size), min(len(own), b + 2 * size)
        backward = z_function([*own[low:b][::-1], -1, *own[low:top][::-1]])
        for q in periods:
            start, end = b - backward[b - low + 1 + top - b - q], b + q + min(3 * size, forward[q])
            held = open_at.get(q)
            if held is not None and start <= held[1] - q:
                held[1] = max(held[1], end)
            else:
                if held is not None:
                    out.append((q, *held))
                open_at[q] = [start, end]
    return out + [(q, *held) for q, held in open_at.items()]


_ROW = (
    "key long, doc_id long, n_words long, words_sha256 string, words binary, size int, start long, boundaries binary, tile binary"
)
_ARROW = pa.schema([
    ("key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("words_sha256", pa.string()),
    ("words", pa.large_binary()), ("size", pa.int32()), ("start", pa.int64()), ("boundaries", pa.large_binary()),
    ("tile", pa.large_binary()),
])


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _screen(batches: Iterator[pa.RecordBatch], prepare, core: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """A row per document (with its words, if it has tiles) and a row per tile."""
    key = TaskContext.get().partitionId() << 40
    held: list[tuple[int, int | None, list[bytes], np.ndarray]] = []
    total = 0

    def settled() -> Iterator[pa.RecordBatch]:
        held.sort(key=lambda h: -len(h[3]))
        numbers = [h[3] for h in held]
        out, weight, with_tiles = [], 0, set()
        for doc, size, boundaries in flagged(numbers):
            with_tiles.add(doc)
            for s, start, places, words in tiles(numbers[doc], size, boundaries, core):
                out.append((held[doc][0], None, None, None, None, s, start, places.astype(np.int32).tobytes(), words.tobytes()))
                weight += words.nbytes
                if weight > 16 << 20:
                    yield _arrow(out)
                    out, weight = [], 0
        for i, (k, doc_id, words, _) in enumerate(held):
            text = b" ".join(words)
            kept = text if i in with_tiles else None
            out.append((k, doc_id, len(words), hashlib.sha256(text).hexdigest(), kept, None, None, None, None))
            weight += len(kept or b"")
            if weight > 16 << 20:
                yield _arrow(out)
                out, weight = [], 0
        if out:
            yield _arrow(out)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text)
            if prepare is not None:
                words = prepare(doc_id, words)
            if total and total + len(words) > chunk:
                yield from settled()
                held.clear()
                total = 0
            held.append((key, doc_id, words, numbered(words)))
            key, total = key + 1, total + len(words) + 1
    if held:
        yield from settled()


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, size, start, places, tile in zip(
            *(batch.column(c).to_pylist() for c in ("key", "size", "start", "boundaries", "tile"))
        ):
            found = fragments(size, np.frombuffer(places, np.int32), np.frombuffer(tile, np.int32))
            out.extend((key, q, start + a, start + b) for q, a, b in found)
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], names=["key", "period", "start", "end"]
            )


def stitched(pieces: DataFrame) -> DataFrame:
    """``key, start, length, period`` of the runs that fragments ``key, period, start, end`` make up."""
    along = Window.partitionBy("key", "period").orderBy("start", "end")
    before = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col("start") > before - F.col("period")), 1).otherwise(0)
    islands = pieces.withColumn("new", new).withColumn("island", F.sum("new").over(along))
    whole = islands.groupBy("key", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    return whole.select("key", "start", length.alias("length"), "period").filter(
        length >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))
    )


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text of each document without the words that runs repeat."""
    for batch in batches:
        texts = []
        for words, runs in zip(batch.column("words").to_pylist(), batch.column("runs").to_pylist()):
            if not runs:
                texts.append(None)
                continue
            parts = words.split(b" ")
            keep = np.ones(len(parts), bool)
            for run in runs:
                keep[run["start"] + run["period"] : run["start"] + run["length"]] = False
            texts.append(b" ".join(parts[i] for i in np.flatnonzero(keep).tolist()).decode())
        rest = [batch.column(c) for c in ("doc_id", "n_words", "words_sha256", "runs")]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(texts)], names=["doc_id", "n_words", "words_sha256", "runs", "collapsed"])


RUNS = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None, core: int = CORE, chunk: int = CHUNK,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, words_sha256, runs, collapsed``.

    ``runs`` are sorted by start, then period. ``collapsed`` is the text, its words joined by one space, without the words
    that a run holds after its first period; null where there is no run, whose words joined by one space have the hash
    ``words_sha256``. ``prepare`` may change a document's words first.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    screened = stored(map_arrow(own, partial(_screen, prepare=prepare, core=core, chunk=chunk), _ROW), "run-tiles")
    dealt = screened.filter("size IS NOT NULL").select("key", "size", "start", "boundaries", "tile").repartition("key", "size", "start")
    found = stitched(map_arrow(dealt, _solve, "key long, period long, start long, end long"))
    by_doc = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    names = ["doc_id", "n_words", "words_sha256"]
    no_runs, rows = F.array().cast(RUNS), screened.filter("size IS NULL")
    plain = rows.filter("words IS NULL").select(*names, no_runs.alias("runs"), F.lit(None).cast("string").alias("collapsed"))
    tiled = rows.filter("words IS NOT NULL").select("key", *names, "words").join(by_doc, "key", "left")
    with_runs = map_arrow(
        tiled.select(*names, "words", F.coalesce("runs", no_runs).alias("runs")), _collapsed,
        f"doc_id long, n_words long, words_sha256 string, runs {RUNS}, collapsed string",
    )
    return plain.unionByName(with_runs)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A stated rule that makes a tenth of the documents periodic: with h the crc32 of the decimal identifier, h % 10 = 0
    and g = h // 10, every word from a = g % n on repeats the first 1 + (n - a) // (3 + g % 8) words from there."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, rest = divmod(zlib.crc32(b"%d" % doc_id), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a : a + p]
    return words[:a] + (block * ((n - a) // p + 1))[: n - a]


def run_report(docs: DataFrame, **how) -> DataFrame:
    """Per document the number of runs, the one of greatest exponent, and hashes of all runs and of the collapsed text."""
    found = periodic_runs(docs, **how)
    # Exponents are compared exactly: length / period as fractions, by cross multiplication
    exact = "decimal(38,0)"
    better = F.aggregate(
        "runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
        lambda best, r: F.when(
            best.isNull() | (r["length"].cast(exact) * best["period"] > best["length"].cast(exact) * r["period"]), r
        ).otherwise(best),
    )
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    runs_text = F.concat(F.concat_ws("\n", F.transform("runs", line)), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("best")
    return found.withColumn("best", better).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(runs_text.cast("binary"), 256).alias("runs_sha256"),
        F.coalesce(F.sha2(F.col("collapsed").cast("binary"), 256), "words_sha256").alias("collapsed_sha256"),
    )
