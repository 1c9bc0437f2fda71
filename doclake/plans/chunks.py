"""Greedy chunking of dump records by bytes and documents, in parallel within a file.

A chunk starting at record ``i`` ends before the first later record that pushes
it over the byte limit, or after ``max_docs`` records; so the next start is a
function ``f(i)``. A file is cut into segments. Each segment tabulates, for every
start that can still be open where it begins, the start that is open where it
ends. Composing these small tables gives the true start in each segment, and all
segments then list their chunks at the same time. Tables are composed two by two,
level by level (so a file of n segments takes log n equal steps, and no task holds
more than two tables), and the true starts go down the same levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from doclake.runtime import ship_package, stored

MB = 1 << 20


def clamp_buffer_mb(megabytes: int) -> int:
    """Fixed range of the chunk size option: 16 to 2047 MB."""
    return max(16, min(2047, megabytes))


def _next_starts(lengths: np.ndarray, max_bytes: int, max_docs: int) -> np.ndarray:
    ends = np.cumsum(lengths)
    index = np.arange(len(lengths))
    by_bytes = np.maximum(np.searchsorted(ends, ends - lengths + max_bytes, side="right"), index + 1)
    return np.minimum(by_bytes, index + max_docs)


def _array(raw) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int64) if raw is not None else np.empty(0, dtype=np.int64)


def _packer(segment_bytes: int, max_bytes: int, max_docs: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("offset")
        lengths = pdf["length"].to_numpy(np.int64)
        offsets = pdf["offset"].to_numpy(np.int64)
        end = int(offsets[-1] + lengths[-1])
        # Starts that can still be open here: few enough bytes and records to the end, or the last record.
        tail = min(len(lengths), max_docs, max(1, int((end - offsets <= max_bytes).sum())))
        return pd.DataFrame(
            {
                "path": [pdf["path"].iloc[0]], "seg": [pdf["seg"].iloc[0]], "next_seg": [end // segment_bytes],
                "first": [int(offsets[0])], "lengths": [lengths.tobytes()], "tail": [lengths[-tail:].tobytes()],
            }
        )

    return pack


def _tabulator(max_bytes: int, max_docs: int):
    def tabulate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for row in pdf.itertuples():
                before, own = _array(row.before), _array(row.lengths)
                lengths = np.concatenate([before, own])
                nxt = _next_starts(lengths, max_bytes, max_docs)
                entry = np.arange(max(1, len(before)))
                at = entry.copy()
                while True:
                    go = nxt[at] < len(lengths)
                    if not go.any():
                        break
                    at[go] = nxt[at[go]]
                leaving = row.first - int(before.sum()) + np.cumsum(lengths)[at] - lengths[at]
                entering = row.first - int(before.sum()) + np.cumsum(lengths)[entry] - lengths[entry]
                # The table is a step function: keep the first entry of each step.
                keep = np.r_[True, leaving[1:] != leaving[:-1]]
                out.append((row.path, row.seg, entering[keep].tobytes(), leaving[keep].tobytes()))
            yield pd.DataFrame(out, columns=["path", "seg", "entering", "leaving"])

    return tabulate


def _through(entering: np.ndarray, leaving: np.ndarray, at: np.ndarray) -> np.ndarray:
    """What is open behind a segment, for what is open before it."""
    return leaving[np.searchsorted(entering, at, side="right") - 1]


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """Two neighbouring tables as one; a last one without neighbour stays."""
    pdf = pdf.sort_values("at")
    entering, leaving = _array(pdf["entering"].iloc[0]), _array(pdf["leaving"].iloc[0])
    for row in pdf.iloc[1:].itertuples():
        leaving = _through(_array(row.entering), _array(row.leaving), leaving)
        keep = np.r_[True, leaving[1:] != leaving[:-1]]
        entering, leaving = entering[keep], leaving[keep]
    return pd.DataFrame(
        {"path": [pdf["path"].iloc[0]], "at": [int(pdf["at"].iloc[0]) // 2], "entering": [entering.tobytes()], "leaving": [leaving.tobytes()]}
    )


def _open_below(pdf: pd.DataFrame) -> pd.DataFrame:
    """What is open before each of two neighbours, from what is open before the first."""
    pdf = pdf.sort_values("at")
    start, starts = int(pdf["open_at"].iloc[0]), []
    for row in pdf.itertuples():
        starts.append(start)
        start = int(_through(_array(row.entering), _array(row.leaving), np.array([start]))[0])
    return pd.DataFrame({"path": pdf["path"], "at": pdf["at"], "open_at": starts})


def _opened(tables: DataFrame) -> DataFrame:
    """``path, seg, open_at``: the chunk start that is open where each segment begins."""
    place = F.row_number().over(Window.partitionBy("path").orderBy("seg")) - 1
    placed = stored(tables.select("path", "seg").withColumn("at", place.cast("bigint")), "segment-places")
    table = "path string, at bigint, entering binary, leaving binary"
    levels = [stored(tables.join(placed, ["path", "seg"]).select("path", "at", "entering", "leaving"), "segment-tables")]
    while (levels[-1].agg(F.max("at")).first()[0] or 0) > 0:
        pair = F.floor(F.col("at") / 2).alias("pair")
        levels.append(stored(levels[-1].groupBy("path", pair).applyInPandas(_compose, table), "segment-tables"))
    opened = levels[-1].select("path", "at", F.lit(0).cast("bigint").alias("open_at"))
    for level in reversed(levels[:-1]):
        upper = opened.withColumnRenamed("at", "pair")
        below = level.withColumn("pair", F.floor(F.col("at") / 2)).join(upper, ["path", "pair"])
        opened = stored(
            below.groupBy("path", "pair").applyInPandas(_open_below, "path string, at bigint, open_at bigint"), "segment-starts"
        )
    return opened.join(placed, ["path", "at"]).select("path", "seg", "open_at")


def _lister(max_bytes: int, max_docs: int, sampled: bool):
    def chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for row in pdf.itertuples():
                before, own = _array(row.before), _array(row.lengths)
                lengths = np.concatenate([before, own])
                ends = np.cumsum(lengths)
                origin = row.first - int(before.sum())
                nxt = _next_starts(lengths, max_bytes, max_docs)
                at = int(np.searchsorted(ends - lengths, row.open_at - origin))
                found = []
                while nxt[at] < len(lengths):
                    found.append((at, int(nxt[at])))
                    at = int(nxt[at])
                if row.is_last:
                    found.append((at, len(lengths)))
                    # The record that reaches the sample limit joins the chunk before any size test.
                    if sampled and len(found) > 1 and at == len(lengths) - 1 and at - found[-2][0] < max_docs:
                        found[-2:] = [(found[-2][0], len(lengths))]
                for a, b in found:
                    first = int(ends[a] - lengths[a])
                    out.append((row.path, origin + first, b - a, int(ends[b - 1]) - first))
            yield pd.DataFrame(out, columns=["path", "start_offset", "n_docs", "n_bytes"])

    return chunks


def first_records(offsets: DataFrame, n: int) -> DataFrame:
    """First ``n`` records of every file in file order.

    Each shuffle partition cuts its own rows first (``row_number`` below a
    literal becomes a group limit on both sides of the shuffle).
    """
    order = Window.partitionBy("path").orderBy("offset")
    return offsets.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n).drop("_n")


def chunk_plan(
    offsets: DataFrame,
    max_bytes: int = 128 * MB,
    max_docs: int = 100_000,
    sample: int | None = None,
    segment_bytes: int | None = None,
    slots: int = 256,
) -> DataFrame:
    """``(path, chunk_no, start_offset, n_docs, n_bytes, slot)`` from ``(path, offset, length)``.

    ``sample`` keeps the first records of every file.
    """
    ship_package(offsets.sparkSession)
    if sample is not None:
        offsets = first_records(offsets, sample)
    # As long as a chunk, whatever the file's length: what is open at a segment's end began inside it, and a segment, which
    # is one task's array, has no more records than a chunk's bytes can hold.
    segment_bytes = max(segment_bytes or 0, max_bytes)
    seg = F.floor(F.col("offset") / segment_bytes).cast("bigint")
    packed = stored(
        offsets.select("path", "offset", "length", seg.alias("seg")).groupBy("path", "seg").applyInPandas(
            _packer(segment_bytes, max_bytes, max_docs),
            "path string, seg bigint, next_seg bigint, first bigint, lengths binary, tail binary",
        ),
        "segments",
    )
    last = packed.groupBy("path").agg(F.max("seg").alias("last_seg"))
    # The next record starts where the last one ends; only a file's last segment can point at itself.
    tails = packed.filter("next_seg > seg").select("path", F.col("next_seg").alias("seg"), F.col("tail").alias("before"))
    work = packed.join(tails, ["path", "seg"], "left").join(last, "path").select(
        "path", "seg", "first", "lengths", "before", (F.col("seg") == F.col("last_seg")).alias("is_last")
    )
    tables = work.mapInPandas(
        _tabulator(max_bytes, max_docs), "path string, seg bigint, entering binary, leaving binary"
    )
    plan = work.join(_opened(tables), ["path", "seg"]).mapInPandas(
        _lister(max_bytes, max_docs, sample is not None),
        "path string, start_offset bigint, n_docs bigint, n_bytes bigint",
    )
    number = F.row_number().over(Window.partitionBy("path").orderBy("start_offset")) - 1
    return plan.withColumn("chunk_no", number.cast("bigint")).select(
        "path", "chunk_no", "start_offset", "n_docs", "n_bytes", F.pmod("chunk_no", F.lit(slots)).cast("int").alias("slot")
    )
