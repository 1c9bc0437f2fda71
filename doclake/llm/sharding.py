"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Documents of equal text form a group that is never split over shards. Packing a corpus item by item would be one long
sequence, so it is done in two levels, both best fit decreasing: groups are dealt out by hash, and every task packs its
own, largest first, into parcels of a fixed capacity (a 1/256 of a shard); then the parcels are packed into shards. A
group above the parcel capacity is a parcel. At most one parcel of a task is less than half full, so there are at most
``2 * 256 * shards + tasks`` parcels, whatever the corpus: these, not the documents, meet in one place.

Best fit: the parcel or shard with the least room that suffices, found in a balanced search tree of the rooms.

``plan_shards`` minimises the number of shards of a given capacity; ``shard`` takes the number of shards and seeks the
smallest capacity that suffices, so that sizes come out near equal. A group larger than an even share gets a shard of
its own, and the others share the rest evenly.

Size of a document: the UTF-8 bytes of its text (null: none) plus 1. Null counts as the empty text in groups and
checksum. Slots count the documents of a shard from 0, in the order of the identifier (null first, ties in any order).
Repeated rows are each a document. An empty table gives an empty result; further columns are ignored by ``shard`` and
passed on by ``with_shards``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import map_arrow, whole_row
from doclake.runtime import stored

PARCELS_PER_SHARD = 256


class RoomTree:
    """Balanced search tree (a treap) of (room, bin): insert, and take the least room that suffices."""

    def __init__(self):
        self.root = None
        self.state = 0x2545F4914F6CDD1D

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def insert(self, room: int, bin_: int) -> None:
        # xorshift: priorities that are as good as random and the same in every run
        s = self.state
        s ^= (s << 13) & 0xFFFFFFFFFFFFFFFF
        s ^= s >> 7
        self.state = s = s ^ (s << 17) & 0xFFFFFFFFFFFFFFFF
        left, right = self._split(self.root, (room, bin_))
        self.root = self._merge(self._merge(left, [(room, bin_), s, None, None]), right)

    def take(self, size: int):
        """Remove and return the least (room, bin) with ``room >= size``; None if there is none."""
        best, node = None, self.root
        while node is not None:
            if node[0][0] >= size:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            left, rest = self._split(self.root, best)
            _, right = self._split(rest, (best[0], best[1] + 1))
            self.root = self._merge(left, right)
        return best


class BestFit:
    """Bins of one capacity, filled by best fit; an item above the capacity gets a bin of its own."""

    def __init__(self, capacity: int):
        self.capacity, self.tree, self.loads = capacity, RoomTree(), []

    def put(self, size: int) -> int:
        found = self.tree.take(size)
        if found is None:
            bin_, room = len(self.loads), self.capacity
            self.loads.append(0)
        else:
            room, bin_ = found
        self.loads[bin_] += size
        if room > size:
            self.tree.insert(room - size, bin_)
        return bin_


def pack(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item by best fit decreasing (equal sizes in the given order)."""
    bins, out = BestFit(capacity), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = bins.put(sizes[i])
    return out


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Shard of each item: the smallest capacity (to a thousandth) that needs no more than ``shards`` bins. An item above
    an even share of what is left gets a shard of its own first."""
    out, rest, left = [0] * len(sizes), sorted(range(len(sizes)), key=lambda i: -sizes[i]), shards
    total = sum(sizes)
    while left > 1 and rest and sizes[rest[0]] * left > total:
        left -= 1
        out[rest[0]] = left
        total -= sizes[rest.pop(0)]
    if not rest:
        return out
    own = [sizes[i] for i in rest]
    low = max(own[0], -(-total // left))
    high, best = low, pack(own, low)
    step = max(1, low // 1000)
    while max(best) >= left:
        high += step
        step *= 2
        best = pack(own, high)
    low_failed = high - step // 2
    while high - low_failed > max(1, low // 1000):
        middle = (low_failed + high) // 2
        tried = pack(own, middle)
        if max(tried) < left:
            high, best = middle, tried
        else:
            low_failed = middle
    for i, shard_ in zip(rest, best):
        out[i] = shard_
    return out


def _parcels(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Groups of a task, largest first, into parcels."""
    bins, first = BestFit(capacity), TaskContext.get().partitionId() << 40
    for batch in batches:
        parcels = [first + bins.put(b) for b in batch.column("bytes").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parcels, pa.int64())], names=[*batch.schema.names, "parcel"])


KEY = ["g", "text_crc32", "size"]


def sized(docs: DataFrame, text_col: str) -> DataFrame:
    """The columns of ``docs`` and the group key with ``size`` and ``text_crc32``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({
        "g": F.xxhash64(text),
        "text_crc32": F.crc32(text.cast("binary")),
        "size": (F.octet_length(text) + F.lit(1)).cast("long"),
    })


def _parcelled(rows: DataFrame, capacity: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Groups with their parcel, and (parcel, bytes) of all parcels, for shards of ``capacity`` bytes."""
    groups = rows.groupBy(*KEY).agg(F.sum("size").alias("bytes"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = groups.repartition(n, *KEY).sortWithinPartitions(F.desc("bytes"), *KEY)
    room = max(1, capacity // PARCELS_PER_SHARD)
    parcelled = stored(
        map_arrow(dealt, partial(_parcels, capacity=room), "g long, text_crc32 long, size long, bytes long, parcel long"), "parcels"
    )
    sums = parcelled.groupBy("parcel").agg(F.sum("bytes").alias("bytes")).toArrow()
    return parcelled.select(*KEY, "parcel"), sorted(zip(*(sums.column(c).to_pylist() for c in ("parcel", "bytes"))))


def _placed(rows: DataFrame, parcelled: DataFrame, parcels: list[tuple[int, int]], shards: list[int]) -> DataFrame:
    spark = rows.sparkSession
    table = spark.createDataFrame([(p, s) for (p, _), s in zip(parcels, shards)], "parcel long, shard int")
    return rows.join(parcelled.join(table, "parcel").drop("parcel"), KEY)


def plan_shards(docs: DataFrame, capacity: int, *, text_col: str = "text") -> DataFrame:
    """``g, text_crc32, size, shard`` of every group: as few shards of ``capacity`` bytes as best fit decreasing needs (a
    larger group gets a shard of its own)."""
    rows = sized(docs.select(text_col), text_col).select(*KEY)
    parcelled, parcels = _parcelled(rows, capacity)
    return _placed(rows.distinct(), parcelled, parcels, pack([b for _, b in parcels], capacity))


def _assigned(rows: DataFrame, keyed: DataFrame, shards: int) -> DataFrame:
    """``keyed`` rows with their shard, planned from the key columns in ``rows``."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parcelled, parcels = _parcelled(rows, total // shards)
    return _placed(keyed, parcelled, parcels, pack_into([b for _, b in parcels], shards))


def shard(docs: DataFrame, shards: int = 16, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(sized(own, "text").drop("text"), "sizes")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Even ranges of the identifier, with a tie-break so that one identifier cannot fill a range
    ranged = _assigned(rows, rows, shards).withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(n, "doc_id", "tie")
    placed = stored(ranged.withColumn("part", F.spark_partition_id()), "shards")
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    here = F.row_number().over(Window.partitionBy("part", "shard").orderBy("doc_id", "tie")) - 1
    return placed.withColumn("here", here).join(starts, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("here")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_shards(docs: DataFrame, shards: int = 16, *, text_col: str = "text") -> DataFrame:
    """The documents with all their columns and ``shard`` (a column of that name is replaced)."""
    rows = stored(sized(docs.select(F.col(text_col).alias("text")), "text").drop("text"), "sizes")
    packed = docs.select(whole_row(docs, "shard"), F.col(text_col).alias("text"))
    return _assigned(rows, sized(packed, "text").drop("text"), shards).select("row.*", "shard")
