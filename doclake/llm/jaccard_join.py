"""Exact n-gram Jaccard join by parity sketches.

A document is the set of its distinct four-word shingles. Two documents link when
``100 * |A & B| >= PERCENT * |A | B|``, that is, when the sets differ in at most
``(|A| + |B|) * (100 - PERCENT) / (100 + PERCENT)`` shingles. No link is missed, and links are verified on the sets.

A parity sketch XORs every shingle into a vector of bits: of the XOR of two sketches, only shingles of one set are left,
so its weight (the Hamming distance) is at most the symmetric difference.

1. Size bands: linked sets lie in one band of sizes or in two neighbouring ones. A band bounds the difference by ``d``.
2. Pigeonhole: for each band the space of hashes is cut into ``d + 1 + x`` blocks, and a block's parity vector is named
   by the XOR of its shingles' hashes. Two linked sets agree in at least ``1 + x`` blocks, so each drops the ``x`` that
   hold the fewest shingles (the ones that say least and many sets share) and still meets its partners in a block.
3. Sets that agree in a block form a group. A task holds a group's sketches (narrow: a byte for each shingle) and hands
   on a spanning forest of the pairs that the Hamming distance allows, so a group of n gives at most n - 1 pairs; these
   are verified. Larger groups are cut into tiles of bounded size that share one member.
4. Where a verified pair failed, or a group was cut, links between the classes so far could be left. Only members with an
   allowed partner of another class are fetched with their sets, tile pair by tile pair, and settled exactly.

So nothing is paired one by one within a group but in the memory of a task, and copies count once.

Defined cases: words are runs of other than the six ASCII white-space characters, A-Z lower-cased; fewer than four words
are one shingle; no words, or null, is the empty set and linked with nothing, its component being its own identifier. A
component is named by its smallest identifier, null if it has none. Repeated rows are documents each. An empty table
gives an empty result; further columns are ignored. Texts of any length are whole; equality of shingles is that of 64-bit
hashes, of texts (to read copies once) that of md5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.llm.common import components, map_arrow, mix, shingles, signed
from doclake.runtime import stored

K = 4
PERCENT = 85
TILE = 1024  # members of a group in one task
TILE_BYTES = 16 << 20  # bytes of their sets
SKETCH_BITS = 8  # bits a shingle
SKETCH_LIMIT = 1 << 17  # a larger set has a weaker sketch, not a wrong one
_STEP, _TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC4CEB9FE1A85EC53)


class _Words(dict):
    """64-bit hashes of words, remembered up to ``limit`` words (a forgotten one is hashed again)."""

    limit = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str, ids: _Words) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    words = text.encode().lower().split()  # ASCII on both counts
    return np.unique(shingles(np.fromiter(map(ids.__getitem__, words), np.uint64, len(words)), K))


@lru_cache
def bands(percent: int, limit: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """Smallest size of each band, and the differing shingles it allows: a set's partners end with the next band."""
    first, allowed = [1], []
    while first[-1] <= limit:
        largest = 100 * first[-1] // percent
        allowed.append((100 - percent) * 2 * largest // (100 + percent))
        first.append(largest + 1)
    return np.array(first[:-1]), np.array(allowed)


def block_keys(own: np.ndarray, band: int, allowed: int) -> np.ndarray:
    """The keys of ``allowed + 1`` blocks; sets that differ in at most ``allowed`` shingles share one."""
    spare = -(-allowed // 8)
    parts = allowed + 1 + spare
    edges = np.arange(1, parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)
    cuts = np.concatenate([[0], np.searchsorted(own, edges), [len(own)]])
    parity = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mix(own))])
    counts = np.diff(cuts)
    place = np.arange(parts, dtype=np.uint64) * _STEP + mix(np.full(1, band + 1, np.uint64))
    keys = mix((parity[cuts[1:]] ^ parity[cuts[:-1]]) + mix(place + counts.astype(np.uint64) * _TURN))
    return keys[np.lexsort((keys, counts))[spare:]] if spare else keys


def all_keys(own: np.ndarray, percent: int) -> np.ndarray:
    """Keys in the own band, and in the next one if a partner can be there."""
    first, allowed = bands(percent)
    band = int(np.searchsorted(first, len(own), side="right")) - 1
    keys = [block_keys(own, band, int(allowed[band]))]
    if 100 * len(own) // percent >= first[band + 1]:
        keys.append(block_keys(own, band + 1, int(allowed[band + 1])))
    return np.concatenate(keys)


def parity_sketch(own: np.ndarray) -> np.ndarray:
    """Parities of the shingles by the low bits of their hashes, as 64-bit words: a power of two of them."""
    bits = 64
    while bits < min(SKETCH_LIMIT, SKETCH_BITS * len(own)):
        bits *= 2
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketches: list[np.ndarray]) -> np.ndarray:
    """Sketches as rows of one width: halves XORed are the sketch of half the bits."""
    width = min(map(len, sketches))
    return np.stack([np.bitwise_xor.reduce(s.reshape(-1, width), axis=0) for s in sketches])


class _Group:
    """Sizes and sketches of a group, and what they allow."""

    def __init__(self, members: list[dict], percent: int):
        self.ids = [m["vid"] for m in members]
        self.sizes = np.array([m["n"] for m in members], np.int64)
        self.sketches = folded([np.frombuffer(m["sketch"], np.uint64) for m in members])
        self.percent = percent

    def margin(self, i: int, others: np.ndarray) -> np.ndarray:
        """How far the Hamming distance of ``i`` and ``others`` is beyond what their sizes allow: at most 0 may link."""
        far = np.bitwise_count(self.sketches[others] ^ self.sketches[i]).sum(axis=1, dtype=np.int64)
        total = self.sizes[others] + self.sizes[i]
        return far - total * (100 - self.percent) // (100 + self.percent)

    def forest(self) -> list[tuple[int, int]]:
        """A spanning forest of the allowed pairs, of the smallest margins (Prim's)."""
        rest = np.arange(1, len(self.ids))
        best = self.margin(0, rest)
        source = np.zeros(len(rest), np.int64)
        out = []
        while len(rest):
            at = int(np.argmin(best))
            new = int(rest[at])
            if best[at] <= 0:
                out.append((self.ids[new], self.ids[source[at]]))
            rest, best, source = (np.delete(x, at) for x in (rest, best, source))
            if len(rest):
                here = self.margin(new, rest)
                closer = here < best
                best, source = np.where(closer, here, best), np.where(closer, new, source)
        return out


def _hash_texts(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Size of every document's set, and the keys of texts not yet seen in this task."""
    ids, sizes = _Words(), {}
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        counts, keys, empty = [], [], np.empty(0, np.int64)
        for text, name in zip(batch.column("text").to_pylist(), batch.column("name").to_pylist()):
            own = None
            if name not in sizes:
                if len(sizes) >= 500_000:
                    sizes.clear()
                own = shingle_set(text or "", ids)
                sizes[name] = len(own)
            counts.append(sizes[name])
            keys.append(signed(all_keys(own, percent)) if own is not None and len(own) else None)
        lengths = [0 if k is None else len(k) for k in keys]
        flat = np.concatenate([empty, *(k for k in keys if k is not None)])
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("name"), pa.array(np.arange(row, row + len(keys))),
                pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat), mask=pa.array([k is None for k in keys])),
            ],
            names=["doc_id", "name", "row", "n", "keys"],
        )
        row += len(keys)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = _Words()
    for batch in batches:
        sets = [shingle_set(t, ids) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vid"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([parity_sketch(s).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary()),
            ],
            names=["vid", "n", "sketch", "shingles"],
        )


def _forests(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, members in zip(batch.column("key").to_pylist(), batch.column("members").to_pylist()):
            out.extend((key, *sorted(pair)) for pair in _Group(members, percent).forest())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["key", "a", "b"])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = zip(batch.column("shingles").to_pylist(), batch.column("other").to_pylist())
        found = [linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent) for a, b in both]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found)], names=["a", "b", "linked"])


def _across(group: _Group, members: list[dict]) -> Iterator[tuple[int, np.ndarray]]:
    """``(i, others)``: later members of another class that the sketches allow, in a unit of one tile or of two."""
    roots = np.array([m["root"] for m in members])
    parts = np.array([m["part"] for m in members])
    two = parts.min() != parts.max()
    for i in range(len(members) - 1):
        others = np.arange(i + 1, len(members))
        others = others[(roots[others] != roots[i]) & ((parts[others] != parts[i]) | (not two))]
        if len(others):
            others = others[group.margin(i, others) <= 0]
            if len(others):
                yield i, others


def _needed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Members that have an allowed partner of another class."""
    for batch in batches:
        out = []
        for unit, members in zip(batch.column("unit").to_pylist(), batch.column("members").to_pylist()):
            some = set()
            for i, others in _across(_Group(members, percent), members):
                some.update([i, *others.tolist()])
            out.extend((unit, members[i]["vid"], members[i]["root"], members[i]["part"]) for i in some)
        if out:
            unit, vid, root, part = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unit, pa.string()), pa.array(vid, pa.int64()), pa.array(root, pa.int64()), pa.array(part, pa.int32())],
                names=["unit", "vid", "root", "part"],
            )


def _settled(batches: Iterator[pa.RecordBatch], percent: int, same: Callable[[np.ndarray, np.ndarray], bool]) -> Iterator[pa.RecordBatch]:
    """Links that join the classes in a unit as far as they are linked at all."""
    for batch in batches:
        out = []
        for members in batch.column("members").to_pylist():
            sets = [np.frombuffer(m["shingles"], np.uint64) for m in members]
            label = np.array([m["root"] for m in members])
            for i, others in _across(_Group(members, percent), members):
                for j in others.tolist():
                    if label[i] != label[j] and same(sets[i], sets[j]):
                        out.append((members[i]["vid"], members[j]["vid"]))
                        label[label == label[j]] = label[i]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b"])


def block_groups(hashed: DataFrame, tile: int) -> DataFrame:
    """``key, vid, place, size, tile`` of the groups of at least two, each set of members once."""
    every = hashed.select(F.explode("keys").alias("key"), "vid", "n")
    along = Window.partitionBy("key").orderBy("vid")
    met = stored(
        every.withColumns({"place": F.row_number().over(along), "next": F.lead("vid").over(along)})
        .filter("place > 1 OR next IS NOT NULL").drop("next"),
        "join-members",
    )
    mark = [F.bit_xor(F.xxhash64(F.lit(i), "vid")).alias(f"m{i}") for i in (1, 2)]
    sizes = met.groupBy("key").agg(F.count("*").alias("size"), F.max("n").alias("most"), *mark)
    once = sizes.groupBy("size", "most", "m1", "m2").agg(F.min("key").alias("key"))
    fits = F.greatest(F.lit(2), F.least(F.lit(tile), F.floor(F.lit(TILE_BYTES) / (8 * F.col("most"))))).cast("int")
    return stored(met.drop("n").join(once.select("key", "size", fits.alias("tile")), "key"), "join-groups")


def _listed(members: DataFrame, by: str, *columns: str) -> DataFrame:
    return members.groupBy(by).agg(F.collect_list(F.struct(*columns)).alias("members"))


def _candidates(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``key, a, b``: forests of allowed pairs, tile by tile; the first member of a group is in each of its tiles."""
    last = F.floor((F.col("size") - 1) / F.col("tile")).cast("int")
    own = F.floor((F.col("place") - 1) / F.col("tile")).cast("int")
    tiles = F.when(F.col("place") == 1, F.sequence(F.lit(0), last)).otherwise(F.array(own))
    dealt = groups.select("key", "vid", F.explode(tiles).alias("part"))
    full = dealt.join(sets.select("vid", "n", "sketch"), "vid")
    listed = full.groupBy("key", "part").agg(F.collect_list(F.struct("vid", "n", "sketch")).alias("members"))
    return map_arrow(listed.filter(F.size("members") > 1).select("key", "members"), partial(_forests, percent=percent), "key long, a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    shingle = sets.select("vid", "shingles")
    one = pairs.join(shingle.withColumnRenamed("vid", "a"), "a")
    two = one.join(shingle.select(F.col("vid").alias("b"), F.col("shingles").alias("other")), "b")
    return map_arrow(two.select("a", "b", "shingles", "other"), partial(_verified, percent=percent), "a long, b long, linked boolean")


def _units(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``unit, vid, root, part``: the pairs of tiles of open groups that hold more than one class."""
    rooted = stored(
        groups.join(components(links), F.col("vid") == F.col("v"), "left")
        .select("key", "vid", "tile", F.coalesce("root", "vid").alias("root")),
        "join-rooted",
    )
    several = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    along = Window.partitionBy("key").orderBy("root", "vid")
    parted = rooted.join(several, "key", "left_semi").withColumn(
        "part", F.floor((F.row_number().over(along) - 1) / F.col("tile")).cast("int")
    )
    parted = stored(parted, "join-parts")
    ranges = parted.groupBy("key", "part").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    other = ranges.select("key", F.col("part").alias("part2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    pairs = ranges.join(other, "key").filter("part <= part2 AND NOT (lo = hi AND lo2 = hi2 AND lo = lo2)")
    name = F.concat_ws(":", "key", "part", "part2").alias("unit")
    both = pairs.select("key", name, F.explode(F.array_distinct(F.array("part", "part2"))).alias("part"))
    return parted.join(both, ["key", "part"]).select("unit", "vid", "root", "part")


def links(docs: DataFrame, hashed: DataFrame, *, percent: int = PERCENT, tile: int = TILE) -> DataFrame:
    """Links ``a, b`` that connect the vertices ``vid, name, n, keys`` of ``name, text`` rows as far as they are linked."""
    groups = block_groups(hashed, tile)
    needed = hashed.select("vid", "name").join(groups.select("vid").distinct(), "vid", "left_semi")
    texts = docs.select("name", "text").join(needed, "name")
    # The same text comes from every copy of it: sets are made before the shuffle, and one of them is kept
    sets = stored(
        map_arrow(texts, _sets, "vid long, n long, sketch binary, shingles binary").dropDuplicates(["vid"]), "join-sets"
    )
    candidates = stored(_candidates(groups, sets, percent), "join-candidates")
    checked = stored(_verify(candidates.select("a", "b").distinct(), sets, percent), "join-checked")
    found = checked.filter("linked").select("a", "b")
    failed = candidates.join(checked.filter("NOT linked"), ["a", "b"]).select("key")
    open_keys = failed.unionByName(groups.filter("size > tile").select("key")).distinct()
    settled = settle_classes(groups.join(open_keys, "key", "left_semi"), sets, found, percent, partial(linked, percent=percent))
    return found.unionByName(settled)


def settle_classes(
    groups: DataFrame, sets: DataFrame, found: DataFrame, percent: int, same: Callable[[np.ndarray, np.ndarray], bool]
) -> DataFrame:
    """Links ``a, b`` that join the classes, by the links ``found``, of members of ``groups`` as far as they are linked at
    all: those that ``same`` tells of two rows' ``shingles`` and that imply a Jaccard similarity of ``percent``."""
    units = stored(_units(groups, found), "join-units")
    sketched = units.join(sets.select("vid", "n", "sketch"), "vid")
    again = stored(
        map_arrow(
            _listed(sketched, "unit", "vid", "root", "part", "n", "sketch"), partial(_needed, percent=percent),
            "unit string, vid long, root long, part int",
        ),
        "join-again",
    )
    full = _listed(again.join(sets, "vid"), "unit", "vid", "root", "part", "n", "sketch", "shingles")
    return stored(map_arrow(full.select("members"), partial(_settled, percent=percent, same=same), "a long, b long"), "join-more")


def text_name(text: Column) -> Column:
    """128-bit name of a text, A-Z and a-z alike."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.unhex(F.md5(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()).cast("binary")))


def jaccard_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, tile: int = TILE
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    own = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), text_name(F.col(text_col)).alias("name")
    )
    hashed = stored(
        map_arrow(own, partial(_hash_texts, percent=percent), "doc_id long, name binary, row long, n long, keys array<long>"), "join-hashed"
    )
    worded = hashed.filter("n > 0")
    names = stored(
        worded.groupBy("name").agg(F.min(F.when(F.col("keys").isNotNull(), F.col("row"))).alias("vid"), F.min("doc_id").alias("doc_id")),
        "join-names",
    )
    # A text that several tasks have seen is taken from one of them
    keyed = worded.filter("keys IS NOT NULL")
    extra = keyed.select("name", "row").join(names.select("name", "vid"), "name").filter("row <> vid").select("row")
    once = keyed.join(extra, "row", "left_anti").select(F.col("row").alias("vid"), "name", "n", "keys")
    rooted = names.join(components(links(own, once, percent=percent, tile=tile)), F.col("vid") == F.col("v"), "left")
    rooted = rooted.select("name", "doc_id", F.coalesce("root", "vid").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.select("name", "root").join(classes, "root").select("name", "component_id")
    linked_docs = worded.select("doc_id", "name", F.col("n").alias("n_shingles")).join(named, "name")
    empty = hashed.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked_docs.select("doc_id", "n_shingles", "component_id").unionByName(empty)
