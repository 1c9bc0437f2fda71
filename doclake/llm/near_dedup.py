"""Near-duplicate classes by Order MinHash and banded alignment.

A text is the sequence of its five-word shingles, each labelled with its occurrence number. Two texts are near
duplicates when an order-keeping alignment of the sequences matches ``a`` shingles with ``a / (n1 + n2 - a) >= 0.8``;
classes are the connected components of these links.

1. Order MinHash: ``BANDS`` times, the ``SAMPLE`` labelled shingles of smallest hash are taken and hashed in their text
   order. At similarity 0.8 a band agrees with probability 0.8^3, one of 16 with 0.99999.
2. Texts that agree in a band form a group. A group of up to ``SMALL`` texts is settled in one task, which aligns until
   its links are complete. A larger one elects the member whose groups are largest as leader, and only (member, leader)
   pairs are aligned, so a group of n costs n alignments.
3. Where the links so far leave the members of such a group in several classes, links among them could be missing. All
   members of all these groups are open. Their labelled shingles are cut into blocks by hash, so many that two linked
   texts must agree in a block (see ``jaccard_join``); texts that do meet in bounded tiles, where the Hamming distance of
   parity sketches tells which may be linked across classes, and only those are fetched and aligned. This step is
   exact: no link between open texts is missed, and no pair leaves a task but links that join two classes.

So a link is found if its two texts agree in one of the bands.

Equal texts are one vertex, told apart by 64-bit hashes
of the texts (the chance of one collision among n texts is n^2 / 2^65).

Defined cases: words are runs of letters, digits and ``_``, lower-cased; fewer than five words are one shingle; a null
text or one without words is a class of its own. The class is named by its smallest identifier, which is the document
that stays; null identifiers lose to any other. Repeated rows belong to one class. An empty table gives an empty result;
further columns are ignored by ``near_duplicates`` and passed on by ``without_near_duplicates``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import WordIds, components, map_arrow, mix, shingles, signed, whole_row
from doclake.llm.jaccard_join import all_keys, block_groups, parity_sketch, settle_classes
from doclake.runtime import stored

K = 5
THRESHOLD = 0.8
BANDS, SAMPLE = 16, 3
TILE = 1024  # open texts that meet in a task
SMALL = 16  # members of a group that one task settles
WIDE = 1 << 20  # hashes scrambled at once
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, 1 + BANDS, dtype=np.uint64) * _STEP)


def labelled(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles with their occurrence number, in text order."""
    hashes = shingles(words.astype(np.uint64), K)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    if new.all():
        return hashes
    place = np.arange(len(ordered))
    occurrence = place - np.maximum.accumulate(np.where(new, place, 0))
    out = np.empty_like(hashes)
    out[order] = mix(ordered + occurrence.astype(np.uint64) * _STEP)
    return out


def order_min_hashes(labels: np.ndarray) -> np.ndarray:
    """One hash per band: the labelled shingles of smallest hash, in text order."""
    out = _SEEDS[:BANDS].copy()
    n = min(SAMPLE, len(labels))
    step = max(1, WIDE // len(labels))
    for low in range(0, BANDS, step):
        scrambled = mix(labels[None, :] ^ _SEEDS[low : min(BANDS, low + step), None])
        chosen = np.argpartition(scrambled, n - 1, axis=1)[:, :n]
        chosen.sort(axis=1)
        values = np.take_along_axis(scrambled, chosen, axis=1)
        for place in range(n):
            out[low : low + step] = mix(out[low : low + step] + values[:, place])
    return out


def _longest_rise(values: np.ndarray) -> int:
    tails: list[int] = []
    for v in values.tolist():
        at = bisect_left(tails, v)
        if at == len(tails):
            tails.append(v)
        else:
            tails[at] = v
    return len(tails)


def linked(a: np.ndarray, b: np.ndarray, b_order: np.ndarray, threshold: float) -> bool:
    """Whether the banded alignment of two labelled sequences reaches the threshold. ``b_order`` sorts ``b``."""
    total = len(a) + len(b)
    least = threshold / (1 + threshold) * total - 1e-9  # shingles that must match
    if min(len(a), len(b)) < least:
        return False
    ordered = b[b_order]
    at = np.searchsorted(ordered, a)
    at[at == len(b)] = 0
    i = np.flatnonzero(ordered[at] == a)
    if len(i) < least:
        return False
    j = b_order[at[i]]
    band = total - 2 * least  # beyond this shift too many shingles on one side have no match
    j = j[np.abs(i - j) <= band + 1]
    if len(j) < least:
        return False
    return bool((np.diff(j) > 0).all()) or _longest_rise(j) >= least


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, seen = WordIds(), set()
    for batch in batches:
        vertices, bands = [], []
        for v, text in zip(batch.column("v").to_pylist(), batch.column("text").to_pylist()):
            if v in seen:  # a copy within this task; others are found by grouping
                continue
            if len(seen) < 500_000:
                seen.add(v)
            words = ids.of(text).astype(np.uint32)
            if len(words):
                vertices.append(v)
                bands.append(signed(order_min_hashes(labelled(words))))
        if vertices:
            flat = pa.array(np.concatenate(bands))
            yield pa.RecordBatch.from_arrays(
                [pa.array(vertices, pa.int64()), pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32), flat)],
                names=["v", "keys"],
            )


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids = WordIds()
    for batch in batches:
        words = [ids.of(t).astype(np.uint32).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("v"), pa.array(words, pa.binary())], names=["v", "words"])


def _of(words: bytes) -> np.ndarray:
    return labelled(np.frombuffer(words, np.uint32))


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    held, b, b_order = None, None, None
    for batch in batches:
        out = []
        for words, leader, leader_words in zip(*(batch.column(c).to_pylist() for c in ("words", "leader", "leader_words"))):
            if leader != held:
                held, b = leader, _of(leader_words)
                b_order = np.argsort(b, kind="stable")
            out.append(linked(_of(words), b, b_order, threshold))
        yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("leader"), pa.array(out)], names=["v", "leader", "linked"])


def _blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Keys, sketch and labelled shingles (in text order) of open texts."""
    for batch in batches:
        own = [_of(w) for w in batch.column("words").to_pylist()]
        keys = [signed(all_keys(np.sort(labels), percent)) for labels in own]
        ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vid"), pa.array([len(x) for x in own], pa.int64()), pa.ListArray.from_arrays(ends, flat),
                pa.array([parity_sketch(x).tobytes() for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary()),
            ],
            names=["vid", "n", "keys", "sketch", "shingles"],
        )


def _aligned(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    return linked(a, b, np.argsort(b, kind="stable"), threshold)


def vertex(text: Column) -> Column:
    """A 64-bit name for a text; null for a text without words."""
    return F.when(F.coalesce(text, F.lit("")).rlike(r"(?U)\w"), F.xxhash64(F.lit(K), text))


def _members(keyed: DataFrame) -> DataFrame:
    """``key, v`` of the groups with at least two vertices."""
    several = keyed.groupBy("key").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).filter("lo <> hi").select("key")
    members = keyed.join(several, "key").distinct()
    return stored(members.join(members.groupBy("key").agg(F.count("*").alias("n")), "key"), "near-members")


def _small_groups(members: DataFrame) -> DataFrame:
    """``g, v`` of the groups one task can settle, each set of members once."""
    sets = members.filter(F.col("n") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_list("v")).alias("vs"))
    return sets.select("vs").distinct().select(F.xxhash64("vs").alias("g"), F.explode("vs").alias("v"))


def _pairs(members: DataFrame) -> DataFrame:
    """(member, leader) pairs of the larger groups."""
    large = members.filter(F.col("n") > SMALL)
    central = large.groupBy("v").agg(F.sum("n").alias("weight"))
    leaders = large.join(central, "v").groupBy("key").agg(F.max_by("v", F.struct("weight", "v")).alias("leader"))
    return large.join(leaders, "key").filter("v <> leader").select("v", "leader").distinct()


def _settled(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Links that connect the members of small groups as far as they are linked at all."""
    for batch in batches:
        links = []
        for group in batch.column("group").to_pylist():
            texts = [(m["v"], _of(m["words"])) for m in sorted(group, key=lambda m: m["v"])]
            part = list(range(len(texts)))
            for j in range(1, len(texts)):
                order = np.argsort(texts[j][1], kind="stable")
                for i in range(j):
                    if part[i] != part[j] and linked(texts[i][1], texts[j][1], order, threshold):
                        links.append((texts[i][0], texts[j][0]))
                        part = [part[i] if x == part[j] else x for x in part]
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _settle(groups: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    gathered = groups.join(words, "v").groupBy("g").agg(F.collect_list(F.struct("v", "words")).alias("group"))
    return stored(map_arrow(gathered.select("group"), partial(_settled, threshold=threshold), "a long, b long"), "near-links")


def _verify(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    own = pairs.join(words, "v")
    both = own.join(words.select(F.col("v").alias("leader"), F.col("words").alias("leader_words")), "leader")
    return map_arrow(both, partial(_verified, threshold=threshold), "v long, leader long, linked boolean")


def _open(verified: DataFrame, links: DataFrame) -> DataFrame:
    """``v, root`` of the members of groups that the links so far leave in several classes."""
    members = verified.select("v", "leader").unionByName(verified.select(F.col("leader").alias("v"), "leader").distinct())
    rooted = stored(
        members.join(components(links), "v", "left").select("v", "leader", F.coalesce("root", "v").alias("root")), "near-rooted"
    )
    several = rooted.groupBy("leader").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
    return stored(rooted.join(several, "leader", "left_semi").select("v", "root").distinct(), "near-open")


def _settle_open(still_open: DataFrame, words: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """Links that join the classes of open texts as far as they are linked at all."""
    percent = int(100 * threshold)  # what is aligned to the threshold has at least this Jaccard similarity
    own = still_open.select(F.col("v").alias("vid")).distinct().join(words.withColumnRenamed("v", "vid"), "vid")
    blocks = partial(_blocks, percent=percent)
    sets = stored(
        map_arrow(own.select("vid", "words"), blocks, "vid long, n long, keys array<long>, sketch binary, shingles binary"), "near-blocks"
    )
    return settle_classes(
        block_groups(sets.select("vid", "n", "keys"), TILE), sets.drop("keys"), links, percent, partial(_aligned, threshold=threshold)
    )


def near_links(vertices: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links ``a, b`` between the texts of ``v, text`` rows that connect every class."""
    sketches = stored(map_arrow(vertices, _sketch, "v long, keys array<long>"), "near-sketches")
    members = _members(sketches.select(F.explode("keys").alias("key"), "v"))
    words = stored(
        map_arrow(vertices.join(members.select("v").distinct(), "v"), _words, "v long, words binary")
        .groupBy("v").agg(F.first("words").alias("words")),
        "near-words",
    )
    links = _settle(_small_groups(members), words, threshold)
    verified = stored(_verify(_pairs(members), words, threshold), "near-verified")
    links = stored(links.unionByName(_linked(verified)), "near-links")
    still_open = _open(verified, links)
    if still_open.isEmpty():
        return links
    return links.unionByName(_settle_open(still_open, words, links, threshold))


def _linked(verified: DataFrame) -> DataFrame:
    return verified.filter("linked").select(F.col("v").alias("a"), F.col("leader").alias("b"))


def _classes(texts: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``v, root`` of every vertex of ``texts`` (``v, doc_id, n``: smallest identifier and rows), and per ``root`` the
    class: ``class_id, class_size`` and ``keeper``, the vertex of the document that stays."""
    rooted = texts.join(components(links), "v", "left").withColumn("root", F.coalesce("root", "v"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "v"))
    classes = rooted.groupBy("root").agg(first.alias("first"), F.sum("n").alias("class_size"))
    return rooted, classes.select("root", "class_size", F.col("first.doc_id").alias("class_id"), F.col("first.v").alias("keeper"))


def _by_text(narrow: DataFrame) -> DataFrame:
    return narrow.filter("v IS NOT NULL").groupBy("v").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document: ``doc_id, class_id, class_size, kept``."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    own = own.withColumn("v", vertex(F.col("text")))
    narrow = own.select("doc_id", "v")
    rooted, classes = _classes(_by_text(narrow), near_links(own.filter("v IS NOT NULL").select("v", "text"), threshold))
    named = rooted.select("v", "root").join(classes, "root").select("v", "class_id", "class_size")
    in_class = narrow.filter("v IS NOT NULL").join(named, "v").select("doc_id", "class_id", "class_size")
    alone = narrow.filter("v IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return in_class.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def without_near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One document of every class, with all its columns (of repeated rows, one of them)."""
    own = docs.select(
        whole_row(docs), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).withColumn("v", vertex(F.col("text")))
    worded = own.filter("v IS NOT NULL")
    _, classes = _classes(_by_text(own.select("doc_id", "v")), near_links(worded.select("v", "text"), threshold))
    # Rows are dealt out by identifier and text, so that neither many copies nor many nulls meet in one task
    keepers = classes.select(F.coalesce("class_id", "keeper").alias("id"), F.col("keeper").alias("v"))
    kept = worded.select("row", F.coalesce("doc_id", "v").alias("id"), "v").join(keepers, ["id", "v"])
    once = kept.groupBy("id", "v").agg(F.first("row").alias("row"))
    return once.select("row.*").unionByName(own.filter("v IS NULL").select("row.*"))
