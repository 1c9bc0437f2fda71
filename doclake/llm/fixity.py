"""Fixity audit of WARC replicas by Merkle trees.

A replica is a set of records with their file, offset and bytes. Every record is hashed; the records of one range of
offsets (64 KiB), in order, make a leaf of the tree; sixteen neighbours make a node of the next level, up to one root
over all files. Two replicas are compared from the root down: only the children of nodes that differ are read, and only
the records of ranges that differ are compared one by one. What comes out is each record that was changed, is missing or
is extra, with its place.

A group is never larger than the records that start in one range, or sixteen nodes. Levels are written down, since the
way down reads them again; hashes, not contents, are what is kept.

``warc_records`` lays out pages as records: sorted by identifier, url and content hash, one after the other, in files of
``file_bytes`` (a record belongs to the file in which it starts). Offsets are running sums over even ranges of the order.

Defined cases: null urls and contents are empty, a null identifier is written as ``null``; repeated rows are records of
their own; two records at one place of a replica are compared by their hashes in order; an empty replica has no root, and
every record of the other is missing or extra. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from doclake.runtime import stored

RANGE_BYTES = 1 << 16
FAN_OUT_BITS = 4  # sixteen children
FILE_RANGE_BITS = 20  # ranges a file can have: files of up to 64 GiB
FILE_BYTES = 1 << 30


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a resource record."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("null")),
        F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def warc_records(pages: DataFrame, *, file_bytes: int = FILE_BYTES, more: dict[str, Column] | None = None) -> DataFrame:
    """``page_id, file, offset, length, digest`` of the records of ``page_id, url, html`` rows, and columns of ``more``."""
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.octet_length(record).cast("long").alias("length"), F.sha2(record.cast("binary"), 256).alias("digest"),
        *(c.alias(n) for n, c in (more or {}).items()),
    )
    order = ["page_id", "url", "digest", "tie"]
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = narrow.withColumn("tie", F.monotonically_increasing_id())
    dealt = stored(tied.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "records")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = dealt.groupBy("part").agg(F.sum("length").alias("bytes")).select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start")
    )
    here = F.sum("length").over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    at = F.col("start") + F.col("here") - F.col("length")
    return dealt.withColumn("here", here).join(starts, "part").select(
        "page_id", F.floor(at / file_bytes).cast("long").alias("file"), F.pmod(at, F.lit(file_bytes)).alias("offset"),
        "length", "digest", *(more or {}),
    )


def leaves(records: DataFrame) -> DataFrame:
    """Records with the number of their range in the whole replica."""
    node = F.shiftleft(F.col("file"), FILE_RANGE_BITS) + F.floor(F.col("offset") / RANGE_BYTES)
    return records.withColumn("node", node)


def _combined(rows: DataFrame, *parts: str) -> DataFrame:
    """One hash per node over its members in order."""
    members = F.array_sort(F.collect_list(F.struct(*parts)))
    text = F.array_join(F.transform(members, lambda m: F.concat_ws(":", *(m[p].cast("string") for p in parts))), "|")
    return rows.groupBy("node").agg(F.sha2(text, 256).alias("hash"))


def tree(leaf_rows: DataFrame, levels: int) -> list[DataFrame]:
    """``node, hash`` of every level, ranges first; the last has the root."""
    out = [stored(_combined(leaf_rows, "offset", "length", "digest"), "merkle")]
    for _ in range(levels):
        upper = out[-1].select(F.shiftright("node", FAN_OUT_BITS).alias("node"), F.col("node").alias("child"), "hash")
        out.append(stored(_combined(upper, "child", "hash"), "merkle"))
    return out


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.withColumnRenamed("hash", "a").join(b.withColumnRenamed("hash", "b"), "node", "full")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("node")


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Records (``page_id, file, offset, length, digest``) that differ between two replicas: ``file, offset, page_id,
    status, length_a, length_b, digest_a, digest_b`` with status ``changed``, ``missing`` (from b) or ``extra`` (in b)."""
    a, b = stored(leaves(a), "replica"), stored(leaves(b), "replica")
    last = a.select("node").unionByName(b.select("node")).agg(F.max("node")).first()[0] or 0
    levels = -(-last.bit_length() // FAN_OUT_BITS)
    of_a, of_b = tree(a, levels), tree(b, levels)
    differ = stored(_differing(of_a[-1], of_b[-1]), "differing")
    for level_a, level_b in zip(of_a[-2::-1], of_b[-2::-1]):
        if differ.isEmpty():
            break
        below = [
            level.withColumn("up", F.shiftright("node", FAN_OUT_BITS))
            .join(differ.withColumnRenamed("node", "up"), "up", "left_semi").drop("up")
            for level in (level_a, level_b)
        ]
        differ = stored(_differing(*below), "differing")
    # Records at one place are told apart by their order there
    same_place = Window.partitionBy("node", "file", "offset").orderBy("digest", "length")
    left, right = (
        rows.join(differ, "node", "left_semi").withColumn("nth", F.row_number().over(same_place)).select(
            "node", "file", "offset", "nth", *(F.col(c).alias(f"{c}_{side}") for c in ("page_id", "length", "digest"))
        )
        for rows, side in ((a, "a"), (b, "b"))
    )
    both = left.join(right, ["node", "file", "offset", "nth"], "full")
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return both.filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")) | ~F.col("length_a").eqNullSafe(F.col("length_b"))).select(
        "file", "offset", F.coalesce("page_id_a", "page_id_b").alias("page_id"), status.alias("status"),
        "length_a", "length_b", "digest_a", "digest_b",
    )
