"""Binary document dumps: catalog, metadata, exact parallel splitting, reading.

A dump file is records back to back, each starting with its own length, and has
no other marks. A file is nevertheless read by many tasks: every block guesses
its first record from the structure of the bytes and walks to its end; then each
guess is checked against where the previous block really ended, and blocks whose
guess was wrong are walked again from the right place. The result equals a walk
from the first byte, whatever the data holds.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from doclake.plans.index_plan import parse_metadata
from doclake.runtime import open_path, ship_package, stored
from doclake.sources.bson import FIXED, I32, MIN_RECORD, BsonError, Decoder, GuideParts, well_formed

BLOCK_BYTES = 128 << 20
WINDOW = 1 << 20
BATCH = 2048
BATCH_BYTES = 32 << 20
MAX_TASKS = 100_000
NOT_ZERO = re.compile(rb"[^\0]")
KNOWN = frozenset(FIXED) | {2, 3, 4, 5, 11, 12, 13, 14, 15}
# Fixed pattern: a collection file name, and the collection it holds.
NAME = r"(?i)^(.*)\.bson(\.gz)?$"
META_NAME = r"(?i)^(.*)\.metadata\.json(\.gz)?$"
FILE_GLOB = "*.[bB][sS][oO][nN]"
META_GLOB = "*.[mM][eE][tT][aA][dD][aA][tT][aA].[jJ][sS][oO][nN]"
GZ = ".[gG][zZ]"

BLOCK = "path string, block bigint, lo bigint, hi bigint, size bigint, start bigint, stop bigint, n_docs bigint, error string"
LEAF = pa.struct(
    [("path", pa.string()), ("key", pa.string()), ("pos", pa.int32()), ("type", pa.string()),
     ("integral", pa.bool_()), ("value", pa.string()), ("in_array", pa.bool_())]
)
PART = pa.struct(
    [("path", pa.string()), ("type", pa.string()), ("length", pa.int64()), ("low", pa.string()), ("high", pa.string()),
     ("n_docs", pa.int64()), ("n_values", pa.int64()), ("integral", pa.bool_()), ("scale", pa.int32()),
     ("key_chars", pa.int64())]
)
MAX_PARTS = 50_000
RECORD_ARROW = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("bson_len", pa.int64()), ("id", pa.string()),
     ("oid", pa.string()), ("doc", pa.string()), ("leaves", pa.list_(LEAF)), ("error", pa.string()),
     ("parts", pa.list_(PART))]
)
PARTS = (
    "array<struct<path:string,type:string,length:bigint,low:string,high:string,n_docs:bigint,n_values:bigint,"
    "integral:boolean,scale:int,key_chars:bigint>>"
)
RECORD = (
    "file string, offset bigint, bson_len bigint, id string, oid string, doc string, "
    "leaves array<struct<path:string,key:string,pos:int,type:string,integral:boolean,value:string,in_array:boolean>>, "
    "error string, parts " + PARTS
)


def _glob(plain: str) -> str:
    return "{" + plain + "," + plain + GZ + "}"


def dump_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every collection file with its size; only the listing is read, never the content.

    A scan leaves out files of zero bytes, so the names come from the listing
    Spark made for the scan.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", _glob(FILE_GLOB)).load(folder)
    paths = [(unquote(p).replace("file:///", "file:/", 1),) for p in reader.inputFiles()]
    listed = spark.createDataFrame(paths, "path string").join(reader.select("path", "length"), "path", "left")
    name = F.element_at(F.split("path", "/"), -1)
    return listed.select(
        F.regexp_extract(name, NAME, 1).alias("collection"),
        F.lower(name).endswith(".gz").alias("is_gz"),
        "path", F.coalesce("length", F.lit(0)).alias("length"),
    )


def dump_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """One row per collection; a plain file is preferred over its compressed twin."""
    files = dump_files(spark, folder)
    best = F.min(F.struct("is_gz", "path", "length")).alias("f")
    return files.groupBy("collection").agg(best).select("collection", "f.is_gz", "f.path", "f.length")


def dump_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """``(collection, indexes)`` for every collection; without a metadata file there are no indexes."""
    text = (
        spark.read.option("pathGlobFilter", _glob(META_GLOB)).text(folder, wholetext=True)
        .select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"), F.col("value"))
    )
    text = text.select(
        F.regexp_extract("name", META_NAME, 1).alias("collection"),
        F.lower("name").endswith(".gz").alias("is_gz"), "value",
    )
    best = text.groupBy("collection").agg(F.min(F.struct("is_gz", "value"))["value"].alias("metadata"))
    joined = dump_catalog(spark, folder).join(best, "collection", "left")
    return parse_metadata(joined).select("collection", "indexes")


class _Reader:
    """Ranged reads over one file with a sliding buffer."""

    def __init__(self, path: str, size: int, until: int | None = None):
        """``until``: where reading ahead is to stop; what is needed beyond is read bit by bit."""
        filesystem, local = open_path(path)
        self.file = filesystem.open_input_file(local)
        self.size, self.until, self.at, self.buf, self.n_read = size, size if until is None else until, 0, b"", 0

    def window(self, pos: int, n: int) -> tuple[bytes, int]:
        """A buffer holding ``[pos, pos + n)`` as far as the file goes, and the index of ``pos`` in it."""
        if pos < self.at or pos + n > self.at + len(self.buf):
            # What the buffer still holds from here on is not read again
            kept = self.buf[pos - self.at:] if self.at <= pos < self.at + len(self.buf) else b""
            ahead = max(WINDOW // 16, min(4 * WINDOW, self.until - pos))
            more = self.file.read_at(max(0, min(max(n, ahead), self.size - pos) - len(kept)), pos + len(kept))
            self.at, self.buf, self.n_read = pos, kept + more, self.n_read + len(more)
        return self.buf, pos - self.at

    def record_length(self, pos: int) -> int | None:
        """Length of the record at ``pos``, or None when no whole record is there."""
        if pos + MIN_RECORD > self.size:
            return None
        buf, i = self.window(pos, 4)
        n = I32(buf, i)[0]
        return n if n >= MIN_RECORD and pos + n <= self.size else None

    def plausible(self, pos: int, more: int = 2) -> bool:
        """Whether a well-formed record, and then some more, start at ``pos``."""
        for _ in range(more + 1):
            n = self.record_length(pos)
            if n is None:
                return False
            buf, i = self.window(pos, 6)
            if buf[i + 4] not in KNOWN and n != MIN_RECORD:
                return False
            inside = i + n <= len(buf)
            last = buf[i + n - 1] if inside else self.file.read_at(1, pos + n - 1)[0]
            if last != 0:
                return False
            buf, i = self.window(pos, n)
            if not well_formed(buf[i:i + n], 0, n):
                return False
            pos += n
            if pos == self.size:
                return True
        return True

    def guess(self, lo: int, hi: int) -> int | None:
        """First position in ``[lo, hi)`` that looks like a record start.

        Candidates are found by the zero high byte of a length below 16 MiB. A
        miss costs time only, as every guess is checked later.
        """
        pos = lo
        while pos < hi and pos + MIN_RECORD <= self.size:
            buf, i = self.window(pos, min(WINDOW, self.size - pos, max(WINDOW // 16, self.until - pos)))
            zero = buf.find(b"\0", i + 3)
            if zero < 0:
                pos += len(buf) - i - 2
                continue
            pos += zero - i - 3
            if buf.startswith(b"\0\0\0\0", zero - 3):
                # A run of zeros: no length is zero, so go on where the run ends.
                end = NOT_ZERO.search(buf, zero)
                pos += (end.start() if end else len(buf)) - zero
                continue
            if pos < hi and self.plausible(pos):
                return pos
            pos += 1
        return None


def _walk_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            reader = _Reader(row["path"], row["size"])
            pos = row["start"]
            if pos is None:
                pos = 0 if row["lo"] == 0 else reader.guess(row["lo"], row["hi"])
            row["start"], row["n_docs"], row["error"] = pos, 0, None
            while pos is not None and pos < row["hi"]:
                n = reader.record_length(pos)
                if n is None:
                    row["error"] = f"no whole record at {pos}"
                    break
                pos += n
                row["n_docs"] += 1
            # A cut record ends the file: nothing behind it can be reached by its lengths.
            row["stop"] = row["size"] if row["error"] else pos
        yield pa.RecordBatch.from_pylist(rows, batch.schema)


def _tasks(spark: SparkSession, blocks: int, n_bytes: int) -> int:
    """Tasks for a number of blocks: all cores busy, about one full block each on large dumps."""
    wanted = max(spark.sparkContext.defaultParallelism, -(-n_bytes // BLOCK_BYTES))
    return max(1, min(blocks, wanted, MAX_TASKS))


def _block_tasks(spark: SparkSession, blocks: DataFrame) -> int:
    n, total = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("hi") - F.col("lo")), F.lit(0))).first()
    return _tasks(spark, n, total)


def _unread_blocks(spark: SparkSession, files: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """The blocks of plain files, nothing known of them but their place; and how many tasks should read them."""
    sized = files.filter("length > 0").select("path", F.col("length").alias("size"))
    n_blocks, n_bytes = sized.agg(F.sum(F.ceil(F.col("size") / block_bytes)), F.sum("size")).first()
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(block_bytes).cast("bigint"))
    blocks = sized.select("path", "size", F.posexplode(starts).alias("block", "lo")).select(
        "path", F.col("block").cast("bigint").alias("block"), "lo",
        F.least(F.col("lo") + block_bytes, "size").alias("hi"), "size",
        *[F.lit(None).cast("bigint").alias(c) for c in ("start", "stop", "n_docs")],
        F.lit(None).cast("string").alias("error"),
    )
    return blocks, _tasks(spark, int(n_blocks or 0), int(n_bytes or 0))


def bson_blocks(spark: SparkSession, files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Exact split plan of plain files: per block the first record, the end, the record count.

    ``files`` has ``path`` and ``length``. The plan is written to the shared
    folder, so it is computed once.
    """
    ship_package(spark)
    blocks, tasks = _unread_blocks(spark, files, block_bytes)
    plan = stored(blocks.repartition(tasks).mapInArrow(_walk_blocks, BLOCK), "bson-blocks")
    while True:
        settled = _settled(plan)
        n_wrong = settled.filter("wrong").count()
        if n_wrong == 0:
            return settled.drop("wrong", "due")
        again = settled.filter("wrong").withColumn("start", F.col("due")).drop("wrong", "due")
        again = again.repartition(_tasks(spark, n_wrong, n_wrong * block_bytes)).mapInArrow(_walk_blocks, BLOCK)
        plan = stored(settled.filter("not wrong").drop("wrong", "due").unionByName(again), "bson-blocks")


def _settled(plan: DataFrame) -> DataFrame:
    """Every block's guess checked against where the blocks before it ended: ``wrong`` ones must begin at ``due``."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    checked = plan.withColumn("due", F.coalesce(F.max("stop").over(before), F.lit(0)))
    skip = F.col("due") >= F.col("hi")
    wrong = ~skip & ~F.col("start").eqNullSafe(F.col("due"))
    # A block that lies wholly inside a longer record has no record of its own.
    none = F.lit(None).cast("bigint")
    return checked.select(
        "path", "block", "lo", "hi", "size",
        F.when(skip, none).otherwise(F.col("start")).alias("start"),
        F.when(skip, none).otherwise(F.col("stop")).alias("stop"),
        F.when(skip, F.lit(0)).otherwise(F.col("n_docs")).cast("bigint").alias("n_docs"),
        F.when(~skip, F.col("error")).alias("error"),
        wrong.alias("wrong"), "due",
    )


class _Records:
    """Decodes raw records of one task into Arrow batches."""

    def __init__(self, output: str, allow_duplicate_keys: bool, schema: pa.Schema = RECORD_ARROW):
        self.schema, self.at = schema, None
        self.decoder = Decoder(output != "docs", allow_duplicate_keys)
        self.keep_leaves = output == "leaves"
        self.parts = GuideParts() if output == "parts" else None
        self.rows: list[dict] = []
        self.size = 0

    def add(self, file: str, offset: int, raw: bytes) -> None:
        row = {"file": file, "offset": offset, "bson_len": len(raw)}
        self.size += len(raw)
        try:
            row["doc"], row["id"], row["oid"], leaves = self.decoder.decode(raw)
        except BsonError as e:
            row["error"] = str(e)
        else:
            if self.keep_leaves:
                row["leaves"] = leaves
            elif self.parts is not None:
                self.parts.add(leaves)
                if len(self.parts.rows) > MAX_PARTS:
                    self.end(file)
        self.rows.append(row)

    def fail(self, file: str, offset: int, n_bytes: int | None, error: str) -> None:
        self.rows.append({"file": file, "offset": offset, "bson_len": n_bytes, "error": error})

    def end(self, file: str) -> None:
        """After a block or file: what was learned about its schema becomes one row."""
        if self.parts is not None and self.parts.rows:
            self.rows.append({"file": file, "offset": self.at, "parts": self.parts.take()})

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        """The rows so far, once there are enough of them or their records weigh enough."""
        if self.rows and (len(self.rows) >= least or self.size >= BATCH_BYTES):
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
            self.rows, self.size = [], 0


BLOCK_FACTS = (
    "struct<path:string,block:bigint,lo:bigint,hi:bigint,size:bigint,start:bigint,stop:bigint,n_docs:bigint,error:string,"
    "n_read:bigint>"
)
ONCE = RECORD + ", block " + BLOCK_FACTS
_BLOCK_FACTS = pa.struct(
    [("path", pa.string())] + [(n, pa.int64()) for n in ("block", "lo", "hi", "size", "start", "stop", "n_docs")]
    + [("error", pa.string()), ("n_read", pa.int64())]
)
ONCE_ARROW = RECORD_ARROW.append(pa.field("block", _BLOCK_FACTS))


def _once_reader(allow_duplicate_keys: bool):
    """Decodes blocks, and tells where each began and ended.

    A block without ``start`` is decoded from where its first record seems to start. One with it, and with the facts of
    the file's blocks (``around``), is decoded from there, and so are those behind it until a block is met that was begun
    right, or at ``until``, which another row takes over.
    """

    def one(records: _Records, reader: _Reader, path: str, size: int, block: dict, pos: int | None) -> Iterator[pa.RecordBatch]:
        records.at = block["lo"]
        fact = {"path": path, "size": size} | {k: block[k] for k in ("block", "lo", "hi")} | {"n_docs": 0, "error": None}
        fact["start"] = pos if pos is not None and pos < block["hi"] else None
        while pos is not None and pos < block["hi"]:
            n = reader.record_length(pos)
            if n is None:
                fact["error"] = f"no whole record at {pos}"
                records.fail(path, pos, size - pos, fact["error"])
                break
            buf, i = reader.window(pos, n)
            records.add(path, pos, buf[i:i + n])
            pos += n
            fact["n_docs"] += 1
            yield from records.batches(BATCH)
        records.end(path)
        fact["stop"] = size if fact["error"] else pos if fact["start"] is not None else None
        fact["n_read"], reader.n_read = reader.n_read, 0
        records.rows.append({"file": path, "offset": block["lo"], "block": fact})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = _Records("parts", allow_duplicate_keys, ONCE_ARROW)
        for batch in batches:
            for block in batch.to_pylist():
                path, size, pos = block["path"], block["size"], block["start"]
                reader = _Reader(path, size, block["hi"])
                if pos is None:
                    pos = 0 if block["lo"] == 0 else reader.guess(block["lo"], block["hi"])
                yield from one(records, reader, path, size, block, pos)
                for later in block.get("around") or []:
                    if later["block"] <= block["block"]:
                        continue
                    fact = records.rows[-1]["block"]
                    pos = pos if fact["stop"] is None else fact["stop"]
                    if fact["error"] or later["start"] == pos or later["lo"] >= (block["until"] or size):
                        break
                    reader.until = later["hi"]
                    yield from one(records, reader, path, size, later, pos)
        yield from records.batches(1)

    return read


def read_once(
    spark: SparkSession, folder: str, collections: list[str] | None = None, allow_duplicate_keys: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Records, schema facts (``parts``) and facts of the blocks (``block``) of a dump, every byte read once.

    Blocks are decoded from where their first record seems to start. Whether that was right shows when the facts of the
    blocks before are there: see ``misread``. Rows of a plain file belong to the block that their ``offset`` lies in.
    """
    ship_package(spark)
    files = dump_catalog(spark, folder)
    if collections:
        files = files.filter(F.col("collection").isin(list(collections)))
    blocks, tasks = _unread_blocks(spark, files.filter("not is_gz"), block_bytes)
    rows = blocks.repartition(tasks).mapInArrow(_once_reader(allow_duplicate_keys), ONCE)
    packed = files.filter("is_gz").select("path")
    n_packed = packed.count()
    if n_packed:
        from_gz = packed.repartition(min(n_packed, MAX_TASKS)).mapInArrow(_gz_reader("parts", allow_duplicate_keys, None), RECORD)
        rows = rows.unionByName(from_gz, allowMissingColumns=True)
    return _with_collection(rows, [*RECORD_ARROW.names, "block"])


def _with_collection(rows: DataFrame, names: list[str]) -> DataFrame:
    name = F.element_at(F.split("file", "/"), -1)
    return rows.select(F.regexp_extract(name, NAME, 1).alias("collection"), *names)


def without_blocks(rows: DataFrame, blocks: DataFrame, block_bytes: int) -> DataFrame:
    """Rows that do not lie in one of the blocks ``path, block``."""
    place = (F.col("file") == F.col("path")) & (F.floor(F.col("offset") / block_bytes) == F.col("block_no"))
    return rows.join(blocks.select("path", F.col("block").alias("block_no")), place, "left_anti")


def misread(facts: DataFrame, block_bytes: int, allow_duplicate_keys: bool = False) -> tuple[DataFrame, DataFrame] | None:
    """Of the facts of blocks (``path, block, lo, hi, size, start, stop, n_docs, error``): the blocks whose rows do not
    count (``path, block``), and rows to take in their place as ``read_once`` gives them. None if all are right."""
    spark, names = facts.sparkSession, [c.split()[0] for c in BLOCK.split(", ")]
    plan, redone = facts.select(*names), None
    gone = None
    while True:
        settled = stored(_settled(plan), "bson-checked")
        was = plan.select("path", "block", F.col("n_docs").alias("was"), F.col("error").alias("was_error"))
        # Blocks that lie within a record after all give no rows
        none = settled.join(was, ["path", "block"]).filter("n_docs <> was OR (error IS NULL AND was_error IS NOT NULL)")
        # Where a block is due before its own place, the one before is not settled yet: it waits, or is read from there on
        wrong = settled.filter("wrong AND due >= lo")
        n_wrong = wrong.count()
        if n_wrong == 0 and none.isEmpty():
            return None if gone is None else (gone, redone)
        until = F.lead("lo").over(Window.partitionBy("path").orderBy("block"))
        around = settled.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("block", "lo", "hi", "start"))).alias("around"))
        work = wrong.withColumn("start", F.col("due")).withColumn("until", until).drop("wrong", "due").join(around, "path")
        fresh = stored(
            work.repartition(_tasks(spark, max(1, n_wrong), n_wrong * block_bytes)).mapInArrow(_once_reader(allow_duplicate_keys), ONCE),
            "bson-redone",
        )
        read_again = fresh.filter("block IS NOT NULL").select("block.*").select(*names)
        off = stored(none.select("path", "block").unionByName(read_again.select("path", "block")).distinct(), "bson-misread")
        gone = off if gone is None else gone.unionByName(off).distinct()
        rows = _with_collection(fresh, [*RECORD_ARROW.names, "block"])
        # What was read again before may have been wrong again
        redone = rows if redone is None else without_blocks(redone, off, block_bytes).unionByName(rows)
        left = settled.drop("wrong", "due").join(read_again.select("path", "block"), ["path", "block"], "left_anti")
        plan = stored(left.unionByName(read_again), "bson-blocks")


def _block_reader(output: str, allow_duplicate_keys: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = _Records(output, allow_duplicate_keys)
        for batch in batches:
            for block in batch.to_pylist():
                reader, path, pos = _Reader(block["path"], block["size"]), block["path"], block["start"]
                for _ in range(block["n_docs"]):
                    n = reader.record_length(pos)
                    buf, i = reader.window(pos, n)
                    records.add(path, pos, buf[i:i + n])
                    pos += n
                    yield from records.batches(BATCH)
                if block["error"]:
                    records.fail(path, pos, block["size"] - pos, block["error"])
                records.end(path)
        yield from records.batches(1)

    return read


def _inflated(path: str) -> Iterator[bytes]:
    """Content of a gzip file in pieces of at most WINDOW bytes; of a cut or damaged file, what comes before the fault."""
    filesystem, local = open_path(path)
    with filesystem.open_input_stream(local, compression=None, buffer_size=1 << 20) as stream:
        inflater, packed = zlib.decompressobj(wbits=31), b""
        while True:
            packed = packed or stream.read(1 << 20)
            if not packed:
                return
            if inflater.eof:  # another member follows
                inflater = zlib.decompressobj(wbits=31)
            try:
                plain = inflater.decompress(packed, WINDOW)
            except zlib.error:
                return
            packed = inflater.unused_data if inflater.eof else inflater.unconsumed_tail
            if plain:
                yield plain


def gz_records(path: str) -> Iterator[tuple[int, bytes | None, str | None]]:
    """``(offset, record, error)`` streamed out of one compressed file; memory holds one record and one buffer. A cut
    file gives its whole records and one error."""
    pieces, offset, pending = _inflated(path), 0, b""
    for piece in pieces:
        pending += piece
        at = 0
        while len(pending) - at >= 4:
            n = I32(pending, at)[0]
            if n < MIN_RECORD:
                yield offset, None, f"no whole record at {offset}"
                return
            if len(pending) - at < n:
                # A long record: gathered in a list, since joining piece by piece would copy it again and again
                parts, size = [pending[at:]], len(pending) - at
                while size < n and (more := next(pieces, b"")):
                    parts.append(more)
                    size += len(more)
                pending, at = b"".join(parts), 0
                if size < n:
                    break
            yield offset, pending[at:at + n], None
            at += n
            offset += n
        pending = pending[at:]
    if pending:
        yield offset, None, f"no whole record at {offset}"


def _gz_reader(output: str, allow_duplicate_keys: bool, sample: int | None):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = _Records(output, allow_duplicate_keys)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                for offset, raw, error in islice(gz_records(path), sample):
                    if raw is None:
                        records.fail(path, offset, None, error)
                    else:
                        records.add(path, offset, raw)
                    yield from records.batches(BATCH)
                records.end(path)
        yield from records.batches(1)

    return read


def read_bson(
    spark: SparkSession,
    folder: str,
    collections: list[str] | None = None,
    leaves: bool = False,
    allow_duplicate_keys: bool = False,
    block_bytes: int = BLOCK_BYTES,
    on_error: str = "null",
    sample: int | None = None,
) -> DataFrame:
    """Records of a dump as ``(collection, file, offset, bson_len, id, oid, doc, leaves, error)``.

    A record that cannot be decoded keeps its row with ``error`` set and a null
    ``doc``; a cut tail gives one such row. ``on_error="fail"`` stops the job.
    Compressed files cannot be split: each is streamed by one task and its rows
    are then dealt out over all cores for the work that follows. ``sample`` reads
    the first records of every file; blocks behind them are not opened.
    """
    if on_error not in ("null", "fail"):
        raise ValueError(f"unknown on_error {on_error!r}: null or fail")
    output = "leaves" if leaves else "docs"
    rows = _read(spark, folder, collections, output, allow_duplicate_keys, block_bytes, sample).drop("parts")
    if on_error == "fail":
        stop = F.raise_error(F.concat(F.col("file"), F.lit(": "), F.col("error"))).cast("string")
        rows = rows.withColumn("error", F.when(F.col("error").isNotNull(), stop))
    return rows


def read_bson_and_parts(
    spark: SparkSession,
    folder: str,
    collections: list[str] | None = None,
    allow_duplicate_keys: bool = False,
    block_bytes: int = BLOCK_BYTES,
    sample: int | None = None,
) -> DataFrame:
    """Records and, in extra rows with ``parts`` set, the schema facts of each block: one decoding pass for both."""
    return _read(spark, folder, collections, "parts", allow_duplicate_keys, block_bytes, sample).drop("leaves")


def _read(
    spark: SparkSession, folder: str, collections: list[str] | None, output: str, allow_duplicate_keys: bool,
    block_bytes: int, sample: int | None,
) -> DataFrame:
    files = dump_catalog(spark, folder)
    if collections:
        files = files.filter(F.col("collection").isin(list(collections)))
    plain, packed = files.filter("not is_gz"), files.filter("is_gz")
    blocks = bson_blocks(spark, plain, block_bytes).filter("n_docs > 0 or error is not null")
    if sample is not None:
        before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        left = F.lit(sample) - F.coalesce(F.sum("n_docs").over(before), F.lit(0))
        blocks = blocks.withColumn("left", left).filter("left > 0").withColumns(
            {"n_docs": F.least("n_docs", "left"), "error": F.when(F.col("left") > F.col("n_docs"), F.col("error"))}
        ).drop("left")
    rows = blocks.repartition(_block_tasks(spark, blocks)).mapInArrow(_block_reader(output, allow_duplicate_keys), RECORD)
    n_packed = packed.count()
    if n_packed:
        from_gz = packed.select("path").repartition(min(n_packed, MAX_TASKS)).mapInArrow(
            _gz_reader(output, allow_duplicate_keys, sample), RECORD
        )
        # Records with parts go to storage, which splits them by itself and keeps a collection's rows together.
        if output != "parts":
            from_gz = from_gz.repartition(max(spark.sparkContext.defaultParallelism, n_packed))
        rows = rows.unionByName(from_gz)
    return _with_collection(rows, RECORD_ARROW.names)


def _offset_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
    for batch in batches:
        for block in batch.to_pylist():
            reader = _Reader(block["path"], block["size"])
            offsets, lengths, pos = [], [], block["start"]
            for _ in range(block["n_docs"]):
                n = reader.record_length(pos)
                offsets.append(pos)
                lengths.append(n)
                pos += n
            if offsets:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block["path"]] * len(offsets)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    schema=schema,
                )


def bson_offsets(spark: SparkSession, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(path, offset, length)`` of every record of the plain files."""
    blocks = bson_blocks(spark, dump_catalog(spark, folder).filter("not is_gz"), block_bytes).filter("n_docs > 0")
    return blocks.repartition(_block_tasks(spark, blocks)).mapInArrow(_offset_reader, "path string, offset bigint, length bigint")
