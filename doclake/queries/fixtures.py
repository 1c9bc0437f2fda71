"""Dump files made from the tables, so that the dump queries have something to read."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from datetime import datetime
from decimal import Decimal

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from doclake.runtime import open_path, scratch, ship_package

EPOCH = datetime(1970, 1, 1)


class ObjectId(bytes):
    """Twelve raw bytes."""


def _element(name: str, value) -> bytes:
    key = name.encode() + b"\0"
    if value is None:
        return b"\x0a" + key
    if isinstance(value, ObjectId):
        return b"\x07" + key + value
    if isinstance(value, bool):
        return b"\x08" + key + (b"\1" if value else b"\0")
    if isinstance(value, int):
        if -(1 << 31) <= value < 1 << 31:
            return b"\x10" + key + struct.pack("<i", value)
        return b"\x12" + key + struct.pack("<q", value)
    if isinstance(value, float):
        return b"\x01" + key + struct.pack("<d", value)
    if isinstance(value, Decimal):
        sign, digits, exponent = value.as_tuple()
        number = int("".join(map(str, digits)))
        high = sign << 63 | (exponent + 6176) << 49 | number >> 64
        return b"\x13" + key + struct.pack("<QQ", number & (1 << 64) - 1, high)
    if isinstance(value, str):
        raw = value.encode() + b"\0"
        return b"\x02" + key + struct.pack("<i", len(raw)) + raw
    if isinstance(value, datetime):
        ms = (value - EPOCH) // (datetime.resolution * 1000)
        return b"\x09" + key + struct.pack("<q", ms)
    if isinstance(value, bytes):
        return b"\x05" + key + struct.pack("<i", len(value)) + b"\0" + value
    if isinstance(value, dict):
        return b"\x03" + key + encode(value)
    if isinstance(value, list):
        return b"\x04" + key + encode({str(i): v for i, v in enumerate(value)})
    raise TypeError(type(value))


def encode(doc: dict) -> bytes:
    body = b"".join([_element(k, v) for k, v in doc.items()])
    return struct.pack("<i", len(body) + 5) + body + b"\0"


def write_dump(rows: DataFrame, name: str, gz: bool = False, folder: str | None = None) -> str:
    """One dump file per partition, ``<name>-<partition>.bson[.gz]``; gives the folder.

    Top-level columns become fields, structs objects, arrays arrays. Files
    appear under their final name only when complete, so a task that runs twice
    leaves the same file.
    """
    ship_package(rows.sparkSession)
    folder = folder or scratch(rows.sparkSession, "dump")
    filesystem, local = open_path(folder)
    filesystem.create_dir(local, recursive=True)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_path(folder)
        target = f"{base}/{name}-{TaskContext.get().partitionId():05d}.bson" + (".gz" if gz else "")
        part = f"{base}/_{uuid.uuid4().hex}.tmp"
        count = 0
        with fs.open_output_stream(part, compression="gzip" if gz else None) as out:
            for batch in batches:
                out.write(b"".join([encode(row) for row in batch.to_pylist()]))
                count += batch.num_rows
        fs.move(part, target)
        yield pa.RecordBatch.from_pydict({"n": pa.array([count], pa.int64())})

    rows.mapInArrow(save, "n bigint").agg(F.sum("n")).collect()
    return folder


def write_files(rows: DataFrame, folder: str) -> None:
    """One small file per row of ``(name, content)``."""
    ship_package(rows.sparkSession)
    filesystem, local = open_path(folder)
    filesystem.create_dir(local, recursive=True)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_path(folder)
        for batch in batches:
            for row in batch.to_pylist():
                part = f"{base}/_{uuid.uuid4().hex}.tmp"
                with fs.open_output_stream(part, compression=None) as out:
                    out.write(row["content"].encode())
                fs.move(part, f"{base}/{row['name']}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    rows.mapInArrow(save, "n bigint").agg(F.sum("n")).collect()


def new_folder(spark: SparkSession) -> str:
    return scratch(spark, "dump")
