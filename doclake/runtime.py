"""Session helpers: shared scratch storage and input spreading."""

from __future__ import annotations

import io
import re
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    and the master is local (one machine) a folder of our own is made; on a
    cluster such a folder would be a different one on each executor, so that raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="doclake-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_dir(spark)}/doclake/{name}-{uuid.uuid4().hex}"


_open_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession):
    """What this thread stores inside is removed at the end; results must be written elsewhere by then."""
    scopes = _open_scopes.__dict__.setdefault("paths", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            remove(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives executor loss."""
    spark = df.sparkSession
    path = scratch(spark, name)
    if _open_scopes.__dict__.get("paths"):
        _open_scopes.paths[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def children(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """``(path, name)`` of what a folder holds, names without the escapes of partition folders; none if there is no folder."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    plain = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return [(e.getPath().toString(), plain(e.getPath().getName())) for e in files.listStatus(at)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system Spark can write to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work at least one partition per core.

    A large input already has more splits than cores and passes through
    untouched, so this never shuffles big data.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def open_path(path: str):
    """``(filesystem, path)`` for a URI or a plain local path."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        scheme, rest = path.split("://", 1)
        return pafs.FileSystem.from_uri(("s3" if scheme == "s3a" else scheme) + "://" + rest)
    return pafs.LocalFileSystem(), path


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python tasks on every executor, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(PACKAGE.rglob("*.py")):
            z.write(source, source.relative_to(PACKAGE.parent))
    folder = scratch(spark, "package")
    filesystem, local = open_path(folder)
    filesystem.create_dir(local, recursive=True)
    with filesystem.open_output_stream(f"{local}/{PACKAGE.name}.zip", compression=None) as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/{PACKAGE.name}.zip")
    _shipped.add(app)
