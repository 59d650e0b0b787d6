"""Helpers that all operators of this subpackage use: code shipping, shared folders, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they need no shared source folder."""
    context: SparkContext = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-code-")) / f"{package.name}_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; below the warehouse if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def materialise(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back: cut lineage that survives lost executors.

    The files go when the application ends.
    """
    path, context = shared_folder(frame.sparkSession), frame.sparkSession.sparkContext
    frame.write.option("compression", "zstd").parquet(path)
    own = context._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(own)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release_memory() -> None:
    """Give what Arrow and the C library keep for reuse back to the system: Python workers outlive their tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than GNU's
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    ship_code(frame.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release_memory()

    return frame.mapInArrow(run, schema)


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the strings of a column hold about ``limit`` bytes at most; one row is never cut."""
    for batch in batches:
        start, held = 0, 0
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        for row, size in enumerate(sizes):
            if row > start and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if batch.num_rows > start:
            yield batch.slice(start)


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def text_digest() -> F.Column:
    return F.md5(F.coalesce(F.col("text"), F.lit("")))
