"""Parquet tables in versions.

A table's folder holds data folders that are never changed once written, and one
small manifest per version that lists the data folders it is made of.  A write
adds folders and then puts the next manifest, which alone makes them visible: it
takes effect as a whole or not at all.  A reader keeps the folders of the version
it opened, whatever is written meanwhile.  The manifest also says which batches
of which streams it contains, so that a replayed batch can be told.

Manifests list folders, at most a few for each partition, never files or rows.
Read such a table with ``read``, since plain Parquet reads would mix versions.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.sources.durable import shuffles_dropped

MANIFESTS = "_versions"
#: Partition column that keeps the data of different writes apart.
LOAD = "load"


class StaleVersion(RuntimeError):
    """Another writer has put the version that this one was about to put."""


@dataclass(frozen=True)
class Version:
    """Data folders below the table's, by a label of what they hold, and the last batch of each stream."""

    number: int = 0
    folders: tuple[tuple[str, str], ...] = ()
    applied: dict[str, int] = field(default_factory=dict)

    def without(self, labels) -> tuple[tuple[str, str], ...]:
        return tuple(entry for entry in self.folders if entry[0] not in labels)

    def has(self, batch: tuple[str, int] | None) -> bool:
        """Whether a stream's batch is part of this version."""
        return batch is not None and self.applied.get(batch[0], -1) >= batch[1]

    def next(self, folders, batch: tuple[str, int] | None = None) -> Version:
        applied = self.applied | ({batch[0]: batch[1]} if batch else {})
        return Version(self.number + 1, tuple(folders), applied)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it knows it."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), own


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists (nothing is listed or read)."""
    files, own = file_system(spark, path)
    return files.exists(own)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read on the driver."""
    files, own = file_system(spark, path)
    stream = files.open(own)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _manifest(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{number:012d}.json"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that are kept, ascending."""
    files, pattern = file_system(spark, f"{path.rstrip('/')}/{MANIFESTS}/*.json")
    return sorted(int(status.getPath().getName()[:-5]) for status in files.globStatus(pattern) or ())


def open_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """A version by its number, or the newest; version 0 is the empty table before the first write."""
    if number is None:
        number = max(numbers(spark, path), default=0)
    if not number:
        return Version()
    content = json.loads(read_text(spark, _manifest(path, number)))
    return Version(number, tuple((label, folder) for label, folder in content["folders"]), content["applied"])


def commit(spark: SparkSession, path: str, version: Version) -> None:
    """Put a version's manifest, unless one of that number is there: then another writer was faster."""
    jvm = spark.sparkContext._jvm
    target = _manifest(path, version.number)
    files, beside = file_system(spark, f"{path.rstrip('/')}/{MANIFESTS}/.{uuid.uuid4().hex}")
    out = files.create(beside, False)
    out.write(bytearray(json.dumps(dataclasses.asdict(version)).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(beside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(beside), files.makeQualified(file_system(spark, target)[1]), plain)
    except Py4JJavaError as problem:
        files.delete(beside, False)
        if "FileAlreadyExistsException" in problem.java_exception.getClass().getName():
            raise StaleVersion(f"version {version.number} of {path} was written by another writer") from None
        raise


def add_folders(df: DataFrame, path: str, partitions: list[str] = []) -> tuple[tuple[str, str], ...]:  # noqa: B006
    """Write rows beside those of all versions; the new folders, labelled by their partition values.

    They are part of no version until one that lists them is committed.  What the rows were shuffled with goes at once.
    """
    spark, load = df.sparkSession, f"w{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.withColumn(LOAD, F.lit(load)).write.mode("append").partitionBy(*partitions, LOAD).parquet(path)
    files, pattern = file_system(spark, "/".join([path.rstrip("/"), *(f"{name}=*" for name in partitions), f"{LOAD}={load}"]))
    levels = len(partitions) + 1
    found = ["/".join(status.getPath().toString().rsplit("/", levels)[1:]) for status in files.globStatus(pattern) or ()]
    return tuple(sorted(("/".join(part.split("=", 1)[1] for part in folder.split("/")[:-1]), folder) for folder in found))


def read_folders(spark: SparkSession, path: str, folders, schema: T.StructType) -> DataFrame:
    """Rows of data folders; partition values come from their names."""
    if not folders:
        return spark.createDataFrame([], schema)
    paths = [f"{path.rstrip('/')}/{folder}" for _, folder in folders]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(schema.names)


def read(spark: SparkSession, path: str, schema: T.StructType, number: int | None = None) -> DataFrame:
    """A version's rows (the newest unless a number is given); later writes do not change the frame."""
    return read_folders(spark, path, open_version(spark, path, number).folders, schema)


def remove_folders(spark: SparkSession, path: str, folders) -> None:
    """Delete data folders, which no version may list any more."""
    files = file_system(spark, path)[0]
    for folder in folders:
        files.delete(file_system(spark, f"{path.rstrip('/')}/{folder}")[1], True)


def tidy(spark: SparkSession, path: str, keep: int) -> int:
    """Delete all versions but the last ``keep``, and the data folders that only they list; the number of folders."""
    known = numbers(spark, path)
    dropped = known[:-keep] if keep else known
    if not dropped:
        return 0
    needed = {folder for number in known[len(dropped) :] for _, folder in open_version(spark, path, number).folders}
    gone = {folder for number in dropped for _, folder in open_version(spark, path, number).folders} - needed
    remove_folders(spark, path, gone)
    files = file_system(spark, path)[0]
    for number in dropped:
        files.delete(file_system(spark, _manifest(path, number))[1], False)
    return len(gone)
