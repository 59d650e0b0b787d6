"""Materialising intermediate frames in shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, one below the warehouse, removed when Python ends.

    Both are shared by the executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints-{uuid.uuid4().hex}"
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end within it leave no shuffle files, which else lie there until the driver happens to collect garbage.

    A plan that is run again shuffles again.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def materialise(df: DataFrame, partitions: list[str] = []) -> DataFrame:  # noqa: B006
    """Write ``df`` below the checkpoint folder as Parquet and read it from there (one job).

    Later plans read only the columns they need and know the size; lost executors cost nothing but a read.  The files
    go when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_folder(spark).rstrip('/')}/stage-{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(path)
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(own)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)
