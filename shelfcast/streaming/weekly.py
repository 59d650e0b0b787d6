"""Keyed upserts for point-of-sale files as they land in a folder."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from shelfcast.sources.fact_store import FILE_ORDER, merge_facts
from shelfcast.sources.pos_files import (
    CSV_OPTIONS,
    RAW_LINE,
    any_surplus,
    conform,
    keep_rejected,
    observed,
    require_columns,
    route_by_subcategory,
    split_rejected,
    with_field_count,
)
from shelfcast.sources.versions import read_text


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Structured Streaming gives a new checkpoint; its batch numbers start anew with it."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def stream_weekly_updates(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    columns: list[str],
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start upserting the CSV files of ``folder``; stops when all are applied.

    ``columns`` is the header of the files (checked against each of them).  Within
    a micro-batch the newer file wins, by modification time and then name.  The
    table's version records the last batch of the checkpoint's stream, so that a
    batch replayed after a failure is skipped and not merged over newer rows.
    """
    require_columns(columns)
    layout = StructType([StructField(c, StringType()) for c in [*columns, RAW_LINE]])
    whole = {"columnNameOfCorruptRecord": RAW_LINE, "columnPruning": False}
    reader = spark.readStream.schema(layout).options(**CSV_OPTIONS, **whole, enforceSchema=False, pathGlobFilter="*.csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    age = F.struct("_metadata.file_modification_time", "_metadata.file_name")
    rows = with_field_count(reader.csv(folder)).withColumn(FILE_ORDER, age).withColumn("source_file", F.col("_metadata.file_path"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        delta, seen = observed(batch, len(columns))
        good, _ = split_rejected(delta, len(columns))
        delta = conform(route_by_subcategory(good), keep=(FILE_ORDER,))
        done = merge_facts(spark, path, delta, batch=(_stream_id(spark, checkpoint), batch_id))
        if not done.replayed and any_surplus(seen):
            keep_rejected(split_rejected(batch, len(columns))[1], path)

    return (
        rows.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
