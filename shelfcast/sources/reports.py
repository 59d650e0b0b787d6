"""Report sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from shelfcast.plans.tables import PushReport
from shelfcast.sources.versions import file_system


def write_report(df: DataFrame, folder: str, name: str, formats=("csv", "parquet")) -> list[str]:
    """Write a report as directories of part files, one per format."""
    paths = []
    for kind in formats:
        path = f"{folder.rstrip('/')}/{name}.{kind}"
        writer = df.write.mode("overwrite")
        if kind == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.format(kind).save(path)
        paths.append(path)
    return paths


def write_single_csv(df: DataFrame, path: str) -> str:
    """Write a report as one CSV file of this name, to be opened as it is; for summaries, as one task writes it."""
    spark, beside = df.sparkSession, f"{path}.{uuid.uuid4().hex}"
    df.coalesce(1).write.option("header", True).csv(beside)
    files, target = file_system(spark, path)
    part = next(status.getPath() for status in files.globStatus(file_system(spark, f"{beside}/part-*")[1]))
    files.delete(target, True)
    if not files.rename(part, target):
        raise OSError(f"cannot move {part.toString()} to {path}")
    files.delete(file_system(spark, beside)[1], True)
    return path


def write_push_report(report: PushReport, folder: str, prefix: str, store_clusters: bool = False, single_summary: bool = False) -> list[str]:
    """Detail and summary, and the store clusters if asked for; ``single_summary`` adds the summary as one CSV file."""
    paths = write_report(report.detail, folder, f"{prefix}_detail") + write_report(report.summary, folder, f"{prefix}_summary")
    if store_clusters:
        paths += write_report(report.clusters, folder, f"{prefix}_store_clusters")
    if single_summary:
        paths.append(write_single_csv(report.summary, f"{folder.rstrip('/')}/{prefix}_summary_single.csv"))
    return paths
