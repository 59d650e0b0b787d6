"""From pushed rows to reports: ranking, grades, reasons, clusters - for any number of categories in the same passes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.config import PushPreset
from shelfcast.operators.facts import select_report
from shelfcast.operators.grading import STORE_GROUP, abc_labels, abc_running, attach_clusters, store_clusters
from shelfcast.plans.tables import PushReport
from shelfcast.sources.durable import materialise

CATEGORY = "_category"


@dataclass(frozen=True)
class Method:
    """What the methods of projection differ in once units are pushed."""

    cuts: tuple
    finish: Callable[[DataFrame, PushPreset], DataFrame]
    columns: Callable[[PushPreset, DataFrame], list[str]]
    summary: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Pushed:
    """Rows of one category with unrounded push quantities."""

    method: Method
    preset: PushPreset
    rows: DataFrame


def stacked(parts: dict[str, DataFrame]) -> DataFrame:
    """Frames under one another with their key as CATEGORY; columns that one lacks are NULL in its rows."""
    frames = [frame.withColumn(CATEGORY, F.lit(key)) for key, frame in parts.items()]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def part(whole: DataFrame, key: str, like: DataFrame, *more: str) -> DataFrame:
    """The rows of a category out of a stack, in the columns and types of ``like``, and ``more`` columns."""
    own = [F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in like.schema.fields]
    return whole.where(F.col(CATEGORY) == key).select(*own, *more)


def write_once(parts: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Frames that are read several times, written by one job whatever their number."""
    if not parts:
        return {}
    written = materialise(stacked(parts), [CATEGORY])
    return {key: part(written, key, frame) for key, frame in parts.items()}


def finished(pushed: dict[str, Pushed]) -> dict[str, PushReport]:
    """Detail, regional summary and store clusters of each category.

    Runs jobs while planning, as many for all categories as for one: the pushed rows, the ranking of rows and that of
    stores are each written once with the category as leading key (see ``grouping.ranked_by_key``).  Categories without
    rows yield empty frames.
    """
    if not pushed:
        return {}
    ranked = abc_running(stacked({key: one.rows for key, one in pushed.items()}), [CATEGORY])
    details = {}
    for key, one in pushed.items():
        own = part(ranked, key, one.rows, "_baseline", "running", "grand_total")
        details[key] = one.method.finish(abc_labels(own, one.method.cuts), one.preset)
    measures = ["baseline_weekly_sales", "projected_weekly_sales", "push_units", "current_wos"]
    clusters = store_clusters(stacked({key: detail.select(*STORE_GROUP, *measures) for key, detail in details.items()}), groups=[CATEGORY])
    reports = {}
    for key, one in pushed.items():
        own = clusters.where(F.col(CATEGORY) == key).drop(CATEGORY)
        detail = attach_clusters(details[key], own)
        detail = select_report(detail, one.method.columns(one.preset, detail))
        reports[key] = PushReport(detail, one.method.summary(detail), own)
    return reports
