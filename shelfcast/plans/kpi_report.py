"""Weekly productivity extract of one or all categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.config import KPI_PRESETS, KpiPreset
from shelfcast.operators.calendar import DEFAULT_SEASONS, assign_season, in_seasons
from shelfcast.operators.facts import filter_category
from shelfcast.operators.kpi import (
    SALES,
    coerce_totals,
    grouping_columns,
    season_averages,
    season_to_date,
    weekly_item_totals,
    weekly_ratios,
)
from shelfcast.schemas import SOURCE


def weekly_productivity(
    facts: DataFrame, style: DataFrame | None, preset: KpiPreset, seasons=DEFAULT_SEASONS
) -> DataFrame:
    """One scan over all season ranges, one aggregation, one window."""
    rows = filter_category(facts.where(F.col(SOURCE) == preset.source), preset.subcategories)
    totals = assign_season(coerce_totals(weekly_item_totals(in_seasons(rows, seasons), preset, style)))
    keys = grouping_columns(totals.columns, preset)
    report = season_averages(season_to_date(weekly_ratios(totals), keys))
    money = [*SALES, "season_sales_cumulative_ty"]
    return report.withColumns({name: F.col(name).cast("double") for name in money})


def weekly_productivity_all(facts: DataFrame, style: DataFrame, seasons=DEFAULT_SEASONS) -> dict[str, DataFrame]:
    return {key: weekly_productivity(facts, style, preset, seasons) for key, preset in KPI_PRESETS.items()}
