"""Run push reports by preset."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.config import PUSH_PRESETS, PushPreset
from shelfcast.operators.calendar import Period, RetailCalendar, resolve_period
from shelfcast.plans.finish import Pushed, finished, write_once
from shelfcast.plans.tables import PushReport, RetailTables
from shelfcast.plans.trend_push import TREND, by_style, pushed_of, trend_scored
from shelfcast.plans.weather_push import WEATHER, weather_pushed


def run_category(
    tables: RetailTables,
    preset: str | PushPreset,
    period: Period | None = None,
    target_week: int | None = None,
    calendar: RetailCalendar | None = None,
) -> PushReport | None:
    """Run one category once, with all its options; None when there are no facts."""
    chosen = PUSH_PRESETS[preset] if isinstance(preset, str) else preset
    return run_all(tables, {chosen.name: chosen}, period, target_week, calendar).get(chosen.name)


def run_all(
    tables: RetailTables,
    presets: dict[str, PushPreset] | None = None,
    period: Period | None = None,
    target_week: int | None = None,
    calendar: RetailCalendar | None = None,
) -> dict[str, PushReport]:
    """All categories over the same tables and period, in one plan: see ``finished``.

    Eager writes are as many for all categories as for one that pushes by style.
    """
    presets = PUSH_PRESETS if presets is None else presets
    for preset in presets.values():
        if preset.method not in ("trend", "weather"):
            raise ValueError(f"unknown method: {preset.method}")
    if period is None:
        period = resolve_period(tables.facts, tables.week_map, calendar, target_week)
    if period is None:
        return {}
    scored = {key: trend_scored(tables, preset, period) for key, preset in presets.items() if preset.method == "trend"}
    scored |= write_once({key: rows for key, rows in scored.items() if by_style(presets[key])})
    pushed = {}
    for key, preset in presets.items():
        if preset.method == "trend":
            pushed[key] = Pushed(TREND, preset, pushed_of(scored[key], tables, preset, period))
        else:
            pushed[key] = Pushed(WEATHER, preset, weather_pushed(tables, preset, period))
    return finished(pushed)


def run_all_details(reports: dict[str, PushReport]):
    """All detail reports stacked under a ``category`` column, for one export."""
    frames = [r.detail.withColumn("category", F.lit(key)) for key, r in reports.items()]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked
