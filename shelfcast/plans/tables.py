"""The tables a report run reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class RetailTables:
    facts: DataFrame
    stores: DataFrame
    style: DataFrame
    case_pack: DataFrame
    week_map: DataFrame
    weather: DataFrame | None = None
    client_forecast: DataFrame | None = None


@dataclass(frozen=True)
class PushReport:
    """Result of one category run; all frames are lazy."""

    detail: DataFrame
    summary: DataFrame
    clusters: DataFrame
