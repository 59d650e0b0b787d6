"""Category presets and tuning defaults (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass

from shelfcast.schemas import CATEGORY_A, GENERAL

TARGET_WOS = 6.0
WEATHER_FLOOR = -0.1


@dataclass(frozen=True)
class PushPreset:
    """How one product category is projected and pushed."""

    name: str
    subcategories: tuple[str, ...]
    method: str = "trend"
    source: str = GENERAL
    output: str = "push_recommendation"
    use_style_projection: bool = True
    use_client_forecast: bool = False
    client_forecast_weight: float = 0.0
    client_forecast_weeks: int = 4
    push_strategy: str = "wos"
    target_wos: float = TARGET_WOS
    style_target_wos: float = 10.0
    size_min_wos: float = 2.0
    hysteresis_weeks: float = 0.5
    min_push_units: float = 1.0
    convert_to_case_pack: bool = False
    # Weather method only: top up to shelf capacity, everywhere or in one region.
    apply_shelf_fill: bool = False
    shelf_fill_region: str | None = None
    # Style strategy only: lead time, review period, service factor, throttle, capacity.
    lead_weeks: float = 1.0
    review_weeks: float = 1.0
    z_service: float = 1.0
    ramp_weeks: float = 0.75
    use_rop_gate: bool = True
    front_capacity: int = 4
    backroom_units: int = 6


@dataclass(frozen=True)
class KpiPreset:
    """Which rows and detail columns the weekly KPI extract of a category uses."""

    name: str
    subcategories: tuple[str, ...]
    source: str = GENERAL
    has_style: bool = True
    detail_columns: tuple[str, ...] = ()
    output: str = "weekly_detailed"


PUSH_PRESETS = {
    "category_a": PushPreset(
        "Category A", ("1001", "1002"), source=CATEGORY_A, output="category_a_push_recommendation",
        use_client_forecast=True, client_forecast_weight=0.8, push_strategy="style_rop",
        hysteresis_weeks=0.25,
    ),
    "category_b": PushPreset(
        "Category B", ("2001",), output="category_b_push_recommendation",
        use_client_forecast=True, client_forecast_weight=1.0, target_wos=8.0,
    ),
    "category_c": PushPreset(
        "Category C", ("3001",), output="category_c_push_recommendation",
        client_forecast_weight=0.5, target_wos=10.0,
    ),
    "category_d": PushPreset(
        "Category D", ("4001", "4002", "4003", "4004"), method="weather",
        output="category_d_push_recommendation", use_style_projection=False,
    ),
    "category_e": PushPreset(
        "Category E", ("5001",), output="category_e_push_recommendation", convert_to_case_pack=True,
    ),
    "category_f": PushPreset(
        "Category F", ("6001", "6002", "6003"), output="category_f_push_recommendation",
        target_wos=4.0, convert_to_case_pack=True,
    ),
}

KPI_PRESETS = {
    "category_a": KpiPreset(
        "Category A", ("1001", "1002"), source=CATEGORY_A,
        detail_columns=("trait_description", "vendor_stock_id", "color_description"),
        output="category_a_weekly_detailed",
    ),
    "category_b": KpiPreset("Category B", ("2001",), output="category_b_weekly_detailed"),
    "category_c": KpiPreset("Category C", ("3001",), output="category_c_weekly_detailed"),
    "category_d": KpiPreset(
        "Category D", ("4001", "4002", "4003", "4004"), has_style=False,
        output="category_d_weekly_detailed",
    ),
}
