"""Push recommendations from last year's sales and the regional weather outlook."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.config import PushPreset
from shelfcast.functions.labels import WEATHER_GRADE_CUTS
from shelfcast.functions.numeric import coerce_numeric
from shelfcast.operators.calendar import LY_OFFSETS, Period
from shelfcast.operators.facts import (
    STOCK_COLUMNS,
    current_rows,
    filter_category,
    lower_region,
    with_case_pack,
    with_inventory_position,
    with_store,
    with_weather,
)
from shelfcast.operators.features import ly_window_name, weather_features
from shelfcast.operators.grading import region_summary_weather
from shelfcast.operators.projection import weather_projection
from shelfcast.operators.push import (
    push_reason_weather,
    push_weather,
    round_weather,
    sell_through,
    shelf_fill,
    to_case_packs,
    wos_weather,
)
from shelfcast.plans.finish import Method, Pushed, finished
from shelfcast.plans.tables import PushReport, RetailTables
from shelfcast.schemas import CATEGORY_A, KEY

# Report layout.
BASE_COLUMNS = ["region", "state", "store_number", "f5c_item_number", "subcategory_description"]
CATEGORY_A_COLUMNS = ["vendor_stock_id", "color_description", "trait_description"]
REPORT_COLUMNS = [
    "wtd_pos", "lw_pos", *[ly_window_name(o) for o in LY_OFFSETS],
    "baseline_weekly_sales", "tw_pct", "nw_pct", "weather_adjustment",
    "tw_projected", "nw_projected", "projected_weekly_sales",
    "on_hand_ty", "in_warehouse_ty", "in_transit_ty", "on_order_ty", "store_on_hand_quantity_this_year",
    "on_hand_ly", "in_warehouse_ly", "in_transit_ly", "on_order_ly", "store_on_hand_quantity_last_year",
    "total_pipeline", "total_pipeline_ly", "current_wos", "ly_wos", "target_inventory",
    "push_units", "push_case_pack", "projected_wos_after_push", "pos_sales_this_year", "pos_sales_last_year",
    "store_item_grade", "pct_of_total_sales", "cumulative_pct", "push_reason",
    "case_pack_qty", "max_shelf_quantity_this_year", "ship_qty", "sell_through_pct", "sell_through_flag",
    "store_cluster", "store_pct_of_total_sales", "store_cumulative_pct",
]
COERCED = ["wtd_pos", "lw_pos", *STOCK_COLUMNS, "store_on_hand_quantity_this_year",
           "store_on_hand_quantity_last_year", "pos_sales_this_year", "pos_sales_last_year"]


def weather_scored(tables: RetailTables, preset: PushPreset, period: Period) -> DataFrame:
    """Current rows with projection, inventory position and weeks of supply."""
    category = filter_category(tables.facts, preset.subcategories)
    rows = with_store(current_rows(tables.facts, preset.subcategories, period.latest), tables.stores)
    rows = with_case_pack(lower_region(rows), tables.case_pack)
    rows = rows.join(weather_features(category, period), KEY, "left")
    rows = coerce_numeric(with_weather(rows, tables.weather), COERCED)
    projected = weather_projection(rows, category, period)
    return wos_weather(with_inventory_position(sell_through(projected)))


def weather_pushed(tables: RetailTables, preset: PushPreset, period: Period) -> DataFrame:
    """Scored rows with unrounded push quantities, shelf fill applied if asked for."""
    pushed = push_weather(weather_scored(tables, preset, period), preset.target_wos)
    return shelf_fill(pushed, preset.shelf_fill_region) if preset.apply_shelf_fill else pushed


def _finish(graded: DataFrame, preset: PushPreset) -> DataFrame:
    return round_weather(push_reason_weather(to_case_packs(graded), preset.target_wos))


def _columns(preset: PushPreset, detail: DataFrame) -> list[str]:
    return BASE_COLUMNS + (CATEGORY_A_COLUMNS if preset.source == CATEGORY_A else []) + REPORT_COLUMNS


WEATHER = Method(WEATHER_GRADE_CUTS, _finish, _columns, region_summary_weather)


def weather_push(tables: RetailTables, preset: PushPreset, period: Period) -> PushReport:
    """Detail, regional summary and store clusters of one category; see ``finished``."""
    return finished({preset.name: Pushed(WEATHER, preset, weather_pushed(tables, preset, period))})[preset.name]
