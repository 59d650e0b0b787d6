"""Push recommendations from the 13-week this-year/last-year trend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.config import PushPreset
from shelfcast.functions.labels import TREND_GRADE_CUTS
from shelfcast.functions.numeric import half_even
from shelfcast.operators.calendar import Period
from shelfcast.operators.facts import (
    STOCK_COLUMNS,
    filter_category,
    style_key,
    with_case_pack,
    with_inventory_position,
    with_store,
    with_style_left,
)
from shelfcast.operators.features import feature_frame, style_spread
from shelfcast.operators.grading import region_summary_trend
from shelfcast.operators.projection import (
    attach_projection,
    blend_forecast,
    client_forecast_avg,
    item_projection,
    item_signals,
    projection_of,
    style_signals,
)
from shelfcast.operators.push import push_reason_trend, push_style_rop, push_wos, round_trend, sell_through, wos_trend
from shelfcast.plans.finish import Method, Pushed, finished
from shelfcast.plans.tables import PushReport, RetailTables
from shelfcast.schemas import CATEGORY_A, ITEM, STORE, UNITS, WEEK
from shelfcast.sources.durable import materialise

# Report layout.
BASE_COLUMNS = [
    "region", "state", "zip_code", "merch_zone_number",
    "store_number", "f5c_item_number", "subcategory_description", "vendor_stock_id",
]
CATEGORY_A_COLUMNS = ["color_description", "trait_description"]
EXTRA_COLUMNS = [
    "wtd_pos", "lw_pos", "pos_m1", "pos_m2", "pos_m3", "pos_m4",
    "ty_13wk_pos_total", "ty_52wk_pos_total", "ty_13wk_avg", "ly_13wk_avg", "growth_rate",
    "ly_current_week", "ly_next_week", "tw_projected", "nw_projected",
    "baseline_weekly_sales", "projected_weekly_sales",
    "on_hand_ty", "in_warehouse_ty", "in_transit_ty", "on_order_ty", "store_on_hand_quantity_this_year",
    "on_hand_ly", "in_warehouse_ly", "in_transit_ly", "on_order_ly", "store_on_hand_quantity_last_year",
    "total_pipeline", "total_pipeline_ly", "current_wos", "pipeline_wos", "ly_wos",
    "target_inventory", "push_units", "projected_wos_after_push", "pos_sales_this_year", "pos_sales_last_year",
    "store_item_grade", "pct_of_total_sales", "cumulative_pct", "push_reason",
    "projection_source", "engine_projected_weekly_sales", "avg_forecast_each",
    "style_target_wos", "size_min_wos", "size_target_inventory", "shortfall_weeks",
    "max_shelf_quantity_this_year", "ship_qty", "sell_through_pct", "sell_through_flag",
    "case_pack_qty", "push_case_pack", "store_cluster", "store_pct_of_total_sales", "store_cumulative_pct",
]


def window_rows(facts: DataFrame, subcategories, period: Period) -> DataFrame:
    """Category rows of both 13-week windows; narrow columns only."""
    stock = {name: source for name, source in STOCK_COLUMNS.items() if name.endswith("_ty")}
    return (
        filter_category(facts, subcategories)
        .where(
            F.col(WEEK).between(period.ty_start, period.latest)
            | F.col(WEEK).between(period.ly_start, period.ly_current)
        )
        .select(
            WEEK, STORE, ITEM, "vendor_stock_id", UNITS,
            *[F.col(source).alias(name) for name, source in stock.items()],
        )
    )


def styled_rows(facts: DataFrame, style: DataFrame, subcategories, period: Period) -> DataFrame:
    """Category rows of both 13-week windows with their style."""
    return style_key(with_style_left(window_rows(facts, subcategories, period), style))


def trend_inputs(tables: RetailTables, preset: PushPreset, period: Period) -> DataFrame:
    """Current rows with features, store and style attributes and sell-through."""
    rows = feature_frame(tables.facts, preset.subcategories, period)
    rows = style_key(with_style_left(with_store(rows, tables.stores), tables.style))
    if preset.convert_to_case_pack:
        rows = with_case_pack(rows, tables.case_pack)
    return with_inventory_position(sell_through(rows))


def trend_scored(tables: RetailTables, preset: PushPreset, period: Period) -> DataFrame:
    """Inputs with projection, client forecast and weeks of supply."""
    rows = trend_inputs(tables, preset, period)
    if preset.use_style_projection:
        signals = style_signals(item_signals(window_rows(tables.facts, preset.subcategories, period), period), tables.style)
        rows = attach_projection(rows.drop("ly_current_week", "ly_next_week"), projection_of(signals))
    else:
        rows = item_projection(rows, filter_category(tables.facts, preset.subcategories), period)
    if preset.use_client_forecast:
        outlook = client_forecast_avg(tables.client_forecast, preset.subcategories, preset.client_forecast_weeks)
        rows = blend_forecast(rows, outlook, preset.client_forecast_weight)
    return wos_trend(rows)


def by_style(preset: PushPreset) -> bool:
    """Whether units are pushed by style first; the style strategy reads its scored rows several times."""
    return preset.push_strategy == "style_rop" and preset.use_style_projection


def pushed_of(scored: DataFrame, tables: RetailTables, preset: PushPreset, period: Period, parity: bool = False) -> DataFrame:
    """Scored rows, written already if ``by_style``, with unrounded push quantities."""
    if by_style(preset):
        spread = style_spread(styled_rows(tables.facts, tables.style, preset.subcategories, period), period)
        return push_style_rop(scored, spread, preset, parity=parity)
    return push_wos(scored, preset.target_wos, preset.hysteresis_weeks, preset.min_push_units)


def trend_pushed(tables: RetailTables, preset: PushPreset, period: Period, parity: bool = False) -> DataFrame:
    """``pushed_of`` one category from its tables."""
    scored = trend_scored(tables, preset, period)
    return pushed_of(materialise(scored) if by_style(preset) else scored, tables, preset, period, parity)


def _finish(graded: DataFrame, preset: PushPreset) -> DataFrame:
    detail = round_trend(push_reason_trend(graded, preset.target_wos))
    if preset.convert_to_case_pack:
        packs = half_even(F.col("push_units") / F.col("case_pack_qty")).cast("bigint")
        detail = detail.withColumn("push_case_pack", packs)
    return detail


def _columns(preset: PushPreset, detail: DataFrame) -> list[str]:
    base = BASE_COLUMNS + (CATEGORY_A_COLUMNS if preset.source == CATEGORY_A else [])
    return base + [c for c in EXTRA_COLUMNS if c in detail.columns]


TREND = Method(TREND_GRADE_CUTS, _finish, _columns, region_summary_trend)


def trend_push(tables: RetailTables, preset: PushPreset, period: Period, parity: bool = False) -> PushReport:
    """Detail, regional summary and store clusters of one category; see ``finished``."""
    return finished({preset.name: Pushed(TREND, preset, trend_pushed(tables, preset, period, parity))})[preset.name]
