"""Weekly productivity extract: totals, ratios and season-to-date measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.config import KpiPreset
from shelfcast.functions.numeric import coerce_numeric, half_even, money, ratio
from shelfcast.operators.facts import filter_category, with_style_inner
from shelfcast.schemas import ITEM, SOURCE, WEEK

# Report name -> fact column.
TOTALS = {
    "ty_store_ct": "traited_store_count_this_year",
    "ly_store_ct": "traited_store_count_last_year",
    "pos_qty_ty": "pos_quantity_this_year",
    "pos_qty_ly": "pos_quantity_last_year",
    "oh_qty_ty": "store_on_hand_quantity_this_year_eop",
    "oh_qty_ly": "store_on_hand_quantity_last_year_eop",
    "in_transit_ty": "store_in_transit_quantity_this_year",
    "in_transit_ly": "store_in_transit_quantity_last_year",
    "in_warehouse_ty": "store_in_warehouse_quantity_this_year",
    "in_warehouse_ly": "store_in_warehouse_quantity_last_year",
    "on_order_ty": "store_on_order_quantity_this_year",
    "on_order_ly": "store_on_order_quantity_last_year",
}
SALES = {"sales_ty": "pos_sales_this_year", "sales_ly": "pos_sales_last_year"}
STYLE_COLUMNS = ("internal_style_color", "product_category")


def category_columns(preset: KpiPreset) -> list[str]:
    """Descriptive columns of a category's extract, in report order."""
    columns = [WEEK, ITEM, "subcategory_description", *preset.detail_columns]
    if preset.has_style:
        columns += STYLE_COLUMNS
        if "size" not in preset.detail_columns:
            columns.append("size")
    return columns


def grouping_columns(available, preset: KpiPreset) -> list[str]:
    """Columns identifying one product within the extract; at least the item."""
    wanted = ["internal_style_color", ITEM, *preset.detail_columns]
    if "size" not in wanted:
        wanted.append("size")
    return [c for c in wanted if c in available] or [ITEM]


def weekly_item_totals(rows: DataFrame, preset: KpiPreset, style: DataFrame | None) -> DataFrame:
    """Sums over stores by week and item, with style columns where there are any.

    Stores are summed before the style bridge is joined, so the join sees one row
    per item and week.  Sales are exact decimals.
    """
    names = [*TOTALS, *SALES]
    by_item = rows.groupBy(WEEK, ITEM, "subcategory_description", *preset.detail_columns).agg(
        *[F.sum(source).alias(name) for name, source in TOTALS.items()],
        *[F.sum(money(F.col(source))).alias(name) for name, source in SALES.items()],
    )
    if not preset.has_style:
        return by_item.select(*category_columns(preset), *names)
    return (
        with_style_inner(by_item, style)
        .groupBy(category_columns(preset))
        .agg(*[F.sum(name).alias(name) for name in names])
    )


def category_query(facts: DataFrame, preset: KpiPreset, style: DataFrame | None, low: int, high: int) -> DataFrame:
    """Totals of one category over an inclusive week range."""
    rows = filter_category(facts.where(F.col(SOURCE) == preset.source), preset.subcategories)
    return weekly_item_totals(rows.where(F.col(WEEK).between(low, high)), preset, style)


def weekly_ratios(df: DataFrame) -> DataFrame:
    """Units and stock per store, and weeks of supply, to two places."""

    def rate(top: str, bottom: str, **policy) -> Column:
        return half_even(ratio(F.col(top), F.col(bottom), **policy), 2)

    return df.withColumns(
        {
            "weekly_productivity_ty": rate("pos_qty_ty", "ty_store_ct"),
            "weekly_productivity_ly": rate("pos_qty_ly", "ly_store_ct"),
            "avg_oh_per_store_ty": rate("oh_qty_ty", "ty_store_ct"),
            "avg_oh_per_store_ly": rate("oh_qty_ly", "ly_store_ct"),
            "weeks_of_supply_ty": rate("oh_qty_ty", "pos_qty_ty", positive_over_zero=0.0),
        }
    )


def season_to_date(df: DataFrame, keys: list[str]) -> DataFrame:
    """Running units, sales, store-weeks and week count within the season.

    A window partition is one product in one season, so it holds at most 27 weeks
    times the product's few descriptive variants.  Rows with a NULL key have no
    running values.
    """
    group = [*keys, "season"]
    tiebreak = [c for c in ("subcategory_description", "product_category") if c in df.columns]
    so_far = Window.partitionBy(group).orderBy(WEEK, *tiebreak)
    rows = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    complete = F.lit(True)
    for column in group:
        complete = complete & F.col(column).isNotNull()
    return df.withColumns(
        {
            "season_pos_qty_cumulative_ty": F.when(complete, F.sum("pos_qty_ty").over(rows)),
            "season_sales_cumulative_ty": F.when(complete, F.sum("sales_ty").over(rows)),
            "weeks_in_season_so_far": F.when(complete, F.row_number().over(so_far)),
            "season_store_weeks_cumulative_ty": F.when(complete, F.sum("ty_store_ct").over(rows)),
        }
    )


def season_averages(df: DataFrame) -> DataFrame:
    """Season-to-date means per week and units per store-week."""
    weeks = F.col("weeks_in_season_so_far").cast("double")
    units, sales = F.col("season_pos_qty_cumulative_ty"), F.col("season_sales_cumulative_ty")
    productivity = half_even(ratio(units, F.col("season_store_weeks_cumulative_ty")), 2)
    return df.withColumns(
        {
            "avg_weekly_pos_qty_std_ty": half_even(units.cast("double") / weeks, 2),
            "avg_weekly_sales_std_ty": half_even(sales.cast("double") / weeks, 2),
            "season_productivity_std_ty": F.coalesce(productivity, F.lit(0.0)),
        }
    )


def coerce_totals(df: DataFrame) -> DataFrame:
    return coerce_numeric(df, [*TOTALS, *SALES])
