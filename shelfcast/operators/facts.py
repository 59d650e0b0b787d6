"""Unified fact view, slices and dimension joins.

Dimension joins carry no broadcast hint: Spark broadcasts a side only while its
measured size stays below ``spark.sql.autoBroadcastJoinThreshold`` (adaptive
execution re-checks it at run time) and falls back to a shuffle join with skew
splitting beyond that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import integer
from shelfcast.schemas import (
    CATEGORY_A,
    GENERAL,
    ITEM,
    POS_ALL_COLUMNS,
    POS_FACT,
    SOURCE,
    STORE,
    STYLE,
    SUBCATEGORY,
    UNITS,
    WEEK,
)

# Report names of the inventory columns.
STOCK_COLUMNS = {
    "on_hand_ty": "store_on_hand_quantity_this_year_eop",
    "on_hand_ly": "store_on_hand_quantity_last_year_eop",
    "in_warehouse_ty": "store_in_warehouse_quantity_this_year",
    "in_warehouse_ly": "store_in_warehouse_quantity_last_year",
    "in_transit_ty": "store_in_transit_quantity_this_year",
    "in_transit_ly": "store_in_transit_quantity_last_year",
    "on_order_ty": "store_on_order_quantity_this_year",
    "on_order_ly": "store_on_order_quantity_last_year",
}


def pos_all(general: DataFrame, category_a: DataFrame) -> DataFrame:
    """Both facts stacked; the general one has no color or trait text."""
    hidden = [c for c in ("color_description", "trait_description") if c in general.columns]
    stacked = (
        general.drop(*hidden, SOURCE)
        .withColumn(SOURCE, F.lit(GENERAL))
        .unionByName(category_a.drop(SOURCE).withColumn(SOURCE, F.lit(CATEGORY_A)), allowMissingColumns=True)
    )
    types = {f.name: f.dataType for f in POS_FACT.fields}
    return stacked.select(
        [F.col(c) if c in stacked.columns else F.lit(None).cast(types[c]).alias(c) for c in POS_ALL_COLUMNS]
    )


def filter_category(df: DataFrame, subcategories) -> DataFrame:
    return df.where(F.col(SUBCATEGORY).isin([str(s) for s in subcategories]))


def filter_weeks(df: DataFrame, low: int, high: int) -> DataFrame:
    return df.where(F.col(WEEK).between(low, high))


def filter_store(df: DataFrame, store: str) -> DataFrame:
    return df.where(F.col(STORE) == str(store))


def with_store(df: DataFrame, stores: DataFrame) -> DataFrame:
    return df.join(stores.select(STORE, "region", "state", "zip_code", "merch_zone_number"), STORE, "left")


def _style_columns(style: DataFrame) -> DataFrame:
    return style.withColumnRenamed("customer_style_number", ITEM)


def with_style_left(df: DataFrame, style: DataFrame) -> DataFrame:
    return df.join(_style_columns(style).select(ITEM, "internal_style_color"), ITEM, "left")


def with_style_inner(df: DataFrame, style: DataFrame) -> DataFrame:
    bridge = _style_columns(style).select(ITEM, "internal_style_color", "product_category", "size")
    return df.join(bridge, ITEM, "inner")


def with_case_pack(df: DataFrame, case_pack: DataFrame) -> DataFrame:
    """Units per pack; unknown, non-numeric and zero packs count as 1."""
    packs = case_pack.select(F.col("item_nbr").alias(ITEM), integer(F.col("case_pack_qty")).alias("_pack"))
    size = F.when(F.col("_pack") != 0, F.col("_pack")).otherwise(F.lit(1))
    return df.join(packs, ITEM, "left").withColumn("case_pack_qty", size.cast("bigint")).drop("_pack")


def latest_snapshot(df: DataFrame, stamp: str = "week_imported") -> DataFrame:
    """Rows of the most recent import (uncorrelated scalar subquery)."""
    newest = df.agg(F.max(stamp).alias("newest"))
    return df.where(F.col(stamp) == newest.scalar())


def lower_region(df: DataFrame) -> DataFrame:
    return df.withColumn("region", F.lower("region"))


def with_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Latest regional outlook, matched on the lower-case region of ``df``."""
    outlook = lower_region(latest_snapshot(weather)).select("region", "tw_pct", "nw_pct")
    return df.join(outlook, "region", "left")


def style_key(df: DataFrame) -> DataFrame:
    """``style``: the mapped style, else the vendor's own stock id."""
    return df.withColumn(STYLE, F.coalesce("internal_style_color", "vendor_stock_id"))


def inventory_position(suffix: str) -> Column:
    """On hand + warehouse + transit + on order; NULL when a part is NULL."""
    return (
        F.col(f"on_hand_{suffix}")
        + F.col(f"in_warehouse_{suffix}")
        + F.col(f"in_transit_{suffix}")
        + F.col(f"on_order_{suffix}")
    )


def with_inventory_position(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"total_pipeline": inventory_position("ty"), "total_pipeline_ly": inventory_position("ly")}
    )


def current_rows(facts: DataFrame, subcategories, week: int) -> DataFrame:
    """One week of a category under report column names."""
    return (
        filter_category(facts, subcategories)
        .where(F.col(WEEK) == week)
        .select(
            STORE,
            ITEM,
            SUBCATEGORY,
            "subcategory_description",
            "vendor_stock_id",
            "color_description",
            "trait_description",
            F.col(UNITS).alias("wtd_pos"),
            *[F.col(source).alias(name) for name, source in STOCK_COLUMNS.items()],
            "store_on_hand_quantity_this_year",
            "store_on_hand_quantity_last_year",
            "pos_sales_this_year",
            "pos_sales_last_year",
            "max_shelf_quantity_this_year",
        )
    )


def select_report(df: DataFrame, columns, fill_missing: bool = True) -> DataFrame:
    """Fixed column list; absent columns become NULL or are skipped."""
    chosen = []
    for name in columns:
        if name in df.columns:
            chosen.append(F.col(f"`{name}`"))
        elif fill_missing:
            chosen.append(F.lit(None).cast("double").alias(name))
    return df.select(chosen)


def stack_periods(frames: list[DataFrame]) -> DataFrame:
    """Union of separately produced period extracts."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked


def order_report(df: DataFrame, ascending=(), descending=()) -> DataFrame:
    """Sort at the sink only; name tie-breaking columns in ``ascending``."""
    return df.orderBy(*[F.desc(c) for c in descending], *[F.asc_nulls_last(c) for c in ascending])


