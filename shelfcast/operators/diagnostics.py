"""Summaries and data-quality checks over facts, projections and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import half_even
from shelfcast.operators.calendar import Period
from shelfcast.schemas import ITEM, STORE, STYLE, UNITS, WEEK


def table_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, week range for those that have weeks, and a total."""
    parts = []
    for name, frame in tables.items():
        weeks = WEEK if WEEK in frame.columns else None
        bounds = [
            (function(weeks) if weeks else F.lit(None)).cast("int").alias(alias)
            for function, alias in ((F.min, "min_week"), (F.max, "max_week"))
        ]
        parts.append(frame.agg(F.count(F.lit(1)).alias("row_count"), *bounds).select(
            F.lit(name).alias("table_name"), "row_count", "min_week", "max_week"
        ))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    # One row per table: rollup adds the grand total in the same pass.
    return stacked.rollup("table_name").agg(
        F.sum("row_count").alias("row_count"), F.min("min_week").alias("min_week"), F.max("max_week").alias("max_week")
    ).withColumn("table_name", F.coalesce("table_name", F.lit("(all tables)")))


def productivity_summary(kpi: DataFrame) -> DataFrame:
    return kpi.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(WEEK).alias("min_week"),
        F.max(WEEK).alias("max_week"),
        F.countDistinct(WEEK).alias("unique_weeks"),
        F.min("ty_store_ct").alias("min_store_ct"),
        F.max("ty_store_ct").alias("max_store_ct"),
        F.avg("ty_store_ct").alias("avg_store_ct"),
        F.sum("sales_ty").cast("double").alias("total_sales_ty"),
        F.sum("sales_ly").cast("double").alias("total_sales_ly"),
        F.count(F.when(F.col("sales_ty") > 0, 1)).alias("rows_with_sales"),
        F.avg("weekly_productivity_ty").alias("avg_productivity_ty"),
        F.max("weekly_productivity_ty").alias("max_productivity_ty"),
        F.avg("avg_oh_per_store_ty").alias("avg_oh_per_store"),
        F.avg("weeks_of_supply_ty").alias("avg_weeks_of_supply"),
    )


def rows_per(df: DataFrame, column: str) -> DataFrame:
    """Row count per value; NULL is not a value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def top_n(df: DataFrame, by: str, measure: str, n: int, total: str = "total") -> DataFrame:
    """The ``n`` largest groups by summed measure (ties broken by name)."""
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(F.sum(measure).alias(total))
        .orderBy(F.desc(total), F.asc(by))
        .limit(n)
    )


def style_inventory_summary(current: DataFrame) -> DataFrame:
    """Current stock, inventory position and number of sizes per style."""
    parts = ["on_hand_ty", "in_warehouse_ty", "in_transit_ty", "on_order_ty"]
    return (
        current.where(F.col(STYLE).isNotNull())
        .groupBy(STYLE)
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts], F.count(ITEM).alias("num_sizes"))
        .withColumn("total_pipeline", sum((F.col(c) for c in parts[1:]), F.col(parts[0])))
    )


def style_sales_summary(styled: DataFrame) -> DataFrame:
    """Units, distinct sizes and the first vendor id per style."""
    return (
        styled.where(F.col(STYLE).isNotNull())
        .groupBy(STYLE)
        .agg(
            F.sum(UNITS).alias("total_pos"),
            F.countDistinct(ITEM).alias("num_sizes"),
            F.min("vendor_stock_id").alias("vendor_stock_id"),
        )
    )


def period_verification(facts: DataFrame, period: Period, weeks: int = 26) -> DataFrame:
    """Units and weekly average per store over the check window."""
    return (
        facts.where(F.col(WEEK).between(period.check_start, period.latest))
        .groupBy(STORE)
        .agg(F.sum(UNITS).alias("total_pos"))
        .withColumn("weekly_avg", F.col("total_pos") / weeks)
    )


def missing_style_report(styled: DataFrame, n: int | None = None) -> DataFrame:
    """Items without a style mapping, with their number of rows; the first ``n`` if that is given."""
    missing = (
        styled.where(F.col("internal_style_color").isNull())
        .groupBy(ITEM)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return missing.orderBy(ITEM).limit(n) if n else missing


def performance_distribution(styles: DataFrame) -> DataFrame:
    """Store-styles and their share per growth class (at most five rows)."""
    counts = rows_per(styles, "style_performance")
    total = F.sum("row_count").over(Window.partitionBy())
    return counts.withColumn("share", F.col("row_count") / total)


def inventory_totals(current: DataFrame) -> DataFrame:
    parts = ["on_hand_ty", "in_warehouse_ty", "in_transit_ty", "on_order_ty"]
    return current.agg(
        *[F.sum(c).alias(c) for c in parts],
        F.sum("total_pipeline").alias("total_pipeline"),
    )


def blend_weight_summary(mix: DataFrame) -> DataFrame:
    return mix.agg(*[F.avg(c).alias(f"avg_{c}") for c in ("weight_ty", "weight_ly", "weight_pipeline")])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """Total rows against distinct keys, both from one pre-aggregation."""
    return (
        df.groupBy(keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("distinct_keys"))
    )


def forecast_coverage(detail: DataFrame) -> DataFrame:
    covered = F.col("avg_forecast_each").isNotNull()
    return detail.agg(
        F.count(F.when(covered, 1)).alias("rows_with_forecast"),
        F.avg(F.when(covered, F.lit(1.0)).otherwise(F.lit(0.0))).alias("forecast_share"),
    )


def projection_diagnostics(projection: DataFrame, facts: DataFrame, period: Period, weeks: int = 26) -> DataFrame:
    """Projected weekly units per store against actual 13-week and check-window averages.

    ``facts`` is the category slice; stores with a projection are listed.
    """
    actual = (
        facts.where(F.col(WEEK).between(period.check_start, period.latest))
        .groupBy(STORE)
        .agg(
            (F.coalesce(F.sum(F.when(F.col(WEEK) >= period.ty_start, F.col(UNITS))), F.lit(0)) / 13).alias("actual_13wk_avg"),
            (F.sum(UNITS) / weeks).alias("expected_weekly"),
        )
    )
    gap = F.col("projected_weekly") - F.col("expected_weekly")
    return (
        projection.groupBy(STORE)
        .agg(F.sum("projected_weekly_sales").alias("projected_weekly"))
        .join(actual, STORE, "left")
        .withColumn("gap_units", gap)
        .withColumn("gap_pct", half_even(F.when(F.col("expected_weekly") > 0, gap / F.col("expected_weekly") * 100), 1))
    )
