"""ABC grades, store clusters and report summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.labels import CLUSTER_CUTS, CLUSTER_LABELS, GRADE_LABELS, share_label
from shelfcast.functions.numeric import half_even
from shelfcast.operators.grouping import as_share, exact_mean, ranked, ranked_by_key
from shelfcast.schemas import ITEM, STORE

STORE_GROUP = ["region", "state", STORE]


def _percent(part: Column, total: Column) -> Column:
    return part.cast("double") / total.cast("double") * 100


def abc_running(df: DataFrame, groups: list[str] = [], slices: int | None = None) -> DataFrame:  # noqa: B006
    """Append what grades follow from: the exact baseline and its running and grand total, within ``groups``."""
    rows = df.withColumn("_baseline", as_share(F.col("baseline_weekly_sales")))
    return ranked_by_key(rows, groups, "_baseline", [STORE, ITEM], slices)


def abc_labels(placed: DataFrame, cuts: tuple) -> DataFrame:
    """Shares and grades from the running totals of ``abc_running``."""
    positive, known = F.col("grand_total") > 0, F.col("_baseline").isNotNull()
    return placed.withColumns(
        {
            "pct_of_total_sales": F.when(~positive, F.lit(0.0)).when(known, _percent(F.col("_baseline"), F.col("grand_total"))),
            "cumulative_pct": F.when(~positive, F.lit(0.0)).when(known, _percent(F.col("running"), F.col("grand_total"))),
            "store_item_grade": F.when(
                positive & known, share_label(F.col("running"), F.col("grand_total"), cuts, GRADE_LABELS)
            ).otherwise(F.lit(GRADE_LABELS[-1])),
        }
    ).drop("_baseline", "running", "grand_total")


def abc_grade(df: DataFrame, cuts: tuple, slices: int | None = None) -> DataFrame:
    """Share of total baseline, cumulative share in descending order, and grade.

    Ties are ordered by store and item.  Rows without a baseline come last, have
    no share and grade D; so does every row when the total is not positive.
    """
    return abc_labels(abc_running(df, slices=slices), cuts)


def store_totals(detail: DataFrame, groups: list[str] = []) -> DataFrame:  # noqa: B006
    """Sums per store (and per value of ``groups``); stores without region or state do not take part."""
    return (
        detail.dropna(subset=STORE_GROUP)
        .groupBy(*groups, *STORE_GROUP)
        .agg(
            F.coalesce(F.sum(as_share(F.col("baseline_weekly_sales"))), F.lit(0).cast("decimal(30,6)")).alias("_baseline"),
            F.coalesce(F.sum("projected_weekly_sales"), F.lit(0.0)).alias("store_projected"),
            F.sum("push_units").alias("store_push"),
            exact_mean(F.col("current_wos")).alias("store_current_wos"),
        )
        .withColumn("store_baseline", F.col("_baseline").cast("double"))
        .select(*groups, *STORE_GROUP, "store_baseline", "store_projected", "store_push", "store_current_wos", "_baseline")
    )


def store_clusters(detail: DataFrame, slices: int | None = None, groups: list[str] = []) -> DataFrame:  # noqa: B006
    """Stores labelled by cumulative share of baseline sales, largest first, within ``groups``."""
    totals = store_totals(detail, groups).withColumn("_baseline", F.col("_baseline").cast("decimal(30,6)"))
    placed = ranked(totals, groups, "_baseline", [STORE, "region", "state"], slices).drop("_next")
    nonzero = F.col("grand_total") != 0
    return placed.withColumns(
        {
            "store_pct_of_total_sales": F.when(nonzero, _percent(F.col("_baseline"), F.col("grand_total"))),
            "store_cumulative_pct": F.when(nonzero, _percent(F.col("running"), F.col("grand_total"))),
            "store_cluster": F.when(
                nonzero, share_label(F.col("running"), F.col("grand_total"), CLUSTER_CUTS, CLUSTER_LABELS)
            ),
        }
    ).drop("_baseline", "running", "grand_total")


def attach_clusters(detail: DataFrame, clusters: DataFrame, groups: list[str] = []) -> DataFrame:  # noqa: B006
    columns = ["store_cluster", "store_pct_of_total_sales", "store_cumulative_pct"]
    return detail.join(clusters.select(*groups, *STORE_GROUP, *columns), [*groups, *STORE_GROUP], "left")


def _with_change(summary: DataFrame) -> DataFrame:
    change = F.col("total_pipeline_ty") - F.col("total_pipeline_ly")
    percent = F.when(
        F.col("total_pipeline_ly") > 0, F.col("pipeline_change") / F.col("total_pipeline_ly") * 100
    ).otherwise(F.lit(0.0))
    return summary.withColumn("pipeline_change", change).withColumn("pipeline_change_pct", half_even(percent, 1))


def region_summary_trend(detail: DataFrame) -> DataFrame:
    """Push, cover and inventory by region; stores without a region form a group."""
    return _with_change(
        detail.groupBy("region").agg(
            F.sum("push_units").alias("total_push_units"),
            half_even(exact_mean(F.col("current_wos")), 2).alias("avg_current_wos"),
            half_even(exact_mean(F.col("ly_wos")), 2).alias("avg_ly_wos"),
            half_even(exact_mean(F.col("projected_wos_after_push")), 2).alias("avg_projected_wos"),
            F.countDistinct(STORE).alias("store_count"),
            F.sum("total_pipeline").alias("total_pipeline_ty"),
            F.sum("total_pipeline_ly").alias("total_pipeline_ly"),
        )
    )


def region_summary_weather(detail: DataFrame) -> DataFrame:
    """As the trend summary, plus packs and outlook, without the NULL region."""
    return _with_change(
        detail.where(F.col("region").isNotNull()).groupBy("region").agg(
            F.sum("push_units").alias("total_push_units"),
            F.sum("push_case_pack").alias("total_push_case_pack"),
            half_even(exact_mean(F.col("current_wos")), 2).alias("avg_current_wos"),
            half_even(exact_mean(F.col("ly_wos")), 2).alias("avg_ly_wos"),
            half_even(exact_mean(F.col("projected_wos_after_push")), 2).alias("avg_projected_wos"),
            F.countDistinct(STORE).alias("store_count"),
            half_even(exact_mean(F.col("weather_adjustment")), 2).alias("avg_weather_adj"),
            F.sum("total_pipeline").alias("total_pipeline_ty"),
            F.sum("total_pipeline_ly").alias("total_pipeline_ly"),
        )
    )


def grade_distribution(detail: DataFrame) -> DataFrame:
    return detail.groupBy("store_item_grade").agg(
        F.sum("push_units").alias("push_units"),
        F.sum("push_case_pack").alias("push_case_pack"),
        F.count(STORE).alias("store_items"),
    )


def push_grand_totals(detail: DataFrame) -> DataFrame:
    return detail.agg(
        F.sum("push_units").alias("total_push_units"),
        exact_mean(F.col("current_wos")).alias("avg_current_wos"),
        exact_mean(F.col("ly_wos")).alias("avg_ly_wos"),
        exact_mean(F.col("projected_wos_after_push")).alias("avg_projected_wos"),
        F.countDistinct(STORE).alias("store_count"),
        F.sum("total_pipeline").alias("total_pipeline_ty"),
        F.sum("total_pipeline_ly").alias("total_pipeline_ly"),
    )
