"""Classification columns: seasons, growth classes, grades, clusters, reasons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label texts and class boundaries are part of the results.
PERFORMANCE_CLASSES = ((-0.20, "Declining"), (-0.05, "Soft"), (0.05, "Stable"), (0.20, "Growing"))
PERFORMANCE_TOP = "Hot"
TREND_GRADE_CUTS = (20, 50, 95)
WEATHER_GRADE_CUTS = (50, 80, 95)
GRADE_LABELS = ("A", "B", "C", "D")
CLUSTER_CUTS = (20, 50, 80)
CLUSTER_LABELS = ("Top 20%", "Next 30%", "Next 30%", "Bottom 20%")
MAX_WOS = 15.0
STRONG_SIGNAL = 0.15
CRITICAL_WOS = 2.0


def season_label(week: Column) -> Column:
    """``YYYYWW`` to ``Spring YYYY`` (weeks 1-26) or ``Fall YYYY`` (27 and later)."""
    number = F.pmod(week, F.lit(100))
    year = F.floor(week / 100).cast("string")
    return (
        F.when(week.isNull(), F.lit(None).cast("string"))
        .when((week < 100000) | (number == 0), F.lit("Unknown"))
        .when(number <= 26, F.concat(F.lit("Spring "), year))
        .otherwise(F.concat(F.lit("Fall "), year))
    )


def performance_label(rate: Column) -> Column:
    """Right-closed growth classes; NULL stays NULL."""
    label = F.when(rate.isNull(), F.lit(None).cast("string"))
    for upper, name in PERFORMANCE_CLASSES:
        label = label.when(rate <= upper, F.lit(name))
    return label.otherwise(F.lit(PERFORMANCE_TOP))


def share_label(running: Column, total: Column, cuts: tuple, labels: tuple) -> Column:
    """Label by cumulative share, compared exactly as ``running*100 <= cut*total``.

    Both inputs are fixed-scale decimals, so a label cannot depend on the order
    in which floating-point values happened to be added.
    """
    label = F.when(running.isNull(), F.lit(labels[-1]))
    for cut, name in zip(cuts, labels):
        label = label.when(running * 100 <= total * cut, F.lit(name))
    return label.otherwise(F.lit(labels[-1]))


def trend_reason(current_wos: Column, push: Column, growth_rate: Column, target_wos: float) -> Column:
    return (
        F.when(current_wos > MAX_WOS, F.lit("Overstocked (>15 WOS)"))
        .when((push == 0) & (current_wos >= target_wos), F.lit("Adequate inventory"))
        .when(push == 0, F.lit("No push needed"))
        .when(growth_rate > STRONG_SIGNAL, F.lit("Strong growth trend"))
        .otherwise(F.lit("Standard replenishment"))
    )


def weather_reason(current_wos: Column, push: Column, adjustment: Column, target_wos: float) -> Column:
    return (
        F.when(current_wos > MAX_WOS, F.lit("Overstocked (>15 WOS)"))
        .when((push == 0) & (current_wos >= target_wos), F.lit("Adequate inventory"))
        .when(push == 0, F.lit("No push needed"))
        .when(current_wos < CRITICAL_WOS, F.lit("Critical - Low inventory"))
        .when(adjustment > STRONG_SIGNAL, F.lit("High demand forecast"))
        .otherwise(F.lit("Standard replenishment"))
    )
