"""Sales features per store and item.

All features come from one conditional aggregation over the union of the needed
weeks: the fact table is read once and shuffled once, after partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import coerce_numeric
from shelfcast.operators.calendar import LY_OFFSETS, Period
from shelfcast.operators.facts import STOCK_COLUMNS, current_rows, filter_category
from shelfcast.schemas import KEY, STORE, STYLE, UNITS, WEEK

RECENT_COLUMNS = ["pos_m1", "pos_m2", "pos_m3", "pos_m4"]
COERCED_COLUMNS = [
    "wtd_pos", "lw_pos", *RECENT_COLUMNS, "ty_13wk_avg", "ty_13wk_pos_total", "ty_52wk_pos_total",
    *STOCK_COLUMNS, "store_on_hand_quantity_this_year", "store_on_hand_quantity_last_year",
    "pos_sales_this_year", "pos_sales_last_year",
]


def ly_window_name(offset: int) -> str:
    return f"ly_pos_week_{offset:+d}"


def _in(low: int, high: int) -> Column:
    return F.col(WEEK).between(low, high)


def _units_when(condition: Column) -> Column:
    return F.when(condition, F.col(UNITS))


def _total(condition: Column, name: str) -> Column:
    return F.sum(_units_when(condition)).alias(name)


def pos_total(facts: DataFrame, period: Period) -> DataFrame:
    """13- and 52-week unit totals."""
    return (
        facts.where(_in(period.ty52_start, period.latest))
        .groupBy(KEY)
        .agg(
            _total(_in(period.ty_start, period.latest), "ty_13wk_pos_total"),
            F.sum(UNITS).alias("ty_52wk_pos_total"),
        )
    )


def pos_avg(facts: DataFrame, period: Period) -> DataFrame:
    """Mean units over the weeks present, this year's and last year's 13 weeks."""
    this_year, last_year = _in(period.ty_start, period.latest), _in(period.ly_start, period.ly_current)
    return (
        facts.where(this_year | last_year)
        .groupBy(KEY)
        .agg(
            F.avg(_units_when(this_year)).alias("ty_13wk_avg"),
            F.avg(_units_when(last_year)).alias("ly_13wk_avg"),
        )
    )


def last_week_pos(facts: DataFrame, period: Period) -> DataFrame:
    return facts.where(F.col(WEEK) == period.last_week).groupBy(KEY).agg(F.sum(UNITS).alias("lw_pos"))


def pos_last4_pivot(facts: DataFrame, period: Period) -> DataFrame:
    """Units one to four weeks back as columns; weeks without a row count 0."""
    weeks = dict(zip(RECENT_COLUMNS, period.recent))
    return (
        facts.where(F.col(WEEK).isin(*period.recent))
        .groupBy(KEY)
        .agg(*[F.coalesce(F.sum(_units_when(F.col(WEEK) == w)), F.lit(0)).alias(c) for c, w in weeks.items()])
    )


def ly_pair_pivot(facts: DataFrame, period: Period) -> DataFrame:
    """Last year's current and next week (mean on duplicates), 0 when absent."""
    pair = {"ly_current_week": period.ly_current, "ly_next_week": period.ly_next}
    return (
        facts.where(F.col(WEEK).isin(*pair.values()))
        .groupBy(KEY)
        .agg(*[F.coalesce(F.avg(_units_when(F.col(WEEK) == w)), F.lit(0.0)).alias(c) for c, w in pair.items()])
    )


def ly_window_pivot(facts: DataFrame, period: Period) -> DataFrame:
    """Six weeks around last year's current week as columns, 0 when absent."""
    names = {ly_window_name(o): w for o, w in zip(LY_OFFSETS, period.ly_window)}
    return (
        facts.where(F.col(WEEK).isin(*period.ly_window))
        .groupBy(KEY)
        .agg(*[F.coalesce(F.avg(_units_when(F.col(WEEK) == w)), F.lit(0.0)).alias(c) for c, w in names.items()])
    )


def key_features(facts: DataFrame, period: Period) -> DataFrame:
    """Every item-level feature in one pass."""
    this_year, last_year = _in(period.ty_start, period.latest), _in(period.ly_start, period.ly_current)
    pair = {"ly_current_week": period.ly_current, "ly_next_week": period.ly_next}
    recent = dict(zip(RECENT_COLUMNS, period.recent))
    return (
        facts.where(_in(period.ty52_start, period.latest) | last_year | F.col(WEEK).isin(*pair.values()))
        .groupBy(KEY)
        .agg(
            F.avg(_units_when(this_year)).alias("ty_13wk_avg"),
            _total(F.col(WEEK) == period.last_week, "lw_pos"),
            *[_total(F.col(WEEK) == week, name) for name, week in recent.items()],
            _total(this_year, "ty_13wk_pos_total"),
            _total(_in(period.ty52_start, period.latest), "ty_52wk_pos_total"),
            F.coalesce(F.avg(_units_when(last_year)), F.lit(0.0)).alias("ly_13wk_avg"),
            *[F.avg(_units_when(F.col(WEEK) == week)).alias(name) for name, week in pair.items()],
        )
    )


def feature_frame(facts: DataFrame, subcategories, period: Period) -> DataFrame:
    """Current-week rows with their features; items without a current row never appear."""
    slice_ = filter_category(facts, subcategories)
    joined = current_rows(facts, subcategories, period.latest).join(key_features(slice_, period), KEY, "left")
    return coerce_numeric(joined, [*COERCED_COLUMNS, "max_shelf_quantity_this_year"])


def weather_features(facts: DataFrame, period: Period) -> DataFrame:
    """Last week's units and the six-week window of last year in one pass."""
    names = {ly_window_name(o): w for o, w in zip(LY_OFFSETS, period.ly_window)}
    return (
        facts.where(F.col(WEEK).isin(period.last_week, *period.ly_window))
        .groupBy(KEY)
        .agg(
            _total(F.col(WEEK) == period.last_week, "lw_pos"),
            *[F.coalesce(F.avg(_units_when(F.col(WEEK) == w)), F.lit(0.0)).alias(c) for c, w in names.items()],
        )
    )


def style_weekly(styled: DataFrame) -> DataFrame:
    """Units per (store, style, week); sizes are collapsed."""
    return (
        styled.where(F.col(STYLE).isNotNull())
        .groupBy(STORE, STYLE, WEEK)
        .agg(F.coalesce(F.sum(UNITS), F.lit(0)).alias("week_units"))
    )


def style_weekly_avg(styled: DataFrame, period: Period) -> DataFrame:
    """Mean weekly style units over the weeks present, both years in one pass.

    Styles without a row this year are not listed; last year's mean is 0 when
    there was none.
    """
    this_year, last_year = _in(period.ty_start, period.latest), _in(period.ly_start, period.ly_current)
    return (
        style_weekly(styled.where(this_year | last_year))
        .groupBy(STORE, STYLE)
        .agg(
            F.avg(F.when(this_year, F.col("week_units"))).alias("style_ty_13wk_avg"),
            F.coalesce(F.avg(F.when(last_year, F.col("week_units"))), F.lit(0.0)).alias("style_ly_13wk_avg"),
        )
        .where(F.col("style_ty_13wk_avg").isNotNull())
    )


def style_spread(styled: DataFrame, period: Period) -> DataFrame:
    """Sample deviation of this year's weekly style units (NULL for one week)."""
    weekly = style_weekly(styled.where(_in(period.ty_start, period.latest)))
    return weekly.groupBy(STORE, STYLE).agg(F.stddev_samp("week_units").alias("sigma_weekly"))
