"""Inventory cover and push quantities.

Sums over a (store, style) group are aggregated and joined back (see
``grouping``), so one very large style cannot end up in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import PushPreset
from shelfcast.functions.labels import trend_reason, weather_reason
from shelfcast.functions.numeric import at_least, at_most, half_even, weeks_cover
from shelfcast.operators.grouping import totals_of, with_group_totals
from shelfcast.schemas import STORE, STYLE, STYLE_KEY

MIN_DEMAND = 0.01


def sell_through(df: DataFrame, sold: str = "wtd_pos") -> DataFrame:
    """Sold share of what was shipped (sold + on hand), flagged when nothing was."""
    shipped = F.col("ship_qty")
    share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col(sold) / shipped))
    return df.withColumn("ship_qty", F.col(sold) + F.col("on_hand_ty")).withColumns(
        {
            "sell_through_pct": F.when(shipped > 0, half_even(share, 4)),
            "sell_through_flag": F.when(shipped <= 0, F.lit("check")).otherwise(F.lit("")),
        }
    )


def wos_trend(df: DataFrame) -> DataFrame:
    """Weeks of supply from on-hand stock (trend method)."""
    demand = F.col("projected_weekly_sales")
    return df.withColumns(
        {
            "current_wos": weeks_cover(F.col("on_hand_ty"), demand),
            "pipeline_wos": weeks_cover(F.col("total_pipeline"), demand),
            "ly_wos": weeks_cover(F.col("on_hand_ly"), F.col("ly_13wk_avg")),
        }
    )


def wos_weather(df: DataFrame) -> DataFrame:
    """Weeks of supply from the whole inventory position (weather method)."""
    return df.withColumns(
        {
            "current_wos": weeks_cover(F.col("total_pipeline"), F.col("projected_weekly_sales")),
            "ly_wos": weeks_cover(F.col("total_pipeline_ly"), F.col("baseline_weekly_sales")),
        }
    )


def _wos_after_push() -> Column:
    return weeks_cover(F.col("total_pipeline") + F.col("push_units"), F.col("projected_weekly_sales"))


def _drop_small(push: Column, minimum: float) -> Column:
    return F.when(push >= minimum, push).otherwise(F.lit(0.0))


def push_wos(df: DataFrame, target_wos: float, hysteresis_weeks: float = 0.5, min_push_units: float = 1.0) -> DataFrame:
    """Fill up to the target weeks of supply; ignore small shortfalls and pushes."""
    demand = F.col("projected_weekly_sales")
    gap = F.col("target_inventory") - F.col("total_pipeline")
    return (
        df.withColumn("target_inventory", demand * float(target_wos))
        .withColumn("shortfall_weeks", F.when(demand > 0, gap / demand).otherwise(F.lit(0.0)))
        .withColumn(
            "push_units",
            _drop_small(
                F.when(F.col("shortfall_weeks") >= float(hysteresis_weeks), at_least(gap, 0.0)).otherwise(F.lit(0.0)),
                float(min_push_units),
            ),
        )
        .withColumn("projected_wos_after_push", _wos_after_push())
    )


def push_weather(df: DataFrame, target_wos: float) -> DataFrame:
    """Fill the inventory position up to the target weeks of supply."""
    target = F.col("projected_weekly_sales") * float(target_wos)
    return (
        df.withColumn("target_inventory", target)
        .withColumn("push_units", F.greatest(F.lit(0.0), F.col("target_inventory") - F.col("total_pipeline")))
        .withColumn("projected_wos_after_push", _wos_after_push())
    )


def shelf_fill(df: DataFrame, region: str | None = None) -> DataFrame:
    """Raise the push to fill the shelf where the normal push would not."""
    shelf = F.coalesce(F.col("max_shelf_quantity_this_year").cast("double"), F.lit(0.0))
    short = shelf > F.col("total_pipeline") + F.col("push_units")
    if region:
        short = short & (F.col("region") == region.lower())
    filled = F.greatest(F.lit(0.0), shelf - F.col("total_pipeline"))
    return df.withColumn("push_units", F.when(short, filled).otherwise(F.col("push_units"))).withColumn(
        "projected_wos_after_push", _wos_after_push()
    )


def to_case_packs(df: DataFrame) -> DataFrame:
    """Pushed units as whole packs, ties to even."""
    return df.withColumn("push_case_pack", half_even(F.col("push_units") / F.col("case_pack_qty")).cast("bigint"))


def style_target_gap(df: DataFrame, style_target_wos: float) -> DataFrame:
    """Per (store, style): demand, target, inventory and the gap between them."""
    demand = F.coalesce(F.sum("projected_weekly_sales"), F.lit(0.0)).alias("style_demand")
    pipeline = F.coalesce(F.sum("total_pipeline"), F.lit(0)).alias("style_total_pipeline")
    return (
        totals_of(df, STYLE_KEY, demand, pipeline)
        .withColumn("style_target_inventory", F.greatest(F.lit(0.0), F.col("style_demand") * float(style_target_wos)))
        .withColumn(
            "style_gap", F.greatest(F.lit(0.0), F.col("style_target_inventory") - F.col("style_total_pipeline"))
        )
    )


def style_sigma(df: DataFrame) -> DataFrame:
    """Spread of weekly style demand; the square root of demand where unknown."""
    known = F.col("sigma_weekly") > 0
    return df.withColumn("mu_weekly", F.greatest(F.lit(MIN_DEMAND), F.col("style_demand"))).withColumn(
        "sigma_weekly", F.when(known, F.col("sigma_weekly")).otherwise(F.sqrt("mu_weekly"))
    )


def rop_gate(df: DataFrame, preset: PushPreset) -> DataFrame:
    """Throttle the style gap around the reorder point.

    The gate is 1 while the effective inventory is below the reorder point and
    falls to 0 over ``ramp_weeks`` of demand above it.  Needs ``sigma_weekly``.
    """
    horizon = preset.lead_weeks + preset.review_weeks
    mu, effective = F.col("mu_weekly"), F.col("style_pipeline_eff")
    return (
        style_sigma(df)
        .withColumns(
            {
                "style_pipeline_eff": F.greatest(F.lit(0.0), F.col("style_total_pipeline") - mu * preset.lead_weeks),
                "rop_s": half_even(mu * horizon + F.lit(preset.z_service) * F.col("sigma_weekly") * F.sqrt(F.lit(horizon)), 2),
                "ramp_units": half_even(mu * preset.ramp_weeks, 4),
            }
        )
        .withColumn(
            "gate",
            F.coalesce(
                F.when(
                    F.col("ramp_units") > 0,
                    F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("rop_s") + F.col("ramp_units") - effective) / F.col("ramp_units"))),
                ),
                F.lit(0.0),
            ),
        )
        .withColumn(
            "style_cap",
            half_even(F.col("style_gap") * F.col("gate"), 2) if preset.use_rop_gate else F.col("style_gap"),
        )
    )


def size_targets(df: DataFrame, preset: PushPreset) -> DataFrame:
    """Target stock and raw push of each size, net of demand during transit."""
    demand = F.col("projected_weekly_sales")
    target = at_least(demand, 0.0) * max(preset.style_target_wos, preset.size_min_wos)
    in_transit_demand = at_least(demand, MIN_DEMAND) * preset.lead_weeks
    return (
        df.withColumn("size_target_inventory", target)
        .withColumn("total_pipeline_eff", at_least(F.col("total_pipeline") - in_transit_demand, 0.0))
        .withColumn("raw_push", at_least(F.col("size_target_inventory") - F.col("total_pipeline_eff"), 0.0))
    )


def capacity_clamp(df: DataFrame, front: int = 4, backroom: int = 6) -> DataFrame:
    """Limit the raw push to the room left on the shelf and in the backroom."""
    shelf = F.greatest(F.col("max_shelf_quantity_this_year"), F.lit(front))
    return df.withColumn("capacity_gap", F.greatest(F.lit(0), shelf + backroom - F.col("total_pipeline"))).withColumn(
        "candidate_push", at_most(F.col("raw_push"), F.col("capacity_gap").cast("double"))
    )


def hysteresis_filter(df: DataFrame, hysteresis_weeks: float) -> DataFrame:
    """Keep a candidate only when it covers enough weeks of demand."""
    demand = F.col("projected_weekly_sales")
    return df.withColumn(
        "shortfall_weeks", F.when(demand > 0, F.col("candidate_push") / demand).otherwise(F.lit(0.0))
    ).withColumn(
        "push_units",
        F.when(
            F.col("shortfall_weeks") >= float(hysteresis_weeks), F.coalesce(F.col("candidate_push"), F.lit(0.0))
        ).otherwise(F.lit(0.0)),
    )


def cap_in_group(df: DataFrame, keys: list[str], cap: str, block_on_zero: bool = True) -> DataFrame:
    """Scale the pushes of a group down to its cap and round down to whole units.

    A cap of zero blocks the group, or leaves it as it is with
    ``block_on_zero=False``.  Rows with a NULL key get no push.
    """
    push, total, limit = F.col("push_units"), F.col("_group_push"), F.col(cap)
    scaled = F.floor(push * F.least(F.lit(1.0), limit / total)).cast("double")
    capped = (
        F.when(total.isNull(), F.lit(0.0))
        .when(total <= 0, push)
        .when(limit > 0, scaled)
        .otherwise(F.lit(0.0) if block_on_zero else push)
    )
    return with_group_totals(df, keys, _group_push="push_units").withColumn("push_units", capped).drop("_group_push")


def style_caps(df: DataFrame, spread: DataFrame, preset: PushPreset) -> DataFrame:
    """Targets, reorder point and cap per (store, style).  ``spread`` has sigma."""
    targets = style_target_gap(df, preset.style_target_wos)
    return rop_gate(targets.join(spread.select(*STYLE_KEY, "sigma_weekly"), STYLE_KEY, "left"), preset)


def size_candidates(df: DataFrame, caps: DataFrame, preset: PushPreset) -> DataFrame:
    """Size rows with their clamped, filtered candidate push and style cap."""
    columns = ["style_target_inventory", "style_gap", "style_cap", "gate"]
    joined = df.join(caps.select(*STYLE_KEY, *columns), STYLE_KEY, "left")
    clamped = capacity_clamp(size_targets(joined, preset), preset.front_capacity, preset.backroom_units)
    return hysteresis_filter(clamped, preset.hysteresis_weeks)


def push_style_rop(df: DataFrame, spread: DataFrame, preset: PushPreset, parity: bool = False) -> DataFrame:
    """Style-level target with reorder-point gate, split to sizes within capacity.

    ``parity=True`` reproduces the original program to the letter: styles are
    vendor stock ids, the cap is not gated, a cap of zero does not block, and
    rows without a vendor id are dropped.
    """
    rows = df
    if parity:
        rows = df.withColumn(STYLE, F.col("vendor_stock_id")).where(F.col(STYLE).isNotNull())
    sized = size_candidates(rows, style_caps(rows, spread, preset), preset)
    capped = cap_in_group(sized, STYLE_KEY, "style_gap" if parity else "style_cap", block_on_zero=not parity)
    return (
        capped.withColumn("push_units", _drop_small(F.col("push_units"), float(preset.min_push_units)))
        .withColumn("projected_wos_after_push", _wos_after_push())
        .withColumns(
            {
                "style_target_wos": F.lit(float(preset.style_target_wos)),
                "size_min_wos": F.lit(float(preset.size_min_wos)),
            }
        )
    )


def style_cap_qa(sized: DataFrame, cap: str = "style_cap") -> DataFrame:
    """Where units are lost: raw, capacity-clamped and capped sums per style."""
    raw = at_least(F.col("size_target_inventory") - F.col("total_pipeline"), 0.0)
    return (
        sized.where(F.col(STYLE).isNotNull())
        .withColumn("_raw", raw)
        .withColumn("_clamped", at_most(F.col("_raw"), F.col("capacity_gap").cast("double")))
        .groupBy(STORE, STYLE)
        .agg(
            F.coalesce(F.sum("_raw"), F.lit(0.0)).alias("raw_sum"),
            F.coalesce(F.sum("_clamped"), F.lit(0.0)).alias("after_cap_sum"),
            F.max(cap).alias("style_cap"),
        )
    )


def style_cap_totals(qa: DataFrame) -> DataFrame:
    """Grand totals of the cap report, over exact sums."""
    exact = lambda name: F.sum(F.col(name).cast("decimal(20,6)")).cast("double").alias(name)
    return qa.agg(F.count(F.lit(1)).alias("styles"), exact("raw_sum"), exact("after_cap_sum"), exact("style_cap"))


def push_reason_trend(df: DataFrame, target_wos: float) -> DataFrame:
    return df.withColumn(
        "push_reason",
        trend_reason(F.col("current_wos"), F.col("push_units"), F.col("growth_rate"), float(target_wos)),
    )


def push_reason_weather(df: DataFrame, target_wos: float) -> DataFrame:
    return df.withColumn(
        "push_reason",
        weather_reason(F.col("current_wos"), F.col("push_units"), F.col("weather_adjustment"), float(target_wos)),
    )


def round_trend(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "push_units": half_even(F.col("push_units")).cast("bigint"),
            "pct_of_total_sales": half_even(F.col("pct_of_total_sales"), 2),
            "growth_rate": half_even(F.col("growth_rate"), 3),
        }
    )


def round_weather(df: DataFrame) -> DataFrame:
    digits = {
        "current_wos": 1, "ly_wos": 1, "projected_wos_after_push": 1,
        "pct_of_total_sales": 2, "tw_pct": 3, "nw_pct": 3, "weather_adjustment": 3,
    }
    rounded = {name: half_even(F.col(name), places) for name, places in digits.items()}
    return df.withColumns({"push_units": half_even(F.col("push_units")).cast("bigint"), **rounded})
