"""Demand projections: style level with an adaptive size mix, item level, weather,
and blending with the client's own forecast.  All column expressions, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.config import WEATHER_FLOOR
from shelfcast.functions.labels import performance_label
from shelfcast.functions.numeric import at_least, coerce_numeric, growth
from shelfcast.operators.calendar import LY_OFFSETS, Period
from shelfcast.operators.facts import inventory_position, style_key, with_style_left
from shelfcast.operators.features import ly_window_name
from shelfcast.operators.grouping import totals_of, with_group_totals
from shelfcast.schemas import ITEM, KEY, STORE, STYLE, STYLE_KEY, UNITS, WEEK

MIN_PROJECTION = 0.01
BASELINE_WEEKS = 13
# Base weights (this year, last year, inventory) above each growth
# bound; a style below every bound, or without a growth rate, takes the last row.
BASE_WEIGHTS = ((0.20, (0.70, 0.20, 0.10)), (0.05, (0.60, 0.25, 0.15)), (-0.05, (0.45, 0.35, 0.20)), (-0.20, (0.30, 0.40, 0.30)))
FALLBACK_WEIGHTS = (0.20, 0.40, 0.40)
WEIGHT_COLUMNS = ("weight_ty", "weight_ly", "weight_pipeline")


def style_growth(styles: DataFrame) -> DataFrame:
    """Growth rate, class and projected weekly units of each store and style."""
    rate = growth(F.col("style_ty_13wk_avg"), F.col("style_ly_13wk_avg"))
    projected = F.col("style_ly_13wk_avg") * (1 + F.col("style_growth_rate"))
    return (
        styles.withColumn("style_growth_rate", rate)
        .withColumn("style_performance", performance_label(F.col("style_growth_rate")))
        .withColumn("style_projected_weekly_sales", at_least(projected, MIN_PROJECTION))
    )


def _years(first: int, last: int) -> list[int]:
    return list(range(first // 100, last // 100 + 1)) or [first // 100]


def _week_bits(first: int, last: int, name: str) -> dict[str, Column]:
    """A bit for each week number, in one bit set for each year of a window of any length."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col(WEEK), F.lit(100)).cast("int"))
    return {f"{name}_{k}": F.when(F.floor(F.col(WEEK) / 100) == year, bit) for k, year in enumerate(_years(first, last))}


def _signals(rows: DataFrame, period: Period, keys: list[str], known: list[str]) -> DataFrame:
    """Units of both years, current inventory and the weeks with a row, by keys of which ``known`` are not NULL.

    One conditional aggregation gives what a full outer join of three separate
    aggregates would: a row wherever any of the three has one.  Stock columns are
    read for the current week only.  The weeks with a row are kept as bit sets,
    so that style averages over the weeks present need no second pass.
    """
    # All keys are tested here: the plan branches that read this frame then ask
    # for the same rows, and Spark runs the shared exchange once.
    for key in known:
        rows = rows.where(F.col(key).isNotNull())
    this_year = F.col(WEEK).between(period.ty_start, period.latest)
    last_year = F.col(WEEK).between(period.ly_start, period.ly_current)
    none = F.lit(None).cast("bigint")

    def when(condition: Column, value: Column, name: str) -> Column:
        return F.when(condition, value).alias(name)

    ty_bits, ly_bits = _week_bits(period.ty_start, period.latest, "ty_weeks"), _week_bits(period.ly_start, period.ly_current, "ly_weeks")
    bits = [*ty_bits, *ly_bits]
    sales = rows.where(this_year | last_year).select(
        *keys,
        when(this_year, F.col(UNITS), "ty"), when(last_year, F.col(UNITS), "ly"), none.alias("stock"),
        *[when(this_year, bit, name) for name, bit in ty_bits.items()], *[when(last_year, bit, name) for name, bit in ly_bits.items()],
    )
    stock = rows.where(F.col(WEEK) == period.latest).select(
        *keys, none.alias("ty"), none.alias("ly"), inventory_position("ty").alias("stock"), *[none.alias(name) for name in bits],
    )

    def total(value: str, name: str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).alias(name)

    return (
        sales.unionByName(stock)
        .groupBy(*keys)
        .agg(
            total("ty", "size_sales_ty_13wk"),
            total("ly", "size_sales_ly_13wk"),
            total("stock", "total_pipeline"),
            *[F.bit_or(name).alias(name) for name in bits],
        )
        .transform(_with_all_bits)
    )


def _with_all_bits(signals: DataFrame) -> DataFrame:
    """True of every row.  It keeps the bit sets in all branches that read the frame; were they pruned from one, Spark
    could not share the exchange below."""
    return signals.where(F.greatest(F.lit(0), F.lit(0), *_bit_sets(signals, "ty"), *_bit_sets(signals, "ly")) >= 0)


def size_signals(styled: DataFrame, period: Period) -> DataFrame:
    """Signals per (store, style, item) of rows that have a style already."""
    return _signals(styled, period, [*STYLE_KEY, ITEM], [*STYLE_KEY, ITEM])


def item_signals(rows: DataFrame, period: Period) -> DataFrame:
    """Signals per (store, item, vendor's stock id): all that styles are derived from, a row in place of up to 27."""
    return _signals(rows, period, [STORE, ITEM, "vendor_stock_id"], [STORE, ITEM])


def style_signals(items: DataFrame, style: DataFrame) -> DataFrame:
    """Signals per (store, style, item) from those by item: the style bridge meets aggregated rows only.

    The sums by style have an exchange of their own, so that adaptive execution may split the join for a hot item.
    """
    bits = [*_bit_sets(items, "ty"), *_bit_sets(items, "ly")]
    sums = [F.sum(name).alias(name) for name in ("size_sales_ty_13wk", "size_sales_ly_13wk", "total_pipeline")]
    styled = style_key(with_style_left(items, style))
    return _with_all_bits(totals_of(styled, [*STYLE_KEY, ITEM], *sums, *[F.bit_or(name).alias(name) for name in bits]))


def _bit_sets(signals: DataFrame, year: str) -> list[str]:
    return [name for name in signals.columns if name.startswith(f"{year}_weeks_")]


def style_totals(signals: DataFrame) -> DataFrame:
    """Style sums, and mean weekly units over the weeks present in each year."""
    sets = {year: _bit_sets(signals, year) for year in ("ty", "ly")}

    def mean(total: str, year: str) -> Column:
        weeks = sum((F.coalesce(F.bit_count(name), F.lit(0)) for name in sets[year]), F.lit(0))
        return F.col(total) / F.nullif(weeks, F.lit(0))

    return (
        signals.groupBy(STYLE_KEY)
        .agg(
            F.sum("size_sales_ty_13wk").alias("style_total_sales_ty"),
            F.sum("size_sales_ly_13wk").alias("style_total_sales_ly"),
            F.sum("total_pipeline").alias("style_total_pipeline"),
            *[F.bit_or(name).alias(name) for names in sets.values() for name in names],
        )
        .withColumns(
            {
                "style_ty_13wk_avg": mean("style_total_sales_ty", "ty"),
                "style_ly_13wk_avg": F.coalesce(mean("style_total_sales_ly", "ly"), F.lit(0.0)),
            }
        )
        .drop(*sets["ty"], *sets["ly"])
    )


def size_mixes(signals: DataFrame, totals: DataFrame) -> DataFrame:
    """Share of each size in its style, by sales of both years and by inventory."""
    names = {
        "ty_size_mix_pct": ("size_sales_ty_13wk", "style_total_sales_ty"),
        "ly_size_mix_pct": ("size_sales_ly_13wk", "style_total_sales_ly"),
        "pipeline_size_mix_pct": ("total_pipeline", "style_total_pipeline"),
    }
    return signals.join(totals, STYLE_KEY, "left").withColumns(
        {
            mix: F.when(F.col(total) > 0, F.col(value) / F.col(total)).otherwise(F.lit(0.0))
            for mix, (value, total) in names.items()
        }
    ).drop(*_bit_sets(signals, "ty"), *_bit_sets(signals, "ly"), *[total for _, total in names.values()])


def _base_weight(rate: Column, position: int) -> Column:
    first_bound, first = BASE_WEIGHTS[0]
    chosen = F.when(rate > first_bound, F.lit(first[position]))
    for bound, weights in BASE_WEIGHTS[1:]:
        chosen = chosen.when(rate > bound, F.lit(weights[position]))
    return chosen.otherwise(F.lit(FALLBACK_WEIGHTS[position]))


def adaptive_weights(mix: DataFrame) -> DataFrame:
    """Blending weights by growth class, shifted by the evidence for each size.

    A size that sold better last year moves weight to last year; a size without
    sales this year but with stock moves weight away from this year.
    """
    ty, ly, stock = F.col("size_sales_ty_13wk"), F.col("size_sales_ly_13wk"), F.col("total_pipeline")
    rate = F.col("style_growth_rate")
    boost = F.when(
        (ly > ty) & (ty > 0), F.least(F.lit(0.15), (ly - ty) / ly * 0.3)
    ).otherwise(F.lit(0.0))
    dormant = (ty == 0) & (stock > 0)
    returning, new = dormant & (ly > 0), dormant & ~(ly > 0)
    step = mix.withColumn("_boost", boost).withColumns(
        {
            "_w_ty": _base_weight(rate, 0) - F.col("_boost") * 0.7,
            "_w_ly": _base_weight(rate, 1) + F.col("_boost"),
            "_w_in": _base_weight(rate, 2) - F.col("_boost") * 0.3,
        }
    )

    def drop_to_zero(column: str, amount: float) -> Column:
        return F.greatest(F.lit(0.0), F.col(column) - amount)

    step = step.withColumns(
        {
            "_v_ty": F.when(returning, drop_to_zero("_w_ty", 0.30)).when(new, drop_to_zero("_w_ty", 0.15)).otherwise(F.col("_w_ty")),
            "_v_ly": F.when(returning, F.col("_w_ly") + 0.20).when(new, drop_to_zero("_w_ly", 0.15)).otherwise(F.col("_w_ly")),
            "_v_in": F.when(returning, F.col("_w_in") + 0.10).when(new, F.col("_w_in") + 0.30).otherwise(F.col("_w_in")),
        }
    ).withColumn("_sum", F.col("_v_ty") + F.col("_v_ly") + F.col("_v_in"))
    parts = dict(zip(WEIGHT_COLUMNS, ("_v_ty", "_v_ly", "_v_in")))
    return step.withColumns(
        {name: F.when(F.col("_sum") > 0, F.col(part) / F.col("_sum")).otherwise(F.col(part)) for name, part in parts.items()}
    ).drop("_boost", "_w_ty", "_w_ly", "_w_in", "_v_ty", "_v_ly", "_v_in", "_sum")


def normalise_in_group(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Rescale a column so that each group sums to 1 (0 when it has no weight)."""
    scaled = F.when(F.col("_total") > 0, F.col(column) / F.col("_total")).otherwise(F.lit(0.0))
    return with_group_totals(df, keys, _total=column).withColumn(column, scaled).drop("_total")


def blended_size_mix(mix: DataFrame) -> DataFrame:
    """Weighted mean of the three mixes, normalised within the style."""
    blended = (
        F.col("weight_ty") * F.col("ty_size_mix_pct")
        + F.col("weight_ly") * F.col("ly_size_mix_pct")
        + F.col("weight_pipeline") * F.col("pipeline_size_mix_pct")
    )
    return normalise_in_group(mix.withColumn("blended_size_mix_pct", blended), STYLE_KEY, "blended_size_mix_pct")


def weighted_mix(styled: DataFrame, period: Period) -> DataFrame:
    """Size mixes with style growth and adaptive weights attached.

    A style without a row this year has no growth, projection or class.
    """
    return mix_of(size_signals(styled, period))


def mix_of(signals: DataFrame) -> DataFrame:
    """``weighted_mix`` from the signals per (store, style, item)."""
    totals = style_totals(signals)
    sold = F.col("style_ty_13wk_avg").isNotNull()
    grown = style_growth(totals)
    derived = ("style_growth_rate", "style_performance", "style_projected_weekly_sales", "style_ly_13wk_avg")
    return adaptive_weights(
        size_mixes(signals, grown.withColumns({c: F.when(sold, F.col(c)) for c in derived}))
    )


def distribute_to_sizes(mix: DataFrame) -> DataFrame:
    """Style projection times size mix; the baseline divides by a fixed 13 weeks."""
    projected = F.col("style_projected_weekly_sales") * F.col("blended_size_mix_pct")
    return mix.withColumns(
        {
            "projected_weekly_sales": at_least(projected, MIN_PROJECTION),
            "baseline_weekly_sales": F.col("size_sales_ty_13wk") / F.lit(float(BASELINE_WEEKS)),
        }
    )


def style_projection(styled: DataFrame, period: Period) -> DataFrame:
    """Projected weekly units per (store, style, item).

    ``styled`` are category rows with a ``style`` column and report-named stock
    columns; rows without a style do not take part.
    """
    return projection_of(size_signals(styled, period))


def projection_of(signals: DataFrame) -> DataFrame:
    """``style_projection`` from the signals per (store, style, item)."""
    return distribute_to_sizes(blended_size_mix(mix_of(signals)))


def attach_projection(current: DataFrame, projection: DataFrame) -> DataFrame:
    """Current rows with their projection; the style comes from the current row."""
    columns = [
        "projected_weekly_sales", "baseline_weekly_sales", "style_growth_rate", "blended_size_mix_pct",
        "style_projected_weekly_sales", "style_ty_13wk_avg", "style_ly_13wk_avg",
    ]
    return current.join(projection.select(*KEY, *columns), KEY, "left").withColumn(
        "growth_rate", F.col("style_growth_rate")
    )


def item_projection(features: DataFrame, facts: DataFrame, period: Period) -> DataFrame:
    """Last year's current and next week, each scaled by the item's growth.

    When the category has no row at all in those two weeks, this year's average
    stands in for both.  ``facts`` is the category slice.
    """
    pair_rows = (
        facts.where(F.col(WEEK).isin(period.ly_current, period.ly_next)).agg(F.count(F.lit(1)).alias("n")).scalar()
    )

    def last_year(name: str) -> Column:
        return F.when(pair_rows == 0, F.col("ty_13wk_avg")).otherwise(F.coalesce(F.col(name), F.lit(0.0)))

    scaled = 1 + F.col("growth_rate")
    return (
        features.withColumns({name: last_year(name) for name in ("ly_current_week", "ly_next_week")})
        .withColumn("growth_rate", growth(F.col("ty_13wk_avg"), F.col("ly_13wk_avg")))
        .withColumns(
            {
                "tw_projected": F.col("ly_current_week") * scaled,
                "nw_projected": F.col("ly_next_week") * scaled,
                "baseline_weekly_sales": F.col("ty_13wk_avg"),
            }
        )
        .withColumn(
            "projected_weekly_sales",
            F.greatest(F.lit(MIN_PROJECTION), (F.col("tw_projected") + F.col("nw_projected")) / 2),
        )
    )


def client_forecast_avg(forecast: DataFrame, subcategories, weeks: int = 4, from_week: int | None = None) -> DataFrame:
    """Mean forecast units per store and item over the first ``weeks`` weeks.

    The window is the first distinct weeks of the whole snapshot, or those from
    ``from_week`` on; its end is a scalar, so only a filter reaches the rows.
    """
    rows = forecast if from_week is None else forecast.where(F.col("f5c_calendar_week") >= from_week)
    first_weeks = rows.select("f5c_calendar_week").distinct().orderBy("f5c_calendar_week").limit(weeks)
    last = first_weeks.agg(F.max("f5c_calendar_week")).scalar()
    return (
        rows.where(F.col("subcategory_nbr").isin([str(s) for s in subcategories]))
        .where(F.col("f5c_calendar_week") <= last)
        .groupBy(F.col("store_nbr").alias(STORE), F.col("f5c_item_nbr").alias(ITEM))
        .agg(F.avg("final_forecast_each_quantity").alias("avg_forecast_each"))
    )


def blend_forecast(df: DataFrame, forecast: DataFrame, weight: float) -> DataFrame:
    """Mix the engine's projection with the client's where the client has one."""
    mixed = (1 - weight) * F.col("projected_weekly_sales") + weight * F.col("avg_forecast_each")
    has_forecast = F.col("avg_forecast_each").isNotNull()
    label = "CLIENT_FORECAST" if weight >= 0.999 else "Blend"
    return (
        df.join(forecast.select(*KEY, "avg_forecast_each"), KEY, "left")
        .withColumn("engine_projected_weekly_sales", F.col("projected_weekly_sales"))
        .withColumns(
            {
                "projected_weekly_sales": F.when(has_forecast, at_least(mixed, MIN_PROJECTION)).otherwise(
                    F.col("projected_weekly_sales")
                ),
                "projection_source": F.when(has_forecast, F.lit(label)).otherwise(F.lit("Engine")),
            }
        )
    )


def weather_projection(df: DataFrame, facts: DataFrame, period: Period) -> DataFrame:
    """Last year's current and next week scaled by the floored regional outlook.

    The baseline averages only those of the six weeks in which the category sold
    anything at all; a week absent for one row counts as 0.  ``facts`` is the
    category slice, ``df`` carries the six-week pivot and the outlook.
    """
    window = [ly_window_name(o) for o in LY_OFFSETS]
    weeks_present = (
        facts.where(F.col(WEEK).isin(*period.ly_window)).agg(F.countDistinct(WEEK).alias("n")).scalar()
    )
    base = coerce_numeric(df, [*window, "tw_pct", "nw_pct"])
    total = sum((F.col(f"`{c}`") for c in window[1:]), F.col(f"`{window[0]}`"))
    now, following = F.col(f"`{ly_window_name(0)}`"), F.col(f"`{ly_window_name(1)}`")
    return (
        base.withColumns({c: F.greatest(F.lit(WEATHER_FLOOR), F.col(c)) for c in ("tw_pct", "nw_pct")})
        .withColumns(
            {
                "tw_projected": now * (1 + F.col("tw_pct")),
                "nw_projected": following * (1 + F.col("nw_pct")),
                "weather_adjustment": (F.col("tw_pct") + F.col("nw_pct")) / 2,
                "baseline_weekly_sales": F.when(weeks_present > 0, total / weeks_present).otherwise(now),
            }
        )
        .withColumn(
            "projected_weekly_sales",
            F.greatest(F.lit(MIN_PROJECTION), (F.col("tw_projected") + F.col("nw_projected")) / 2),
        )
    )

