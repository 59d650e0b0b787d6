"""Numeric column helpers: coercion, guarded division and half-even rounding.

Spark 4 runs in ANSI mode, so every cast is a ``try_cast`` and every division
is guarded.  The helpers never produce NaN; a missing number is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_TYPE = "decimal(20,4)"
SHARE_TYPE = "decimal(20,6)"


def half_even(value: Column, digits: int = 0) -> Column:
    """Round to ``digits`` places, ties to the even neighbour."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def ratio(
    numerator: Column,
    denominator: Column,
    zero_over_zero: float = 0.0,
    positive_over_zero: float | None = None,
) -> Column:
    """``numerator / denominator`` as double with an explicit zero policy.

    ``positive_over_zero`` of None keeps a signed infinity.
    """
    top, bottom = numerator.cast("double"), denominator.cast("double")
    if positive_over_zero is None:
        overflow = F.when(top > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    else:
        overflow = F.when(top > 0, F.lit(positive_over_zero)).otherwise(F.lit(float("-inf")))
    return (
        F.when(bottom != 0, top / bottom)
        .when(top == 0, F.lit(zero_over_zero))
        .when(top.isNotNull() & bottom.isNotNull(), overflow)
    )


def number(value: Column) -> Column:
    """Text to double; anything that is not a number becomes 0."""
    parsed = F.trim(value.cast("string")).try_cast("double")
    return F.coalesce(F.nanvl(parsed, F.lit(0.0)), F.lit(0.0))


def money(value: Column) -> Column:
    """``'$1,234.50'`` to an exact decimal; unparsable text is NULL."""
    return F.regexp_replace(value.cast("string"), "[$,\\s]", "").try_cast(MONEY_TYPE)


def integer(value: Column) -> Column:
    """Text to bigint, also accepting a decimal rendering such as ``12.0``."""
    text = F.trim(value.cast("string"))
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))


def at_least(value: Column, floor: float) -> Column:
    """Lower bound that keeps NULL as NULL (``greatest`` alone would not)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def at_most(value: Column, ceiling: Column) -> Column:
    """Upper bound that keeps NULL as NULL."""
    return F.when(value.isNotNull(), F.least(value, ceiling))


def weeks_cover(units: Column, weekly: Column, otherwise: float = 999.0) -> Column:
    """Units divided by weekly demand; a sentinel when there is no demand."""
    return F.when(weekly > 0, units.cast("double") / weekly).otherwise(F.lit(otherwise))


def growth(current: Column, previous: Column) -> Column:
    """Relative change, 0 where there is no positive previous value."""
    now, then = current.cast("double"), previous.cast("double")
    return F.when(then > 0, (now - then) / then).otherwise(F.lit(0.0))


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NULL and non-numeric values by 0 in those columns that exist."""
    fixed = {}
    for field in df.schema.fields:
        if field.name not in columns:
            continue
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            fixed[field.name] = number(column)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            fixed[field.name] = F.coalesce(F.nanvl(column, F.lit(0.0)), F.lit(0.0))
        else:
            fixed[field.name] = F.coalesce(column, F.lit(0).cast(field.dataType))
    return df.withColumns(fixed) if fixed else df


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Half-even round every floating column (used by reports and checks)."""
    fixed = {
        f.name: half_even(F.col(f"`{f.name}`"), digits)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixed) if fixed else df
