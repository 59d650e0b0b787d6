"""Group totals and global running shares that hold up under skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import SHARE_TYPE
from shelfcast.sources.durable import materialise


def group_of(keys: list[str]) -> Column:
    """The keys as one value, NULL if one of them is.

    Rows that an earlier join has dealt out by some of the keys are not dealt out by this value, so grouping by it is a
    partial aggregate with an exchange of its own, and neither it nor a join by it keeps adaptive execution from
    splitting the earlier join where a key is hot.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    return F.when(known, F.struct(*keys))


def totals_of(df: DataFrame, keys: list[str], *totals: Column) -> DataFrame:
    """Aggregates by known keys, combined before an exchange of their own: (keys, totals)."""
    grouped = df.withColumn("_group", group_of(keys)).where("_group is not null").groupBy("_group").agg(*totals)
    return grouped.select("_group.*", *[name for name in grouped.columns if name != "_group"])


def with_group_totals(df: DataFrame, keys: list[str], **totals: str) -> DataFrame:
    """Append ``sum(column)`` of each row's group; NULL keys get NULL totals.

    An aggregate joined back rather than a window: sums are combined before the
    shuffle, and a hot group is never gathered in one task, whatever the rows were
    joined by before (see ``group_of``).  Small totals are broadcast by adaptive
    execution, large ones join with skew splitting.
    """
    rows = df.withColumn("_group", group_of(keys))
    sums = rows.where("_group is not null").groupBy("_group").agg(*[F.sum(source).alias(name) for name, source in totals.items()])
    return rows.join(sums, "_group", "left").drop("_group")


def share_of_group(df: DataFrame, keys: list[str], value: str, total: str, name: str) -> DataFrame:
    """``value / total`` of the group, 0 when the total is not positive."""
    share = F.when(F.col(total) > 0, F.col(value) / F.col(total)).otherwise(F.lit(0.0))
    return with_group_totals(df, keys, **{total: value}).withColumn(name, share)


def ranked(
    df: DataFrame, groups: list[str], value: str, keys: list[str], slices: int | None = None, order: list[Column] | None = None
) -> DataFrame:
    """Append ``running`` and ``grand_total`` of a decimal column, largest first, ties by ``keys``; for narrow rows.

    Each value of ``groups`` (a few, as categories) is ranked on its own, all in the same passes.  Two passes instead
    of one global window: rows are range-partitioned by the full order (ties included, so equal values spread over
    slices) and written once, each slice is summed, and every slice starts from the sum of those before it.  Only one
    row per slice and group is ever broadcast.  NULL values come last.  Without ``slices`` adaptive execution merges
    neighbouring ranges to a sensible size.
    """
    wide = "decimal(38,6)"
    within = order or [F.desc_nulls_last(value), *(F.asc(key) for key in keys)]
    order = [*(F.asc(name) for name in groups), *within]
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    sliced = materialise(ranged.withColumn("_slice", F.spark_partition_id()), groups)
    sums = sliced.groupBy(*groups, "_slice").agg(F.sum(value).alias("_sum"))
    by_group = Window.partitionBy(*groups).orderBy("_slice")
    before = by_group.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select(
        *groups, "_slice",
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).cast(wide).alias("_offset"),
        F.coalesce(F.sum("_sum").over(everything), F.lit(0)).cast(wide).alias("grand_total"),
    )
    here = Window.partitionBy("_slice", *groups).orderBy(*within)
    running = F.coalesce(F.sum(value).over(here.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return (
        sliced.join(F.broadcast(offsets), [*groups, "_slice"])
        .withColumn("running", (F.col("_offset") + running).cast(wide))
        .withColumn("_next", F.lead(F.struct(value, *keys)).over(here))
        .drop("_slice", "_offset")
    )


def running_total(df: DataFrame, value: str, order: list[Column], slices: int | None = None) -> DataFrame:
    """Append ``running`` and ``grand_total`` of a decimal column in any global order, for narrow rows; see ``ranked``."""
    return ranked(df, [], value, [], slices, order).drop("_next")


def ranked_by_key(df: DataFrame, groups: list[str], value: str, keys: list[str], slices: int | None = None) -> DataFrame:
    """``ranked`` for wide rows: they are written once, (groups, value, keys) alone are ranked and joined back.

    Rows equal in value and keys have the running total of the last of them.
    """
    columns = [*groups, value, *keys]
    rows = materialise(df, groups)
    places = ranked(rows.select(columns), groups, value, keys, slices).where(~F.struct(value, *keys).eqNullSafe(F.col("_next")))
    places = places.select(*[F.col(name).alias(f"_r_{name}") for name in columns], "running", "grand_total")
    same = F.lit(True)
    for name in columns:
        other = F.col(f"_r_{name}")  # groups are never NULL, and their equality prunes both sides
        same = same & (F.col(name) == other if name in groups else F.col(name).eqNullSafe(other))
    return rows.join(places, same, "left").drop(*[f"_r_{name}" for name in columns])


def as_share(column: Column) -> Column:
    """Double to fixed-scale decimal for order-independent sums."""
    return column.cast(SHARE_TYPE)


def exact_mean(column: Column) -> Column:
    """Average over an exact decimal sum: the same on every run and partitioning."""
    return F.sum(as_share(column)).cast("double") / F.count(column)
