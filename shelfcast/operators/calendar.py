"""Retail calendar: week arithmetic, TY/LY alignment, period windows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.labels import season_label
from shelfcast.schemas import WEEK

WEEKS_IN_YEAR = 52
# Four half-year reporting windows, inclusive.
DEFAULT_SEASONS = ((202401, 202426), (202427, 202453), (202501, 202526), (202527, 202553))


@dataclass(frozen=True)
class RetailCalendar:
    """52-week years, plus a week 53 in each of ``long_years``.

    ``index`` is dense, so "13 weeks back" means 13 weeks also across New Year.
    """

    long_years: tuple[int, ...] = ()

    def _year_start(self, year: int) -> int:
        return year * WEEKS_IN_YEAR + sum(1 for y in self.long_years if y < year)

    def index(self, week: int) -> int:
        return self._year_start(week // 100) + week % 100 - 1

    def week(self, index: int) -> int:
        year = index // WEEKS_IN_YEAR
        while self._year_start(year) > index:
            year -= 1
        while self._year_start(year + 1) <= index:
            year += 1
        return year * 100 + index - self._year_start(year) + 1

    def shift(self, week: int, weeks: int) -> int:
        return self.week(self.index(week) + weeks)

    def between(self, first: int, last: int) -> tuple[int, ...]:
        return tuple(self.week(i) for i in range(self.index(first), self.index(last) + 1))

    def index_column(self, week: Column) -> Column:
        year = F.floor(week / 100)
        value = year * WEEKS_IN_YEAR + F.pmod(week, F.lit(100)) - 1
        for long_year in self.long_years:
            value = value + F.when(year > long_year, 1).otherwise(0)
        return value.cast("int")


@dataclass(frozen=True)
class Period:
    """The handful of week numbers a run works on.

    They enter plans as literals, so a week-partitioned fact table is pruned to
    the touched partitions when the plan is made, not while it runs.
    """

    latest: int
    ty_start: int
    ty52_start: int
    check_start: int
    recent: tuple[int, ...]
    ly_start: int
    ly_current: int
    ly_next: int
    ly_window: tuple[int, ...]
    calendar: RetailCalendar = RetailCalendar()

    @property
    def last_week(self) -> int:
        return self.recent[0]

    @property
    def ty_weeks(self) -> tuple[int, ...]:
        return self.calendar.between(self.ty_start, self.latest)

    @property
    def ly_weeks(self) -> tuple[int, ...]:
        return self.calendar.between(self.ly_start, self.ly_current)


LY_OFFSETS = (-3, -2, -1, 0, 1, 2)


def assign_season(df: DataFrame, week: str = WEEK) -> DataFrame:
    return df.withColumn("season", season_label(F.col(week)))


def in_seasons(df: DataFrame, ranges, week: str = WEEK) -> DataFrame:
    """Keep rows inside any of the inclusive week ranges; one scan, one OR filter."""
    keep = F.lit(False)
    for low, high in ranges:
        keep = keep | F.col(week).between(low, high)
    return df.where(keep)


def season_ranges(first_year: int, last_year: int) -> tuple[tuple[int, int], ...]:
    """Spring and fall windows of consecutive years."""
    years = range(first_year, last_year + 1)
    return tuple(r for y in years for r in ((y * 100 + 1, y * 100 + 26), (y * 100 + 27, y * 100 + 53)))


def unique_mapping(week_map: DataFrame) -> DataFrame:
    """The mapping with ``ty_week`` as its primary key: equal rows become one, different ones fail the job."""
    clash = F.min("ly_week") != F.max("ly_week")
    clear = F.when(clash, F.raise_error(F.concat(F.lit("several last-year weeks for week "), F.col("ty_week"))).cast("int")).otherwise(F.max("ly_week"))
    rest = [F.max(name).alias(name) for name in week_map.columns if name not in ("ty_week", "ly_week")]
    return week_map.groupBy("ty_week").agg(clear.cast("int").alias("ly_week"), *rest)


def week_to_ly(df: DataFrame, week_map: DataFrame, week: str = WEEK) -> DataFrame:
    """Append ``ly_week``: the mapped week, or the same week number a year earlier.

    The mapping has one row per calendar week (which is enforced), so
    broadcasting it is bounded by the number of weeks in history.
    """
    mapped = unique_mapping(week_map.select("ty_week", "ly_week")).toDF("_ty_week", "_ly_week")
    return (
        df.join(F.broadcast(mapped), F.col(week) == F.col("_ty_week"), "left")
        .withColumn("ly_week", F.coalesce(F.col("_ly_week"), F.col(week) - 100).cast("int"))
        .drop("_ty_week", "_ly_week")
    )


def calendar_of(facts: DataFrame, week_map: DataFrame) -> RetailCalendar:
    """A calendar with a week 53 in the years for which facts or mapping have one (a row a year is read)."""
    weeks = [facts.select(F.col(WEEK).alias("week"))] + [week_map.select(F.col(name).alias("week")) for name in ("ty_week", "ly_week")]
    years = F.floor(F.col("week") / 100).cast("int").alias("year")
    long_years = [frame.where(F.pmod(F.col("week"), F.lit(100)) == 53).select(years).distinct() for frame in weeks]
    found = long_years[0].unionByName(long_years[1]).unionByName(long_years[2]).distinct().collect()
    return RetailCalendar(tuple(sorted(row["year"] for row in found)))


def latest_week(df: DataFrame, week: str = WEEK) -> DataFrame:
    return df.agg(F.max(week).alias("latest_week"))


def resolve_period(
    facts: DataFrame,
    week_map: DataFrame,
    calendar: RetailCalendar | None = None,
    target_week: int | None = None,
) -> Period | None:
    """Read the week numbers of a run: three integers, and the years with a week 53 if no calendar is given.

    Returns None for an empty fact table.
    """
    latest = target_week
    if latest is None:
        latest = latest_week(facts).first()["latest_week"]
    if latest is None:
        return None
    calendar = calendar_of(facts, week_map) if calendar is None else calendar
    back = lambda n: calendar.shift(latest, -n)
    ty_start = back(12)
    mapped = {
        row["ty_week"]: row["ly_week"]
        for row in unique_mapping(week_map.where(F.col("ty_week").isin(latest, ty_start)).select("ty_week", "ly_week")).collect()
    }
    ly_current = mapped.get(latest, latest - 100)
    return Period(
        latest=latest,
        ty_start=ty_start,
        ty52_start=back(51),
        check_start=back(25),
        recent=tuple(back(n) for n in (1, 2, 3, 4)),
        ly_start=mapped.get(ty_start, ty_start - 100),
        ly_current=ly_current,
        ly_next=calendar.shift(ly_current, 1),
        ly_window=tuple(calendar.shift(ly_current, n) for n in LY_OFFSETS),
        calendar=calendar,
    )


#: Windows of a target week, as weeks before and after it or its last-year week.
TY_WINDOWS = {"ty13": (-12, 0), "ty52": (-51, 0), "check": (-25, 0), "recent": (-4, -1)}
LY_WINDOWS = {"ly_window": (LY_OFFSETS[0], LY_OFFSETS[-1]), "ly_pair": (0, 1)}


def calendar_dimension(facts: DataFrame, week_map: DataFrame) -> DataFrame:
    """Every week of the years of facts and mapping, and of the two years around them: (week, week_idx).

    The index is dense, so weeks of any distance meet by an equality of indexes.  A year has a week 53 if facts or
    mapping have one.  The table grows with the calendar only and may be broadcast.
    """
    seen = reduce(
        DataFrame.unionByName,
        [facts.select(F.col(WEEK).alias("week")).distinct(), *(week_map.select(F.col(name).alias("week")) for name in ("ty_week", "ly_week"))],
    )
    years = seen.groupBy(F.floor(F.col("week") / 100).cast("int").alias("year")).agg(F.max(F.pmod(F.col("week"), F.lit(100))).alias("last"))
    bounds = years.agg(F.min("year").alias("first"), F.max("year").alias("final")).where("first is not null")
    every = bounds.select(F.explode(F.sequence(F.col("first") - 2, F.col("final") + 2)).alias("year")).join(years, "year", "left")
    slots = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(WEEKS_IN_YEAR), F.coalesce("last", F.lit(0)))))
    weeks = every.select("year", slots.alias("slot"))
    week = (F.col("year") * 100 + F.col("slot")).cast("int")
    long_before = F.sum(F.when(F.col("slot") == 53, 1).otherwise(0)).over(Window.orderBy("year", "slot").rowsBetween(Window.unboundedPreceding, -1))
    return weeks.select(week.alias("week"), (F.col("year") * WEEKS_IN_YEAR + F.col("slot") - 1 + F.coalesce(long_before, F.lit(0))).cast("int").alias("week_idx"))


def target_windows(targets: DataFrame, dimension: DataFrame, week_map: DataFrame) -> DataFrame:
    """The weeks of every window of many target weeks: (target_week, window, position, week), one row each.

    ``targets`` has a column ``target_week``.  Offsets are joins with the calendar; ``position`` is the distance from
    the target or, in last-year windows, from its last-year week.  Aggregates of all targets follow from one join of
    the facts with this table, instead of a run for each.
    """
    index = F.broadcast(dimension)

    def at(frame: DataFrame, week: str, name: str) -> DataFrame:
        return frame.join(index.select(F.col("week").alias(week), F.col("week_idx").alias(name)), week, "left")

    base = at(targets.select("target_week").distinct(), "target_week", "ty_idx")
    starts = index.select(F.col("week").alias("start_week"), (F.col("week_idx") + 12).alias("ty_idx"))
    base = week_to_ly(base, week_map, "target_week").withColumnRenamed("ly_week", "ly_current")
    base = week_to_ly(base.join(starts, "ty_idx", "left"), week_map, "start_week").withColumnRenamed("ly_week", "ly_start")
    base = at(at(base, "ly_current", "ly_idx"), "ly_start", "ly_start_idx")

    def window(name: str, origin: str, first: Column, last: Column) -> Column:
        return F.struct(F.lit(name).alias("window"), F.col(origin).alias("origin"), first.alias("first"), last.alias("last"))

    spans = [window(name, "ty_idx", F.lit(a), F.lit(b)) for name, (a, b) in TY_WINDOWS.items()]
    spans += [window(name, "ly_idx", F.lit(a), F.lit(b)) for name, (a, b) in LY_WINDOWS.items()]
    spans.append(window("ly13", "ly_idx", F.col("ly_start_idx") - F.col("ly_idx"), F.lit(0)))
    every = base.select("target_week", F.explode(F.array(*spans)).alias("span")).select("target_week", "span.*").where("first <= last")
    placed = every.select("target_week", "window", "origin", F.explode(F.sequence("first", "last")).alias("position"))
    return placed.join(index.withColumnRenamed("week_idx", "_idx"), F.col("origin") + F.col("position") == F.col("_idx")).select("target_week", "window", "position", "week")


def windowed_units(facts: DataFrame, windows: DataFrame, keys: list[str], units: str) -> DataFrame:
    """Units of every window of every target week by key, from one pass over the facts.

    Weeks are summed before the join, which then repeats a key's week for the windows that hold it.
    """
    weekly = facts.groupBy(*keys, WEEK).agg(F.sum(units).alias("_units"))
    held = weekly.join(F.broadcast(windows.select("target_week", "window", F.col("week").alias(WEEK))), WEEK)
    return held.groupBy("target_week", "window", *keys).agg(F.sum("_units").alias("units"), F.count(F.lit(1)).alias("weeks"))


def week_map_template(bounds: DataFrame) -> DataFrame:
    """Week pairs to be edited by hand: LY is the same week number a year earlier.

    ``bounds`` holds ``start_week`` and ``num_weeks``; any number of weeks rolls
    over correctly.
    """
    slot = F.pmod(F.col("start_week"), F.lit(100)) - 1 + F.col("step")
    year = F.floor(F.col("start_week") / 100) + F.floor(slot / WEEKS_IN_YEAR)
    return (
        bounds.select("start_week", F.explode(F.expr("sequence(0, num_weeks - 1)")).alias("step"))
        .select((year * 100 + F.pmod(slot, F.lit(WEEKS_IN_YEAR)) + 1).cast("int").alias("ty_week"))
        .select("ty_week", (F.col("ty_week") - 100).cast("int").alias("ly_week"), F.lit("").alias("notes"))
    )


def upsert_week_mapping(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Insert or replace by ``ty_week``, of which each may come once only."""
    columns = ["ty_week", "ly_week", "notes"]
    fresh = unique_mapping(delta.select(columns))
    kept = unique_mapping(base.select(columns)).join(fresh.select("ty_week"), "ty_week", "left_anti")
    return kept.select(columns).unionByName(fresh.select(columns))


def list_week_mapping(week_map: DataFrame) -> DataFrame:
    return week_map.orderBy("ty_week")
