"""Dimension and forecast tables: full-refresh loads from CSV or Parquet.

A load writes beside the table, is checked there, and takes effect with a new
version (see ``versions``); one that fails leaves the table as it was.  Read the
tables with ``read_dimension``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schemas
from shelfcast.functions.numeric import integer
from shelfcast.operators.calendar import unique_mapping
from shelfcast.sources import versions


@dataclass(frozen=True, eq=False)
class DimensionSpec:
    """Target schema of a table and renames from normalised headers."""

    name: str
    schema: T.StructType
    renames: dict[str, str] = field(default_factory=dict)


STORES = DimensionSpec("dim_stores", schemas.DIM_STORES)
ITEMS = DimensionSpec("dim_items", schemas.DIM_ITEMS)
CAPACITY = DimensionSpec("dim_capacity", schemas.DIM_CAPACITY)
CASE_PACK = DimensionSpec("dim_case_pack", schemas.DIM_CASE_PACK)
STYLE = DimensionSpec("dim_category_a_style", schemas.DIM_STYLE)
WEEK_MAPPING = DimensionSpec("dim_week_mapping", schemas.DIM_WEEK_MAPPING)
CLIENT_FORECAST = DimensionSpec("client_forecast_fact", schemas.CLIENT_FORECAST)
WEATHER = DimensionSpec(
    "fact_forecast_vendor",
    schemas.WEATHER_FORECAST,
    {short: f"{short}_pct" for short in ("tw", "nw", "m1", "m2", "m3")},
)
#: Versions of a table that stay readable behind the newest.
KEPT_VERSIONS = 10
# Header fragments, looked for in column order.
TY_FRAGMENTS = ("ty", "this year", "current", "2025")
LY_FRAGMENTS = ("ly", "last year", "prior", "2024")


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV (all text) or Parquet, by file extension."""
    if path.rstrip("/").lower().endswith(".csv"):
        return spark.read.options(header=True, escape='"').csv(path)
    return spark.read.parquet(path)


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def shape(df: DataFrame, spec: DimensionSpec) -> DataFrame:
    """Normalised, renamed and cast to the table's schema; absent columns are NULL."""
    named = normalise_headers(df).withColumnsRenamed(spec.renames)
    columns = []
    for target in spec.schema.fields:
        if target.name not in named.columns:
            value = F.lit(None).cast(target.dataType)
        elif isinstance(target.dataType, (T.IntegerType, T.LongType)):
            value = integer(F.col(target.name)).try_cast(target.dataType)
        elif isinstance(target.dataType, T.StringType):
            value = F.col(target.name).cast("string")
        else:
            value = F.col(target.name).try_cast(target.dataType)
        columns.append(value.alias(target.name))
    return named.select(columns)


class RejectedLoad(ValueError):
    """A file whose rows cannot be those of the table."""


@dataclass(frozen=True)
class Staged:
    """Rows written beside a table, checked, and not yet part of it."""

    spec: DimensionSpec
    target: str
    before: versions.Version
    folders: tuple[tuple[str, str], ...]


def stage(df: DataFrame, spec: DimensionSpec, target: str) -> Staged:
    """Write and check a load: rows that all lack the table's first column, its key, are not of this table."""
    spark, key = df.sparkSession, spec.schema.names[0]
    before = versions.open_version(spark, target)
    folders = versions.add_folders(df, target)
    rows, keyed = versions.read_folders(spark, target, folders, spec.schema).agg(F.count(F.lit(1)), F.count(key)).first()
    if rows and not keyed:
        raise RejectedLoad(f"{spec.name}: none of {rows} rows has a {key}")
    return Staged(spec, target, before, folders)


def publish(spark: SparkSession, staged: Staged, keep: tuple[tuple[str, str], ...] = (), label: str = "") -> DataFrame:
    """Make a staged load the table's newest version, beside the folders ``keep`` of the one before."""
    folders = tuple((label, folder) for _, folder in staged.folders)
    version = staged.before.next(keep + folders)
    versions.commit(spark, staged.target, version)
    versions.tidy(spark, staged.target, KEPT_VERSIONS)
    return versions.read_folders(spark, staged.target, version.folders, staged.spec.schema)


def read_dimension(spark: SparkSession, spec: DimensionSpec, target: str, version: int | None = None) -> DataFrame:
    """The table's newest version, or that of a number; later loads do not change the frame."""
    return versions.read(spark, target, spec.schema, version)


def load_dimension(spark: SparkSession, path: str, spec: DimensionSpec, target: str) -> DataFrame:
    """Replace the table at ``target`` by the file's rows."""
    return publish(spark, stage(shape(read_any(spark, path), spec), spec, target))


def _outlook(spark: SparkSession, path: str, week_date: dt.date | str | None) -> tuple[DataFrame, str]:
    """The rows of a regional outlook with their import date, and that date."""
    day = str(week_date) if week_date is not None else str(spark.range(1).select(F.current_date()).first()[0])
    return shape(read_any(spark, path), WEATHER).withColumn("week_imported", F.lit(day).cast("date")), day


def load_weather_forecast(
    spark: SparkSession, path: str, target: str, week_date: dt.date | str | None = None, history: bool = False
) -> DataFrame:
    """Regional outlook stamped with its import date (today unless given).

    Replaces the table; with ``history=True`` only an earlier import of the same date.
    """
    rows, day = _outlook(spark, path, week_date)
    staged = stage(rows, WEATHER, target)
    return publish(spark, staged, staged.before.without([day]) if history else (), day)


def detect_week_columns(columns) -> tuple[str, str]:
    """This-year and last-year columns: exact names first, then header fragments."""

    def find(exact: str, fragments) -> str | None:
        lowered = {c: str(c).lower().strip() for c in columns}
        named = [c for c, low in lowered.items() if low.replace(" ", "_") == exact]
        partial = [c for c, low in lowered.items() if any(f in low for f in fragments)]
        return (named or partial or [None])[0]

    ty, ly = find("ty_week", TY_FRAGMENTS), find("ly_week", LY_FRAGMENTS)
    if ty is None or ly is None:
        raise ValueError(f"cannot identify this-year and last-year columns in {list(columns)}")
    if ty == ly:
        raise ValueError(f"column {ty!r} matches both this year and last year")
    return ty, ly


def week_mapping(df: DataFrame) -> DataFrame:
    """Week pairs of a lookup sheet; blank and non-numeric rows are left out."""
    ty, ly = detect_week_columns(df.columns)
    return df.select(
        integer(F.col(f"`{ty}`")).try_cast("int").alias("ty_week"),
        integer(F.col(f"`{ly}`")).try_cast("int").alias("ly_week"),
        F.lit(None).cast("string").alias("notes"),
    ).dropna(subset=["ty_week", "ly_week"])


def load_week_mapping(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Replace the week mapping; two different rows for one week fail the load."""
    return publish(spark, stage(unique_mapping(week_mapping(read_any(spark, path))), WEEK_MAPPING, target))


def load_all_dimensions(
    spark: SparkSession, folder: str, target: str, files: dict[str, str] | None = None, week_date=None
) -> dict[str, DataFrame]:
    """Refresh stores, items, capacity, case packs and the weather outlook, all or none.

    ``files`` maps table names to file names in ``folder`` where they differ from
    ``<table>.csv``.  The client forecast is loaded on its own.  All tables are
    written and checked before the first takes effect.
    """
    files = files or {}
    source = lambda spec: f"{folder}/{files.get(spec.name, spec.name + '.csv')}"
    rows = {spec: shape(read_any(spark, source(spec)), spec) for spec in (STORES, ITEMS, CAPACITY, CASE_PACK)}
    rows[WEATHER], day = _outlook(spark, source(WEATHER), week_date)
    staged = [stage(df, spec, f"{target}/{spec.name}") for spec, df in rows.items()]
    return {one.spec.name: publish(spark, one, label=day if one.spec is WEATHER else "") for one in staged}
