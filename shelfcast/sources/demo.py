"""Retail tables derived from a TPC-H-like star schema.

Line items are read as point-of-sale events: four suppliers form a store, forty
parts form an item, and a week is a seventh of days counted from New Year.  All
tables, dimensions included, grow with the input.  Measures are integers so that
sums are exact.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.calendar import Period, resolve_period, week_to_ly
from shelfcast.schemas import CATEGORY_A, CATEGORY_A_SUBCATEGORIES, GENERAL, ITEM, STORE, WEEK
from shelfcast.sources.durable import materialise

SUPPLIERS_PER_STORE = 4
PARTS_PER_ITEM = 40
SUBCATEGORIES = ("1001", "1002", "2001", "3001", "4001", "4002", "4003", "4004", "5001", "6001", "6002", "6003")
MEASURES = ["qty", "cents", "oh", "wh", "tr", "oo"]
#: Line items that a part of a week, and a task that makes facts of them, hold at most (about).
PART_ROWS = 200_000
TASK_ROWS = 400_000
UNMAPPED_ITEMS = (9, 25, 37, 41)
VENDORLESS_ITEMS = (37, 41)


def _code(prefix: str, number: Column) -> Column:
    """Five digits at least; longer numbers keep all of theirs."""
    whole = number.cast("bigint")
    padded = F.concat(F.lit(prefix), F.lpad(whole.cast("string"), 5, "0"))  # a formatter for each row costs more than its other columns
    return F.when(whole.between(0, 99_999), padded).otherwise(F.format_string(f"{prefix}%05d", whole))


def _item_columns(i: Column) -> dict[str, Column]:
    family = F.expr("(i div 24) * 12 + i % 12")
    return {
        "item": _code("I", i),
        "subcat": F.element_at(F.array(*[F.lit(s) for s in SUBCATEGORIES]), (i % 12 + 1).cast("int")),
        "style": F.when(~(i % 48).isin(*UNMAPPED_ITEMS), _code("ST", family)),
        "vsi": F.when(~(i % 48).isin(*VENDORLESS_ITEMS), _code("V", family)),
    }


class DemoTables:
    """Lazy frames over one data folder; only week numbers are ever fetched."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        """One row per line item, under retail keys."""
        day = F.to_date("l_shipdate")
        return self.table("lineitem").select(
            (F.year(day) * 100 + F.least(F.lit(52), F.floor((F.dayofyear(day) - 1) / 7) + 1)).cast("int").alias("wk"),
            F.expr(f"l_suppkey div {SUPPLIERS_PER_STORE}").alias("st"),
            F.expr(f"l_partkey div {PARTS_PER_ITEM}").alias("i"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
            ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 60).alias("oh"),
            (F.col("l_orderkey") % 13).alias("wh"),
            (F.col("l_partkey") % 7).alias("tr"),
            ((F.col("l_orderkey") + F.col("l_suppkey")) % 11).alias("oo"),
        )

    @cached_property
    def cells(self) -> DataFrame:
        """Units and stock per (week, store, item)."""
        return (
            self.events.groupBy("wk", "st", "i")
            .agg(*[F.sum(c).alias(c) for c in MEASURES])
            .withColumn("tc", (F.col("wk") + F.col("st") + F.col("i")) % 4)
        )

    @cached_property
    def weeks(self) -> DataFrame:
        """Line items of each week, counted once: grows with the calendar only."""
        return materialise(self.events.groupBy("wk").agg(F.count(F.lit(1)).alias("n")))

    @cached_property
    def week_map(self) -> DataFrame:
        """One-week shift in 2001; every fifth week is left unmapped."""
        shift = F.when((F.floor(F.col("wk") / 100) == 2001) & (F.col("wk") % 100 < 52), 99).otherwise(100)
        return (
            self.weeks.where((F.col("wk") % 100) % 5 != 0)
            .select(
                F.col("wk").alias("ty_week"),
                (F.col("wk") - shift).cast("int").alias("ly_week"),
                F.lit(None).cast("string").alias("notes"),
            )
        )

    @cached_property
    def reported(self) -> DataFrame:
        """Line items under every week that reports them: their own, and those that they are the last year (``past``) of.

        Dealt out by week and, in weeks of many line items, by store and item: as facts are stored.
        """
        sizes = week_to_ly(self.weeks, self.week_map, "wk").join(F.broadcast(self.weeks.toDF("ly_week", "ly_n")), "ly_week", "left")
        parts = F.ceil((F.col("n") + F.coalesce("ly_n", F.lit(0))) / PART_ROWS).alias("parts")
        own = sizes.select(F.col("wk").alias("week"), F.col("wk").alias("origin"), F.lit(False).alias("past"), parts)
        links = own.unionByName(sizes.where("ly_n > 0").select(F.col("wk").alias("week"), F.col("ly_week").alias("origin"), F.lit(True).alias("past"), parts))
        rows = self.events.join(F.broadcast(links), F.col("wk").eqNullSafe(F.col("origin"))).where("not past or st is not null and i is not null")
        rows = rows.select(F.col("week").alias("wk"), F.pmod(F.xxhash64("st", "i"), F.col("parts")).alias("part"), "past", "st", "i", *MEASURES)
        total = self.weeks.agg(F.sum("n").alias("n")).first()["n"] or 0
        return rows.repartition(max(self.spark.sparkContext.defaultParallelism, 2 * total // TASK_ROWS), "wk", "part")

    @cached_property
    def facts(self) -> DataFrame:
        """The unified fact view with last-year columns, dealt out by week (see ``reported``).

        This year's and last year's line items of a cell meet in one exchange and one aggregation.
        """
        both_years = self.reported.groupBy("wk", "part", "st", "i").agg(
            F.count_if(~F.col("past")).alias("rows"),
            F.count_if("past").alias("l_rows"),
            *[F.sum(F.when(~F.col("past"), F.col(c))).alias(c) for c in MEASURES],
            *[F.sum(F.when(F.col("past"), F.col(c))).alias(f"l_{c}") for c in MEASURES],
        )
        parity = lambda week: (F.col(week) + F.col("st") + F.col("i")) % 4
        aligned = week_to_ly(both_years.where("rows > 0"), self.week_map, "wk").withColumns(
            {"tc": parity("wk"), "l_tc": F.when(F.col("l_rows") > 0, parity("ly_week"))}
        )
        i = F.col("i")

        def dollars(cents: Column) -> Column:
            whole, rest = F.floor(cents / 100).cast("bigint"), cents % 100
            return F.concat(F.lit("$"), whole.cast("string"), F.lit("."), F.lpad(rest.cast("string"), 2, "0"))

        def both(name: str, short: str) -> list[Column]:
            return [F.col(short).alias(f"{name}_this_year"), F.col(f"l_{short}").alias(f"{name}_last_year")]

        is_a = F.col("subcat").isin(*CATEGORY_A_SUBCATEGORIES)
        return aligned.withColumns(_item_columns(i)).select(
            F.col("wk").alias(WEEK),
            F.concat(F.lit("Sub "), "subcat").alias("subcategory_description"),
            F.col("subcat").alias("subcategory_number"),
            F.col("st").cast("string").alias(STORE),
            F.col("item").alias(ITEM),
            *both("pos_quantity", "qty"),
            *both("store_in_warehouse_quantity", "wh"),
            *both("store_in_transit_quantity", "tr"),
            *both("store_on_order_quantity", "oo"),
            *both("store_on_hand_quantity", "oh"),
            F.col("oh").alias("store_on_hand_quantity_this_year_eop"),
            F.col("l_oh").alias("store_on_hand_quantity_last_year_eop"),
            dollars(F.col("cents")).alias("pos_sales_this_year"),
            dollars(F.col("l_cents")).alias("pos_sales_last_year"),
            F.when(i % 10 != 0, 20 + (i % 9) * 10).alias("max_shelf_quantity_this_year"),
            *both("traited_store_count", "tc"),
            F.col("tc").alias("valid_store_count_this_year"),
            F.col("vsi").alias("vendor_stock_id"),
            F.when(is_a, F.concat(F.lit("Color "), (i % 3).cast("string"))).alias("color_description"),
            F.when(is_a & (i % 48 != 36), F.concat(F.lit("Trait "), (i % 2).cast("string"))).alias("trait_description"),
            F.when(is_a, F.lit(CATEGORY_A)).otherwise(F.lit(GENERAL)).alias("source_table"),
        )

    @cached_property
    def stores(self) -> DataFrame:
        """A store lies where its first supplier does; every 25th has no entry."""
        return (
            self.table("supplier")
            .groupBy(F.expr(f"s_suppkey div {SUPPLIERS_PER_STORE}").alias("st"))
            .agg(F.min("s_nationkey").alias("n_nationkey"))
            .where(F.col("st") % 25 != 24)
            .join(self.table("nation"), "n_nationkey")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("st").cast("string").alias(STORE),
                F.col("n_name").alias("state"),
                F.col("r_name").alias("region"),
                F.format_string("%08d", F.col("st").cast("bigint") * 101).alias("zip_code"),
                (F.col("st") % 4).cast("int").alias("merch_zone_number"),
            )
        )

    @cached_property
    def catalogue(self) -> DataFrame:
        """One row per item with its codes and list price."""
        grouped = (
            self.table("part")
            .groupBy(F.expr(f"p_partkey div {PARTS_PER_ITEM}").alias("i"))
            .agg(F.min("p_name").alias("description"), F.min("p_retailprice").alias("retail"))
        )
        return grouped.withColumns(_item_columns(F.col("i")))

    @cached_property
    def style(self) -> DataFrame:
        return self.catalogue.where(F.col("style").isNotNull()).select(
            F.col("item").alias("customer_style_number"),
            F.col("style").alias("internal_style_color"),
            F.concat(F.lit("Cat "), "subcat").alias("product_category"),
            F.concat(F.lit("S"), F.expr("(i div 12) % 2").cast("string")).alias("size"),
        )

    @cached_property
    def case_pack(self) -> DataFrame:
        """Packs of 0 and NULL occur; every twelfth item is missing."""
        quantity = F.when(F.col("i") % 6 == 0, 0).when(F.col("i") % 6 != 1, (F.col("i") % 6) * 2)
        return self.catalogue.where((F.col("i") % 48) < 44).select(
            F.col("item").alias("item_nbr"),
            F.lit("A").alias("status"),
            F.lit(None).cast("int").alias("vnpk_qty"),
            quantity.cast("int").alias("case_pack_qty"),
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.catalogue.select(
            F.col("item").alias(ITEM),
            F.col("subcat").alias("subcategory"),
            "description",
            F.col("style").alias("style_id"),
            F.lit(None).cast("double").alias("cost"),
            "retail",
            F.lit("A").alias("item_status"),
        )

    @cached_property
    def capacity(self) -> DataFrame:
        return self.catalogue.select("item", (F.col("i") % 9 + 2).cast("int").alias("capacity"))

    @cached_property
    def weather(self) -> DataFrame:
        """A regional outlook per week; the last region has none."""
        by_store = self.events.groupBy("wk", "st").agg(*[F.sum(c).alias(c) for c in MEASURES])
        located = by_store.withColumn(STORE, F.col("st").cast("string")).join(
            self.stores.select(STORE, "region"), STORE
        )
        last_region = self.table("region").agg(F.max("r_name")).scalar()
        first_day = F.make_date(F.floor(F.col("wk") / 100).cast("int"), F.lit(1), F.lit(1))

        def outlook(measure: str, modulus: int) -> Column:
            return (F.sum(measure) % modulus - modulus // 2) / 100.0

        return (
            located.where(F.col("region") != last_region)
            .groupBy(F.upper("region").alias("region"), "wk")
            .agg(
                outlook("qty", 41).alias("tw_pct"),
                outlook("oh", 37).alias("nw_pct"),
                outlook("wh", 31).alias("m1_pct"),
                outlook("tr", 29).alias("m2_pct"),
                outlook("oo", 23).alias("m3_pct"),
            )
            .select(
                "region",
                F.date_add(first_day, (F.col("wk") % 100 - 1) * 7).alias("week_imported"),
                "tw_pct", "nw_pct", "m1_pct", "m2_pct", "m3_pct",
            )
        )

    @cached_property
    def client_forecast(self) -> DataFrame:
        """The client's own outlook: last year's six following weeks, nudged."""
        period = self.period
        ahead = [period.calendar.shift(period.latest, n) for n in range(1, 7)]
        return (
            self.cells.where(F.col("wk").isin([week - 100 for week in ahead]))
            .withColumns(_item_columns(F.col("i")))
            .select(
                F.col("item").alias("f5c_item_nbr"),
                F.col("subcat").alias("subcategory_nbr"),
                (F.col("wk") + 100).cast("int").alias("f5c_calendar_week"),
                F.col("st").cast("string").alias("store_nbr"),
                (F.col("qty") + (F.col("st") + F.col("i")) % 5).alias("final_forecast_each_quantity"),
                F.col("vsi").alias("vendor_stock_id"),
            )
        )

    @cached_property
    def period(self) -> Period:
        return resolve_period(self.weeks.withColumnRenamed("wk", WEEK), self.week_map)
