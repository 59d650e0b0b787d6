"""Every registered query: a Spark callable and, where SQL can say it, its twin.

Queries read the given tables (through the demo fact table) as a whole.  Doubles
are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.catalog import oracle as o
from shelfcast.catalog.oracle import compose, out
from shelfcast.catalog.workspace import Workspace
from shelfcast.config import KPI_PRESETS, PUSH_PRESETS, PushPreset
from shelfcast.functions.labels import TREND_GRADE_CUTS
from shelfcast.functions.numeric import coerce_numeric, integer, money, round_doubles
from shelfcast.operators import calendar as cal
from shelfcast.operators import diagnostics as diag
from shelfcast.operators import facts as fx
from shelfcast.operators import features as feat
from shelfcast.operators import grading as grade
from shelfcast.operators import kpi
from shelfcast.operators import projection as proj
from shelfcast.operators import push as ps
from shelfcast.operators.grouping import share_of_group
from shelfcast.plans import trend_push as trend
from shelfcast.plans import weather_push as weather
from shelfcast.plans.kpi_report import weekly_productivity, weekly_productivity_all
from shelfcast.plans.runner import run_all, run_all_details, run_category
from shelfcast.plans.tables import PushReport
from shelfcast.schemas import CATEGORY_A, FACT_KEY, GENERAL, ITEM, KEY, SOURCE, STORE, STYLE, STYLE_KEY, SUBCATEGORY, UNITS, WEEK
from shelfcast.sources import dimensions as dims
from shelfcast.sources import fact_store, pos_files
from shelfcast.sources.reports import write_push_report, write_report
from shelfcast.streaming.weekly import stream_weekly_updates



def seasons(ws) -> tuple[tuple[int, int], ...]:
    """The last two years of the data."""
    year = ws.period.latest // 100
    return cal.season_ranges(year - 1, year)


ALL = PushPreset("All categories", o.ALL_SUBCATEGORIES, convert_to_case_pack=True)
ALL_STYLE = PushPreset(
    "All categories by style", o.ALL_SUBCATEGORIES, source=CATEGORY_A, use_client_forecast=True,
    client_forecast_weight=0.8, push_strategy="style_rop", hysteresis_weeks=0.25,
)
ALL_FORECAST = replace(ALL_STYLE, push_strategy="wos")
ALL_ITEM = replace(ALL, use_style_projection=False, convert_to_case_pack=False)
ALL_WEATHER = PushPreset("All categories by weather", o.ALL_SUBCATEGORIES, method="weather", use_style_projection=False)
ALL_SHELF = replace(ALL_WEATHER, apply_shelf_fill=True)
REGION_SHELF = replace(PUSH_PRESETS["category_d"], apply_shelf_fill=True, shelf_fill_region="AMERICA")


@dataclass(frozen=True)
class Query:
    run: Callable[[Workspace], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None):
    def register(function: Callable[[Workspace], DataFrame]):
        QUERIES[name] = Query(function, sql)
        return function

    return register


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(entry: Query):
        return lambda spark, folder: round_doubles(entry.run(Workspace.of(spark, folder)))

    return {name: bind(entry) for name, entry in QUERIES.items()}


def sql_twins() -> dict[str, str]:
    return {name: entry.sql for name, entry in QUERIES.items() if entry.sql}


# --- facts, slices, joins ---------------------------------------------------

FACT_COLUMNS = [
    WEEK, "subcategory_description", SUBCATEGORY, STORE, ITEM, *[c for c in fact_store.POS_FACT.fieldNames() if "quantity" in c],
    "pos_sales_this_year", "pos_sales_last_year", "traited_store_count_this_year", "traited_store_count_last_year",
    "valid_store_count_this_year", "vendor_stock_id", "color_description", "trait_description", SOURCE,
]
KEYS = ("f5c_calendar_week", "store_number", "f5c_item_number")


@query("pos_all_union", compose(f"SELECT {out(*FACT_COLUMNS)} FROM pos"))
def _(ws):
    facts = ws.facts
    both = fx.pos_all(facts.where(F.col(SOURCE) == GENERAL), facts.where(F.col(SOURCE) == CATEGORY_A))
    return both.select(FACT_COLUMNS)


@query("category_filter", compose(f"SELECT {out(*KEYS, UNITS)} FROM pos WHERE subcategory_number IN ('1001','1002')"))
def _(ws):
    return fx.filter_category(ws.facts, (1001, 1002)).select(*FACT_KEY, UNITS)


@query("week_filter", compose(f"SELECT {out(*KEYS, UNITS)} FROM pos, per WHERE {o.TY13}"))
def _(ws):
    return fx.filter_weeks(ws.facts, ws.period.ty_start, ws.period.latest).select(*FACT_KEY, UNITS)


@query(
    "store_slice",
    compose("SELECT f5c_calendar_week, CAST(sum(pos_quantity_this_year) AS BIGINT) AS units FROM pos WHERE store_number = '1' GROUP BY 1"),
)
def _(ws):
    return fx.filter_store(ws.facts, 1).groupBy(WEEK).agg(F.sum(UNITS).alias("units"))


@query(
    "coerce_numeric",
    compose(
        f"SELECT {out(*KEYS)}, coalesce(pos_quantity_last_year, 0) AS pos_quantity_last_year, "
        "coalesce(CAST(max_shelf_quantity_this_year AS DOUBLE), 0.0) AS shelf_text, 0.0::DOUBLE AS pos_sales_this_year FROM pos"
    ),
)
def _(ws):
    rows = ws.facts.select(
        *FACT_KEY, "pos_quantity_last_year", F.col("max_shelf_quantity_this_year").cast("string").alias("shelf_text"),
        "pos_sales_this_year",
    )
    return coerce_numeric(rows, ["pos_quantity_last_year", "shelf_text", "pos_sales_this_year"])


@query(
    "money",
    compose(f"SELECT {out(*KEYS, '~sales_ty=' + o.cents('pos_sales_this_year'), '~sales_ly=' + o.cents('pos_sales_last_year'))} FROM pos"),
)
def _(ws):
    return ws.facts.select(
        *FACT_KEY,
        money(F.col("pos_sales_this_year")).cast("double").alias("sales_ty"),
        money(F.col("pos_sales_last_year")).cast("double").alias("sales_ly"),
    )


@query(
    "style_key",
    compose(f"""SELECT {out(*KEYS, 'style=coalesce(internal_style_color, vendor_stock_id)')}
    FROM pos LEFT JOIN style ON f5c_item_number = customer_style_number"""),
)
def _(ws):
    return fx.style_key(fx.with_style_left(ws.facts, ws.tables.style)).select(*FACT_KEY, STYLE)


@query("lower_region", compose("SELECT store_number, state, lower(region) AS region FROM stores"))
def _(ws):
    return fx.lower_region(ws.tables.stores).select(STORE, "state", "region")


@query(
    "with_store",
    compose(f"""SELECT f5c_calendar_week, pos.store_number, f5c_item_number, region, state, zip_code, merch_zone_number
    FROM pos LEFT JOIN stores ON pos.store_number = stores.store_number"""),
)
def _(ws):
    return fx.with_store(ws.facts, ws.tables.stores).select(*FACT_KEY, "region", "state", "zip_code", "merch_zone_number")


@query(
    "with_style_left",
    compose(f"SELECT {out(*KEYS, 'internal_style_color')} FROM pos LEFT JOIN style ON f5c_item_number = customer_style_number"),
)
def _(ws):
    return fx.with_style_left(ws.facts, ws.tables.style).select(*FACT_KEY, "internal_style_color")


@query(
    "with_style_inner",
    compose(f"""SELECT {out(*KEYS, 'internal_style_color', 'product_category', 'size')}
    FROM pos JOIN style ON f5c_item_number = customer_style_number"""),
)
def _(ws):
    return fx.with_style_inner(ws.facts, ws.tables.style).select(*FACT_KEY, "internal_style_color", "product_category", "size")


@query(
    "with_case_pack",
    compose(f"""SELECT {out(*KEYS)}, CASE WHEN coalesce(case_pack_qty,0) = 0 THEN 1 ELSE case_pack_qty END AS case_pack_qty
    FROM pos LEFT JOIN case_pack ON f5c_item_number = item_nbr"""),
)
def _(ws):
    return fx.with_case_pack(ws.facts, ws.tables.case_pack).select(*FACT_KEY, "case_pack_qty")


@query(
    "latest_snapshot",
    compose(f"""SELECT {out('region', 'week_imported', '~tw_pct', '~nw_pct')} FROM weather
    WHERE week_imported = (SELECT max(week_imported) FROM weather)"""),
)
def _(ws):
    return fx.latest_snapshot(ws.tables.weather).select("region", "week_imported", "tw_pct", "nw_pct")


@query(
    "with_weather",
    compose(f"""SELECT f5c_calendar_week, pos.store_number, f5c_item_number, lower(d.region) AS region,
      {out('~tw_pct', '~nw_pct')} FROM pos LEFT JOIN stores d ON pos.store_number = d.store_number
      LEFT JOIN (SELECT lower(region) AS lr, tw_pct, nw_pct FROM weather
                 WHERE week_imported = (SELECT max(week_imported) FROM weather)) x ON lower(d.region) = lr"""),
)
def _(ws):
    placed = fx.lower_region(fx.with_store(ws.facts, ws.tables.stores))
    return fx.with_weather(placed, ws.tables.weather).select(*FACT_KEY, "region", "tw_pct", "nw_pct")


@query(
    "order_report",
    compose("SELECT ty_week, ly_week FROM weekmap ORDER BY ly_week DESC, ty_week"),
)
def _(ws):
    return fx.order_report(ws.tables.week_map, ["ty_week"], ["ly_week"]).select("ty_week", "ly_week")


# --- calendar ---------------------------------------------------------------

WEEKS = "SELECT DISTINCT f5c_calendar_week FROM pos"


@query(
    "assign_season",
    compose(f"""SELECT f5c_calendar_week, CASE WHEN f5c_calendar_week%100 <= 26 THEN 'Spring ' ELSE 'Fall ' END
    || CAST(f5c_calendar_week//100 AS VARCHAR) AS season FROM ({WEEKS})"""),
)
def _(ws):
    return cal.assign_season(ws.facts.select(WEEK).distinct())


@query(
    "week_to_ly",
    compose(f"""SELECT f5c_calendar_week, coalesce(ly_week, f5c_calendar_week-100) AS ly_week
    FROM ({WEEKS}) LEFT JOIN weekmap ON ty_week = f5c_calendar_week"""),
)
def _(ws):
    return cal.week_to_ly(ws.facts.select(WEEK).distinct(), ws.tables.week_map)


@query("latest_week", compose("SELECT max(f5c_calendar_week) AS latest_week FROM pos"))
def _(ws):
    return cal.latest_week(ws.facts)


def _week_index(week: str) -> str:
    return f"({week}//100*52 + {week}%100 - 1)"


@query(
    "calendar_dimension",
    compose(f"""SELECT CAST(y*100 + s AS INTEGER) AS week, CAST({_week_index('(y*100 + s)')} AS INTEGER) AS week_idx
      FROM (SELECT min(w)//100 - 2 AS a, max(w)//100 + 2 AS b FROM (SELECT f5c_calendar_week AS w FROM pos UNION SELECT ty_week FROM weekmap UNION SELECT ly_week FROM weekmap)),
        range(1, 53) t(s), range(1900, 2200) u(y) WHERE y BETWEEN a AND b"""),
)
def _(ws):
    return cal.calendar_dimension(ws.facts, ws.tables.week_map)


SPANS_SQL = f"""SELECT *, coalesce((SELECT ly_week FROM weekmap WHERE ty_week = target_week), target_week - 100) AS ly_now,
    coalesce((SELECT ly_week FROM weekmap WHERE ty_week = {o.shift('target_week', -12)}), {o.shift('target_week', -12)} - 100) AS ly_first
  FROM (SELECT DISTINCT f5c_calendar_week AS target_week FROM pos)"""
WINDOWS_SQL = f"""SELECT target_week, "window", CAST(p AS INTEGER) AS position, CAST({o.shift('w', 'p')} AS INTEGER) AS week FROM (
    SELECT target_week, "window", CASE WHEN "window" LIKE 'ly%' THEN ly_now ELSE target_week END AS w, unnest(range(a, b + 1)) AS p FROM (
      SELECT target_week, ly_now, "window", a, b FROM spans, (VALUES ('ty13', -12, 0), ('ty52', -51, 0), ('check', -25, 0), ('recent', -4, -1), ('ly_window', -3, 2), ('ly_pair', 0, 1)) v("window", a, b)
      UNION ALL SELECT target_week, ly_now, 'ly13', {_week_index('ly_first')} - {_week_index('ly_now')}, 0 FROM spans))"""


@query("week_windows_all_targets", compose("SELECT * FROM windows_of", {"spans": SPANS_SQL, "windows_of": WINDOWS_SQL}))
def _(ws):
    """Every window of every week of the facts as a target, in one plan."""
    dimension = cal.calendar_dimension(ws.facts, ws.tables.week_map)
    return cal.target_windows(ws.facts.select(F.col(WEEK).alias("target_week")), dimension, ws.tables.week_map)


@query(
    "rolling_units_all_targets",
    compose("""SELECT target_week, "window", subcategory_number, CAST(sum(u) AS BIGINT) AS units, count(*) AS weeks
      FROM windows_of JOIN (SELECT f5c_calendar_week, subcategory_number, sum(pos_quantity_this_year) AS u FROM pos GROUP BY ALL) ON f5c_calendar_week = week GROUP BY ALL""",
      {"spans": SPANS_SQL, "windows_of": WINDOWS_SQL}),
)
def _(ws):
    dimension = cal.calendar_dimension(ws.facts, ws.tables.week_map)
    windows = cal.target_windows(ws.facts.select(F.col(WEEK).alias("target_week")), dimension, ws.tables.week_map)
    return cal.windowed_units(ws.facts, windows, [SUBCATEGORY], UNITS)


@query(
    "week_windows",
    compose(f"""SELECT f5c_calendar_week, CAST(f5c_calendar_week//100*52 + f5c_calendar_week%100 - 1 AS INTEGER) AS week_idx,
      {o.TY13} AS in_ty13, f5c_calendar_week BETWEEN ty52 AND latest AS in_ty52, {o.LY13} AS in_ly13,
      f5c_calendar_week BETWEEN chk AND latest AS in_check, f5c_calendar_week IN (v0,v1,v2,ly_cur,ly_next,v5) AS in_ly_window,
      f5c_calendar_week IN (ly_cur, ly_next) AS in_ly_pair,
      CASE f5c_calendar_week WHEN w1 THEN 1 WHEN w2 THEN 2 WHEN w3 THEN 3 WHEN w4 THEN 4 END AS weeks_ago FROM ({WEEKS}), per"""),
)
def _(ws):
    p, week = ws.period, F.col(WEEK)
    ago = F.when(week == p.recent[0], 1)
    for n, w in enumerate(p.recent[1:], start=2):
        ago = ago.when(week == w, n)
    return ws.facts.select(WEEK).distinct().select(
        WEEK,
        cal.RetailCalendar().index_column(week).alias("week_idx"),
        week.between(p.ty_start, p.latest).alias("in_ty13"),
        week.between(p.ty52_start, p.latest).alias("in_ty52"),
        week.between(p.ly_start, p.ly_current).alias("in_ly13"),
        week.between(p.check_start, p.latest).alias("in_check"),
        week.isin(*p.ly_window).alias("in_ly_window"),
        week.isin(p.ly_current, p.ly_next).alias("in_ly_pair"),
        ago.alias("weeks_ago"),
    )


@query(
    "week_map_template",
    compose(f"""SELECT ty_week, ty_week-100 AS ly_week, '' AS notes FROM
      (SELECT {o.shift('first', 0).replace('(0)', 'n')} AS ty_week
       FROM (SELECT min(f5c_calendar_week) AS first, count(DISTINCT f5c_calendar_week) AS c FROM pos),
            LATERAL (SELECT unnest(range(c)) AS n))"""),
)
def _(ws):
    return cal.week_map_template(
        ws.facts.agg(F.min(WEEK).alias("start_week"), F.countDistinct(WEEK).alias("num_weeks"))
    )


@query(
    "week_map_upsert",
    compose(f"""SELECT ty_week, ly_week, NULL::VARCHAR AS notes FROM weekmap WHERE ty_week//100 <> (SELECT latest//100 FROM per)
      UNION ALL SELECT f5c_calendar_week, f5c_calendar_week-100, 'aligned' FROM ({WEEKS}) WHERE f5c_calendar_week//100 = (SELECT latest//100 FROM per)"""),
)
def _(ws):
    delta = ws.facts.select(WEEK).distinct().where(F.floor(F.col(WEEK) / 100) == ws.period.latest // 100).select(
        F.col(WEEK).alias("ty_week"), (F.col(WEEK) - 100).alias("ly_week"), F.lit("aligned").alias("notes")
    )
    return cal.upsert_week_mapping(ws.tables.week_map, delta)


@query("list_week_mapping", compose("SELECT ty_week, ly_week FROM weekmap ORDER BY ty_week"))
def _(ws):
    return cal.list_week_mapping(ws.tables.week_map).select("ty_week", "ly_week")


# --- weekly KPI extract -----------------------------------------------------


def _kpi_args(preset):
    return preset.subcategories, preset.source, preset.detail_columns, preset.has_style


def _kpi_rows(ws, preset):
    rows = fx.filter_category(ws.facts.where(F.col(SOURCE) == preset.source), preset.subcategories)
    return kpi.weekly_item_totals(rows, preset, ws.tables.style)


def _kpi(ws, key: str) -> DataFrame:
    return weekly_productivity(ws.facts, ws.tables.style, KPI_PRESETS[key], seasons(ws))


def _register_kpi(key: str, name: str):
    preset = KPI_PRESETS[key]
    sql = compose(f"SELECT {o.kpi_columns(preset.detail_columns, preset.has_style)} FROM kpi", o.kpi_stages(*_kpi_args(preset)))
    query(name, sql)(lambda ws: _kpi(ws, key))


_register_kpi("category_a", "weekly_productivity")
for _key in ("category_b", "category_c", "category_d"):
    _register_kpi(_key, f"weekly_productivity_{_key}")


@query(
    "weekly_productivity_all",
    " UNION ALL ".join(
        f"SELECT * FROM ({compose(f"SELECT '{key}' AS category, count(*) AS row_count, CAST(sum(pos_qty_ty) AS BIGINT) AS pos_qty_ty FROM kpi", o.kpi_stages(*_kpi_args(preset)))})"
        for key, preset in KPI_PRESETS.items()
    ),
)
def _(ws):
    reports = weekly_productivity_all(ws.facts, ws.tables.style, seasons(ws))
    totals = [frame.agg(F.count(F.lit(1)).alias("row_count"), F.sum("pos_qty_ty").alias("pos_qty_ty")).withColumn("category", F.lit(key)) for key, frame in reports.items()]
    return reduce(DataFrame.unionByName, totals)


KPI_A, KPI_D = KPI_PRESETS["category_a"], KPI_PRESETS["category_d"]
A_STAGES = o.kpi_stages(*_kpi_args(KPI_A))
D_STAGES = o.kpi_stages(*_kpi_args(KPI_D))


@query(
    "weekly_item_totals",
    compose(f"SELECT {out(*kpi.category_columns(KPI_A), *o.KPI_TOTALS, '~sales_ty', '~sales_ly')} FROM kpi_totals", A_STAGES),
)
def _(ws):
    totals = _kpi_rows(ws, KPI_A)
    return totals.withColumns({c: F.col(c).cast("double") for c in kpi.SALES})


@query(
    "concat_periods",
    compose(
        "SELECT f5c_calendar_week, f5c_item_number, pos_qty_ty FROM kpi_totals WHERE " + o.LAST_TWO_YEARS,
        D_STAGES,
    ),
)
def _(ws):
    parts = [kpi.category_query(ws.facts, KPI_D, None, low, high) for low, high in seasons(ws)]
    return fx.stack_periods(parts).select(WEEK, ITEM, "pos_qty_ty")


RUNNING = ["season_pos_qty_cumulative_ty", "season_sales_cumulative_ty", "weeks_in_season_so_far", "season_store_weeks_cumulative_ty"]


@query(
    "season_to_date",
    compose(
        f"SELECT {out(WEEK, *kpi.grouping_columns(kpi.category_columns(KPI_A), KPI_A), 'season', RUNNING[0], '~' + RUNNING[1], *RUNNING[2:])} FROM kpi",
        A_STAGES,
    ),
)
def _(ws):
    totals = cal.assign_season(kpi.coerce_totals(cal.in_seasons(_kpi_rows(ws, KPI_A), seasons(ws))))
    keys = kpi.grouping_columns(totals.columns, KPI_A)
    running = kpi.season_to_date(totals, keys).withColumn(RUNNING[1], F.col(RUNNING[1]).cast("double"))
    return running.select(WEEK, *keys, "season", *RUNNING)


@query("weeks_in_season", compose("SELECT f5c_calendar_week, f5c_item_number, season, weeks_in_season_so_far FROM kpi", D_STAGES))
def _(ws):
    return _kpi(ws, "category_d").select(WEEK, ITEM, "season", "weeks_in_season_so_far")


@query(
    "productivity_summary",
    compose(
        f"""SELECT count(*) AS total_rows, min(f5c_calendar_week) AS min_week, max(f5c_calendar_week) AS max_week,
        count(DISTINCT f5c_calendar_week) AS unique_weeks, min(ty_store_ct) AS min_store_ct, max(ty_store_ct) AS max_store_ct,
        {out('~avg_store_ct=avg(ty_store_ct)', '~total_sales_ty=sum(sales_ty)', '~total_sales_ly=sum(sales_ly)')},
        count(*) FILTER (WHERE sales_ty > 0) AS rows_with_sales,
        {out('~avg_productivity_ty=avg(weekly_productivity_ty)', '~max_productivity_ty=max(weekly_productivity_ty)',
             '~avg_oh_per_store=avg(avg_oh_per_store_ty)', '~avg_weeks_of_supply=avg(weeks_of_supply_ty)')} FROM kpi""",
        A_STAGES,
    ),
)
def _(ws):
    return diag.productivity_summary(_kpi(ws, "category_a"))


@query("season_row_counts", compose("SELECT season, count(*) AS row_count FROM kpi GROUP BY season", A_STAGES))
def _(ws):
    return diag.rows_per(_kpi(ws, "category_a"), "season")


@query(
    "product_category_row_counts",
    compose("SELECT product_category, count(*) AS row_count FROM kpi GROUP BY product_category", A_STAGES),
)
def _(ws):
    return diag.rows_per(_kpi(ws, "category_a"), "product_category")


@query(
    "top_styles",
    compose(
        "SELECT internal_style_color, CAST(sum(sales_ty) AS DOUBLE) AS total_sales FROM kpi GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
        A_STAGES,
    ),
)
def _(ws):
    totals = _kpi_rows(ws, KPI_A).where(F.col(WEEK).between(seasons(ws)[0][0], seasons(ws)[-1][1]))
    return diag.top_n(totals, "internal_style_color", "sales_ty", 5, "total_sales").withColumn(
        "total_sales", F.col("total_sales").cast("double")
    )


@query(
    "top_items",
    compose("SELECT f5c_item_number, CAST(sum(sales_ty) AS DOUBLE) AS total_sales FROM kpi GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5", D_STAGES),
)
def _(ws):
    totals = _kpi_rows(ws, KPI_D).where(F.col(WEEK).between(seasons(ws)[0][0], seasons(ws)[-1][1]))
    return diag.top_n(totals, ITEM, "sales_ty", 5, "total_sales").withColumn("total_sales", F.col("total_sales").cast("double"))


# --- features ---------------------------------------------------------------

BASE = o.base_stages(o.ALL_SUBCATEGORIES)
K2 = ("store_number", "f5c_item_number")


@query(
    "pos_13_52_totals",
    compose(f"SELECT {out(*K2, 'ty_13wk_pos_total', 'ty_52wk_pos_total')} FROM f_52 LEFT JOIN f_ty USING ({o.K})", BASE),
)
def _(ws):
    return feat.pos_total(ws.facts, ws.period)


@query("pos_avg", compose(f"SELECT {out(*K2, '~ty_13wk_avg', '~ly_13wk_avg')} FROM f_ty FULL JOIN f_ly USING ({o.K})", BASE))
def _(ws):
    return feat.pos_avg(ws.facts, ws.period)


@query("last_week_pos", compose(f"SELECT {out(*K2, 'lw_pos=pos_m1')} FROM f_m1", BASE))
def _(ws):
    return feat.last_week_pos(ws.facts, ws.period)


@query(
    "pos_last4_pivot",
    compose(
        f"""SELECT {o.K}, {', '.join(f'coalesce(pos_m{n},0) AS pos_m{n}' for n in (1, 2, 3, 4))} FROM f_m1
        FULL JOIN f_m2 USING ({o.K}) FULL JOIN f_m3 USING ({o.K}) FULL JOIN f_m4 USING ({o.K})""",
        BASE,
    ),
)
def _(ws):
    return feat.pos_last4_pivot(ws.facts, ws.period)


@query(
    "ly_pair_pivot",
    compose(
        f"""SELECT {out(*K2, '~ly_current_week=coalesce(ly_current_week,0)', '~ly_next_week=coalesce(ly_next_week,0)')}
        FROM f_lyc FULL JOIN f_lyn USING ({o.K})""",
        BASE,
    ),
)
def _(ws):
    return feat.ly_pair_pivot(ws.facts, ws.period)


WEATHER_ALL = o.weather_stages(ALL_WEATHER)


@query(
    "ly_window_pivot",
    compose(
        f"""SELECT {out(*K2, *[f'~ly_pos_week_{w}=coalesce(o{n},0)' for n, w in enumerate(o.OFFSETS)])} FROM lyw0
        {' '.join(f'FULL JOIN lyw{n} USING ({o.K})' for n in range(1, 6))}""",
        WEATHER_ALL,
    ),
)
def _(ws):
    return feat.ly_window_pivot(ws.facts, ws.period)


FEATURES = ["wtd_pos", "lw_pos", "pos_m1", "pos_m2", "pos_m3", "pos_m4", "ty_13wk_pos_total", "ty_52wk_pos_total"]


@query(
    "feature_frame",
    compose(f"SELECT {out(*K2, *FEATURES, '~ty_13wk_avg', '~ly_13wk_avg', *o.STOCK, 'max_shelf_quantity_this_year')} FROM feat", BASE),
)
def _(ws):
    rows = feat.feature_frame(ws.facts, o.ALL_SUBCATEGORIES, ws.period)
    return rows.select(*KEY, *FEATURES, "ty_13wk_avg", "ly_13wk_avg", *o.STOCK, "max_shelf_quantity_this_year")


# --- projection -------------------------------------------------------------

SK2 = ("store_number", "style=sty")


def _styled(ws) -> DataFrame:
    return trend.styled_rows(ws.facts, ws.tables.style, o.ALL_SUBCATEGORIES, ws.period)


def _styles(ws) -> DataFrame:
    return proj.style_growth(feat.style_weekly_avg(_styled(ws), ws.period))


def _mix(ws) -> DataFrame:
    return proj.weighted_mix(_styled(ws), ws.period)


@query(
    "style_weekly_avg",
    compose(f"SELECT {out(*SK2, '~style_ty_13wk_avg=ty_avg', '~style_ly_13wk_avg=ly_avg')} FROM sty_avg", BASE),
)
def _(ws):
    return feat.style_weekly_avg(_styled(ws), ws.period)


@query(
    "style_growth",
    compose(f"SELECT {out(*SK2, '~style_growth_rate=g', 'style_performance', '~style_projected_weekly_sales=sty_proj')} FROM sty_growth", BASE),
)
def _(ws):
    return _styles(ws).select(*STYLE_KEY, "style_growth_rate", "style_performance", "style_projected_weekly_sales")


@query("style_performance", compose(f"SELECT {out(*SK2, 'style_performance')} FROM sty_growth", BASE))
def _(ws):
    return _styles(ws).select(*STYLE_KEY, "style_performance")


@query(
    "performance_distribution",
    compose(
        f"""SELECT style_performance, count(*) AS row_count, {out('~share=count(*)/CAST((SELECT count(*) FROM sty_growth) AS DOUBLE)')}
        FROM sty_growth GROUP BY style_performance""",
        BASE,
    ),
)
def _(ws):
    return diag.performance_distribution(_styles(ws))


for _name, _value, _short in (
    ("size_mix_ty", "size_sales_ty_13wk", "ty"), ("size_mix_ly", "size_sales_ly_13wk", "ly"), ("size_mix_inventory", "total_pipeline", "in"),
):

    def _size_mix(ws, value=_value):
        signals = proj.size_signals(_styled(ws), ws.period)
        return share_of_group(signals, STYLE_KEY, value, "style_total", "size_mix_pct").select(*STYLE_KEY, ITEM, value, "size_mix_pct")

    query(
        _name,
        compose(f"SELECT {out(*SK2, 'f5c_item_number', f'{_value}=s_{_short}', f'~size_mix_pct=m_{_short}')} FROM mix", BASE),
    )(_size_mix)


@query(
    "merge_mixes",
    compose(
        f"""SELECT {out(*SK2, 'f5c_item_number', 'size_sales_ty_13wk=s_ty', 'size_sales_ly_13wk=s_ly', 'total_pipeline=s_in',
        '~ty_size_mix_pct=m_ty', '~ly_size_mix_pct=m_ly', '~pipeline_size_mix_pct=m_in', '~style_growth_rate=g')}
        FROM mix LEFT JOIN sty_growth USING ({o.SK})""",
        BASE,
    ),
)
def _(ws):
    return _mix(ws).select(
        *STYLE_KEY, ITEM, "size_sales_ty_13wk", "size_sales_ly_13wk", "total_pipeline",
        "ty_size_mix_pct", "ly_size_mix_pct", "pipeline_size_mix_pct", "style_growth_rate",
    )


@query(
    "adaptive_weights",
    compose(f"SELECT {out(*SK2, 'f5c_item_number', '~weight_ty', '~weight_ly', '~weight_pipeline')} FROM wts", BASE),
)
def _(ws):
    return _mix(ws).select(*STYLE_KEY, ITEM, *proj.WEIGHT_COLUMNS)


@query(
    "blend_weight_summary",
    compose(f"SELECT {out(*[f'~avg_{c}=avg({c})' for c in proj.WEIGHT_COLUMNS])} FROM wts", BASE),
)
def _(ws):
    return diag.blend_weight_summary(_mix(ws))


@query("blended_size_mix", compose(f"SELECT {out(*SK2, 'f5c_item_number', '~blended_size_mix_pct=blended')} FROM bl", BASE))
def _(ws):
    return proj.blended_size_mix(_mix(ws)).select(*STYLE_KEY, ITEM, "blended_size_mix_pct")


@query(
    "style_projection",
    compose(
        f"SELECT {out(*SK2, 'f5c_item_number', '~style_growth_rate=g', '~projected_weekly_sales=proj', '~baseline_weekly_sales=base')} FROM sproj",
        BASE,
    ),
)
def _(ws):
    return proj.style_projection(_styled(ws), ws.period).select(
        *STYLE_KEY, ITEM, "style_growth_rate", "projected_weekly_sales", "baseline_weekly_sales"
    )


ITEM_STAGES = o.trend_stages(ALL_ITEM)


@query(
    "item_projection",
    compose(
        f"""SELECT {out(*K2, '~ly_current_week', '~ly_next_week', '~growth_rate', '~tw_projected', '~nw_projected',
        '~projected_weekly_sales=engine', '~baseline_weekly_sales')} FROM prj""",
        ITEM_STAGES,
    ),
)
def _(ws):
    rows = proj.item_projection(feat.feature_frame(ws.facts, o.ALL_SUBCATEGORIES, ws.period), ws.facts, ws.period)
    return rows.select(
        *KEY, "ly_current_week", "ly_next_week", "growth_rate", "tw_projected", "nw_projected",
        "projected_weekly_sales", "baseline_weekly_sales",
    )


@query("client_forecast_avg", compose(f"SELECT {out(*K2, '~avg_forecast_each')} FROM cf_avg", BASE))
def _(ws):
    return proj.client_forecast_avg(ws.tables.client_forecast, o.ALL_SUBCATEGORIES)


FORECAST_STAGES = o.trend_stages(ALL_FORECAST)


@query(
    "blend_forecast",
    compose(
        f"""SELECT {out(*K2, '~engine_projected_weekly_sales', '~avg_forecast_each', '~projected_weekly_sales', 'projection_source')} FROM fc""",
        FORECAST_STAGES,
    ),
)
def _(ws):
    return trend.trend_scored(ws.tables, ALL_FORECAST, ws.period).select(
        *KEY, "engine_projected_weekly_sales", "avg_forecast_each", "projected_weekly_sales", "projection_source"
    )


@query(
    "forecast_coverage",
    compose(
        f"""SELECT count(avg_forecast_each) AS rows_with_forecast,
        {out('~forecast_share=count(avg_forecast_each)/CAST(count(*) AS DOUBLE)')} FROM fc""",
        FORECAST_STAGES,
    ),
)
def _(ws):
    return diag.forecast_coverage(trend.trend_scored(ws.tables, ALL_FORECAST, ws.period))


@query(
    "weather_projection",
    compose(
        f"""SELECT {out(*K2, '~tw_pct=tw', '~nw_pct=nw', '~weather_adjustment=wadj', '~tw_projected', '~nw_projected',
        '~projected_weekly_sales', '~baseline_weekly_sales')} FROM wx2""",
        WEATHER_ALL,
    ),
)
def _(ws):
    return weather.weather_scored(ws.tables, ALL_WEATHER, ws.period).select(
        *KEY, "tw_pct", "nw_pct", "weather_adjustment", "tw_projected", "nw_projected", "projected_weekly_sales", "baseline_weekly_sales"
    )


@query(
    "projection_diagnostics",
    compose(
        f"""SELECT store_number, {out('~projected_weekly', '~actual_13wk_avg', '~expected_weekly', '~gap_units=projected_weekly - expected_weekly')},
        CASE WHEN expected_weekly > 0 THEN {o.r('(projected_weekly - expected_weekly)/expected_weekly*100', 1)} END AS gap_pct
        FROM (SELECT store_number, sum(proj) AS projected_weekly FROM sproj GROUP BY 1) LEFT JOIN
          (SELECT store_number, CAST(coalesce(sum(pos_quantity_this_year) FILTER (WHERE f5c_calendar_week >= ty_start), 0) AS DOUBLE)/13 AS actual_13wk_avg,
                  CAST(sum(pos_quantity_this_year) AS DOUBLE)/26 AS expected_weekly
           FROM cat, per WHERE f5c_calendar_week BETWEEN chk AND latest GROUP BY 1) USING (store_number)""",
        BASE,
    ),
)
def _(ws):
    return diag.projection_diagnostics(proj.style_projection(_styled(ws), ws.period), ws.facts, ws.period)


@query(
    "style_sigma",
    compose(f"SELECT {out(*SK2, '~mu_weekly=mu', '~sigma_weekly=sigma')} FROM gat0", o.trend_stages(ALL_STYLE)),
)
def _(ws):
    return _caps(ws).select(*STYLE_KEY, "mu_weekly", "sigma_weekly")


# --- cover and push ---------------------------------------------------------


def _scored(ws, preset=ALL) -> DataFrame:
    return trend.trend_scored(ws.tables, preset, ws.period)


def _caps(ws, preset=ALL_STYLE) -> DataFrame:
    return ps.style_caps(_scored(ws, preset), feat.style_spread(_styled(ws), ws.period), preset)


TREND_ALL = o.trend_stages(ALL)
STYLE_ALL = o.trend_stages(ALL_STYLE)


@query("sell_through", compose(f"SELECT {out(*K2, 'ship_qty', '~sell_through_pct', 'sell_through_flag')} FROM cur", BASE))
def _(ws):
    return trend.trend_inputs(ws.tables, ALL, ws.period).select(*KEY, "ship_qty", "sell_through_pct", "sell_through_flag")


@query(
    "wos_metrics",
    compose(f"SELECT {out(*K2, 'total_pipeline', 'total_pipeline_ly', '~current_wos', '~pipeline_wos', '~ly_wos')} FROM scored", TREND_ALL),
)
def _(ws):
    return _scored(ws).select(*KEY, "total_pipeline", "total_pipeline_ly", "current_wos", "pipeline_wos", "ly_wos")


@query("wos_weather", compose(f"SELECT {out(*K2, '~current_wos=cw', '~ly_wos=lw')} FROM wscored", WEATHER_ALL))
def _(ws):
    return weather.weather_scored(ws.tables, ALL_WEATHER, ws.period).select(*KEY, "current_wos", "ly_wos")


PUSH = ["target_inventory", "shortfall_weeks", "push_units", "projected_wos_after_push"]


@query(
    "push_wos",
    compose(f"SELECT {out(*K2, '~target_inventory', '~shortfall_weeks', '~push_units=push', '~projected_wos_after_push')} FROM pushed", TREND_ALL),
)
def _(ws):
    return trend.trend_pushed(ws.tables, ALL, ws.period).select(*KEY, *PUSH)


@query(
    "style_target_gap",
    compose(
        f"SELECT {out(*SK2, '~style_demand=sd', '~style_target_inventory=target', 'style_total_pipeline=sp', '~style_gap')} FROM tgt",
        STYLE_ALL,
    ),
)
def _(ws):
    gaps = ps.style_target_gap(_scored(ws, ALL_STYLE), ALL_STYLE.style_target_wos)
    return gaps.select(*STYLE_KEY, "style_demand", "style_target_inventory", "style_total_pipeline", "style_gap")


@query(
    "rop_gate",
    compose(f"SELECT {out(*SK2, '~rop_s=rop', '~ramp_units=ramp', '~style_pipeline_eff=eff', '~gate', '~style_cap=gcap')} FROM gat", STYLE_ALL),
)
def _(ws):
    return _caps(ws).select(*STYLE_KEY, "rop_s", "ramp_units", "style_pipeline_eff", "gate", "style_cap")


@query(
    "size_targets_capacity",
    compose(f"SELECT {out(*K2, '~size_target_inventory', '~raw_push', 'capacity_gap=room', '~candidate_push=cand', '~shortfall_weeks')} FROM sz4", STYLE_ALL),
)
def _(ws):
    sized = ps.size_candidates(_scored(ws, ALL_STYLE), _caps(ws), ALL_STYLE)
    return sized.select(*KEY, "size_target_inventory", "raw_push", "capacity_gap", "candidate_push", "shortfall_weeks")


@query("cap_in_group", compose(f"SELECT {out(*K2, '~push_units=p1')} FROM sz5", STYLE_ALL))
def _(ws):
    sized = ps.size_candidates(_scored(ws, ALL_STYLE), _caps(ws), ALL_STYLE)
    return ps.cap_in_group(sized, STYLE_KEY, "style_cap").select(*KEY, "push_units")


@query(
    "style_cap_qa",
    compose(
        f"""SELECT {out(*SK2, '~raw_sum', '~after_cap_sum', '~style_cap')} FROM (SELECT {o.SK},
          coalesce(sum(greatest(0.0, size_target_inventory - total_pipeline)),0.0) AS raw_sum,
          coalesce(sum(least(greatest(0.0, size_target_inventory - total_pipeline), room)),0.0) AS after_cap_sum,
          max(gcap) AS style_cap FROM sz1 WHERE sty IS NOT NULL GROUP BY {o.SK})""",
        STYLE_ALL,
    ),
)
def _(ws):
    return ps.style_cap_qa(ps.size_candidates(_scored(ws, ALL_STYLE), _caps(ws), ALL_STYLE))


@query(
    "style_cap_qa_totals",
    compose(
        f"""SELECT count(*) AS styles, {out('~raw_sum=sum(CAST(raw_sum AS DECIMAL(20,6)))', '~after_cap_sum=sum(CAST(after_cap_sum AS DECIMAL(20,6)))', '~style_cap=sum(CAST(gc AS DECIMAL(20,6)))')}
        FROM (SELECT {o.SK}, coalesce(sum(greatest(0.0, size_target_inventory - total_pipeline)),0.0) AS raw_sum,
          coalesce(sum(least(greatest(0.0, size_target_inventory - total_pipeline), room)),0.0) AS after_cap_sum,
          max(gcap) AS gc FROM sz1 WHERE sty IS NOT NULL GROUP BY {o.SK})""",
        STYLE_ALL,
    ),
)
def _(ws):
    return ps.style_cap_totals(ps.style_cap_qa(ps.size_candidates(_scored(ws, ALL_STYLE), _caps(ws), ALL_STYLE)))


STYLE_PUSH = ["size_target_inventory", "shortfall_weeks", "push_units", "projected_wos_after_push"]
STYLE_PUSH_SQL = out(*K2, "~size_target_inventory", "~shortfall_weeks", "~push_units=push", "~projected_wos_after_push")


@query("push_style_rop", compose(f"SELECT {STYLE_PUSH_SQL} FROM pushed", STYLE_ALL))
def _(ws):
    return trend.trend_pushed(ws.tables, ALL_STYLE, ws.period).select(*KEY, *STYLE_PUSH)


@query("push_style_rop_parity", compose(f"SELECT {STYLE_PUSH_SQL} FROM pushed", o.trend_stages(ALL_STYLE, parity=True)))
def _(ws):
    return trend.trend_pushed(ws.tables, ALL_STYLE, ws.period, parity=True).select(*KEY, *STYLE_PUSH)


@query(
    "push_weather",
    compose(f"SELECT {out(*K2, '~target_inventory', '~push_units=push', '~projected_wos_after_push=after_push')} FROM wpushed", WEATHER_ALL),
)
def _(ws):
    return weather.weather_pushed(ws.tables, ALL_WEATHER, ws.period).select(
        *KEY, "target_inventory", "push_units", "projected_wos_after_push"
    )


@query(
    "shelf_fill",
    compose(f"SELECT {out(*K2, '~push_units=push', '~projected_wos_after_push=after_push')} FROM wpushed", o.weather_stages(ALL_SHELF)),
)
def _(ws):
    return weather.weather_pushed(ws.tables, ALL_SHELF, ws.period).select(*KEY, "push_units", "projected_wos_after_push")


@query(
    "case_packs",
    compose(f"SELECT {out(*K2, 'case_pack_qty', 'push_case_pack=CAST(round_even(push/case_pack_qty, 0) AS BIGINT)')} FROM wpushed", WEATHER_ALL),
)
def _(ws):
    return ps.to_case_packs(weather.weather_pushed(ws.tables, ALL_WEATHER, ws.period)).select(*KEY, "case_pack_qty", "push_case_pack")


@query("push_reason_trend", compose(f"SELECT {out(*K2)}, {o.trend_reason(6.0)} AS push_reason FROM pushed", TREND_ALL))
def _(ws):
    return ps.push_reason_trend(trend.trend_pushed(ws.tables, ALL, ws.period), ALL.target_wos).select(*KEY, "push_reason")


@query("push_reason_weather", compose(f"SELECT {out(*K2, 'push_reason')} FROM det1", WEATHER_ALL))
def _(ws):
    return ps.push_reason_weather(weather.weather_pushed(ws.tables, ALL_WEATHER, ws.period), ALL_WEATHER.target_wos).select(
        *KEY, "push_reason"
    )


# --- grades, clusters, summaries --------------------------------------------


@query(
    "abc_grade",
    compose(f"SELECT {out(*K2, '~pct_of_total_sales=CASE WHEN bl_dec IS NOT NULL THEN pct_raw END', '~cumulative_pct', 'store_item_grade')} FROM graded", TREND_ALL),
)
def _(ws):
    graded = grade.abc_grade(trend.trend_pushed(ws.tables, ALL, ws.period), TREND_GRADE_CUTS)
    return graded.select(*KEY, "pct_of_total_sales", "cumulative_pct", "store_item_grade")


def _whole(ws, preset):
    return run_category(ws.tables, preset, ws.period)


CLUSTERS = ["region", "state", STORE, "store_baseline", "store_projected", "store_push", "store_current_wos",
            "store_pct_of_total_sales", "store_cumulative_pct", "store_cluster"]


@query(
    "store_clusters",
    compose(
        f"""SELECT {out('region', 'state', 'store_number', '~store_baseline', '~store_projected', 'store_push', '~store_current_wos',
        '~store_pct_of_total_sales', '~store_cumulative_pct', 'store_cluster')} FROM st_cl""",
        TREND_ALL,
    ),
)
def _(ws):
    return _whole(ws, ALL).clusters.select(CLUSTERS)


@query(
    "store_totals",
    compose(
        f"""SELECT {out('region', 'state', 'store_number', '~store_baseline=sb', '~store_projected', 'store_push', '~store_current_wos')}
        FROM st_tot""",
        TREND_ALL,
    ),
)
def _(ws):
    return grade.store_totals(_whole(ws, ALL).detail).select(CLUSTERS[:7])


@query("region_summary_trend", compose(o.summary_sql(False), TREND_ALL))
def _(ws):
    return _whole(ws, ALL).summary


@query("region_summary_weather", compose(o.summary_sql(True), WEATHER_ALL))
def _(ws):
    return _whole(ws, ALL_WEATHER).summary


@query(
    "grade_distribution",
    compose(
        """SELECT store_item_grade, CAST(sum(push_units) AS BIGINT) AS push_units, CAST(sum(push_case_pack) AS BIGINT) AS push_case_pack,
        count(*) AS store_items FROM detail GROUP BY store_item_grade""",
        WEATHER_ALL,
    ),
)
def _(ws):
    return grade.grade_distribution(_whole(ws, ALL_WEATHER).detail)


@query(
    "push_grand_totals",
    compose(
        f"""SELECT CAST(sum(push_units) AS BIGINT) AS total_push_units, {out('~avg_current_wos=' + o.mean('current_wos'), '~avg_ly_wos=' + o.mean('ly_wos'),
        '~avg_projected_wos=' + o.mean('projected_wos_after_push'))}, count(DISTINCT store_number) AS store_count,
        CAST(sum(total_pipeline) AS BIGINT) AS total_pipeline_ty, CAST(sum(total_pipeline_ly) AS BIGINT) AS total_pipeline_ly FROM detail""",
        TREND_ALL,
    ),
)
def _(ws):
    return grade.push_grand_totals(_whole(ws, ALL).detail)


@query(
    "push_grand_totals_weather",
    compose(
        f"""SELECT CAST(sum(push_units) AS BIGINT) AS total_push_units, {out('~avg_current_wos=' + o.mean('current_wos'), '~avg_ly_wos=' + o.mean('ly_wos'),
        '~avg_projected_wos=' + o.mean('projected_wos_after_push'))}, count(DISTINCT store_number) AS store_count,
        CAST(sum(total_pipeline) AS BIGINT) AS total_pipeline_ty, CAST(sum(total_pipeline_ly) AS BIGINT) AS total_pipeline_ly FROM detail""",
        WEATHER_ALL,
    ),
)
def _(ws):
    return grade.push_grand_totals(_whole(ws, ALL_WEATHER).detail)


# --- full reports -----------------------------------------------------------


def _register_report(name: str, preset: PushPreset, expected: PushPreset | None = None):
    expected = expected or preset
    if expected.method == "trend":
        stages, columns, summary = o.trend_stages(expected), o.trend_columns(expected), o.summary_sql(False)
    else:
        stages, columns, summary = o.weather_stages(expected), o.WEATHER_COLUMNS, o.summary_sql(True)
    kind = f"{preset.method}_push"
    query(f"{kind}_detail_{name}", compose(f"SELECT {columns} FROM detail", stages))(lambda ws: _whole(ws, preset).detail)
    query(f"{kind}_summary_{name}", compose(summary, stages))(lambda ws: _whole(ws, preset).summary)


for _key, _preset in PUSH_PRESETS.items():
    _register_report(_key, _preset, o.PRESETS[_key])
_register_report("item_projection", ALL_ITEM)
_register_report("shelf_fill_region", REGION_SHELF)


# --- diagnostics ------------------------------------------------------------


@query(
    "inventory_totals",
    compose(
        """SELECT CAST(sum(on_hand_ty) AS BIGINT) AS on_hand_ty, CAST(sum(in_warehouse_ty) AS BIGINT) AS in_warehouse_ty,
        CAST(sum(in_transit_ty) AS BIGINT) AS in_transit_ty, CAST(sum(on_order_ty) AS BIGINT) AS on_order_ty,
        CAST(sum(total_pipeline) AS BIGINT) AS total_pipeline FROM cur""",
        BASE,
    ),
)
def _(ws):
    rows = fx.current_rows(ws.facts, o.ALL_SUBCATEGORIES, ws.period.latest)
    return diag.inventory_totals(fx.with_inventory_position(rows))


@query(
    "style_inventory_summary",
    compose(
        """SELECT sty AS style, CAST(sum(on_hand_ty) AS BIGINT) AS on_hand_ty, CAST(sum(in_warehouse_ty) AS BIGINT) AS in_warehouse_ty,
        CAST(sum(in_transit_ty) AS BIGINT) AS in_transit_ty, CAST(sum(on_order_ty) AS BIGINT) AS on_order_ty, count(*) AS num_sizes,
        CAST(sum(total_pipeline) AS BIGINT) AS total_pipeline FROM cur WHERE sty IS NOT NULL GROUP BY sty""",
        BASE,
    ),
)
def _(ws):
    rows = fx.current_rows(ws.facts, o.ALL_SUBCATEGORIES, ws.period.latest)
    return diag.style_inventory_summary(fx.style_key(fx.with_style_left(rows, ws.tables.style)))


STYLE_SALES = """SELECT sty AS style, CAST(sum(pos_quantity_this_year) AS BIGINT) AS total_pos, count(DISTINCT f5c_item_number) AS num_sizes,
        min(vendor_stock_id) AS vendor_stock_id FROM cat, per WHERE f5c_calendar_week BETWEEN ty_start AND latest AND sty IS NOT NULL GROUP BY sty"""


@query("style_sales_summary", compose(STYLE_SALES, BASE))
def _(ws):
    return diag.style_sales_summary(fx.filter_weeks(_styled(ws), ws.period.ty_start, ws.period.latest))


@query("top_styles_by_units", compose(f"SELECT style, total_pos FROM ({STYLE_SALES}) ORDER BY total_pos DESC, style LIMIT 10", BASE))
def _(ws):
    return diag.top_n(fx.filter_weeks(_styled(ws), ws.period.ty_start, ws.period.latest), STYLE, UNITS, 10, "total_pos")


@query(
    "period_verification",
    compose(
        f"""SELECT store_number, CAST(sum(pos_quantity_this_year) AS BIGINT) AS total_pos,
        {out('~weekly_avg=CAST(sum(pos_quantity_this_year) AS DOUBLE)/26')} FROM pos, per
        WHERE f5c_calendar_week BETWEEN chk AND latest GROUP BY store_number""",
    ),
)
def _(ws):
    return diag.period_verification(ws.facts, ws.period)


@query(
    "missing_style_report",
    compose(
        "SELECT f5c_item_number, count(*) AS row_count FROM cat WHERE internal_style_color IS NULL GROUP BY 1", BASE
    ),
)
def _(ws):
    return diag.missing_style_report(fx.with_style_left(ws.facts, ws.tables.style))


@query(
    "duplicate_keys",
    compose("""SELECT f5c_calendar_week, store_number, f5c_item_number, count(*) AS row_count FROM (SELECT * FROM pos UNION ALL SELECT * FROM pos WHERE store_on_hand_quantity_this_year % 50 = 0)
        GROUP BY ALL HAVING count(*) > 1"""),
)
def _(ws):
    twice = ws.facts.unionByName(ws.facts.where("store_on_hand_quantity_this_year % 50 = 0"))
    return diag.duplicate_keys(twice, FACT_KEY)


@query("key_counts", compose("SELECT count(*) AS total_rows, count(DISTINCT (store_number, sty, f5c_item_number)) AS distinct_keys FROM sproj", BASE))
def _(ws):
    return diag.key_counts(proj.style_projection(_styled(ws), ws.period), [*STYLE_KEY, ITEM])


@query(
    "table_summary",
    compose(
        """SELECT * FROM (SELECT 'category_a' AS table_name, count(*) AS row_count, min(f5c_calendar_week) AS min_week, max(f5c_calendar_week) AS max_week
          FROM pos WHERE source_table = 'category_a'
        UNION ALL SELECT 'general', count(*), min(f5c_calendar_week), max(f5c_calendar_week) FROM pos WHERE source_table <> 'category_a'
        UNION ALL SELECT 'dim_stores', count(*), NULL, NULL FROM stores
        UNION ALL SELECT 'dim_items', count(*), NULL, NULL FROM t_code
        UNION ALL SELECT 'dim_capacity', count(*), NULL, NULL FROM t_code
        UNION ALL SELECT 'dim_case_pack', count(*), NULL, NULL FROM case_pack
        UNION ALL SELECT 'fact_forecast_vendor', count(*), NULL, NULL FROM weather
        UNION ALL SELECT '(all tables)', (SELECT count(*) FROM pos) + (SELECT count(*) FROM stores) + 2 * (SELECT count(*) FROM t_code)
          + (SELECT count(*) FROM case_pack) + (SELECT count(*) FROM weather), (SELECT min(f5c_calendar_week) FROM pos), (SELECT max(f5c_calendar_week) FROM pos))"""
    ),
)
def _(ws):
    t = ws.tables
    return diag.table_summary(
        {
            "category_a": t.facts.where(F.col(SOURCE) == CATEGORY_A),
            "general": t.facts.where(F.col(SOURCE) == GENERAL),
            "dim_stores": t.stores,
            "dim_items": ws.demo.items,
            "dim_capacity": ws.demo.capacity,
            "dim_case_pack": t.case_pack,
            "fact_forecast_vendor": t.weather,
        }
    )


# --- loading ----------------------------------------------------------------

LOADED = [*FACT_KEY, SUBCATEGORY, SOURCE, UNITS, "pos_sales_this_year", "vendor_stock_id", "color_description"]
LOADED_SQL = """f5c_calendar_week, store_number, f5c_item_number, subcategory_number, source_table,
  {units} AS pos_quantity_this_year, pos_sales_this_year,
  CASE WHEN source_table = 'category_a' THEN vendor_stock_id END AS vendor_stock_id, color_description"""
CORRECTED = "CASE WHEN f5c_calendar_week >= w2 THEN pos_quantity_this_year + 7 ELSE pos_quantity_this_year END"
AFTER_UPDATE = compose(f"SELECT {LOADED_SQL.format(units=CORRECTED)} FROM pos, per")


def export_csv(df: DataFrame, folder: str) -> str:
    """Facts as CSV drops: no source tag, text only."""
    df.drop(SOURCE).write.option("header", True).csv(folder)
    return folder


def weekly_change(ws) -> tuple[DataFrame, DataFrame]:
    """All weeks but the latest, and a corrected copy of the last three."""
    old = ws.facts.where(F.col(WEEK) < ws.period.latest)
    fresh = ws.facts.where(F.col(WEEK) >= ws.period.recent[1]).withColumn(UNITS, F.col(UNITS) + 7)
    return old, fresh


@query(
    "route_by_subcategory",
    compose("SELECT subcategory_number, source_table, count(*) AS row_count FROM pos GROUP BY ALL"),
)
def _(ws):
    routed = pos_files.route_by_subcategory(ws.facts.drop(SOURCE))
    return routed.groupBy(SUBCATEGORY, SOURCE).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "conform",
    compose(
        f"SELECT {LOADED_SQL.format(units='pos_quantity_this_year')}, traited_store_count_last_year, NULL::VARCHAR AS modular_based_merchandising_description FROM pos"
    ),
)
def _(ws):
    text = ws.facts.drop(SOURCE).select([F.col(c).cast("string").alias(c) for c in ws.facts.drop(SOURCE).columns])
    rows = pos_files.conform(pos_files.route_by_subcategory(text.withColumn("unknown_column", F.lit("x"))))
    return rows.select(*LOADED, "traited_store_count_last_year", "modular_based_merchandising_description")


@query(
    "upsert_facts",
    compose(f"SELECT {out(*KEYS)}, {CORRECTED} AS pos_quantity_this_year FROM pos, per"),
)
def _(ws):
    old, fresh = weekly_change(ws)
    return fact_store.upsert_facts(old, fresh).select(*FACT_KEY, UNITS)


@query(
    "anti_join_keys",
    compose(f"SELECT {out(*KEYS, UNITS)} FROM pos, per WHERE f5c_calendar_week < w2"),
)
def _(ws):
    old, fresh = weekly_change(ws)
    return fact_store.anti_join_keys(old, fresh, FACT_KEY).select(*FACT_KEY, UNITS)


@query("initial_load", compose(f"SELECT {LOADED_SQL.format(units='pos_quantity_this_year')} FROM pos"))
def _(ws):
    drop, table = export_csv(ws.facts, ws.new_folder("drop")), ws.new_folder("table")
    pos_files.initial_load(ws.spark, drop, table, clear_first=True)
    return fact_store.read_pos_all(ws.spark, table).select(LOADED)


@query("weekly_update", AFTER_UPDATE)
def _(ws):
    table = ws.new_folder("table")
    old, fresh = weekly_change(ws)
    wrong = fresh.withColumn(UNITS, F.col(UNITS) + 100)
    fact_store.append_facts(pos_files.conform(old), table, dealt=True)
    files = [export_csv(wrong, ws.new_folder("drop")), export_csv(fresh, ws.new_folder("drop")), f"{table}-absent.csv"]
    pos_files.weekly_update(ws.spark, files, table)
    return fact_store.read_pos_all(ws.spark, table).select(LOADED)


@query("stream_weekly_updates", AFTER_UPDATE)
def _(ws):
    table = ws.new_folder("table")
    old, fresh = weekly_change(ws)
    fact_store.append_facts(pos_files.conform(old), table, dealt=True)
    drop = export_csv(fresh, ws.new_folder("drop"))
    columns = [c for c in fresh.columns if c != SOURCE]
    stream_weekly_updates(ws.spark, drop, table, ws.new_folder("stream"), columns).awaitTermination()
    return fact_store.read_pos_all(ws.spark, table).select(LOADED)


@query(
    "fact_versions",
    compose("""SELECT f5c_calendar_week, CAST(sum(CASE WHEN f5c_calendar_week < latest THEN pos_quantity_this_year END) AS BIGINT) AS units_before,
      CAST(sum(CASE WHEN f5c_calendar_week >= w2 THEN pos_quantity_this_year + 7 ELSE pos_quantity_this_year END) AS BIGINT) AS units_after
      FROM pos, per GROUP BY 1"""),
)
def _(ws):
    """The version before an upsert, opened before and read after it, beside the newest."""
    table = ws.new_folder("table")
    old, fresh = weekly_change(ws)
    fact_store.append_facts(pos_files.conform(old), table, dealt=True)
    before = fact_store.read_facts(ws.spark, table)
    fact_store.merge_facts(ws.spark, table, pos_files.conform(fresh))
    units = lambda frame, name: frame.groupBy(WEEK).agg(F.sum(UNITS).alias(name))
    return units(fact_store.read_facts(ws.spark, table), "units_after").join(units(before, "units_before"), WEEK, "left")


@query("upsert_replayed_batch", compose(f"SELECT {out(*KEYS)}, {CORRECTED.replace('+ 7', '+ 8')} AS pos_quantity_this_year FROM pos, per"))
def _(ws):
    """A batch, a correction of it, and the batch again: the correction stays."""
    table = ws.new_folder("table")
    old, fresh = weekly_change(ws)
    fact_store.append_facts(pos_files.conform(old), table, dealt=True)
    fact_store.merge_facts(ws.spark, table, pos_files.conform(fresh), batch=("drops", 0))
    fact_store.merge_facts(ws.spark, table, pos_files.conform(fresh.withColumn(UNITS, F.col(UNITS) + 1)))
    fact_store.merge_facts(ws.spark, table, pos_files.conform(fresh), batch=("drops", 0))
    return fact_store.read_facts(ws.spark, table).select(*FACT_KEY, UNITS)


@query("stored_weeks", compose("SELECT f5c_calendar_week, source_table, count(*) AS row_count FROM pos GROUP BY ALL"))
def _(ws):
    """Rows by week and source from partition values and footers: no column is read."""
    return ws.facts.groupBy(WEEK, SOURCE).agg(F.count(F.lit(1)).alias("row_count"))


DAMAGED = "(CAST(store_number AS INTEGER) + f5c_calendar_week) % 7 = 0"


#: Lines that a compressed file holds at most, as it is read by one task.
FILE_LINES = 200_000


def export_damaged_csv(ws, folder: str, **options) -> list[str]:
    """A file folder for each year, in which the lines of some stores have a field too many.

    Each year's weeks are written where they are read, line by line: no task holds a year, or any rows at all.
    ``options`` of the writer, as ``compression``, go beside those for the lines.
    """
    columns = [c for c in ws.facts.columns if c != SOURCE]
    cells = [F.concat(F.lit('"'), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"')) for c in columns]
    line = F.concat_ws(",", *cells, F.when(F.expr(DAMAGED), F.lit('"more, and more"')))
    years = [row["year"] for row in ws.facts.select(F.floor(F.col(WEEK) / 100).alias("year")).distinct().orderBy("year").toLocalIterator()]
    as_it_is = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for year in years:
        if year is not None:
            rows = ws.facts.where(F.col(WEEK).between(year * 100, year * 100 + 99))
            rows.select(line.alias(",".join(columns))).write.options(**as_it_is, **options).csv(f"{folder}/year={year}")
    return [f"{folder}/year={year}" for year in years]


@query(
    "rejected_lines",
    compose(f"""SELECT f5c_calendar_week, count(*) FILTER (NOT {DAMAGED}) AS loaded_rows, count(*) FILTER ({DAMAGED}) AS rejected_rows,
      CAST(sum(pos_quantity_this_year) FILTER (NOT {DAMAGED}) AS BIGINT) AS units FROM pos GROUP BY 1"""),
)
def _(ws):
    table = ws.new_folder("table")
    drops = export_damaged_csv(ws, ws.new_folder("drop"), compression="gzip", maxRecordsPerFile=FILE_LINES)
    pos_files.weekly_update(ws.spark, drops, table)
    bad = pos_files.read_rejected(ws.spark, table).groupBy(F.col(WEEK).cast("int").alias(WEEK)).agg(F.count(F.lit(1)).alias("rejected_rows"))
    good = fact_store.read_facts(ws.spark, table).groupBy(WEEK).agg(F.count(F.lit(1)).alias("loaded_rows"), F.sum(UNITS).alias("units"))
    counts = [F.coalesce(name, F.lit(0)).alias(name) for name in ("loaded_rows", "rejected_rows")]
    return good.join(bad, WEEK, "full").select(WEEK, *counts, "units")


FILE_NAMES = {"Category_A_week": 0, "drop_category_d": 1, "pos_data": 2, "other": 3}


@query(
    "tag_source_file",
    compose("""SELECT ['Category A', 'Category D', 'Mixed Categories', 'Unknown'][f5c_calendar_week % 4 + 1] AS source_category,
        ['Category A', 'Category D', 'Mixed', 'Mixed'][f5c_calendar_week % 4 + 1] AS update_category, count(*) AS row_count FROM pos GROUP BY ALL"""),
)
def _(ws):
    """Each file is labelled by its folder's name here, as Spark names the files themselves."""
    named = F.element_at(F.array(*[F.lit(name) for name in FILE_NAMES]), F.col(WEEK) % 4 + 1)
    tagged = ws.facts.withColumn("name", named)
    labels = tagged.withColumns({"source_category": pos_files.source_label(F.col("name")), "update_category": pos_files.source_label(F.col("name"), update=True)})
    return labels.groupBy("source_category", "update_category").agg(F.count(F.lit(1)).alias("row_count"))


@query("tag_loaded_files", compose("SELECT 'Unknown' AS source_category, count(*) AS row_count FROM pos"))
def _(ws):
    drop = export_csv(ws.facts, ws.new_folder("drop"))
    tagged = pos_files.tag_source_file(pos_files.read_pos_csv(ws.spark, drop))
    return tagged.groupBy("source_category").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "integer_text",
    compose(f"SELECT {out(*KEYS)}, max_shelf_quantity_this_year AS shelf FROM pos"),
)
def _(ws):
    text = F.concat(F.col("max_shelf_quantity_this_year").cast("string"), F.lit(".0"))
    return ws.facts.select(*FACT_KEY, integer(text).alias("shelf"))


# --- dimension files and report sinks ---------------------------------------


def _csv(ws, df: DataFrame, headers: dict[str, str]) -> str:
    """A dimension as a CSV folder under the given headers."""
    path = ws.new_folder("dimension") + ".csv"
    df.select([F.col(c).alias(h) for c, h in headers.items()]).write.option("header", True).csv(path)
    return path


@query("load_dimension", compose("SELECT store_number, state, region, zip_code, merch_zone_number FROM stores"))
def _(ws):
    headers = {"store_number": "Store Number", "state": " State", "region": "Region", "zip_code": "Zip Code", "merch_zone_number": "Merch Zone Number"}
    return dims.load_dimension(ws.spark, _csv(ws, ws.tables.stores, headers), dims.STORES, ws.new_folder("stores"))


@query(
    "load_client_forecast",
    compose("SELECT f5c_item_nbr, subcategory_nbr, f5c_calendar_week, store_nbr, final_forecast_each_quantity FROM client_forecast"),
)
def _(ws):
    headers = {c: c.upper() for c in dims.CLIENT_FORECAST.schema.fieldNames()}
    path = _csv(ws, ws.tables.client_forecast, headers)
    return dims.load_dimension(ws.spark, path, dims.CLIENT_FORECAST, ws.new_folder("forecast")).drop("vendor_stock_id")


def _load(ws, frame: DataFrame, spec) -> DataFrame:
    headers = {name: f" {name.replace('_', ' ').title()}" for name in spec.schema.fieldNames()}
    return dims.load_dimension(ws.spark, _csv(ws, frame, headers), spec, ws.new_folder(spec.name))


@query(
    "load_items",
    compose(f"SELECT {o.item_code('i')} AS f5c_item_number, {o.subcat('i')} AS subcategory, description, retail, 'A' AS item_status FROM t_code"),
)
def _(ws):
    return _load(ws, ws.demo.items, dims.ITEMS).select(ITEM, "subcategory", "description", "retail", "item_status")


@query("load_capacity", compose(f"SELECT {o.item_code('i')} AS item, CAST(i % 9 + 2 AS INTEGER) AS capacity FROM t_code"))
def _(ws):
    return _load(ws, ws.demo.capacity, dims.CAPACITY)


@query("load_case_pack", compose("SELECT item_nbr, case_pack_qty FROM case_pack"))
def _(ws):
    return _load(ws, ws.tables.case_pack, dims.CASE_PACK).select("item_nbr", "case_pack_qty")


@query(
    "load_all_dimensions",
    compose("""SELECT 'dim_stores' AS table_name, count(*) AS row_count FROM stores UNION ALL SELECT 'dim_items', count(*) FROM t_code
      UNION ALL SELECT 'dim_capacity', count(*) FROM t_code UNION ALL SELECT 'dim_case_pack', count(*) FROM case_pack
      UNION ALL SELECT 'fact_forecast_vendor', count(*) FROM weather"""),
)
def _(ws):
    folder = ws.new_folder("dimensions")
    given = (
        (dims.STORES, ws.tables.stores), (dims.ITEMS, ws.demo.items), (dims.CAPACITY, ws.demo.capacity),
        (dims.CASE_PACK, ws.tables.case_pack), (dims.WEATHER, ws.tables.weather),
    )
    for spec, frame in given:
        frame.drop("week_imported").write.option("header", True).csv(f"{folder}/{spec.name}.csv")
    loaded = dims.load_all_dimensions(ws.spark, folder, ws.new_folder("loaded"), week_date="2001-11-05")
    counts = [frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, frame in loaded.items()]
    return reduce(DataFrame.unionByName, counts)


@query(
    "load_all_dimensions_rows",
    compose("""SELECT 'dim_stores' AS table_name, store_number AS key, state || '|' || region || '|' || zip_code || '|' || merch_zone_number AS content FROM stores
      UNION ALL SELECT 'dim_items', printf('I%05d', CAST(i AS BIGINT)), description FROM t_code
      UNION ALL SELECT 'dim_capacity', printf('I%05d', CAST(i AS BIGINT)), CAST(CAST(i % 9 + 2 AS INTEGER) AS VARCHAR) FROM t_code
      UNION ALL SELECT 'dim_case_pack', item_nbr, coalesce(CAST(case_pack_qty AS VARCHAR), '') FROM case_pack
      UNION ALL SELECT 'fact_forecast_vendor', region, '2001-11-05' FROM weather"""),
)
def _(ws):
    """What a refresh of all dimensions leaves in the tables, refreshed twice."""
    folder, target = ws.new_folder("dimensions"), ws.new_folder("loaded")
    given = (
        (dims.STORES, ws.tables.stores), (dims.ITEMS, ws.demo.items), (dims.CAPACITY, ws.demo.capacity),
        (dims.CASE_PACK, ws.tables.case_pack), (dims.WEATHER, ws.tables.weather),
    )
    for spec, frame in given:
        frame.drop("week_imported").write.option("header", True).csv(f"{folder}/{spec.name}.csv")
    for day in ("2001-10-29", "2001-11-05"):
        dims.load_all_dimensions(ws.spark, folder, target, week_date=day)
    content = {
        dims.STORES: (STORE, F.concat_ws("|", "state", "region", "zip_code", F.col("merch_zone_number").cast("string"))),
        dims.ITEMS: (ITEM, F.col("description")),
        dims.CAPACITY: ("item", F.col("capacity").cast("string")),
        dims.CASE_PACK: ("item_nbr", F.coalesce(F.col("case_pack_qty").cast("string"), F.lit(""))),
        dims.WEATHER: ("region", F.col("week_imported").cast("string")),
    }
    tables = [
        dims.read_dimension(ws.spark, spec, f"{target}/{spec.name}").select(F.lit(spec.name).alias("table_name"), F.col(key).alias("key"), text.alias("content"))
        for spec, (key, text) in content.items()
    ]
    return reduce(DataFrame.unionByName, tables)


@query("load_week_mapping", compose("SELECT ty_week, ly_week FROM weekmap"))
def _(ws):
    path = _csv(ws, ws.tables.week_map, {"notes": "Notes", "ty_week": "TY Week", "ly_week": "LY Week"})
    return dims.load_week_mapping(ws.spark, path, ws.new_folder("weeks")).select("ty_week", "ly_week")


@query(
    "load_weather_forecast",
    compose(f"SELECT region, DATE '2001-11-05' AS week_imported, {out('~tw_pct', '~nw_pct')} FROM weather"),
)
def _(ws):
    path = _csv(ws, ws.tables.weather, {"region": "Region", "tw_pct": "TW", "nw_pct": "NW"})
    loaded = dims.load_weather_forecast(ws.spark, path, ws.new_folder("weather"), "2001-11-05")
    return loaded.select("region", "week_imported", "tw_pct", "nw_pct")


@query("write_report", compose("SELECT f5c_calendar_week, f5c_item_number, pos_qty_ty FROM kpi", D_STAGES))
def _(ws):
    paths = write_report(_kpi(ws, "category_d"), ws.new_folder("report"), "weekly", formats=("parquet",))
    return ws.spark.read.parquet(paths[0]).select(WEEK, ITEM, "pos_qty_ty")


def _written_push(ws) -> tuple[dict[str, str], PushReport]:
    """The folders that a push report is written to, by what they hold, and the report."""
    report = run_category(ws.tables, "category_d", ws.period)
    paths = write_push_report(report, ws.new_folder("report"), "category_d", store_clusters=True, single_summary=True)
    return {path.rsplit("category_d_", 1)[1]: path for path in paths}, report


def _read_csv(ws, path: str, like: DataFrame) -> DataFrame:
    return ws.spark.read.schema(like.schema).options(header=True, escape='"', nullValue="\\N").csv(path)  # so that quoted empty texts are no NULLs


@query("write_push_report_detail", QUERIES["weather_push_detail_category_d"].sql)
def _(ws):
    """All columns of a detail report, read back from CSV."""
    paths, report = _written_push(ws)
    return _read_csv(ws, paths["detail.csv"], report.detail)


@query("write_push_report_summary", QUERIES["weather_push_summary_category_d"].sql)
def _(ws):
    """A summary, read back from its one CSV file."""
    paths, report = _written_push(ws)
    return _read_csv(ws, paths["summary_single.csv"], report.summary)


def _all_categories_sql() -> str:
    parts = []
    for key, preset in o.PRESETS.items():
        stages = o.trend_stages(preset) if preset.method == "trend" else o.weather_stages(preset)
        inner = compose("SELECT store_number, f5c_item_number, push_units, store_item_grade, push_reason FROM detail", stages)
        parts.append(f"SELECT '{key}' AS category, * FROM ({inner})")
    return " UNION ALL ".join(parts)


@query("run_all", _all_categories_sql())
def _(ws):
    stacked = run_all_details(run_all(ws.tables, period=ws.period))
    return stacked.select("category", *KEY, "push_units", "store_item_grade", "push_reason")
