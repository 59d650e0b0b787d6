"""SQL twins of the registered queries, for DuckDB on the raw tables.

Written from the formulas, not from the Spark code.  ``STAGES`` holds named
common table expressions; ``compose`` prepends those a query needs.
"""

from __future__ import annotations

import re

from shelfcast.config import PushPreset

ALL_SUBCATEGORIES = ("1001", "1002", "2001", "3001", "4001", "4002", "4003", "4004", "5001", "6001", "6002", "6003")

# What the presets of the reports must hold, written here again so that a slip in the configuration shows.
PRESETS = {
    "category_a": PushPreset(
        "Category A", ("1001", "1002"), method="trend", source="category_a", use_style_projection=True, use_client_forecast=True, client_forecast_weight=0.8,
        client_forecast_weeks=4, push_strategy="style_rop", target_wos=6.0, style_target_wos=10.0, size_min_wos=2.0, hysteresis_weeks=0.25, min_push_units=1.0,
        lead_weeks=1.0, review_weeks=1.0, z_service=1.0, ramp_weeks=0.75, use_rop_gate=True, front_capacity=4, backroom_units=6,
    ),
    "category_b": PushPreset(
        "Category B", ("2001",), method="trend", use_style_projection=True, use_client_forecast=True, client_forecast_weight=1.0, client_forecast_weeks=4,
        push_strategy="wos", target_wos=8.0, hysteresis_weeks=0.5, min_push_units=1.0,
    ),
    "category_c": PushPreset(
        "Category C", ("3001",), method="trend", use_style_projection=True, use_client_forecast=False, client_forecast_weight=0.5, push_strategy="wos",
        target_wos=10.0, hysteresis_weeks=0.5, min_push_units=1.0,
    ),
    "category_d": PushPreset("Category D", ("4001", "4002", "4003", "4004"), method="weather", use_style_projection=False, target_wos=6.0),
    "category_e": PushPreset(
        "Category E", ("5001",), method="trend", use_style_projection=True, push_strategy="wos", target_wos=6.0, hysteresis_weeks=0.5, min_push_units=1.0,
        convert_to_case_pack=True,
    ),
    "category_f": PushPreset(
        "Category F", ("6001", "6002", "6003"), method="trend", use_style_projection=True, push_strategy="wos", target_wos=4.0, hysteresis_weeks=0.5,
        min_push_units=1.0, convert_to_case_pack=True,
    ),
}


def shift(week: str, n: int) -> str:
    """SQL for a week ``n`` weeks away in a calendar of 52-week years."""
    index = f"(({week})//100*52 + ({week})%100 - 1 + ({n}))"
    return f"({index}//52*100 + {index}%52 + 1)"


def r(value: str, digits: int) -> str:
    return f"(round_even(CAST({value} AS DOUBLE)*1e{digits}, 0)/1e{digits})"


def mean(value: str) -> str:
    """Average over exact sums, so that it does not depend on their order."""
    return f"(CAST(sum(CAST({value} AS DECIMAL(20,6))) AS DOUBLE)/count({value}))"


def out(*names: str) -> str:
    """Select list; ``~name`` rounds to six places, ``~name=expr`` as well."""
    items = []
    for name in names:
        rounded = name.startswith("~")
        alias, _, expression = name.lstrip("~").partition("=")
        expression = expression or f'"{alias}"'
        items.append(f'{r(expression, 6) if rounded else expression} AS "{alias}"')
    return ", ".join(items)


STAGES: dict[str, str] = {}


def compose(select: str, extra: dict[str, str] | None = None) -> str:
    """Prepend the stages a select refers to, directly or not, in their order."""
    stages = {**STAGES, **(extra or {})}
    needed, pending = set(), [select]
    while pending:
        text = pending.pop()
        for name in stages:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(stages[name])
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in stages.items() if name in needed)
    return f"WITH {body}\n{select}" if body else select


# --- input tables -----------------------------------------------------------

STAGES["t_code"] = """
  SELECT p_partkey//40 AS i, min(p_name) AS description, min(p_retailprice) AS retail FROM part GROUP BY 1"""


def subcat(i: str) -> str:
    return f"([{', '.join(repr(s) for s in ALL_SUBCATEGORIES)}])[CAST({i} % 12 AS INTEGER) + 1]"


def item_code(i: str) -> str:
    return f"printf('I%05d', CAST({i} AS BIGINT))"


def family_code(prefix: str, i: str, missing: str) -> str:
    return f"CASE WHEN {i}%48 IN ({missing}) THEN NULL ELSE printf('{prefix}%05d', CAST(({i}//24)*12 + {i}%12 AS BIGINT)) END"


STAGES["t_raw"] = """
  SELECT year(l_shipdate)*100 + least(52, (dayofyear(l_shipdate)-1)//7 + 1) AS wk,
         l_suppkey//4 AS st, l_partkey//40 AS i, CAST(l_quantity AS BIGINT) AS qty,
         CAST(round(l_extendedprice*100) AS BIGINT) AS cents,
         (l_orderkey*7 + l_linenumber*3) % 60 AS oh, l_orderkey % 13 AS wh,
         l_partkey % 7 AS tr, (l_orderkey + l_suppkey) % 11 AS oo FROM lineitem"""
STAGES["t_cell"] = """
  SELECT wk, st, i, CAST(sum(qty) AS BIGINT) qty, CAST(sum(cents) AS BIGINT) cents, CAST(sum(oh) AS BIGINT) oh,
         CAST(sum(wh) AS BIGINT) wh, CAST(sum(tr) AS BIGINT) tr, CAST(sum(oo) AS BIGINT) oo, (wk+st+i)%4 AS tc
  FROM t_raw GROUP BY wk, st, i"""
STAGES["weekmap"] = """
  SELECT wk AS ty_week, CASE WHEN wk//100 = 2001 AND wk%100 < 52 THEN wk-99 ELSE wk-100 END AS ly_week
  FROM (SELECT DISTINCT wk FROM t_raw) WHERE (wk%100)%5 <> 0"""
STAGES["pos"] = f"""
  SELECT c.wk AS f5c_calendar_week, 'Sub '||{subcat('c.i')} AS subcategory_description,
         {subcat('c.i')} AS subcategory_number, CAST(c.st AS VARCHAR) AS store_number, {item_code('c.i')} AS f5c_item_number,
         c.qty AS pos_quantity_this_year, l.qty AS pos_quantity_last_year,
         c.wh AS store_in_warehouse_quantity_this_year, l.wh AS store_in_warehouse_quantity_last_year,
         c.tr AS store_in_transit_quantity_this_year, l.tr AS store_in_transit_quantity_last_year,
         c.oo AS store_on_order_quantity_this_year, l.oo AS store_on_order_quantity_last_year,
         c.oh AS store_on_hand_quantity_this_year, l.oh AS store_on_hand_quantity_last_year,
         c.oh AS store_on_hand_quantity_this_year_eop, l.oh AS store_on_hand_quantity_last_year_eop,
         '$'||CAST(c.cents//100 AS VARCHAR)||'.'||lpad(CAST(c.cents%100 AS VARCHAR),2,'0') AS pos_sales_this_year,
         '$'||CAST(l.cents//100 AS VARCHAR)||'.'||lpad(CAST(l.cents%100 AS VARCHAR),2,'0') AS pos_sales_last_year,
         CASE WHEN c.i%10 = 0 THEN NULL ELSE 20 + (c.i%9)*10 END AS max_shelf_quantity_this_year,
         c.tc AS traited_store_count_this_year, l.tc AS traited_store_count_last_year, c.tc AS valid_store_count_this_year,
         {family_code('V', 'c.i', '37,41')} AS vendor_stock_id,
         CASE WHEN c.i%12 < 2 THEN 'Color '||CAST(c.i%3 AS VARCHAR) END AS color_description,
         CASE WHEN c.i%12 < 2 AND c.i%48 <> 36 THEN 'Trait '||CAST(c.i%2 AS VARCHAR) END AS trait_description,
         CASE WHEN c.i%12 < 2 THEN 'category_a' ELSE 'non-category_a' END AS source_table
  FROM t_cell c LEFT JOIN weekmap m ON m.ty_week = c.wk
  LEFT JOIN t_cell l ON l.wk = coalesce(m.ly_week, c.wk-100) AND l.st = c.st AND l.i = c.i"""
STAGES["stores"] = """
  SELECT CAST(st AS VARCHAR) AS store_number, n_name AS state, r_name AS region,
         printf('%08d', CAST(st*101 AS BIGINT)) AS zip_code, st%4 AS merch_zone_number
  FROM (SELECT s_suppkey//4 AS st, min(s_nationkey) AS nk FROM supplier GROUP BY 1)
  JOIN nation ON n_nationkey = nk JOIN region ON r_regionkey = n_regionkey WHERE st%25 <> 24"""
STAGES["style"] = f"""
  SELECT {item_code('i')} AS customer_style_number, {family_code('ST', 'i', '9,25,37,41')} AS internal_style_color, 'Cat '||{subcat('i')} AS product_category,
         'S'||CAST((i//12)%2 AS VARCHAR) AS size FROM t_code WHERE i%48 NOT IN (9,25,37,41)"""
STAGES["case_pack"] = f"""
  SELECT {item_code('i')} AS item_nbr, CASE i%6 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE (i%6)*2 END AS case_pack_qty
  FROM t_code WHERE i%48 < 44"""
STAGES["weather"] = """
  SELECT upper(region) AS region, make_date(wk//100,1,1) + CAST((wk%100-1)*7 AS INTEGER) AS week_imported,
         (sum(qty)%41 - 20)/100.0::DOUBLE AS tw_pct, (sum(oh)%37 - 18)/100.0::DOUBLE AS nw_pct
  FROM t_cell JOIN stores ON store_number = CAST(st AS VARCHAR)
  WHERE region <> (SELECT max(r_name) FROM region) GROUP BY upper(region), wk"""
STAGES["client_forecast"] = f"""
  SELECT {item_code('i')} AS f5c_item_nbr, {subcat('i')} AS subcategory_nbr, wk+100 AS f5c_calendar_week,
         CAST(st AS VARCHAR) AS store_nbr, qty + (st+i)%5 AS final_forecast_each_quantity
  FROM t_cell WHERE wk + 100 IN (SELECT unnest([{', '.join(shift('latest', n) for n in range(1, 7))}]) FROM (SELECT max(wk) AS latest FROM t_raw))"""
STAGES["per0"] = f"""
  SELECT latest, {shift('latest', -12)} AS ty_start, {shift('latest', -51)} AS ty52, {shift('latest', -25)} AS chk,
         {shift('latest', -1)} AS w1, {shift('latest', -2)} AS w2, {shift('latest', -3)} AS w3, {shift('latest', -4)} AS w4
  FROM (SELECT max(wk) AS latest FROM t_raw)"""
STAGES["per"] = f"""
  SELECT *, {shift('ly_cur', 1)} AS ly_next, {shift('ly_cur', -3)} AS v0, {shift('ly_cur', -2)} AS v1,
         {shift('ly_cur', -1)} AS v2, {shift('ly_cur', 2)} AS v5
  FROM (SELECT *, coalesce((SELECT ly_week FROM weekmap WHERE ty_week = latest), latest-100) AS ly_cur,
               coalesce((SELECT ly_week FROM weekmap WHERE ty_week = ty_start), ty_start-100) AS ly_start FROM per0)"""

# --- weekly KPI extract -----------------------------------------------------


def cents(column: str) -> str:
    return f"TRY_CAST(regexp_replace({column}, '[$,]', '', 'g') AS DECIMAL(20,4))"


KPI_TOTALS = {
    "ty_store_ct": "traited_store_count_this_year", "ly_store_ct": "traited_store_count_last_year",
    "pos_qty_ty": "pos_quantity_this_year", "pos_qty_ly": "pos_quantity_last_year",
    "oh_qty_ty": "store_on_hand_quantity_this_year_eop", "oh_qty_ly": "store_on_hand_quantity_last_year_eop",
    "in_transit_ty": "store_in_transit_quantity_this_year", "in_transit_ly": "store_in_transit_quantity_last_year",
    "in_warehouse_ty": "store_in_warehouse_quantity_this_year", "in_warehouse_ly": "store_in_warehouse_quantity_last_year",
    "on_order_ty": "store_on_order_quantity_this_year", "on_order_ly": "store_on_order_quantity_last_year",
}


def quotient(top: str, bottom: str, overflow: str = "'inf'::DOUBLE") -> str:
    """Two-place ratio: 0/0 is 0, positive/0 is ``overflow``."""
    return (
        f"CASE WHEN {bottom} <> 0 THEN {r(f'CAST({top} AS DOUBLE)/CAST({bottom} AS DOUBLE)', 2)} "
        f"WHEN {top} = 0 THEN 0.0 WHEN {top} > 0 THEN {overflow} WHEN {top} < 0 THEN '-inf'::DOUBLE END"
    )


LAST_TWO_YEARS = "f5c_calendar_week BETWEEN (SELECT max(wk)//100*100 - 99 FROM t_raw) AND (SELECT max(wk)//100*100 + 53 FROM t_raw)"


def kpi_stages(subcategories, source: str, detail=(), styled: bool = True) -> dict[str, str]:
    """``kpi_totals`` (whole history) and ``kpi`` (two years of seasons)."""
    keys = ["f5c_calendar_week", "f5c_item_number", "subcategory_description", *detail]
    keys += ["internal_style_color", "product_category", "size"] if styled else []
    subs = ", ".join(f"'{s}'" for s in subcategories)
    sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for n, c in KPI_TOTALS.items())
    join = "JOIN style ON f5c_item_number = customer_style_number" if styled else ""
    totals = f"""
      SELECT {', '.join(keys)}, {sums}, sum({cents('pos_sales_this_year')}) AS sales_ty,
             sum({cents('pos_sales_last_year')}) AS sales_ly
      FROM pos {join} WHERE source_table = '{source}' AND subcategory_number IN ({subs}) GROUP BY {', '.join(keys)}"""
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in [*KPI_TOTALS, "sales_ty", "sales_ly"])
    product = (["internal_style_color"] if styled else []) + ["f5c_item_number", *detail] + (["size"] if styled else [])
    part = f"PARTITION BY {', '.join(product)}, season ORDER BY f5c_calendar_week"
    known = " AND ".join(f"{c} IS NOT NULL" for c in product)

    def running(value: str) -> str:
        return f"CASE WHEN {known} THEN {value} OVER ({part} ROWS UNBOUNDED PRECEDING) END"

    return {
        "kpi_totals": totals,
        "kpi_base": f"""
      SELECT {', '.join(keys)}, {filled},
             CASE WHEN f5c_calendar_week%100 <= 26 THEN 'Spring ' ELSE 'Fall ' END ||
               CAST(f5c_calendar_week//100 AS VARCHAR) AS season
      FROM kpi_totals WHERE {LAST_TWO_YEARS}""",
        "kpi_run": f"""
      SELECT *, {running('sum(pos_qty_ty)')} AS cu, {running('sum(sales_ty)')} AS cs,
             {running('row_number()')} AS wn, {running('sum(ty_store_ct)')} AS cw FROM kpi_base""",
        "kpi": f"""
      SELECT *, {quotient('pos_qty_ty', 'ty_store_ct')} AS weekly_productivity_ty,
             {quotient('pos_qty_ly', 'ly_store_ct')} AS weekly_productivity_ly,
             {quotient('oh_qty_ty', 'ty_store_ct')} AS avg_oh_per_store_ty,
             {quotient('oh_qty_ly', 'ly_store_ct')} AS avg_oh_per_store_ly,
             {quotient('oh_qty_ty', 'pos_qty_ty', '0.0')} AS weeks_of_supply_ty,
             CAST(cu AS BIGINT) AS season_pos_qty_cumulative_ty, CAST(cs AS DOUBLE) AS season_sales_cumulative_ty,
             wn AS weeks_in_season_so_far, CAST(cw AS BIGINT) AS season_store_weeks_cumulative_ty,
             {r('CAST(cu AS DOUBLE)/CAST(wn AS DOUBLE)', 2)} AS avg_weekly_pos_qty_std_ty,
             {r('CAST(cs AS DOUBLE)/CAST(wn AS DOUBLE)', 2)} AS avg_weekly_sales_std_ty,
             coalesce({quotient('cu', 'cw')}, 0.0) AS season_productivity_std_ty FROM kpi_run""",
    }


def kpi_columns(detail=(), styled: bool = True) -> str:
    keys = ["f5c_calendar_week", "f5c_item_number", "subcategory_description", *detail]
    keys += ["internal_style_color", "product_category", "size"] if styled else []
    return out(
        *keys, *KPI_TOTALS, "~sales_ty", "~sales_ly", "season",
        "~weekly_productivity_ty", "~weekly_productivity_ly", "~avg_oh_per_store_ty", "~avg_oh_per_store_ly",
        "~weeks_of_supply_ty", "season_pos_qty_cumulative_ty", "~season_sales_cumulative_ty",
        "weeks_in_season_so_far", "season_store_weeks_cumulative_ty", "~avg_weekly_pos_qty_std_ty",
        "~avg_weekly_sales_std_ty", "~season_productivity_std_ty",
    )


# --- category slices, features, projection ----------------------------------

K = "store_number, f5c_item_number"
SK = "store_number, sty"
U = "pos_quantity_this_year"
W = "f5c_calendar_week"
TY13 = f"{W} BETWEEN ty_start AND latest"
LY13 = f"{W} BETWEEN ly_start AND ly_cur"
POSITION_TY = "oh + wh + tr + oo"


def base_stages(subcategories) -> dict[str, str]:
    """Category rows with style, per-key features and the style projection."""
    subs = ", ".join(f"'{s}'" for s in subcategories)
    growth = "CASE WHEN ly_avg > 0 THEN (ty_avg - ly_avg)/ly_avg ELSE 0.0 END"

    def weight(a: float, b: float, c: float, d: float, e: float) -> str:
        return (
            f"CASE WHEN g > 0.20 THEN {a}::DOUBLE WHEN g > 0.05 THEN {b}::DOUBLE WHEN g > -0.05 THEN {c}::DOUBLE "
            f"WHEN g > -0.20 THEN {d}::DOUBLE ELSE {e}::DOUBLE END"
        )

    def feature(name: str, aggregate: str, where: str) -> str:
        return f"SELECT {K}, {aggregate} AS {name} FROM cat, per WHERE {where} GROUP BY {K}"

    def mix(value: str, name: str, where: str) -> str:
        return f"""
      SELECT *, CASE WHEN sum({name}) OVER (PARTITION BY {SK}) > 0
                THEN {name}/CAST(sum({name}) OVER (PARTITION BY {SK}) AS DOUBLE) ELSE 0.0 END AS {name}_mix
      FROM (SELECT {SK}, f5c_item_number, CAST(coalesce(sum({value}), 0) AS BIGINT) AS {name} FROM cat, per
            WHERE {where} AND sty IS NOT NULL GROUP BY {SK}, f5c_item_number)"""

    return {
        "cat": f"""
      SELECT f.*, store_on_hand_quantity_this_year_eop AS oh, store_in_warehouse_quantity_this_year AS wh,
             store_in_transit_quantity_this_year AS tr, store_on_order_quantity_this_year AS oo,
             s.internal_style_color, coalesce(s.internal_style_color, f.vendor_stock_id) AS sty
      FROM pos f LEFT JOIN style s ON f.f5c_item_number = s.customer_style_number
      WHERE subcategory_number IN ({subs})""",
        "f_ty": f"""SELECT {K}, avg({U}) AS ty_13wk_avg, CAST(sum({U}) AS BIGINT) AS ty_13wk_pos_total
      FROM cat, per WHERE {TY13} GROUP BY {K}""",
        "f_52": feature("ty_52wk_pos_total", f"CAST(sum({U}) AS BIGINT)", f"{W} BETWEEN ty52 AND latest"),
        "f_ly": feature("ly_13wk_avg", f"avg({U})", LY13),
        **{f"f_m{n}": feature(f"pos_m{n}", f"CAST(sum({U}) AS BIGINT)", f"{W} = w{n}") for n in (1, 2, 3, 4)},
        "f_lyc": feature("ly_current_week", f"avg({U})", f"{W} = ly_cur"),
        "f_lyn": feature("ly_next_week", f"avg({U})", f"{W} = ly_next"),
        "cur": f"""
      SELECT c.store_number, c.f5c_item_number, subcategory_number, subcategory_description, vendor_stock_id,
             color_description, trait_description, internal_style_color, sty,
             coalesce({U},0) AS wtd_pos, coalesce(oh,0) AS on_hand_ty,
             coalesce(store_on_hand_quantity_last_year_eop,0) AS on_hand_ly,
             coalesce(wh,0) AS in_warehouse_ty, coalesce(store_in_warehouse_quantity_last_year,0) AS in_warehouse_ly,
             coalesce(tr,0) AS in_transit_ty, coalesce(store_in_transit_quantity_last_year,0) AS in_transit_ly,
             coalesce(oo,0) AS on_order_ty, coalesce(store_on_order_quantity_last_year,0) AS on_order_ly,
             coalesce(store_on_hand_quantity_this_year,0) AS store_on_hand_quantity_this_year,
             coalesce(store_on_hand_quantity_last_year,0) AS store_on_hand_quantity_last_year,
             0.0::DOUBLE AS pos_sales_this_year, 0.0::DOUBLE AS pos_sales_last_year, max_shelf_quantity_this_year AS shelf_raw,
             coalesce(max_shelf_quantity_this_year,0) AS max_shelf_quantity_this_year,
             coalesce(oh,0)+coalesce(wh,0)+coalesce(tr,0)+coalesce(oo,0) AS total_pipeline,
             coalesce(store_on_hand_quantity_last_year_eop,0)+coalesce(store_in_warehouse_quantity_last_year,0)
               +coalesce(store_in_transit_quantity_last_year,0)+coalesce(store_on_order_quantity_last_year,0) AS total_pipeline_ly,
             coalesce({U},0)+coalesce(oh,0) AS ship_qty,
             CASE WHEN coalesce({U},0)+coalesce(oh,0) > 0 THEN
               {r(f'least(1.0, greatest(0.0, CAST(coalesce({U},0) AS DOUBLE)/CAST(coalesce({U},0)+coalesce(oh,0) AS DOUBLE)))', 4)} END AS sell_through_pct,
             CASE WHEN coalesce({U},0)+coalesce(oh,0) <= 0 THEN 'check' ELSE '' END AS sell_through_flag,
             region, state, zip_code, merch_zone_number
      FROM cat c JOIN per ON {W} = latest LEFT JOIN stores d ON c.store_number = d.store_number""",
        "feat": f"""
      SELECT cur.*, coalesce(ty_13wk_avg,0) AS ty_13wk_avg, coalesce(ty_13wk_pos_total,0) AS ty_13wk_pos_total,
             coalesce(ty_52wk_pos_total,0) AS ty_52wk_pos_total, coalesce(ly_13wk_avg,0) AS ly_13wk_avg,
             coalesce(pos_m1,0) AS lw_pos, coalesce(pos_m1,0) AS pos_m1, coalesce(pos_m2,0) AS pos_m2,
             coalesce(pos_m3,0) AS pos_m3, coalesce(pos_m4,0) AS pos_m4, ly_current_week, ly_next_week
      FROM cur LEFT JOIN f_ty USING ({K}) LEFT JOIN f_52 USING ({K}) LEFT JOIN f_ly USING ({K})
      LEFT JOIN f_m1 USING ({K}) LEFT JOIN f_m2 USING ({K}) LEFT JOIN f_m3 USING ({K}) LEFT JOIN f_m4 USING ({K})
      LEFT JOIN f_lyc USING ({K}) LEFT JOIN f_lyn USING ({K})""",
        "sw_ty": f"SELECT {SK}, {W}, coalesce(sum({U}),0) AS u FROM cat, per WHERE {TY13} AND sty IS NOT NULL GROUP BY {SK}, {W}",
        "sw_ly": f"SELECT {SK}, {W}, coalesce(sum({U}),0) AS u FROM cat, per WHERE {LY13} AND sty IS NOT NULL GROUP BY {SK}, {W}",
        "sty_avg": f"""
      SELECT a.*, coalesce(ly_avg, 0.0) AS ly_avg
      FROM (SELECT {SK}, avg(u) AS ty_avg, stddev_samp(u) AS sigma_raw FROM sw_ty GROUP BY {SK}) a
      LEFT JOIN (SELECT {SK}, avg(u) AS ly_avg FROM sw_ly GROUP BY {SK}) b USING ({SK})""",
        "sty_growth": f"""
      SELECT *, CASE WHEN g <= -0.20 THEN 'Declining' WHEN g <= -0.05 THEN 'Soft' WHEN g <= 0.05 THEN 'Stable'
                     WHEN g <= 0.20 THEN 'Growing' ELSE 'Hot' END AS style_performance,
             greatest(0.01, ly_avg*(1+g)) AS sty_proj FROM (SELECT *, {growth} AS g FROM sty_avg)""",
        "mix_ty": mix(U, "s_ty", TY13),
        "mix_ly": mix(U, "s_ly", LY13),
        "mix_in": mix(POSITION_TY, "s_in", f"{W} = latest"),
        "mix": f"""
      SELECT {SK}, f5c_item_number, coalesce(s_ty,0) AS s_ty, coalesce(s_ly,0) AS s_ly, coalesce(s_in,0) AS s_in,
             coalesce(s_ty_mix,0.0) AS m_ty, coalesce(s_ly_mix,0.0) AS m_ly, coalesce(s_in_mix,0.0) AS m_in
      FROM mix_ty FULL JOIN mix_ly USING ({SK}, f5c_item_number) FULL JOIN mix_in USING ({SK}, f5c_item_number)""",
        "wt1": f"""
      SELECT *, {weight(.7, .6, .45, .3, .2)} AS a0, {weight(.2, .25, .35, .4, .4)} AS b0, {weight(.1, .15, .2, .3, .4)} AS c0,
             CASE WHEN s_ly > s_ty AND s_ty > 0
                  THEN least(0.15::DOUBLE, CAST(s_ly - s_ty AS DOUBLE)/CAST(s_ly AS DOUBLE)*0.3::DOUBLE) ELSE 0.0::DOUBLE END AS bst
      FROM mix LEFT JOIN sty_growth USING ({SK})""",
        "wt2": """
      SELECT *, a0 - bst*0.7::DOUBLE AS a1, b0 + bst AS b1, c0 - bst*0.3::DOUBLE AS c1,
             s_ty = 0 AND s_in > 0 AND s_ly > 0 AS back, s_ty = 0 AND s_in > 0 AND NOT s_ly > 0 AS fresh FROM wt1""",
        "wt3": """
      SELECT *, CASE WHEN back THEN greatest(0.0::DOUBLE, a1 - 0.30::DOUBLE) WHEN fresh THEN greatest(0.0::DOUBLE, a1 - 0.15::DOUBLE) ELSE a1 END AS a2,
             CASE WHEN back THEN b1 + 0.20::DOUBLE WHEN fresh THEN greatest(0.0::DOUBLE, b1 - 0.15::DOUBLE) ELSE b1 END AS b2,
             CASE WHEN back THEN c1 + 0.10::DOUBLE WHEN fresh THEN c1 + 0.30::DOUBLE ELSE c1 END AS c2 FROM wt2""",
        "wts": "SELECT *, a2/(a2+b2+c2) AS weight_ty, b2/(a2+b2+c2) AS weight_ly, c2/(a2+b2+c2) AS weight_pipeline FROM wt3",
        "bl": f"""
      SELECT *, CASE WHEN sum(bm) OVER (PARTITION BY {SK}) > 0 THEN bm/sum(bm) OVER (PARTITION BY {SK}) ELSE 0.0 END AS blended
      FROM (SELECT *, weight_ty*m_ty + weight_ly*m_ly + weight_pipeline*m_in AS bm FROM wts)""",
        "sproj": """
      SELECT *, CASE WHEN sty_proj IS NOT NULL THEN greatest(0.01, sty_proj*blended) END AS proj,
             s_ty/13.0::DOUBLE AS base FROM bl""",
        "cf_avg": f"""
      SELECT store_nbr AS store_number, f5c_item_nbr AS f5c_item_number, avg(final_forecast_each_quantity) AS avg_forecast_each
      FROM client_forecast WHERE subcategory_nbr IN ({subs}) AND f5c_calendar_week IN
        (SELECT DISTINCT f5c_calendar_week FROM client_forecast ORDER BY 1 LIMIT 4) GROUP BY ALL""",
    }


def scored_stages(preset: PushPreset) -> dict[str, str]:
    """``scored``: trend rows with projection and weeks of supply."""
    stages = base_stages(preset.subcategories)
    if preset.use_style_projection:
        stages["prj"] = f"""
      SELECT feat.* EXCLUDE (ly_current_week, ly_next_week), proj AS engine, base AS baseline_weekly_sales, g AS growth_rate,
             blended, sty_proj FROM feat LEFT JOIN sproj USING ({K})"""
    else:
        absent = "(SELECT count(*) = 0 FROM cat, per WHERE f5c_calendar_week IN (ly_cur, ly_next))"
        stages["prj0"] = f"""
      SELECT * EXCLUDE (ly_current_week, ly_next_week),
             CASE WHEN {absent} THEN ty_13wk_avg ELSE coalesce(ly_current_week,0) END AS ly_current_week,
             CASE WHEN {absent} THEN ty_13wk_avg ELSE coalesce(ly_next_week,0) END AS ly_next_week,
             CASE WHEN ly_13wk_avg > 0 THEN (ty_13wk_avg-ly_13wk_avg)/ly_13wk_avg ELSE 0.0 END AS growth_rate FROM feat"""
        stages["prj"] = """
      SELECT *, ly_current_week*(1+growth_rate) AS tw_projected, ly_next_week*(1+growth_rate) AS nw_projected,
             greatest(0.01, (ly_current_week*(1+growth_rate) + ly_next_week*(1+growth_rate))/2) AS engine,
             ty_13wk_avg AS baseline_weekly_sales FROM prj0"""
    if preset.use_client_forecast:
        weight = preset.client_forecast_weight
        label = "CLIENT_FORECAST" if weight >= 0.999 else "Blend"
        stages["fc"] = f"""
      SELECT prj.*, avg_forecast_each, engine AS engine_projected_weekly_sales,
             CASE WHEN avg_forecast_each IS NULL THEN engine
                  WHEN engine IS NOT NULL THEN greatest(0.01, (1-{weight}::DOUBLE)*engine + {weight}::DOUBLE*avg_forecast_each) END AS projected_weekly_sales,
             CASE WHEN avg_forecast_each IS NULL THEN 'Engine' ELSE '{label}' END AS projection_source
      FROM prj LEFT JOIN cf_avg USING ({K})"""
    else:
        stages["fc"] = "SELECT *, engine AS projected_weekly_sales FROM prj"
    stages["scored"] = """
      SELECT *, CASE WHEN projected_weekly_sales > 0 THEN on_hand_ty/projected_weekly_sales ELSE 999.0 END AS current_wos,
             CASE WHEN projected_weekly_sales > 0 THEN total_pipeline/projected_weekly_sales ELSE 999.0 END AS pipeline_wos,
             CASE WHEN ly_13wk_avg > 0 THEN on_hand_ly/ly_13wk_avg ELSE 999.0 END AS ly_wos FROM fc"""
    return stages


AFTER = "CASE WHEN projected_weekly_sales > 0 THEN (total_pipeline + push)/projected_weekly_sales ELSE 999.0 END"


def wos_stages(preset: PushPreset) -> dict[str, str]:
    """``pushed`` by weeks of supply."""
    stages = scored_stages(preset)
    stages["w1s"] = f"""
      SELECT *, projected_weekly_sales*{float(preset.target_wos)}::DOUBLE AS target_inventory,
             projected_weekly_sales*{float(preset.target_wos)}::DOUBLE - total_pipeline AS gap FROM scored"""
    stages["w2s"] = "SELECT *, CASE WHEN projected_weekly_sales > 0 THEN gap/projected_weekly_sales ELSE 0.0 END AS shortfall_weeks FROM w1s"
    stages["pushed"] = f"""
      SELECT *, {AFTER} AS projected_wos_after_push FROM
        (SELECT *, CASE WHEN shortfall_weeks >= {float(preset.hysteresis_weeks)} AND gap >= {float(preset.min_push_units)}
                        THEN gap ELSE 0.0 END AS push FROM w2s)"""
    return stages


def rop_stages(preset: PushPreset, parity: bool = False) -> dict[str, str]:
    """``pushed`` by style target, reorder point and capacity."""
    stages = scored_stages(preset)
    lead, horizon = preset.lead_weeks, preset.lead_weeks + preset.review_weeks
    stages["sc"] = (
        "SELECT * EXCLUDE (sty), vendor_stock_id AS sty FROM scored WHERE vendor_stock_id IS NOT NULL" if parity else "SELECT * FROM scored"
    )
    stages["tgt"] = f"""
      SELECT *, greatest(0.0, sd*{float(preset.style_target_wos)}::DOUBLE) AS target,
             greatest(0.0, sd*{float(preset.style_target_wos)}::DOUBLE - sp) AS style_gap, greatest(0.01, sd) AS mu
      FROM (SELECT {SK}, coalesce(sum(projected_weekly_sales),0.0) AS sd, coalesce(sum(total_pipeline),0) AS sp
            FROM sc WHERE sty IS NOT NULL GROUP BY {SK})"""
    stages["gat0"] = f"""
      SELECT tgt.*, CASE WHEN sigma_raw > 0 THEN sigma_raw ELSE sqrt(mu) END AS sigma,
             greatest(0.0, sp - mu*{lead}::DOUBLE) AS eff FROM tgt LEFT JOIN sty_avg USING ({SK})"""
    stages["gat1"] = f"""
      SELECT *, {r(f'mu*{horizon}::DOUBLE + {preset.z_service}::DOUBLE*sigma*sqrt({horizon}::DOUBLE)', 2)} AS rop,
             {r(f'mu*{preset.ramp_weeks}::DOUBLE', 4)} AS ramp FROM gat0"""
    stages["gat2"] = "SELECT *, CASE WHEN ramp > 0 THEN least(1.0, greatest(0.0, (rop + ramp - eff)/ramp)) ELSE 0.0 END AS gate FROM gat1"
    stages["gat"] = f"SELECT *, {r('style_gap*gate', 2)} AS gcap, {'style_gap' if parity else r('style_gap*gate', 2)} AS cap FROM gat2"
    stages["sz1"] = f"""
      SELECT sc.*, target, style_gap, gate, gcap, cap,
             projected_weekly_sales*{float(max(preset.style_target_wos, preset.size_min_wos))}::DOUBLE AS size_target_inventory,
             CASE WHEN projected_weekly_sales IS NOT NULL
                  THEN greatest(0.0, total_pipeline - greatest(0.01, projected_weekly_sales)*{lead}::DOUBLE) END AS peff,
             greatest(0, greatest(max_shelf_quantity_this_year, {preset.front_capacity}) + {preset.backroom_units} - total_pipeline) AS room
      FROM sc LEFT JOIN gat USING ({SK})"""
    stages["sz2"] = """
      SELECT *, CASE WHEN size_target_inventory IS NOT NULL THEN greatest(0.0, size_target_inventory - peff) END AS raw_push FROM sz1"""
    stages["sz3"] = """
      SELECT *, CASE WHEN raw_push IS NOT NULL THEN least(raw_push, room) END AS cand FROM sz2"""
    stages["sz4"] = f"""
      SELECT *, CASE WHEN shortfall_weeks >= {float(preset.hysteresis_weeks)} THEN coalesce(cand, 0.0) ELSE 0.0 END AS p0
      FROM (SELECT *, CASE WHEN projected_weekly_sales > 0 THEN cand/projected_weekly_sales ELSE 0.0 END AS shortfall_weeks FROM sz3)"""
    blocked = "p0" if parity else "0.0"
    stages["sz5"] = f"""
      SELECT *, CASE WHEN sty IS NULL THEN 0.0 WHEN tot <= 0 THEN p0
                     WHEN cap > 0 THEN floor(p0*least(1.0, cap/tot)) ELSE {blocked} END AS p1
      FROM (SELECT *, sum(p0) OVER (PARTITION BY {SK}) AS tot FROM sz4)"""
    stages["pushed"] = f"""
      SELECT *, {AFTER} AS projected_wos_after_push, {float(preset.style_target_wos)}::DOUBLE AS style_target_wos,
             {float(preset.size_min_wos)}::DOUBLE AS size_min_wos
      FROM (SELECT *, CASE WHEN p1 >= {float(preset.min_push_units)} THEN p1 ELSE 0.0 END AS push FROM sz5)"""
    return stages


def graded(source: str, cuts) -> dict[str, str]:
    """``graded``: global cumulative share of the baseline, exact decimals."""
    a, b, c = cuts
    return {
        "gr0": f"""
      SELECT *, CAST(baseline_weekly_sales AS DECIMAL(20,6)) AS bl_dec FROM {source}""",
        "gr1": """
      SELECT *, sum(bl_dec) OVER (ORDER BY bl_dec DESC NULLS LAST, store_number, f5c_item_number ROWS UNBOUNDED PRECEDING) AS run,
             coalesce(sum(bl_dec) OVER (), 0) AS tot_bl FROM gr0""",
        "graded": f"""
      SELECT *, CASE WHEN NOT tot_bl > 0 THEN 0.0 ELSE CAST(bl_dec AS DOUBLE)/CAST(tot_bl AS DOUBLE)*100 END AS pct_raw,
             CASE WHEN NOT tot_bl > 0 THEN 0.0 WHEN bl_dec IS NOT NULL THEN CAST(run AS DOUBLE)/CAST(tot_bl AS DOUBLE)*100 END AS cumulative_pct,
             CASE WHEN NOT tot_bl > 0 OR bl_dec IS NULL THEN 'D' WHEN run*100 <= tot_bl*{a} THEN 'A'
                  WHEN run*100 <= tot_bl*{b} THEN 'B' WHEN run*100 <= tot_bl*{c} THEN 'C' ELSE 'D' END AS store_item_grade FROM gr1""",
    }


def clusters(detail: str) -> dict[str, str]:
    return {
        "st_tot": f"""
      SELECT region, state, store_number, coalesce(sum(CAST(baseline_weekly_sales AS DECIMAL(20,6))), 0) AS sb,
             coalesce(sum(projected_weekly_sales), 0.0) AS store_projected, CAST(sum(push_units) AS BIGINT) AS store_push,
             {mean('current_wos')} AS store_current_wos FROM {detail}
      WHERE region IS NOT NULL AND state IS NOT NULL AND store_number IS NOT NULL GROUP BY region, state, store_number""",
        "st_run": """
      SELECT *, sum(sb) OVER (ORDER BY sb DESC, store_number ROWS UNBOUNDED PRECEDING) AS srun, sum(sb) OVER () AS stot FROM st_tot""",
        "st_cl": """
      SELECT *, CAST(sb AS DOUBLE) AS store_baseline,
             CASE WHEN stot <> 0 THEN CAST(sb AS DOUBLE)/CAST(stot AS DOUBLE)*100 END AS store_pct_of_total_sales,
             CASE WHEN stot <> 0 THEN CAST(srun AS DOUBLE)/CAST(stot AS DOUBLE)*100 END AS store_cumulative_pct,
             CASE WHEN stot <> 0 THEN CASE WHEN srun*100 <= stot*20 THEN 'Top 20%' WHEN srun*100 <= stot*80 THEN 'Next 30%'
                  ELSE 'Bottom 20%' END END AS store_cluster FROM st_run""",
    }


def trend_reason(target: float) -> str:
    return f"""CASE WHEN current_wos > 15 THEN 'Overstocked (>15 WOS)' WHEN push = 0 AND current_wos >= {target} THEN 'Adequate inventory'
             WHEN push = 0 THEN 'No push needed' WHEN growth_rate > 0.15 THEN 'Strong growth trend' ELSE 'Standard replenishment' END"""


def trend_stages(preset: PushPreset, parity: bool = False) -> dict[str, str]:
    """``detail`` and everything before it."""
    styled = preset.push_strategy == "style_rop" and preset.use_style_projection
    stages = rop_stages(preset, parity) if styled else wos_stages(preset)
    stages.update(graded("pushed", (20, 50, 95)))
    stages["det0"] = f"""
      SELECT * EXCLUDE (growth_rate), CAST(round_even(push, 0) AS BIGINT) AS push_units, {trend_reason(preset.target_wos)} AS push_reason,
             {r('pct_raw', 2)} AS pct_of_total_sales, {r('growth_rate', 3)} AS growth_rate FROM graded"""
    if preset.convert_to_case_pack:
        pack = "CASE WHEN coalesce(p.case_pack_qty,0) = 0 THEN 1 ELSE p.case_pack_qty END"
        stages["det1"] = f"""
      SELECT det0.*, {pack} AS case_pack_qty, CAST(round_even(CAST(push_units AS DOUBLE)/{pack}, 0) AS BIGINT) AS push_case_pack
      FROM det0 LEFT JOIN case_pack p ON f5c_item_number = item_nbr"""
    else:
        stages["det1"] = "SELECT * FROM det0"
    stages.update(clusters("det1"))
    stages["detail"] = """
      SELECT det1.*, store_cluster, store_pct_of_total_sales, store_cumulative_pct FROM det1
      LEFT JOIN st_cl ON det1.region = st_cl.region AND det1.state = st_cl.state AND det1.store_number = st_cl.store_number"""
    return stages


STOCK = ["on_hand_ty", "in_warehouse_ty", "in_transit_ty", "on_order_ty", "store_on_hand_quantity_this_year",
         "on_hand_ly", "in_warehouse_ly", "in_transit_ly", "on_order_ly", "store_on_hand_quantity_last_year"]


def trend_columns(preset: PushPreset) -> str:
    styled = preset.push_strategy == "style_rop" and preset.use_style_projection
    names = ["region", "state", "zip_code", "merch_zone_number", "store_number", "f5c_item_number",
             "subcategory_description", "vendor_stock_id"]
    if preset.source == "category_a":
        names += ["color_description", "trait_description"]
    names += ["wtd_pos", "lw_pos", "pos_m1", "pos_m2", "pos_m3", "pos_m4", "ty_13wk_pos_total", "ty_52wk_pos_total",
              "~ty_13wk_avg", "~ly_13wk_avg", "~growth_rate"]
    if not preset.use_style_projection:
        names += ["~ly_current_week", "~ly_next_week", "~tw_projected", "~nw_projected"]
    names += ["~baseline_weekly_sales", "~projected_weekly_sales", *STOCK, "total_pipeline", "total_pipeline_ly",
              "~current_wos", "~pipeline_wos", "~ly_wos"]
    names += [] if styled else ["~target_inventory"]
    names += ["push_units", "~projected_wos_after_push", "~pos_sales_this_year", "~pos_sales_last_year",
              "store_item_grade", "~pct_of_total_sales", "~cumulative_pct", "push_reason"]
    if preset.use_client_forecast:
        names += ["projection_source", "~engine_projected_weekly_sales", "~avg_forecast_each"]
    if styled:
        names += ["~style_target_wos", "~size_min_wos", "~size_target_inventory"]
    names += ["~shortfall_weeks", "max_shelf_quantity_this_year", "ship_qty", "~sell_through_pct", "sell_through_flag"]
    if preset.convert_to_case_pack:
        names += ["case_pack_qty", "push_case_pack"]
    return out(*names, "store_cluster", "~store_pct_of_total_sales", "~store_cumulative_pct")


def summary_sql(packs: bool) -> str:
    extra = "CAST(sum(push_case_pack) AS BIGINT) AS total_push_case_pack," if packs else ""
    weather = f"{r(mean('weather_adjustment'), 2)} AS avg_weather_adj," if packs else ""
    where = "WHERE region IS NOT NULL" if packs else ""
    listed = ["region", "total_push_units"] + (["total_push_case_pack"] if packs else [])
    listed += ["~avg_current_wos", "~avg_ly_wos", "~avg_projected_wos", "store_count"] + (["~avg_weather_adj"] if packs else [])
    listed += ["total_pipeline_ty", "total_pipeline_ly", "pipeline_change=total_pipeline_ty - total_pipeline_ly"]
    change = f"CASE WHEN total_pipeline_ly > 0 THEN {r('(total_pipeline_ty-total_pipeline_ly)/CAST(total_pipeline_ly AS DOUBLE)*100', 1)} ELSE 0.0 END"
    return f"""SELECT {out(*listed)}, {change} AS pipeline_change_pct FROM
      (SELECT region, CAST(sum(push_units) AS BIGINT) AS total_push_units, {extra} {r(mean('current_wos'), 2)} AS avg_current_wos,
              {r(mean('ly_wos'), 2)} AS avg_ly_wos, {r(mean('projected_wos_after_push'), 2)} AS avg_projected_wos,
              count(DISTINCT store_number) AS store_count, {weather} CAST(sum(total_pipeline) AS BIGINT) AS total_pipeline_ty,
              CAST(sum(total_pipeline_ly) AS BIGINT) AS total_pipeline_ly FROM detail {where} GROUP BY region)"""


# --- weather method ---------------------------------------------------------

OFFSETS = {"-3": "v0", "-2": "v1", "-1": "v2", "+0": "ly_cur", "+1": "ly_next", "+2": "v5"}


def weather_scored_stages(preset: PushPreset) -> dict[str, str]:
    stages = base_stages(preset.subcategories)
    for n, week in enumerate(OFFSETS.values()):
        stages[f"lyw{n}"] = f"SELECT {K}, avg({U}) AS o{n} FROM cat, per WHERE {W} = {week} GROUP BY {K}"
    stages["snap"] = """
      SELECT lower(region) AS region, tw_pct AS tw0, nw_pct AS nw0 FROM weather
      WHERE week_imported = (SELECT max(week_imported) FROM weather)"""
    stages["present"] = f"SELECT count(DISTINCT {W}) AS n FROM cat, per WHERE {W} IN ({', '.join(OFFSETS.values())})"
    joins = " ".join(f"LEFT JOIN lyw{n} USING ({K})" for n in range(6))
    offs = ", ".join(f"coalesce(o{n}, 0.0) AS p{n}" for n in range(6))
    stages["wx0"] = f"""
      SELECT c.* EXCLUDE (region, max_shelf_quantity_this_year), lower(c.region) AS region, shelf_raw AS max_shelf_quantity_this_year,
             coalesce(pos_m1,0) AS lw_pos, {offs},
             greatest(-0.1::DOUBLE, coalesce(tw0, 0.0)) AS tw, greatest(-0.1::DOUBLE, coalesce(nw0, 0.0)) AS nw,
             CASE WHEN coalesce(p.case_pack_qty,0) = 0 THEN 1 ELSE p.case_pack_qty END AS case_pack_qty
      FROM cur c LEFT JOIN f_m1 USING ({K}) {joins} LEFT JOIN snap ON lower(c.region) = snap.region
      LEFT JOIN case_pack p ON c.f5c_item_number = p.item_nbr"""
    stages["wx1"] = """
      SELECT *, p3*(1+tw) AS tw_projected, p4*(1+nw) AS nw_projected, (tw+nw)/2 AS wadj,
             CASE WHEN n > 0 THEN (p0+p1+p2+p3+p4+p5)/n ELSE p3 END AS baseline_weekly_sales FROM wx0, present"""
    stages["wx2"] = "SELECT *, greatest(0.01, (tw_projected+nw_projected)/2) AS projected_weekly_sales FROM wx1"
    stages["wscored"] = """
      SELECT *, CASE WHEN projected_weekly_sales > 0 THEN total_pipeline/projected_weekly_sales ELSE 999.0 END AS cw,
             CASE WHEN baseline_weekly_sales > 0 THEN total_pipeline_ly/baseline_weekly_sales ELSE 999.0 END AS lw,
             projected_weekly_sales*6.0::DOUBLE AS target_inventory FROM wx2"""
    return stages


def weather_stages(preset: PushPreset) -> dict[str, str]:
    stages = weather_scored_stages(preset)
    stages["wp0"] = "SELECT *, greatest(0.0, target_inventory - total_pipeline) AS push0 FROM wscored"
    if preset.apply_shelf_fill:
        area = f"AND region = '{preset.shelf_fill_region.lower()}'" if preset.shelf_fill_region else ""
        fill = f"""CASE WHEN coalesce(max_shelf_quantity_this_year,0) > total_pipeline + push0 {area}
                   THEN greatest(0.0, coalesce(max_shelf_quantity_this_year,0) - total_pipeline) ELSE push0 END"""
    else:
        fill = "push0"
    stages["wp1"] = f"SELECT *, CAST({fill} AS DOUBLE) AS push FROM wp0"
    stages["wpushed"] = f"SELECT *, {AFTER} AS after_push FROM wp1"
    stages.update(graded("wpushed", (50, 80, 95)))
    stages["det1"] = f"""
      SELECT *, {r('cw', 1)} AS current_wos, {r('lw', 1)} AS ly_wos, {r('after_push', 1)} AS projected_wos_after_push,
             {r('pct_raw', 2)} AS pct_of_total_sales, {r('tw', 3)} AS tw_pct, {r('nw', 3)} AS nw_pct, {r('wadj', 3)} AS weather_adjustment,
             CAST(round_even(push, 0) AS BIGINT) AS push_units, CAST(round_even(push/case_pack_qty, 0) AS BIGINT) AS push_case_pack,
             CASE WHEN cw > 15 THEN 'Overstocked (>15 WOS)' WHEN push = 0 AND cw >= 6 THEN 'Adequate inventory'
                  WHEN push = 0 THEN 'No push needed' WHEN cw < 2 THEN 'Critical - Low inventory'
                  WHEN wadj > 0.15 THEN 'High demand forecast' ELSE 'Standard replenishment' END AS push_reason FROM graded"""
    stages.update(clusters("det1"))
    stages["detail"] = """
      SELECT det1.*, store_cluster, store_pct_of_total_sales, store_cumulative_pct FROM det1
      LEFT JOIN st_cl ON det1.region = st_cl.region AND det1.state = st_cl.state AND det1.store_number = st_cl.store_number"""
    return stages


WEATHER_COLUMNS = out(
    "region", "state", "store_number", "f5c_item_number", "subcategory_description", "wtd_pos", "lw_pos",
    *[f"~ly_pos_week_{o}=p{n}" for n, o in enumerate(OFFSETS)],
    "~baseline_weekly_sales", "~tw_pct", "~nw_pct", "~weather_adjustment", "~tw_projected", "~nw_projected",
    "~projected_weekly_sales", *STOCK, "total_pipeline", "total_pipeline_ly", "~current_wos", "~ly_wos",
    "~target_inventory", "push_units", "push_case_pack", "~projected_wos_after_push", "~pos_sales_this_year",
    "~pos_sales_last_year", "store_item_grade", "~pct_of_total_sales", "~cumulative_pct", "push_reason",
    "case_pack_qty", "max_shelf_quantity_this_year", "ship_qty", "~sell_through_pct", "sell_through_flag",
    "store_cluster", "~store_pct_of_total_sales", "~store_cumulative_pct",
)
