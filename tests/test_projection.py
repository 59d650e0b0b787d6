import dataclasses

"""Projection operators against plain Python written from the formulas."""

import itertools
import random
import re
from collections import defaultdict

import pytest

from shelfcast.operators import projection as proj
from shelfcast.operators.calendar import Period
from shelfcast.operators.facts import style_key, with_style_left

PERIOD = Period(202444, 202432, 202345, 202419, (202443, 202442, 202441, 202440), 202332, 202344, 202345,
                (202341, 202342, 202343, 202344, 202345, 202346))


def expected_weights(growth, ty, ly, stock):
    base = {True: (0.2, 0.4, 0.4)}
    if growth is None or growth <= -0.20:
        w = list(base[True])
    elif growth <= -0.05:
        w = [0.30, 0.40, 0.30]
    elif growth <= 0.05:
        w = [0.45, 0.35, 0.20]
    elif growth <= 0.20:
        w = [0.60, 0.25, 0.15]
    else:
        w = [0.70, 0.20, 0.10]
    if ly > ty > 0:
        b = min(0.15, 0.3 * (ly - ty) / ly)
        w = [w[0] - 0.7 * b, w[1] + b, w[2] - 0.3 * b]
    if ty == 0 and stock > 0:
        if ly > 0:
            w = [max(0, w[0] - 0.30), w[1] + 0.20, w[2] + 0.10]
        else:
            w = [max(0, w[0] - 0.15), max(0, w[1] - 0.15), w[2] + 0.30]
    return [x / sum(w) for x in w]


def test_adaptive_weights_every_branch(frame):
    growths = [None, -0.5, -0.2, -0.1, -0.05, 0.0, 0.05, 0.1, 0.2, 0.5]
    cases = list(itertools.product(growths, [0, 5, 40], [0, 6, 50], [0, 9]))
    df = frame(
        [(n, *case) for n, case in enumerate(cases)],
        "n int, style_growth_rate double, size_sales_ty_13wk bigint, size_sales_ly_13wk bigint, total_pipeline bigint",
    )
    for row in proj.adaptive_weights(df).collect():
        got = [row[c] for c in proj.WEIGHT_COLUMNS]
        assert got == pytest.approx(expected_weights(*cases[row["n"]])), cases[row["n"]]
        assert sum(got) == pytest.approx(1.0)


def test_style_growth_and_floor(frame):
    df = proj.style_growth(frame([(10.0, 8.0), (10.0, 0.0), (0.0, 5.0)], "style_ty_13wk_avg double, style_ly_13wk_avg double"))
    rows = [(r["style_growth_rate"], r["style_performance"], r["style_projected_weekly_sales"]) for r in df.collect()]
    assert rows == [(0.25, "Hot", 10.0), (0.0, "Stable", 0.01), (-1.0, "Declining", 0.01)]


def brute_force(rows):
    """(store, style, item) -> projected, baseline; rows: week, store, item, style, units, stock."""
    ty = lambda w: PERIOD.ty_start <= w <= PERIOD.latest
    ly = lambda w: PERIOD.ly_start <= w <= PERIOD.ly_current
    weekly = {True: defaultdict(int), False: defaultdict(int)}
    signals = defaultdict(lambda: [0, 0, 0])
    for week, store, item, style, units, stock in rows:
        if style is None:
            continue
        key = (store, style, item)
        if ty(week):
            weekly[True][(store, style, week)] += units
            signals[key][0] += units
        if ly(week):
            weekly[False][(store, style, week)] += units
            signals[key][1] += units
        if week == PERIOD.latest:
            signals[key][2] += stock

    def average(table, sk):
        values = [v for (s, st, _), v in table.items() if (s, st) == sk]
        return sum(values) / len(values) if values else None

    totals = defaultdict(lambda: [0, 0, 0])
    for (store, style, _), values in signals.items():
        totals[(store, style)] = [a + b for a, b in zip(totals[(store, style)], values)]
    blended, sums, growth = {}, defaultdict(float), {}
    for (store, style, item), values in signals.items():
        sk = (store, style)
        now, then = average(weekly[True], sk), average(weekly[False], sk) or 0
        growth[sk] = None if now is None else ((now - then) / then if then > 0 else 0)
        mixes = [v / t if t > 0 else 0 for v, t in zip(values, totals[sk])]
        weights = expected_weights(growth[sk], *values)
        blended[(store, style, item)] = sum(w * m for w, m in zip(weights, mixes))
        sums[sk] += blended[(store, style, item)]
    result = {}
    for key, value in blended.items():
        sk = key[:2]
        share = value / sums[sk] if sums[sk] > 0 else 0
        then = average(weekly[False], sk) or 0
        projected = None if growth[sk] is None else max(0.01, max(0.01, then * (1 + growth[sk])) * share)
        result[key] = (projected, signals[key][0] / 13)
    return result


def test_style_projection_with_a_hot_style(frame):
    """A third of all rows share one style of one store; some rows have no style."""
    rng = random.Random(3)
    rows = []
    for week in [*range(202332, 202345), *range(202432, 202445)]:
        for n in range(90):
            if rng.random() < 0.5:
                continue
            hot = n < 30
            store, style = ("1", "HOT") if hot else (str(n % 3), rng.choice(["A", "B", None]))
            rows.append((week, store, f"i{n}", style if hot or n % 7 else None, rng.randint(0, 9), rng.randint(0, 20)))
    df = frame(
        [(w, s, i, st, u, k, 0, 0, 0) for w, s, i, st, u, k in rows],
        "f5c_calendar_week int, store_number string, f5c_item_number string, style string, pos_quantity_this_year bigint,"
        "on_hand_ty bigint, in_warehouse_ty bigint, in_transit_ty bigint, on_order_ty bigint",
    )
    expected = brute_force(rows)
    got = {(r["store_number"], r["style"], r["f5c_item_number"]): r for r in proj.style_projection(df, PERIOD).collect()}
    assert got.keys() == expected.keys()
    for key, (projected, baseline) in expected.items():
        assert got[key]["projected_weekly_sales"] == (None if projected is None else pytest.approx(projected)), key
        assert got[key]["baseline_weekly_sales"] == pytest.approx(baseline)


def test_signals_by_item_give_the_same_projection_with_a_hot_item(spark, frame):
    """A third of all rows are of one item; items have several vendor ids, two styles share an item, nothing is broadcast."""
    rng = random.Random(5)
    weeks = [*range(202332, 202345), *range(202432, 202445)]
    rows = [
        (week, str(rng.randint(0, 5)), "HOT" if n % 3 == 0 else f"i{n % 17}", rng.choice(["V1", "V2", None]), rng.randint(0, 9), rng.randint(0, 20), 0, 0, 0)
        for week in weeks for n in range(40)
    ]
    schema = (
        "f5c_calendar_week int, store_number string, f5c_item_number string, vendor_stock_id string, pos_quantity_this_year bigint,"
        "on_hand_ty bigint, in_warehouse_ty bigint, in_transit_ty bigint, on_order_ty bigint"
    )
    bridge = [("HOT", "S1"), *((f"i{n}", f"S{n % 4}") for n in range(12)), ("i3", "S9")]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, style = frame(rows, schema), frame(bridge, "customer_style_number string, internal_style_color string")
        before = proj.style_projection(style_key(with_style_left(facts, style)), PERIOD)
        after = proj.projection_of(proj.style_signals(proj.item_signals(facts, PERIOD), style))
        text = after._jdf.queryExecution().executedPlan().toString()
        values = {name: {(r["store_number"], r["style"], r["f5c_item_number"]): (r["projected_weekly_sales"], r["baseline_weekly_sales"]) for r in frame_.collect()} for name, frame_ in (("a", before), ("b", after))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert values["a"].keys() == values["b"].keys() and len(values["a"]) > 50
    for key, (projected, baseline) in values["a"].items():
        assert values["b"][key] == (projected if projected is None else pytest.approx(projected), pytest.approx(baseline))
    assert re.search(r"SortMergeJoin \[f5c_item_number", text)
    below = text[re.search(r"SortMergeJoin \[f5c_item_number", text).end() :]
    assert "HashAggregate" in below  # the bridge meets aggregated rows


def test_mix_sums_to_one_or_zero(frame):
    df = frame(
        [("1", "S", "a", 3, 0, 1), ("1", "S", "b", 1, 0, 1), ("1", "T", "c", 0, 0, 0)],
        "store_number string, style string, f5c_item_number string, size_sales_ty_13wk bigint, size_sales_ly_13wk bigint, total_pipeline bigint",
    ).selectExpr("*", "1L AS ty_weeks", "1L AS ly_weeks")
    rows = {r["f5c_item_number"]: r for r in proj.size_mixes(df, proj.style_totals(df)).collect()}
    assert rows["a"]["ty_size_mix_pct"] + rows["b"]["ty_size_mix_pct"] == 1.0
    assert (rows["a"]["ly_size_mix_pct"], rows["c"]["ty_size_mix_pct"]) == (0.0, 0.0)


FEATURES = "store_number string, f5c_item_number string, ty_13wk_avg double, ly_13wk_avg double, ly_current_week double, ly_next_week double"
FACT = "f5c_calendar_week int, store_number string"


def test_item_projection(frame):
    rows = frame([("1", "a", 12.0, 10.0, 5.0, 7.0), ("1", "b", 4.0, 0.0, None, None)], FEATURES)
    got = {r["f5c_item_number"]: r for r in proj.item_projection(rows, frame([(202344, "1")], FACT), PERIOD).collect()}
    assert got["a"]["projected_weekly_sales"] == pytest.approx((5 * 1.2 + 7 * 1.2) / 2)
    assert got["b"]["projected_weekly_sales"] == 0.01
    assert got["a"]["baseline_weekly_sales"] == 12.0


def test_item_projection_without_any_last_year(frame):
    rows = frame([("1", "a", 12.0, 10.0, None, None)], FEATURES)
    got = proj.item_projection(rows, frame([(202440, "1")], FACT), PERIOD).first()
    assert got["ly_current_week"] == got["ly_next_week"] == 12.0
    assert got["projected_weekly_sales"] == pytest.approx(12 * 1.2)


def test_client_forecast_window(frame):
    df = frame(
        [("a", "1001", w, "1", q) for w, q in ((202445, 4), (202446, 8), (202448, 30), (202450, 99))] + [("b", "2001", 202445, "1", 5)],
        "f5c_item_nbr string, subcategory_nbr string, f5c_calendar_week int, store_nbr string, final_forecast_each_quantity bigint",
    )
    rows = lambda **k: {r["f5c_item_number"]: r["avg_forecast_each"] for r in proj.client_forecast_avg(df, ["1001"], **k).collect()}
    assert rows(weeks=3) == {"a": 14.0}
    assert rows(weeks=2, from_week=202446) == {"a": 19.0}


@pytest.mark.parametrize("weight,label", [(0.8, "Blend"), (1.0, "CLIENT_FORECAST")])
def test_blend_forecast(frame, weight, label):
    df = frame([("1", "a", 10.0), ("1", "b", 10.0), ("1", "c", None)], "store_number string, f5c_item_number string, projected_weekly_sales double")
    fc = frame([("1", "a", 20.0), ("1", "c", 20.0)], "store_number string, f5c_item_number string, avg_forecast_each double")
    got = {r["f5c_item_number"]: r for r in proj.blend_forecast(df, fc, weight).collect()}
    assert got["a"]["projected_weekly_sales"] == pytest.approx((1 - weight) * 10 + weight * 20)
    assert (got["b"]["projected_weekly_sales"], got["b"]["projection_source"]) == (10.0, "Engine")
    assert (got["c"]["projected_weekly_sales"], got["c"]["projection_source"]) == (None, label)


def test_weather_projection_baseline_counts_only_selling_weeks(frame):
    names = [f"ly_pos_week_{o:+d}" for o in (-3, -2, -1, 0, 1, 2)]
    df = frame([(0.0, 4.0, None, 6.0, 8.0, 0.0, -0.5, None)], ", ".join(f"`{c}` double" for c in names) + ", tw_pct double, nw_pct double")
    facts = frame([(202342, "1"), (202344, "2"), (202345, "1"), (202400, "1")], FACT)
    row = proj.weather_projection(df, facts, PERIOD).first()
    assert row["baseline_weekly_sales"] == pytest.approx(18 / 3)
    assert (row["tw_pct"], row["nw_pct"], row["weather_adjustment"]) == (-0.1, 0.0, -0.05)
    assert row["projected_weekly_sales"] == pytest.approx((6 * 0.9 + 8) / 2)


def test_style_average_counts_weeks_of_all_sizes(frame):
    """Two sizes sold in overlapping weeks: three distinct weeks, not four rows."""
    rows = [(202440, "a", 6), (202441, "a", 3), (202441, "b", 3), (202444, "b", 3)]
    df = frame(
        [(w, "1", i, "S", u, 0, 0, 0, 0) for w, i, u in rows],
        "f5c_calendar_week int, store_number string, f5c_item_number string, style string, pos_quantity_this_year bigint,"
        "on_hand_ty bigint, in_warehouse_ty bigint, in_transit_ty bigint, on_order_ty bigint",
    )
    row = proj.style_totals(proj.size_signals(df, PERIOD)).first()
    assert (row["style_ty_13wk_avg"], row["style_ly_13wk_avg"]) == (5.0, 0.0)


def test_a_window_of_many_years_counts_each_week(frame):
    """Last year's window reaches back four years; equal week numbers of different years are different weeks."""
    period = dataclasses.replace(PERIOD, ly_start=202001, ly_current=PERIOD.ly_current)
    weeks = [202001, 202101, 202152, 202153, 202301]
    df = frame(
        [(w, "1", "a", "S", 10, 0, 0, 0, 0) for w in weeks],
        "f5c_calendar_week int, store_number string, f5c_item_number string, style string, pos_quantity_this_year bigint,"
        "on_hand_ty bigint, in_warehouse_ty bigint, in_transit_ty bigint, on_order_ty bigint",
    )
    assert proj.style_totals(proj.size_signals(df, period)).first()["style_ly_13wk_avg"] == 10.0
