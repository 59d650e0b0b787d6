import dataclasses
import math

import pytest

from shelfcast.config import PUSH_PRESETS
from shelfcast.operators import push as ps

A = PUSH_PRESETS["category_a"]
SIZE = "store_number string, style string, f5c_item_number string, projected_weekly_sales double, total_pipeline bigint"


def by_item(df):
    return {r["f5c_item_number"]: r for r in df.collect()}


def test_push_wos(frame):
    df = frame([("a", 10.0, 20), ("b", 10.0, 56), ("c", 0.01, 0), ("d", None, 3)], "f5c_item_number string, projected_weekly_sales double, total_pipeline bigint")
    got = by_item(ps.push_wos(df, 6, hysteresis_weeks=0.5, min_push_units=1))
    assert (got["a"]["push_units"], got["a"]["projected_wos_after_push"]) == (40.0, 6.0)
    assert got["b"]["push_units"] == 0.0  # shortfall of 0.4 weeks
    assert got["c"]["push_units"] == 0.0  # below one unit
    assert (got["d"]["push_units"], got["d"]["projected_wos_after_push"]) == (0.0, 999.0)


@pytest.mark.parametrize("pipeline,gate", [(0, 1.0), (300, 0.0), (34, None)])
def test_rop_gate(frame, pipeline, gate):
    df = frame([("1", "S", 10.0, 100.0, pipeline, 100.0 - min(pipeline, 100), 4.0)],
               "store_number string, style string, style_demand double, style_target_inventory double, style_total_pipeline bigint, style_gap double, sigma_weekly double")
    row = ps.rop_gate(df, A).first()
    s = round(10 * 2 + 4 * math.sqrt(2), 2)
    effective = max(0, pipeline - 10)
    expected = min(1, max(0, (s + 7.5 - effective) / 7.5))
    assert row["rop_s"] == s and row["ramp_units"] == 7.5
    assert row["gate"] == pytest.approx(expected)
    assert gate is None or row["gate"] == gate
    assert row["style_cap"] == pytest.approx(round(row["style_gap"] * expected, 2))
    open_gate = ps.rop_gate(df, dataclasses.replace(A, use_rop_gate=False)).first()
    assert open_gate["style_cap"] == row["style_gap"]


@pytest.mark.parametrize("sigma,expected", [(3.0, 3.0), (0.0, 4.0), (None, 4.0)])
def test_sigma_fallback(frame, sigma, expected):
    df = frame([(16.0, sigma)], "style_demand double, sigma_weekly double")
    assert ps.style_sigma(df).first()["sigma_weekly"] == expected


@pytest.mark.parametrize("shelf,pipeline,raw,expected", [(20, 10, 50.0, 16.0), (None, 3, 50.0, 7.0), (1, 3, 5.0, 5.0), (20, 40, 5.0, 0.0), (20, 0, None, None)])
def test_capacity_clamp(frame, shelf, pipeline, raw, expected):
    df = frame([(shelf, pipeline, raw)], "max_shelf_quantity_this_year bigint, total_pipeline bigint, raw_push double")
    assert ps.capacity_clamp(df).first()["candidate_push"] == expected


def capped(frame, cap, **options):
    df = frame(
        [("1", "S", "a", 6.5, cap), ("1", "S", "b", 3.5, cap), ("1", None, "c", 9.0, None)],
        "store_number string, style string, f5c_item_number string, push_units double, cap double",
    )
    return {k: r["push_units"] for k, r in by_item(ps.cap_in_group(df, ["store_number", "style"], "cap", **options)).items()}


def test_cap_in_group(frame):
    assert capped(frame, 5.0) == {"a": 3.0, "b": 1.0, "c": 0.0}
    assert capped(frame, 100.0) == {"a": 6.0, "b": 3.0, "c": 0.0}
    assert capped(frame, 0.0) == {"a": 0.0, "b": 0.0, "c": 0.0}
    assert capped(frame, 0.0, block_on_zero=False)["a"] == 6.5


def test_style_push_never_exceeds_cap(frame):
    """One style with very many sizes: sums stay within the cap."""
    rows = [("1", "HOT", f"i{n}", 1.0 + n % 5, n % 3, 60, f"V{n % 2}") for n in range(400)] + [("2", "S", "x", 5.0, 1, 60, "V9"), ("2", None, "y", 5.0, 0, 60, None)]
    df = frame(rows, SIZE + ", max_shelf_quantity_this_year bigint, vendor_stock_id string")
    spread = frame([("1", "HOT", 12.0), ("2", "S", 2.0)], "store_number string, style string, sigma_weekly double")
    pushed = ps.push_style_rop(df, spread, A)
    assert pushed.count() == len(rows)
    cap = ps.style_caps(df, spread, A).where("style = 'HOT'").first()["style_cap"]
    total = sum(r["push_units"] for r in pushed.where("style = 'HOT'").collect())
    assert 0 < total <= cap
    assert pushed.where("style is null").first()["push_units"] == 0.0
    parity = ps.push_style_rop(df, spread, A, parity=True)
    assert parity.count() == len(rows) - 1  # the row without a vendor id is dropped


def test_shelf_fill(frame):
    df = frame([("a", "west", 50, 10, 5.0, 2.0), ("b", "east", 50, 10, 5.0, 2.0), ("c", "west", None, 10, 5.0, 2.0)],
               "f5c_item_number string, region string, max_shelf_quantity_this_year bigint, total_pipeline bigint, push_units double, projected_weekly_sales double")
    assert {k: r["push_units"] for k, r in by_item(ps.shelf_fill(df, "WEST")).items()} == {"a": 40.0, "b": 5.0, "c": 5.0}
    assert by_item(ps.shelf_fill(df))["b"]["projected_wos_after_push"] == 25.0


def test_sell_through(frame):
    df = frame([(3, 1), (0, 0), (5, -5), (4, -1)], "wtd_pos bigint, on_hand_ty bigint")
    rows = [(r["ship_qty"], r["sell_through_pct"], r["sell_through_flag"]) for r in ps.sell_through(df).collect()]
    assert rows == [(4, 0.75, ""), (0, None, "check"), (0, None, "check"), (3, 1.0, "")]


def test_packs_round_half_to_even(frame):
    df = frame([(5.0, 2), (7.0, 2), (6.0, 4), (1.0, 1)], "push_units double, case_pack_qty bigint")
    assert [r["push_case_pack"] for r in ps.to_case_packs(df).collect()] == [2, 4, 2, 1]
