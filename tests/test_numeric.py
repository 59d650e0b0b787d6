import math

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import numeric as n
from shelfcast.functions.labels import performance_label, season_label, share_label, trend_reason, weather_reason


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("value,digits,expected", [(0.5, 0, 0.0), (1.5, 0, 2.0), (2.5, 0, 2.0), (0.125, 2, 0.12), (0.375, 2, 0.38), (-2.5, 0, -2.0)])
def test_half_even_matches_python(spark, value, digits, expected):
    assert one(spark, n.half_even(F.lit(value), digits)) == expected == round(value, digits)


@pytest.mark.parametrize(
    "top,bottom,policy,expected",
    [
        (6, 3, {}, 2.0), (0, 0, {}, 0.0), (5, 0, {}, math.inf), (-5, 0, {}, -math.inf),
        (5, 0, {"positive_over_zero": 0.0}, 0.0), (None, 3, {}, None), (3, None, {}, None), (0, 4, {}, 0.0),
    ],
)
def test_ratio_policies(spark, top, bottom, policy, expected):
    value = n.ratio(F.lit(top).cast("bigint"), F.lit(bottom).cast("bigint"), **policy)
    assert one(spark, value) == expected


@pytest.mark.parametrize("text,expected", [("12.5", 12.5), (" 7 ", 7.0), ("abc", 0.0), ("", 0.0), (None, 0.0), ("NaN", 0.0), ("$3.00", 0.0)])
def test_number_turns_junk_into_zero(spark, text, expected):
    assert one(spark, n.number(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("text,expected", [("$12.34", 12.34), ("$1,234.5", 1234.5), ("9", 9.0), ("junk", None), (None, None)])
def test_money(spark, text, expected):
    value = one(spark, n.money(F.lit(text).cast("string")))
    assert (None if value is None else float(value)) == expected


@pytest.mark.parametrize("text,expected", [("12", 12), ("12.0", 12), (" 5", 5), ("x", None), ("NaN", None), (None, None)])
def test_integer(spark, text, expected):
    assert one(spark, n.integer(F.lit(text).cast("string"))) == expected


def test_bounds_keep_null(spark):
    null = F.lit(None).cast("double")
    assert one(spark, n.at_least(null, 0.01)) is None
    assert one(spark, n.at_least(F.lit(0.0), 0.01)) == 0.01
    assert one(spark, n.at_most(null, F.lit(1.0))) is None


def test_cover_sentinel(spark):
    assert one(spark, n.weeks_cover(F.lit(10), F.lit(4.0))) == 2.5
    assert one(spark, n.weeks_cover(F.lit(10), F.lit(0.0))) == 999.0
    assert one(spark, n.weeks_cover(F.lit(10), F.lit(None).cast("double"))) == 999.0


def test_coerce_numeric_leaves_other_columns(frame):
    df = frame([(None, "x", "4"), (3, None, "b")], "q bigint, s string, t string")
    assert [tuple(r) for r in n.coerce_numeric(df, ["q", "t", "absent"]).collect()] == [(0, "x", 4.0), (3, None, 0.0)]


@pytest.mark.parametrize(
    "week,expected",
    [(202401, "Spring 2024"), (202426, "Spring 2024"), (202427, "Fall 2024"), (202453, "Fall 2024"), (202400, "Unknown"), (2024, "Unknown"), (None, None)],
)
def test_season_label(spark, week, expected):
    assert one(spark, season_label(F.lit(week).cast("int"))) == expected


@pytest.mark.parametrize(
    "rate,expected",
    [(-0.5, "Declining"), (-0.20, "Declining"), (-0.1, "Soft"), (-0.05, "Soft"), (0.0, "Stable"), (0.05, "Stable"),
     (0.1, "Growing"), (0.20, "Growing"), (0.3, "Hot"), (None, None)],
)
def test_performance_bins_are_right_closed(spark, rate, expected):
    assert one(spark, performance_label(F.lit(rate).cast("double"))) == expected


def test_share_label_boundaries(spark):
    def label(running):
        return one(spark, share_label(F.lit(running).cast("decimal(38,6)"), F.lit(100).cast("decimal(38,6)"), (20, 50, 95), tuple("ABCD")))

    assert [label(v) for v in (1, 20, 20.000001, 50, 95, 95.5, None)] == ["A", "A", "B", "B", "C", "D", "D"]


def test_reason_order(spark):
    def trend(wos, push, growth):
        return one(spark, trend_reason(F.lit(wos), F.lit(push), F.lit(growth).cast("double"), 6.0))

    assert trend(16.0, 5.0, 1.0) == "Overstocked (>15 WOS)"
    assert trend(7.0, 0.0, 1.0) == "Adequate inventory"
    assert trend(2.0, 0.0, 1.0) == "No push needed"
    assert trend(2.0, 3.0, 0.2) == "Strong growth trend"
    assert trend(2.0, 3.0, None) == "Standard replenishment"

    def weather(wos, push, adjustment):
        return one(spark, weather_reason(F.lit(wos), F.lit(push), F.lit(adjustment), 6.0))

    assert weather(1.0, 3.0, 0.9) == "Critical - Low inventory"
    assert weather(3.0, 3.0, 0.9) == "High demand forecast"
    assert weather(3.0, 3.0, 0.1) == "Standard replenishment"
