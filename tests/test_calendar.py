import pytest
from pyspark.sql import functions as F

from conftest import column
from shelfcast.operators import calendar as cal


@pytest.mark.parametrize("week,n,expected", [(202505, -12, 202445), (202452, 1, 202501), (202501, -1, 202452), (202530, -52, 202430), (202510, 0, 202510)])
def test_shift_across_new_year(week, n, expected):
    assert cal.RetailCalendar().shift(week, n) == expected


def test_shift_with_a_long_year():
    calendar = cal.RetailCalendar(long_years=(2023,))
    assert calendar.shift(202352, 1) == 202353
    assert calendar.shift(202353, 1) == 202401
    assert calendar.shift(202401, -1) == 202353
    weeks = [calendar.week(calendar.index(202301) + n) for n in range(60)]
    assert [calendar.index(w) for w in weeks] == list(range(calendar.index(202301), calendar.index(202301) + 60))


def test_index_column_agrees_with_index(frame):
    calendar = cal.RetailCalendar(long_years=(2023, 2017))
    weeks = [201701, 201753, 201801, 202352, 202353, 202401]
    df = frame([(w,) for w in weeks], "week int").select("week", calendar.index_column(F.col("week")).alias("i"))
    assert column(df, "week", "i") == [(w, calendar.index(w)) for w in weeks]


def test_period_uses_mapping_and_fallback(frame):
    facts = frame([(202505,), (202504,)], "f5c_calendar_week int")
    mapping = frame([(202505, 202406)], "ty_week int, ly_week int")
    p = cal.resolve_period(facts, mapping)
    assert (p.latest, p.ty_start, p.ty52_start, p.last_week) == (202505, 202445, 202406, 202504)
    assert p.recent == (202504, 202503, 202502, 202501)
    assert (p.ly_current, p.ly_next, p.ly_start) == (202406, 202407, 202345)
    assert p.ly_window == (202403, 202404, 202405, 202406, 202407, 202408)
    assert cal.resolve_period(facts, mapping, target_week=202504).ly_current == 202404
    assert cal.resolve_period(facts.limit(0), mapping) is None


def test_week_to_ly(frame):
    df = cal.week_to_ly(frame([(202505,), (202506,)], "f5c_calendar_week int"), frame([(202505, 202406)], "ty_week int, ly_week int"))
    assert sorted(column(df, "f5c_calendar_week", "ly_week")) == [(202505, 202406), (202506, 202406)]


def test_template_rolls_over_any_number_of_years(frame):
    rows = column(cal.week_map_template(frame([(202451, 110)], "start_week int, num_weeks int")), "ty_week", "ly_week")
    assert len(rows) == 110
    assert rows[:3] == [(202451, 202351), (202452, 202352), (202501, 202401)]
    assert rows[-1] == (202704, 202604)


def test_mapping_upsert_replaces_by_week(frame):
    schema = "ty_week int, ly_week int, notes string"
    merged = cal.upsert_week_mapping(frame([(1, 10, None), (2, 20, None)], schema), frame([(2, 21, "x"), (3, 30, "")], schema))
    assert column(cal.list_week_mapping(merged), "ty_week", "ly_week", "notes") == [(1, 10, None), (2, 21, "x"), (3, 30, "")]


def test_season_filter_is_one_condition(frame):
    df = frame([(202400,), (202401,), (202426,), (202530,), (202600,)], "f5c_calendar_week int")
    assert column(cal.in_seasons(df, ((202401, 202426), (202527, 202553))), "f5c_calendar_week") == [202401, 202426, 202530]
    assert cal.season_ranges(2024, 2025) == cal.DEFAULT_SEASONS


def test_week_53_is_taken_from_the_data(frame):
    mapping = frame([], "ty_week int, ly_week int")
    facts = frame([(202352,), (202353,), (202401,)], "f5c_calendar_week int")
    period = cal.resolve_period(facts, mapping)
    assert period.last_week == 202353 and len(period.ty_weeks) == 13
    period = cal.resolve_period(frame([(202352,), (202401,)], "f5c_calendar_week int"), mapping)
    assert period.last_week == 202352 and len(period.ty_weeks) == 13


def test_a_week_is_mapped_once(frame):
    facts = frame([(202401,)], "f5c_calendar_week int")
    twice = frame([(202401, 202301), (202401, 202301), (202341, 202299)], "ty_week int, ly_week int")
    period = cal.resolve_period(facts, twice)
    assert (period.ly_current, period.ly_start) == (202301, 202299)
    assert cal.week_to_ly(facts, twice).count() == 1
    with pytest.raises(Exception, match="several last-year weeks"):
        cal.week_to_ly(facts, frame([(202401, 202301), (202401, 202302)], "ty_week int, ly_week int")).collect()
