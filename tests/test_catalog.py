"""Registered queries against their SQL twins, and what the plans look like."""

import dataclasses
import re

import pytest

import __spark_entry__ as contract
from shelfcast.catalog import registry
from shelfcast.catalog.compare import compare, connect
from shelfcast.catalog.workspace import Workspace
from shelfcast.config import PUSH_PRESETS
from shelfcast.operators import calendar as cal
from shelfcast.operators import diagnostics as diag
from shelfcast.operators import grouping
from shelfcast.plans import finish
from shelfcast.plans.runner import run_all, run_category
from shelfcast.plans.trend_push import styled_rows, trend_scored

DATA = "/root/testdata/sf0.001"
# One of each kind; tools/check_oracle.py compares all of them.
CHECKED = [
    "weekly_productivity", "weekly_productivity_category_d", "feature_frame", "style_projection", "item_projection",
    "blend_forecast", "weather_projection", "rop_gate", "push_style_rop", "push_style_rop_parity", "shelf_fill", "abc_grade",
    "store_clusters", "region_summary_trend", "region_summary_weather", "week_windows", "table_summary", "weekly_update",
    "fact_versions", "upsert_replayed_batch", "stored_weeks", "rejected_lines", "load_all_dimensions_rows", "write_push_report_detail",
    "calendar_dimension", "week_windows_all_targets", "rolling_units_all_targets",
    "trend_push_detail_category_a", "trend_push_detail_item_projection", "weather_push_detail_category_d", "run_all",
]


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.fixture(scope="module")
def workspace(spark):
    return Workspace.of(spark, DATA)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_twin(spark, duck, name):
    assert compare(duck, spark, DATA, name, contract.queries()[name], contract.oracle_sql()[name]) is None


def test_every_query_has_a_twin():
    assert registry.callables().keys() == registry.sql_twins().keys()
    assert contract.queries().keys() >= registry.callables().keys() and contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 10000)
    return df._jdf.queryExecution().executedPlan().toString()


def test_reports_prune_weeks_and_columns(workspace):
    p = workspace.period
    text = plan(styled_rows(workspace.facts, workspace.tables.style, ("1001",), p))
    facts = [line for line in text.splitlines() if "FileScan" in line and "pos_quantity_this_year" in line]
    assert len(facts) == 1
    assert str(p.ty_start) in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", facts[0]).group(1)
    assert "In(subcategory_number" in facts[0] or "EqualTo(subcategory_number" in facts[0]
    assert "pos_sales_this_year" not in facts[0]


def test_no_python_and_no_cross_join_in_the_trend_plan(workspace):
    text = plan(trend_scored(workspace.tables, registry.ALL_STYLE, workspace.period))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in text


def test_each_fact_slice_is_read_once(workspace):
    """Totals joined back to their own rows share the exchange below both."""
    scored = trend_scored(workspace.tables, registry.ALL, workspace.period)
    scored.collect()
    executed = plan(scored).split("== Initial Plan ==")[0]
    scans = [line for line in executed.splitlines() if "FileScan" in line and "f5c_calendar_week" in line]
    assert len(scans) == 4  # current rows, features, sales of both years, current stock


def test_eager_writes_do_not_grow_with_the_categories(workspace, monkeypatch):
    writes = []
    write = grouping.materialise

    def counted(*args):
        writes.append(args)
        return write(*args)

    monkeypatch.setattr(grouping, "materialise", counted)
    monkeypatch.setattr(finish, "materialise", counted)
    counts = []
    for keys in (["category_a"], list(PUSH_PRESETS)):
        writes.clear()
        assert run_all(workspace.tables, {key: PUSH_PRESETS[key] for key in keys}, workspace.period).keys() == set(keys)
        counts.append(len(writes))
    assert counts == [4, 4]


def test_reports_of_all_categories_equal_those_of_each(workspace):
    together = run_all(workspace.tables, period=workspace.period)
    for key in ("category_a", "category_d", "category_e"):
        alone = run_category(workspace.tables, key, workspace.period)
        for name in ("detail", "summary", "clusters"):
            mine, theirs = getattr(together[key], name), getattr(alone, name)
            assert mine.schema == theirs.schema
            assert sorted(map(str, mine.collect())) == sorted(map(str, theirs.collect()))


def test_counts_by_partition_read_no_column(workspace):
    text = plan(contract.queries()["stored_weeks"](workspace.spark, DATA)) + plan(cal.latest_week(workspace.facts))
    text += plan(diag.table_summary({"general": workspace.facts.where("source_table <> 'category_a'")}))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 3 and all("ReadSchema: struct<>" in line for line in scans)


@pytest.mark.parametrize("key", PUSH_PRESETS)
def test_a_category_without_rows_gives_empty_reports(workspace, key):
    nothing = dataclasses.replace(PUSH_PRESETS[key], subcategories=("none",))
    report = run_category(workspace.tables, nothing, workspace.period)
    assert report.detail.count() == report.summary.count() == report.clusters.count() == 0


def test_no_facts_no_report(workspace):
    empty = dataclasses.replace(workspace.tables, facts=workspace.facts.limit(0))
    assert run_category(empty, "category_a") is None


def test_current_rows_are_neither_lost_nor_multiplied(workspace):
    p = workspace.period
    preset = registry.ALL_STYLE
    current = workspace.facts.where(f"f5c_calendar_week = {p.latest}").count()
    detail = run_category(workspace.tables, preset, p).detail
    assert detail.count() == detail.select("store_number", "f5c_item_number").distinct().count() == current
