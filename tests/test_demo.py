"""The derived fact table: last year's columns, null keys, and how often line items move."""

import datetime
import gzip
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfcast.catalog.registry import DAMAGED, export_damaged_csv
from shelfcast.schemas import FACT_KEY, ITEM, STORE, UNITS, WEEK
from shelfcast.sources import demo, pos_files
from shelfcast.sources import fact_store as store

LINES = "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, l_shipdate timestamp"


def lines():
    """Three years of weeks: some with no last year, some items and stores and days unknown, some cells of several lines."""
    rows = []
    for k in range(300):
        day = None if k % 31 == 0 else datetime.datetime(1999 + k % 3, 1, 1) + datetime.timedelta(days=7 * (k % 11) + 1)
        part, supplier = (None if k % 17 == 0 else 40 * (k % 4), None if k % 19 == 0 else 4 * (k % 2))
        rows.append((k, k % 5, part, supplier, float(k % 13), 10.25 * k, day))
    return rows


def week_of(day):
    return None if day is None else day.year * 100 + min(52, (day.timetuple().tm_yday - 1) // 7 + 1)


def last_year(week):
    if week is None:
        return None
    return week - 99 if week % 100 % 5 and week // 100 == 2001 and week % 100 < 52 else week - 100


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame(lines(), LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    return demo.DemoTables(spark, str(tmp_path))


@pytest.mark.parametrize("part_rows", [demo.PART_ROWS, 2])
def test_facts_have_the_units_of_both_years(tables, monkeypatch, part_rows):
    monkeypatch.setattr(demo, "PART_ROWS", part_rows)
    units, price = Counter(), Counter()
    for _, _, part, supplier, quantity, _, day in lines():
        units[week_of(day), supplier and supplier // 4 if supplier else supplier, part // 40 if part is not None else None] += int(quantity)
    wanted = []
    for (week, st, i), total in units.items():
        past = units.get((last_year(week), st, i)) if None not in (week, st, i) else None
        wanted.append((week, None if st is None else str(st), i, total, past, None if past is None else (last_year(week) + st + i) % 4))
    facts = tables.facts.select(
        WEEK, STORE, F.expr(f"try_cast(substring({ITEM}, 2, 9) as int)"), UNITS, "pos_quantity_last_year", "traited_store_count_last_year"
    )
    known = [row for row in wanted if row[2] is not None]
    found = [tuple(row) for row in facts.collect()]
    assert Counter(row for row in found if row[2] is not None) == Counter(known)
    assert len(found) == len(wanted) and any(row[4] is not None for row in known) and any(row[0] is None for row in known)


def test_line_items_move_once_to_become_facts(tables):
    plan = tables.facts._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\((?:wk|ly_week|st|i|part)#", plan)) == 1


def test_weeks_are_counted_once_for_the_calendar(tables):
    assert "lineitem.parquet" not in str(tables.week_map.inputFiles()) and tables.period.latest == 200111


def test_rows_that_are_dealt_out_are_appended_without_an_exchange(tables, spark, tmp_path, monkeypatch):
    facts = tables.facts.where(F.col(WEEK).isNotNull() & F.col(STORE).isNotNull() & F.col(ITEM).isNotNull())
    store.append_facts(facts, f"{tmp_path}/dealt", dealt=True)
    store.append_facts(facts, f"{tmp_path}/plain")
    one, other = (store.read_facts(spark, f"{tmp_path}/{name}") for name in ("dealt", "plain"))
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty() and not one.isEmpty()
    assert "Exchange" not in store._laid_out(one, dealt=True)._jdf.queryExecution().executedPlan().toString()


def test_a_year_of_many_lines_is_exported_by_several_tasks(tables, spark, tmp_path):
    facts = tables.facts.where(F.col(WEEK).isNotNull() & F.col(STORE).isNotNull() & F.col(ITEM).isNotNull())
    store.append_facts(facts, f"{tmp_path}/facts", dealt=True)

    class Shop:
        facts = store.read_pos_all(spark, f"{tmp_path}/facts")

    Shop.spark = spark
    paths = export_damaged_csv(Shop, f"{tmp_path}/drop")
    files = [file for path in paths for file in Path(path).glob("part-*")]
    assert len(paths) == 3 and len(files) > 3
    for file in files:
        head, *rest = file.read_text().splitlines()
        assert head.startswith(f"{WEEK},") and rest and all(row.startswith('"') and row.endswith('"') for row in rest)
    result = pos_files.weekly_update(spark, paths, f"{tmp_path}/table")
    kept = store.read_facts(spark, f"{tmp_path}/table")
    sound = Shop.facts.where(f"not {DAMAGED}").select(*FACT_KEY, UNITS, "pos_sales_this_year")
    assert kept.select(*sound.columns).exceptAll(sound).isEmpty() and kept.count() == sound.count()
    assert sum(result.rejected.values()) == Shop.facts.where(DAMAGED).count() > 0


def test_compressed_exports_are_loaded_like_plain_ones(tables, spark, tmp_path):
    facts = tables.facts.where(F.col(WEEK).isNotNull() & F.col(STORE).isNotNull() & F.col(ITEM).isNotNull())
    store.append_facts(facts, f"{tmp_path}/facts", dealt=True)

    class Shop:
        facts = store.read_pos_all(spark, f"{tmp_path}/facts")

    Shop.spark = spark
    loaded = {}
    for name, options in (("plain", {}), ("packed", {"compression": "gzip", "maxRecordsPerFile": 5})):
        paths = export_damaged_csv(Shop, f"{tmp_path}/{name}", **options)
        result = pos_files.weekly_update(spark, paths, f"{tmp_path}/table-{name}")
        bad = pos_files.read_rejected(spark, f"{tmp_path}/table-{name}").select("line", "field_count")
        loaded[name] = store.read_facts(spark, f"{tmp_path}/table-{name}"), bad, sum(result.rejected.values()), result.upserted
    archives = [file for path in paths for file in Path(path).glob("part-*")]
    assert all(file.suffix == ".gz" and len(gzip.open(file, "rt").readlines()) <= 6 for file in archives)
    for one, other in zip(loaded["plain"][:2], loaded["packed"][:2], strict=True):
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty() and not one.isEmpty()
    assert loaded["plain"][2:] == loaded["packed"][2:] and loaded["plain"][2] > 0
