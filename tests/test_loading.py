import datetime as dt
import gzip
import os
import time
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfcast.schemas import FACT_KEY, UNITS
from shelfcast.sources import dimensions as dims
from shelfcast.sources import fact_store as store
from shelfcast.sources import pos_files as files
from shelfcast.sources import versions
from shelfcast.sources.reports import write_report, write_single_csv
from shelfcast.streaming.weekly import stream_weekly_updates

HEADER = "f5c_calendar_week, subcategory_number ,store_number,f5c_item_number,pos_quantity_this_year,vendor_stock_id,color_description,surprise"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def write(folder, name, lines, header=HEADER):
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    return path


def rows(spark, path):
    facts = store.read_facts(spark, path)
    return sorted(tuple(r) for r in facts.select(*FACT_KEY, UNITS, "source_table", "vendor_stock_id").collect())


def test_read_trims_headers_and_checks_columns(spark, folder):
    good = write(folder, "a.csv", ["202401,1001,1,x,5,V,red,?"])
    assert files.read_pos_csv(spark, good).columns[1] == "subcategory_number"
    bad = write(folder, "b.csv", ["1,2"], header="f5c_calendar_week,store_number")
    with pytest.raises(files.MissingColumns, match="f5c_item_number"):
        files.read_pos_csv(spark, bad)


def test_routing_and_conform(spark, folder):
    path = write(folder, "a.csv", ["202401,1001,1,x,5.0,V1,red,?", "202401,2001,1,y,abc,V2,blue,?", "202401,,1,z,NA,V3,,?"])
    out = {r["f5c_item_number"]: r for r in files.conform(files.route_by_subcategory(files.read_pos_csv(spark, path))).collect()}
    assert (out["x"][UNITS], out["x"]["source_table"], out["x"]["vendor_stock_id"], out["x"]["color_description"]) == (5, "category_a", "V1", "red")
    assert (out["y"][UNITS], out["y"]["source_table"], out["y"]["vendor_stock_id"]) == (None, "non-category_a", None)
    assert (out["z"][UNITS], out["z"]["source_table"], out["z"]["subcategory_number"]) == (None, "non-category_a", None)
    assert "surprise" not in out["x"].asDict() and out["x"]["pos_quantity_last_year"] is None


def test_row_without_a_key_fails(spark, folder):
    path = write(folder, "a.csv", ["oops,1001,1,x,5,,,"])
    with pytest.raises(PySparkException, match="row without f5c_calendar_week"):
        files.conform(files.route_by_subcategory(files.read_pos_csv(spark, path))).collect()


def test_initial_load_appends_and_skips_invalid_files(spark, folder):
    write(folder, "category_a_1.csv", ["202401,1001,1,x,5,V,,", "202401,1001,1,x,6,V,,"])
    write(folder, "reordered.csv", ["1,y,202402,2001"], header="store_number,f5c_item_number,f5c_calendar_week,subcategory_number")
    broken = write(folder, "broken.csv", ["1"], header="store_number")
    table = f"{folder}/table"
    result = files.initial_load(spark, folder, table)
    assert len(result.loaded) == 2 and [p.split("/")[-1] for p in result.skipped] == [broken.split("/")[-1]]
    expected = [(202401, "1", "x", 5, "category_a", "V"), (202401, "1", "x", 6, "category_a", "V"), (202402, "1", "y", None, "non-category_a", None)]
    assert rows(spark, table) == expected
    files.initial_load(spark, folder, table)
    assert len(rows(spark, table)) == 6
    files.initial_load(spark, folder, table, clear_first=True)
    assert rows(spark, table) == expected


def test_weekly_update_replaces_keys_and_the_later_file_wins(spark, folder):
    table = f"{folder}/table"
    base = write(folder, "base.csv", ["202401,1001,1,x,5,V,,", "202401,1001,2,x,7,V,,", "202402,2001,1,y,1,,,"])
    one = write(folder, "one.csv", ["202401,1001,1,x,50,V,,", "202402,2001,1,y,10,,,"])
    two = write(folder, "two.csv", ["202401,1001,1,x,60,W,,", "202401,1001,1,x,61,W,,", "202403,2001,1,z,2,,,"])
    files.weekly_update(spark, base, table)
    result = files.weekly_update(spark, [one, f"{folder}/absent.csv", two], table)
    assert result.loaded == [one, two] and list(result.skipped) == [f"{folder}/absent.csv"]
    expected = [
        (202401, "1", "x", 60, "category_a", "W"), (202401, "1", "x", 61, "category_a", "W"), (202401, "2", "x", 7, "category_a", "V"),
        (202402, "1", "y", 10, "non-category_a", None), (202403, "1", "z", 2, "non-category_a", None),
    ]
    assert rows(spark, table) == expected
    files.weekly_update(spark, [one, two], table)
    assert rows(spark, table) == expected


def test_the_two_facts_are_upserted_apart(spark, folder):
    table = f"{folder}/table"
    files.weekly_update(spark, write(folder, "a.csv", ["202401,1001,1,x,5,V,,"]), table)
    files.weekly_update(spark, write(folder, "b.csv", ["202401,2001,1,x,9,,,"]), table)
    assert [r[3] for r in rows(spark, table)] == [5, 9]


def test_upsert_counts_and_untouched_weeks(spark, folder):
    table = f"{folder}/table"
    load = lambda name, lines: files.conform(files.route_by_subcategory(files.read_pos_csv(spark, write(folder, name, lines))))
    assert store.merge_facts(spark, table, load("a.csv", ["202401,1001,1,x,5,V,,", "202402,1001,1,x,5,V,,"])) == store.UpsertResult(0, 2)
    before = {p.name for p in Path(table, "f5c_calendar_week=202402").iterdir()}
    assert store.merge_facts(spark, table, load("b.csv", ["202401,1001,1,x,6,V,,", "202401,1001,3,x,6,V,,"])) == store.UpsertResult(1, 2)
    assert before == {p.name for p in Path(table, "f5c_calendar_week=202402").iterdir()}
    assert store.merge_facts(spark, table, load("c.csv", ["202401,1001,1,x,6,V,,"]).limit(0)) == store.UpsertResult(0, 0)


def loader(spark, folder):
    return lambda name, lines: files.conform(files.route_by_subcategory(files.read_pos_csv(spark, write(folder, name, lines))))


def test_an_upsert_that_broke_off_changes_nothing(spark, folder, monkeypatch):
    table, load = f"{folder}/table", loader(spark, folder)
    store.merge_facts(spark, table, load("a.csv", ["202401,1001,1,x,5,V,,", "202402,1001,2,x,5,V,,"]))

    def breaks(spark, path, version):
        raise OSError("lost driver")  # all rows are written, the version is not

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", breaks)
        with pytest.raises(OSError):
            store.merge_facts(spark, table, load("b.csv", ["202401,1001,1,x,8,V,,"]))
    assert [r[3] for r in rows(spark, table)] == [5, 5]
    store.merge_facts(spark, table, load("c.csv", ["202402,1001,2,x,9,V,,"]))
    assert [r[3] for r in rows(spark, table)] == [5, 9]


def test_a_reader_keeps_its_version_during_an_upsert(spark, folder, monkeypatch):
    table, load = f"{folder}/table", loader(spark, folder)
    store.merge_facts(spark, table, load("a.csv", ["202401,1001,1,x,5,V,,", "202402,1001,2,x,5,V,,"]))
    opened = store.read_facts(spark, table)
    seen = []
    commit = versions.commit

    def watched(spark, path, version):
        seen.append([r[3] for r in rows(spark, table)])  # all new rows lie in the folder, none is visible
        commit(spark, path, version)
        seen.append([r[3] for r in rows(spark, table)])

    monkeypatch.setattr(versions, "commit", watched)
    store.merge_facts(spark, table, load("b.csv", ["202401,1001,1,x,8,V,,", "202402,1001,2,x,9,V,,", "202403,1001,2,x,1,V,,"]))
    assert seen == [[5, 5], [8, 9, 1]]
    assert sorted(r[UNITS] for r in opened.collect()) == [5, 5]
    assert sorted(r[UNITS] for r in store.read_facts(spark, table, version=1).collect()) == [5, 5]


def test_a_second_writer_is_refused(spark, folder, monkeypatch):
    table, load = f"{folder}/table", loader(spark, folder)
    one, other = load("a.csv", ["202401,1001,1,x,5,V,,"]), load("b.csv", ["202401,1001,1,x,6,V,,"])
    add = versions.add_folders

    def slow(df, path, partitions):
        folders = add(df, path, partitions)
        monkeypatch.setattr(versions, "add_folders", add)
        store.append_facts(other, path)  # another writer commits before this one does
        return folders

    monkeypatch.setattr(versions, "add_folders", slow)
    with pytest.raises(versions.StaleVersion):
        store.merge_facts(spark, table, one)
    assert [r[3] for r in rows(spark, table)] == [6]


def test_a_replayed_batch_leaves_a_later_correction(spark, folder):
    table, load = f"{folder}/table", loader(spark, folder)
    batch = load("a.csv", ["202401,1001,1,x,5,V,,"])
    assert store.merge_facts(spark, table, batch, batch=("s", 0)) == store.UpsertResult(0, 1)
    store.merge_facts(spark, table, load("b.csv", ["202401,1001,1,x,6,V,,"]))
    assert store.merge_facts(spark, table, batch, batch=("s", 0)) == store.UpsertResult(0, 0, replayed=True)
    assert [r[3] for r in rows(spark, table)] == [6]
    assert store.merge_facts(spark, table, batch, batch=("another", 0)) == store.UpsertResult(1, 1)
    assert not store.merge_facts(spark, table, batch.limit(0), batch=("s", 1)).replayed
    assert store.merge_facts(spark, table, batch, batch=("s", 1)).replayed


def test_a_replayed_stream_batch_leaves_a_later_correction(spark, folder):
    names = ["f5c_calendar_week", "subcategory_number", "store_number", "f5c_item_number", "pos_quantity_this_year"]
    header, drop, table, state = ",".join(names), f"{folder}/drop", f"{folder}/table", f"{folder}/state"
    os.mkdir(drop)
    run = lambda: stream_weekly_updates(spark, drop, table, state, names).awaitTermination()
    write(drop, "w1.csv", ["202401,1001,1,x,5", "202401,2001,1,y,6,surplus"], header)
    run()
    os.remove(next(Path(state, "commits").glob("0")))  # the driver was lost before Spark noted the batch
    for crc in Path(state, "commits").glob(".0.crc"):
        os.remove(crc)
    files.weekly_update(spark, write(folder, "fix.csv", ["202401,1001,1,x,50"], header), table)
    run()
    assert [r[3] for r in rows(spark, table)] == [50]
    assert [r["line"] for r in files.read_rejected(spark, table).collect()] == ["202401,2001,1,y,6,surplus"]


def test_old_versions_and_their_folders_go(spark, folder):
    table, load = f"{folder}/table", loader(spark, folder)
    for k in range(5):
        store.merge_facts(spark, table, load(f"{k}.csv", [f"202401,1001,1,x,{k},V,,", *(["202402,1001,1,x,7,V,,"] if not k else [])]), keep_versions=2)
    assert versions.numbers(spark, table) == [4, 5]
    assert len(list(Path(table, "f5c_calendar_week=202401").glob("*/load=*"))) == 2
    assert [r[3] for r in rows(spark, table)] == [4, 7]
    assert sorted(r[UNITS] for r in store.read_facts(spark, table, version=4).collect()) == [3, 7]


def test_a_plain_folder_is_not_written_to(spark, folder):
    load = loader(spark, folder)("a.csv", ["202401,1001,1,x,5,V,,"])
    load.write.partitionBy("f5c_calendar_week").parquet(f"{folder}/plain")
    with pytest.raises(ValueError, match="no versions"):
        store.append_facts(load, f"{folder}/plain")


def test_a_replayed_upsert_keeps_what_others_wrote_in_between(spark, folder):
    table, load = f"{folder}/table", loader(spark, folder)
    batch = load("a.csv", ["202401,1001,1,x,5,V,,"])
    assert store.merge_facts(spark, table, batch) == store.UpsertResult(0, 1)
    store.merge_facts(spark, table, load("b.csv", ["202401,1001,2,x,6,V,,"]))
    assert store.merge_facts(spark, table, batch) == store.UpsertResult(1, 1)
    assert [r[3] for r in rows(spark, table)] == [5, 6]


def test_overwriting_does_not_depend_on_the_session(spark, folder):
    table, load = f"{folder}/table", loader(spark, folder)
    store.append_facts(load("a.csv", ["202401,1001,1,x,5,V,,"]), table)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store.append_facts(load("b.csv", ["202402,1001,1,x,5,V,,"]), table, overwrite=True)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert len(rows(spark, table)) == 1


def test_jobs_do_not_grow_with_the_files(spark, folder):
    tracker = spark.sparkContext.statusTracker()

    def jobs(group, run):
        spark.sparkContext.setJobGroup(group, group)
        try:
            run()
        finally:
            spark.sparkContext._jsc.clearJobGroup()
        return len(tracker.getJobIdsForGroup(group))

    counts = {}
    for number in (2, 50):
        drop = f"{folder}/drop{number}"
        os.mkdir(drop)
        paths = [write(drop, f"w{k}.csv", [f"202401,1001,{k},x,5,V,,"]) for k in range(number)]
        load = jobs(f"load{number}", lambda d=drop, n=number: files.initial_load(spark, d, f"{folder}/t{n}"))
        result = []
        update = jobs(f"update{number}", lambda p=paths, n=number: result.append(files.weekly_update(spark, p, f"{folder}/t{n}")))
        assert result[0].upserted == store.UpsertResult(number, number)
        counts[number] = (load, update)
    # a few more for listing many paths and for ordering by file, none for each file
    assert all(many <= few + 6 for many, few in zip(counts[50], counts[2], strict=True))


def test_keep_latest_file_with_one_hot_key(spark):
    delta = spark.range(30000).select(
        F.lit("category_a").alias("source_table"), F.lit(202401).alias("f5c_calendar_week"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("store_number"),
        F.lit("x").alias("f5c_item_number"), (F.col("id") % 2).alias(store.FILE_ORDER),
    )
    kept = store.keep_latest_file(delta)
    assert kept.where("store_number = 'hot'").count() == 5000
    assert kept.count() == 20000 + 5000


def test_streamed_files_equal_weekly_updates(spark, folder):
    names = ["f5c_calendar_week", "subcategory_number", "store_number", "f5c_item_number", "pos_quantity_this_year"]
    header = " , ".join(names)
    drop, table, state = f"{folder}/drop", f"{folder}/table", f"{folder}/state"
    os.mkdir(drop)
    run = lambda: stream_weekly_updates(spark, drop, table, state, names).awaitTermination()
    write(drop, "w1.csv", ["202401,1001,1,x,5", "202401,2001,1,y,6"], header)
    run()
    assert [r[3] for r in rows(spark, table)] == [5, 6]
    write(drop, "w2.csv", ["202401,1001,1,x,50", "202402,1001,1,x,1"], header)
    write(drop, "w3.csv", ["202402,1001,1,x,2"], header)
    os.utime(f"{drop}/w3.csv", (4e9, 4e9))
    run()
    assert [r[3] for r in rows(spark, table)] == [50, 6, 2]
    run()  # nothing new
    assert len(rows(spark, table)) == 3


def test_stream_rejects_a_file_with_another_header(spark, folder):
    drop = f"{folder}/drop"
    os.mkdir(drop)
    names = ["f5c_calendar_week", "subcategory_number", "store_number", "f5c_item_number", "pos_quantity_this_year"]
    write(drop, "w.csv", ["1,202401,1001,x,5"], ",".join([names[2], names[0], names[1], names[3], names[4]]))
    with pytest.raises(PySparkException):
        stream_weekly_updates(spark, drop, f"{folder}/t", f"{folder}/s", names).awaitTermination()
    with pytest.raises(files.MissingColumns):
        stream_weekly_updates(spark, drop, f"{folder}/t", f"{folder}/s", names[:2])


@pytest.mark.parametrize("name,update,expected", [
    ("Category_A_w1", False, "Category A"), ("x_category_d", False, "Category D"), ("pos_data", False, "Mixed Categories"),
    ("other", False, "Unknown"), ("other", True, "Mixed"), ("category_a", True, "Category A"),
])
def test_source_label(spark, name, update, expected):
    assert spark.range(1).select(files.source_label(F.lit(name), update).alias("v")).first()["v"] == expected


def test_dimension_headers_and_refresh(spark, folder):
    path = write(folder, "packs.csv", ["007,A,10,4", "8,B,,"], header="Item Nbr ,Status,VNPK Qty,Case Pack Qty")
    table = dims.load_dimension(spark, path, dims.CASE_PACK, f"{folder}/out")
    assert sorted(tuple(r) for r in table.collect()) == [("007", "A", 10, 4), ("8", "B", None, None)]
    path = write(folder, "packs2.csv", ["9,C,1,1"], header="item_nbr,status,vnpk_qty,case_pack_qty")
    assert dims.load_dimension(spark, path, dims.CASE_PACK, f"{folder}/out").count() == 1


def test_weather_load(spark, folder):
    path = write(folder, "w.csv", ["SE,0.1,-0.2,0,0,0"], header="Region,TW,NW,M1,M2,M3")
    table = dims.load_weather_forecast(spark, path, f"{folder}/out", "2025-01-06")
    assert tuple(table.first())[:4] == ("SE", dt.date(2025, 1, 6), 0.1, -0.2)
    assert dims.load_weather_forecast(spark, path, f"{folder}/out", "2025-01-13", history=True).count() == 2
    assert dims.load_weather_forecast(spark, path, f"{folder}/out").count() == 1


def test_week_mapping_import(spark, folder):
    path = write(folder, "m.csv", ["n,202501,202402", "n,,202403", "n,x,202404", "n,202505.0,202406"], header="Note,TY Week,LY Week")
    assert sorted(tuple(r)[:2] for r in dims.load_week_mapping(spark, path, f"{folder}/out").collect()) == [(202501, 202402), (202505, 202406)]
    assert dims.detect_week_columns(["Quantity", "ly_week", "ty_week"]) == ("ty_week", "ly_week")
    assert dims.detect_week_columns(["This Year", "Prior"]) == ("This Year", "Prior")
    for headers in (["Week", "Other"], ["Weekly ty"]):
        with pytest.raises(ValueError):
            dims.detect_week_columns(headers)


def test_all_dimensions(spark, folder):
    write(folder, "dim_stores.csv", ["1,TX,S,75001,3"], header="Store Number,State,Region,Zip Code,Merch Zone Number")
    write(folder, "dim_items.csv", ["x,1001,d,s,1.5,2.5,A"], header="f5c_item_number,Subcategory,Description,Style ID,Cost,Retail,Item Status")
    write(folder, "caps.csv", ["x,12"], header="Item,Capacity")
    write(folder, "dim_case_pack.csv", ["x,A,1,2"], header="Item Nbr,Status,vnpk_qty,case_pack_qty")
    write(folder, "fact_forecast_vendor.csv", ["SE,0.1,0.2,0,0,0"], header="region,tw,nw,m1,m2,m3")
    tables = dims.load_all_dimensions(spark, folder, f"{folder}/out", {"dim_capacity": "caps.csv"}, "2025-01-06")
    assert {k: v.count() for k, v in tables.items()} == dict.fromkeys(
        ["dim_stores", "dim_items", "dim_capacity", "dim_case_pack", "fact_forecast_vendor"], 1)
    assert tables["dim_items"].first()["retail"] == 2.5 and tables["dim_capacity"].first()["capacity"] == 12


def test_report_sinks(spark, folder):
    paths = write_report(spark.range(3), folder, "report")
    assert [p.rsplit(".")[-1] for p in paths] == ["csv", "parquet"]
    assert spark.read.option("header", True).csv(paths[0]).count() == spark.read.parquet(paths[1]).count() == 3


def test_one_csv_file_of_a_summary(spark, folder):
    path = write_single_csv(spark.range(30).repartition(4), f"{folder}/summary.csv")
    assert Path(path).is_file() and len(Path(path).read_text().split()) == 31
    write_single_csv(spark.range(2), path)
    assert Path(path).read_text().split() == ["id", "0", "1"]


def test_lines_with_too_many_fields_are_kept_aside(spark, folder):
    table, drop = f"{folder}/table", f"{folder}/drop"
    os.mkdir(drop)
    write(drop, "a.csv", ["202401,1001,1,x,5,V,red,?", "202401,1001,2,x,6,V,red,?,more", '202401,1001,3,x,7,V,"red, dark",?', "202401,1001,4,x,8"])
    write(drop, "b.csv", ["202402,1001,1,x,9,V,red,?,", '202402,1001,2,x,9,V,"a, b",?,c'])
    write(drop, "other.csv", ["1,y,202402,2001"], header="store_number,f5c_item_number,f5c_calendar_week,subcategory_number")
    result = files.initial_load(spark, drop, table)
    assert len(result.loaded) == 3 and {p.split("/")[-1]: n for p, n in result.rejected.items()} == {"a.csv": 1, "b.csv": 2}
    assert [(r[0], r[1], r[3]) for r in rows(spark, table)] == [(202401, "1", 5), (202401, "3", 7), (202401, "4", 8), (202402, "1", None)]
    kept = {r["line"]: (r["field_count"], r["expected_count"]) for r in files.read_rejected(spark, table).collect()}
    assert kept == {"202401,1001,2,x,6,V,red,?,more": (9, 8), "202402,1001,1,x,9,V,red,?,": (9, 8), '202402,1001,2,x,9,V,"a, b",?,c': (9, 8)}
    result = files.weekly_update(spark, [f"{drop}/a.csv", f"{drop}/b.csv"], table)
    assert {p.split("/")[-1]: n for p, n in result.rejected.items()} == {"a.csv": 1, "b.csv": 2}
    assert files.read_rejected(spark, table).count() == 6
    assert files.weekly_update(spark, f"{drop}/other.csv", table).rejected == {}
    empty = write(folder, "empty.csv", [])
    assert files.weekly_update(spark, empty, table).upserted == store.UpsertResult(0, 0)


def test_a_failing_dimension_load_leaves_the_old_table(spark, folder):
    target = f"{folder}/out"
    dims.load_dimension(spark, write(folder, "packs.csv", ["8,B,,"], header="Item Nbr,Status,VNPK Qty,Case Pack Qty"), dims.CASE_PACK, target)
    opened = dims.read_dimension(spark, dims.CASE_PACK, target)
    for wrong in (write(folder, "wrong.csv", ["1,2"], header="Colour,Size"), f"{folder}/absent.csv"):
        with pytest.raises((dims.RejectedLoad, PySparkException)):
            dims.load_dimension(spark, wrong, dims.CASE_PACK, target)
        assert dims.read_dimension(spark, dims.CASE_PACK, target).collect() == opened.collect()
    dims.load_dimension(spark, write(folder, "new.csv", ["9,C,,", "10,C,,"], header="Item Nbr,Status,VNPK Qty,Case Pack Qty"), dims.CASE_PACK, target)
    assert (opened.count(), dims.read_dimension(spark, dims.CASE_PACK, target).count()) == (1, 2)
    with pytest.raises(PySparkException, match="several last-year weeks"):
        dims.load_week_mapping(spark, write(folder, "m.csv", ["202501,202402", "202501,202403"], header="ty_week,ly_week"), f"{folder}/map")
    assert dims.read_dimension(spark, dims.WEEK_MAPPING, f"{folder}/map").count() == 0


def test_all_dimensions_or_none(spark, folder):
    write(folder, "dim_stores.csv", ["1,TX,S,75001,3"], header="Store Number,State,Region,Zip Code,Merch Zone Number")
    write(folder, "dim_items.csv", ["x,1001,d,s,1.5,2.5,A"], header="f5c_item_number,Subcategory,Description,Style ID,Cost,Retail,Item Status")
    write(folder, "dim_capacity.csv", ["x,12"], header="Item,Capacity")
    write(folder, "dim_case_pack.csv", ["x,A,1,2"], header="Wrong,Status,vnpk_qty,case_pack_qty")
    write(folder, "fact_forecast_vendor.csv", ["SE,0.1,0.2,0,0,0"], header="region,tw,nw,m1,m2,m3")
    with pytest.raises(dims.RejectedLoad):
        dims.load_all_dimensions(spark, folder, f"{folder}/out", week_date="2025-01-06")
    assert all(dims.read_dimension(spark, spec, f"{folder}/out/{spec.name}").count() == 0 for spec in (dims.STORES, dims.ITEMS, dims.WEATHER))


def test_weather_of_one_day_is_imported_once(spark, folder):
    header = "Region,TW,NW,M1,M2,M3"
    for day, value in (("2025-01-06", 1), ("2025-01-13", 2), ("2025-01-13", 3)):
        dims.load_weather_forecast(spark, write(folder, "w.csv", [f"SE,{value},0,0,0,0"], header), f"{folder}/out", day, history=True)
    kept = dims.read_dimension(spark, dims.WEATHER, f"{folder}/out").orderBy("week_imported").collect()
    assert [(str(r["week_imported"]), r["tw_pct"]) for r in kept] == [("2025-01-06", 1.0), ("2025-01-13", 3.0)]


def test_compressed_files_are_loaded(spark, folder):
    table, path = f"{folder}/table", f"{folder}/a.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join(["\ufeff" + HEADER, "202401,1001,1,x,5,V,red,?", "202401,1001,2,x,6,V,red,?,more", ""]))
    Path(folder, "torn.csv.gz").write_bytes(b"no archive")
    result = files.weekly_update(spark, [path, f"{folder}/torn.csv.gz"], table)
    assert result.loaded == [path] and list(result.skipped) == [f"{folder}/torn.csv.gz"] and list(result.rejected.values()) == [1]
    assert [r[3] for r in rows(spark, table)] == [5]


def test_weeks_that_one_file_has_are_written_once(spark, folder, monkeypatch):
    table, plans = f"{folder}/table", []
    add = versions.add_folders

    def watched(df, path, partitions=()):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return add(df, path, list(partitions))

    monkeypatch.setattr(versions, "add_folders", watched)
    one = write(folder, "one.csv", ["202401,1001,1,x,5,V,,", "202402,1001,1,x,6,V,,"])
    two = write(folder, "two.csv", ["202403,1001,1,x,7,V,,", "202403,1001,1,x,8,V,,"])
    assert files.weekly_update(spark, [one, two], table).upserted == store.UpsertResult(0, 4)
    assert len(plans) == 1 and plans[0].count("FileScan csv") == 1 and "SortMergeJoin" not in plans[0]
    three = write(folder, "three.csv", ["202402,1001,1,x,60,V,,", "202402,2001,1,x,61,,,", "202402,1001,2,x,62,V,,"])
    assert files.weekly_update(spark, [three, one, two], table).upserted == store.UpsertResult(4, 6)
    assert [r[3] for r in rows(spark, table)] == [5, 6, 61, 62, 7, 8]
    there = {"/".join(part.parts[-3:]) for part in Path(table).glob("*/*/load=*")}
    assert there == {entry for number in (1, 2) for _, entry in versions.open_version(spark, table, number).folders}


def test_an_upsert_leaves_no_shuffle_files(spark, folder):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = blocks.getAllFiles()
        return {name for name in (found.apply(k).getName() for k in range(found.size())) if name.startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    delta, known, before = loader(spark, folder)("a.csv", ["202401,1001,1,x,5,V,,", "202402,1001,1,x,6,V,,"]), shuffled(), spark.conf.get(setting, None)
    store.append_facts(delta, f"{folder}/table")
    until = time.time() + 10
    while (left := shuffled() - known) and time.time() < until:  # Spark deletes them beside the next query
        time.sleep(0.1)
    assert not left and spark.conf.get(setting, None) == before
