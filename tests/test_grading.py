import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import grading, grouping

ROWS = "store_number string, f5c_item_number string, baseline_weekly_sales double"


@pytest.mark.parametrize("slices", [None, 1, 3, 16])
def test_running_share_equals_a_global_window_with_hot_ties(frame, slices):
    """A third of all rows tie at one value; ties are split over slices."""
    rng = random.Random(11)
    rows = [(str(n % 5), f"i{n:04d}", 2.5 if n % 3 == 0 else rng.randint(0, 40) / 8) for n in range(900)] + [("9", "none", None)]
    order = sorted((r for r in rows if r[2] is not None), key=lambda r: (-r[2], r[0], r[1]))
    total, running, expected = sum(Decimal(str(r[2])) for r in order), Decimal(0), {}
    for store, item, value in order:
        running += Decimal(str(value))
        share = running * 100 / total
        expected[(store, item)] = ("A" if share <= 20 else "B" if share <= 50 else "C" if share <= 95 else "D", float(share))
    expected[("9", "none")] = ("D", None)
    graded = grading.abc_grade(frame(rows, ROWS).repartition(7), (20, 50, 95), slices=slices).collect()
    assert len(graded) == len(rows)
    for r in graded:
        label, share = expected[(r["store_number"], r["f5c_item_number"])]
        assert r["store_item_grade"] == label
        assert r["cumulative_pct"] == (None if share is None else pytest.approx(share))
    assert max(r["cumulative_pct"] for r in graded if r["cumulative_pct"] is not None) == pytest.approx(100)


def test_nothing_sold_means_grade_d(frame):
    graded = grading.abc_grade(frame([("1", "a", 0.0), ("1", "b", None)], ROWS), (20, 50, 95)).collect()
    assert [(r["store_item_grade"], r["cumulative_pct"]) for r in graded] == [("D", 0.0), ("D", 0.0)]


def test_empty_input_stays_empty(frame):
    assert grading.abc_grade(frame([], ROWS), (20, 50, 95)).collect() == []


DETAIL = "region string, state string, store_number string, baseline_weekly_sales double, projected_weekly_sales double, push_units bigint, current_wos double"


def test_store_clusters(frame):
    rows = [("r", "s", str(n), float(v), 1.0, 2, 4.0) for n, v in enumerate((20, 30, 29, 21))] + [(None, "s", "9", 50.0, 1.0, 2, 4.0)]
    detail = frame(rows, DETAIL)
    clusters = grading.store_clusters(detail)
    assert {r["store_number"]: r["store_cluster"] for r in clusters.collect()} == {"1": "Next 30%", "2": "Next 30%", "3": "Next 30%", "0": "Bottom 20%"}
    joined = {r["store_number"]: r["store_cluster"] for r in grading.attach_clusters(detail, clusters).collect()}
    assert joined["9"] is None and joined["1"] == "Next 30%"


def test_no_sales_no_clusters(frame):
    clusters = grading.store_clusters(frame([("r", "s", "1", 0.0, 1.0, 2, 4.0)], DETAIL)).collect()
    assert [(r["store_cluster"], r["store_cumulative_pct"]) for r in clusters] == [(None, None)]


def test_group_totals_ignore_null_keys(frame):
    df = frame([("a", 1), ("a", 2), (None, 5)], "k string, v bigint")
    rows = {r["v"]: r["total"] for r in grouping.with_group_totals(df, ["k"], total="v").collect()}
    assert rows == {1: 3, 2: 3, 5: None}


def test_grades_fall_with_baseline(frame):
    graded = grading.abc_grade(frame([("1", f"i{n}", float(n)) for n in range(50)], ROWS), (50, 80, 95))
    labels = [r["store_item_grade"] for r in graded.orderBy(F.desc("baseline_weekly_sales")).collect()]
    assert labels == sorted(labels)


def formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanges(df) -> list[str]:
    """Input columns and arguments of each exchange of a plan."""
    return re.findall(r"\) Exchange\nInput \[\d+\]: (.*?)\n\n", formatted(df), re.S)


def test_only_the_ranked_columns_are_dealt_into_slices(spark, frame):
    rows = [("1", f"i{n}", float(n % 7), f"text {n}") for n in range(60)]
    with_broadcasts_off(spark, lambda: check_slices(frame(rows, ROWS + ", wide string")))


def check_slices(df):
    found = exchanges(grading.abc_grade(df, (20, 50, 95)))
    slices = [text for text in found if "_slice" in text]
    assert slices and not any("wide" in text for text in slices)
    assert sum("wide" in text for text in found) == 1  # of the join by key


def with_broadcasts_off(spark, run):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_totals_after_a_join_by_the_same_key_are_combined_before_an_exchange(spark, frame):
    """A third of all rows have one key; the join before the totals deals rows out by it."""
    rows = [("hot" if n % 3 == 0 else f"k{n % 50}", n) for n in range(3000)]

    def check():
        joined = frame(rows, "k string, v bigint").join(frame([("hot", 1)] + [(f"k{n}", 2) for n in range(50)], "k string, w bigint"), "k")
        totals = grouping.with_group_totals(joined, ["k"], total="v")
        text = formatted(totals)
        assert "partial_sum(v" in text and any("hashpartitioning(_group" in found and "sum#" in found for found in exchanges(totals))
        expected = {}
        for key, value in rows:
            expected[key] = expected.get(key, 0) + value
        assert {(r["k"], r["v"]): r["total"] for r in totals.collect()} == {(key, value): expected[key] for key, value in rows}

    with_broadcasts_off(spark, check)


def test_rows_equal_in_value_and_key_are_not_multiplied(frame):
    rows = [("1", "a", 2.0), ("1", "a", 2.0), ("1", "a", 1.0), ("2", "b", 5.0), (None, "c", 1.0), (None, "c", 1.0)]
    graded = grading.abc_grade(frame(rows, ROWS), (20, 50, 95)).collect()
    assert sorted((str(r["store_number"]), r["baseline_weekly_sales"], round(r["cumulative_pct"], 2)) for r in graded) == [
        ("1", 1.0, 100.0), ("1", 2.0, 75.0), ("1", 2.0, 75.0), ("2", 5.0, 41.67), ("None", 1.0, 91.67), ("None", 1.0, 91.67),
    ]


def test_groups_are_ranked_apart(frame):
    rows = [(g, str(n % 3), f"i{n}", float(n + 1)) for g in ("x", "y") for n in range(20 if g == "x" else 7)]
    df = frame(rows, "g string, " + ROWS)
    together = grading.abc_labels(grading.abc_running(df, ["g"], slices=4), (20, 50, 95))
    for g in ("x", "y"):
        alone = grading.abc_grade(df.where(F.col("g") == g), (20, 50, 95))
        assert sorted(map(str, together.where(F.col("g") == g).select(alone.columns).collect())) == sorted(map(str, alone.collect()))
