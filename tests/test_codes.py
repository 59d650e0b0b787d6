"""Codes of the derived retail tables stay apart for any number of items."""

from pyspark.sql import functions as F

from shelfcast.sources import demo


def test_long_numbers_keep_all_digits(spark):
    numbers = spark.range(99_990, 100_010).select("id", demo._code("I", F.col("id")).alias("code"))
    found = {row["id"]: row["code"] for row in numbers.collect()}
    assert len(set(found.values())) == 20 and found[99_999] == "I99999" and found[100_001] == "I100001"
    assert spark.range(1).select(demo._code("ST", F.lit(7)).alias("code")).first()["code"] == "ST00007"


def test_item_columns_are_unique_beyond_five_digits(spark):
    items = spark.range(100_000, 100_100).toDF("i").withColumns(demo._item_columns(F.col("i")))
    assert items.select("item").distinct().count() == 100
    assert items.where("style is not null").select("style").distinct().count() > 30
