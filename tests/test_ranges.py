"""The merged ranges of the adaptive ranking keep the global order."""

from pyspark.sql import functions as F

from shelfcast.operators.grouping import running_total


def test_adaptive_ranges_give_the_same_running_total(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        rows = spark.range(60000).select(
            F.col("id").cast("string").alias("k"),
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("decimal(20,6)").alias("v"),
        )
        ranked = running_total(rows, "v", [F.desc("v"), F.asc("k")])
        got = ranked.orderBy(F.desc("v"), F.asc("k")).select("v", "running", "grand_total").toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(got) == 60000
    assert (got["running"].astype(float) == got["v"].astype(float).cumsum()).all()
    assert (got["grand_total"].astype(float) == got["v"].astype(float).sum()).all()
