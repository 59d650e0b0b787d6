"""Tables shared by the registered queries of one application."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shelfcast.operators.calendar import Period, resolve_period
from shelfcast.plans.tables import RetailTables
from shelfcast.sources.demo import DemoTables
from shelfcast.sources.durable import ensure_checkpoint_folder
from shelfcast.sources.fact_store import append_facts, read_pos_all


class Workspace:
    """Demo tables over one folder, loaded once per application.

    As in a real run, facts and dimensions are loaded first and reports read the
    loaded tables: the facts partitioned by week, so that scans are pruned.  They
    go to the session's shared checkpoint folder.
    """

    _open: dict[tuple[str, str], "Workspace"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.demo = DemoTables(spark, folder)

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Workspace":
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        return cls._open[key]

    def new_folder(self, name: str) -> str:
        """A fresh path in the shared folder."""
        return f"{ensure_checkpoint_folder(self.spark).rstrip('/')}/shelfcast-{name}-{uuid.uuid4().hex}"

    @cached_property
    def facts(self) -> DataFrame:
        path = self.new_folder("facts")
        append_facts(self.demo.facts, path, dealt=True)
        return read_pos_all(self.spark, path)

    @cached_property
    def period(self) -> Period:
        return resolve_period(self.facts, self.tables.week_map)

    @cached_property
    def tables(self) -> RetailTables:
        folder = self.new_folder("tables")
        loaded = {}
        for name in ("stores", "style", "case_pack", "week_map", "weather", "client_forecast"):
            path = f"{folder}/{name}"
            getattr(self.demo, name).write.parquet(path)
            loaded[name] = self.spark.read.parquet(path)
        return RetailTables(self.facts, **loaded)
