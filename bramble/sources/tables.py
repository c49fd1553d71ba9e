"""Readers for the driver's Parquet tables.

Each table is read lazily with ``spark.read.parquet``: Catalyst prunes the columns a
query does not use and pushes filters into the scan (see ``explain()`` ReadSchema /
PushedFilters). Nothing is cached here.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem`` -> DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        path = os.path.join(self.sf_dir, f"{name}.parquet")
        return self.spark.read.parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            df = self.read(name)
            self.__dict__[name] = df
            return df
        raise AttributeError(name)

    @cached_property
    def fixtures(self):
        from bramble.sources.fixtures import Fixtures
        return Fixtures(self)
