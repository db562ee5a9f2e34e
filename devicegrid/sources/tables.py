"""Scans of the driver's Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class Tables:
    """Lazy access to ``<sf_dir>/<name>.parquet``.

    Reads are plain ``spark.read.parquet`` scans: later ``select``/``filter``
    calls are pushed into the scan by Catalyst (``ReadSchema`` and
    ``PushedFilters`` in the plan), so nothing here reads whole rows eagerly.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.read(name)
        raise AttributeError(name)
