"""Shared inputs for catalogue queries: driver tables -> panel, dimension, features."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from weekcast.operators.dense import DenseFeatures
from weekcast.operators.features import build_features
from weekcast.sources import panel as P
from weekcast.sources import store, tables

TASK_BYTES = 2 << 20        # of lineitem's files for each task; as a dense panel a hundred times as much
TASK_BUCKETS = 32           # buckets of SKUs a task makes the features of one after the other


@dataclass
class Inputs:
    spark: SparkSession
    sf_dir: str
    key: str = "brand_type"
    materialized: bool = True

    @cached_property
    def fingerprint(self) -> str:
        base = self.sf_dir.rstrip("/")
        fp = store.input_fingerprint(self.spark, [f"{base}/lineitem.parquet", f"{base}/part.parquet"])
        return f"{self.key}-{fp}"

    def keep(self, build: Callable[[], DataFrame], name: str, yearly: bool = False) -> DataFrame:
        """A shared input, stored once (see ``weekcast.sources.store``); built only where the store lacks it."""
        return store.materialize(self.spark, build, name, self.fingerprint, yearly) if self.materialized else build()

    @cached_property
    def lineitem(self) -> DataFrame:
        return tables.lineitem(self.spark, self.sf_dir)

    @cached_property
    def part(self) -> DataFrame:
        return tables.part(self.spark, self.sf_dir)

    @cached_property
    def weekly(self) -> DataFrame:
        return P.weekly_quantities(self.lineitem, self.part, self.key, self.tasks)

    @property
    def tasks(self) -> int | None:
        """Tasks for the panel with one SKU per part, by the size of ``lineitem``: a task's dense rows fit its memory (None: left to AQE)."""
        if self.key != "part":
            return None
        size = store.input_bytes(self.spark, f"{self.sf_dir.rstrip('/')}/lineitem.parquet")
        return max(self.spark.sparkContext.defaultParallelism, size // TASK_BYTES + 1)

    @cached_property
    def calendar(self) -> DataFrame:
        return P.week_calendar(self.lineitem)

    @cached_property
    def panel(self) -> DataFrame:
        return self.keep(lambda: P.observed_demand(P.dense_panel(self.weekly, self.calendar)), "panel")

    @cached_property
    def meta(self) -> DataFrame:
        # the sparse weeks have the same SKUs as the panel that is made of them
        active = self.panel if self.materialized else self.weekly
        return self.keep(lambda: P.sku_dimension(self.part, active, self.key), "sku_dimension")

    @cached_property
    def features(self) -> DataFrame:
        return self.keep(lambda: build_features(self.panel, self.meta), "features", yearly=True)

    @cached_property
    def dense_features(self) -> DenseFeatures:
        """The rows of ``features`` for one SKU per part, made for a bucket of SKUs at a time, with the columns that are asked for."""
        buckets = self.tasks * TASK_BUCKETS
        return DenseFeatures(P.weekly_quantities(self.lineitem, self.part, self.key, self.tasks, buckets), self.meta, self.calendar, buckets)

    @cached_property
    def model_rows(self) -> DataFrame:
        """Feature rows with a known target (N1: null demand dropped after features)."""
        return self.features.dropna(subset=["demand"])
