"""Forecasts for SKUs without history (E11): a hierarchy of means, SKU, category, global.

Off unless a caller asks for it: the forecasters and the batch scorer leave
unknown SKUs out, as the analysed workload does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.operators.baselines import expand_horizon


def prior_means(history: DataFrame) -> DataFrame:
    """(category, mean): mean known demand of each category, and of all rows under a null category.

    One grouping-sets aggregate, combined map-side; rows of SKUs without a
    category only count for all.
    """
    known = history.filter(F.col("demand").isNotNull()).select("category", "demand")
    return (known.groupingSets([["category"], []], "category").agg(F.avg("demand").alias("mean"), F.grouping("category").alias("_all"))
            .filter((F.col("_all") == 1) | F.col("category").isNotNull()).select("category", "mean"))


def with_prior(skus: DataFrame, history: DataFrame) -> DataFrame:
    """``skus`` (sku_id, category, ...) with ``prior`` and ``prior_level``: the category's mean, else the global one, else 0.

    The means are as many as categories; the join is left to the optimizer.
    """
    means = prior_means(history)
    whole = means.filter(F.col("category").isNull()).agg(F.max("mean").alias("_global"))
    by_category = means.filter(F.col("category").isNotNull()).withColumnRenamed("mean", "_category_mean")
    joined = skus.join(by_category, "category", "left").join(F.broadcast(whole))            # one row
    return joined.select(*skus.columns, F.coalesce("_category_mean", "_global", F.lit(0.0)).alias("prior"),
                         F.when(F.col("_category_mean").isNotNull(), "category").when(F.col("_global").isNotNull(), "global").otherwise("none").alias("prior_level"))


def with_cold_start(forecasts: DataFrame, history: DataFrame, skus: DataFrame, horizon: int | Column) -> DataFrame:
    """B1-B3 for all of ``skus`` (sku_id, category): (sku_id, week, p50, level).

    SKUs that ``forecasts`` covers keep their rows (level ``sku``); the others
    get their prior over ``horizon`` weeks after the history's last week.
    """
    last = history.agg(F.max("week").alias("last_week"))
    absent = skus.dropDuplicates(["sku_id"]).join(forecasts.select("sku_id").distinct(), "sku_id", "left_anti")
    cold = with_prior(absent, history).join(F.broadcast(last)).filter(F.col("last_week").isNotNull())       # one row
    cold = expand_horizon(cold.withColumn("_h", horizon if isinstance(horizon, Column) else F.lit(horizon)), "_h")
    return (forecasts.select("sku_id", "week", "p50", F.lit("sku").alias("level"))
            .unionByName(cold.select("sku_id", "week", F.col("prior").alias("p50"), F.col("prior_level").alias("level"))))


def score_unknown(unknown: DataFrame, history: DataFrame, skus: DataFrame) -> DataFrame:
    """B8 for requests of SKUs without history: a frame as ``interval_fallback`` takes it, p50 from the prior.

    ``unknown`` is (request_id, sku_id, horizon_weeks, include_intervals). A SKU
    that ``skus`` doesn't have either gets the global mean.
    """
    last = history.agg(F.max("week").alias("last_week"))
    named = unknown.join(skus.select("sku_id", "category").dropDuplicates(["sku_id"]), "sku_id", "left")
    cold = with_prior(named, history).join(F.broadcast(last)).filter(F.col("last_week").isNotNull())        # one row
    return expand_horizon(cold, "horizon_weeks").withColumn("p50", F.col("prior"))
