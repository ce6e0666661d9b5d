"""Baseline forecasters (B1-B4) and the nearest-week as-of join.

Every forecaster is a grouped job over ``keys`` (default ``sku_id``; the
walk-forward CV adds ``fold``) that anchors on each group's last history
week and projects ``horizon`` weeks forward. Nothing is collected: the
catalogue-wide forecast is one DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import (
    INTERVAL_STD_FALLBACK,
    INTERVAL_Z,
    MOVING_AVERAGE_WINDOW,
    SEASON_WEEKS,
)
from weekcast.operators.splits import last_n_rows


def weeks_after(anchor: Column, steps: Column) -> Column:
    return F.date_add(anchor, steps * 7)


def _h(horizon: int | str) -> Column:
    """A horizon is a fixed int or the name of a per-group column (e.g. fold size)."""
    return F.col(horizon) if isinstance(horizon, str) else F.lit(horizon)


def _carry(horizon: int | str) -> list[Column]:
    return [F.max(horizon).alias(horizon)] if isinstance(horizon, str) else []


def expand_horizon(fit: DataFrame, horizon: int | str, keys=("sku_id",)) -> DataFrame:
    """one row per (group, step 1..h) with week = last week + step weeks."""
    return (fit.withColumn("step", F.explode(F.sequence(F.lit(1), _h(horizon))))
            .withColumn("week", weeks_after(F.col("last_week"), F.col("step"))))


def naive(history: DataFrame, horizon: int | str, keys=("sku_id",)) -> DataFrame:
    """B1: last non-null demand repeated over the horizon (0 if none)."""
    last = F.expr("max_by(demand, week) FILTER (WHERE demand IS NOT NULL)")
    fit = history.groupBy(*keys).agg(F.coalesce(last, F.lit(0.0)).alias("p50"), F.max("week").alias("last_week"),
                                     *_carry(horizon))
    return expand_horizon(fit, horizon, keys).select(*keys, "week", "p50")


def moving_average(history: DataFrame, horizon: int | str, window: int = MOVING_AVERAGE_WINDOW,
                   keys=("sku_id",)) -> DataFrame:
    """B2: mean of the last ``window`` rows (null counted as 0), repeated."""
    extra = [horizon] if isinstance(horizon, str) else []
    tail = last_n_rows(history.select(*keys, "week", "demand", *extra), window, keys)
    fit = tail.groupBy(*keys).agg(F.avg(F.coalesce("demand", F.lit(0.0))).alias("p50"),
                                  F.max("week").alias("last_week"), *_carry(horizon))
    return expand_horizon(fit, horizon, keys).select(*keys, "week", "p50")


def nearest_asof(targets: DataFrame, history: DataFrame, keys=("sku_id",),
                 target_col: str = "target_week", value_col: str = "demand") -> DataFrame:
    """For each target row, the history row of the same group whose week is
    nearest to ``target_col`` by absolute days; ties go to the earlier week.

    History and targets are unioned; the previous and next history rows come
    from two running frames, one in each direction of time. The cost is one
    shuffle and two sorts per group, with no pairing of targets and history
    rows and no cap on how far apart they may be.
    """
    hist = history.select(*keys, F.col("week").alias("_t"), F.lit(0).alias("_kind"),
                          F.struct(F.col("week").alias("w"), F.col(value_col).alias("v")).alias("_h"),
                          F.lit(None).cast("date").alias("week"))
    tgt = targets.select(*keys, F.col(target_col).alias("_t"), F.lit(1).alias("_kind"),
                         F.lit(None).cast("struct<w:date,v:double>").alias("_h"), "week")
    w = Window.partitionBy(*keys).orderBy("_t", "_kind")
    before = F.last("_h", True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    back = Window.partitionBy(*keys).orderBy(F.col("_t").desc(), F.col("_kind").desc())
    after = F.last("_h", True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = hist.unionByName(tgt).select("*", before.alias("_prev"), after.alias("_next"))
    d_prev = F.datediff(F.col("_t"), F.col("_prev.w"))
    d_next = F.datediff(F.col("_next.w"), F.col("_t"))
    take_prev = F.col("_next").isNull() | (F.col("_prev").isNotNull() & (d_prev <= d_next))
    chosen = F.when(take_prev, F.col("_prev")).otherwise(F.col("_next"))
    return (both.filter(F.col("_kind") == 1)
            .select(*keys, "week", F.col("_t").alias(target_col),
                    chosen["w"].alias("matched_week"), chosen["v"].alias("matched_value")))


def seasonal_naive(history: DataFrame, horizon: int | str, season_weeks: int = SEASON_WEEKS,
                   keys=("sku_id",)) -> DataFrame:
    """Value of the history week nearest to (forecast week - 52 weeks)."""
    extra = [horizon] if isinstance(horizon, str) else []
    hist = history.select(*keys, "week", F.coalesce("demand", F.lit(0.0)).alias("demand"), *extra)
    anchors = hist.groupBy(*keys).agg(F.max("week").alias("last_week"), *_carry(horizon))
    targets = (expand_horizon(anchors, horizon, keys)
               .withColumn("target_week", F.date_sub(F.col("week"), 7 * season_weeks)))
    matched = nearest_asof(targets, hist, keys)
    return matched.select(*keys, "week", F.coalesce("matched_value", F.lit(0.0)).alias("p50"))


def rolling_interval_forecast(features: DataFrame, horizon: int = 8) -> DataFrame:
    """Interval view from rolling statistics of each SKU's last rows.

    p50 = 4-week rolling mean (else the median demand of those rows),
    sigma = 4-week rolling std (else 0.12 * p50), p10/p90 = p50 -/+ 1.28 sigma
    (p10 >= 0); the i-th of the last rows maps to last week + i weeks.
    """
    tail = last_n_rows(features.select("sku_id", "week", "demand", "rolling_mean_4w", "rolling_std_4w"),
                       horizon)
    per = Window.partitionBy("sku_id")
    order = Window.partitionBy("sku_id").orderBy("week")
    p50 = F.coalesce(F.col("rolling_mean_4w"), F.median("demand").over(per))
    std = F.coalesce(F.col("rolling_std_4w"), p50 * INTERVAL_STD_FALLBACK)
    return (tail
            .select("sku_id", p50.alias("p50"), std.alias("_std"),
                    weeks_after(F.max("week").over(per), F.row_number().over(order)).alias("week"))
            .select("sku_id", "week",
                    F.greatest(F.col("p50") - INTERVAL_Z * F.col("_std"), F.lit(0.0)).alias("p10"),
                    "p50",
                    (F.col("p50") + INTERVAL_Z * F.col("_std")).alias("p90")))
