"""Reporting aggregates over the feature table.

All are grouped aggregations with map-side partial aggregation; the few
global orderings run over per-group results (weeks, SKUs, categories), never
over raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import CALENDAR_FEATURES, PROMO_HOLIDAY_FEATURES
from weekcast.operators.cumulative import exact_quantiles

ZERO_RATIO_BINS = 30


def _is_zero(col: str = "demand") -> Column:
    """Null counts as 'not zero' and stays in the denominator."""
    return F.coalesce(F.col(col) == 0, F.lit(False)).cast("double")


def weekly_totals(features: DataFrame) -> DataFrame:
    """Per week mean, sum (0 when all null) and sample std of demand."""
    return features.groupBy("week").agg(
        F.avg("demand").alias("mean_demand"),
        F.coalesce(F.sum("demand"), F.lit(0.0)).alias("total_demand"),
        F.stddev_samp("demand").alias("std_demand"))


def category_mix(meta: DataFrame) -> DataFrame:
    """SKUs per category, descending."""
    return meta.groupBy("category").agg(F.count("*").alias("n_skus")).orderBy(F.desc("n_skus"), "category")


def demand_box_by_category(features: DataFrame) -> DataFrame:
    """Exact quartiles and mean of non-null demand per category.

    Quantiles come from ``exact_quantiles`` (distributed running sums over
    value counts), since one category may hold a large share of all rows.
    """
    rows = features.filter(F.col("category").isNotNull() & F.col("demand").isNotNull())
    q = exact_quantiles(rows, "demand", {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0},
                        ["category"])
    stats = rows.groupBy("category").agg(F.count("*").alias("n"), F.avg("demand").alias("mean"))
    return stats.join(q, "category").select("category", "n", "min", "q1", "median", "q3", "max", "mean")


def sku_stats(features: DataFrame) -> DataFrame:
    """Per SKU average, max, zero share, stockout weeks, promo weeks (all SKUs)."""
    return features.groupBy("sku_id").agg(
        F.avg("demand").alias("avg_demand"),
        F.max("demand").alias("max_demand"),
        F.avg(_is_zero()).alias("zero_share"),
        F.sum("stockout_flag").cast("long").alias("stockout_weeks"),
        F.sum("promotion_flag").cast("long").alias("promo_weeks"))


def weekly_by_category(features: DataFrame) -> DataFrame:
    """A10: mean demand per (week, category)."""
    return (features.filter(F.col("category").isNotNull())
            .groupBy("week", "category").agg(F.avg("demand").alias("mean_demand")))


def zero_ratio_histogram(features: DataFrame, bins: int = ZERO_RATIO_BINS) -> DataFrame:
    """Counts of zero_demand_ratio_12w in ``bins`` equal bins over [0, 1] per category."""
    x = F.col("zero_demand_ratio_12w")
    b = F.least(F.lit(bins - 1), F.floor(x * bins)).cast("int")
    return (features.filter(x.isNotNull() & F.col("category").isNotNull())
            .groupBy("category", b.alias("bin")).agg(F.count("*").alias("n")))


def intermittency_summary(features: DataFrame) -> DataFrame:
    """Per category mean / median / sample std of the zero ratio, 3 dp."""
    z = F.col("zero_demand_ratio_12w")
    rows = features.filter(F.col("category").isNotNull())
    med = exact_quantiles(rows, "zero_demand_ratio_12w", {"median": 0.5}, ["category"])
    stats = rows.groupBy("category").agg(F.round(F.avg(z), 3).alias("mean_zero_ratio"),
                                         F.round(F.stddev_samp(z), 3).alias("std_zero_ratio"))
    return stats.join(med, "category", "left").select(
        "category", "mean_zero_ratio", F.round("median", 3).alias("median_zero_ratio"), "std_zero_ratio")


def demand_by_region(features: DataFrame) -> DataFrame:
    """Mean / sum / non-null count of demand per region (null region dropped)."""
    return (features.filter(F.col("supplier_region").isNotNull()).groupBy("supplier_region").agg(
        F.avg("demand").alias("mean_demand"),
        F.coalesce(F.sum("demand"), F.lit(0.0)).alias("total_demand"),
        F.count("demand").alias("n_rows")))


def distinct_skus(features: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct SKU count (HyperLogLog++ when ``approximate``)."""
    c = F.approx_count_distinct("sku_id") if approximate else F.countDistinct("sku_id")
    return features.agg(c.alias("n_skus"))


def top_skus(features: DataFrame, n: int = 20) -> DataFrame:
    """K2: top-n SKUs by mean demand (SKU id breaks ties).

    The per-SKU means are computed first; only those (one row per SKU) are
    ordered, and ``orderBy().limit()`` plans as a distributed top-k.
    """
    per = (features.filter(F.col("category").isNotNull())
           .groupBy("sku_id", "category").agg(F.avg("demand").alias("mean_demand")))
    return per.orderBy(F.col("mean_demand").desc_nulls_last(), "sku_id").limit(n)


def feature_group(col: str = "feature") -> Column:
    """feature name -> dashboard group."""
    c = F.col(col)
    return (F.when(c.startswith("lag_"), "lag")
            .when(c.startswith("rolling_"), "rolling")
            .when(c.startswith("demand_change"), "velocity")
            .when(c.isin(*CALENDAR_FEATURES), "seasonality")
            .when(c.isin(*PROMO_HOLIDAY_FEATURES), "promo_holiday")
            .otherwise("other"))


def importance_share(importance: DataFrame, n: int = 20) -> DataFrame:
    """Top-n features by importance, share of the shown total in %."""
    top = importance.orderBy(F.col("importance").desc(), "feature").limit(n)
    total = Window.partitionBy()
    return top.select("feature", "importance",
                      (F.col("importance") / F.sum("importance").over(total) * 100).alias("importance_pct"),
                      feature_group().alias("group"))


def leaderboard_kpis(board: DataFrame, production_pattern: str = "LightGBM",
                     ml_pattern: str = "LightGBM|XGBoost") -> DataFrame:
    """Production WAPE and coverage, best baseline WAPE and the gap."""
    prod = F.col("model").rlike(production_pattern)
    base = ~F.col("model").rlike(ml_pattern)
    return board.agg(
        F.min(F.when(prod, F.col("wape"))).alias("production_wape"),
        F.min(F.when(prod, F.col("coverage_80pct"))).alias("production_coverage"),
        F.min(F.when(base, F.col("wape"))).alias("best_baseline_wape"),
    ).withColumn("gap_pp", F.col("best_baseline_wape") - F.col("production_wape"))
