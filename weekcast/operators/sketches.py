"""Mergeable sketches for the reports (A14, A8): one small row per week, merged over any span of weeks.

Distinct counts by HyperLogLog (relative error about 1.6 % at 12 bits), quantiles
by KLL (rank error about 1.3 % at k = 200). The exact forms stay in ``reports``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HLL_BITS = 12
KLL_K = 200


def weekly_sku_sketches(features: DataFrame) -> DataFrame:
    """(week, skus): a sketch of the SKUs seen in each week."""
    return features.groupBy("week").agg(F.hll_sketch_agg("sku_id", F.lit(HLL_BITS)).alias("skus"))


def distinct_from_sketches(sketches: DataFrame) -> DataFrame:
    """About how many SKUs all the weeks together saw; 0 without weeks."""
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("skus")), F.lit(0)).cast("long").alias("n_skus"))


def weekly_demand_sketches(features: DataFrame) -> DataFrame:
    """(category, week, n, demand): a sketch of the known demands of each category and week."""
    rows = features.filter(F.col("category").isNotNull() & F.col("demand").isNotNull())
    return rows.groupBy("category", "week").agg(F.count("*").alias("n"), F.kll_sketch_agg_double(F.col("demand").cast("double"), F.lit(KLL_K)).alias("demand"))


def box_from_sketches(sketches: DataFrame) -> DataFrame:
    """A8 from merged sketches: (category, n, q1, median, q3)."""
    whole = sketches.groupBy("category").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("demand").alias("demand"))
    at = lambda q: F.kll_sketch_get_quantile_double("demand", F.lit(q))
    return whole.select("category", "n", at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3"))
