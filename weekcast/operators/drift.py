"""Drift checks, demand shocks and the action rule.

The two-sample KS statistic is exact and distributed: values are first
collapsed to (feature, value) counts per side (ties and hot values are
combined map-side), then the empirical CDFs are built with the prefix sums of
``cumulative`` -- windows over the digits of a value's order code -- so no task
ever holds all values of a feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import (
    DATA_DRIFT_RETRAIN,
    DATA_DRIFT_WARNING,
    DRIFT_FEATURES,
    PERF_DEGRADATION_THRESHOLD,
    PERF_RECENT_WEEKS,
    PVALUE_THRESHOLD,
)
from weekcast.functions.stats import ks_pvalue
from weekcast.operators.cumulative import one_row_attach, running_sums
from weekcast.operators.dense import DenseFeatures
from weekcast.operators.evaluation import wape_column
from weekcast.operators.splits import in_week_set, latest_weeks





def _long(df: DataFrame, cols: list[str], side: int) -> DataFrame:
    """(feature, value, side) with nulls dropped."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    long = wide.unpivot([], cols, "feature", "value")   # one pass (Expand), not one scan per column
    return long.filter(F.col("value").isNotNull()).withColumn("side", F.lit(side))


def _counted(df: DataFrame | DenseFeatures, cols: list[str], side: int) -> DataFrame:
    """(feature, value, n, side); values of features not made yet are counted where they are made."""
    if isinstance(df, DenseFeatures):
        return df.select(*cols).value_counts().withColumn("side", F.lit(side))
    return _long(df, cols, side).withColumn("n", F.lit(1).cast("long"))


def ks_two_sample(reference: DataFrame | DenseFeatures, current: DataFrame, features: list[str],
                  cur_features: list[str] | None = None) -> DataFrame:
    """Per feature n_ref, n_cur, ks_statistic, p_value.

    ``cur_features`` names the current-side columns when they differ
    (prediction drift compares reference ``demand`` with current ``p50``).
    A feature with an empty side is skipped (no row).
    """
    cur_features = cur_features or features
    cur = current.select(*[F.col(c).alias(f) for f, c in zip(features, cur_features)])
    both = _counted(reference, features, 0).unionByName(_counted(cur, features, 1))
    counts = both.groupBy("feature", "value").agg(
        F.sum(F.col("n") * (1 - F.col("side"))).alias("c_ref"), F.sum(F.col("n") * F.col("side")).alias("c_cur"))
    sizes = counts.groupBy("feature").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
    cum = running_sums(counts, ["feature"], "value", ["c_ref", "c_cur"])
    cdf = cum.join(sizes, "feature").select(
        "feature", "n_ref", "n_cur",
        (F.col("cum_c_ref") / F.col("n_ref")).alias("f_ref"),
        (F.col("cum_c_cur") / F.col("n_cur")).alias("f_cur"))
    stat = (cdf.filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
            .groupBy("feature", "n_ref", "n_cur")
            .agg(F.max(F.abs(F.col("f_ref") - F.col("f_cur"))).alias("ks_statistic")))
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_cur"))
    return stat.select("feature", "n_ref", "n_cur", "ks_statistic", p.alias("p_value"),
                       (p < PVALUE_THRESHOLD).alias("drifted"))


def data_drift_status(ks: DataFrame, n_available: int) -> DataFrame:
    """Drift fraction over the available features and the status rule."""
    frac = F.sum(F.col("drifted").cast("int")) / F.lit(float(n_available)) if n_available else F.lit(0.0)
    agg = ks.agg(F.coalesce(F.sum(F.col("drifted").cast("int")), F.lit(0)).cast("long").alias("n_drifted"),
                 F.coalesce(frac, F.lit(0.0)).alias("drift_fraction"))
    status = (F.when(F.col("drift_fraction") >= DATA_DRIFT_RETRAIN, "retrain")
              .when(F.col("drift_fraction") >= DATA_DRIFT_WARNING, "warning").otherwise("ok"))
    return agg.select(F.lit(n_available).cast("int").alias("n_features"), "n_drifted", "drift_fraction",
                      status.alias("status"))


def prediction_drift(reference: DataFrame, current: DataFrame, like_for_like: bool = False) -> DataFrame:
    """KS on p50 (or demand when a side has no p50); 'skipped' if a side is empty.

    ``like_for_like`` compares predictions with predictions only: 'skipped'
    when just one side has them.
    """
    ref_col = "p50" if "p50" in reference.columns else "demand"
    cur_col = "p50" if "p50" in current.columns else "demand"
    if like_for_like and ref_col != cur_col:
        current = current.limit(0)
    ks = ks_two_sample(reference.select(F.col(ref_col).alias("x")), current.select(F.col(cur_col).alias("x")), ["x"])
    one = reference.sparkSession.range(1).select(F.lit(1).alias("_k"))
    out = one.join(F.broadcast(ks.withColumn("_k", F.lit(1))), "_k", "left")
    status = (F.when(F.col("ks_statistic").isNull(), "skipped")
              .when(F.col("drifted"), "drift").otherwise("ok"))
    return out.select(status.alias("status"), "ks_statistic", "p_value", "drifted")


def performance_drift(predictions: DataFrame, baseline_wape: float,
                      weeks: int = PERF_RECENT_WEEKS) -> DataFrame:
    """WAPE on the last ``weeks`` distinct weeks vs the baseline WAPE; 'skipped' without predictions or rows."""
    if "p50" not in predictions.columns:
        predictions = predictions.withColumn("p50", F.lit(None).cast("double")).limit(0)
    recent = in_week_set(predictions, latest_weeks(predictions, weeks))
    wape = wape_column()
    base = F.lit(float(baseline_wape))
    deg = (F.col("recent_wape") - base) / (base + 1e-8)
    dropped = F.count(F.when(F.col("demand").isNull() | F.col("p50").isNull(), 1))
    return recent.agg(wape.alias("recent_wape"), dropped.alias("n_dropped_pairs"), F.count("*").alias("n_rows")).select(
        (F.when(F.col("n_rows") == 0, "skipped").when(deg > PERF_DEGRADATION_THRESHOLD, "retrain").otherwise("ok")).alias("status"),
        base.alias("baseline_wape"), "recent_wape",
        F.round(deg * 100, 2).alias("degradation_pct"),
        F.lit(PERF_DEGRADATION_THRESHOLD * 100).alias("threshold_pct"), "n_dropped_pairs")


def action_column(data_status, pred_status, perf_status):
    """The decision table."""
    return (F.when((perf_status == "retrain") & data_status.isin("retrain", "warning"), "immediate_retrain_and_alert")
            .when(perf_status == "retrain", "immediate_retrain")
            .when(data_status == "retrain", "scheduled_retrain")
            .when((data_status == "warning") | (pred_status == "drift"), "warning")
            .otherwise("no_action"))


def drift_action(data: DataFrame, pred: DataFrame, perf: DataFrame) -> DataFrame:
    """X5 over one-row frames of X2-X4."""
    row = one_row_attach(
        one_row_attach(data.select(F.col("status").alias("data_status"), "drift_fraction", "n_drifted"),
                       pred.select(F.col("status").alias("prediction_status"), "ks_statistic", "p_value")),
        perf.select(F.col("status").alias("performance_status"), "recent_wape", "degradation_pct"))
    return row.withColumn("action", action_column(F.col("data_status"), F.col("prediction_status"),
                                                  F.col("performance_status")))


def region_skus(meta: DataFrame, region: str) -> DataFrame:
    """SKUs of one supplier region (a subset of the dimension table)."""
    return meta.filter(F.col("supplier_region") == F.lit(region)).select("sku_id")


def scenario_shock(panel: DataFrame, meta: DataFrame, region: str, multiplier: float,
                   weeks: int) -> DataFrame:
    """Multiply demand of the region's SKUs over the last ``weeks`` weeks."""
    hit_sku = panel.join(region_skus(meta, region).withColumn("_in_region", F.lit(True)), "sku_id", "left")
    recent = latest_weeks(panel, weeks).withColumn("_recent", F.lit(True))
    tagged = hit_sku.join(F.broadcast(recent), "week", "left")
    hit = F.coalesce(F.col("_in_region"), F.lit(False)) & F.coalesce(F.col("_recent"), F.lit(False))
    return (tagged.withColumn("demand", F.when(hit, F.col("demand") * multiplier).otherwise(F.col("demand")))
            .withColumn("shocked", hit.cast("int"))
            .drop("_in_region", "_recent"))
