"""Shock-to-action (X8) and the rolling WAPE timeline.

reference features (unshocked) -> regional demand shock -> shocked features
-> proxy p50 (4-week rolling mean, else the exact median demand) -> last N
weeks as the current window -> data / prediction / performance drift ->
action. Every step is a lazy DataFrame; the two feature builds share the
panel and dimension.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import (
    DRIFT_FEATURES,
    EPSILON,
    PERF_DEGRADATION_THRESHOLD,
    PVALUE_THRESHOLD,
)
from weekcast.functions.stats import chi2_pvalue
from weekcast.operators import drift as D
from weekcast.operators.cumulative import exact_median, one_row_attach
from weekcast.operators.features import build_features
from weekcast.operators.splits import in_week_set, latest_weeks
from weekcast.plans.context import Inputs

DEMO_REGION = "APAC"
DEMO_MULTIPLIER = 2.0
DEMO_WEEKS = 6
DEMO_BASELINE_WAPE = 34.9


@dataclass
class ShockRun:
    reference: DataFrame
    shocked: DataFrame       # shocked feature rows with a known target and the proxy p50
    current: DataFrame       # shocked rows in the last N weeks
    predictions: DataFrame   # (sku_id, week, demand, p50) of the current window
    ks: DataFrame
    data: DataFrame
    prediction: DataFrame
    performance: DataFrame
    action: DataFrame


def proxy_predictions(features: DataFrame) -> DataFrame:
    """p50 = 4-week rolling mean, else the median demand of all rows."""
    rows = features.dropna(subset=["demand"])
    med = exact_median(rows, "demand")
    return (one_row_attach(rows, med)
            .withColumn("p50", F.coalesce(F.col("rolling_mean_4w"), F.col("median_demand")))
            .drop("median_demand"))


def shock_to_action(x: Inputs, region: str = DEMO_REGION, multiplier: float = DEMO_MULTIPLIER,
                    weeks: int = DEMO_WEEKS, baseline_wape: float = DEMO_BASELINE_WAPE) -> ShockRun:
    reference = x.features
    shocked_features = x.keep(lambda: build_features(D.scenario_shock(x.panel, x.meta, region, multiplier, weeks).drop("shocked"), x.meta),
                              f"shocked_features-{region}-{multiplier}-{weeks}")
    shocked = x.keep(lambda: proxy_predictions(shocked_features), f"shocked_predictions-{region}-{multiplier}-{weeks}")
    current = in_week_set(shocked, latest_weeks(shocked, weeks))
    predictions = current.select("sku_id", "week", "demand", "p50")
    available = [f for f in DRIFT_FEATURES if f in current.columns and f in reference.columns]
    ks = D.ks_two_sample(reference, current, available)
    data = D.data_drift_status(ks, len(available))
    pred = D.prediction_drift(reference, current)
    perf = D.performance_drift(predictions, baseline_wape)
    action = D.drift_action(data, pred, perf)
    return ShockRun(reference, shocked, current, predictions, ks, data, pred, perf, action)


def rolling_wape_timeline(predictions: DataFrame, baseline_wape: float = DEMO_BASELINE_WAPE,
                          window: int = 4) -> DataFrame:
    """Weekly WAPE and the trailing ``window``-week WAPE against the retrain line.

    One row per week (bounded by the calendar), so the global time window
    runs in a single small task.
    """
    y, p = F.col("demand"), F.col("p50")
    valid = y.isNotNull() & p.isNotNull()
    weekly = predictions.groupBy("week").agg(
        F.coalesce(F.sum(F.when(valid, F.abs(y - p))), F.lit(0.0)).alias("abs_error"),
        F.coalesce(F.sum(F.when(valid, F.abs(y))), F.lit(0.0)).alias("abs_actual"))
    trail = Window.orderBy("week").rowsBetween(-(window - 1), 0)
    threshold = baseline_wape * (1 + PERF_DEGRADATION_THRESHOLD)
    rolling = F.sum("abs_error").over(trail) / (F.sum("abs_actual").over(trail) + EPSILON) * 100
    return weekly.select(
        "week",
        (F.col("abs_error") / (F.col("abs_actual") + EPSILON) * 100).alias("wape"),
        rolling.alias("rolling_wape"),
        F.lit(threshold).alias("retrain_threshold"),
    ).withColumn("above_threshold", F.col("rolling_wape") > F.col("retrain_threshold"))


def chi_square_drift(reference: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Pearson chi-square test of the side x value contingency table, with its decision. Values may be of any type; nulls are left out."""
    def side(df: DataFrame, mark: int) -> DataFrame:
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in features])
        return texts.unpivot([], features, "feature", "value").filter(F.col("value").isNotNull()).withColumn("side", F.lit(mark))

    both = side(reference, 0).unionByName(side(current, 1))
    counts = both.groupBy("feature", "value").agg(
        F.sum(1 - F.col("side")).alias("c_ref"), F.sum("side").alias("c_cur"))
    sizes = counts.groupBy("feature").agg(
        F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"), F.count("*").alias("n_values"))
    cells = counts.join(sizes, "feature").filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    n = F.col("n_ref") + F.col("n_cur")
    col_total = F.col("c_ref") + F.col("c_cur")
    e_ref = F.col("n_ref") * col_total / n
    e_cur = F.col("n_cur") * col_total / n
    term = (F.col("c_ref") - e_ref) ** 2 / e_ref + (F.col("c_cur") - e_cur) ** 2 / e_cur
    test = cells.groupBy("feature", "n_ref", "n_cur").agg(
        F.sum(term).alias("chi2_statistic"), (F.max("n_values") - 1).alias("dof"))
    p = chi2_pvalue(F.col("chi2_statistic"), F.col("dof"))
    return test.withColumn("p_value", p).withColumn("drifted", F.col("p_value") < PVALUE_THRESHOLD)


def column_drift(reference: DataFrame, current: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """One report of all columns by their kind: KS for numeric ones, chi-square for categorical ones.

    (feature, test, n_ref, n_cur, statistic, p_value, drifted); a column with an
    empty side has no row. ``data_drift_status`` takes it as it is.
    """
    columns = lambda df, name: df.select("feature", F.lit(name).alias("test"), "n_ref", "n_cur", "statistic", "p_value", "drifted")
    ks = columns(D.ks_two_sample(reference, current, numeric).withColumnRenamed("ks_statistic", "statistic"), "ks")
    chi = columns(chi_square_drift(reference, current, categorical).withColumnRenamed("chi2_statistic", "statistic"), "chi_square")
    return ks.unionByName(chi)
