"""Accuracy metrics, segments, leaderboard and CV summaries.

Metrics are conditional aggregates over valid (actual, prediction) pairs,
so one aggregation pass serves any grouping (model, segment, fold, week)
and groups with no valid pair still produce a row of nulls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import EPSILON, METRIC_NAMES


def metric_columns(actual: str = "demand", pred: str = "p50",
                   lo: str | None = None, hi: str | None = None) -> list[Column]:
    """A1/A2 as aggregate Columns (percent metrics x100)."""
    y, p = F.col(actual), F.col(pred)
    valid = y.isNotNull() & p.isNotNull()
    err = F.when(valid, y - p)
    cols = [
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.when(valid & (F.abs(y) > EPSILON), F.abs(F.try_divide(y - p, y)))) * 100).alias("mape"),
        (F.avg(F.when(valid, 2.0 * F.abs(y - p) / (F.abs(y) + F.abs(p) + EPSILON))) * 100).alias("smape"),
        (F.sum(F.abs(err)) / (F.sum(F.when(valid, F.abs(y))) + EPSILON) * 100).alias("wape"),
        F.avg(F.when(valid, p - y)).alias("bias"),
    ]
    if lo is not None and hi is not None:
        l, h = F.col(lo), F.col(hi)
        inside = F.coalesce((y >= l) & (y <= h), F.lit(False)).cast("double")
        width_missing = F.count(F.when(valid & (h - l).isNull(), 1)) > 0
        cols += [
            (F.avg(F.when(valid, inside)) * 100).alias("coverage_80pct"),
            F.when(width_missing, F.lit(None).cast("double")).otherwise(F.avg(F.when(valid, h - l)))
            .alias("interval_width"),
        ]
    else:
        cols += [F.lit(None).cast("double").alias("coverage_80pct"),
                 F.lit(None).cast("double").alias("interval_width")]
    return cols


def wape_column(actual: str = "demand", pred: str = "p50") -> Column:
    """WAPE over valid pairs, x100."""
    y, p = F.col(actual), F.col(pred)
    valid = y.isNotNull() & p.isNotNull()
    return F.sum(F.when(valid, F.abs(y - p))) / (F.sum(F.when(valid, F.abs(y))) + EPSILON) * 100


def metrics(df: DataFrame, by=(), actual: str = "demand", pred: str = "p50",
            lo: str | None = None, hi: str | None = None) -> DataFrame:
    """compute_metrics / compute_segment_metrics: one row per group."""
    cols = metric_columns(actual, pred, lo, hi)
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def segment_metrics(df: DataFrame, by=(), segment: str = "category", **kw) -> DataFrame:
    """A3: metrics per segment; rows without a segment are dropped."""
    return metrics(df.filter(F.col(segment).isNotNull()), by=(*by, segment), **kw)


def metrics_long(seg: DataFrame, keys=(), segment: str = "category") -> DataFrame:
    """A4: (segment, metric) -> ``segment_metric`` name, nulls skipped."""
    long = seg.unpivot([*keys, segment], METRIC_NAMES, "metric", "value")
    return (long.filter(F.col("value").isNotNull())
            .select(*keys, F.concat_ws("_", F.col(segment), F.col("metric")).alias("name"), "value"))


def evaluate_forecast(test: DataFrame, preds: DataFrame, model: str, how: str = "inner",
                      inference_ms: str = "< 1", keys=("sku_id",)) -> tuple[DataFrame, DataFrame]:
    """B10 for one model: join forecasts to actuals (J2 inner / J3 left), score."""
    cols = [c for c in ("p10", "p50", "p90") if c in preds.columns]
    merged = test.select(*keys, "week", "demand", "category").join(
        preds.select(*keys, "week", *cols), [*keys, "week"], how)
    lo, hi = ("p10", "p90") if "p10" in cols and "p90" in cols else (None, None)
    row = metrics(merged, lo=lo, hi=hi).select(
        F.lit(model).alias("model"), *METRIC_NAMES, F.lit(inference_ms).alias("inference_ms"))
    return row, merged


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """U1."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def leaderboard(rows: list[DataFrame] | DataFrame) -> DataFrame:
    """K1: models ranked by WAPE ascending, nulls last (model name breaks ties)."""
    df = union_frames(rows) if isinstance(rows, list) else rows
    w = Window.orderBy(F.col("wape").asc_nulls_last(), F.col("model"))
    return df.withColumn("rank", F.row_number().over(w))


def cv_summary(fold_metrics: DataFrame, by=("model",)) -> DataFrame:
    """A5: mean and population std per metric over folds (nulls skipped), n_folds."""
    aggs = []
    for m in METRIC_NAMES:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return fold_metrics.groupBy(*by).agg(*aggs, F.count("*").alias("n_folds"))
