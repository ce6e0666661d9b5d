"""Batch scoring for many SKUs in one job.

Requests are a DataFrame (one row per requested SKU and horizon); they are
validated into accepted / rejected rows, split into known and unknown SKUs
with an inner and an anti join, expanded over their horizons from each
SKU's latest feature row, scored by any model with a ``transform``-style
callable, and optionally nested into one response row per request.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.functions.columns import clamp_nonneg
from weekcast.functions.constants import (
    DEFAULT_HORIZON,
    FEATURE_COLUMNS,
    INTERVAL_Z,
    MAX_BATCH_SKUS,
    MAX_HORIZON,
    SERVE_P10_FACTOR,
    SERVE_P90_FACTOR,
)
from weekcast.operators.baselines import expand_horizon
from weekcast.operators.coldstart import score_unknown
from weekcast.operators.dense import DenseFeatures
from weekcast.operators.recursive import Predict, recursive_scoring_frame


def request_clean(requests: DataFrame, max_batch: int | None = None) -> DataFrame:
    """strip white space from ids, apply the defaults (4 weeks, intervals on), reject
    blank ids and horizons outside 1..52.

    ``large_batch`` labels requests of batches over 500 ids; they are rejected
    only where the caller sets ``max_batch``.
    """
    sku = F.regexp_replace("sku_id", r"^\s+|\s+$", "")
    horizon = F.coalesce("horizon_weeks", F.lit(DEFAULT_HORIZON)).cast("int")
    # batch sizes by a grouped count (map-side combined) joined back: a huge
    # batch stays splittable by AQE's skew handling, unlike a window partition
    sizes = requests.groupBy("batch_id").agg(F.count("*").alias("_batch_size"))
    reason = (F.when(sku.isNull() | (sku == ""), "blank_sku_id")
              .when(~horizon.between(1, MAX_HORIZON), "horizon_out_of_range"))
    if max_batch is not None:
        reason = reason.when(F.col("_batch_size") > max_batch, "batch_too_large")
    return requests.join(sizes, "batch_id", "left").select(
        "request_id", "batch_id", sku.alias("sku_id"), horizon.alias("horizon_weeks"),
        F.coalesce("include_intervals", F.lit(True)).alias("include_intervals"),
        F.coalesce(F.col("_batch_size") > MAX_BATCH_SKUS, F.lit(False)).alias("large_batch"),
        reason.alias("reason")).withColumn("valid", F.col("reason").isNull())


def latest_rows(features: DataFrame | DenseFeatures) -> DataFrame:
    """Each SKU's last feature row: a grouped maximum, combined map-side before the shuffle; of features not made yet, only that row is made."""
    if isinstance(features, DenseFeatures):
        return features.latest()
    row = F.struct(*features.columns)
    return features.groupBy("sku_id").agg(F.max_by(row, "week").alias("_row")).select("_row.*")


def split_known(valid: DataFrame, latest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests for SKUs with history (inner) and the unknown ones (anti)."""
    keys = latest.select("sku_id")
    known = valid.join(keys, "sku_id", "left_semi")
    unknown = (valid.join(keys, "sku_id", "left_anti")
               .select("request_id", "sku_id", F.lit("SKU not found in feature store").alias("error")))
    return known, unknown


def scoring_frame(known: DataFrame, latest: DataFrame) -> DataFrame:
    """B8 + F15 + F17: the latest row repeated over the horizon, lag_1 set to the
    last adjusted demand, missing inputs 0 (calendar columns are not refreshed)."""
    last = latest.select("sku_id", F.col("week").alias("last_week"), "category",
                         *[c for c in FEATURE_COLUMNS if c in latest.columns],
                         "demand_adjusted")
    frame = known.join(last, "sku_id", "inner")
    frame = expand_horizon(frame, "horizon_weeks")
    frame = frame.withColumn("lag_1", F.col("demand_adjusted"))
    for c in FEATURE_COLUMNS:
        if c not in frame.columns:
            frame = frame.withColumn(c, F.lit(0))
    return frame.fillna(0, subset=FEATURE_COLUMNS)


def rolling_stats_model(frame: DataFrame) -> DataFrame:
    """A transparent scorer: p50 = 4-week rolling mean, p10/p90 = p50 -/+ 1.28 * 4-week std."""
    p50 = F.col("rolling_mean_4w").cast("double")
    sd = F.col("rolling_std_4w").cast("double")
    return frame.withColumn("p50", p50).withColumn("p10", p50 - INTERVAL_Z * sd).withColumn(
        "p90", p50 + INTERVAL_Z * sd)


def interval_fallback(scored: DataFrame) -> DataFrame:
    """B9 + F16: p50 >= 0; p10 defaults to 0.7 p50 (>= 0), p90 to 1.3 p50 (>= p50);
    no intervals when the request did not ask for them."""
    p50 = clamp_nonneg(F.coalesce(F.col("p50"), F.lit(0.0)))
    p10 = F.greatest(F.lit(0.0), F.coalesce(F.col("p10") if "p10" in scored.columns else F.lit(None),
                                            p50 * SERVE_P10_FACTOR))
    p90 = F.greatest(p50, F.coalesce(F.col("p90") if "p90" in scored.columns else F.lit(None),
                                     p50 * SERVE_P90_FACTOR))
    include = F.col("include_intervals")
    return scored.select(
        "request_id", "sku_id", "category", "horizon_weeks", "step", "week",
        F.when(include, p10).cast("double").alias("p10"), p50.alias("p50"),
        F.when(include, p90).cast("double").alias("p90"))


def _skus(features: DataFrame | DenseFeatures) -> DataFrame:
    some = features.select("sku_id")
    return (some.latest() if isinstance(some, DenseFeatures) else some).distinct()


def batch_score(requests: DataFrame, features: DataFrame | DenseFeatures,
                model: Callable[[DataFrame], DataFrame] = rolling_stats_model, max_batch: int | None = None,
                skus: DataFrame | None = None, recursive: Predict | None = None):
    """Requests -> (forecast rows, rejected requests, unknown SKUs).

    Every request is in exactly one of the three. The inner join with the
    latest rows drops unknown SKUs; batches of any size are scored unless
    ``max_batch`` is set. With ``skus`` (sku_id, category), SKUs without history
    are forecast from their category's mean demand and none is unknown. With
    ``recursive`` (a function of inputs, see ``recursive``), each step's inputs
    come from the steps before it, and ``model`` is not used. Both look at whole
    histories: features not made yet are made with all rows then.
    """
    if isinstance(features, DenseFeatures) and (recursive is not None or skus is not None):
        features = features.rows()
    checked = request_clean(requests, max_batch)
    valid = checked.filter("valid")
    _, unknown = split_known(valid, _skus(features))
    if recursive is None:
        used = [c for c in features.columns if c in {"sku_id", "week", "category", "demand_adjusted", *FEATURE_COLUMNS}]
        forecasts = interval_fallback(model(scoring_frame(valid, latest_rows(features.select(*used)))))
    else:
        forecasts = interval_fallback(recursive_scoring_frame(valid, features, recursive))
    if skus is not None:
        cold = valid.join(unknown.select("request_id").distinct(), "request_id", "left_semi")
        cold = cold.join(_skus(features), "sku_id", "left_anti")
        forecasts = forecasts.unionByName(interval_fallback(score_unknown(cold, features, skus)))
        unknown = unknown.limit(0)
    rejected = checked.filter(~F.col("valid")).select("request_id", "sku_id", "reason")
    return forecasts, rejected, unknown


def request_outcomes(requests: DataFrame, features: DataFrame, **options) -> DataFrame:
    """(request_id, outcome, n_rows, reason) for every request: forecast, rejected or unknown."""
    forecasts, rejected, unknown = batch_score(requests, features, **options)
    none = F.lit(None).cast("string")
    return (forecasts.groupBy("request_id").agg(F.count("*").alias("n_rows"))
            .select("request_id", F.lit("forecast").alias("outcome"), "n_rows", none.alias("reason"))
            .unionByName(rejected.select("request_id", F.lit("rejected").alias("outcome"), F.lit(0).cast("long").alias("n_rows"), "reason"))
            .unionByName(unknown.select("request_id", F.lit("unknown").alias("outcome"), F.lit(0).cast("long").alias("n_rows"),
                                        F.col("error").alias("reason"))))


def response_nested(forecasts: DataFrame) -> DataFrame:
    """One row per request with its week forecasts in week order."""
    item = F.struct(F.col("step"), F.date_format("week", "yyyy-MM-dd").alias("week"), "p10", "p50", "p90")
    return (forecasts.groupBy("request_id", "sku_id", "horizon_weeks", F.col("category").alias("sku_segment"))
            .agg(F.sort_array(F.collect_list(item)).alias("forecasts"))
            .withColumn("forecasts", F.transform("forecasts", lambda s: s.dropFields("step"))))
