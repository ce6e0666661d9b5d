"""Champion / challenger promotion gate and registry stage replay.

The gate runs over a metrics table -- any number of candidate models,
segments and metric names at once -- instead of one candidate run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import GATE_THRESHOLD, HIGHER_IS_BETTER, LOWER_IS_BETTER


def promotion_gate(metrics_long: DataFrame, production_model: str, threshold: float = GATE_THRESHOLD,
                   keys=("segment", "metric")) -> DataFrame:
    """G1: every candidate vs the production model on each (segment, metric).

    Lower-better metrics gain (prod - cand) / (prod + 1e-8), higher-better
    ones (cand - prod) / (prod + 1e-8); promote iff gain > threshold
    (strict). No production value -> promote; no candidate value or an
    unknown metric name -> reject.
    """
    prod = metrics_long.filter(F.col("model") == production_model).select(
        *keys, F.col("value").alias("production_value"))
    cand = metrics_long.filter(F.col("model") != production_model).select(
        F.col("model").alias("candidate"), *keys, F.col("value").alias("candidate_value"))
    pairs = cand.join(prod, list(keys), "left")
    m, c, p = F.col("metric"), F.col("candidate_value"), F.col("production_value")
    lower, higher = m.isin(*LOWER_IS_BETTER), m.isin(*HIGHER_IS_BETTER)
    gain = (F.when(lower, (p - c) / (p + 1e-8)).when(higher, (c - p) / (p + 1e-8)))
    status = (F.when(~(lower | higher), "rejected")
              .when(c.isNull(), "rejected")
              .when(p.isNull(), "promoted")
              .when(gain > threshold, "promoted").otherwise("rejected"))
    reason = (F.when(~(lower | higher), "unknown_metric")
              .when(c.isNull(), "missing_candidate_metric")
              .when(p.isNull(), "missing_production_metric")
              .when(gain > threshold, "improved").otherwise("below_threshold"))
    return pairs.select(
        "candidate", *keys, "candidate_value", "production_value",
        F.round(gain * 100, 4).alias("improvement_pct"),
        F.lit(round(threshold * 100, 4)).alias("threshold_pct"),
        status.alias("promotion_status"), reason.alias("reason"))


def current_stage(events: DataFrame) -> DataFrame:
    """Replay an append-only registry log.

    ``events``: (model_name, version, event_type, event_time) where
    event_type is 'promote' or 'rollback' (both move ``version`` to
    Production). The latest event per model names the Production version;
    every other version that was ever in Production is Archived.
    """
    latest = events.groupBy("model_name").agg(
        F.max_by("version", "event_time").alias("production_version"))
    seen = events.groupBy("model_name", "version").agg(F.max("event_time").alias("last_event_time"))
    return (seen.join(latest, "model_name", "inner")
            .select("model_name", "version", "last_event_time",
                    F.when(F.col("version") == F.col("production_version"), "Production")
                    .otherwise("Archived").alias("stage")))


def fold_champion_events(per_fold: DataFrame, model_name: str = "demand-forecaster",
                         threshold: float = GATE_THRESHOLD) -> DataFrame:
    """Registry events from walk-forward folds: each fold's best model (by WAPE)
    challenges the previous fold's best on the same fold; a pass (or the
    first fold) is a 'promote' event with version = 'v<fold>'."""
    rank = Window.partitionBy("fold").orderBy(F.col("wape").asc_nulls_last(), "model")
    best = per_fold.withColumn("_r", F.row_number().over(rank)).filter("_r = 1").select(
        "fold", F.col("model").alias("best_model"), F.col("wape").alias("best_wape"))
    prev = Window.orderBy("fold")   # one row per fold: a handful of rows
    chain = best.withColumn("prev_model", F.lag("best_model").over(prev))
    prod_on_fold = per_fold.select("fold", F.col("model").alias("prev_model"), F.col("wape").alias("prev_wape"))
    joined = chain.join(prod_on_fold, ["fold", "prev_model"], "left")
    gain = (F.col("prev_wape") - F.col("best_wape")) / (F.col("prev_wape") + 1e-8)
    promote = F.col("prev_model").isNull() | F.col("prev_wape").isNull() | (gain > threshold)
    return joined.filter(promote).select(
        F.lit(model_name).alias("model_name"),
        F.concat(F.lit("v"), F.col("fold").cast("string")).alias("version"),
        F.col("best_model").alias("model"),
        F.lit("promote").alias("event_type"),
        F.col("fold").cast("long").alias("event_time"))
