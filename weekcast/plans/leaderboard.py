"""Baseline leaderboard and walk-forward CV (B10, K1, V4) as single jobs.

All three baselines forecast the whole catalogue in one DataFrame tagged
with ``model``; scoring is one grouped aggregation over the joined rows.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weekcast.functions.constants import (
    CV_FOLDS,
    INTERVAL_Z,
    METRIC_NAMES,
    MOVING_AVERAGE_NAME,
    NAIVE_NAME,
    SEASONAL_NAIVE_NAME,
    TEST_WEEKS,
)
from weekcast.operators import baselines as B
from weekcast.operators.evaluation import cv_summary, leaderboard, metrics, union_frames
from weekcast.operators.splits import fold_rows, holdout_split, walk_forward_folds

ROLLING_INTERVAL_NAME = "RollingInterval(4w, one-step)"


FORECASTERS = {NAIVE_NAME: B.naive, MOVING_AVERAGE_NAME: B.moving_average, SEASONAL_NAIVE_NAME: B.seasonal_naive}
BASELINE_MODELS = tuple(FORECASTERS)


def baseline_forecasts(train: DataFrame, horizon: int | str = TEST_WEEKS, keys=("sku_id",), models=BASELINE_MODELS) -> DataFrame:
    """B1-B3 (or those of them in ``models``) over the whole catalogue, tagged with the model name."""
    unknown = [m for m in models if m not in FORECASTERS]
    if unknown or not models:
        raise ValueError(f"no baseline named {', '.join(unknown)}" if unknown else "no model to forecast with")
    return union_frames([FORECASTERS[m](train, horizon, keys=keys).withColumn("model", F.lit(m)) for m in models])


def scored_rows(test: DataFrame, forecasts: DataFrame, how: str = "inner", keys=("sku_id",),
                models=BASELINE_MODELS) -> DataFrame:
    """J2 (inner) / J3 (left): actuals joined to every model's forecast.

    The left form keeps every actual row once per model (one left join per
    named model), as each model is scored against the full test set.
    """
    fc_cols = [c for c in ("p10", "p50", "p90") if c in forecasts.columns]
    actual = test.select(*keys, "week", "demand", "category")
    fc = forecasts.select("model", *keys, "week", *fc_cols)
    if how == "inner":
        return actual.join(fc, [*keys, "week"], "inner")
    return union_frames([
        actual.join(fc.filter(F.col("model") == m).drop("model"), [*keys, "week"], "left")
        .withColumn("model", F.lit(m)) for m in models])


def one_step_interval(test: DataFrame) -> DataFrame:
    """Rolling-statistics interval scored one step ahead on the test rows
    (features there hold actual lags): p50 = 4-week mean, sigma = 4-week std."""
    p50 = F.col("rolling_mean_4w")
    std = F.coalesce(F.col("rolling_std_4w"), p50 * 0.12)
    return test.select(
        F.lit(ROLLING_INTERVAL_NAME).alias("model"), "sku_id", "week", "demand", "category",
        F.greatest(p50 - INTERVAL_Z * std, F.lit(0.0)).alias("p10"), p50.alias("p50"),
        (p50 + INTERVAL_Z * std).alias("p90"))


def model_metrics(scored: DataFrame, interval: bool = False, by=("model",)) -> DataFrame:
    lo, hi = ("p10", "p90") if interval else (None, None)
    return metrics(scored, by=by, lo=lo, hi=hi)


def baseline_leaderboard(model_rows: DataFrame, models=(*BASELINE_MODELS, ROLLING_INTERVAL_NAME)) -> DataFrame:
    """run_all_models for the SQL-expressible models, or those of them in ``models`` -> ranked leaderboard."""
    train, test = holdout_split(model_rows)
    point = [m for m in models if m != ROLLING_INTERVAL_NAME]
    parts = [model_metrics(scored_rows(test, baseline_forecasts(train, models=point)))] if point or not models else []
    if ROLLING_INTERVAL_NAME in models:
        parts.append(model_metrics(one_step_interval(test), interval=True))
    rows = union_frames(parts).withColumn("inference_ms", F.lit("< 1"))
    return leaderboard(rows).select("rank", "model", *METRIC_NAMES, "inference_ms")


def walk_forward_cv(model_rows: DataFrame, k: int = CV_FOLDS) -> tuple[DataFrame, DataFrame]:
    """V4 for the baselines: every fold in one job.

    Rows are tagged with the folds they belong to (each row at most k times);
    each fold's train part is the history, its validation block the horizon.
    Returns (per-fold metrics, summary).
    """
    folds = walk_forward_folds(model_rows, k)
    tagged = fold_rows(model_rows, folds)
    keys = ("fold", "sku_id")
    train = tagged.filter(F.col("role") == "train")
    val = tagged.filter(F.col("role") == "val")
    scored = scored_rows(val, baseline_forecasts(train, "size", keys=keys), keys=keys)
    per_fold = model_metrics(scored, by=("model", "fold"))
    return per_fold, cv_summary(per_fold)


def one_step_baselines(model_rows: DataFrame, test: DataFrame) -> DataFrame:
    """The point baselines scored one step ahead: each test row is forecast from the rows before it.

    Naive is the previous known demand, the moving average the mean of the
    four rows before, the seasonal one the row nearest to 52 weeks earlier.
    All three come from frames over the SKU's own rows; ``test`` picks the rows.
    """
    rows = model_rows.select("sku_id", "week", "demand", "category")
    w = Window.partitionBy("sku_id").orderBy("week")
    before = rows.select(
        "sku_id", "week", "demand", "category",
        F.coalesce(F.lag("demand").over(w), F.lit(0.0)).alias("naive"),
        F.coalesce(F.avg(F.coalesce("demand", F.lit(0.0))).over(w.rowsBetween(-4, -1)), F.lit(0.0)).alias("average"))
    here = before.join(test.select("sku_id", "week"), ["sku_id", "week"], "left_semi")
    matched = B.nearest_asof(here.select("sku_id", "week", F.date_sub("week", 364).alias("target_week")),
                             rows.select("sku_id", "week", "demand"))
    past = F.when(F.col("matched_week") < F.col("week"), F.col("matched_value"))
    seasonal = matched.select("sku_id", "week", F.coalesce(past, F.lit(0.0)).alias("seasonal"))
    wide = here.join(seasonal, ["sku_id", "week"], "left")
    named = {"naive": NAIVE_NAME, "average": MOVING_AVERAGE_NAME, "seasonal": SEASONAL_NAIVE_NAME}
    long = wide.unpivot(["sku_id", "week", "demand", "category"], list(named), "source", "p50")
    names = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    return long.select(names[F.col("source")].alias("model"), "sku_id", "week", "demand", "category", "p50")


def baseline_modes(model_rows: DataFrame) -> DataFrame:
    """Metrics of every baseline in both modes: ``multi_step`` over the whole holdout, ``one_step`` row by row."""
    train, test = holdout_split(model_rows)
    multi = model_metrics(scored_rows(test, baseline_forecasts(train))).withColumn("mode", F.lit("multi_step"))
    single = model_metrics(one_step_baselines(model_rows, test)).withColumn("mode", F.lit("one_step"))
    return multi.unionByName(single)


def walk_forward_cv_learner(model_rows: DataFrame, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]],
                            name: str, k: int = CV_FOLDS, at_once: int | None = None) -> DataFrame:
    """V4 for a learner: per fold, ``fit`` on the fold's training weeks and score its validation rows one step ahead.

    Folds share only the stored features, so ``at_once`` of them (all, if not
    given) are fitted at the same time: each thread carries the session's local
    properties and its own scheduler pool, and under FAIR scheduling the folds
    share the cluster. Rows without a forecast count as such (left join).
    """
    folds = walk_forward_folds(model_rows, k).select("fold", "train_end_week", "val_end_week").orderBy("fold").collect()     # k rows
    spark = model_rows.sparkSession

    def run(f) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{f.fold}")
        train = model_rows.filter(F.col("week") <= F.lit(f.train_end_week))
        val = model_rows.filter((F.col("week") > F.lit(f.train_end_week)) & (F.col("week") <= F.lit(f.val_end_week)))
        predicted = fit(train)(val).select("sku_id", "week", "p50")
        return (val.select("sku_id", "week", "demand", "category").join(predicted, ["sku_id", "week"], "left")
                .withColumn("model", F.lit(name)).withColumn("fold", F.lit(f.fold)))

    with ThreadPoolExecutor(at_once or k) as pool:
        waiting = [pool.submit(inheritable_thread_target(spark)(lambda f=f: run(f))) for f in folds]
        scored = [w.result() for w in waiting]
    return model_metrics(union_frames(scored), by=("model", "fold"))
