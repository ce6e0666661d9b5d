"""Recursive multi-step scoring (E5): each step's inputs come from the steps before it.

A SKU's state is its last 52 adjusted demands and its last row's other inputs.
Step by step, lags, rolling statistics, velocities and zero ratio are computed
from the state, the calendar inputs from the step's own week, and the prediction
enters the state. The state never grows, SKUs are independent, and all rows of a
batch take a step together. The flat scorer of ``scoring`` stays the default.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.functions.constants import FEATURE_COLUMNS, INTERVAL_Z, LAGS, MIN_MAX_WINDOW, ROLLING_WINDOWS, ZERO_RATIO_WINDOW
from weekcast.operators.splits import last_n_rows
from weekcast.session import ship_code

DEPTH = max(LAGS)
CALENDAR = ("week_of_year", "month", "quarter", "is_q1", "is_q4")
WINDOWED = {f"lag_{k}" for k in LAGS} | {c for c in FEATURE_COLUMNS if c.startswith(("rolling_", "demand_change_", "zero_demand_ratio_"))}
Predict = Callable[[np.ndarray], dict[str, np.ndarray]]


def states(features: DataFrame) -> DataFrame:
    """Per SKU: last_week, n_rows, its last adjusted demands (oldest first, at most DEPTH) and its last row's other inputs."""
    others = [c for c in FEATURE_COLUMNS if c not in WINDOWED and c not in CALENDAR]
    past = (last_n_rows(features.select("sku_id", "week", "demand_adjusted"), DEPTH)
            .groupBy("sku_id").agg(F.sort_array(F.collect_list(F.struct("week", "demand_adjusted"))).alias("_past")))           # at most DEPTH
    last = features.groupBy("sku_id").agg(F.max("week").alias("last_week"), F.count("*").alias("n_rows"),
                                          F.max_by(F.struct("category", *others), "week").alias("_last"))
    return (last.join(past, "sku_id").select("sku_id", "last_week", "n_rows", "_last.*", F.transform("_past", lambda x: x["demand_adjusted"]).alias("past")))


def step_inputs(past: np.ndarray, n_rows: np.ndarray, weeks: pd.Series, constants: dict[str, np.ndarray], step: int) -> np.ndarray:
    """(rows x FEATURE_COLUMNS) inputs of one step; ``past`` is (rows x DEPTH), NaN before a SKU's first row."""
    def of(n: int) -> np.ndarray:
        return past[:, DEPTH - n:]

    with np.errstate(all="ignore"):
        made = {f"lag_{k}": past[:, DEPTH - k] for k in LAGS}
        seen = lambda a: (~np.isnan(a)).sum(axis=1)
        for n in ROLLING_WINDOWS:
            a, many = of(n), seen(of(n))
            mean = np.nansum(a, axis=1) / np.where(many, many, np.nan)
            made[f"rolling_mean_{n}w"] = mean
            made[f"rolling_std_{n}w"] = np.where(many > 1, np.sqrt(np.nansum((a - mean[:, None]) ** 2, axis=1) / np.maximum(many - 1, 1)), 0.0)
        a = of(MIN_MAX_WINDOW)
        some = seen(a) > 0
        made[f"rolling_min_{MIN_MAX_WINDOW}w"] = np.where(some, np.where(np.isnan(a), np.inf, a).min(axis=1), np.nan)
        made[f"rolling_max_{MIN_MAX_WINDOW}w"] = np.where(some, np.where(np.isnan(a), -np.inf, a).max(axis=1), np.nan)
        for n, back in ((1, 2), (4, 5)):
            before = past[:, DEPTH - back]
            made[f"demand_change_{n}w"] = past[:, DEPTH - 1] / np.where(before == 0, np.nan, before) - 1
        a = of(ZERO_RATIO_WINDOW)
        made[f"zero_demand_ratio_{ZERO_RATIO_WINDOW}w"] = np.where(seen(a) > 0, (a == 0).sum(axis=1) / np.minimum(n_rows + step, ZERO_RATIO_WINDOW), np.nan)
    date = weeks.dt
    made |= {"week_of_year": date.isocalendar().week.to_numpy(float), "month": date.month.to_numpy(float), "quarter": date.quarter.to_numpy(float)}
    made |= {"is_q1": (made["quarter"] == 1).astype(float), "is_q4": (made["quarter"] == 4).astype(float)}
    return np.stack([made[c] if c in made else constants[c] for c in FEATURE_COLUMNS], axis=1)


def rolling_predict(inputs: np.ndarray) -> dict[str, np.ndarray]:
    """The transparent scorer: p50 = 4-week rolling mean, p10 / p90 = p50 -/+ 1.28 standard deviations."""
    mean, std = inputs[:, FEATURE_COLUMNS.index("rolling_mean_4w")], inputs[:, FEATURE_COLUMNS.index("rolling_std_4w")]
    return {"p10": mean - INTERVAL_Z * std, "p50": mean, "p90": mean + INTERVAL_Z * std}


def recursive_forecast(features: DataFrame, horizons: DataFrame, predict: Predict = rolling_predict) -> DataFrame:
    """(sku_id, category, step, week, p10, p50, p90) of each SKU of ``horizons`` (sku_id, horizon) with history.

    ``predict`` takes (rows x FEATURE_COLUMNS), NaN for missing, and gives named
    predictions, ``p50`` among them; what enters the state is at least 0, and a
    NaN prediction enters as 0.
    """
    ship_code(features.sparkSession)
    others = [c for c in FEATURE_COLUMNS if c not in WINDOWED and c not in CALENDAR]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            past = np.full((len(frame), DEPTH), np.nan)
            for k, values in enumerate(frame["past"]):
                if len(values):
                    past[k, DEPTH - len(values):] = np.array(values, dtype=float)
            constants = {c: frame[c].to_numpy(float) for c in others}
            n_rows, horizon = frame["n_rows"].to_numpy(), frame["horizon"].to_numpy()
            start = pd.to_datetime(frame["last_week"])
            for step in range(1, int(horizon.max(initial=0)) + 1):
                weeks = start + pd.Timedelta(weeks=step)
                found = predict(step_inputs(past, n_rows, weeks, constants, step))
                go = horizon >= step
                yield pd.DataFrame({"sku_id": frame["sku_id"], "category": frame["category"], "step": step, "week": weeks.dt.date,
                                    **{p: found.get(p, np.full(len(frame), np.nan)) for p in ("p10", "p50", "p90")}})[go]
                past = np.concatenate([past[:, 1:], np.maximum(np.nan_to_num(found["p50"]), 0.0)[:, None]], axis=1)

    rows = states(features).join(horizons, "sku_id")
    made = rows.mapInPandas(run, "sku_id string, category string, step int, week date, p10 double, p50 double, p90 double")
    return made.select("sku_id", "category", "step", "week", *[F.when(~F.isnan(p), F.col(p)).alias(p) for p in ("p10", "p50", "p90")])


def recursive_scoring_frame(valid: DataFrame, features: DataFrame, predict: Predict = rolling_predict) -> DataFrame:
    """Requests with their recursive predictions, as ``interval_fallback`` takes them: each SKU is stepped once, to its longest horizon."""
    horizons = valid.groupBy("sku_id").agg(F.max("horizon_weeks").alias("horizon"))
    steps = recursive_forecast(features, horizons, predict)
    return valid.join(steps, "sku_id").filter(F.col("step") <= F.col("horizon_weeks"))
