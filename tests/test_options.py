"""Options beyond the analysed workload's defaults: cold start, recursive steps, sketches, folds at once."""

import datetime as dt
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weekcast.functions.constants import FEATURE_COLUMNS, MOVING_AVERAGE_NAME, NAIVE_NAME
from weekcast.operators import sketches as SK
from weekcast.operators.baselines import moving_average, naive
from weekcast.operators.coldstart import prior_means, with_cold_start
from weekcast.operators.features import build_features
from weekcast.operators.learners import QuantileBoost
from weekcast.operators.recursive import recursive_forecast
from weekcast.operators.reports import demand_box_by_category, distinct_skus
from weekcast.operators.splits import holdout_split
from weekcast.plans.context import Inputs
from weekcast.plans.leaderboard import ROLLING_INTERVAL_NAME, baseline_leaderboard, walk_forward_cv_learner

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ cold start
def test_cold_start_levels(spark):
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(7 * k)
    rows = [("a", "x", day(0), 2.0), ("a", "x", day(1), 4.0), ("b", "y", day(0), 10.0), ("c", None, day(1), 20.0), ("d", "z", day(0), None)]
    history = spark.createDataFrame(rows, "sku_id string, category string, week date, demand double")
    assert {r.category: r["mean"] for r in prior_means(history).collect()} == {"x": 3.0, "y": 10.0, None: 9.0}
    skus = spark.createDataFrame([("a", "x"), ("n1", "y"), ("n2", "q"), ("n3", None), ("n4", "z"), ("n1", "y")], "sku_id string, category string")
    for make in (naive, moving_average):
        got = {(r.sku_id, r.week): (r.p50, r.level) for r in with_cold_start(make(history, 2), history, skus, 2).collect()}
        assert {k: v for k, v in got.items() if k[0][0] == "n"} == {
            (s, day(1 + h)): v for h in (1, 2) for s, v in {"n1": (10.0, "category"), "n2": (9.0, "global"), "n3": (9.0, "global"), "n4": (9.0, "global")}.items()}
        assert sum(k[0] == "a" for k in got) == 2 and got["a", day(2)][1] == "sku"
    assert with_cold_start(naive(history.limit(0), 2), history.limit(0), skus, 2).collect() == []


# ------------------------------------------------------------------ recursive steps
WEIGHTS = {"lag_1": 0.3, "lag_2": 0.1, "lag_52": 0.05, "rolling_mean_12w": 0.2, "rolling_std_4w": 0.1, "rolling_std_12w": 0.1, "rolling_min_4w": 0.1, "rolling_max_4w": 0.05,
           "demand_change_1w": 0.7, "demand_change_4w": 0.4, "zero_demand_ratio_12w": 3.0, "week_of_year": 0.01, "month": 0.02, "quarter": 0.03, "is_q1": 0.5, "is_q4": 0.25,
           "lead_time_weeks": 0.01, "log_unit_cost": 0.1, "region_NA": 0.2}


def plain_rows(frame):
    return frame.astype(object).where(frame.notna(), None).values.tolist()


def weigh(inputs):
    weights = np.array([WEIGHTS.get(c, 0.0) for c in FEATURE_COLUMNS])
    return {"p50": np.nansum(inputs * weights, axis=1) - 2.0}


def test_recursive_steps_equal_rebuilt_features(spark):
    """Each step's inputs are what the feature pipeline gives once the predictions before it are rows of the panel."""
    x = Inputs(spark, SF, materialized=False)
    few = [r.sku_id for r in x.meta.select("sku_id").orderBy("sku_id").limit(4).collect()]
    cut = dt.date(2001, 6, 4)
    panel = x.panel.filter(F.col("sku_id").isin(few) & (F.col("week") <= cut))
    rows = panel.toPandas()
    short = rows["sku_id"] != few[0]
    rows = rows[short | (rows["week"] > cut - dt.timedelta(7 * 3))]                # a SKU with three weeks of history
    names = panel.columns
    base = spark.createDataFrame(plain_rows(rows), panel.schema)
    horizons = spark.createDataFrame([(s, 4) for s in few[:3]], "sku_id string, horizon int")
    got = {(r.sku_id, r.step): r.p50 for r in recursive_forecast(build_features(base, x.meta), horizons, weigh).collect()}
    assert len(got) == 12
    now = rows
    for step in range(1, 5):
        week = cut + dt.timedelta(7 * step)
        more = now[now["week"] == cut].copy() if step == 1 else now[now["week"] == week - dt.timedelta(7)].copy()
        more["week"], more["demand"], more["stockout_flag"] = week, 0.0, 0
        trial = spark.createDataFrame(plain_rows(pd.concat([now, more])), panel.schema)
        made = build_features(trial.select(*names), x.meta).filter(F.col("week") == F.lit(week)).toPandas().set_index("sku_id")
        for s in few[:3]:
            want = weigh(made.loc[[s], FEATURE_COLUMNS].to_numpy(dtype=float))["p50"][0]
            assert got[s, step] == pytest.approx(want, rel=1e-9, abs=1e-9)
            more.loc[more["sku_id"] == s, "demand"] = max(0.0, want)
        now = pd.concat([now, more])


# ------------------------------------------------------------------ sketches
@pytest.fixture(scope="module")
def part_panel(spark):
    x = Inputs(spark, "/root/testdata/sf0.01", key="part", materialized=False)
    return x.panel.join(x.meta, "sku_id").select("sku_id", "week", "demand", "category").persist()


def test_distinct_sketches(spark, part_panel):
    weekly = SK.weekly_sku_sketches(part_panel)
    merged = SK.distinct_from_sketches(weekly).first().n_skus
    once = part_panel.agg(F.hll_sketch_estimate(F.hll_sketch_agg("sku_id", F.lit(SK.HLL_BITS)))).first()[0]
    exact = distinct_skus(part_panel).first().n_skus
    assert abs(merged - once) <= 0.01 * exact and abs(merged - exact) <= 0.02 * exact
    assert SK.distinct_from_sketches(weekly.limit(0)).first().n_skus == 0


def test_quantile_sketches(part_panel):
    got = {r.category: r for r in SK.box_from_sketches(SK.weekly_demand_sketches(part_panel)).collect()}
    exact = {r.category: r for r in demand_box_by_category(part_panel).collect()}
    assert got.keys() == exact.keys()
    values = part_panel.filter("demand IS NOT NULL").groupBy("category").agg(F.collect_list("demand").alias("v")).collect()
    for r in values:
        v = np.sort(np.array(r.v))
        assert got[r.category].n == len(v) == exact[r.category].n
        for q, name in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")):
            value = getattr(got[r.category], name)
            below, upto = (v < value).mean(), (v <= value).mean()
            assert below - 0.03 <= q <= upto + 0.03


# ------------------------------------------------------------------ models of a leaderboard
def test_leaderboard_of_some_models(spark):
    rows = Inputs(spark, SF).model_rows
    whole = {r.model: r for r in baseline_leaderboard(rows).collect()}
    for models in ((NAIVE_NAME,), (ROLLING_INTERVAL_NAME, MOVING_AVERAGE_NAME)):
        some = baseline_leaderboard(rows, models).collect()
        assert {r.model for r in some} == set(models) and [r["rank"] for r in some] == list(range(1, len(models) + 1))
        assert all(r.wape == pytest.approx(whole[r.model].wape) for r in some)
    for models in (("Nobody",), ()):
        with pytest.raises(ValueError, match="no baseline named Nobody|no model"):
            baseline_leaderboard(rows, models)


# ------------------------------------------------------------------ folds at once
def test_folds_at_once_give_the_loop_s_metrics(spark):
    rows = Inputs(spark, SF).model_rows

    def fit(train):
        inner, val = holdout_split(train)
        model = QuantileBoost(quantiles={"p50": 0.5}, rounds=2, leaves=7, bins=32).fit(inner, val)
        return lambda r: model.transform(r.select("sku_id", "week", *FEATURE_COLUMNS))

    def run(at_once):
        start = time.time()
        made = sorted(map(tuple, walk_forward_cv_learner(rows, fit, "m", at_once=at_once).select("fold", F.round("wape", 6), F.round("mae", 6)).collect()))
        return made, time.time() - start

    run(5)
    loop, slow = run(1)
    both, quick = run(5)
    assert both == loop and len(loop) == 5
    print(f"folds one by one {slow:.1f} s, at once {quick:.1f} s")
    assert quick < 0.8 * slow
