"""Requests: defaults, validation, and no request lost."""

import datetime as dt

import pytest

from weekcast.functions.constants import FEATURE_COLUMNS
from weekcast.operators import scoring as SC
from weekcast.operators.learners import QuantileBoost

REQUEST = "request_id long, batch_id long, sku_id string, horizon_weeks int, include_intervals boolean"


@pytest.fixture(scope="module")
def features(spark):
    from pyspark.sql import functions as F

    weeks = [(f"PART-{k}", dt.date(2024, 1, 1) + dt.timedelta(weeks=w), float(k + w)) for k in range(600) for w in range(2)]
    df = spark.createDataFrame(weeks, "sku_id string, week date, demand double")
    df = df.withColumn("demand_adjusted", F.col("demand")).withColumn("category", F.lit("seasonal"))
    return df.select("*", *[F.col("demand").alias(c) for c in FEATURE_COLUMNS])


def test_every_request_has_one_outcome(spark, features):
    rows = [(1, 1, " PART-1 ", None, None), (2, 1, "\tPART-2\n", 3, False), (3, 1, "\t", 2, True), (4, 1, None, 2, True),
            (5, None, "PART-3", 0, True), (6, 1, "PART-4", 53, None), (7, 1, "PART-5", 52, True), (8, 1, "PART-9999", None, True)]
    out = {r.request_id: (r.outcome, r.n_rows, r.reason) for r in SC.request_outcomes(spark.createDataFrame(rows, REQUEST), features).collect()}
    assert out[1] == ("forecast", 4, None) and out[2] == ("forecast", 3, None) and out[7] == ("forecast", 52, None)
    assert out[3][2] == out[4][2] == "blank_sku_id" and out[5][2] == out[6][2] == "horizon_out_of_range"
    assert out[8][0] == "unknown" and len(out) == len(rows)


def test_default_intervals_are_on(spark, features):
    rows = [(1, 1, "PART-1", 1, None), (2, 1, "PART-1", 1, False)]
    got = {r.request_id: r for r in SC.batch_score(spark.createDataFrame(rows, REQUEST), features)[0].collect()}
    assert got[1].p10 is not None and got[2].p10 is None


def test_large_batches_are_scored_and_labelled(spark, features):
    rows = [(k, 1, f"PART-{k}", 1, True) for k in range(501)]
    requests = spark.createDataFrame(rows, REQUEST)
    assert SC.request_clean(requests).filter("large_batch and valid").count() == 501
    assert SC.batch_score(requests, features)[0].count() == 501
    assert SC.batch_score(requests, features, max_batch=500)[1].filter("reason = 'batch_too_large'").count() == 501


def test_scoring_with_a_fitted_quantile_model(spark, features):
    model = QuantileBoost(rounds=2, depth=2).fit(features.limit(300))
    requests = spark.createDataFrame([(k, 1, f"PART-{k}", 2, True) for k in range(10)], REQUEST)
    rows = SC.batch_score(requests, features, model.transform)[0].collect()
    assert len(rows) == 20 and all(0 <= r.p10 and 0 <= r.p50 <= r.p90 for r in rows)


def test_nested_response_keeps_week_order(spark, features):
    requests = spark.createDataFrame([(1, 1, "PART-1", 12, True)], REQUEST)
    nested = SC.response_nested(SC.batch_score(requests, features)[0]).first()
    assert [f.week for f in nested.forecasts] == sorted(f.week for f in nested.forecasts) and len(nested.forecasts) == 12
