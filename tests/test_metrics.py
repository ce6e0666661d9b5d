"""Metric vectors (FIXTURES.md 1.3)."""

import math

import pytest

from weekcast.operators.evaluation import metrics, segment_metrics


def _m(spark, y, p, lo=None, hi=None, cat=None):
    rows = []
    for i in range(len(y)):
        f = lambda v: None if v is None else float(v)
        rows.append((f(y[i]), f(p[i]), f(lo[i]) if lo else None, f(hi[i]) if hi else None,
                     cat[i] if cat else "x"))
    df = spark.createDataFrame(rows, "demand double, p50 double, p10 double, p90 double, category string")
    return df, metrics(df, lo="p10" if lo else None, hi="p90" if hi else None).first().asDict()


def test_perfect(spark):
    _, m = _m(spark, [10, 20, 30], [10, 20, 30])
    assert m["mae"] == 0 and m["rmse"] == 0 and m["bias"] == 0 and m["wape"] == pytest.approx(0)


def test_over_forecast(spark):
    _, m = _m(spark, [10, 10, 10], [15, 15, 15])
    assert m["bias"] == pytest.approx(5) and m["wape"] == pytest.approx(50, rel=1e-6)


def test_zero_actuals_finite(spark):
    _, m = _m(spark, [0, 0, 0], [1, 2, 3])
    assert math.isfinite(m["wape"]) and m["mape"] is None


def test_zero_in_mape_ignored(spark):
    _, m = _m(spark, [0, 10, 20], [1, 10, 20])
    assert m["mape"] == pytest.approx(0)


def test_coverage(spark):
    y = [10, 20, 30, 40, 50]
    _, m = _m(spark, y, y, [v - 5 for v in y], [v + 5 for v in y])
    assert m["coverage_80pct"] == pytest.approx(100)


def test_width(spark):
    _, m = _m(spark, [10, 20], [10, 20], [0, 10], [20, 30])
    assert m["interval_width"] == pytest.approx(20)


def test_null_pairs_dropped(spark):
    _, m = _m(spark, [10, None, 30], [10, 20, None])
    assert m["mae"] == 0


def test_segments(spark):
    df, _ = _m(spark, [10, 20, 5, 50], [10, 18, 5, 55],
               cat=["fast_moving", "fast_moving", "intermittent", "seasonal"])
    keys = {r["category"] for r in segment_metrics(df).collect()}
    assert keys == {"fast_moving", "intermittent", "seasonal"}


def test_empty_gives_null_row(spark):
    df = spark.createDataFrame([(None, 1.0)], "demand double, p50 double")
    m = metrics(df).first().asDict()
    assert m["mae"] is None and m["wape"] is None
