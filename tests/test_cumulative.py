"""Exact running sums, medians and quantiles against numpy."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.operators.cumulative import exact_median, exact_quantiles, order_code, running_sums

ODD = [-math.inf, -1e300, -5.5, -5.0, -1e-300, -5e-324, 0.0, 5e-324, 1e-300, 0.1, 0.1 + 1e-16, 1.0, 1.0 + 2**-40, 1.0 + 2**-30, 2.0, 3.0, 1e300, math.inf]


def test_order_code(spark):
    rows = spark.createDataFrame([(v,) for v in ODD], "v double").select("v", order_code(F.col("v")).alias("c")).collect()
    assert [r.v for r in sorted(rows, key=lambda r: r.c)] == ODD and len({r.c for r in rows}) == len(set(ODD))
    assert spark.range(1).select(order_code(F.lit(-0.0)).alias("a"), order_code(F.lit(0.0)).alias("b")).first() == (0, 0)


@pytest.mark.parametrize("parts", [1, 7])
def test_running_sums(spark, parts):
    rng = np.random.default_rng(2)
    values = {"a": np.unique(rng.normal(size=3000) * 10.0 ** rng.integers(-5, 6, 3000)), "b": np.array(ODD), "c": np.array([4.0]), "d": 1e6 + np.arange(2000) / 2000}
    rows = [(g, float(v), int(n), float(n) / 4) for g, vs in values.items() for v, n in zip(vs, rng.integers(0, 9, len(vs)), strict=True)]
    df = spark.createDataFrame(rows + [("a", None, 3, 0.5)], "g string, v double, n long, x double").repartition(parts)
    got = {(r.g, r.v): (r.cum_n, r.cum_x) for r in running_sums(df, ["g"], "v", ["n", "x"]).collect()}
    for g, vs in values.items():
        n = np.cumsum([r[2] for r in rows if r[0] == g]) + (3 if g == "a" else 0)
        x = np.cumsum([r[3] for r in rows if r[0] == g]) + (0.5 if g == "a" else 0)
        for v, a, b in zip(vs, n, x, strict=True):
            assert got[g, float(v)] == (a, pytest.approx(b))
    assert got["a", None] == (3, 0.5)
    one = running_sums(df.filter("g = 'd'").drop("g"), [], "v", ["n"])
    assert one.agg(F.max("cum_n")).first()[0] == sum(r[2] for r in rows if r[0] == "d")
    assert running_sums(df.limit(0), ["g"], "v", ["n"]).collect() == []


def test_work_does_not_depend_on_the_number_of_tasks(spark):
    df = spark.range(100_000).select((F.col("id") * 1.37).alias("v"), F.lit(1).cast("long").alias("n"))
    plan = lambda: running_sums(df, [], "v", ["n"])._jdf.queryExecution().optimizedPlan().toString()
    usual, short = spark.conf.get("spark.sql.shuffle.partitions"), plan()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "2000")
        assert len(plan()) == len(short)
        start = time.time()
        assert running_sums(df, [], "v", ["n"]).agg(F.max("cum_n")).first()[0] == 100_000
        assert time.time() - start < 120
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


def test_medians_and_quantiles(spark):
    rng = np.random.default_rng(5)
    data = {"a": rng.integers(-3, 4, 501).astype(float), "b": rng.normal(size=400) * 1000}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None)], "g string, v double").repartition(5)
    medians = {r.g: r.median_v for r in exact_median(df, "v", ["g"]).collect()}
    quantiles = {r.g: r for r in exact_quantiles(df, "v", {"q1": 0.1, "q2": 0.77}, ["g"]).collect()}
    for g, vs in data.items():
        assert medians[g] == pytest.approx(np.median(vs))
        assert (quantiles[g].q1, quantiles[g].q2) == pytest.approx((np.quantile(vs, 0.1), np.quantile(vs, 0.77)))
