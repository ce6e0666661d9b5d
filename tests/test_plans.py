"""Plan shape, lazy builders, stores and drift summaries."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekcast.functions.stats import chi2_pvalue
from weekcast.operators import drift as D
from weekcast.operators.baselines import nearest_asof
from weekcast.operators.features import build_features
from weekcast.plans import drift_demo as DD
from weekcast.plans import leaderboard as L
from weekcast.plans.catalog import QUERIES
from weekcast.plans.context import Inputs
from weekcast.sources import files as FS
from weekcast.sources import store as ST
from weekcast.sources import versions as VS

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("key", ["weekly_totals", "walk_forward_cv", "ks_two_sample", "leaderboard_sorted", "batch_score"])
def test_building_a_query_starts_no_job(spark, key):
    QUERIES[key](spark, SF)                                 # fills the store
    spark.sparkContext.setJobGroup(f"build-{key}", "")
    df = QUERIES[key](spark, SF)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{key}")
    spark.sparkContext.setJobGroup("rest", "")
    assert not jobs and "Aggregate" in plan(df) + df._jdf.queryExecution().optimizedPlan().toString()


@needs_data
def test_no_frame_grows_from_the_current_row_to_the_end(spark):
    x = Inputs(spark, SF, materialized=False)
    for df in (build_features(x.panel, x.meta), L.baseline_forecasts(x.panel)):
        assert "currentrow$(), unboundedfollowing$()" not in plan(df).lower()


@needs_data
def test_panel_scans_lineitem_for_its_rows_and_its_dates_only(spark):
    x = Inputs(spark, SF, materialized=False)
    text = plan(x.panel)
    assert text.count("l_quantity") and text.count("FileScan parquet [l_partkey") <= 1


@needs_data
def test_scale_key_stores_nothing_and_deals_its_lines_once(spark):
    spark.sparkContext.setJobGroup("build-features_part_key", "")
    df = QUERIES["features_part_key"](spark, SF)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build-features_part_key")
    spark.sparkContext.setJobGroup("rest", "")
    x = Inputs(spark, SF, key="part", materialized=False)
    assert not jobs and x.tasks >= 1 and "REPARTITION_BY_NUM" in plan(df)
    assert plan(x.panel).count("Exchange hashpartitioning") == 1


@needs_data
def test_week_cutoff_reaches_the_scan(spark):
    from weekcast.operators.splits import holdout_split

    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        _, test = holdout_split(Inputs(spark, SF).model_rows)
        assert "PushedFilters: [IsNotNull(week), GreaterThanOrEqual(week,ScalarSubquery" in plan(test.select("week", "demand"))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_nearest_asof_prefers_the_earlier_week_on_ties(spark):
    day = dt.date(2024, 1, 1)
    history = spark.createDataFrame([("a", day + dt.timedelta(d), float(d)) for d in (0, 14, 100)], "sku_id string, week date, demand double")
    targets = spark.createDataFrame([("a", day, day + dt.timedelta(d)) for d in (-50, 7, 8, 60, 400)], "sku_id string, week date, target_week date")
    got = {(r.target_week - day).days: r.matched_value for r in nearest_asof(targets, history).collect()}
    assert got == {-50: 0.0, 7: 0.0, 8: 14.0, 60: 100.0, 400: 100.0}


def test_newest_of_several_drift_summaries(spark, tmp_path):
    one = spark.range(1)
    data = one.select(F.lit("ok").alias("status"), F.lit(0.0).alias("drift_fraction"))
    ks = one.select(F.lit("x").alias("feature"), F.lit(False).alias("drifted"))
    prediction = one.select(F.lit("ok").alias("status"), F.lit(0.1).alias("ks_statistic"), F.lit(0.5).alias("p_value"), F.lit(False).alias("drifted"))
    performance = one.select(F.lit("ok").alias("status"), *[F.lit(1.0).alias(c) for c in ("baseline_wape", "recent_wape", "degradation_pct", "threshold_pct")])
    action = one.select(F.lit("no_action").alias("action"))
    root = str(tmp_path)
    assert FS.latest_drift_summary(spark, root).count() == 0
    for stamp in ("20240301_000000", "20240101_000000", "20240201_000000"):
        FS.write_drift_summary(FS.drift_summary(stamp, 1.0, ks, data, prediction, performance, action), root)
    assert FS.drift_report_flat(FS.latest_drift_summary(spark, root)).first().timestamp == "20240301_000000"


def test_prediction_drift_like_for_like_and_skipped_performance(spark):
    demand = spark.createDataFrame([(float(k),) for k in range(50)], "demand double")
    both = demand.withColumn("p50", F.col("demand"))
    assert D.prediction_drift(demand, both, like_for_like=True).first().status == "skipped"
    assert D.prediction_drift(both, both, like_for_like=True).first().status == "ok"
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0)], "week date, demand double")
    assert D.performance_drift(rows, 10.0).first().status == "skipped"


@pytest.mark.parametrize(("x", "dof", "want"), [(3.841459, 1, 0.05), (5.991465, 2, 0.05), (14.067140, 7, 0.05), (0.0, 3, 1.0),
                                                (23.209251, 10, 0.01), (500.0, 5, 0.0), (90.0, 100, 0.7531980)])
def test_chi_square_tail(spark, x, dof, want):
    got = spark.range(1).select(chi2_pvalue(F.lit(x), F.lit(dof)).alias("p")).first().p
    assert got == pytest.approx(want, abs=1e-5)


def test_categorical_drift_decision(spark):
    same = spark.createDataFrame([(k % 3,) for k in range(300)], "flag int")
    other = spark.createDataFrame([(0,)] * 200 + [(1,)] * 50, "flag int")
    assert not DD.chi_square_drift(same, same, ["flag"]).first().drifted
    assert DD.chi_square_drift(same, other, ["flag"]).first().drifted


def test_stored_tables_keep_their_schema_and_follow_their_files(spark, tmp_path):
    made = []

    def build():
        made.append(1)
        return spark.range(3).withColumn("x", F.lit("a"))

    name = f"t-{tmp_path.name}"
    assert ST.materialize(spark, build, name, "f").schema.simpleString() == ST.materialize(spark, build, name, "f").schema.simpleString()
    assert len(made) == 1
    for rows in (1, 2):
        spark.range(rows).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "in"))
        made.append(ST.input_fingerprint(spark, [str(tmp_path / "in")]))
    assert made[-1] != made[-2]


def test_feature_schema_contract(spark, tmp_path):
    VS.write_feature_version(spark.range(2).withColumn("demand", F.lit(1.0)), str(tmp_path), "v1")
    good = T.StructType([T.StructField("demand", T.DoubleType())])
    assert VS.read_feature_version(spark, str(tmp_path), "v1", good).count() == 2
    with pytest.raises(ValueError, match="demand"):
        VS.read_feature_version(spark, str(tmp_path), "v1", T.StructType([T.StructField("demand", T.LongType())]))


@needs_data
def test_learner_cross_validation_folds(spark):
    rows = Inputs(spark, SF).model_rows
    seen = []

    def fit(train):
        seen.append(train.agg(F.max("week")).first()[0])
        return lambda val: val.select("sku_id", "week", F.lit(1.0).alias("p50"))

    made = L.walk_forward_cv_learner(rows, fit, "one").collect()
    assert len(set(seen)) == len(seen) == len(made) == 5           # folds run at the same time, in any order
