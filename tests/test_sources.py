"""Declared CSV sources and the versioned store."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weekcast.operators.splits import holdout_split, in_week_set
from weekcast.plans.context import Inputs
from weekcast.sources import files as FS
from weekcast.sources import versions as VS

SF = "/root/testdata/sf0.001"


def write(path, name, *lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path / "meta", "a.csv", "﻿unit_cost,supplier_region, sku_id ,extra,lead_time_weeks,category", "1.5,NA,P1,x,3,seasonal", "inf,EMEA,P2,y,4.0,slow_moving", "NaN,,P3,z,,")
    rows = FS.scan_sku_metadata(spark, path).orderBy("sku_id").collect()
    assert [tuple(r) for r in rows] == [("P1", "seasonal", "NA", 1.5, 3), ("P2", "slow_moving", "EMEA", None, 4), ("P3", None, None, None, None)]
    assert FS.read_sku_metadata(spark, path)[1].count() == 0


def test_bad_rows_are_rejected_with_their_reasons(spark, tmp_path):
    path = write(tmp_path / "demand", "a.csv", "week,sku_id,demand,promotion_flag,stockout_flag,holiday_flag",
                 "2024-01-01,P1,3,1,0,0", "2024-13-01,P2,4,0,0,0", "2024-01-08,,oops,0,0,0", "2024-01-15,P4,-inf,0,0.0,1", "2024-01-22,P5,7", "2024-01-29,P6,,x,0,0", ",P7,1,0,0,0")
    accepted, rejected = FS.read_demand(spark, path)
    assert [tuple(r) for r in accepted.orderBy("week").collect()] == [("P1", dt.date(2024, 1, 1), 3.0, 0, 0, 1), ("P4", dt.date(2024, 1, 15), None, 0, 1, 0)]
    got = {r.line: r.reasons for r in rejected.collect()}
    assert sorted(map(tuple, got.values())) == sorted([("week: not a date: 2024-13-01",), ("sku_id: missing", "demand: not a number: oops"),
                                                       ("wrong number of fields",), ("promotion_flag: not a whole number: x",), ("week: missing",)])
    assert accepted.count() + rejected.count() == 7 and all(r.file.endswith("a.csv") for r in rejected.collect())


def test_headers_that_do_not_fit(spark, tmp_path):
    path = write(tmp_path / "one", "a.csv", "sku_id,week", "P1,2024-01-01")
    with pytest.raises(ValueError, match="demand, stockout_flag"):
        FS.scan_demand(spark, path)
    path = write(tmp_path / "two", "a.csv", "sku_id,category,supplier_region,unit_cost,lead_time_weeks", "P1,a,NA,1,2")
    write(tmp_path / "two", "b.csv", "sku_id,supplier_region,category,unit_cost,lead_time_weeks", "P2,NA,a,1,2")
    with pytest.raises(Exception, match="(?i)header"):
        FS.scan_sku_metadata(spark, path).collect()
    (tmp_path / "none").mkdir()
    assert FS.scan_demand(spark, str(tmp_path / "none")).collect() == []
    with pytest.raises(FileNotFoundError):
        FS.scan_demand(spark, str(tmp_path / "absent"))


def test_drift_log(spark, tmp_path):
    root = str(tmp_path / "log")
    row = lambda stamp, wape: spark.createDataFrame([(stamp, wape)], "timestamp string, baseline_wape double")
    for stamp, wape in (("20240301", 1.0), ("20240101", 2.0), ("20240301", 3.0)):
        FS.write_drift_summary(row(stamp, wape), root)
    assert [r.baseline_wape for r in FS.latest_drift_summary(spark, root).collect()] == [3.0]
    (tmp_path / "empty").mkdir()
    assert FS.latest_drift_summary(spark, str(tmp_path / "empty")).collect() == []


# ------------------------------------------------------------------ versions
@pytest.fixture()
def history(spark):
    return (spark.range(300).select(F.concat(F.lit("P"), (F.col("id") % 3).cast("string")).alias("sku_id"),
                                    F.expr("date_add(date'2020-01-06', cast(7 * (id div 3) as int))").alias("week"), F.col("id").cast("double").alias("demand")))


def scan(df):
    """(partition filters, number of files read) of a scan without a shuffle."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.toString().split("PartitionFilters: [")[1].split("]")[0], leaf.metrics().apply("numFiles").value()


def test_a_range_of_weeks_reads_its_years(spark, tmp_path, history):
    root = str(tmp_path)
    VS.write_feature_version(history, root, "v1")
    first = dt.date(2021, 6, 7)
    part = VS.read_feature_version(spark, root, "v1", first=first)
    filters, files = scan(part)
    whole = VS.read_feature_version(spark, root, "v1")
    assert "week_year" in filters and files < scan(whole)[1]
    assert part.count() == history.filter(F.col("week") >= first).count() and whole.columns == history.columns
    assert sorted(whole.collect()) == sorted(history.collect())


def test_weeks_are_added_without_a_rewrite(spark, tmp_path, history):
    root = str(tmp_path)
    early, late = history.filter("week < '2021-11-01'"), history.filter("week = '2021-11-01'")
    VS.write_feature_version(early, root, "v1")
    before = set(VS.read_feature_version(spark, root, "v1").inputFiles())
    VS.append_weeks(late, root, "v1")
    now = VS.read_feature_version(spark, root, "v1")
    assert before < set(now.inputFiles()) and sorted(now.collect()) == sorted(early.unionByName(late).collect())
    with pytest.raises(ValueError, match="already has weeks"):
        VS.append_weeks(late, root, "v1")
    with pytest.raises(ValueError, match="schema"):
        VS.append_weeks(late.withColumn("demand", F.lit("x")), root, "v1")
    twice = history.filter("year(week) = 2020").withColumn("demand", F.lit(-1.0))
    VS.replace_years(twice, root, "v1")
    again = VS.read_feature_version(spark, root, "v1")
    assert again.filter("demand = -1").count() == twice.count() and again.count() == early.count() + late.count()


def test_only_committed_files_are_seen(spark, tmp_path, history):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        VS.append_weeks(history, root, "v1")
    VS._write_run(history, VS._base(root, "v1"))                 # a writer that was lost before its manifest
    with pytest.raises(FileNotFoundError):
        VS.read_feature_version(spark, root, "v1")
    assert VS.list_versions(spark, root) == []
    VS.write_feature_version(history.limit(30), root, "v1")
    VS.write_feature_version(history.limit(60), root, "v1")
    assert VS.read_feature_version(spark, root, "v1").count() == 60
    with pytest.raises(Exception, match="(?i)exist"):
        VS._commit(spark, VS._base(root, "v1"), 2, {})           # another writer's number
    VS.write_feature_version(history.limit(0), root, "v2")
    assert VS.latest_feature_version(spark, root)[1] == "v2" and VS.latest_feature_version(spark, root)[0].collect() == []


def test_splits_of_the_stored_features_read_their_years(spark):
    x = Inputs(spark, SF)
    train, test = holdout_split(x.model_rows)
    for df in (test.select("sku_id", "week", "demand"), in_week_set(x.features, x.features.select("week").distinct().orderBy(F.desc("week")).limit(3)).select("sku_id", "week")):
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        assert any("week_year" in part.split("]")[0] for part in text.split("PartitionFilters: [")[1:])
    plain = Inputs(spark, SF, materialized=False)
    assert test.count() == holdout_split(plain.model_rows)[1].count() and train.count() == holdout_split(plain.model_rows)[0].count()
