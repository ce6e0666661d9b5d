"""As-of join, KS, decision table, gate, versions, splits."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from weekcast.operators import baselines as B
from weekcast.operators import drift as D
from weekcast.operators import gate as G
from weekcast.sources import versions as store


def test_asof_nearest_tie_earliest(spark):
    d = dt.date(2023, 1, 2)
    hist = spark.createDataFrame([("a", d - dt.timedelta(weeks=1), 1.0), ("a", d + dt.timedelta(weeks=1), 2.0)],
                                 "sku_id string, week date, demand double")
    tgt = spark.createDataFrame([("a", d + dt.timedelta(weeks=52), d)], "sku_id string, week date, target_week date")
    row = B.nearest_asof(tgt, hist).first()
    assert row["matched_value"] == 1.0


def test_asof_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt.date(2020, 1, 6)
    hist_rows, tgt_rows = [], []
    for s in "abc":
        weeks = sorted(rnd.sample(range(0, 60), 15))
        hist_rows += [(s, base + dt.timedelta(weeks=w), float(w)) for w in weeks]
        tgt_rows += [(s, base + dt.timedelta(weeks=100 + t), base + dt.timedelta(weeks=t)) for t in range(-5, 70, 7)]
    hist = spark.createDataFrame(hist_rows, "sku_id string, week date, demand double")
    tgt = spark.createDataFrame(tgt_rows, "sku_id string, week date, target_week date")
    got = {(r["sku_id"], r["week"]): r["matched_value"] for r in B.nearest_asof(tgt, hist).collect()}
    for s, w, t in tgt_rows:
        cands = sorted([(abs((h[1] - t).days), h[1], h[2]) for h in hist_rows if h[0] == s])
        assert got[(s, w)] == cands[0][2]


def _ks_brute(a, b):
    vals = sorted(set(a) | set(b))
    return max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in vals)


@pytest.mark.parametrize("a,b,expect", [
    ([0, 0, 0, 1, 1, 2, 2, 2, 3], [0, 1, 1, 1, 2, 5, 5], None),
    ([1, 2, 3, 4], [1, 2, 3, 4], 0.0),
    ([1, 2, 3], [10, 11], 1.0),
])
def test_ks_statistic(spark, a, b, expect):
    ref = spark.createDataFrame([(float(x),) for x in a], "x double")
    cur = spark.createDataFrame([(float(x),) for x in b], "x double")
    row = D.ks_two_sample(ref, cur, ["x"]).first()
    want = _ks_brute(a, b) if expect is None else expect
    assert row["ks_statistic"] == pytest.approx(want)
    assert 0.0 <= row["p_value"] <= 1.0


def test_ks_skips_empty_side(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    cur = spark.createDataFrame([(None,)], "x double")
    assert D.ks_two_sample(ref, cur, ["x"]).count() == 0


def test_action_table_all_combinations(spark):
    combos = list(itertools.product(["ok", "warning", "retrain"], ["ok", "drift"], ["ok", "retrain"]))
    df = spark.createDataFrame(combos, "d string, p string, f string")
    got = {tuple(r[:3]): r["a"] for r in df.select("*", D.action_column(F.col("d"), F.col("p"), F.col("f"))
                                                   .alias("a")).collect()}
    for (d, p, f), a in got.items():
        if f == "retrain" and d in ("retrain", "warning"):
            assert a == "immediate_retrain_and_alert"
        elif f == "retrain":
            assert a == "immediate_retrain"
        elif d == "retrain":
            assert a == "scheduled_retrain"
        elif d == "warning" or p == "drift":
            assert a == "warning"
        else:
            assert a == "no_action"
    assert len(set(got.values())) == 5


def test_gate_strict_and_missing(spark):
    thr = (100.0 - 98.0) / (100.0 + 1e-8)
    rows = [("prod", "all", "wape", 100.0), ("c1", "all", "wape", 98.0),
            ("c2", "all", "wape", None), ("c3", "all", "bias", 1.0), ("prod", "all", "bias", 2.0),
            ("c4", "seg", "wape", 50.0), ("c5", "all", "coverage_80pct", 90.0), ("prod", "all", "coverage_80pct", 80.0)]
    m = spark.createDataFrame(rows, "model string, segment string, metric string, value double")
    out = {(r["candidate"], r["metric"]): (r["promotion_status"], r["reason"])
           for r in G.promotion_gate(m, "prod", threshold=thr).collect()}
    assert out[("c1", "wape")] == ("rejected", "below_threshold")          # gain == threshold: strict >
    assert out[("c2", "wape")] == ("rejected", "missing_candidate_metric")
    assert out[("c3", "bias")] == ("rejected", "unknown_metric")
    assert out[("c4", "wape")] == ("promoted", "missing_production_metric")
    assert out[("c5", "coverage_80pct")] == ("promoted", "improved")


def test_current_stage_replay(spark):
    ev = spark.createDataFrame([("m", "v1", "promote", 1), ("m", "v2", "promote", 2), ("m", "v1", "rollback", 3)],
                               "model_name string, version string, event_type string, event_time long")
    st = {r["version"]: r["stage"] for r in G.current_stage(ev).collect()}
    assert st == {"v1": "Production", "v2": "Archived"}


def test_latest_version_numeric(spark, tmp_path):
    root = str(tmp_path / "fs")
    df = spark.range(3)
    for v in ("v1", "v2", "v10"):
        store.write_feature_version(df, root, v)
    _, latest = store.latest_feature_version(spark, root)
    assert latest == "v10"
    with pytest.raises(FileNotFoundError):
        store.read_feature_version(spark, root, "v3")


def test_na_region_survives_csv(spark, tmp_path):
    from weekcast.sources import files

    meta = spark.createDataFrame([("A", "seasonal", "NA", 250.0, 3)],
                                 "sku_id string, category string, supplier_region string, unit_cost double, "
                                 "lead_time_weeks int")
    path = str(tmp_path / "meta")
    files.write_csv(meta, path)
    assert files.scan_sku_metadata(spark, path).first()["supplier_region"] == "NA"
