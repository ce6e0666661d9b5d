"""Boosting against a plain version, learner invariants, the flat forest."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weekcast.functions.constants import FEATURE_COLUMNS
from weekcast.operators import boosting
from weekcast.operators.boosting import HistogramBoost, residual_code, residual_of, to_bins
from weekcast.operators.forest import Forest
from weekcast.operators.learners import QuantileBoost, point_boost, quantile_and_point_boost
from weekcast.operators.splits import holdout_split
from weekcast.plans import catalog
from weekcast.plans.catalog import QUERIES
from weekcast.plans.context import Inputs

SF = "/root/testdata/sf0.001"
NAMES = [f"x{k}" for k in range(6)]


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(11)
    n = 1500
    x = np.stack([rng.normal(size=n), rng.integers(0, 9, n), rng.integers(0, 2, n), rng.exponential(size=n) * 50, rng.normal(size=n), np.full(n, np.nan)], axis=1)
    x[rng.random(x.shape) < 0.12] = np.nan
    y = np.where(np.isnan(x[:, 0]), 20.0, 5 * np.nan_to_num(x[:, 0])) + np.nan_to_num(x[:, 1]) ** 1.5 + 0.1 * np.nan_to_num(x[:, 3]) + rng.gamma(2, 2, n)
    return x, y


@pytest.fixture(scope="module")
def frame(spark, table):
    x, y = table
    rows = [(*[None if np.isnan(v) else float(v) for v in r], float(t)) for r, t in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in NAMES) + ", demand double")


def plain_boost(x, y, edges, alpha, start, rounds, rate, leaves, min_rows, scale):
    """Boosting with exhaustive splits on the whole table: [(splits in best-first order), ...], predictions."""
    bins = np.stack([to_bins(x[:, f], e) for f, e in enumerate(edges)])
    q, out = np.full(len(y), start), []
    for _ in range(rounds):
        unit = (y > q).astype(np.int64) if alpha is not None else np.rint((y - q) * scale).astype(np.int64)

        def worth(n, u):
            g = alpha * u + (alpha - 1) * (n - u) if alpha is not None else u / scale
            return g * g / max(n, 1e-12)

        def best(rows):
            n, u, found = len(rows), int(unit[rows].sum()), None
            for f, e in enumerate(edges):
                b = bins[f][rows]
                for cut in range(1, len(e) + 2):
                    for missing_left in (True, False):
                        if cut == len(e) + 1 and (missing_left or not (b == 0).any()):
                            continue
                        left = np.where(b == 0, missing_left, b <= cut)
                        ln = int(left.sum())
                        if ln < min_rows or n - ln < min_rows:
                            continue
                        lu = int(unit[rows][left].sum())
                        gain = worth(float(ln), float(lu)) + worth(float(n - ln), float(u - lu)) - worth(float(n), float(u))
                        if gain > 1e-9 and (found is None or gain > found[0]):
                            found = (gain, f, cut, missing_left, rows[left], rows[~left])
            return found

        open_leaves, splits = [(np.arange(len(y)), best(np.arange(len(y))))], []
        while len(open_leaves) < leaves and any(s for _, s in open_leaves):
            at = max((k for k, (_, s) in enumerate(open_leaves) if s), key=lambda k: open_leaves[k][1][0])
            _, s = open_leaves.pop(at)
            splits.append((round(s[0], 6), s[1], s[2], s[3]))
            open_leaves += [(s[4], best(s[4])), (s[5], best(s[5]))]
        for rows, _ in open_leaves:
            r = (y - q)[rows]
            if alpha is None:
                value = np.rint(r * scale).sum() / scale / len(rows)
            else:
                codes = np.sort(residual_code(r))
                value = residual_of(int(codes[int(np.ceil(alpha * len(rows))) - 1]))
            q[rows] += rate * value
        out.append(splits)
    return out, q


def chosen(tree):
    return sorted((int(tree.feature[k]), int(tree.bin[k]), bool(tree.missing_left[k])) for k in range(len(tree.left)) if tree.left[k] != k)


@pytest.mark.parametrize(("alpha", "parts"), [(0.1, 3), (0.5, 1), (0.9, 7), (None, 4)])
def test_splits_equal_a_plain_version(frame, table, alpha, parts):
    """Same splits, leaf values and predictions, however the rows are dealt."""
    x, y = table
    boost = HistogramBoost(NAMES, {"m": alpha}, rounds=3, learning_rate=0.3, leaves=9, min_rows=15, column_share=1.0, bins=32).fit(frame.repartition(parts))
    fit = boost.fits["m"]
    want, q = plain_boost(x, y, boost.edges, alpha, fit.start, 3, 0.3, 9, 15, boost.scale)
    assert [chosen(t) for t in fit.trees] == [sorted(s[1:] for s in splits) for splits in want]
    assert Forest.of(boost).predict(x)["m"] == pytest.approx(q, abs=1e-9)


@pytest.mark.parametrize("alpha", [0.5, None])
def test_small_leaves_grow_in_one_pass(frame, table, alpha, monkeypatch):
    """A tree of few rows takes two passes; the same trees if none, some or all of its leaves are small."""
    x, y = table
    passes, real = [], boosting.HistogramBoost._histograms
    monkeypatch.setattr(boosting.HistogramBoost, "_histograms", lambda *a: passes.append(a[2]) or real(*a))
    want = None
    for small in (1 << 13, 300, 0):
        monkeypatch.setattr(boosting, "SMALL", small)
        passes.clear()
        boost = HistogramBoost(NAMES, {"m": alpha}, rounds=2, learning_rate=0.3, leaves=24, min_rows=15, column_share=1.0, bins=32).fit(frame.repartition(3))
        want = want or plain_boost(x, y, boost.edges, alpha, boost.fits["m"].start, 2, 0.3, 24, 15, boost.scale)
        assert [chosen(t) for t in boost.fits["m"].trees] == [sorted(s[1:] for s in splits) for splits in want[0]], small
        assert Forest.of(boost).predict(x)["m"] == pytest.approx(want[1], abs=1e-9)
        assert len(passes) == 4 if small > len(y) else len(passes) > 4, small
        assert small or len(passes) > 8


def test_a_quantile_beside_squared_error(frame):
    """The same leaf values as by itself."""
    alone, beside = (HistogramBoost(NAMES, targets, rounds=2, leaves=9, column_share=1.0, bins=32).fit(frame).fits["b"] for targets in ({"b": 0.5}, {"b": 0.5, "a": None}))
    assert [t.value.tolist() for t in alone.trees] == [t.value.tolist() for t in beside.trees]


def test_learners_side_by_side(frame, table, monkeypatch):
    """Quantiles and squared error in the same jobs: the trees and losses of their own fits, in fewer passes."""
    passes, real = [], boosting.HistogramBoost._histograms
    monkeypatch.setattr(boosting.HistogramBoost, "_histograms", lambda *a: passes.append(a[2]) or real(*a))
    monkeypatch.setattr(boosting, "SMALL", 300)
    options = {"rounds": 3, "learning_rate": 0.3, "leaves": 9, "min_rows": 15, "bins": 32, "early_stopping": 2}
    train, val = frame.filter("demand < 30"), frame.filter("demand >= 30")
    quantiles, point = QuantileBoost(NAMES, **options).fit(train, val), point_boost(train, val, NAMES, **options)
    alone = len(passes)
    passes.clear()
    both, beside = quantile_and_point_boost(train, val, NAMES, **options)
    assert 0 < len(passes) < alone

    def flat(forest):
        return {n: [[c.tolist() for c in (t.feature, t.threshold[t.feature >= 0], t.missing_left, t.left, t.right, t.value)] for t in trees] for n, trees in forest.trees.items()}

    assert list(both.forest.trees) == ["p10", "p50", "p90"] and list(beside.trees) == ["p50"]
    assert flat(both.forest) == flat(quantiles.forest) and flat(beside) == flat(point)
    assert both.forest.start == quantiles.forest.start and beside.start == pytest.approx(point.start)
    assert {n: f.rounds for n, f in both.models.items()} == {n: f.rounds for n, f in quantiles.models.items()}
    for name, p in quantiles.forest.predict(table[0]).items():
        assert both.forest.predict(table[0])[name] == pytest.approx(p)
    assert beside.predict(table[0])["p50"] == pytest.approx(point.predict(table[0])["p50"])


def test_depth_rows_and_columns(frame):
    boost = HistogramBoost(NAMES, {"a": None, "b": 0.5}, rounds=4, depth=2, leaves=64, row_share=0.8, column_share=0.5, l2=1.0, bins=32).fit(frame)
    for fit in boost.fits.values():
        assert all(t.depth <= 2 for t in fit.trees) and len(fit.trees) == 4
        losses = [h[1] for h in fit.history]
        assert losses[-1] < losses[0]
        used = [{int(t.feature[k]) for k in range(len(t.left)) if t.left[k] != k} for t in fit.trees]
        assert all(len(u) <= 2 for u in used) and len(set().union(*used)) > 2     # half of the 5 features that have values


def test_early_stop_and_odd_tables(spark, frame, table):
    noise = frame.withColumn("demand", F.rand(3))
    fit = HistogramBoost(NAMES, {"m": 0.5}, rounds=40, learning_rate=0.5, early_stopping=3, bins=16).fit(noise, noise.withColumn("demand", F.rand(4))).fits["m"]
    best = min(fit.history, key=lambda h: h[2])[0]
    assert fit.rounds < 40 and len(fit.trees) == best and fit.rounds == best + 3
    empty = HistogramBoost(NAMES, {"m": 0.5}).fit(frame.limit(0))
    assert Forest.of(empty).transform(frame.limit(2)).select("m").collect()[0].m == 0.0
    flat = HistogramBoost(NAMES, {"m": None}, rounds=5, bins=16).fit(frame.withColumn("demand", F.lit(7.0)))
    assert flat.fits["m"].start == 7.0 and Forest.of(flat).predict(table[0])["m"] == pytest.approx(np.full(1500, 7.0))
    holes = frame.withColumn("demand", F.when(F.col("x1") > 4, F.col("demand")).when(F.col("x1") > 2, F.lit(float("nan"))))
    assert HistogramBoost(NAMES, {"m": 0.9}, rounds=2, bins=16).fit(holes).fits["m"].start > 0


def test_flat_forest(spark, frame, table):
    """Table round trip; a plan that doesn't grow with the trees; ordered quantiles."""
    few = QuantileBoost(NAMES, rounds=2, leaves=7, bins=32).fit(frame)
    many = QuantileBoost(NAMES, rounds=12, leaves=7, bins=32).fit(frame)
    plan = lambda m: m.transform(frame)._jdf.queryExecution().executedPlan().toString().count("\n")
    assert plan(few) == plan(many)
    back = Forest.read(many.forest.frame(spark), NAMES)
    for name, p in many.forest.predict(table[0]).items():
        assert back.predict(table[0])[name] == pytest.approx(p)
    got = many.transform(frame, ordered=True).select("p10", "p50", "p90").toPandas()
    assert (got["p10"] <= got["p50"]).all() and (got["p50"] <= got["p90"]).all() and (got.min() >= 0).all()
    raw = many.forest.predict(table[0])
    assert np.allclose(np.sort(np.maximum(np.stack([raw[k] for k in ("p10", "p50", "p90")], axis=1), 0), axis=1)[:, 1].sum(), got["p50"].sum())


def test_quantile_boost_on_the_panel(spark):
    fit, val = holdout_split(Inputs(spark, SF).model_rows)
    model = QuantileBoost(rounds=3, leaves=15, early_stopping=5).fit(fit, val)
    for m in model.models.values():
        losses = [h[1] for h in m.history]
        assert all(b <= a + 1e-6 for a, b in zip(losses, losses[1:], strict=False)), losses
    pred = model.transform(fit.select("sku_id", "week", "demand", *FEATURE_COLUMNS))
    stats = pred.agg(
        F.min(F.least("p10", "p50", "p90")).alias("lo"),
        F.avg((F.col("demand") <= F.col("p10")).cast("double")).alias("b10"),
        F.avg((F.col("demand") <= F.col("p50")).cast("double")).alias("b50"),
        F.avg((F.col("demand") <= F.col("p90")).cast("double")).alias("b90")).first()
    assert stats["lo"] >= 0
    assert stats["b10"] <= stats["b50"] <= stats["b90"]
    assert stats["b90"] >= 0.75
    assert abs(sum(v for _, v in model.feature_importance("p50")) - 1.0) < 1e-9
    assert len(point_boost(fit, val, rounds=2, depthwise=True).trees["p50"]) >= 1


def flat_trees(trees):
    """Each tree's splits and its leaves' values, in no order of nodes."""
    return [(sorted((int(f), float(e), bool(m)) for f, e, m in zip(t.feature, t.threshold, t.missing_left, strict=True) if f >= 0), sorted(t.value[t.feature < 0])) for t in trees]


@pytest.mark.parametrize("options", [{"leaves": 24}, {"leaves": 16, "depth": 3, "l2": 1.0, "column_share": 0.5}])
def test_a_fit_in_one_task(frame, table, options):
    """Every model in a task of its own: the trees, losses and stops of the passes over all blocks."""
    targets, train, val = {"low": 0.1, "mid": 0.5, "mean": None}, frame.filter("x1 < 7 or x1 is null"), frame.filter("x1 >= 7")
    passes, alone = (HistogramBoost(NAMES, targets, rounds=6, learning_rate=0.4, min_rows=15, bins=32, early_stopping=2, one_task=cells, **options).fit(train, val) for cells in (0, 1 << 20))
    for name in targets:
        a, b = passes.fits[name], alone.fits[name]
        assert (a.start, a.rounds, len(a.trees)) == (b.start, b.rounds, len(b.trees)) and len(a.trees)
        assert [h[0] for h in a.history] == [h[0] for h in b.history]
        assert [h[1:] for h in b.history] == [pytest.approx(h[1:]) for h in a.history]
        for (splits, values), (want, leaves) in zip(*(flat_trees(Forest.of(b).trees[name]) for b in (alone, passes)), strict=True):
            assert splits == want and values == pytest.approx(leaves)
        assert Forest.of(alone).predict(table[0])[name] == pytest.approx(Forest.of(passes).predict(table[0])[name])


def test_a_fit_in_one_task_stops_and_draws_rows(frame, table):
    noise = frame.withColumn("demand", F.rand(3))
    fit = HistogramBoost(NAMES, {"m": 0.5}, rounds=40, learning_rate=0.5, early_stopping=3, bins=16, one_task=1 << 20).fit(noise, noise.withColumn("demand", F.rand(4))).fits["m"]
    best = min(fit.history, key=lambda h: h[2])[0]
    assert fit.rounds < 40 and len(fit.trees) == best and fit.rounds == best + 3
    flat = HistogramBoost(NAMES, {"m": None}, rounds=5, bins=16, one_task=1 << 20).fit(frame.withColumn("demand", F.lit(7.0)))
    assert Forest.of(flat).predict(table[0])["m"] == pytest.approx(np.full(1500, 7.0))
    some = HistogramBoost(NAMES, {"m": None}, rounds=4, depth=2, leaves=64, row_share=0.8, l2=1.0, bins=32, one_task=1 << 20).fit(frame).fits["m"]
    assert len(some.trees) == 4 and all(t.depth <= 2 for t in some.trees) and some.history[-1][1] < some.history[0][1]


def whole_fits(monkeypatch, spark, key):
    """The (rounds, rate, patience, leaves, shares) that a query's fits ask for; only the first round is run here."""
    asked, real = [], HistogramBoost.fit

    def fit(self, train, val=None):
        asked.append((self.rounds, self.learning_rate, self.early_stopping, self.leaves, self.row_share, self.column_share))
        self.rounds = 1
        return real(self, train, val)

    monkeypatch.setattr(HistogramBoost, "fit", fit)
    monkeypatch.setattr(catalog, "_fitted", {})
    assert QUERIES[key](spark, SF).count()
    return asked


def test_importance_share_runs_the_whole_fit(monkeypatch, spark):
    assert whole_fits(monkeypatch, spark, "importance_share") == [(500, 0.05, 50, 63, 1.0, 0.8)]


def test_leaderboard_all_models_runs_the_whole_fits(monkeypatch, spark):
    """Side by side, and squared error alone where the session has the quantiles."""
    whole = (500, 0.05, 50, 63, 1.0, 0.8)
    assert whole_fits(monkeypatch, spark, "leaderboard_all_models") == [whole]
    model = QuantileBoost(FEATURE_COLUMNS)
    asked = []
    monkeypatch.setattr(catalog.LR, "point_boost", lambda *a, **options: asked.append({k: v for k, v in options.items() if k != "one_task"}))
    x = Inputs(spark, SF)
    monkeypatch.setattr(catalog, "_fitted", {(spark.sparkContext.applicationId, x.fingerprint): model})
    assert catalog._both_run(x)[0] is model and asked == [{}]


def test_walk_forward_cv_learners_runs_whole_fits(monkeypatch, spark):
    assert whole_fits(monkeypatch, spark, "walk_forward_cv_learners") == [(500, 0.05, 50, 63, 1.0, 0.8)] * 5
