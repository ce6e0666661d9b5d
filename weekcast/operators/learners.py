"""Boosted-tree learners (B5-B7): ``boosting`` fits them, ``forest`` scores them.

Missing inputs stay missing: each split learns the side they go to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.functions.constants import FEATURE_COLUMNS, QUANTILES
from weekcast.operators.boosting import Fit, HistogramBoost
from weekcast.operators.forest import Forest


class QuantileBoost:
    """P10 / P50 / P90 boosted trees with pinball loss and early stopping, all quantiles in the same jobs.

    The defaults are the analysed workload's: 500 rounds of 63 leaves, learning
    rate 0.05, 80 % of the columns for each tree, and a stop after 50 rounds
    without a better validation loss.
    """

    def __init__(self, features: list[str] = FEATURE_COLUMNS, quantiles: dict[str, float] = QUANTILES, **options):
        self.features, self.quantiles, self.options = features, quantiles, options
        self.models: dict[str, Fit] = {}
        self.forest: Forest | None = None

    def fit(self, train: DataFrame, val: DataFrame | None = None) -> "QuantileBoost":
        boost = HistogramBoost(list(self.features), dict(self.quantiles), **self.options).fit(train, val)
        self.models, self.forest = boost.fits, Forest.of(boost)
        return self

    def transform(self, df: DataFrame, ordered: bool = False) -> DataFrame:
        """Adds p10 / p50 / p90 (at least 0; sorted in each row if ``ordered``)."""
        return self.forest.transform(df, ordered)

    def feature_importance(self, name: str = "p50") -> list[tuple[str, float]]:
        return self.forest.importance(name)


def point_boost(train: DataFrame, val: DataFrame | None = None, features: list[str] = FEATURE_COLUMNS, depthwise: bool = False, **options) -> Forest:
    """Squared-error boosted trees with early stopping.

    Leaf-wise like B5's, or ``depthwise``: whole levels down to depth 6, 80 % of
    the rows for each tree, one row's weight added to each leaf.
    """
    if depthwise:
        options = {"leaves": 64, "depth": 6, "row_share": 0.8, "l2": 1.0, **options}
    return Forest.of(HistogramBoost(list(features), {"p50": None}, **options).fit(train, val))


def quantile_and_point_boost(train: DataFrame, val: DataFrame | None = None, features: list[str] = FEATURE_COLUMNS, quantiles: dict[str, float] = QUANTILES,
                             **options) -> tuple[QuantileBoost, Forest]:
    """B5 and the leaf-wise B6 on the same rows, grown in the same jobs: the trees of ``QuantileBoost.fit`` and ``point_boost``."""
    point = "squared"
    while point in quantiles:
        point += "_"
    boost = HistogramBoost(list(features), {**quantiles, point: None}, draws={point: 0}, **options).fit(train, val)
    model = QuantileBoost(features, quantiles, **options)
    model.models, model.forest = {n: boost.fits[n] for n in quantiles}, Forest.of(boost, {n: n for n in quantiles})
    return model, Forest.of(boost, {"p50": point})


def point_predict(model: Forest, df: DataFrame) -> DataFrame:
    return model.transform(df.select("sku_id", "week", *model.features)).select("sku_id", "week", "p50")


def importance_frame(spark, pairs: list[tuple[str, float]]) -> DataFrame:
    """B7 as a DataFrame (feature, importance), descending."""
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(F.desc("importance"), "feature")
