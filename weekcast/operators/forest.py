"""A fitted forest as flat arrays: one vectorised pass scores all trees of all models.

Every tree becomes a table ``next[node, bin]``; leaves lead to themselves. A
batch of rows is cut into bins once, at the thresholds that the forest uses, and
each tree is walked for all rows together. The plan is one projection, however
many trees there are. The forest also is a table of nodes (``frame``), so it can
be stored, versioned and read back like any other data.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekcast.session import ship_code

NODE_SCHEMA = ("model string, start double, rate double, tree int, node int, feature string, threshold double, missing_left boolean, "
               "left int, right int, value double")


@dataclass
class FlatTree:
    """Numbered nodes; ``feature`` is -1 in a leaf. A row goes left if its value is at most ``threshold``."""

    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int


@dataclass
class Forest:
    """Models (name -> start, trees) that share features and a learning rate."""

    features: list[str]
    rate: float
    start: dict[str, float]
    trees: dict[str, list[FlatTree]]
    _tables: dict | None = field(default=None, repr=False)

    @classmethod
    def of(cls, boost, models: dict[str, str] | None = None) -> "Forest":
        """The forest of a fitted ``HistogramBoost``, or of some of its ``models`` (name here -> name there)."""
        fits = {n: boost.fits[there] for n, there in models.items()} if models is not None else boost.fits
        trees = {name: [_flat(t, boost.edges) for t in fit.trees] for name, fit in fits.items()}
        return cls(list(boost.features), boost.learning_rate, {n: f.start for n, f in fits.items()}, trees)

    # -------------------------------------------------------------- as a table
    def frame(self, spark: SparkSession) -> DataFrame:
        """A row for each node; a model without trees has one row without a tree, which keeps its start."""
        rows = []
        for name, trees in self.trees.items():
            for k, t in enumerate(trees):
                rows += [(name, self.start[name], self.rate, k, n, None if t.feature[n] < 0 else self.features[t.feature[n]], float(t.threshold[n]),
                          bool(t.missing_left[n]), int(t.left[n]), int(t.right[n]), float(t.value[n])) for n in range(len(t.feature))]
            if not trees:
                rows.append((name, self.start[name], self.rate, None, None, None, None, None, None, None, None))
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @classmethod
    def read(cls, nodes: DataFrame, features: list[str]) -> "Forest":
        """A forest from its table (bounded by rounds x leaves, not by data)."""
        held = nodes.orderBy("model", "tree", "node").toPandas()
        place = {f: k for k, f in enumerate(features)}
        start, trees, rate = {}, {}, 0.0
        for name, rows in held.groupby("model", sort=False):
            start[name], rate, trees[name] = float(rows["start"].iloc[0]), float(rows["rate"].iloc[0]), []
            for _, t in rows.dropna(subset=["tree"]).groupby("tree"):
                feature = np.array([place[f] if f is not None else -1 for f in t["feature"].astype(object).where(t["feature"].notna(), None)], dtype=np.int64)
                flat = FlatTree(feature, t["threshold"].to_numpy(float), t["missing_left"].to_numpy(bool), t["left"].to_numpy(np.int64), t["right"].to_numpy(np.int64), t["value"].to_numpy(float), 0)
                flat.depth = _depth(flat)
                trees[name].append(flat)
        return cls(list(features), rate, start, trees)

    # -------------------------------------------------------------- scoring
    def _prepare(self) -> dict:
        if self._tables is None:
            every = [t for trees in self.trees.values() for t in trees]
            edges = []
            for f in range(len(self.features)):
                used = [t.threshold[(t.feature == f) & np.isfinite(t.threshold)] for t in every]
                edges.append(np.unique(np.concatenate(used)) if used else np.zeros(0))
            width = max((len(e) for e in edges), default=0) + 2
            tables = {name: [self._table(t, edges, width) for t in trees] for name, trees in self.trees.items()}
            self._tables = {"edges": edges, "width": width, "tables": tables}
        return self._tables

    def _table(self, t: FlatTree, edges: list[np.ndarray], width: int) -> tuple:
        """(feature of each node, next[node x bin], value, depth)."""
        n = len(t.feature)
        after = np.repeat(np.arange(n)[:, None], width, axis=1)
        for k in np.flatnonzero(t.feature >= 0).tolist():
            left = np.searchsorted(edges[t.feature[k]], t.threshold[k], side="right") if np.isfinite(t.threshold[k]) else width
            after[k, 1:] = np.where(np.arange(1, width) <= left, t.left[k], t.right[k])
            after[k, 0] = t.left[k] if t.missing_left[k] else t.right[k]
        kind = np.uint8 if n <= 256 else np.uint32
        return np.maximum(t.feature, 0), after.astype(kind).ravel(), t.value, t.depth

    def predict(self, values: np.ndarray) -> dict[str, np.ndarray]:
        """Predictions of each model for a (rows x features) array; NaN is missing."""
        made = self._prepare()
        n, width = len(values), made["width"]
        bins = np.zeros((len(self.features), n), dtype=np.int64)
        for f, e in enumerate(made["edges"]):
            column = values[:, f]
            bins[f] = np.where(np.isnan(column), 0, np.searchsorted(e, column, side="left") + 1)
        flat, row = bins.ravel(), np.arange(n)
        out = {}
        for name, tables in made["tables"].items():
            total = np.full(n, self.start[name])
            for feature, after, value, depth in tables:
                node = np.zeros(n, dtype=np.int64)
                for _ in range(depth):
                    node = after[node * width + flat[feature[node] * n + row]].astype(np.int64)
                total += self.rate * value[node]
            out[name] = total
        return out

    def transform(self, df: DataFrame, ordered: bool = False) -> DataFrame:
        """``df`` with a column for each model, at least 0; ``ordered`` sorts each row's predictions (no quantile crossing).

        Null and NaN inputs are missing. Input columns named like a model are replaced.
        """
        spark = df.sparkSession
        ship_code(spark)
        names = list(self.trees)
        self._prepare()
        shared = spark.sparkContext.broadcast(self)         # at most rounds x leaves nodes

        def score(rows: pd.DataFrame) -> pd.DataFrame:
            found = shared.value.predict(rows.to_numpy(dtype=np.float64))
            table = np.maximum(np.stack([found[n] for n in names], axis=1), 0.0)
            return pd.DataFrame(np.sort(table, axis=1) if ordered else table, columns=names)

        made = F.pandas_udf(score, ", ".join(f"`{n}` double" for n in names))
        inputs = F.struct(*[F.col(c).cast("double").alias(c) for c in self.features])
        keep = [c for c in df.columns if c not in names]
        scored = df.select(*keep, made(inputs).alias("_scored"))
        return scored.select(*keep, *[F.col(f"_scored.{n}").alias(n) for n in names])

    def importance(self, name: str) -> list[tuple[str, float]]:
        """Each input's share of one model's splits, descending."""
        counts = np.zeros(len(self.features))
        for t in self.trees[name]:
            np.add.at(counts, t.feature[t.feature >= 0], 1)
        total = counts.sum() or 1.0
        return sorted(((f, float(c / total)) for f, c in zip(self.features, counts, strict=True)), key=lambda x: (-x[1], x[0]))


def _flat(tree, edges: list[np.ndarray]) -> FlatTree:
    """The reachable nodes of a grown tree, numbered anew, with thresholds instead of bins."""
    order, number = [0], {0: 0}
    for k in order:
        for c in (int(tree.left[k]), int(tree.right[k])):
            if c not in number:
                number[c] = len(order)
                order.append(c)
    inner = [int(tree.left[k]) != k for k in order]

    def threshold(k: int) -> float:
        e = edges[int(tree.feature[k])]
        b = int(tree.bin[k])
        return float(e[b - 1]) if b <= len(e) else np.inf

    return FlatTree(np.array([int(tree.feature[k]) if i else -1 for k, i in zip(order, inner, strict=True)], dtype=np.int64),
                    np.array([threshold(k) if i else np.nan for k, i in zip(order, inner, strict=True)]),
                    np.array([bool(tree.missing_left[k]) for k in order]), np.array([number[int(tree.left[k])] for k in order]),
                    np.array([number[int(tree.right[k])] for k in order]), tree.value[order].astype(float), tree.depth)


def _depth(t: FlatTree) -> int:
    deep = np.zeros(len(t.feature), dtype=int)
    for k in range(len(t.feature)):             # children are numbered after their parent
        if t.feature[k] >= 0:
            deep[t.left[k]] = deep[t.right[k]] = deep[k] + 1
    return int(deep.max(initial=0))
