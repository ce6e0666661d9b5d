"""Histogram gradient boosting as Spark jobs.

Features are cut into at most 255 bins once, bin 0 for missing values, and the
training rows become blocks of bytes. A tree grows leaf by leaf, the leaf of
greatest gain first. Each pass over the blocks is one Spark job: tasks add up
gradient histograms of all leaves that may be split next, the histograms of a
leaf meet by its key, and the best split of each leaf is all that comes back.
A leaf of few rows sends those rows instead, and the group that gets them grows
all that may follow below it. So a tree costs about as many jobs as its levels
of large leaves, and one more; several models (the quantiles) grow side by side
in the same jobs.

Gradients are integers (pinball: rows above and below the prediction; squared
error: fixed-point residuals), so sums, and with them the trees, don't depend
on how rows are dealt over tasks. A missing value goes to the side with the
greater gain.

Where the rows' bins fit one task's memory (``one_task``), each model instead is
fitted in a task of its own by ``fit_alone``: the same splits, leaf values and
stops, without jobs for each round.

Predictions live in the blocks. They are cached, and every ``CUT`` rounds
checkpointed to the folder that driver and executors share: a lost executor
costs a few rounds' replay.
"""

from __future__ import annotations

import heapq
import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekcast.session import ensure_checkpoint_dir, ship_code

BINS = 255
BLOCK_ROWS = 1 << 16            # rows of a block, at most
LEAST_ROWS = 1 << 12
SMALL = 1 << 13                 # rows of a leaf, at most, that meet in one group to grow all below it
CUT = 25
STEP = 13                       # low bits of a float32 residual that a leaf's quantile ignores (relative error 2**-10)
CODES = 1 << (33 - STEP)        # more than residual codes there are, of both signs
NODES = 1 << 20                 # nodes of one tree, at most
BLOCKS = "block string, val boolean, n int, bins binary, y binary, q binary, loss array<double>"


# ------------------------------------------------------------------ binning
def bin_edges(rows: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper bounds of each feature's bins: approximate quantiles, in one aggregate."""
    probs = F.lit([k / (bins - 1) for k in range(1, bins - 1)])         # made once: a call to the JVM for each literal
    made = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 10_000).alias(f"f{k}") for k, c in enumerate(features)]).first()
    return [np.unique(np.array(e if e is not None else [], dtype=np.float64)) for e in made]


def to_bins(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin 0: missing; bin b + 1: above b edges."""
    out = np.searchsorted(edges, values, side="left") + 1
    return np.where(np.isnan(values), 0, out).astype(np.uint8)


def _blocks(rows: DataFrame, features: list[str], edges: list[np.ndarray], start: list[float], val: bool, tasks: int, size: int) -> DataFrame:
    """Rows, dealt evenly over ``tasks``, as blocks of at most ``size``: bins by feature, target, and every model's start as prediction."""
    table = rows.select(*[F.col(c).cast("double").alias(f"f{k}") for k, c in enumerate(features)], F.col("demand").cast("double").alias("y")).repartition(tasks)

    def emit(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bins, y = np.concatenate([p[0] for p in parts], axis=1), np.concatenate([p[1] for p in parts])
        q = np.repeat(np.array(start)[:, None], len(y), axis=1)
        return _batch(uuid.uuid4().hex, val, len(y), np.ascontiguousarray(bins).tobytes(), y.tobytes(), q.tobytes(), [0.0] * len(start))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            at = 0
            while at < batch.num_rows:
                end = min(batch.num_rows, at + size - held)
                parts.append((np.stack([to_bins(c[at:end], e) for c, e in zip(columns, edges, strict=False)]), columns[-1][at:end]))
                held, at = held + end - at, end
                if held == size:
                    yield emit(parts)
                    parts, held = [], 0
        if held:
            yield emit(parts)

    return table.mapInArrow(run, BLOCKS)


def _batch(block, val, n, bins, y, q, loss) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": [block], "val": [val], "n": pa.array([n], pa.int32()), "bins": pa.array([bins], pa.binary()),
                                       "y": pa.array([y], pa.binary()), "q": pa.array([q], pa.binary()), "loss": pa.array([loss], pa.list_(pa.float64()))})


# ------------------------------------------------------------------ trees
@dataclass
class Tree:
    """Node arrays; a leaf's children are itself. ``bin`` is the last bin that goes left."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each column of ``bins`` (features x rows)."""
        node = np.zeros(bins.shape[1], dtype=np.int32)
        column = np.arange(bins.shape[1])
        for _ in range(self.depth):
            value = bins[self.feature[node], column]
            node = np.where(np.where(value == 0, self.missing_left[node], value <= self.bin[node]), self.left[node], self.right[node])
        return node


@dataclass
class _Node:
    depth: int
    n: int
    total: int                          # gradient sum, in integer units
    split: tuple | None = None          # (gain, feature, bin, missing_left, left n, left total)
    asked: bool = False
    children: tuple[int, int] | None = None


class _Growing:
    """A tree under construction: the leaf of greatest gain is split first."""

    def __init__(self, leaves: int, depth: int | None, columns: np.ndarray):
        self.nodes, self.leaves, self.depth, self.columns = [_Node(0, 0, 0)], leaves, depth, columns
        self.chosen: list[int] = []

    def wanted(self) -> list[int]:
        """Nodes whose best split must be known next; empty when the tree is done.

        Replays the best-first order over what is known. Where it meets children
        whose gains aren't known, it asks for those of all nodes that would be
        split if no child were worth it: the ones with the greatest least gain on
        their path.
        """
        if not self.nodes[0].asked:
            return [0]
        self.chosen, heap = [], []
        self._push(heap, 0)
        while heap and len(self.chosen) + 1 < self.leaves:
            k = heapq.heappop(heap)[1]
            self.chosen.append(k)
            if len(self.chosen) + 1 < self.leaves and not self._known(k):
                done = set(self.chosen)
                ahead = heapq.nsmallest(self.leaves - 1 - len(done), ((-bound, p) for p, bound in self._bounds() if p not in done))
                return [c for p in [k, *(p for _, p in ahead if not self._known(p))] for c in self._open(p)]
            for c in self.nodes[k].children or ():
                self._push(heap, c)
        return []

    def _push(self, heap: list, k: int) -> None:
        s = self.nodes[k].split
        if s is not None and (self.depth is None or self.nodes[k].depth < self.depth):
            heapq.heappush(heap, (-s[0], k))

    def _bounds(self) -> list[tuple[int, float]]:
        """(node, least gain from the root to it) of every node that can be split."""
        out, stack = [], [(0, np.inf)]
        while stack:
            k, least = stack.pop()
            node = self.nodes[k]
            if node.split is not None and (self.depth is None or node.depth < self.depth):
                least = min(least, node.split[0])
                out.append((k, least))
                stack += [(c, least) for c in node.children or () if self.nodes[c].asked]
        return out

    def floor(self) -> float:
        """A node of less gain can't be chosen any more: ``leaves - 1`` nodes have at least this on their whole path."""
        bounds = heapq.nlargest(self.leaves - 1, (bound for _, bound in self._bounds()))
        return bounds[-1] if bounds and len(bounds) == self.leaves - 1 else 0.0

    def small(self, nodes: list[int]) -> dict[int, tuple[int, int | None, float]]:
        """Those of ``nodes`` with few rows: (splits at most, levels at most, least gain) of what grows below each."""
        floor = self.floor()
        return {k: (self.leaves - 1 - self.nodes[k].depth, None if self.depth is None else self.depth - self.nodes[k].depth, floor)
                for k in nodes if 0 < self.nodes[k].n <= SMALL}

    def _known(self, k: int) -> bool:
        made = self.nodes[k].children
        return made is not None and all(self.nodes[c].asked for c in made) or self.depth is not None and self.nodes[k].depth + 1 >= self.depth

    def _open(self, k: int) -> tuple[int, int]:
        node = self.nodes[k]
        if node.children is None:
            _, _, _, _, n, total = node.split
            node.children = (len(self.nodes), len(self.nodes) + 1)
            self.nodes += [_Node(node.depth + 1, n, total), _Node(node.depth + 1, node.n - n, node.total - total)]
        return node.children

    def answer(self, k: int, n: int, total: int, split: tuple | None) -> None:
        node = self.nodes[k]
        node.n, node.total, node.split, node.asked = n, total, split, True

    def tree(self, only: set[int] | None = None) -> Tree:
        """The tree with the chosen splits, or with those of ``only``."""
        inner = set(self.chosen) if only is None else only
        for k in inner:
            self._open(k)
        size = len(self.nodes)
        f, b, m = np.zeros(size, np.int32), np.zeros(size, np.int32), np.zeros(size, bool)
        left, right = np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32)
        for k in inner:
            _, f[k], b[k], m[k], _, _ = self.nodes[k].split
            left[k], right[k] = self.nodes[k].children
        depth = max((self.nodes[k].depth + 1 for k in inner), default=0)
        return Tree(f, b, m, left, right, np.zeros(size), depth)

    def above(self, nodes: list[int]) -> set[int]:
        """The nodes whose splits lead to ``nodes``."""
        parent = {c: k for k, node in enumerate(self.nodes) if node.children for c in node.children}
        out: set[int] = set()
        for k in nodes:
            while k in parent:
                k = parent[k]
                out.add(k)
        return out


# ------------------------------------------------------------------ splits
def best_split(hist: np.ndarray, columns: np.ndarray, edges: np.ndarray, alpha: float | None, scale: float, min_rows: int, l2: float) -> tuple[int, int, tuple | None]:
    """(rows, gradient units, (gain, feature, bin, missing_left, left rows, left units)) of one node.

    ``hist`` is (columns x bins x 2) integers: rows below and above the
    prediction (``alpha``), or rows and fixed-point residuals; ``edges`` says how
    many edges each column has. Bins up to the chosen one go left. Of equal
    gains the first column, then the lower bin, then missing values left.
    """
    rows, units = (hist.sum(axis=2), hist[:, :, 1]) if alpha is not None else (hist[:, :, 0], hist[:, :, 1])
    n, total = int(rows[0].sum()), int(units[0].sum())

    def worth(count, unit):
        g = alpha * unit + (alpha - 1.0) * (count - unit) if alpha is not None else unit / scale
        return g * g / np.maximum(count + l2, 1e-12)

    run_n, run_u = np.cumsum(rows[:, 1:], axis=1), np.cumsum(units[:, 1:], axis=1)
    bins = np.arange(1, hist.shape[1])
    missing_n, missing_u = rows[:, :1], units[:, :1]
    ln = np.stack([run_n + missing_n, run_n], axis=2)                   # missing left, missing right
    lu = np.stack([run_u + missing_u, run_u], axis=2)
    # a split behind the last edge parts present values from missing ones
    may = np.stack([bins[None] <= edges[:, None], (bins[None] <= edges[:, None] + 1) & (missing_n > 0)], axis=2)
    may &= (ln >= min_rows) & (n - ln >= min_rows)
    if not may.any():
        return n, total, None
    gain = worth(ln.astype(float), lu.astype(float)) + worth((n - ln).astype(float), (total - lu).astype(float)) - worth(float(n), float(total))
    gain = np.where(may, gain, -np.inf)
    at = int(np.argmax(gain))
    if gain.flat[at] <= 1e-9:
        return n, total, None
    f, b, right = np.unravel_index(at, gain.shape)
    return n, total, (float(gain.flat[at]), int(columns[f]), int(b) + 1, not right, int(ln.flat[at]), int(lu.flat[at]))


def small_subtree(bins: np.ndarray, unit: np.ndarray, limits: tuple[int, int | None, float], columns: np.ndarray, edges: np.ndarray, width: int,
                  alpha: float | None, scale: float, min_rows: int, l2: float) -> list[tuple[int, int, tuple | None, int | None]]:
    """(rows, gradient units, best split, place of the left child) of a node and of all that may be split below it.

    ``bins`` is (columns x rows), ``unit`` says which rows are above the
    prediction, or their fixed-point residuals. The leaf of greatest gain is
    split first; the right child stands behind the left one. A larger child's
    histogram is its parent's less its sibling's, all in integers.
    """
    splits, levels, floor = limits
    size = len(columns) * width
    code = bins + (np.arange(len(columns), dtype=np.int32) * width)[:, None]

    def histogram(rows: np.ndarray) -> np.ndarray:
        if alpha is not None:
            parts = [np.bincount(code[:, rows[unit[rows] == side]].ravel(), minlength=size) for side in (0, 1)]
        else:
            own = code[:, rows]
            parts = [np.bincount(own.ravel(), minlength=size),
                     np.bincount(own.ravel(), weights=np.broadcast_to(unit[rows].astype(float), own.shape).ravel(), minlength=size).astype(np.int64)]
        return np.stack(parts, axis=1).reshape(len(columns), width, 2)

    out, heap = [], []

    def look(rows: np.ndarray, hist: np.ndarray, level: int) -> None:
        n, total, split = best_split(hist, columns, edges, alpha, scale, min_rows, l2)
        if split is not None and split[0] >= floor and (levels is None or level + 1 < levels):
            heapq.heappush(heap, (-split[0], len(out), level, rows, hist))
        out.append((n, total, split, None))

    every = np.arange(bins.shape[1])
    look(every, histogram(every), 0)
    for _ in range(splits - 1):             # the last split's children aren't asked for
        if not heap:
            break
        _, at, level, rows, hist = heapq.heappop(heap)
        n, total, split, _ = out[at]
        out[at] = (n, total, split, len(out))
        value = bins[np.searchsorted(columns, split[1]), rows]
        goes = np.where(value == 0, split[3], value <= split[2])
        sides = [rows[goes], rows[~goes]]
        less = int(len(sides[1]) < len(sides[0]))
        hists = [None, None]
        hists[less] = histogram(sides[less])
        hists[1 - less] = hist - hists[less]
        for side, own in zip(sides, hists, strict=True):
            look(side, own, level + 1)
    return out


def grow_alone(bins: np.ndarray, unit: np.ndarray, columns: np.ndarray, edges: np.ndarray, alpha: float | None, scale: float, leaves: int, depth: int | None,
               min_rows: int, l2: float) -> tuple[Tree, list[tuple[int, np.ndarray]]]:
    """One tree on rows that are all here, and (leaf, its rows): the leaf of greatest gain is split first.

    ``bins`` is (rows x features); ``unit`` is as in ``small_subtree``.
    """
    width = int(edges.max(initial=0)) + 2
    many, size = len(columns), len(columns) * width
    code = bins[:, columns].astype(np.uint16 if 2 * size < 1 << 16 else np.int64)
    code += (np.arange(many) * width).astype(code.dtype)
    if alpha is not None:
        code += (unit * size).astype(code.dtype)[:, None]         # rows above the prediction behind those below

    def histogram(rows: np.ndarray) -> np.ndarray:
        parts = np.zeros((2, size), np.int64)
        for at in range(0, len(rows), LEAST_ROWS):
            some = rows[at:at + LEAST_ROWS]
            own = code[some].ravel()
            if alpha is not None:
                parts += np.bincount(own, minlength=2 * size).reshape(2, size)
            else:
                parts[0] += np.bincount(own, minlength=size)
                parts[1] += np.bincount(own, weights=np.repeat(unit[some].astype(float), many), minlength=size).astype(np.int64)
        return np.ascontiguousarray(parts.T).reshape(many, width, 2)

    nodes: list[list] = []              # split, children, level
    held: dict[int, np.ndarray] = {}
    heap: list = []

    def look(rows: np.ndarray, hist: np.ndarray | None, level: int) -> None:
        split = best_split(hist, columns, edges[columns], alpha, scale, min_rows, l2)[2] if hist is not None else None
        if split is not None and (depth is None or level < depth):
            heapq.heappush(heap, (-split[0], len(nodes), hist))
        held[len(nodes)] = rows
        nodes.append([split, None, level])

    every = np.arange(len(bins))
    look(every, histogram(every), 0)
    for left in range(leaves - 1, 0, -1):
        if not heap:
            break
        _, at, hist = heapq.heappop(heap)
        split, _, level = nodes[at]
        rows = held.pop(at)
        value = bins[rows, split[1]]
        goes = np.where(value == 0, split[3], value <= split[2])
        sides = [rows[goes], rows[~goes]]
        hists: list = [None, None]
        if left > 1 and (depth is None or level + 1 < depth):           # else the children aren't split
            less = int(len(sides[1]) < len(sides[0]))
            hists[less] = histogram(sides[less])
            hists[1 - less] = hist - hists[less]
        nodes[at][1] = len(nodes)
        for side, own in zip(sides, hists, strict=True):
            look(side, own, level + 1)
    n = len(nodes)
    tree = Tree(np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32), np.zeros(n),
                max(level for _, _, level in nodes))
    for k, (split, child, _) in enumerate(nodes):
        if child is not None:
            _, tree.feature[k], tree.bin[k], tree.missing_left[k], _, _ = split
            tree.left[k], tree.right[k] = child, child + 1
    return tree, list(held.items())


def fit_alone(boost: HistogramBoost, name: str, blocks: list[tuple[str, bool, np.ndarray, np.ndarray]]) -> Fit:
    """The model ``name`` on blocks (name, whether to validate on it, bins by feature, target) that are all here."""
    fit, at = boost.fits[name], list(boost.fits).index(name)
    alpha, edges = fit.alpha, np.array([len(e) for e in boost.edges])

    def gathered(val: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        some = [b for b in blocks if b[1] == val]
        bins = np.concatenate([np.zeros((0, len(edges)), np.uint8), *[b[2].T for b in some]])
        y = np.concatenate([np.zeros(0), *[b[3] for b in some]])
        return bins, y, np.full(len(y), fit.start)

    def loss(y: np.ndarray, q: np.ndarray) -> float:
        return float(np.mean((y - q) ** 2 if alpha is None else np.where(y >= q, alpha * (y - q), (alpha - 1.0) * (y - q))))

    (bins, y, q), (val_bins, val_y, val_q) = gathered(False), gathered(True)
    by_feature = np.ascontiguousarray(val_bins.T)
    best: tuple[float, int] | None = None
    for r in range(1, boost.rounds + 1):
        unit = (y > q).astype(np.int64) if alpha is not None else np.rint((y - q) * boost.scale).astype(np.int64)
        drawn = None
        if boost.row_share < 1.0:
            drawn = np.concatenate([boost.drawn(r, b[0], len(b[3])) for b in blocks if not b[1]])
        tree, leaves = grow_alone(bins if drawn is None else bins[drawn], unit if drawn is None else unit[drawn], boost._columns(r, boost.draws.get(name, at)), edges, alpha, boost.scale,
                                  boost.leaves, boost.depth, boost.min_rows, boost.l2)
        if drawn is not None:               # a leaf's value is that of all its rows
            leaf = tree.leaves(bins.T)
            leaves = [(k, np.flatnonzero(leaf == k)) for k, _ in leaves]
        for k, rows in leaves:
            if not len(rows):
                continue
            residual = y[rows] - q[rows]
            if alpha is None:
                tree.value[k] = int(np.rint(residual * boost.scale).astype(np.int64).sum()) / boost.scale / (len(rows) + boost.l2)
            else:
                place = max(0, int(np.ceil(alpha * float(len(rows)))) - 1)
                tree.value[k] = residual_of(int(np.partition(residual_code(residual), place)[place]))
            q[rows] += boost.learning_rate * tree.value[k]
        fit.trees.append(tree)
        fit.rounds = r
        if len(val_y):
            val_q += boost.learning_rate * tree.value[tree.leaves(by_feature)]
        fit.history.append((r, loss(y, q), loss(val_y, val_q) if len(val_y) else None))
        found = fit.history[-1][2]
        if found is not None and (best is None or found < best[0] - 1e-12):
            best = (found, r)
        elif found is not None and r - best[1] >= boost.early_stopping:
            break
        if tree.depth == 0:                 # nothing left to split
            break
    if best is not None:
        del fit.trees[best[1]:]
    return fit


def residual_code(r: np.ndarray) -> np.ndarray:
    """Ascending integer code of a residual, equal for residuals that agree in 10 bits."""
    bits = r.astype(np.float32).view(np.int32).astype(np.int64)
    return np.where(bits >= 0, bits >> STEP, -((bits & 0x7FFFFFFF) >> STEP))


def residual_of(code: int) -> float:
    value = float(np.array(abs(code) << STEP, dtype=np.int64).astype(np.int32).view(np.float32))
    return value if code >= 0 else -value


# ------------------------------------------------------------------ the boosting loop
@dataclass
class Fit:
    """One model: its start, trees and losses."""

    name: str
    alpha: float | None                 # quantile; None: squared error
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    history: list[tuple[int, float, float | None]] = field(default_factory=list)      # (round, train loss, validation loss)
    rounds: int = 0                     # rounds run, with those that early stopping took back


@dataclass
class HistogramBoost:
    """Trees of all ``targets`` (name -> quantile, or None for squared error) on the rows' ``demand``.

    The defaults are the analysed workload's: 500 rounds of 63 leaves, rate
    0.05, at least 20 rows in a leaf, 80 % of the columns for each tree, and a
    stop after 50 rounds without a better validation loss. ``depth`` limits the
    trees' depth (None: only by their leaves); ``row_share`` below 1 draws rows
    for each tree, ``l2`` is added to a leaf's row count. A model draws its
    columns by its place among ``targets``, or by its number in ``draws``: with
    the number it would have by itself it gets the same trees beside others.
    Up to ``one_task`` cells (rows x features), each model is fitted in a task
    of its own; 0 leaves all fits to passes over the blocks.
    """

    features: list[str]
    targets: dict[str, float | None]
    rounds: int = 500
    learning_rate: float = 0.05
    leaves: int = 63
    depth: int | None = None
    min_rows: int = 20
    early_stopping: int = 50
    row_share: float = 1.0
    column_share: float = 0.8
    l2: float = 0.0
    bins: int = BINS
    seed: int = 42
    draws: dict[str, int] = field(default_factory=dict)
    one_task: int = 0
    edges: list[np.ndarray] = field(default_factory=list)
    fits: dict[str, Fit] = field(default_factory=dict)
    scale: float = 1.0

    # -------------------------------------------------------------- set-up
    def fit(self, train: DataFrame, val: DataFrame | None = None) -> "HistogramBoost":
        """Rows with a null or NaN ``demand`` are left out; without training rows every model is its start of 0."""
        spark = train.sparkSession
        ensure_checkpoint_dir(spark)
        ship_code(spark)
        known = lambda df: df.filter(F.col("demand").isNotNull() & ~F.isnan(F.col("demand").cast("double")))
        train = known(train)
        alphas = sorted({a for a in self.targets.values() if a is not None})
        y = F.col("demand").cast("double")
        found = train.agg(F.count("*").alias("n"), F.avg(y).alias("mean"), F.max(F.abs(y)).alias("most"),
                          F.percentile_approx(y, alphas or [0.5], 10_000).alias("quantiles")).first()
        start = {a: q for a, q in zip(alphas, found.quantiles or [0.0] * len(alphas), strict=False)}
        self.fits = {name: Fit(name, a, float((found["mean"] if a is None else start[a]) or 0.0)) for name, a in self.targets.items()}
        if not found.n:
            self.edges = [np.zeros(0) for _ in self.features]
            return self
        self.edges = bin_edges(train, self.features, self.bins)
        most = max(4.0 * found.most, 1e-300)
        self.scale = float(2.0 ** min(20, np.floor(np.log2((1 << 36) / most)), np.floor(np.log2(float(1 << 62) / (found.n * most)))))
        starts = [f.start for f in self.fits.values()]
        cores = spark.sparkContext.defaultParallelism
        size = int(min(BLOCK_ROWS, max(LEAST_ROWS, found.n // cores + 1)))
        tasks = int(min(cores, found.n // size + 1))
        state = _blocks(train, self.features, self.edges, starts, False, tasks, size)
        if val is not None:
            state = state.unionByName(_blocks(known(val), self.features, self.edges, starts, True, 1 + tasks // 4, size))
        state = state.checkpoint(eager=True)
        if found.n * len(self.features) <= self.one_task and state.agg(F.sum("n")).first()[0] * len(self.features) <= self.one_task:
            return self._fit_in_tasks(state)
        active = list(self.fits)
        best: dict[str, tuple[float, int]] = {}
        held = None
        for r in range(1, self.rounds + 1):
            trees = self._grow(state, active, r)
            self._set_values(state, trees)
            after = self._advance(state, trees)
            after = after.checkpoint(eager=True) if r % CUT == 0 else after.persist(StorageLevel.MEMORY_AND_DISK)
            losses = self._losses(after)
            if held is not None:
                held.unpersist()
            state, held = after, (after if r % CUT else None)
            for name in list(active):
                fit, at = self.fits[name], list(self.fits).index(name)
                fit.trees.append(trees[name])
                fit.rounds = r
                fit.history.append((r, losses[False][at], losses[True][at] if True in losses else None))
                loss = fit.history[-1][2]
                if loss is not None and (name not in best or loss < best[name][0] - 1e-12):
                    best[name] = (loss, r)
                elif loss is not None and r - best[name][1] >= self.early_stopping:
                    active.remove(name)
                if trees[name].depth == 0:              # nothing left to split
                    active = [a for a in active if a != name]
            if not active:
                break
        if held is not None:
            held.unpersist()
        for name, (_, r) in best.items():
            del self.fits[name].trees[r:]
        return self

    def _fit_in_tasks(self, state: DataFrame) -> "HistogramBoost":
        """Every model in a task that gets all blocks; the fitted models come back, at most rounds x leaves nodes each."""
        names, features = list(self.fits), len(self.features)
        shared = replace(self, fits={n: replace(f) for n, f in self.fits.items()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    held.setdefault(row["model"], []).append((row["block"], row["val"], np.frombuffer(row["bins"], np.uint8).reshape(features, row["n"]), np.frombuffer(row["y"], np.float64)))
            for k, blocks in held.items():
                yield pa.RecordBatch.from_pydict({"model": pa.array([k], pa.int32()), "fit": pa.array([pickle.dumps(fit_alone(shared, names[k], blocks))], pa.binary())})

        copies = state.select(F.explode(F.array(*[F.lit(k) for k in range(len(names))])).alias("model"), "block", "val", "n", "bins", "y")
        for row in copies.repartitionById(len(names), F.col("model")).mapInArrow(run, "model int, fit binary").collect():
            self.fits[names[row.model]] = pickle.loads(row.fit)
        return self

    def drawn(self, r: int, block: str, rows: int) -> np.ndarray:
        """Which rows of a block a round's trees see."""
        return np.random.default_rng([self.seed, r, int(block[:8], 16)]).random(rows) < self.row_share

    def _columns(self, r: int, at: int) -> np.ndarray:
        every = np.array([k for k, e in enumerate(self.edges) if len(e)], dtype=np.int64)       # a feature without a value can't split
        many = max(1, round(self.column_share * len(every)))
        return every if many >= len(every) else np.sort(np.random.default_rng([self.seed, r, at]).choice(every, many, replace=False))

    # -------------------------------------------------------------- one tree for each model
    def _grow(self, state: DataFrame, active: list[str], r: int) -> dict[str, Tree]:
        names = list(self.fits)
        growing = {n: _Growing(self.leaves, self.depth, self._columns(r, self.draws.get(n, names.index(n)))) for n in active}
        while True:
            asked = {n: g.wanted() for n, g in growing.items()}
            asked = {n: nodes for n, nodes in asked.items() if nodes}
            if not asked:
                return {n: g.tree() for n, g in growing.items()}
            routes = {n: growing[n].tree(growing[n].above(nodes)) for n, nodes in asked.items()}
            small = {n: growing[n].small(nodes) for n, nodes in asked.items()}
            found = self._histograms(state, r, asked, small, routes, {n: growing[n].columns for n in asked}).collect()      # at most 2 x leaves rows for each leaf that was asked for
            number: dict[tuple[int, int], int] = {}
            for row in sorted(found, key=lambda row: (row.key, row.place)):
                tree, k = growing[names[row.key // NODES]], number.get((row.key, row.place), row.key % NODES)
                split = (row.gain, row.feature, row.bin, row.missing_left, row.left_n, row.left_total) if row.gain is not None else None
                tree.answer(k, row.n, row.total, split)
                if row.left is not None:
                    number[row.key, row.left], number[row.key, row.left + 1] = tree._open(k)

    def _histograms(self, state: DataFrame, r: int, asked: dict[str, list[int]], small: dict[str, dict[int, tuple]], routes: dict[str, Tree],
                    columns: dict[str, np.ndarray]) -> DataFrame:
        """A row for each node asked for: its rows, gradient and best split. Only bins that hold a row are sent.

        The rows of ``small`` nodes are sent themselves, and a row comes back for each node below that may be split, too.
        """
        names = list(self.fits)
        edges = np.array([len(e) for e in self.edges])
        width = int(edges.max(initial=0)) + 2
        jobs = [(names.index(n), np.array([k for k in nodes if k not in small[n]], dtype=np.int64), np.array(list(small[n]), dtype=np.int64), routes[n], columns[n], self.targets[n])
                for n, nodes in asked.items()]
        limits = {names.index(n) * NODES + k: limit for n, nodes in small.items() for k, limit in nodes.items()}
        scale, share, seed, models = self.scale, self.row_share, self.seed, len(names)
        min_rows, l2 = self.min_rows, self.l2
        by_model = {m: (cols, alpha) for m, *_, cols, alpha in jobs}
        tasks = min(state.sparkSession.sparkContext.defaultParallelism, sum(map(len, asked.values())))

        def rows_of(m: int, few: np.ndarray, place: np.ndarray, bins: np.ndarray, y: np.ndarray, q: np.ndarray, cols: np.ndarray, alpha: float | None) -> pa.RecordBatch:
            keys, cells, counts = [], [], []
            pick = np.flatnonzero(place >= 0)
            pick = pick[np.argsort(place[pick], kind="stable")]
            cuts = np.searchsorted(place[pick], np.arange(len(few) + 1))
            for k, node in enumerate(few.tolist()):
                own = pick[cuts[k]:cuts[k + 1]]
                if len(own):
                    unit = (y[own] > q[m][own]).astype(np.int64) if alpha is not None else np.rint((y[own] - q[m][own]) * scale).astype(np.int64)
                    keys.append(m * NODES + node)
                    cells.append(bins[np.ix_(cols, own)].tobytes())
                    counts.append(unit.tobytes())
            return pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.int64()), "cells": pa.array(cells, pa.binary()), "counts": pa.array(counts, pa.binary())})

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {m: [] for m, *_ in jobs}
            for bins, y, q, row in _open_blocks(batches, models, len(edges)):
                if row["val"]:
                    continue
                drawn = np.random.default_rng([seed, r, int(row["block"][:8], 16)]).random(len(y)) < share if share < 1.0 else None
                for m, nodes, few, tree, cols, alpha in jobs:
                    local = np.full(len(tree.left), -1)
                    local[nodes] = np.arange(len(nodes))
                    local[few] = len(nodes) + np.arange(len(few))
                    place = local[tree.leaves(bins)]
                    if drawn is not None:
                        place[~drawn] = -1
                    if len(few):
                        yield rows_of(m, few, place - len(nodes), bins, y, q, cols, alpha)
                    if not len(nodes):
                        continue
                    pick = np.flatnonzero((place >= 0) & (place < len(nodes)))
                    code = ((place[pick] * (len(cols) * width))[None] + (np.arange(len(cols)) * width)[:, None] + bins[np.ix_(cols, pick)]) * 2
                    if alpha is not None:
                        found[m].append(_filled((code + (y[pick] > q[m][pick])[None]).ravel(), None))
                    else:
                        unit = np.broadcast_to(np.rint((y[pick] - q[m][pick]) * scale), code.shape)
                        found[m] += [_filled(code.ravel(), None), _filled(code.ravel() + 1, unit.ravel())]
                    if len(found[m]) > 8:
                        found[m] = [_added(found[m])]
            keys, cells, counts = [], [], []
            for m, nodes, _, _, cols, _ in jobs:
                if not found[m]:
                    continue
                cell, count = _added(found[m])
                size = len(cols) * width * 2
                cuts = np.searchsorted(cell, np.arange(len(nodes) + 1) * size)
                for k, node in enumerate(nodes.tolist()):
                    if cuts[k] < cuts[k + 1]:
                        keys.append(m * NODES + node)
                        cells.append((cell[cuts[k]:cuts[k + 1]] - k * size).astype(np.int32).tobytes())
                        counts.append(count[cuts[k]:cuts[k + 1]].tobytes())
            if keys:
                yield pa.RecordBatch.from_pydict({"key": keys, "cells": cells, "counts": counts})

        def choose(table: pa.Table) -> pa.Table:
            key = table.column("key")[0].as_py()
            cols, alpha = by_model[key // NODES]
            if key in limits:
                bins = np.concatenate([np.frombuffer(cell.as_buffer(), np.uint8).reshape(len(cols), -1) for cell in table.column("cells")], axis=1)
                unit = np.concatenate([np.frombuffer(count.as_buffer(), np.int64) for count in table.column("counts")])
                nodes = small_subtree(bins, unit, limits[key], cols, edges[cols], width, alpha, scale, min_rows, l2)
            else:
                whole = np.zeros(len(cols) * width * 2, np.int64)
                for cell, count in zip(table.column("cells"), table.column("counts"), strict=True):
                    whole[np.frombuffer(cell.as_buffer(), np.int32)] += np.frombuffer(count.as_buffer(), np.int64)
                nodes = [(*best_split(whole.reshape(len(cols), width, 2), cols, edges[cols], alpha, scale, min_rows, l2), None)]
            made = [(key, place, n, units, *(split or (None,) * 6), left) for place, (n, units, split, left) in enumerate(nodes)]
            return pa.table([pa.array(column, kind) for column, kind in zip(zip(*made, strict=True), answer.types, strict=True)], schema=answer)

        answer = pa.schema([("key", pa.int64()), ("place", pa.int32()), ("n", pa.int64()), ("total", pa.int64()), ("gain", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32()),
                            ("missing_left", pa.bool_()), ("left_n", pa.int64()), ("left_total", pa.int64()), ("left", pa.int32())])
        return (state.mapInArrow(add, "key long, cells binary, counts binary").repartition(tasks, "key").groupBy("key")
                .applyInArrow(choose, "key long, place int, n long, total long, gain double, feature int, bin int, missing_left boolean, left_n long, left_total long, left int"))

    # -------------------------------------------------------------- leaf values and predictions
    def _set_values(self, state: DataFrame, trees: dict[str, Tree]) -> None:
        """Mean residual of each leaf, or its rows' residual quantile: one job over the training blocks."""
        names = list(self.fits)
        jobs = [(names.index(n), t, self.targets[n]) for n, t in trees.items()]
        models, features, l2 = len(names), len(self.edges), self.l2
        scale, alphas = self.scale, {m: alpha for m, _, alpha in jobs}

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {m: [] for m, *_ in jobs}
            for bins, y, q, row in _open_blocks(batches, models, features):
                if row["val"]:
                    continue
                for m, tree, alpha in jobs:
                    leaf = tree.leaves(bins).astype(np.int64)
                    r = y - q[m]
                    if alpha is None:
                        # each leaf's rows under its number, its residuals' sum behind those of all leaves
                        n = np.bincount(leaf, minlength=len(tree.left))
                        total = np.bincount(leaf, weights=np.rint(r * scale), minlength=len(tree.left)).astype(np.int64)
                        found[m].append((np.arange(2 * len(n)), np.concatenate([n, total])))
                    else:
                        found[m].append(np.unique(leaf * CODES + residual_code(r) + CODES // 2, return_counts=True))
                    if len(found[m]) > 8:
                        found[m] = [_added(found[m])]
            keys, codes, counts = [], [], []
            for m, tree, alpha in jobs:
                if not found[m]:
                    continue
                code, count = _added(found[m])
                if alpha is None:
                    for k in np.flatnonzero(count[:len(tree.left)]).tolist():
                        keys.append(m * NODES + k)
                        codes.append(count[len(tree.left) + k].tobytes())
                        counts.append(count[k].tobytes())
                    continue
                cuts = np.searchsorted(code, np.arange(len(tree.left) + 1) * CODES)
                for k in np.flatnonzero(np.diff(cuts)).tolist():
                    keys.append(m * NODES + k)
                    codes.append((code[cuts[k]:cuts[k + 1]] - k * CODES - CODES // 2).tobytes())
                    counts.append(count[cuts[k]:cuts[k + 1]].astype(np.int64).tobytes())
            if keys:
                yield pa.RecordBatch.from_pydict({"key": keys, "codes": codes, "counts": counts})

        def pick(table: pa.Table) -> pa.Table:
            key = table.column("key")[0].as_py()
            alpha = alphas[key // NODES]
            parts = [(np.frombuffer(code.as_buffer(), np.int64), np.frombuffer(count.as_buffer(), np.int64)) for code, count in zip(table.column("codes"), table.column("counts"), strict=True)]
            if alpha is None:
                value = sum(int(total[0]) for total, _ in parts) / scale / (sum(int(n[0]) for _, n in parts) + l2)
            else:
                # the first code up to which the leaf holds its share of the rows
                code, count = _added(parts)
                seen = np.cumsum(count)
                value = residual_of(int(code[np.searchsorted(seen, alpha * float(seen[-1]))]))
            return pa.table({"key": pa.array([key], pa.int64()), "value": pa.array([value], pa.float64())})

        tasks = min(state.sparkSession.sparkContext.defaultParallelism, sum(len(t.left) for t in trees.values()))
        found = state.mapInArrow(add, "key long, codes binary, counts binary").repartition(tasks, "key").groupBy("key").applyInArrow(pick, "key long, value double")
        for row in found.collect():             # a row for each leaf
            trees[names[row.key // NODES]].value[row.key % NODES] = row.value

    def _advance(self, state: DataFrame, trees: dict[str, Tree]) -> DataFrame:
        """The blocks with this round's trees added to their predictions, and their losses."""
        names = list(self.fits)
        jobs = [(names.index(n), t) for n, t in trees.items()]
        alphas, rate, features = [self.targets[n] for n in names], self.learning_rate, len(self.edges)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bins, y, q, row in _open_blocks(batches, len(alphas), features):
                q = q.copy()
                for m, tree in jobs:
                    q[m] += rate * tree.value[tree.leaves(bins)]
                loss = [float(np.sum((y - p) ** 2)) if a is None else float(np.sum(np.where(y >= p, a * (y - p), (a - 1.0) * (y - p)))) for a, p in zip(alphas, q, strict=True)]
                yield _batch(row["block"], row["val"], row["n"], row["bins"], row["y"], q.tobytes(), loss)

        return state.mapInArrow(run, BLOCKS)

    def _losses(self, state: DataFrame) -> dict[bool, list[float]]:
        """Mean losses of the training and of the validation rows, by model."""
        sums = [F.sum(F.col("loss")[k]).alias(f"l{k}") for k in range(len(self.fits))]
        return {row.val: [row[f"l{k}"] / row.n for k in range(len(self.fits))] for row in state.groupBy("val").agg(F.sum("n").alias("n"), *sums).collect()}


def _open_blocks(batches: Iterator[pa.RecordBatch], models: int, features: int):
    for batch in batches:
        for row in batch.to_pylist():
            n = row["n"]
            yield np.frombuffer(row["bins"], np.uint8).reshape(features, n), np.frombuffer(row["y"], np.float64), np.frombuffer(row["q"], np.float64).reshape(models, n), row


def _filled(code: np.ndarray, weights: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(ascending distinct codes, their counts or weight sums as integers)."""
    most = int(code.max(initial=0)) + 1
    if most <= 4 * len(code):
        sums = np.bincount(code, minlength=most) if weights is None else np.bincount(code, weights=weights, minlength=most).astype(np.int64)
        some = np.flatnonzero(sums)
        return some, sums[some]
    if weights is None:
        return np.unique(code, return_counts=True)
    some, at = np.unique(code, return_inverse=True)
    return some, np.bincount(at, weights=weights).astype(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of several (codes, counts)."""
    if len(parts) == 1:
        return parts[0]
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    total = np.zeros(len(codes), np.int64)
    np.add.at(total, at, np.concatenate([n for _, n in parts]).astype(np.int64))
    return codes, total
