"""Second-order boosted trees for a binary label, grown level by level from gradient histograms.

Rows keep the bin numbers of their features, written once. A level is one Spark
job: every row adds its gradient and hessian to a cell (node, feature, bin), cells
are summed where the rows are and then over all tasks. Only the smaller child of
a split is summed; its sibling is the parent less it. What comes to the driver are
cells, at most nodes x features x (bins + 1), whatever the number of rows.

With G and H the sums of gradients and hessians of a node, a leaf's value is
-G / (H + reg_lambda) times the learning rate, and a split's gain is
GL2/(HL + reg_lambda) + GR2/(HR + reg_lambda) - G2/(H + reg_lambda). A split needs
a gain of ``gamma`` or more (and above 1e-6) and a hessian sum of
``min_child_weight`` on both sides. Missing values (NULL, NaN) of a node go to
the side with the larger gain; where a node saw none, to the right. A row goes
left if its value is less than the threshold.

``subsample`` keeps a row for a tree by a hash of its key, so a repeated task sees
the same rows; ``colsample_bytree`` draws the features of a tree by the seed.
``scale_pos_weight`` multiplies the weight of positive rows.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.operators.metrics import auc_roc
from equigauge.operators.models import Tuned, draw_params
from equigauge.operators.prefix import add_bucket, cut_points
from equigauge.operators.split import stratified_folds
from equigauge.roles import LIMITS, ROLES
from equigauge.session import materialize, ship_package

DEFAULTS = {
    "n_estimators": 100,
    "max_depth": 6,
    "learning_rate": 0.3,
    "subsample": 1.0,
    "colsample_bytree": 1.0,
    "min_child_weight": 1.0,
    "gamma": 0.0,
    "scale_pos_weight": 1.0,
    "reg_lambda": 1.0,
    "max_bin": 256,
    "base_score": 0.5,
}

#: The ranges of the search (fixed values).
SPACE = {
    "n_estimators": ("int", 100, 500),
    "max_depth": ("int", 3, 8),
    "learning_rate": ("log", 0.01, 0.3),
    "subsample": ("float", 0.6, 1.0),
    "colsample_bytree": ("float", 0.6, 1.0),
    "min_child_weight": ("int", 1, 10),
    "gamma": ("float", 0.0, 1.0),
    "scale_pos_weight": ("float", 1.0, 5.0),
}

LEAST_GAIN = 1e-6
TREES_PER_WRITE = 8
SUBSAMPLE_STEPS = 1 << 20
NODES = "tree int, node int, feature string, threshold double, default_left boolean, gain double, cover double, value double"


@dataclass(frozen=True)
class Split:
    feature: int
    cut: int  # bins up to this one go left
    default_left: bool
    gain: float
    left: tuple[float, float]
    right: tuple[float, float]


@dataclass
class Tree:
    """Nodes by heap number: the children of k are 2k+1 and 2k+2."""

    splits: dict[int, Split] = field(default_factory=dict)
    sums: dict[int, tuple[float, float]] = field(default_factory=dict)

    def leaves(self) -> list[int]:
        return [k for k in self.sums if k not in self.splits]

    def route(self, bins: Sequence[Column], at_leaf: Mapping[int, Column | None], node: int = 0) -> Column:
        """What ``at_leaf`` has for the node that a row ends in; NULL where it has nothing."""
        split = self.splits.get(node)
        if split is None:
            return at_leaf.get(node, F.lit(None))
        left, right = (self.route(bins, at_leaf, 2 * node + k) for k in (1, 2))
        b = bins[split.feature]
        goes_left = b <= split.cut if split.default_left else b.between(0, split.cut)  # missing is -1
        return F.when(goes_left, left).otherwise(right)


def side_score(g: np.ndarray, h: np.ndarray, reg_lambda: float) -> np.ndarray:
    return g * g / np.maximum(h + reg_lambda, 1e-300)


def candidates(g: np.ndarray, h: np.ndarray, reg_lambda: float) -> list[tuple]:
    """Every split of one feature: (cut, default_left, gain, GL, HL, GR, HR) arrays. ``g``, ``h``: sums by bin, missing last."""
    total_g, total_h = g.sum(), h.sum()
    whole = side_score(total_g, total_h, reg_lambda)
    out = []
    for default_left in (False, True):
        left_g, left_h = np.cumsum(g[:-1]), np.cumsum(h[:-1])
        if default_left:
            left_g, left_h = left_g[:-1] + g[-1], left_h[:-1] + h[-1]
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = side_score(left_g, left_h, reg_lambda) + side_score(right_g, right_h, reg_lambda) - whole
        out.append((default_left, gain, left_g, left_h, right_g, right_h))
    return out


def best_split(cells: Mapping[int, tuple[np.ndarray, np.ndarray]], p: Mapping[str, float]) -> Split | None:
    """The best allowed split over features; among equals the first feature, then the first cut, then missing to the right."""
    best = None
    for feature, (g, h) in cells.items():
        for default_left, gain, lg, lh, rg, rh in candidates(g, h, p["reg_lambda"]):
            if default_left and h[-1] == 0:
                continue
            # a side needs some hessian of its own, beyond what rounding leaves
            least = max(float(p["min_child_weight"]), 1e-12 * max(1.0, float(h.sum())))
            allowed = np.where((lh >= least) & (rh >= least), gain, -np.inf)
            if not len(allowed):
                continue
            k = int(allowed.argmax())
            found = float(allowed[k])
            if found > LEAST_GAIN and found >= p["gamma"] and (best is None or found > best.gain):
                best = Split(feature, k, default_left, found, (float(lg[k]), float(lh[k])), (float(rg[k]), float(rh[k])))
    return best


def feature_cuts(df: DataFrame, features: Sequence[str], max_bin: int) -> list[list[float]]:
    """Cut points of every feature: all values but the smallest if there are at most ``max_bin``, else quantiles of a sketch."""
    numbers = df.select(*[present(c).alias(c) for c in features])
    guess = numbers.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    small = [c for c in features if guess[c] <= 1.2 * max_bin + 2]
    sets = numbers.agg(*[F.collect_set(c).alias(c) for c in small]).first() if small else {}
    few = {c: sorted(sets[c])[1:] for c in small if len(sets[c]) <= max_bin}
    many = [c for c in features if c not in few]
    sketched = cut_points(numbers, many, max_bin) if many else {}
    return [few[c] if c in few else sketched.get(c, []) for c in features]


def present(column: str) -> Column:
    """The number, with NaN as NULL."""
    x = F.col(column).cast("double")
    return F.when(F.isnan(x), None).otherwise(x)


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: flat node arrays, trees x nodes in heap order; ``feature`` is -1 at leaves."""

    features: tuple[str, ...]
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    default_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of rows x features; NaN is missing."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = (self.feature.shape[1] + 1).bit_length() - 2 if len(self.feature) else 0
        for f, t, d, v in zip(self.feature, self.threshold, self.default_left, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                inner = f[node] >= 0
                if not inner.any():
                    break
                cell = x[rows, np.maximum(f[node], 0)]
                left = np.where(np.isnan(cell), d[node], cell < t[node])
                node = np.where(inner, 2 * node + 2 - left, node)
            out += v[node]
        return out

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Adds the probability of the positive class, in Arrow batches."""
        model = self
        ship_package(df.sparkSession)

        @F.pandas_udf("double")
        def probability(frame: pd.DataFrame) -> pd.Series:
            x = frame.to_numpy(dtype=float, na_value=np.nan)
            return pd.Series(1 / (1 + np.exp(-model.margin(x))))

        cells = F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)])
        return df.withColumn(out, probability(cells))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """A row per node of every tree."""
        rows = []
        for t in range(len(self.feature)):
            for k in np.flatnonzero(self.cover[t] > 0):
                inner = self.feature[t, k] >= 0
                name = self.features[self.feature[t, k]] if inner else None
                cells = (float(self.threshold[t, k]), bool(self.default_left[t, k]), float(self.gain[t, k])) if inner else (None, None, None)
                rows.append((t, int(k), name, *cells, float(self.cover[t, k]), None if inner else float(self.value[t, k])))
        return spark.createDataFrame(rows, NODES)

    def importance(self, spark: SparkSession) -> DataFrame:
        """feature, n_splits, mean_gain, importance (mean gain as a share), the largest first."""
        n = [int((self.feature == f).sum()) for f in range(len(self.features))]
        gain = [float(self.gain[self.feature == f].sum()) / k if k else 0.0 for f, k in enumerate(n)]
        total = sum(gain) or 1.0
        rows = [(c, k, g, g / total) for c, k, g in zip(self.features, n, gain, strict=True)]
        return spark.createDataFrame(rows, "feature string, n_splits int, mean_gain double, importance double").orderBy(F.desc("importance"), "feature")


class Trainer:
    """Grows trees on a table and can go on growing; ``valid`` marks rows that are only scored."""

    def __init__(
        self,
        df: DataFrame,
        features: Sequence[str],
        params: Mapping[str, float] | None = None,
        seed: int = LIMITS.seed,
        key: str = ROLES.key,
        weight: str = ROLES.weight,
        y: str = ROLES.label,
        valid: Column | None = None,
    ):
        unknown = set(params or {}) - set(DEFAULTS)
        if unknown:
            raise ValueError(f"no such parameters: {sorted(unknown)}")
        self.p = {**DEFAULTS, **(params or {})}
        self.features, self.seed = tuple(features), seed
        self.base = math.log(self.p["base_score"] / (1 - self.p["base_score"]))
        train = df.where(~valid) if valid is not None else df
        self.cuts = feature_cuts(train, features, int(self.p["max_bin"]))
        own = F.col(weight).cast("double") if weight in df.columns else F.lit(1.0)
        extra = F.when(F.col(y) == 1, F.lit(float(self.p["scale_pos_weight"]))).otherwise(F.lit(1.0))
        rows = df.select(
            F.xxhash64(F.col(key)).alias("id"),
            F.col(y).cast("double").alias("y"),
            (own * extra).alias("w"),
            (valid if valid is not None else F.lit(False)).alias("valid"),
            F.lit(self.base).alias("margin"),
            *[present(c).alias(f"x{i}") for i, c in enumerate(features)],
        ).where(F.col("y").isNotNull())
        for i, cuts in enumerate(self.cuts):
            rows = add_bucket(rows, f"x{i}", cuts, f"k{i}")
            rows = rows.withColumn(f"b{i}", F.when(F.col(f"x{i}").isNull(), F.lit(-1)).otherwise(F.col(f"k{i}"))).drop(f"x{i}", f"k{i}")
        self.table = materialize(rows, "boosting")
        self.trees: list[Tree] = []
        self.pending = 0

    def _bins(self) -> list[Column]:
        return [F.col(f"b{i}") for i in range(len(self.features))]

    def _gradients(self, tree: int) -> DataFrame:
        """Rows that the tree is grown on, with gradient and hessian."""
        rows = self.table.where(~F.col("valid"))
        if self.p["subsample"] < 1:
            draw = F.pmod(F.xxhash64("id", F.lit(self.seed), F.lit(tree)), F.lit(SUBSAMPLE_STEPS))
            rows = rows.where(draw < int(self.p["subsample"] * SUBSAMPLE_STEPS))
        prob = 1 / (1 + F.exp(-F.col("margin")))
        return rows.withColumns({"g": F.col("w") * (prob - F.col("y")), "h": F.col("w") * prob * (1 - prob)})

    def _cells(self, rows: DataFrame, tree: Tree, asked: Sequence[int], drawn: Sequence[int]) -> dict[int, dict[int, tuple]]:
        """Sums per node, feature and bin for the asked nodes; missing values last."""
        bins = self._bins()
        node = tree.route(bins, {k: F.lit(k) for k in asked}).cast("int")
        placed = rows.select(node.alias("node"), "g", "h", F.array(*[bins[f] for f in drawn]).alias("bins")).where("node is not null")
        cells = placed.select("node", "g", "h", F.posexplode("bins").alias("f", "bin"))
        summed = cells.groupBy("node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        empty = {f: len(self.cuts[f]) + 2 for f in drawn}
        out = {k: {f: (np.zeros(n), np.zeros(n)) for f, n in empty.items()} for k in asked}
        for r in summed.collect():
            g, h = out[r.node][drawn[r.f]]
            g[r.bin], h[r.bin] = r.g, r.h  # bin -1 is the last
        return out

    def _grow_one(self) -> Tree:
        t = len(self.trees)
        count = max(1, round(self.p["colsample_bytree"] * len(self.features)))
        drawn = sorted(random.Random(f"{self.seed}-{t}").sample(range(len(self.features)), count))
        rows = self._gradients(t)
        tree = Tree()
        cells = self._cells(rows, tree, [0], drawn)
        first = cells[0][drawn[0]]
        tree.sums[0] = (float(first[0].sum()), float(first[1].sum()))
        for level in range(int(self.p["max_depth"])):
            fresh = {k: s for k in cells if (s := best_split(cells[k], self.p))}
            for k, s in fresh.items():
                tree.splits[k] = s
                tree.sums[2 * k + 1], tree.sums[2 * k + 2] = s.left, s.right
            if not fresh or level + 1 == int(self.p["max_depth"]):
                break
            smaller = {2 * k + (1 if s.left[1] <= s.right[1] else 2): k for k, s in fresh.items()}
            summed = self._cells(rows, tree, list(smaller), drawn)
            below = {}
            for child, parent in smaller.items():
                sibling = 4 * parent + 3 - child
                below[child] = summed[child]
                below[sibling] = {f: tuple(a - b for a, b in zip(cells[parent][f], summed[child][f], strict=True)) for f in drawn}
            cells = below
        return tree

    def value(self, tree: Tree, leaf: int) -> float:
        g, h = tree.sums[leaf]
        return -g / (h + self.p["reg_lambda"]) * self.p["learning_rate"] if h + self.p["reg_lambda"] > 0 else 0.0

    def grow(self, rounds: int) -> "Trainer":
        """Add trees; margins of all rows follow."""
        for _ in range(rounds):
            tree = self._grow_one()
            step = tree.route(self._bins(), {k: F.lit(self.value(tree, k)) for k in tree.leaves()})
            self.table = self.table.withColumn("margin", F.col("margin") + step)
            self.trees.append(tree)
            self.pending += 1
            if self.pending == TREES_PER_WRITE:
                self.table, self.pending = materialize(self.table, "boosting"), 0
        return self

    def valid_auc(self) -> float | None:
        """AUC of the rows that are only scored, by their margins."""
        scored = self.table.where("valid").select(F.col("y").cast("int").alias("y"), F.col("margin").alias("s"))
        return auc_roc(scored, y="y", score="s").first()["auc_roc"]

    def model(self) -> BoostedTrees:
        depth = max((int(math.log2(k + 1)) for t in self.trees for k in t.sums), default=0)
        shape = len(self.trees), 2 ** (depth + 1) - 1
        feature, default_left = np.full(shape, -1), np.zeros(shape, bool)
        threshold, value, gain, cover = (np.zeros(shape) for _ in range(4))
        for n, tree in enumerate(self.trees):
            for k, (_, h) in tree.sums.items():
                cover[n, k] = h
                if s := tree.splits.get(k):
                    cuts = self.cuts[s.feature]
                    feature[n, k], default_left[n, k], gain[n, k] = s.feature, s.default_left, s.gain
                    threshold[n, k] = cuts[s.cut] if s.cut < len(cuts) else np.inf
                else:
                    value[n, k] = self.value(tree, k)
        return BoostedTrees(self.features, self.base, feature, threshold, default_left, value, gain, cover)


def fit(df: DataFrame, features: Sequence[str], params: Mapping[str, float] | None = None, seed: int = LIMITS.seed, **roles: str) -> BoostedTrees:
    """Boosted trees by the parameters of ``DEFAULTS``. ``roles``: key, weight, y."""
    trainer = Trainer(df, features, params, seed, **roles)
    return trainer.grow(int(trainer.p["n_estimators"])).model()


def root_splits(df: DataFrame, features: Sequence[str], params: Mapping[str, float] | None = None, **roles: str) -> DataFrame:
    """Every possible first split: feature, threshold, default_left, gain, left_value, right_value (before the learning rate)."""
    trainer = Trainer(df, features, params, **roles)
    cells = trainer._cells(trainer._gradients(0), Tree(), [0], range(len(features)))[0]
    lam, rows = trainer.p["reg_lambda"], []
    for f, (g, h) in cells.items():
        for default_left, gain, lg, lh, rg, rh in candidates(g, h, lam):
            for k, cut in enumerate(trainer.cuts[f]):
                rows.append((features[f], float(cut), default_left, float(gain[k]), float(-lg[k] / (lh[k] + lam)), float(-rg[k] / (rh[k] + lam))))
    return df.sparkSession.createDataFrame(
        rows, "feature string, threshold double, default_left boolean, gain double, left_value double, right_value double"
    )


def halving_search(
    df: DataFrame,
    features: Sequence[str],
    space: Mapping[str, tuple] = SPACE,
    trials: int = 30,
    keep: int = 3,
    rungs: int = 3,
    folds: int = LIMITS.folds,
    seed: int = LIMITS.seed,
    key: str = ROLES.key,
    weight: str = ROLES.weight,
    y: str = ROLES.label,
) -> Tuned:
    """Search that learns from its trials by successive halving.

    All draws grow a share of their trees on every fold. The best ``1 / keep`` by mean
    AUC of the held-out folds go on boosting from where they stand, with ``keep``
    times as many trees, until the last rung has all of them. The best of that rung is
    refitted on all rows. ``trials`` of the result has a row per draw with its last mean
    AUC and how many trees it had by then.
    """
    table = materialize(stratified_folds(df, y, key, folds, seed), "folds")
    drawn = draw_params(space, trials, seed)
    roles = {"key": key, "weight": weight, "y": y}

    def trees(params: dict, rung: int) -> int:
        return max(1, math.ceil(params.get("n_estimators", DEFAULTS["n_estimators"]) / keep ** (rungs - 1 - rung)))

    running = {i: [Trainer(table, features, p, seed, valid=F.col("fold") == f, **roles) for f in range(folds)] for i, p in enumerate(drawn)}
    result: dict[int, tuple[float, int]] = {}
    for rung in range(rungs):
        for i, trainers in running.items():
            total = trees(drawn[i], rung)
            scores = [t.grow(total - len(t.trees)).valid_auc() for t in trainers]
            result[i] = (float(np.mean([s if s is not None else 0.5 for s in scores])), total)
        if rung + 1 < rungs:
            stay = sorted(running, key=lambda i: -result[i][0])[: max(1, math.ceil(len(running) / keep))]
            running = {i: running[i] for i in sorted(stay)}
    best = max(running, key=lambda i: result[i][0])
    rows = [(i, *result[i], {k: float(v) for k, v in p.items()}, i == best) for i, p in enumerate(drawn)]
    trial_table = df.sparkSession.createDataFrame(rows, "trial int, mean_auc double, n_trees int, params map<string,double>, best boolean")
    return Tuned(fit(df, features, drawn[best], seed, **roles), drawn[best], trial_table)
