"""Why a record got its score: exact attributions that add up to the margin."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.functions.scalar import round_half_up
from equigauge.operators.boosted import BoostedTrees
from equigauge.roles import ROLES
from equigauge.session import new_path, ship_package


def attribute_linear(
    df: DataFrame,
    coefficients: Mapping[str, float],
    intercept: float,
    key: str = ROLES.key,
    background: DataFrame | None = None,
) -> DataFrame:
    """coef * (x - mean) per feature and the base value, on the log-odds scale."""
    names = list(coefficients)
    reference = df if background is None else background
    means = reference.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in names]).first()
    mean = {c: means[c] or 0.0 for c in names}
    base = intercept + sum(coefficients[c] * mean[c] for c in names)
    # a missing value counts as the mean, so it contributes nothing
    parts = [
        F.coalesce(
            F.lit(coefficients[c]) * (F.col(c).cast("double") - F.lit(mean[c])), F.lit(0.0)
        ).alias(c)
        for c in names
    ]
    return df.select(key, F.lit(base).alias("base"), *parts)


def tree_nodes(model: GBTClassificationModel, spark) -> pd.DataFrame:
    """Node table of a fitted model; its size depends on the model only."""
    path = new_path(spark, "gbt")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    return nodes.select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.prediction").alias("prediction"),
        F.get("nodeData.impurityStats", F.lit(0)).alias("cover"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).toPandas()


@dataclass(frozen=True)
class Forest:
    """Node table of a model as flat arrays; ``feature`` is -1 at leaves, children are places in the arrays.

    A row goes left below the threshold, and on it too if ``closed``. NaN goes where
    ``default_left`` says. ``cover`` is the training weight of a node.
    """

    feature: np.ndarray
    threshold: np.ndarray
    default_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cover: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    offset: float
    closed: bool

    def leaves(self) -> Iterator[tuple[float, dict[int, tuple[float, float, bool, float]]]]:
        """Per leaf: its value and, per feature on its path, (low, high, takes missing, cover share)."""
        for root in self.roots:
            todo = [(int(root), {})]
            while todo:
                k, path = todo.pop()
                f, t = int(self.feature[k]), float(self.threshold[k])
                if f < 0:
                    yield float(self.value[k]), path
                    continue
                low, high, missing, share = path.get(f, (-math.inf, math.inf, True, 1.0))
                to_left = bool(self.default_left[k])
                for child, bounds in (
                    (int(self.left[k]), (low, min(high, t), missing and to_left)),
                    (int(self.right[k]), (max(low, t), high, missing and not to_left)),
                ):
                    part = float(self.cover[child] / self.cover[k])
                    todo.append((child, {**path, f: (*bounds, share * part)}))

    def base(self) -> float:
        """Margin of a record of which nothing is known."""
        return self.offset + sum(v * math.prod(p[3] for p in path.values()) for v, path in self.leaves())

    def attributions(self, leaves: Sequence[tuple[float, dict]], x: np.ndarray) -> np.ndarray:
        """Shapley values of rows x features; ``leaves`` as from ``leaves()``."""
        phi = np.zeros_like(x)
        missing = np.isnan(x)
        for value, path in leaves:
            if not path:
                continue
            used = list(path)
            on = np.empty((len(x), len(used)), dtype=bool)
            for j, (low, high, takes_missing, _) in enumerate(path.values()):
                cell = x[:, used[j]]
                inside = (cell > low) & (cell <= high) if self.closed else (cell >= low) & (cell < high)
                on[:, j] = np.where(missing[:, used[j]], takes_missing, inside)
            shares = np.array([p[3] for p in path.values()])
            if 1 << len(used) < len(x):
                # fewer patterns than rows: each is worked out once
                bits = 1 << np.arange(len(used))
                patterns = (np.arange(1 << len(used))[:, None] & bits) > 0
                phi[:, used] += path_weights(patterns, shares, value)[on @ bits]
            else:
                phi[:, used] += path_weights(on, shares, value)
        return phi


def path_weights(on: np.ndarray, shares: np.ndarray, value: float) -> np.ndarray:
    """Contribution of each of a leaf's features, for rows of held (True) or broken conditions.

    The leaf is a product game: a feature in the coalition counts 1 or 0, one outside
    counts its cover share z. The Shapley weight of k known among m - 1 others is the
    integral of t^k (1 - t)^(m - 1 - k), so a feature's contribution is
    value (on - z) times the integral of the product of z (1 - t) + on t over the
    others. That is a polynomial of degree m - 1, and (m + 1) / 2 Gauss points give it
    exactly. The path is extended point by point from both ends, which leaves one
    feature out without a division: m^2 steps a row, and no loss of digits.
    """
    m = len(shares)
    points, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
    t = (points + 1) / 2
    factor = shares[None, :, None] * (1 - t) + on[:, :, None] * t
    before, after = np.ones_like(factor), np.ones_like(factor)
    for j in range(1, m):
        before[:, j] = before[:, j - 1] * factor[:, j - 1]
        after[:, m - 1 - j] = after[:, m - j] * factor[:, m - j]
    return value * (on - shares) * ((before * after) @ (weights / 2))


def forest_of(model: GBTClassificationModel | BoostedTrees, spark: SparkSession) -> Forest:
    """The node table of a fitted model."""
    if isinstance(model, BoostedTrees):
        trees, width = model.feature.shape if len(model.feature) else (0, 0)
        place = np.arange(trees * width).reshape(trees, width)
        heap = np.arange(width)
        start = place[:, :1] if width else place
        return Forest(
            model.feature.ravel(),
            model.threshold.ravel(),
            model.default_left.ravel(),
            (start + 2 * heap + 1).ravel(),
            (start + 2 * heap + 2).ravel(),
            model.cover.ravel(),
            model.value.ravel(),
            start.ravel(),
            model.base,
            closed=False,
        )
    nodes = tree_nodes(model, spark).sort_values(["tree", "id"])
    first = nodes.groupby("tree")["id"].transform("size").groupby(nodes["tree"]).first().cumsum().shift(fill_value=0)
    start = nodes["tree"].map(first).to_numpy()
    leaf = nodes["left"].to_numpy() < 0
    weight = np.asarray(model.treeWeights)[nodes["tree"].to_numpy()]
    return Forest(
        np.where(leaf, -1, nodes["feature"].to_numpy()),
        nodes["threshold"].to_numpy(dtype=float),
        np.zeros(len(nodes), bool),
        start + nodes["left"].to_numpy(),
        start + nodes["right"].to_numpy(),
        nodes["cover"].to_numpy(dtype=float),
        nodes["prediction"].to_numpy(dtype=float) * weight,
        first.to_numpy(),
        0.0,
        closed=True,
    )


def attribute_trees(
    df: DataFrame,
    model: GBTClassificationModel | BoostedTrees,
    features: Sequence[str],
    key: str = ROLES.key,
) -> DataFrame:
    """Shapley values of the cover-weighted tree expectation, on the margin scale.

    ``base`` plus all attributions equals the raw score of the record. A missing value
    goes the way the model learned for it; the trees of Spark ML have no such way and
    take 0, as in scoring. Workers get the node table alone (about 50 bytes a node);
    paths are walked there, once a task.
    """
    spark = df.sparkSession
    ship_package(spark)
    features = list(features)
    fill = not isinstance(model, BoostedTrees)
    if not fill and tuple(features) != model.features:
        raise ValueError(f"the model was fitted on {model.features}")
    forest = forest_of(model, spark)
    base = forest.base()
    shared = spark.sparkContext.broadcast(forest)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaves = list(shared.value.leaves())
        for batch in batches:
            x = batch[features].to_numpy(dtype="float64", na_value=np.nan)
            out = pd.DataFrame(shared.value.attributions(leaves, x), columns=features)
            out.insert(0, "base", base)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    kind = df.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, base double, " + ", ".join(f"{c} double" for c in features)
    cells = [F.col(c).cast("double") for c in features]
    inputs = df.select(key, *[(F.coalesce(x, F.lit(0.0)) if fill else x).alias(c) for c, x in zip(features, cells, strict=True)])
    return inputs.mapInPandas(explain, schema)


def attribution_summary(attributions: DataFrame, features: Sequence[str], top: int = 6):
    """Mean absolute attribution per feature, largest first."""
    wide = attributions.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in features])
    long = wide.unpivot([], list(features), "feature", "mean_abs")
    rounded = long.select("feature", round_half_up("mean_abs").alias("mean_abs"))
    return rounded.orderBy(F.desc("mean_abs"), "feature").limit(top)
