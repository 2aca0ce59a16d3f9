import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from equigauge.operators import attribution, boosted

FEATURES = ["a", "b", "c", "d"]


def coalitions(value, x, m):
    """Shapley values by the sum over all coalitions."""
    out = np.zeros(m)
    for f in range(m):
        others = [g for g in range(m) if g != f]
        for k in range(m):
            for s in combinations(others, k):
                weight = math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m)
                out[f] += weight * (value(x, {*s, f}) - value(x, set(s)))
    return out


def expectation(forest):
    """Margin with some features known, by walking the nodes."""

    def walk(k, x, known):
        f = forest.feature[k]
        if f < 0:
            return forest.value[k]
        left, right = forest.left[k], forest.right[k]
        if f in known:
            below = x[f] <= forest.threshold[k] if forest.closed else x[f] < forest.threshold[k]
            return walk(left if (forest.default_left[k] if np.isnan(x[f]) else below) else right, x, known)
        parts = forest.cover[left] * walk(left, x, known) + forest.cover[right] * walk(right, x, known)
        return parts / forest.cover[k]

    return lambda x, known: forest.offset + sum(walk(r, x, known) for r in forest.roots)


def random_forest(rng, features, depth, trees, closed):
    """Full random trees; features repeat on paths, thresholds are few so that values lie on them."""
    width = 2 ** (depth + 1) - 1
    inner = 2**depth - 1
    n = trees * width
    feature, cover = np.full(n, -1), np.zeros(n)
    place = np.arange(n) % width
    feature[place < inner] = rng.integers(0, features, (place < inner).sum())
    start = np.arange(n) - place
    for k in range(n):
        parent = start[k] + (place[k] - 1) // 2
        if place[k] == 0:
            cover[k] = 100.0
        elif place[k] % 2:
            cover[k] = cover[parent] * rng.uniform(0.1, 0.9)
        else:
            cover[k] = cover[parent] - cover[k - 1]
    return attribution.Forest(
        feature, rng.integers(-2, 3, n).astype(float), rng.random(n) < 0.5, start + 2 * place + 1, start + 2 * place + 2,
        cover, rng.normal(size=n), np.arange(0, n, width), 0.25, closed,
    )


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("rows", [3, 200])
def test_path_weights_equal_all_coalitions(closed, rows):
    rng = np.random.default_rng(5 + closed)
    forest = random_forest(rng, 6, 5, 3, closed)
    x = rng.integers(-3, 4, (rows, 6)).astype(float)
    x[rng.random(x.shape) < 0.2] = np.nan
    got = forest.attributions(list(forest.leaves()), x)
    value = expectation(forest)
    assert forest.base() == pytest.approx(value(x[0], set()), abs=1e-12)
    for i in range(3):
        assert got[i] == pytest.approx(coalitions(value, x[i], 6), abs=1e-12)
    for i in range(rows):
        assert forest.base() + got[i].sum() == pytest.approx(value(x[i], set(range(6))), abs=1e-12)


def test_thirty_features_on_one_path():
    # a chain: all thirty conditions hold or the value is 0; equal shares make the features equal
    m, share = 30, 0.7
    n = 2 * m + 1
    inner = np.arange(m)
    feature, left, right = np.full(n, -1), np.full(n, -1), np.full(n, -1)
    feature[inner] = inner
    left[inner], right[inner] = np.append(inner[1:], n - 1), m + inner
    cover, value = np.ones(n), np.zeros(n)
    for k in range(m):
        cover[left[k]], cover[right[k]] = cover[k] * share, cover[k] * (1 - share)
    value[n - 1] = 2.0
    forest = attribution.Forest(feature, np.zeros(n), np.zeros(n, bool), left, right, cover, value, np.array([0]), 0.0, True)
    x = -np.ones((2, m))
    x[1, 4] = 1.0
    got = forest.attributions(list(forest.leaves()), x)
    assert got[0] == pytest.approx(np.full(m, 2 * (1 - share**m) / m), rel=1e-12)
    assert forest.base() + got.sum(axis=1) == pytest.approx([2.0, 0.0], abs=1e-12)
    assert got[1, 4] < 0 < got[1, 0]


def test_boosted_trees_with_missing_values(spark):
    cells = [F.when(F.rand(s) < 0.85, F.round(F.randn(s + 10), 1)).alias(c) for s, c in enumerate(FEATURES)]
    table = spark.range(400, numPartitions=2).select(F.col("id").alias("person_id"), *cells)
    signal = F.coalesce("a", F.lit(0.4)) + F.coalesce("b", F.lit(-0.6)) * F.coalesce("c", F.lit(1.0)) > 0
    table = table.withColumn("high_income", signal.cast("int")).cache()
    model = boosted.fit(table, FEATURES, {"n_estimators": 5, "max_depth": 3})
    rows = {r.person_id: r for r in attribution.attribute_trees(table, model, FEATURES).collect()}
    assert len(rows) == 400
    x = table.orderBy("person_id").select(*FEATURES).toPandas().to_numpy(dtype=float, na_value=np.nan)
    margins = model.margin(x)
    sums = [rows[i].base + sum(rows[i][c] for c in FEATURES) for i in range(400)]
    assert sums == pytest.approx(list(margins), abs=1e-9)
    value = expectation(attribution.forest_of(model, spark))
    gap = int(np.flatnonzero(np.isnan(x).any(axis=1))[0])
    for i in (gap, 7):
        assert [rows[i][c] for c in FEATURES] == pytest.approx(list(coalitions(value, x[i], 4)), abs=1e-9)
    with pytest.raises(ValueError, match="fitted on"):
        attribution.attribute_trees(table, model, FEATURES[::-1])
    assert attribution.attribute_trees(table.where("false"), model, FEATURES).count() == 0
