import math
import random

import numpy as np
import pytest

from equigauge.operators import boosted, models
from equigauge.operators.metrics import auc_roc

SCHEMA = "person_id bigint, a double, b double, c double, person_weight double, high_income int"
FEATURES = ["a", "b", "c"]


def made(n=600, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rnd.choice([None, *range(8)]), rnd.choice([0, 1, 2, math.nan]), rnd.random()
        z = (a or 0) - 3 + (2 if b is not None and b != b else 0) - 3 * (c > 0.6)
        rows.append((i, None if a is None else float(a), float(b), round(c, 2), float(rnd.randint(1, 3)), int(z + rnd.gauss(0, 2) > 0)))
    return rows


def plain(rows, p):
    """The same trees, one row and one split at a time."""
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows])
    w = np.array([r[4] * (p["scale_pos_weight"] if r[5] else 1) for r in rows])
    y = np.array([r[5] for r in rows], float)
    margin, trees = np.zeros(len(rows)), []

    def grow(at, depth, tree, node):
        gs, hs = g[at].sum(), h[at].sum()
        best = None
        if depth < p["max_depth"]:
            for f in range(x.shape[1]):
                col = x[at, f]
                values = np.unique(col[~np.isnan(col)])
                every = np.unique(x[~np.isnan(x[:, f]), f])[1:]
                for missing_left in (False, True):
                    if missing_left and not np.isnan(col).any():
                        continue
                    for t in [*every, *([] if missing_left else [np.inf])]:
                        left = np.where(np.isnan(col), missing_left, col < t)
                        hl = h[at][left].sum()
                        if min(hl, hs - hl) < max(p["min_child_weight"], 1e-9) or not len(values):
                            continue
                        gl = g[at][left].sum()
                        lam = p["reg_lambda"]
                        gain = gl**2 / (hl + lam) + (gs - gl) ** 2 / (hs - hl + lam) - gs**2 / (hs + lam)
                        if gain > 1e-6 and gain >= p["gamma"] and (best is None or gain > best[0] + 1e-9):
                            best = gain, f, t, missing_left, left
        if best is None:
            tree[node] = ("leaf", -gs / (hs + p["reg_lambda"]) * p["learning_rate"], hs)
            margin[at] += tree[node][1]
            return
        tree[node] = ("split", best[1], best[2], best[0], hs)
        grow(at[best[4]], depth + 1, tree, 2 * node + 1)
        grow(at[~best[4]], depth + 1, tree, 2 * node + 2)

    for _ in range(p["n_estimators"]):
        prob = 1 / (1 + np.exp(-margin))
        g, h = w * (prob - y), w * prob * (1 - prob)
        tree = {}
        grow(np.arange(len(rows)), 0, tree, 0)
        trees.append(tree)
    return trees, margin


@pytest.mark.parametrize(
    "extra", [{}, {"gamma": 1.5, "min_child_weight": 12, "scale_pos_weight": 2.5}, {"reg_lambda": 0.0, "min_child_weight": 0.0}]
)
def test_trees_equal_a_plain_implementation(spark, extra):
    rows = made()
    p = {**boosted.DEFAULTS, "n_estimators": 3, "max_depth": 3, **extra}
    model = boosted.fit(spark.createDataFrame(rows, SCHEMA), FEATURES, {"n_estimators": 3, "max_depth": 3, **extra})
    trees, margin = plain(rows, p)
    for n, tree in enumerate(trees):
        assert set(np.flatnonzero(model.cover[n] > 0)) == set(tree)
        for k, node in tree.items():
            assert model.cover[n, k] == pytest.approx(node[-1], rel=1e-9)
            if node[0] == "leaf":
                assert model.feature[n, k] == -1 and model.value[n, k] == pytest.approx(node[1], rel=1e-8, abs=1e-10)
            else:
                assert model.gain[n, k] == pytest.approx(node[3], rel=1e-8)
    x = np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows])
    assert model.margin(x) == pytest.approx(margin, rel=1e-8, abs=1e-9)


def test_score_is_the_training_margin(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    trainer = boosted.Trainer(df, FEATURES, {"max_depth": 4}).grow(10)  # written once on the way
    model = trainer.model()
    margins = trainer.table.selectExpr("id", "1 / (1 + exp(-margin)) as p")
    scored = model.score(df).selectExpr("xxhash64(person_id) as id", "score")
    assert scored.join(margins, "id").where("abs(score - p) < 1e-9").count() == 600


def test_class_weight_equals_record_weights(spark):
    rows = made()
    heavy = [(*r[:4], r[4] * (3.0 if r[5] else 1.0), r[5]) for r in rows]
    one = boosted.fit(spark.createDataFrame(rows, SCHEMA), FEATURES, {"n_estimators": 2, "scale_pos_weight": 3.0})
    two = boosted.fit(spark.createDataFrame(heavy, SCHEMA), FEATURES, {"n_estimators": 2})
    assert np.allclose(one.value, two.value) and (one.feature == two.feature).all()


def test_parameters_mean_what_they_say(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    splits = lambda **p: boosted.fit(df, FEATURES, {"n_estimators": 4, **p}).feature
    assert (splits(gamma=4.0) >= 0).sum() < (splits() >= 0).sum()
    assert all(len(set(t[t >= 0])) <= 1 for t in splits(colsample_bytree=0.34))
    assert (splits(min_child_weight=1e9) >= 0).sum() == 0
    again = [boosted.fit(df, FEATURES, {"n_estimators": 2, "subsample": 0.6}).value for _ in range(2)]
    assert np.array_equal(again[0], again[1]) or np.allclose(again[0], again[1], rtol=1e-12)
    assert not np.allclose(again[0], boosted.fit(df, FEATURES, {"n_estimators": 2}).value)
    with pytest.raises(ValueError, match="colsample"):
        boosted.fit(df, FEATURES, {"colsample": 0.5})


def test_as_good_as_spark_ml_trees(spark):
    train, test = (spark.createDataFrame(made(1500, s), SCHEMA) for s in (2, 3))
    own = boosted.fit(train, FEATURES, {"n_estimators": 20, "max_depth": 3, "learning_rate": 0.1}).score(test)
    other = models.score(test.na.fill(0.0), models.fit_gbt(train.na.fill(0.0), FEATURES, {"n_estimators": 20, "max_depth": 3}), FEATURES)
    assert auc_roc(own).first().auc_roc >= auc_roc(other).first().auc_roc


def test_wide_values_take_sketched_cuts(spark):
    df = spark.range(5000).selectExpr("id as person_id", "rand(3) as a").selectExpr("*", "cast(a > 0.4 as int) as high_income", "1.0 as person_weight")
    model = boosted.fit(df, ["a"], {"n_estimators": 1, "max_depth": 1, "max_bin": 32})
    assert abs(model.threshold[0, 0] - 0.4) < 0.04


def test_tables_of_nodes_and_importance(spark):
    model = boosted.fit(spark.createDataFrame(made(), SCHEMA), FEATURES, {"n_estimators": 3, "max_depth": 2})
    nodes = model.nodes(spark).collect()
    assert all((r.feature is None) == (r.value is not None) for r in nodes)
    table = {r.feature: r for r in model.importance(spark).collect()}
    assert sum(r.importance for r in table.values()) == pytest.approx(1)
    for f, r in table.items():
        gains = [n.gain for n in nodes if n.feature == f]
        assert r.n_splits == len(gains) and r.mean_gain == pytest.approx(sum(gains) / len(gains) if gains else 0)


def test_one_class_and_no_rows(spark):
    one = spark.createDataFrame([(i, float(i), 1.0, 1.0, 1.0, 1) for i in range(20)], SCHEMA)
    model = boosted.fit(one, FEATURES, {"n_estimators": 2})
    assert (model.feature < 0).all() and (model.score(one).first().score > 0.5)
    none = boosted.fit(one.limit(0), FEATURES, {"n_estimators": 2})
    assert none.score(one).first().score == 0.5


def test_halving_grows_only_the_best(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    space = {"n_estimators": ("int", 4, 4), "max_depth": ("int", 1, 3), "learning_rate": ("log", 0.0001, 0.5), "gamma": ("float", 0.0, 300.0)}
    found = boosted.halving_search(df, FEATURES, space, trials=6, keep=2, rungs=2, folds=2)
    rows = found.trials.orderBy("trial").collect()
    assert sorted(r.n_trees for r in rows) == [2, 2, 2, 4, 4, 4]
    dropped, kept = ([r.mean_auc for r in rows if r.n_trees == n] for n in (2, 4))
    assert max(kept) >= max(dropped)
    (best,) = [r for r in rows if r.best]
    assert best.mean_auc == max(kept) and best.params["gamma"] == pytest.approx(found.best["gamma"])
    assert isinstance(found.model, boosted.BoostedTrees)
