import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from equigauge.operators import prefix
from equigauge.operators.metrics import auc_roc


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(prefix, "MAX_BUCKETS", 16)
    monkeypatch.setattr(prefix, "VALUES_PER_BUCKET", 50)


def values(spark, n=8000):
    rnd = random.Random(5)
    rows = [(rnd.lognormvariate(0, 3), rnd.choice("ab"), rnd.randint(0, 1)) for _ in range(n)]
    rows += [(1.5, "a", 1)] * 700 + [(None, "b", 0)] * 5
    return rows, spark.createDataFrame(rows, "x double, g string, y int").repartition(6)


def test_buckets_keep_their_size_beyond_one_level(spark, small_buckets):
    rows, df = values(spark)
    cuts = prefix.cut_points(df, ["x", "y"])
    assert len(cuts["x"]) > 100 and cuts["x"] == sorted(set(cuts["x"])) and len(cuts["y"]) <= 2
    sizes = prefix.add_bucket(df.where("x is not null and x <> 1.5"), "x", cuts["x"]).groupBy(prefix.BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] <= 250
    assert sizes.agg(F.avg("count")).first()[0] <= 100


def test_one_level_is_left_as_it_was(spark):
    _, df = values(spark, 500)
    assert 0 < len(prefix.cut_points(df, ["x"])["x"]) < 20
    assert len(prefix.cut_points(df.where("x <> 1.5"), ["x"], 4)["x"]) == 3
    assert prefix.cut_points(df.limit(0), ["x"]) == {"x": []}


def test_sums_and_quantiles_are_exact_on_two_levels(spark, small_buckets):
    rows, df = values(spark)
    counts = {g: Counter(x for x, k, _ in rows if k == g and x is not None) for g in "ab"}
    want = {}
    for g, c in counts.items():
        before = 0
        for x in sorted(c):
            want[g, x] = before
            before += c[x]
    got = {(r.g, r.x): r.n_before for r in prefix.running_counts(df, ["g"], "x").collect()}
    assert got == want
    ordered = sorted(x for x, *_ in rows if x is not None)
    median = prefix.quantiles(df, [], "x", [0.5]).first().value
    middle = (len(ordered) - 1) / 2
    assert median == pytest.approx((ordered[int(middle)] + ordered[-(-int(2 * middle) // 2)]) / 2)


def test_auc_does_not_depend_on_the_levels(spark, monkeypatch):
    _, df = values(spark, 3000)
    plain = auc_roc(df, y="y", score="x").first().auc_roc
    monkeypatch.setattr(prefix, "MAX_BUCKETS", 8)
    monkeypatch.setattr(prefix, "VALUES_PER_BUCKET", 20)
    assert auc_roc(df, y="y", score="x").first().auc_roc == plain
