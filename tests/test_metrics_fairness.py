import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equigauge.functions import codebook
from equigauge.operators import fairness, metrics, prefix

# The published table of ten groups, overall rate 0.2686
TEN_GROUPS = [
    ("race: White alone", 9685, 0.2787, 0.0101, 0.9539),
    ("race: Black or African American alone", 2086, 0.1707, 0.0979, 0.9196),
    ("race: American Indian alone", 68, 0.3529, 0.0843, 0.9086),
    ("race: Asian alone", 1059, 0.4127, 0.1441, 0.9522),
    ("race: Some other race alone", 448, 0.1674, 0.1012, 0.9414),
    ("race: Two or more races", 1044, 0.2634, 0.0052, 0.9480),
    ("sex: Male", 6929, 0.3211, 0.0525, 0.9456),
    ("sex: Female", 7478, 0.2198, 0.0488, 0.9543),
    ("nativity: Native born", 12445, 0.2599, 0.0087, 0.9507),
    ("nativity: Foreign born", 1962, 0.3236, 0.0550, 0.9488),
]


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, high_income int").withColumn(
        "pred", (F.col("score") >= 0.5).cast("int")
    )


@pytest.mark.parametrize(
    ("rows", "auc"),
    [
        ([(0.5, 1), (0.5, 0), (0.5, 0)], 0.5),
        ([(0.5, 1), (0.7, 1)], None),
        ([(0.9, 1), (0.8, 1), (0.1, 0)], 1.0),
        ([(0.9, 1), (0.5, 1), (0.5, 0), (0.1, 0)], 0.875),
        ([(0.1, 1), (0.9, 0)], 0.0),
    ],
)
def test_auc_edges(spark, rows, auc):
    assert metrics.auc_roc(scored(spark, rows)).first().auc_roc == auc


def test_auc_equals_evaluator_and_mirrors(spark):
    rng = random.Random(5)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(3000)]
    df = scored(spark, rows)
    got = metrics.auc_roc(df).first().auc_roc
    raw = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="high_income", numBins=0
    ).evaluate(df)
    assert got == pytest.approx(raw, abs=5e-5)
    mirrored = metrics.auc_roc(df.withColumn("score", -F.col("score"))).first().auc_roc
    assert got + mirrored == pytest.approx(1.0, abs=1e-4)


def test_zero_denominators(spark):
    got = metrics.prf(scored(spark, [(0.1, 1), (0.2, 0)])).first()
    assert tuple(got) == (0.0, 0.0, 0.0)


def test_prefix_sum_equals_plain_window(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else rng.choice("ab"), round(rng.gauss(0, 50), 1)) for _ in range(5000)]
    rows += [(None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    for cuts in ([], [0.0], sorted(rng.gauss(0, 50) for _ in range(40))):
        hist = prefix.histogram(prefix.add_bucket(df, "x", cuts), ["g"], "x", n=F.count("*"))
        ours = prefix.prefix_sum(hist, ["g"], "x", ["n"])
        w = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
        plain = hist.withColumn("b", F.coalesce(F.sum("n").over(w), F.lit(0)))
        a = sorted(map(str, ours.select("g", "x", "n", "n_before").collect()))
        b = sorted(map(str, plain.select("g", "x", "n", F.col("b").alias("n_before")).collect()))
        assert a == b


def test_quantiles_equal_builtin(spark):
    rng = random.Random(3)
    rows = [(rng.choice("abc"), rng.choice([None, 7.0, rng.random()])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, x double")
    ours = {(r.g, r.p): r.value for r in prefix.quantiles(df, ["g"], "x", [0.0, 0.25, 0.5, 0.99, 1.0]).collect()}
    plain = df.groupBy("g").agg(F.percentile("x", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.99, 1.0)])).alias("v"))
    for r in plain.collect():
        for p, v in zip((0.0, 0.25, 0.5, 0.99, 1.0), r.v, strict=True):
            assert ours[r.g, p] == pytest.approx(v, abs=1e-12)


def group_rows(n, positives, race):
    return [(0.9 if i < positives else 0.1, i % 2, race) for i in range(n)]


def audit_of(spark, rows, **kw):
    df = spark.createDataFrame(rows, "score double, high_income int, race string").withColumn(
        "pred", (F.col("score") >= 0.5).cast("int")
    )
    dims = {"race": codebook.RACE, "sex": codebook.SEX}
    return df, fairness.fairness_audit(df, dims, **kw)


def test_small_groups_and_unmapped_codes_are_left_out(spark):
    rows = group_rows(29, 5, "1") + group_rows(30, 6, "2") + group_rows(50, 10, "5")
    df, audit = audit_of(spark, rows)
    got = audit.collect()
    assert [(r.group, r.n) for r in got] == [("race: Black or African American alone", 30)]
    assert got[0].ppr_delta == pytest.approx(abs(0.2 - round(21 / 109, 4)), abs=1e-9)
    cover = fairness.audit_coverage(df, {"race": codebook.RACE}).first()
    assert (cover.rows, cover.audited, cover.in_small_groups, cover.without_label) == (109, 30, 29, 50)


def test_delta_on_the_cut_is_not_flagged(spark):
    rows = group_rows(100, 70, "1") + group_rows(100, 30, "2")
    _, audit = audit_of(spark, rows)
    assert {(r.ppr_delta, r.flag) for r in audit.collect()} == {(0.2, False)}
    rows = group_rows(1000, 701, "1") + group_rows(1000, 299, "2")
    _, audit = audit_of(spark, rows)
    assert {(r.ppr_delta, r.flag) for r in audit.collect()} == {(0.201, True)}
    gate = fairness.fairness_gate(audit)
    assert gate.first().gate == "FAILED"
    with pytest.raises(fairness.GateFailedError):
        fairness.enforce(gate)


def test_one_class_group_has_no_auc(spark):
    rows = [(0.3, 0, "1")] * 40 + group_rows(40, 20, "2")
    _, audit = audit_of(spark, rows)
    got = {r.group: r.auc_roc for r in audit.collect()}
    assert got["race: White alone"] is None
    keys = [r.key for r in fairness.flatten_audit(audit).collect()]
    assert "fairness/white_alone/auc_roc" not in keys
    assert "fairness/white_alone/n" in keys and len(keys) == 13


def test_empty_audit_is_not_evaluable(spark):
    _, audit = audit_of(spark, group_rows(5, 1, "1"))
    gate = fairness.fairness_gate(audit)
    assert gate.first().gate == "NOT EVALUABLE"


def published(spark):
    df = spark.createDataFrame(
        [(g, n, p, a) for g, n, p, _, a in TEN_GROUPS], "group string, n long, ppr double, auc_roc double"
    )
    delta = F.floor(F.abs(F.col("ppr") - F.lit(0.2686)) * 1e4 + 0.5) / 1e4
    return df.withColumn("ppr_delta", delta).withColumn("flag", F.col("ppr_delta") > 0.2)


def test_published_groups(spark):
    audit = published(spark)
    assert {r.group: r.ppr_delta for r in audit.collect()} == {g: d for g, _, _, d, _ in TEN_GROUPS}
    assert fairness.fairness_gate(audit).first().gate == "PASSED"
    assert fairness.fairness_tiers(audit).where("tier <> 'ok'").count() == 0
    race = fairness.group_gap(audit).where("dim = 'race'").first()
    assert (race.max_group, race.min_group, race.gap) == (
        "race: Asian alone",
        "race: Some other race alone",
        0.2453,
    )
    named = fairness.group_gap(audit, ["race: Some other race alone"]).where("dim = 'race'").first()
    assert (named.min_group, named.gap) == ("race: Black or African American alone", 0.242)


def test_gap_trend_reviews_and_blocks(spark):
    runs = spark.createDataFrame(
        [(1, "race", 0.24), (2, "race", 0.30), (3, "race", 0.31), (4, "race", 0.20)],
        "run int, dim string, gap double",
    )
    got = [r.status for r in fairness.gap_trend(runs, "run").orderBy("run").collect()]
    assert got == ["ok", "review", "block", "ok"]


def test_gates_and_triggers(spark):
    m = spark.createDataFrame([(0.82,), (0.8199,), (None,)], "auc_roc double")
    assert [r.gate for r in fairness.auc_gate(m).collect()] == ["PASSED", "FAILED", "NOT EVALUABLE"]
    fired = fairness.retraining_triggers(0.2, 0.81, 0.16, 366, spark.range(1)).collect()
    assert {r.trigger: r.fires for r in fired} == {
        "feature_drift": False,
        "auc": True,
        "ppr_delta": True,
        "data_age_days": True,
    }


def test_class_report(spark):
    got = {r.row: r for r in metrics.class_report(scored(spark, [(0.9, 1), (0.9, 0), (0.1, 0), (0.1, 1)])).collect()}
    assert got["accuracy"].f1 == 0.5 and got["weighted avg"].support == 4
    assert got["0"].support == got["1"].support == 2
