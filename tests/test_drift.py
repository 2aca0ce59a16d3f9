import decimal
import math
import random

import pytest
from pyspark.sql import functions as F

from equigauge.operators import drift


def one(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def plain_wasserstein(a, b):
    a, b = sorted(a), sorted(b)
    points = sorted(set(a) | set(b))
    total = 0.0
    for x, nxt in zip(points, points[1:], strict=False):
        f = sum(v <= x for v in a) / len(a)
        g = sum(v <= x for v in b) / len(b)
        total += abs(f - g) * (nxt - x)
    mean = sum(a) / len(a)
    std = math.sqrt(sum((v - mean) ** 2 for v in a) / len(a))
    return total / max(std, 0.001)


def test_wasserstein_equals_brute_force(spark):
    rng = random.Random(1)
    a = [round(rng.gauss(0, 3), 2) for _ in range(800)] + [7.0] * 300
    b = [round(rng.gauss(1, 4), 2) for _ in range(500)]
    got = drift.wasserstein(one(spark, a, "double"), one(spark, b, "double"), "x").first()
    assert got.wasserstein == pytest.approx(plain_wasserstein(a, b), rel=1e-9)


def test_equal_and_disjoint_sets(spark):
    same = one(spark, ["a", "b", "b"], "string")
    other = one(spark, ["c", "d"], "string")
    assert drift.jensen_shannon(same, same, "x").first().jensen_shannon == 0.0
    assert drift.jensen_shannon(same, other, "x").first().jensen_shannon == pytest.approx(1.0)
    base_e = drift.jensen_shannon(same, other, "x", math.e).first().jensen_shannon
    assert base_e == pytest.approx(math.sqrt(math.log(2)))


def test_jensen_shannon_is_symmetric(spark):
    a, b = one(spark, list("aabbbc"), "string"), one(spark, list("abbd"), "string")
    ab = drift.jensen_shannon(a, b, "x").first().jensen_shannon
    assert ab == pytest.approx(drift.jensen_shannon(b, a, "x").first().jensen_shannon)


def test_chi_squared(spark):
    ref = one(spark, list("aabb"), "string")
    cur = one(spark, list("aaabz"), "string")
    got = drift.chi_squared(ref, cur, ["x"]).first()
    assert got.chi_squared == pytest.approx((3 - 2.5) ** 2 / 2.5 + (1 - 2.5) ** 2 / 2.5)
    assert (got.chi_df, got.new_values) == (1, 1)
    assert got.p_value == pytest.approx(math.erfc(math.sqrt(got.chi_squared / 2)))


@pytest.mark.parametrize(
    ("x", "k", "p"),
    [(3.841458820694124, 1, 0.05), (11.070497693516351, 5, 0.05), (18.307038053275146, 10, 0.05), (0.0, 3, 1.0)],
)
def test_chi2_tail(spark, x, k, p):
    df = spark.createDataFrame([(x, float(k))], "x double, k double")
    assert df.select(drift.chi2_tail("x", "k")).first()[0] == pytest.approx(p, rel=1e-9)


def exact_tail(n: int, x: float) -> float:
    """Q(n, x) for a whole n: chances of fewer than n Poisson events, in 60 digits, the likeliest first."""
    with decimal.localcontext() as ctx:
        ctx.prec = 60
        x = decimal.Decimal(x)
        down = n - 1 <= x  # sum the smaller side, away from the mean
        k = n - 1 if down else n
        if k < 2000:
            log_factorial = decimal.Decimal(math.factorial(k)).ln()
        else:
            m = decimal.Decimal(k)
            pi = decimal.Decimal("3.14159265358979323846264338327950288419716939937510582097494")
            bernoulli = [(1, 12), (-1, 360), (1, 1260), (-1, 1680), (1, 1188), (-691, 360360), (1, 156)]
            log_factorial = m * m.ln() - m + (2 * pi * m).ln() / 2
            log_factorial += sum(decimal.Decimal(p) / q / m ** (2 * i + 1) for i, (p, q) in enumerate(bernoulli))
        term = total = (k * x.ln() - x - log_factorial).exp()
        while term > total * decimal.Decimal("1e-25") and (not down or k > 0):
            term = term * k / x if down else term * x / (k + 1)
            k += -1 if down else 1
            total += term
        return float(total if down else 1 - total)


@pytest.mark.parametrize("df", [2, 4, 10, 60, 198, 200, 202, 204, 1_000, 20_002, 1_000_000, 10_000_000])
def test_gamma_tail_agrees_with_exact_sums(df):
    for z in (-5, -2, -0.5, -0.01, 0, 0.01, 0.7, 3, 8, 20):
        x = df + z * math.sqrt(2 * df)
        if x > 0:
            want = exact_tail(df // 2, x / 2)
            assert drift.gamma_tail(df / 2, x / 2) == pytest.approx(want, rel=1e-12, abs=1e-14)


def test_gamma_tail_of_odd_degrees():
    for df in (1, 3, 7, 99, 199, 201, 203, 333):
        for x in (0.01, 1.0, df * 0.6, df, df * 1.3 + 1, df * 2.0 + 5):
            half = x / 2
            terms = [math.exp(a * math.log(half) - half - math.lgamma(a + 1)) for a in (i + 0.5 for i in range((df - 1) // 2))]
            want = math.erfc(math.sqrt(half)) + math.fsum(terms)
            assert drift.gamma_tail(df / 2, half) == pytest.approx(want, rel=1e-11, abs=1e-14)
    assert (drift.gamma_tail(3.0, 0.0), drift.gamma_tail(3.0, math.inf), drift.gamma_tail(5000.0, 1e9)) == (1.0, 0.0, 0.0)


def test_choice_of_test_and_overrides(spark):
    ref = spark.createDataFrame([(i % 5, i % 6, str(i % 9)) for i in range(90)], "few int, many int, code string")
    got = {r.feature: r for r in drift.column_drift(ref, ref, ["few", "many", "code"], {"code": drift.CHI_SQUARED}).collect()}
    assert got["few"].stattest == drift.JENSEN_SHANNON
    assert got["many"].stattest == drift.WASSERSTEIN
    assert (got["code"].score_kind, got["code"].score) == ("p_value", 1.0)
    assert not any(r.drift_detected for r in got.values())


def test_empty_current_and_null_columns(spark):
    ref = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    got = drift.column_drift(ref, ref.where("false"), ["a", "b"]).collect()
    assert all(r.score is None and not r.drift_detected for r in got)


def test_summary_alert_is_strict(spark):
    rows = [(f"f{i}", i == 0) for i in range(5)]
    cols = spark.createDataFrame(rows, "feature string, drift_detected boolean")
    got = drift.drift_summary(cols).first()
    assert (got.drift_share, got.alert, got.dataset_drift) == (0.2, False, False)
    more = cols.withColumn("drift_detected", F.col("feature").isin("f0", "f1", "f2"))
    got = drift.drift_summary(more).first()
    assert (got.alert, got.dataset_drift, got.action) == (True, True, "Schedule retraining on fresh data")
    metrics = drift.drift_metrics(drift.drift_summary(more), more).collect()
    assert len(metrics) == 8


def test_spike(spark):
    runs = spark.createDataFrame([(1, 0.0), (2, 0.8), (3, 0.8)], "run int, drift_share double")
    got = [r.advice for r in drift.drift_spike(runs, "run").orderBy("run").collect()]
    assert got == ["as usual", "check pipeline first", "as usual"]
