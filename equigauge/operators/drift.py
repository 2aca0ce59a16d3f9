"""Feature drift of a current table against a reference table."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from equigauge.functions.scalar import canonical_code, ratio, round_half_up
from equigauge.operators.metrics import with_previous
from equigauge.operators.prefix import (
    BUCKET,
    add_bucket,
    before_bucket,
    cut_points,
    null_safe_join,
)
from equigauge.roles import LIMITS
from equigauge.session import ship_package

WASSERSTEIN = "Wasserstein distance (normed)"
JENSEN_SHANNON = "Jensen-Shannon distance"
CHI_SQUARED = "chi-square p_value"
FEW_VALUES = 5
NORM_FLOOR = 0.001
#: from this shape on the gamma tail is a quadrature of so many panels and points each
WIDE_SHAPE, PANELS, POINTS = 100, 24, 20


def log1p_less(u: np.ndarray) -> np.ndarray:
    """log(1 + u) - u without the loss of digits near 0."""
    small = np.abs(u) < 0.1
    v = np.where(small, u, 0.0)
    series = sum((-1) ** (n + 1) * v**n / n for n in range(17, 1, -1))
    return np.where(small, series, np.log1p(np.where(small, 0.0, u)) - u)


def _wide_gamma_tail(a: float, x: float) -> float:
    """The tail for a large shape, by a fixed number of quadrature points on its steep side.

    With t = (a - 1)(1 + u) the density is exp((a - 1)(log(1 + u) - u)) in u, times a factor that
    Stirling's series gives. It falls from its peak at u = 0 at least as fast as its tangent.
    """
    n = a - 1
    stirling = 1 / (12 * n) - 1 / (360 * n**3) + 1 / (1260 * n**5)
    start = (x - n) / n
    if start <= -1:
        return 1.0
    at_start = float(n * log1p_less(np.array([start]))[0])
    reach = 45 / max(n * abs(start) / (1 + start), math.sqrt(n))
    upper = start >= 0
    ends = np.linspace(start, start + reach if upper else max(start - reach, -1.0), PANELS + 1)
    half, middle = np.diff(ends)[:, None] / 2, ((ends[1:] + ends[:-1]) / 2)[:, None]
    points, weights = np.polynomial.legendre.leggauss(POINTS)
    heights = np.exp(n * log1p_less(middle + half * points) - at_start)
    area = float(np.abs((heights * half) @ weights).sum())
    side = area * math.sqrt(n / (2 * math.pi)) * math.exp(at_start - stirling)
    return min(1.0, side) if upper else max(0.0, 1.0 - side)


def gamma_tail(a: float, x: float) -> float:
    """Upper incomplete gamma function as a share, Q(a, x), at a cost that does not grow with ``a``.

    Small shapes take the power series of the lower part or the continued fraction of the upper
    one, up to the usual border x = a + 1; large ones a quadrature.
    """
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    if a > WIDE_SHAPE:
        return _wide_gamma_tail(a, x)
    front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * math.exp(front))
    # by convergents from the front, each step multiplies what stands so far
    b = x + 1 - a
    c, d = math.inf, 1 / b
    fraction = d
    for i in range(1, 1000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b)
        c = b + step / c
        fraction *= c * d
        if abs(c * d - 1) < 1e-16:
            break
    return min(1.0, fraction * math.exp(front))


@F.pandas_udf(T.DoubleType())
def chi2_tail(statistic: pd.Series, df: pd.Series) -> pd.Series:
    """P(X > statistic) for a chi-squared X; called on one row per feature."""

    def tail(x: float, k: float) -> float | None:
        return None if pd.isna(x) or pd.isna(k) or k < 1 else gamma_tail(k / 2, x / 2)

    return pd.Series([tail(x, k) for x, k in zip(statistic, df, strict=True)], dtype="float64")


def _sides(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    return ref.select(*columns, F.lit(True).alias("_ref")).unionAll(
        cur.select(*columns, F.lit(False).alias("_ref"))
    )


def _totals(both: DataFrame, columns: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Per feature: values on both sides and the reference deviation, in one pass."""
    wide = both.agg(
        *[
            F.struct(
                F.count(F.when(F.col("_ref"), F.col(c))).alias("total_ref"),
                F.count(F.when(~F.col("_ref"), F.col(c))).alias("total_cur"),
                (
                    F.stddev_pop(F.when(F.col("_ref"), F.col(c).cast("double")))
                    if c in numeric
                    else F.lit(None).cast("double")
                ).alias("std_ref"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.unpivot([], list(columns), "feature", "s").select("feature", "s.*")


def _counts() -> list[Column]:
    return [
        F.count_if("_ref").alias("n_ref"),
        F.count_if(~F.col("_ref")).alias("n_cur"),
    ]


def _category_counts(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    text = both.select("_ref", *[canonical_code(c).alias(c) for c in columns])
    long = text.unpivot(["_ref"], list(columns), "feature", "value")
    return long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(*_counts())


def _number_counts(both: DataFrame, columns: Sequence[str]) -> DataFrame:
    cuts = cut_points(both, columns)
    for c in columns:
        both = add_bucket(both, c, cuts[c], f"_b_{c}")
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"_b_{c}").alias(BUCKET),
                F.col(c).cast("double").alias("x"),
            )
            for c in columns
        ]
    )
    long = both.select("_ref", F.inline(cells)).where(F.col("x").isNotNull())
    return long.groupBy("feature", BUCKET, "x").agg(*_counts())


def _area_terms(hist: DataFrame, totals: DataFrame) -> DataFrame:
    """Adds ``area``, |F_ref - F_cur| times the step to the next value.

    Sorting stays inside (feature, bucket); offsets and the first value of the
    next bucket come from bucket totals, a bounded table per feature.
    """
    w = Window.partitionBy("feature", BUCKET).orderBy("x")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = hist.groupBy("feature", BUCKET).agg(
        F.sum("n_ref").alias("b_ref"), F.sum("n_cur").alias("b_cur"), F.min("x").alias("first_x")
    )
    order = Window.partitionBy("feature").orderBy(BUCKET)
    buckets = buckets.select(
        "feature",
        BUCKET,
        F.coalesce(F.sum("b_ref").over(before_bucket(["feature"])), F.lit(0)).alias("off_ref"),
        F.coalesce(F.sum("b_cur").over(before_bucket(["feature"])), F.lit(0)).alias("off_cur"),
        F.lead("first_x").over(order).alias("next_bucket_x"),
    )
    inside = hist.withColumns(
        {
            "cum_ref": F.sum("n_ref").over(upto),
            "cum_cur": F.sum("n_cur").over(upto),
            "next_x": F.lead("x").over(w),
        }
    )
    rows = null_safe_join(inside, buckets, ["feature", BUCKET])
    rows = rows.join(F.broadcast(totals), "feature")
    gap = F.abs(
        ratio(F.col("off_ref") + F.col("cum_ref"), F.col("total_ref"))
        - ratio(F.col("off_cur") + F.col("cum_cur"), F.col("total_cur"))
    )
    step = F.coalesce("next_x", "next_bucket_x") - F.col("x")
    return rows.withColumn("area", F.coalesce(gap * step, F.lit(0.0)))


def _log_term(p: Column, m: Column, base: float) -> Column:
    return F.when(p > 0, p * F.log(p / m) / F.lit(math.log(base))).otherwise(F.lit(0.0))


def _scores(rows: DataFrame, base: float) -> DataFrame:
    """All distances per feature from value counts (with ``area``, NULL for text)."""
    p = ratio(F.col("n_ref"), F.col("total_ref"))
    q = ratio(F.col("n_cur"), F.col("total_cur"))
    m = (p + q) / 2
    js = (_log_term(p, m, base) + _log_term(q, m, base)) / 2
    expected = F.col("total_cur").cast("double") * p
    chi = F.when(p > 0, F.pow(F.col("n_cur").cast("double") - expected, F.lit(2)) / expected)
    sums = rows.groupBy("feature").agg(
        F.max("total_ref").alias("n_ref"),
        F.max("total_cur").alias("n_cur"),
        F.count_if(F.col("n_ref") > 0).alias("distinct_ref"),
        F.count_if(F.col("n_ref") == 0).alias("new_values"),
        (F.sum("area") / F.greatest(F.max("std_ref"), F.lit(NORM_FLOOR))).alias("wasserstein"),
        F.sqrt(F.greatest(F.sum(js), F.lit(0.0))).alias("jensen_shannon"),
        F.sum(chi).alias("chi_squared"),
    )
    return sums.withColumn("chi_df", F.col("distinct_ref") - 1)


def distances(
    ref: DataFrame, cur: DataFrame, columns: Sequence[str], base: float = 2.0
) -> DataFrame:
    """Every distance that applies, one row per feature; NULLs are left out."""
    columns = list(columns)
    both = _sides(ref, cur, columns)
    numeric = [c for c in columns if isinstance(ref.schema[c].dataType, T.NumericType)]
    text = [c for c in columns if c not in numeric]
    totals = _totals(both, columns, numeric)
    shared = ["feature", "n_ref", "n_cur", "total_ref", "total_cur", "std_ref", "area"]
    parts = []
    if numeric:
        parts.append(_area_terms(_number_counts(both.select("_ref", *numeric), numeric), totals))
    if text:
        counts = _category_counts(both.select("_ref", *text), text)
        counts = counts.join(F.broadcast(totals), "feature")
        parts.append(counts.withColumn("area", F.lit(None).cast("double")))
    rows = parts[0].select(*shared)
    for part in parts[1:]:
        rows = rows.unionAll(part.select(*shared))
    scores = _scores(rows, base)
    evaluable = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return scores.withColumns(
        {
            **{
                c: F.when(evaluable, F.col(c))
                for c in ("wasserstein", "jensen_shannon", "chi_squared")
            },
            "is_numeric": F.col("feature").isin(*numeric) if numeric else F.lit(False),
        }
    )


def wasserstein(ref: DataFrame, cur: DataFrame, column: str) -> DataFrame:
    return distances(ref, cur, [column]).select("feature", "wasserstein")


def jensen_shannon(ref: DataFrame, cur: DataFrame, column: str, base: float = 2.0) -> DataFrame:
    return distances(ref, cur, [column], base).select("feature", "jensen_shannon")


def chi_squared(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Statistic, degrees of freedom, p, and the number of values without expectation."""
    ship_package(ref.sparkSession)
    found = distances(ref, cur, columns)
    return found.select(
        "feature",
        "chi_squared",
        "chi_df",
        chi2_tail("chi_squared", F.col("chi_df").cast("double")).alias("p_value"),
        "new_values",
    )


def choose_test(profile: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Adds ``stattest``: numbers with more than a few values are continuous.

    ``profile`` has (feature, is_numeric, distinct_ref); ``overrides`` names the
    test of single features.
    """
    rule = F.when(F.col("is_numeric") & (F.col("distinct_ref") > FEW_VALUES), WASSERSTEIN)
    chosen = rule.otherwise(JENSEN_SHANNON)
    for feature, test in (overrides or {}).items():
        chosen = F.when(F.col("feature") == feature, test).otherwise(chosen)
    return profile.withColumn("stattest", chosen)


def column_drift(
    ref: DataFrame,
    cur: DataFrame,
    columns: Sequence[str],
    overrides: Mapping[str, str] | None = None,
    limits=LIMITS,
) -> DataFrame:
    """Test, score and verdict per feature."""
    chosen = choose_test(distances(ref, cur, columns), overrides)
    if CHI_SQUARED in (overrides or {}).values():
        ship_package(ref.sparkSession)
        p_value = chi2_tail("chi_squared", F.col("chi_df").cast("double"))
    else:
        p_value = F.lit(None).cast("double")
    test = F.col("stattest")
    score = (
        F.when(test == WASSERSTEIN, F.col("wasserstein"))
        .when(test == JENSEN_SHANNON, F.col("jensen_shannon"))
        .otherwise(p_value)
    )
    by_p = test == CHI_SQUARED
    scored = chosen.withColumn("raw", score)
    drifted = F.when(by_p, F.col("raw") < F.lit(limits.p_value_cut)).otherwise(
        F.col("raw") >= F.lit(limits.distance_cut)
    )
    return scored.select(
        "feature",
        "stattest",
        round_half_up("raw").alias("score"),
        F.when(by_p, "p_value").otherwise("distance").alias("score_kind"),
        F.coalesce(drifted, F.lit(False)).alias("drift_detected"),
    )


def drift_summary(columns: DataFrame, by: Sequence[str] = (), limits=LIMITS) -> DataFrame:
    """Drifted features, their share, the dataset verdict and the alert."""
    counts = columns.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_features"), F.count_if("drift_detected").alias("n_drifted")
    )
    share = round_half_up(ratio(F.col("n_drifted"), F.col("n_features")))
    counts = counts.withColumn("drift_share", share)
    alert = F.col("drift_share") > F.lit(limits.drift_alert)
    return (
        counts.withColumn(
            "dataset_drift",
            (F.col("n_features") > 0)
            & (ratio(F.col("n_drifted"), F.col("n_features")) >= F.lit(limits.dataset_drift_share)),
        )
        .withColumn("alert", alert)
        .withColumn(
            "action",
            F.when(alert, "Schedule retraining on fresh data").otherwise("No retraining required"),
        )
    )


def drift_metrics(summary: DataFrame, columns: DataFrame) -> DataFrame:
    """Metric rows of one drift run: three totals and a flag per feature."""
    totals = [
        ("DriftShare", F.col("drift_share"), "None"),
        ("DriftedFeatures", F.col("n_drifted").cast("double"), "Count"),
        ("DatasetDrift", F.col("dataset_drift").cast("double"), "None"),
    ]
    rows = summary.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("name"), v.alias("value"), F.lit(u).alias("unit"))
                    for n, v, u in totals
                ]
            )
        )
    )
    flags = columns.select(
        F.concat(F.lit("FeatureDrift_"), "feature").alias("name"),
        F.col("drift_detected").cast("double").alias("value"),
        F.lit("None").alias("unit"),
    )
    return rows.unionAll(flags)


def drift_spike(runs: DataFrame, order: str, jump: float = 0.5) -> DataFrame:
    """Runs whose drift share jumps: look at the data feed before retraining."""
    seen = with_previous(runs, order, ["drift_share"])
    step = round_half_up(F.col("drift_share") - F.col("drift_share_previous"))
    seen = seen.withColumn("step", step)
    advice = F.when(F.col("step") >= F.lit(jump), "check pipeline first").otherwise("as usual")
    return seen.select(order, "drift_share", "step", advice.alias("advice"))
