"""Table profiles: balance, shares, summary statistics, missing values, quality."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.functions.scalar import canonical_code, ratio, round_half_up
from equigauge.operators.prefix import BUCKET, add_bucket, cut_points, histogram, quantiles_of
from equigauge.roles import LIMITS, ROLES

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def class_balance(df: DataFrame, y: str = ROLES.label, limits=LIMITS) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.col(y).cast("long")), F.lit(0)).alias("positives")
    )
    negatives = F.col("rows") - F.col("positives")
    rate = ratio(F.col("positives"), F.col("rows"))
    return counts.select(
        "rows",
        "positives",
        negatives.alias("negatives"),
        round_half_up(rate).alias("positive_rate"),
        round_half_up(F.when(F.col("positives") > 0, ratio(negatives, F.col("positives")))).alias(
            "imbalance_ratio"
        ),
        ((rate < F.lit(limits.balance_low)) | (rate > F.lit(limits.balance_high))).alias("imbalanced"),
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Share of each value; NULLs are left out, also of the total."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n").cast("double") / total.cast("double"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "feature", "nulls")


def range_stats(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column).cast("double")
    return df.agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"))


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column and, as row ``*``, of the whole table."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    total = sum((F.col(c) for c in columns), F.lit(0).cast("long"))
    long = counts.withColumn("_all", total).unpivot(
        ["_rows"], [*columns, "_all"], "feature", "missing"
    )
    long = long.replace("_all", "*", "feature")
    cells = F.when(F.col("feature") == "*", F.col("_rows") * len(columns)).otherwise(F.col("_rows"))
    return long.select(
        "feature", cells.alias("cells"), "missing", ratio(F.col("missing"), cells).alias("share")
    )


def _is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def _numeric_histogram(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()):
    """Counts per (keep…, feature, bucket, value) of all numeric columns in one pass."""
    cuts = cut_points(df, columns)
    buckets = [f"_b_{c}" for c in columns]
    for c, b in zip(columns, buckets, strict=True):
        df = add_bucket(df, c, cuts[c], b)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(b).cast("int").alias(BUCKET),
                F.col(c).cast("double").alias("x"),
            )
            for c, b in zip(columns, buckets, strict=True)
        ]
    )
    long = df.select(*keep, F.inline(cells)).where(F.col("x").isNotNull())
    return histogram(long, [*keep, "feature"], "x", n=F.count(F.lit(1)))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, exact quartiles, maximum."""
    columns = list(columns)
    hist = _numeric_histogram(df, columns)
    wide = df.agg(
        *[F.struct(
            F.count(F.col(c)).alias("count"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev_samp(F.col(c).cast("double")).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        ).alias(c) for c in columns]
    )
    stats = wide.unpivot([], columns, "feature", "s").select("feature", "s.*")
    return stats.join(_quartiles(hist, ["feature"]), "feature", "left")


def _quartiles(hist: DataFrame, group: Sequence[str]) -> DataFrame:
    q = quantiles_of(hist, group, "x", list(QUARTILES.values()))
    return q.groupBy(*group).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name) for name, p in QUARTILES.items()]
    )


def quality_report(
    ref: DataFrame, cur: DataFrame, columns: Sequence[str], exact: bool = True
) -> DataFrame:
    """Both tables side by side, one row per (side, feature).

    Rows, missing values, distinct values and the most common value for every
    column; minimum, maximum, mean, deviation and quartiles for numeric ones.
    With ``exact=False`` distinct counts and quartiles come from sketches and no
    value histogram is built.
    """
    columns = list(columns)
    both = ref.select(F.lit("reference").alias("side"), *columns).unionAll(
        cur.select(F.lit("current").alias("side"), *columns)
    )
    numeric = [c for c in columns if _is_numeric(ref, c)]
    null = F.lit(None).cast("double")

    def stats(c):
        x = F.col(c).cast("double") if c in numeric else null
        fields = [
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(c).isNull()).alias("missing"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
        ]
        if not exact:
            q = F.percentile_approx(x, list(QUARTILES.values()))
            fields.append(F.approx_count_distinct(c).alias("distinct"))
            fields += [q[i].alias(name) for i, name in enumerate(QUARTILES)]
        return F.struct(*fields).alias(c)

    wide = both.groupBy("side").agg(*[stats(c) for c in columns])
    out = wide.unpivot(["side"], columns, "feature", "s").select("side", "feature", "s.*")
    if not exact:
        return out
    values = []
    plain = [c for c in columns if c not in numeric]
    if plain:
        text = both.select("side", *[F.col(c).cast("string").alias(c) for c in plain])
        values.append(
            text.unpivot(["side"], plain, "feature", "value")
            .where(F.col("value").isNotNull())
            .groupBy("side", "feature", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
    if numeric:
        hist = _numeric_histogram(both, numeric, ["side"])
        values.append(hist.select("side", "feature", canonical_code("x").alias("value"), "n"))
    common = F.min(F.struct((-F.col("n")).alias("m"), F.col("value").alias("value")))
    counts = reduce(DataFrame.unionAll, values).groupBy("side", "feature").agg(
        F.count(F.lit(1)).alias("distinct"), common.alias("c")
    )
    counts = counts.select(
        "side",
        "feature",
        "distinct",
        F.col("c.value").alias("most_common"),
        (-F.col("c.m")).alias("most_common_n"),
    )
    out = out.join(counts, ["side", "feature"], "left")
    if numeric:
        out = out.join(_quartiles(hist, ["side", "feature"]), ["side", "feature"], "left")
    return out
