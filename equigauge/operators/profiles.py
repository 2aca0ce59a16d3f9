"""Stored column profiles that merge: a report over many snapshots reads their profiles, not their rows.

A profile is one row per feature: counts, moments, extremes, and three sketches of
bounded size, for quantiles (KLL), distinct values (HyperLogLog) and frequent
values. Profiles of disjoint rows merge into the profile of all of them. Counts,
moments and extremes are exact up to rounding; errors of the sketches, merged or not:

- quantiles: rank within ``QUANTILE_ERROR`` of the count (with 99 % confidence),
- distinct values: ``DISTINCT_ERROR`` (one standard deviation),
- frequent values: exact up to ``EXACT_VALUES`` distinct values, and beyond that a
  count is too high by at most ``FREQUENT_ERROR`` of the count.

Defined results: a column without values has NULL for everything but its counts
and 0 distinct values. NaN is a missing value. An empty table has one row a feature.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.functions.scalar import canonical_code
from equigauge.operators.profile import QUARTILES
from equigauge.sources.tables import read_days, write_snapshot

QUANTILE_K, DISTINCT_LG_K, TRACKED = 1024, 14, 1024
QUANTILE_ERROR = 0.005
DISTINCT_ERROR = 0.0065
#: the sketch keeps three quarters of its places filled before it drops small counts
EXACT_VALUES = TRACKED * 3 // 4
FREQUENT_ERROR = 3.5 / TRACKED


def _number(df: DataFrame, column: str) -> Column:
    if not isinstance(df.schema[column].dataType, T.NumericType):
        return F.lit(None).cast("double")
    x = F.col(column).cast("double")
    return F.when(~F.isnan(x), x)


def build(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Profile rows (``by``…, feature, …) of a table, in one pass over it.

    Sketches are filled where the rows are; one state per column and group is shuffled.
    """
    columns, numeric = list(columns), {c: isinstance(df.schema[c].dataType, T.NumericType) for c in columns}
    cells = {}
    for i, c in enumerate(columns):
        x = _number(df, c)
        cells[f"x{i}"] = x
        cells[f"v{i}"] = canonical_code(x) if numeric[c] else F.col(c).cast("string")
    wide = df.select(*by, *[cell.alias(name) for name, cell in cells.items()])

    def profile(i: int) -> Column:
        x, v = F.col(f"x{i}"), F.col(f"v{i}")
        return F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.count(v).alias("n"),
            F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("m2"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
            F.kll_sketch_agg_double(x, F.lit(QUANTILE_K)).alias("quantiles"),
            F.hll_sketch_agg(v, F.lit(DISTINCT_LG_K)).alias("values"),
            F.expr(f"approx_top_k_accumulate(v{i}, {TRACKED})").alias("frequent"),
        )

    # names of columns may be any text, so they travel as values
    parts = wide.groupBy(*by).agg(*[profile(i).alias(f"p{i}") for i in range(len(columns))])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"p{i}").alias("p")) for i, c in enumerate(columns)])
    return parts.select(*by, F.explode(rows).alias("r")).select(*by, "r.feature", "r.p.*")


def merge(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One profile per (``by``…, feature) of all its profiles; the rows they came from must be disjoint."""
    group = [*by, "feature"]
    whole = Window.partitionBy(*group)
    has = F.col("mean").isNotNull()
    counted = F.when(has, F.col("n"))
    mean = F.sum(F.col("mean") * counted).over(whole) / F.sum(counted).over(whole)
    # squares around the common mean: nothing cancels if the mean is large
    around = profiles.withColumn("all_mean", mean).withColumn("m2", F.col("m2") + counted * F.pow(F.col("mean") - F.col("all_mean"), 2))
    return around.groupBy(*group).agg(
        F.sum("rows").alias("rows"),
        F.sum("n").alias("n"),
        F.max("all_mean").alias("mean"),
        F.sum("m2").alias("m2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)).alias("quantiles"),
        F.hll_union_agg("values").alias("values"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
    )


def report(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The columns of ``profile.quality_report`` from profiles."""
    numeric = F.col("mean").isNotNull()
    points = F.kll_sketch_get_quantile_double("quantiles", F.array(*[F.lit(float(p)) for p in QUARTILES.values()]))
    quartiles = F.when(numeric, points)
    # among equal counts the smallest value, as far as the sketch lists them
    listed = F.expr(f"approx_top_k_estimate(frequent, {TRACKED})")
    top = F.array_min(F.transform(listed, lambda t: F.struct((-t["count"]).alias("m"), t["item"].alias("value"))))
    wide = profiles.select("*", quartiles.alias("q"), top.alias("top"))
    return wide.select(
        *by,
        "feature",
        "rows",
        (F.col("rows") - F.col("n")).alias("missing"),
        "min",
        "max",
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"),
        F.hll_sketch_estimate("values").alias("distinct"),
        *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(QUARTILES)],
        F.col("top.value").alias("most_common"),
        (-F.col("top.m")).alias("most_common_n"),
    )


def store(df: DataFrame, columns: Sequence[str], path: str, day: date) -> None:
    """Profile a snapshot's rows and store that under its day; a second run replaces the first."""
    write_snapshot(build(df, columns).coalesce(1), path, day)


def read(spark: SparkSession, path: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Stored profiles of a span of days, both ends included; a row per day and feature."""
    return read_days(spark, path, first, last)
