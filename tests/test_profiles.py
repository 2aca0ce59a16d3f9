import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from equigauge.operators import profile, profiles
from equigauge.session import new_path

COLUMNS = ["x", "k", "word", "none"]


@pytest.fixture(scope="module")
def table(spark):
    """60,000 rows over six days of very different size and level."""
    day = F.when(F.col("id") < 30_000, 0).otherwise(F.floor(F.sqrt(F.col("id") - 30_000) / 35) + 1)
    return spark.range(60_000, numPartitions=4).select(
        day.cast("int").alias("day"),
        F.when(F.col("id") % 10 != 0, 1e6 + day + F.randn(3)).alias("x"),
        F.pmod(F.xxhash64("id"), F.lit(9_000)).cast("int").alias("k"),
        F.concat(F.lit("w"), F.floor(F.pow(F.rand(5), 3) * 40).cast("string")).alias("word"),
        F.lit(None).cast("double").alias("none"),
    ).cache()


def test_merged_days_equal_the_profile_of_all_days(spark, table):
    path = new_path(spark, "profiles")
    days = [r.day for r in table.select("day").distinct().collect()]
    start = date(2024, 1, 1)
    for d in days:
        profiles.store(table.where(F.col("day") == d), COLUMNS, path, start + timedelta(days=d))
    stored = profiles.read(spark, path)
    assert stored.count() == len(days) * 4 > 16
    got = {r.feature: r for r in profiles.report(profiles.merge(stored)).collect()}
    want = {r.feature: r for r in profile.quality_report(table, table.where("false"), COLUMNS).where("side = 'reference'").collect()}
    for c in COLUMNS:
        for exact in ("rows", "missing", "min", "max"):
            assert got[c][exact] == want[c][exact], (c, exact)
        if want[c]["mean"] is not None:
            assert got[c]["mean"] == pytest.approx(want[c]["mean"], rel=1e-12)
            assert got[c]["std"] == pytest.approx(want[c]["std"], rel=1e-7)
        exact_distinct = want[c]["distinct"] or 0
        assert abs(got[c]["distinct"] - exact_distinct) <= max(1, 4 * profiles.DISTINCT_ERROR * exact_distinct)
    assert (got["word"].most_common, got["word"].most_common_n) == (want["word"].most_common, want["word"].most_common_n)
    for c in ("x", "k"):
        n = table.where(F.col(c).isNotNull()).count()
        for name, p in profile.QUARTILES.items():
            below, upto = table.agg(F.count_if(F.col(c) < got[c][name]), F.count_if(F.col(c) <= got[c][name])).first()
            assert below - profiles.QUANTILE_ERROR * n <= p * n <= upto + profiles.QUANTILE_ERROR * n
    assert got["none"].distinct == 0 and got["none"].q50 is None and got["none"].most_common is None

    # merging may go in steps, and a span reads its own days
    halves = profiles.merge(stored.withColumn("half", F.dayofmonth("snapshot_date") % 2), ["half"])
    again = {r.feature: r for r in profiles.report(profiles.merge(halves.drop("half"))).collect()}
    assert again["x"].std == pytest.approx(got["x"].std, rel=1e-7) and again["k"].rows == 60_000
    span = profiles.read(spark, path, start, start + timedelta(days=1))
    assert {r.snapshot_date for r in span.collect()} == {start, start + timedelta(days=1)}
    assert not any("snapshot_date=2024-01-03" in f for f in span.inputFiles())
    assert profiles.read(spark, path, date(2030, 1, 1)).count() == 0


def test_frequent_values_beyond_the_tracked_ones(spark):
    # one value in ten rows among 20,000 others: its count is off by the stated share at most
    n = 100_000
    word = F.when(F.col("id") % 10 == 0, "hot").otherwise(F.pmod(F.xxhash64("id"), F.lit(20_000)).cast("string"))
    df = spark.range(n, numPartitions=4).select(word.alias("word"), (F.col("id") % 3).alias("part"))
    merged = profiles.merge(profiles.build(df, ["word"], ["part"]).drop("part"))
    got = profiles.report(merged).first()
    assert got.most_common == "hot"
    assert abs(got.most_common_n - n // 10) <= profiles.FREQUENT_ERROR * n


def test_empty_tables_nan_and_odd_names(spark):
    df = spark.createDataFrame([(1.0, "a"), (math.nan, "a"), (None, None)], "`rows` double, `a.b``c` string")
    df = df.toDF("rows", "n")
    got = {r.feature: r for r in profiles.report(profiles.build(df, ["rows", "n"])).collect()}
    assert (got["rows"].missing, got["rows"].mean, got["rows"].std) == (2, 1.0, None)
    assert (got["n"].most_common, got["n"].most_common_n, got["n"].distinct) == ("a", 2, 1)
    empty = profiles.report(profiles.merge(profiles.build(df.where("false"), ["rows", "n"]))).collect()
    assert [(r.rows, r.missing, r["distinct"], r.q25) for r in empty] == [(0, 0, 0, None)] * 2
