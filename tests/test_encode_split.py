import random

import pytest
from pyspark.sql import functions as F

from equigauge.operators import encode, joins, split
from equigauge.session import new_path

COLS = "person_id long, education string, occupation string, class_of_worker string, marital_status string, age double, hours_per_week double, person_weight double, high_income int"


def people(spark, n=40):
    rows = [
        (i, str(i % 3), f"{i % 4 * 10:04d}", "1", None if i % 5 == 0 else "2", float(i), None if i % 7 == 0 else 40.0 + i, 1.0, i % 2)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, COLS)


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([("3",), ("1",), ("3",), ("1",), ("2",), (None,)], "c string")
    got = encode.modes(encode.code_counts(df, ["c"])).first()
    assert (got.code, got.n) == ("1", 2)
    assert [r.c for r in encode.mode_fill(df, ["c"]).collect()].count("1") == 3


def test_constant_and_empty_columns_scale(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None)], "a double, b double")
    stats = encode.fit_scaler(df, ["a", "b"])
    got = encode.scale(df, stats, ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [(0.0, None), (0.0, None)]


def test_unknown_and_missing_codes_become_zero(spark):
    train = spark.createDataFrame([("0010",), ("0020",), ("10",)], "c string")
    codes = encode.fit_codes(train, ["c"])
    assert {r.code: r.idx for r in codes.collect()} == {"0010": 0, "0020": 1, "10": 2}
    fresh = spark.createDataFrame([("0020",), ("x",), (None,)], "c string")
    coded = encode.encode(fresh, codes, ["c"], keep_known=True).collect()
    assert sorted((r.c, r.c_known) for r in coded) == [(0, False), (0, False), (1, True)]
    report = encode.fallback_report(fresh, codes, ["c"]).first()
    assert (report.rows, report.fallback_rows) == (3, 2)
    assert [r.code for r in joins.unseen(fresh, codes, ["c"]).collect()] == ["x"]


def test_long_code_lists_rank_the_same(spark):
    names = [f"n{random.Random(i).randrange(10**6):07d}" for i in range(500)]
    df = spark.createDataFrame([(n, n[:3]) for n in names], "a string, b string")
    short = encode.fit_codes(df, ["a", "b"])
    long = encode.fit_codes(df, ["a", "b"], max_rows=0)
    assert sorted(map(tuple, short.collect())) == sorted(map(tuple, long.collect()))


@pytest.mark.parametrize("max_rows", [100, 0])
def test_lookup_join_both_ways(spark, max_rows):
    df = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(90)], "i int, k string")
    table = spark.createDataFrame([("hot", 1), ("k0", 2)], "k string, v int")
    got = joins.lookup_join(df, table, ["k"], max_rows=max_rows)
    assert got.count() == 90
    assert {r.k: r.v for r in got.where("v is not null").collect()} == {"hot": 1, "k0": 2}


def test_preprocessor_ignores_the_scored_batch(spark, tmp_path):
    df = people(spark)
    model = encode.Preprocessor().fit(df)
    one = df.where("person_id = 35").drop("high_income")
    alone = model.transform(one).first()
    among = model.transform(df).where("person_id = 35").drop("high_income").first()
    assert alone.asDict() == among.asDict()
    assert alone.asDict().keys() == set(
        ["person_id", "age", "education", "occupation", "hours_per_week", "class_of_worker", "marital_status", "person_weight"]
    )
    path = new_path(spark, "prep-test")
    encode.save_prep(model, path)
    again = encode.load_prep(path)
    assert sorted(map(tuple, again.transform(df).collect())) == sorted(
        map(tuple, model.transform(df).collect())
    ) or again.transform(df).exceptAll(model.transform(df)).count() == 0


def test_split_is_exact_disjoint_and_stable(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 4 == 0).cast("int").alias("y"))
    tagged = split.stratified_split(df, "y", "k", 0.2, 42)
    counts = {(r.y, r.is_test): r["count"] for r in tagged.groupBy("y", "is_test").count().collect()}
    assert counts == {(0, True): 150, (0, False): 602, (1, True): 50, (1, False): 201}
    moved = split.stratified_split(df.repartition(13, F.rand(1)), "y", "k", 0.2, 42)
    assert tagged.exceptAll(moved).count() == 0
    other = split.stratified_split(df, "y", "k", 0.2, 7)
    assert tagged.where("is_test").exceptAll(other.where("is_test")).count() > 0


def test_folds_are_balanced_and_follow_rank(spark):
    df = spark.range(503).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    folds = split.stratified_folds(df, "y", "k", 5, 42)
    sizes = folds.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        mine = [r["count"] for r in sizes if r.y == y]
        assert len(mine) == 5 and max(mine) - min(mine) <= 1
    ranked = split.rank_in_class(df, "y", "k", 42)
    assert ranked.groupBy("y").agg(
        (F.max("rank") == F.count_distinct("rank")).alias("ok")
    ).where("not ok").count() == 0
    spans = folds.join(ranked.select("k", "rank"), "k").groupBy("y", "fold").agg(
        F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.count("*").alias("n")
    )
    assert spans.where("hi - lo + 1 <> n").count() == 0


def test_tiny_class_has_no_test_row(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0), (5, 0), (6, 0)], "k long, y int")
    tagged = split.stratified_split(df, "y", "k")
    assert {(r.y, r["count"]) for r in tagged.where("is_test").groupBy("y").count().collect()} == {(0, 1)}
