import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from equigauge.operators import monitor
from equigauge.operators.metrics import auc_roc
from equigauge.plans.q_monitor import _run_to_end
from equigauge.session import new_path
from equigauge.streaming import labels

START = datetime(2024, 1, 1)


def feed(spark, path, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{name}")
    return spark.readStream.schema(schema).parquet(f"{path}/{name}")


def test_every_prediction_leaves_exactly_once(spark):
    rnd = random.Random(4)
    path = new_path(spark, "settled-test")
    preds = [(i, START + timedelta(days=i % 40), rnd.random()) for i in range(400)]
    outs = [(i, ts + timedelta(days=rnd.randint(0, 14)), rnd.randint(0, 1)) for i, ts, _ in preds if i % 3]
    far = START + timedelta(days=200)  # moves both watermarks past everything
    for lo, hi in ((0, 20), (20, 41), (200, 201)):
        within = lambda ts: START + timedelta(days=lo) <= ts < START + timedelta(days=hi)  # noqa: E731, B023
        p = [r for r in preds if within(r[1])] or [(10_000, far, 0.5)]
        o = [r for r in outs if within(r[1])] or [(10_001, far, 1)]
        if lo == 20:
            o = [r for r in outs if r[1] >= START + timedelta(days=20)]
        left = feed(spark, path, "p", p, "k long, ts timestamp, score double")
        right = feed(spark, path, "o", o, "k long, seen timestamp, y int")
        found = labels.stream_settled(left, right, "k", "ts", "seen", "interval 10 days", "1 day")
        _run_to_end(found.select("k", "ts", "score", "y", "settled").writeStream.format("parquet").option("path", f"{path}/out"), path)
    got = spark.read.parquet(f"{path}/out").where("k < 10000")
    rows = got.collect()
    assert sorted(r.k for r in rows) == list(range(400))
    p, o = spark.createDataFrame(preds, "k long, ts timestamp, score double"), spark.createDataFrame(outs, "k long, seen timestamp, y int")
    matched = {r.k: r.y for r in monitor.delayed_labels(p, o, "k", "ts", "seen", "interval 10 days").collect()}
    assert {r.k: r.y for r in rows if r.settled == "matched"} == matched
    assert 0 < len(matched) < len(outs)

    counts = labels.score_counts(got, "y", "ts", "7 days")
    live = labels.live_auc(counts, []).first()
    known = got.where("y is not null").withColumn("s", F.floor(F.col("score") * labels.SCORE_STEPS))
    assert (live.predictions, live.known) == (400, len(matched))
    assert live.auc_roc == auc_roc(known, y="y", score="s").first().auc_roc
    assert labels.live_auc(counts).count() == counts.select("period").distinct().count()


@pytest.mark.parametrize("rows", [[], [(START, 1.0, None)], [(START, -1.0, 1)]])
def test_auc_without_both_classes(spark, rows):
    counts = labels.score_counts(spark.createDataFrame(rows, "ts timestamp, score double, y int"), "y", "ts", "1 day")
    assert [r.auc_roc for r in labels.live_auc(counts).collect()] == [None] * len(rows)
