import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from equigauge.operators.drift import column_drift
from equigauge.plans.q_monitor import _run_to_end
from equigauge.session import new_path
from equigauge.streaming import alarms, drift_state

DAY = 86400
START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, code string, few int, wide double"


def made(n, day0, days, shift=0.0, seed=1):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        at = START + timedelta(days=day0 + rnd.randrange(days), seconds=rnd.randrange(DAY))
        rows.append((at, rnd.choice(["a", "b", "02", None, "c" if shift else "a"]), rnd.choice([1, 2, 3]), rnd.choice([None, rnd.gauss(shift, 1)])))
    return rows


def run(spark, rows, profile, batches, span):
    """The stream in several runs of one query, so that state is kept between batches."""
    spark.conf.set(alarms.PROVIDER_KEY, alarms.PROVIDER)
    path = new_path(spark, "drift-state-test")
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
        found = drift_state.stream_drift(stream, profile, "ts", DAY, span=span, lateness="1 hour")
        _run_to_end(found.writeStream.format("parquet").option("path", f"{path}/out"), path)
    return spark.read.schema(drift_state.RESULT).parquet(f"{path}/out")


@pytest.mark.parametrize("max_values", [100_000, 64])
def test_equals_the_batch_form_on_the_rows_of_the_span(spark, max_values):
    reference = spark.createDataFrame(made(1500, 0, 5), SCHEMA)
    columns = ["code", "few", "wide"]
    profile = drift_state.reference_profile(reference, columns, max_values)
    rows = made(900, 10, 6, shift=0.8, seed=2)
    sent = [[r for r in rows if lo <= (r[0] - START).days < hi] for lo, hi in ((10, 12), (12, 13), (13, 20))]
    got = run(spark, rows, profile, sent, span=2).collect()
    ends = sorted({r.window_end for r in got})
    assert len(ends) >= 4 and len(got) == 3 * len(ends)
    assert len({(r.feature, r.window_end) for r in got}) == len(got)
    now = spark.createDataFrame(rows, SCHEMA)
    for end in ends[1:4:2]:
        span = now.where((F.col("ts") < F.lit(end)) & (F.col("ts") >= F.lit(end - timedelta(days=2))))
        want = {r.feature: r for r in column_drift(reference, span, columns).collect()}
        for r in (r for r in got if r.window_end == end):
            assert r.stattest == want[r.feature].stattest and r.rows == span.where(F.col(r.feature).isNotNull()).count()
            near = 1e-4 if r.feature != "wide" or max_values > 64 else 0.1  # 64 borders cut the tails off
            assert r.score == pytest.approx(want[r.feature].score, abs=near)


def test_profile_is_bounded_and_comes_back_from_its_files(spark, tmp_path):
    reference = spark.createDataFrame(made(1500, 0, 5), SCHEMA)
    profile = drift_state.reference_profile(reference, ["code", "wide"], 64)
    assert profile.where("feature = 'wide'").count() <= 64
    assert profile.where("feature = 'wide'").agg(F.sum("n")).first()[0] == reference.where("wide is not null").count()
    drift_state.write_profile(profile, f"{tmp_path}/p")
    assert drift_state.load_profile(drift_state.read_profile(spark, f"{tmp_path}/p")) == drift_state.load_profile(profile)
    with pytest.raises(ValueError, match="code"):
        drift_state.reference_profile(reference, ["code"], 2)


def test_scores_without_rows():
    profile = drift_state.FeatureProfile(False, False, {"a": 3}, None)
    assert profile.score({}) is None and profile.score({"a": 5}) == 0.0 and profile.score({"b": 5}) == 1.0
