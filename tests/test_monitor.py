from datetime import datetime, timedelta

from pyspark.sql import functions as F

from equigauge.operators import monitor
from equigauge.plans.q_monitor import _run_to_end
from equigauge.session import new_path
from equigauge.streaming import alarms as stream_alarms
from equigauge.streaming import windows as stream_windows

START = datetime(2024, 1, 1)


def windows(spark, values):
    """Window i with (n, error_rate, p99); None leaves the window out."""
    rows = [
        (START + timedelta(minutes=5 * i), *v) for i, v in enumerate(values) if v is not None
    ]
    return spark.createDataFrame(rows, "window_start timestamp, n long, error_rate double, p99 double")


def states(found, rule):
    rows = found.where(F.col("rule") == rule).orderBy("window_start").collect()
    return "".join("A" if r.alarm else "b" if r.breach else "." for r in rows)


def test_alarm_needs_breaches_in_a_row(spark):
    ok, bad = (10, 0.0, 1.0), (10, 0.06, 3000.0)
    w = windows(spark, [bad, bad, ok, bad, bad, bad, bad, None, bad])
    found = monitor.alarms(w, monitor.endpoint_rules())
    assert states(found, "invocation-errors") == "bb.bbAA.b"
    assert states(found, "model-latency") == "bb.bbAA.b"
    assert states(found, "endpoint-availability") == ".......b."


def test_missing_windows_follow_the_policy(spark):
    ok = (10, 0.0, 1.0)
    w = windows(spark, [ok, None, None, None, ok, None, ok])
    found = monitor.alarms(w, monitor.endpoint_rules())
    assert states(found, "endpoint-availability") == ".bAA.b."
    assert states(found, "invocation-errors") == "......."


def test_error_rate_on_the_limit_is_no_breach(spark):
    w = windows(spark, [(20, 0.05, 2000.0)] * 4)
    found = monitor.alarms(w, monitor.endpoint_rules())
    assert states(found, "invocation-errors") == "...." == states(found, "model-latency")
    scaled = monitor.alarms(w, monitor.endpoint_rules(2.0, 1000.0))
    assert states(scaled, "model-latency") == "...."
    tight = monitor.alarms(w, monitor.endpoint_rules(2000.0, 0.001))
    assert states(tight, "model-latency") == "bbAA"


def test_delayed_labels_respect_the_horizon(spark):
    preds = spark.createDataFrame([(i, START) for i in range(4)], "k long, ts timestamp")
    outs = spark.createDataFrame(
        [(0, START + timedelta(days=60)), (1, START + timedelta(days=61)), (2, START - timedelta(days=1))],
        "k long, seen timestamp",
    )
    got = monitor.delayed_labels(preds, outs, "k", "ts", "seen", "interval 60 days")
    assert [r.k for r in got.collect()] == [0]


def test_stream_alarms_equal_batch_on_closed_windows(spark):
    rows = []
    for key, busy in (("x", [0, 1, 2, 6, 7, 20]), ("y", [0, 3, 4, 5, 20])):
        for i in busy:
            for j in range(4):
                rows.append((key, START + timedelta(minutes=5 * i, seconds=j), int(key == "y" or j == 0), 5.0))
    # a key that keeps the watermark moving
    rows.append(("z", START + timedelta(hours=4), 0, 1.0))
    df = spark.createDataFrame(rows, "endpoint string, ts timestamp, is_error int, latency double")
    path = new_path(spark, "stream-test")
    df.write.parquet(f"{path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{path}/in")
    rules = (
        monitor.AlarmRule("up", "n < 1", 2, monitor.BREACHING),
        monitor.AlarmRule("errors", "error_rate > 0.5", 3),
    )
    closed = stream_windows.stream_windows(stream, by=["endpoint"])
    found = stream_alarms.stream_alarms(closed, rules, "endpoint")
    _run_to_end(found.writeStream.format("parquet").option("path", f"{path}/out"), path)
    got = spark.read.parquet(f"{path}/out")
    batch = monitor.alarms(monitor.endpoint_windows(df, by=["endpoint"]), rules, ["endpoint"])
    names = ["endpoint", "rule", "window_start", "breach", "alarm"]
    until = START + timedelta(minutes=100)
    closed_batch = batch.where((F.col("endpoint") != "z") & (F.col("window_start") <= F.lit(until)))
    upto = got.where((F.col("endpoint") != "z") & (F.col("window_start") <= F.lit(until)))
    a = sorted(map(tuple, upto.select(*names).collect()))
    b = sorted(map(tuple, closed_batch.select(*names).collect()))
    assert a == b and len(a) > 60
    # the silence after the last request is reported too
    assert got.where("endpoint = 'x' and rule = 'up' and alarm").count() > 10
