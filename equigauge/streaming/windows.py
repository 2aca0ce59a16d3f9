"""Endpoint metrics per period on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.functions.scalar import ratio
from equigauge.operators.monitor import PERIOD_SECONDS


def stream_windows(
    events: DataFrame,
    ts: str = "ts",
    error: str = "is_error",
    latency: str = "latency",
    by: Sequence[str] = (),
    seconds: int = PERIOD_SECONDS,
    watermark: str = "10 minutes",
) -> DataFrame:
    """Requests, error rate and p99 of every closed period.

    The percentile is a sketch here: a stream keeps state per open window, and
    a sketch bounds it. ``event_time`` carries the watermark further.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    sums = timed.groupBy(F.window(ts, f"{seconds} seconds").alias("w"), *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(error).cast("long")).alias("errors"),
        F.percentile_approx(F.col(latency).cast("double"), 0.99, 10_000).alias("p99"),
    )
    return sums.select(
        *by,
        F.window_time("w").alias("event_time"),
        F.col("w.start").alias("window_start"),
        "n",
        "errors",
        ratio(F.col("errors"), F.col("n")).alias("error_rate"),
        "p99",
    )
