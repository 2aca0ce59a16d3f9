"""Endpoint metrics per period, alarms over periods, and delayed outcomes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.functions.scalar import ratio
from equigauge.operators.prefix import quantiles

PERIOD_SECONDS = 300
BREACHING, NOT_BREACHING = "breaching", "not_breaching"


def period_start(ts: str, seconds: int = PERIOD_SECONDS) -> Column:
    return F.window(F.col(ts).cast("timestamp"), f"{seconds} seconds")["start"]


def endpoint_windows(
    events: DataFrame,
    ts: str = "ts",
    error: str = "is_error",
    latency: str = "latency",
    by: Sequence[str] = (),
    seconds: int = PERIOD_SECONDS,
) -> DataFrame:
    """Requests, error rate and exact p99 latency per tumbling period."""
    group = [*by, "window_start"]
    rows = events.select(*by, period_start(ts, seconds).alias("window_start"), error, latency)
    counts = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(error).cast("long")).alias("errors")
    )
    counts = counts.withColumn("error_rate", ratio(F.col("errors"), F.col("n")))
    p99 = quantiles(rows, group, latency, [0.99]).select(*group, F.col("value").alias("p99"))
    return counts.join(p99, group, "left")


@dataclass(frozen=True)
class AlarmRule:
    """Fires when ``condition`` holds in ``periods`` windows in a row.

    ``missing`` says whether a window without any row counts as a breach.
    """

    name: str
    condition: str
    periods: int
    missing: str = NOT_BREACHING


def endpoint_rules(
    latency_limit: float = 2000.0, latency_unit_per_limit_unit: float = 1.0
) -> tuple[AlarmRule, ...]:
    """The three endpoint alarms.

    The latency limit is stated in one unit and measured in another in some
    setups; the factor between them is explicit.
    """
    limit = latency_limit * latency_unit_per_limit_unit
    return (
        AlarmRule("endpoint-availability", "n < 1", 2, BREACHING),
        AlarmRule("invocation-errors", "error_rate > 5e-2", 3),
        AlarmRule("model-latency", f"p99 > {limit!r}D", 3),
    )


def calendar(windows: DataFrame, by: Sequence[str] = (), seconds: int = PERIOD_SECONDS):
    """All periods from the first to the last window, for every key."""
    span = windows.groupBy(*by).agg(
        F.min("window_start").alias("lo"), F.max("window_start").alias("hi")
    )
    step = F.expr(f"interval {seconds} seconds")
    return span.where(F.col("lo").isNotNull()).select(
        *by, F.explode(F.sequence("lo", "hi", step)).alias("window_start")
    )


def alarms(
    windows: DataFrame,
    rules: Sequence[AlarmRule],
    by: Sequence[str] = (),
    seconds: int = PERIOD_SECONDS,
    periods: DataFrame | None = None,
) -> DataFrame:
    """Breach and alarm state of every rule in every period.

    A breach adds one to its own and the following ``periods - 1`` windows; a
    window that collects ``periods`` fires. That needs one grouped sum, no
    ordered window over the whole series.
    """
    keys = [*by, "window_start"]
    periods = calendar(windows, by, seconds) if periods is None else periods
    seen = periods.join(windows.withColumn("_seen", F.lit(True)), keys, "left")
    states = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.periods).alias("periods"),
                F.when(F.col("_seen").isNull(), F.lit(r.missing == BREACHING))
                .otherwise(F.coalesce(F.expr(r.condition), F.lit(False)))
                .alias("breach"),
            )
            for r in rules
        ]
    )
    rows = seen.select(*keys, F.inline(states))
    steps = F.when(F.col("breach"), F.sequence(F.lit(0), F.col("periods") - 1)).otherwise(
        F.array(F.lit(0))
    )
    spread = rows.withColumn("step", F.explode(steps))
    target = F.timestamp_seconds(
        F.unix_seconds("window_start") + F.col("step").cast("long") * seconds
    )
    own = F.col("step") == 0
    sums = spread.groupBy(*by, "rule", target.alias("window_start")).agg(
        F.bool_or(own).alias("own"),
        F.bool_or(own & F.col("breach")).alias("breach"),
        F.count_if("breach").alias("hits"),
        F.max("periods").alias("periods"),
    )
    return sums.where("own").select(
        *by, "rule", "window_start", "breach", (F.col("hits") == F.col("periods")).alias("alarm")
    )


def delayed_labels(
    preds: DataFrame,
    outcomes: DataFrame,
    key: str,
    pred_ts: str,
    outcome_ts: str,
    horizon: str = "interval 60 days",
) -> DataFrame:
    """Predictions whose outcome arrived after them, within the horizon.

    One prediction and one outcome per key.
    """
    names = [c for c in outcomes.columns if c != key and c in preds.columns]
    late = outcomes.drop(*names)
    within = (F.col(outcome_ts) >= F.col(pred_ts)) & (
        F.col(outcome_ts) <= F.col(pred_ts) + F.expr(horizon)
    )
    return preds.join(late, key, "inner").where(within)


def live_performance(
    matched: DataFrame, total: DataFrame, least_auc: float, y: str
) -> DataFrame:
    """Metrics on the outcomes known so far and whether they call for retraining."""
    from equigauge.operators.metrics import overall_metrics

    known = overall_metrics(matched, y=y)
    everyone = total.agg(F.count(F.lit(1))).scalar()
    return known.withColumn("predictions", everyone).withColumn(
        "retrain", F.coalesce(F.col("auc_roc") < F.lit(least_auc), F.lit(False))
    )
