"""Delayed outcomes on streams: matched, expired, and the AUC of what is known so far."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equigauge.functions.scalar import round_half_up

SCORE_STEPS = 10_000


def stream_delayed_labels(
    preds: DataFrame,
    outcomes: DataFrame,
    key: str,
    pred_ts: str,
    outcome_ts: str,
    horizon: str = "interval 60 days",
    lateness: str = "1 day",
    how: str = "inner",
) -> DataFrame:
    """Stream-stream join of predictions and their outcomes within the horizon.

    Both watermarks and the time condition bound the state that is kept.
    """
    left = preds.withColumn(pred_ts, F.col(pred_ts).cast("timestamp")).withWatermark(
        pred_ts, lateness
    )
    names = [c for c in outcomes.columns if c != key and c in preds.columns]
    right = (
        outcomes.drop(*names)
        .withColumnRenamed(key, "_key")
        .withColumn(outcome_ts, F.col(outcome_ts).cast("timestamp"))
        .withWatermark(outcome_ts, lateness)
    )
    within = (
        (F.col(key) == F.col("_key"))
        & (F.col(outcome_ts) >= F.col(pred_ts))
        & (F.col(outcome_ts) <= F.col(pred_ts) + F.expr(horizon))
    )
    return left.join(right, within, how).drop("_key")


def stream_settled(
    preds: DataFrame,
    outcomes: DataFrame,
    key: str,
    pred_ts: str,
    outcome_ts: str,
    horizon: str = "interval 60 days",
    lateness: str = "1 day",
) -> DataFrame:
    """Every prediction exactly once: with its outcome, or as expired when none can come any more.

    A left outer join of the two streams. A prediction waits in state until the
    watermark of the outcomes has passed its horizon; then it leaves without an
    outcome. Adds ``settled``: matched or expired. A key has one prediction and at
    most one outcome within the horizon.
    """
    joined = stream_delayed_labels(preds, outcomes, key, pred_ts, outcome_ts, horizon, lateness, "left_outer")
    return joined.withColumn("settled", F.when(F.col(outcome_ts).isNull(), "expired").otherwise("matched"))


def score_counts(settled: DataFrame, y: str, pred_ts: str, period: str, score: str = "score", steps: int = SCORE_STEPS) -> DataFrame:
    """Per period and score step of the settled predictions: how many, with an outcome, positive.

    On a stream these counts are all the state there is, ``steps`` + 1 numbers per open
    period; the rows of a period come out when the watermark has passed it.
    """
    step = F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(score))) * steps).cast("int")
    known = F.col(y).isNotNull()
    return (
        settled.groupBy(F.window(pred_ts, period).alias("w"), step.alias("step"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(known).alias("n_known"), F.sum(F.coalesce(F.col(y), F.lit(0)).cast("long")).alias("pos"))
        .select(F.col("w.start").alias("period"), "step", "n", "n_known", "pos")
    )


def live_auc(counts: DataFrame, by: Sequence[str] = ("period",)) -> DataFrame:
    """AUC of the outcomes known so far from the rows of :func:`score_counts`; scores of one step are ties.

    ``predictions`` counts the expired ones too. NULL if a class is missing.
    """
    by = list(by)
    merged = counts.groupBy(*by, "step").agg(*[F.sum(c).alias(c) for c in ("n", "n_known", "pos")])
    neg = F.col("n_known") - F.col("pos")
    # at most steps + 1 rows in a group
    below = Window.partitionBy(*(by or [F.lit(0)])).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    area = F.col("pos").cast("double") * (F.coalesce(F.sum(neg).over(below), F.lit(0)) + neg / 2)
    sums = merged.withColumns({"area": area, "neg": neg}).groupBy(*by)
    sums = sums.agg(*[F.sum(c).alias(c) for c in ("n", "n_known", "pos", "neg", "area")])
    auc = F.when((F.col("pos") > 0) & (F.col("neg") > 0), F.col("area") / (F.col("pos").cast("double") * F.col("neg")))
    return sums.select(*by, F.col("n").alias("predictions"), F.col("n_known").alias("known"), "pos", round_half_up(auc).alias("auc_roc"))
