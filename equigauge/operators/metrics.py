"""Exact binary classification metrics, overall or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equigauge.functions.scalar import ratio, round_half_up
from equigauge.operators.prefix import (
    BUCKET,
    add_bucket,
    before_bucket,
    before_in_bucket,
    cut_points,
    histogram,
)
from equigauge.roles import ROLES

COUNTS = ("tp", "fp", "fn", "tn")


def confusion(
    df: DataFrame, by: Sequence[str] = (), y: str = ROLES.label, pred: str = "pred"
) -> DataFrame:
    real, said = F.col(y) == 1, F.col(pred) == 1
    return df.groupBy(*by).agg(
        F.count_if(real & said).alias("tp"),
        F.count_if(~real & said).alias("fp"),
        F.count_if(real & ~said).alias("fn"),
        F.count_if(~real & ~said).alias("tn"),
    )


def prf_columns() -> dict[str, Column]:
    """Precision, recall and F1 of the counts tp, fp, fn; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {
        "precision": round_half_up(ratio(tp, tp + fp)),
        "recall": round_half_up(ratio(tp, tp + fn)),
        "f1": round_half_up(ratio(2 * tp, 2 * tp + fp + fn)),
    }


def prf(
    df: DataFrame, by: Sequence[str] = (), y: str = ROLES.label, pred: str = "pred"
) -> DataFrame:
    counts = confusion(df, by, y, pred)
    return counts.select(*by, *[c.alias(n) for n, c in prf_columns().items()])


def ppr(df: DataFrame, by: Sequence[str] = (), pred: str = "pred") -> DataFrame:
    rate = round_half_up(F.avg(F.col(pred).cast("double")))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), rate.alias("ppr"))


def ranked_totals(hist: DataFrame, group: Sequence[str], score: str, extra: Sequence[str] = ()):
    """Per group: rows, positives and the AUC, from a histogram of scores.

    ``hist`` holds counts ``n`` and ``pos`` per (group, bucket, score); further
    counts in ``extra`` are summed along. A bucket needs the others only through
    its offset, the negatives before it, so one small row per bucket is enough
    and nothing joins back.
    """
    neg = F.col("n") - F.col("pos")
    before = F.coalesce(F.sum(neg).over(before_in_bucket(group, score)), F.lit(0))
    area = F.col("pos").cast("double") * (before.cast("double") + neg.cast("double") / 2)
    sums = ["n", "pos", *extra]
    buckets = (
        hist.withColumn("_area", area)
        .groupBy(*group, BUCKET)
        .agg(*[F.sum(c).alias(c) for c in sums], F.sum("_area").alias("_area"))
    )
    offset = F.coalesce(F.sum(neg).over(before_bucket(group)), F.lit(0))
    buckets = buckets.withColumn(
        "_area", F.col("_area") + F.col("pos").cast("double") * offset.cast("double")
    )
    totals = buckets.groupBy(*group).agg(
        *[F.sum(c).alias(c) for c in sums], F.sum("_area").alias("_area")
    )
    pairs = F.col("pos").cast("double") * neg.cast("double")
    auc = F.when((F.col("pos") > 0) & (neg > 0), F.col("_area") / pairs)
    return totals.withColumn("auc_roc", auc).drop("_area")


def auc_roc(
    df: DataFrame, by: Sequence[str] = (), y: str = ROLES.label, score: str = "score"
) -> DataFrame:
    """AUC-ROC; tied scores count half, NULL if a class is missing."""
    rows = df.where(F.col(score).isNotNull()).select(*by, score, y)
    cuts = cut_points(rows, [score])[score]
    hist = histogram(
        add_bucket(rows, score, cuts),
        by,
        score,
        n=F.count(F.lit(1)),
        pos=F.sum(F.col(y).cast("long")),
    )
    totals = ranked_totals(hist, list(by), score)
    return totals.select(*by, "n", "pos", round_half_up("auc_roc").alias("auc_roc"))


def overall_metrics(df: DataFrame, by: Sequence[str] = (), y: str = ROLES.label) -> DataFrame:
    """AUC, F1, precision, recall and positive rate from one pass over the scores."""
    rows = df.where(F.col("score").isNotNull())
    cuts = cut_points(rows, ["score"])["score"]
    hist = histogram(
        add_bucket(rows, "score", cuts),
        by,
        "score",
        n=F.count(F.lit(1)),
        pos=F.sum(F.col(y).cast("long")),
        said=F.sum(F.col("pred").cast("long")),
        tp=F.sum((F.col(y) * F.col("pred")).cast("long")),
    )
    totals = ranked_totals(hist, list(by), "score", ["said", "tp"])
    totals = totals.withColumn("fp", F.col("said") - F.col("tp")).withColumn(
        "fn", F.col("pos") - F.col("tp")
    )
    return totals.select(
        *by,
        "n",
        round_half_up("auc_roc").alias("auc_roc"),
        *[c.alias(name) for name, c in prf_columns().items()],
        round_half_up(ratio(F.col("said"), F.col("n"))).alias("overall_ppr"),
    )


def class_report(df: DataFrame, y: str = ROLES.label, pred: str = "pred") -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted rows."""
    counts = confusion(df, (), y, pred)
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    sides = {"1": (tp, fp, fn), "0": (tn, fn, fp)}
    for name, (hit, over, missed) in sides.items():
        counts = counts.withColumns(
            {
                f"p{name}": ratio(hit, hit + over),
                f"r{name}": ratio(hit, hit + missed),
                f"f{name}": ratio(2 * hit, 2 * hit + over + missed),
                f"s{name}": hit + missed,
            }
        )
    total = F.col("s0") + F.col("s1")

    def row(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("row"),
            p.alias("precision"),
            r.alias("recall"),
            f.alias("f1"),
            s.alias("support"),
        )

    def mean(m):
        return (F.col(f"{m}0") + F.col(f"{m}1")) / 2

    def weighted(m):
        return ratio(
            F.col(f"{m}0") * F.col("s0").cast("double") + F.col(f"{m}1") * F.col("s1").cast("double"),
            total,
        )

    accuracy = ratio(tp + tn, total)
    rows = [
        row(n, F.col(f"p{n}"), F.col(f"r{n}"), F.col(f"f{n}"), F.col(f"s{n}")) for n in ("0", "1")
    ]
    rows += [
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", mean("p"), mean("r"), mean("f"), total),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), total),
    ]
    out = counts.select(F.inline(F.array(*rows)))
    return out.select(
        "row", *[round_half_up(c).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


def with_previous(runs: DataFrame, order: str, columns: Sequence[str], by: Sequence[str] = ()):
    """Value of the previous and the first run next to each run.

    Meant for run logs: one row per run and group, so a window per group is small.
    """
    w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {f"{c}_previous": F.lag(c).over(w) for c in columns}
    added |= {f"{c}_first": F.first_value(c).over(whole) for c in columns}
    return runs.withColumns(added)


def progression(runs: DataFrame, order: str, columns: Sequence[str] = ("auc_roc", "f1")):
    """Change of each metric against the previous and the first model."""
    seen = with_previous(runs, order, columns)
    deltas = {}
    for c in columns:
        deltas[f"{c}_delta"] = round_half_up(F.col(c) - F.col(f"{c}_previous"))
        deltas[f"{c}_delta_first"] = round_half_up(F.col(c) - F.col(f"{c}_first"))
    return seen.select(order, *columns, *[d.alias(n) for n, d in deltas.items()])
