"""Group audit of a scored table, and the gates that follow from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from equigauge.functions.scalar import canonical_code, literal_map, ratio, round_half_up, slug
from equigauge.operators.metrics import prf_columns, ranked_totals, with_previous
from equigauge.operators.prefix import add_bucket, cut_points, histogram
from equigauge.roles import LIMITS, ROLES

Dims = Mapping[str, Mapping[str, str]]
METRICS = ("ppr", "ppr_delta", "precision", "recall", "f1", "auc_roc", "n")


def _slots(dims: Dims) -> tuple[dict[int, tuple[str, str]], list[Column]]:
    """A number for every (dimension, code), and per dimension the row's number.

    Rows whose code has no label get the negative number of their dimension.
    """
    names: dict[int, tuple[str, str]] = {}
    columns = []
    for d, (dim, labels) in enumerate(dims.items()):
        of_code = {}
        for code, text in labels.items():
            of_code[code] = len(names)
            names[len(names)] = (dim, f"{dim}: {text}")
        found = literal_map(of_code)[canonical_code(dim)]
        columns.append(F.coalesce(found, F.lit(-1 - d)))
    return names, columns


def slot_totals(
    df: DataFrame, dims: Dims, by: Sequence[str] = (), y: str = ROLES.label
) -> DataFrame:
    """Counts and AUC of all groups of all dimensions, one pass over the table."""
    _, columns = _slots(dims)
    rows = df.where(F.col("score").isNotNull())
    cuts = cut_points(rows, ["score"])["score"]
    rows = add_bucket(rows, "score", cuts).select(
        *by, "_bucket", "score", y, "pred", F.explode(F.array(*columns)).alias("slot")
    )
    hist = histogram(
        rows,
        [*by, "slot"],
        "score",
        n=F.count(F.lit(1)),
        pos=F.sum(F.col(y).cast("long")),
        said=F.sum(F.col("pred").cast("long")),
        tp=F.sum((F.col(y) * F.col("pred")).cast("long")),
    )
    return ranked_totals(hist, [*by, "slot"], "score", ["said", "tp"])


def _audit_rows(
    totals: DataFrame, dims: Dims, by: Sequence[str], min_n: int, cut: float
) -> DataFrame:
    names, _ = _slots(dims)
    first = next(iter(dims))
    own = [i for i, (dim, _) in names.items() if dim == first] + [-1]
    # every row is in exactly one slot of the first dimension
    everyone = Window.partitionBy(*(by or [F.lit(0)]))
    in_first = F.col("slot").isin(own)
    overall = round_half_up(
        ratio(
            F.sum(F.when(in_first, F.col("said"))).over(everyone),
            F.sum(F.when(in_first, F.col("n"))).over(everyone),
        )
    )
    text = literal_map({i: name for i, (_, name) in names.items()})
    rows = (
        totals.withColumn("overall_ppr", overall)
        .where((F.col("slot") >= 0) & (F.col("n") >= min_n))
        .withColumn("fp", F.col("said") - F.col("tp"))
        .withColumn("fn", F.col("pos") - F.col("tp"))
        .withColumn("ppr", round_half_up(ratio(F.col("said"), F.col("n"))))
        .withColumn("ppr_delta", round_half_up(F.abs(F.col("ppr") - F.col("overall_ppr"))))
    )
    return rows.select(
        *by,
        text[F.col("slot")].alias("group"),
        "n",
        "ppr",
        *[c.alias(name) for name, c in prf_columns().items()],
        round_half_up("auc_roc").alias("auc_roc"),
        "ppr_delta",
        (F.col("ppr_delta") > F.lit(cut)).alias("flag"),
    )


def fairness_audit(
    df: DataFrame,
    dims: Dims,
    by: Sequence[str] = (),
    min_n: int = LIMITS.min_group,
    cut: float = LIMITS.fairness_cut,
    y: str = ROLES.label,
) -> DataFrame:
    """Metrics per labelled group with at least ``min_n`` rows.

    ``ppr_delta`` compares the rounded group rate with the rounded overall rate.
    ``by`` repeats the audit per run or period within the same pass.
    """
    present = {d: labels for d, labels in dims.items() if d in df.columns}
    return _audit_rows(slot_totals(df, present, by, y), present, by, min_n, cut)


def audit_coverage(
    df: DataFrame, dims: Dims, min_n: int = LIMITS.min_group
) -> DataFrame:
    """Per dimension: rows audited, rows in small groups, rows without a label."""
    present = {d: labels for d, labels in dims.items() if d in df.columns}
    names, columns = _slots(present)
    slots = df.select(F.explode(F.array(*columns)).alias("slot"))
    counts = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    dim_of = {i: dim for i, (dim, _) in names.items()}
    dim_of |= {-1 - d: dim for d, dim in enumerate(present)}
    mapped, big = F.col("slot") >= 0, F.col("n") >= min_n

    def rows(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    return counts.groupBy(literal_map(dim_of)[F.col("slot")].alias("dim")).agg(
        F.sum("n").alias("rows"),
        rows(mapped & big).alias("audited"),
        rows(mapped & ~big).alias("in_small_groups"),
        rows(~mapped).alias("without_label"),
    )


def fairness_gate(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """PASSED, FAILED with the flagged groups, or NOT EVALUABLE without groups."""
    flagged = F.count_if("flag")
    return (
        audit.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("groups"),
            flagged.alias("flagged"),
            F.array_join(F.sort_array(F.collect_list(F.when(F.col("flag"), F.col("group")))), "; ").alias(
                "failed_groups"
            ),
        )
        .withColumn(
            "gate",
            F.when(F.col("groups") == 0, "NOT EVALUABLE")
            .when(F.col("flagged") == 0, "PASSED")
            .otherwise("FAILED"),
        )
    )


class GateFailedError(RuntimeError):
    """A gate did not pass; a job that lets it through ends with a non-zero code."""


def enforce(gate: DataFrame) -> None:
    """Raise unless every row of a gate table is PASSED."""
    bad = gate.where("gate <> 'PASSED'").limit(20).collect()
    if bad:
        raise GateFailedError("; ".join(str(r.asDict()) for r in bad))


def auc_gate(metrics: DataFrame, least: float = LIMITS.min_auc) -> DataFrame:
    auc = F.col("auc_roc")
    gate = (
        F.when(auc.isNull(), "NOT EVALUABLE").when(auc >= F.lit(least), "PASSED").otherwise("FAILED")
    )
    return metrics.withColumn("min_auc", F.lit(least)).withColumn("gate", gate)


def flatten_audit(audit: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per group metric, key ``fairness/<group>/<metric>``; NULL AUC left out."""
    values = [F.col(m).cast("double").alias(m) for m in METRICS]
    long = audit.select(*by, slug("group").alias("_slug"), *values).unpivot(
        [*by, "_slug"], list(METRICS), "metric", "value"
    )
    key = F.concat(F.lit("fairness/"), F.col("_slug"), F.lit("/"), F.col("metric"))
    return long.where(F.col("value").isNotNull()).select(*by, key.alias("key"), "value")


def fairness_tiers(
    audit: DataFrame, fail: float = LIMITS.fairness_cut, review: float = LIMITS.review_cut
) -> DataFrame:
    delta = F.col("ppr_delta")
    tier = F.when(delta > F.lit(fail), "fail").when(delta > F.lit(review), "review").otherwise("ok")
    return audit.withColumn("tier", tier)


def group_gap(audit: DataFrame, exclude: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Highest and lowest positive rate per dimension and the gap between them."""
    rows = audit.where(~F.col("group").isin(*exclude)) if exclude else audit
    dim = F.split_part(F.col("group"), F.lit(": "), F.lit(1))
    # ties: smallest name on both ends
    top = F.min(F.struct((-F.col("ppr")).alias("v"), F.col("group").alias("g")))
    low = F.min(F.struct(F.col("ppr").alias("v"), F.col("group").alias("g")))
    ends = rows.groupBy(*by, dim.alias("dim")).agg(top.alias("top"), low.alias("low"))
    return ends.select(
        *by,
        "dim",
        F.col("top.g").alias("max_group"),
        (-F.col("top.v")).alias("max_ppr"),
        F.col("low.g").alias("min_group"),
        F.col("low.v").alias("min_ppr"),
        round_half_up(-F.col("top.v") - F.col("low.v")).alias("gap"),
    )


def gap_trend(
    gaps: DataFrame, order: str, growth: float = LIMITS.gap_growth
) -> DataFrame:
    """Gap against the previous run: review on a big step, block on two widenings in a row."""
    seen = with_previous(gaps, order, ["gap"], ["dim"])
    step = round_half_up(F.col("gap") - F.col("gap_previous"))
    seen = seen.withColumn("gap_step", step)
    w = Window.partitionBy("dim").orderBy(order)
    wider = (F.col("gap_step") > 0).cast("int")
    twice = (wider + F.lag(wider).over(w)) == 2
    status = (
        F.when(twice, "block").when(F.col("gap_step") > F.lit(growth), "review").otherwise("ok")
    )
    return seen.select(order, "dim", "gap", "gap_step", status.alias("status"))


def compare_runs(current: DataFrame, base: DataFrame, keys: Sequence[str], value: str):
    """Value of two runs side by side with the change from the base run."""
    a = current.select(*keys, F.col(value).alias("current"))
    b = base.select(*keys, F.col(value).alias("base"))
    change = round_half_up(F.col("current") - F.col("base"))
    return a.join(b, list(keys), "inner").withColumn("change", change)


def ppr_shift(current: DataFrame, base: DataFrame, limit: float = LIMITS.ppr_shift) -> DataFrame:
    """Groups whose positive rate moved against the last production run."""
    pairs = compare_runs(current, base, ["group"], "ppr")
    shift = F.abs("change")
    return pairs.withColumn("rollback_signal", shift > F.lit(limit))


def retraining_triggers(
    drift_share: float | Column,
    auc: float | Column,
    max_ppr_delta: float | Column,
    data_age_days: int | Column,
    base: DataFrame,
    max_age_days: int = 365,
    limits=LIMITS,
) -> DataFrame:
    """The retraining conditions as one table; ``base`` is the one row they are read from."""

    def value(v):
        return (v if isinstance(v, Column) else F.lit(v)).cast("double")

    checks = [
        ("feature_drift", value(drift_share), limits.drift_alert, "above"),
        ("auc", value(auc), limits.min_auc, "below"),
        ("ppr_delta", value(max_ppr_delta), limits.review_cut, "above"),
        ("data_age_days", value(data_age_days), float(max_age_days), "above"),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("trigger"),
            v.alias("value"),
            F.lit(float(limit)).alias("threshold"),
            (v > F.lit(limit) if side == "above" else v < F.lit(limit)).alias("fires"),
        )
        for name, v, limit, side in checks
    ]
    return base.select(F.inline(F.array(*rows)))
