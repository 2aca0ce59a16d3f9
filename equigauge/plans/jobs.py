"""The three chains end to end: prepare, train and evaluate, watch drift."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equigauge.functions.codebook import CENSUS_DIMS, FIELD_NAMES, NUMERIC_FIELDS
from equigauge.operators import clean, drift, encode, fairness, joins, metrics, models, runs, split
from equigauge.roles import LIMITS, ROLES
from equigauge.sources import matrix, tables


def ingest(spark: SparkSession, landed: str, store: str, day: date) -> None:
    """Landed responses to a typed, dated snapshot; no row is dropped here."""
    raw = matrix.read_json_matrix(spark, landed, [*FIELD_NAMES, "state"])
    named = clean.drop_present(clean.rename_present(raw, FIELD_NAMES), ["state"])
    tables.write_snapshot(clean.coerce_numeric(named, NUMERIC_FIELDS), store, day)


def prepare(
    spark: SparkSession, store: str, out: str, sensitive_out: str, roles=ROLES, limits=LIMITS
) -> encode.PreprocessorModel:
    """Latest snapshot to split tables and a stored preprocessor.

    The split comes before the fit, so nothing is learned from test rows.
    """
    rows = clean.drop_invalid(
        tables.read_latest(spark, store), clean.validity_rules(limits.min_age)
    )
    labelled = clean.label(rows, roles.label_source, limits.label_cut, roles.label)
    tagged = split.stratified_split(
        labelled, roles.label, roles.key, limits.test_share, limits.seed
    )
    model_table, sensitive = clean.separate(tagged, roles)
    prep = encode.Preprocessor().fit(model_table.where("not is_test"))
    sides = [
        prep.transform(model_table.where(F.col("is_test") == F.lit(test))).withColumn(
            "is_test", F.lit(test)
        )
        for test in (False, True)
    ]
    ready = sides[0].unionAll(sides[1])
    wide = joins.attach_groups(ready, sensitive, roles.key)
    tables.write_splits(wide, out, sensitive_out, roles)
    encode.save_prep(prep, f"{out}/preprocessor")
    return prep


@dataclass(frozen=True)
class Evaluation:
    overall: DataFrame
    report: DataFrame
    audit: DataFrame
    coverage: DataFrame
    fairness_gate: DataFrame
    auc_gate: DataFrame


def evaluate(scored: DataFrame, dims=CENSUS_DIMS, roles=ROLES, limits=LIMITS) -> Evaluation:
    """Everything measured on a stored scored table (score, pred, label, dims)."""
    overall = metrics.overall_metrics(scored, y=roles.label)
    audit = fairness.fairness_audit(
        scored, dims, min_n=limits.min_group, cut=limits.fairness_cut, y=roles.label
    )
    return Evaluation(
        overall,
        metrics.class_report(scored, roles.label),
        audit,
        fairness.audit_coverage(scored, dims, limits.min_group),
        fairness.fairness_gate(audit),
        fairness.auc_gate(overall, limits.min_auc),
    )


def train_and_evaluate(
    spark: SparkSession,
    prepared: str,
    sensitive_path: str,
    out: str,
    run_ts: datetime,
    params: dict | None = None,
    dims=CENSUS_DIMS,
    roles=ROLES,
    limits=LIMITS,
) -> Evaluation:
    """Fit boosted trees, score the test side once, measure, log, enforce the gates."""
    features, labels = tables.read_splits(spark, prepared, False, roles, keep_weight=True)
    names = [c for c in roles.feature_order if c in features.columns]
    model = models.fit_gbt(
        features.join(labels, roles.key), names, params, limits.seed, roles.weight, roles.label
    )
    test, _ = tables.read_splits(spark, prepared, True, roles)
    secret = spark.read.parquet(sensitive_path).where("is_test = true").drop("is_test")
    scores = clean.classify(models.score(test, model, names), cut=limits.score_cut)
    scored = joins.attach_groups(scores.select(roles.key, "score", "pred"), secret, roles.key)
    stamp = f"{run_ts:%Y%m%d_%H%M%S}"
    scored.write.mode("overwrite").parquet(f"{out}/scored/run={stamp}")
    stored = spark.read.schema(scored.schema).parquet(f"{out}/scored/run={stamp}")
    found = evaluate(stored, dims, roles, limits)
    for name in ("overall", "audit", "coverage"):
        tables.write_report(getattr(found, name), f"{out}/reports", name, run_ts)
    values = ["auc_roc", "f1", "precision", "recall", "overall_ppr"]
    logged = found.overall.select(*values).unpivot([], values, "key", "value")
    logged = logged.unionAll(fairness.flatten_audit(found.audit))
    importance = models.importance_table(model, names, spark)
    logged = logged.unionAll(
        importance.select(F.concat(F.lit("importance/"), "feature"), "importance")
    ).where(F.col("value").isNotNull())
    gate = found.fairness_gate.first()["gate"]
    runs.log_run(
        spark,
        f"{out}/runs",
        stamp,
        "risk-score",
        run_ts,
        {"model_type": "gbt", "fairness_gate": gate},
        {**models.GBT_DEFAULTS, **(params or {}), "test_size": limits.test_share},
        logged,
    )
    model.write().overwrite().save(f"{out}/models/{stamp}")
    fairness.enforce(found.fairness_gate)
    fairness.enforce(found.auc_gate)
    return found


def watch_drift(
    spark: SparkSession, prepared: str, out: str, run_ts: datetime, roles=ROLES, limits=LIMITS
) -> DataFrame:
    """Training side against current side; metric rows and report tables are stored."""
    reference, _ = tables.read_splits(spark, prepared, False, roles)
    current, _ = tables.read_splits(spark, prepared, True, roles)
    names = [c for c in roles.feature_order if c in reference.columns]
    where = tables.write_report(
        drift.column_drift(reference, current, names, limits=limits),
        f"{out}/reports",
        "column_drift",
        run_ts,
    )
    columns = spark.read.parquet(where)
    summary = drift.drift_summary(columns, limits=limits)
    rows = tables.metric_rows(drift.drift_metrics(summary, columns), "Risk/Drift", run_ts)
    tables.write_metrics(rows, f"{out}/metrics")
    return summary
