"""The chains end to end on landed files derived from a given table."""

import json
from datetime import date, datetime

import pytest

from equigauge.functions import codebook
from equigauge.operators import fairness
from equigauge.plans import jobs
from equigauge.session import new_path

TS = datetime(2024, 6, 1, 8, 0, 0)


def landed(spark, tmp_path):
    """Two landed files with one record per order."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").orderBy("o_orderkey").collect()
    header = [*codebook.FIELD_NAMES, "state"]
    files = {"va": [header], "md": [header]}
    for i, r in enumerate(orders):
        state = "va" if i % 3 else "md"
        row = {
            "AGEP": str(15 + i % 60),
            "SCHL": str(1 + i % 24),
            "OCCP": f"{(i % 25) * 100:04d}",
            "WKHP": "" if i % 50 == 0 else str(10 + i % 60),
            "COW": str(1 + i % 9),
            "MAR": str(1 + i % 5),
            "PWGTP": str(1 + i % 100),
            "WAGP": "-1" if i % 40 == 0 else str(1500 * (10 + i % 60) * (1 + (i % 24) // 12)),
            "RAC1P": str(1 + i % 9),
            "SEX": str(1 + i % 2),
            "NATIVITY": str(1 + i % 2),
            "state": "51" if state == "va" else "24",
        }
        files[state].append([row[c] for c in header])
    for name, rows in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    return len(orders)


def test_chains(spark, tmp_path):
    n = landed(spark, tmp_path)
    base = new_path(spark, "chain")
    jobs.ingest(spark, str(tmp_path), f"{base}/raw", date(2024, 6, 1))
    assert spark.read.parquet(f"{base}/raw").count() == n
    jobs.prepare(spark, f"{base}/raw", f"{base}/ready", f"{base}/sensitive")
    features = spark.read.parquet(f"{base}/ready/features")
    assert not set(features.columns) & {"race", "sex", "nativity", "wage_income", "high_income"}
    params = {"n_estimators": 5, "max_depth": 3}
    found = jobs.train_and_evaluate(
        spark, f"{base}/ready", f"{base}/sensitive", f"{base}/out", TS, params
    )
    assert found.overall.first().auc_roc > 0.82
    assert found.fairness_gate.first().gate == "PASSED"
    cover = {r.dim: r for r in found.coverage.collect()}
    assert cover["sex"].without_label == 0 and cover["race"].without_label > 0
    summary = jobs.watch_drift(spark, f"{base}/ready", f"{base}/out", TS).first()
    assert (summary.n_features, summary.alert) == (6, False)
    assert spark.read.parquet(f"{base}/out/metrics").count() == 9
    keys = {r.key for r in spark.read.parquet(f"{base}/out/runs/metrics").collect()}
    assert {"auc_roc", "importance/age", "fairness/male/ppr"} <= keys


def test_failed_gate_stops_the_job(spark):
    gate = spark.createDataFrame([("FAILED", "race: x")], "gate string, failed_groups string")
    with pytest.raises(fairness.GateFailedError, match="race: x"):
        fairness.enforce(gate)
