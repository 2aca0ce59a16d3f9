"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from equigauge.operators import clean, joins, split
from equigauge.plans import applicants

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize(
    "name",
    [
        "f1_fairness_audit",
        "f1_audit_by_run",
        "f11_retraining_triggers",
        "m3_auc_roc",
        "a2_value_shares",
        "a3_describe",
        "a11_quality_report",
        "d5_column_drift",
        "d3_chi_squared",
        "w1_rank_in_class",
        "w2_exact_quantiles",
        "l1_stratified_split",
        "l12_preprocess",
        "j2_attach_groups",
        "j5_reconcile",
        "t2_alarms",
        "t3_live_performance",
    ],
)
def test_no_pairwise_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_audit_reads_only_its_columns(spark):
    text = plan(entry.queries()["f1_fairness_audit"](spark, SF))
    schemas = {line.strip() for line in text.splitlines() if "ReadSchema" in line}
    assert schemas == {
        "ReadSchema: struct<race:string,sex:string,nativity:string,high_income:int,score:double,pred:int>"
    }


def test_validity_rules_reach_the_scan(spark):
    scored = applicants.scored_applicants(spark, SF).select("person_id", "age", "wage_income")
    text = plan(clean.drop_invalid(scored, clean.validity_rules()))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(age,18)" in pushed
    assert "GreaterThanOrEqual(wage_income,0.0)" in pushed


def test_split_is_a_plain_column(spark):
    scored = applicants.scored_applicants(spark, SF).select("person_id", "high_income")
    text = plan(split.stratified_split(scored, "high_income", "person_id"))
    assert "Exchange" not in text and "Join" not in text


def test_long_lookup_is_not_broadcast_by_hint(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    table = spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("v"))
    spread = joins.lookup_join(df, table, ["k"], max_rows=10)
    assert "_salt" in plan(spread)
    assert joins.lookup_join(df, table, ["k"], max_rows=100).count() == 100
    assert spread.where("v = k").count() == 100
