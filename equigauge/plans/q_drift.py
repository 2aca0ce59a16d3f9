"""Queries of the drift operators."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.functions.scalar import round_half_up
from equigauge.operators import drift
from equigauge.plans import applicants as ap
from equigauge.plans.q_tables import _early_late
from equigauge.plans.registry import query, r4, scored_sql
from equigauge.session import new_path
from equigauge.sources import tables

RUN_TS = datetime(2024, 1, 1, 6, 0, 0)
NUMBERS = ("age", "hours_per_week", "wage_income")
CODES = ("education", "marital_status", "class_of_worker")
FEATURES = (*NUMBERS, *CODES)


def planted(cur: DataFrame) -> DataFrame:
    """Current data with a shifted income and one education code gone."""
    code = F.when(F.col("education") == "1", "5").otherwise(F.col("education"))
    return cur.withColumns({"wage_income": F.col("wage_income") * F.lit(1.3e0), "education": code})


def _pair(spark, sf):
    ref, cur = _early_late(spark, sf)
    return ref, planted(cur)


VALUES = f"""
pr as (
  select order_ts < timestamp '1998-01-01' as is_ref, cast(age as double) as age, hours_per_week,
    case when order_ts < timestamp '1998-01-01' then wage_income else wage_income * 13e-1 end as wage_income,
    case when order_ts >= timestamp '1998-01-01' and education = '1' then '5' else education end as education,
    marital_status, class_of_worker from a),
nl as (select is_ref, unnest(['age', 'hours_per_week', 'wage_income']) as feature,
  unnest([age, hours_per_week, wage_income]) as x from pr),
nh as (
  select feature, x, count(*) filter (is_ref) as n_ref, count(*) filter (not is_ref) as n_cur
  from nl where x is not null group by 1, 2),
nc as (
  select *, sum(n_ref) over (partition by feature) as t_ref, sum(n_cur) over (partition by feature) as t_cur,
    sum(n_ref) over (partition by feature order by x) as c_ref,
    sum(n_cur) over (partition by feature order by x) as c_cur,
    lead(x) over (partition by feature order by x) as next_x from nh),
sd as (select feature, stddev_pop(x) as sd from nl where is_ref group by 1),
ws as (
  select feature, sum(abs(c_ref / cast(t_ref as double) - c_cur / cast(t_cur as double)) * (next_x - x))
    / greatest(any_value(sd), 1e-3) as wasserstein from nc join sd using (feature) group by 1),
cl as (select is_ref, unnest(['education', 'marital_status', 'class_of_worker']) as feature,
  unnest([education, marital_status, class_of_worker]) as code from pr),
ch as (
  select feature, code, count(*) filter (is_ref) as n_ref, count(*) filter (not is_ref) as n_cur
  from cl where code is not null group by 1, 2),
cp as (
  select *, n_ref / cast(sum(n_ref) over (partition by feature) as double) as p,
    n_cur / cast(sum(n_cur) over (partition by feature) as double) as q,
    sum(n_cur) over (partition by feature) as t_cur from ch),
js as (
  select feature, sqrt(sum(case when p > 0 then p * ln(p / ((p + q) / 2)) / ln(2e0) else 0e0 end) / 2
    + sum(case when q > 0 then q * ln(q / ((p + q) / 2)) / ln(2e0) else 0e0 end) / 2) as js,
    sum(case when p > 0 then power(n_cur - t_cur * p, 2) / (t_cur * p) end) as chi,
    count(*) filter (p > 0) - 1 as df, count(*) filter (p = 0) as new_values from cp group by 1),
cd as (
  select feature, 'Wasserstein distance (normed)' as stattest, {r4("wasserstein")} as score,
    'distance' as score_kind, wasserstein >= 1e-1 as drift_detected from ws
  union all
  select feature, 'Jensen-Shannon distance', {r4("js")}, 'distance', js >= 1e-1 from js)"""


@query(
    "d1_wasserstein",
    scored_sql(f"select feature, {r4('wasserstein')} as wasserstein from ws where feature = 'wage_income'", VALUES),
)
def d1(spark, sf):
    found = drift.wasserstein(*_pair(spark, sf), "wage_income")
    return found.withColumn("wasserstein", round_half_up("wasserstein"))


@query(
    "d2_jensen_shannon",
    scored_sql(f"select feature, {r4('js')} as jensen_shannon from js where feature = 'education'", VALUES),
)
def d2(spark, sf):
    found = drift.jensen_shannon(*_pair(spark, sf), "education")
    return found.withColumn("jensen_shannon", round_half_up("jensen_shannon"))


@query(
    "d3_chi_squared",
    scored_sql(
        f"""select feature, {r4("chi")} as chi_squared, df as chi_df,
  {r4("exp(-chi / 2) * case df when 2 then 1 else 1 + chi / 2 end")} as p_value, new_values
from js where feature in ('marital_status', 'class_of_worker')""",
        VALUES,
    ),
)
def d3(spark, sf):
    found = drift.chi_squared(*_pair(spark, sf), ["marital_status", "class_of_worker"])
    return found.withColumns(
        {c: round_half_up(c) for c in ("chi_squared", "p_value")}
    )


@query(
    "d4_choose_test",
    scored_sql(
        """select feature, n as distinct_ref, case when n > 5 then 'Wasserstein distance (normed)'
  else 'Jensen-Shannon distance' end as stattest from (
  select feature, count(*) as n from nh where n_ref > 0 group by 1)
union all select feature, count(*) filter (n_ref > 0), case feature when 'education'
  then 'chi-square p_value' else 'Jensen-Shannon distance' end from ch group by 1""",
        VALUES,
    ),
)
def d4(spark, sf):
    found = drift.distances(*_pair(spark, sf), FEATURES)
    chosen = drift.choose_test(found, {"education": drift.CHI_SQUARED})
    return chosen.select("feature", "distinct_ref", "stattest")


def _columns(spark, sf):
    return drift.column_drift(*_pair(spark, sf), FEATURES)


@query("d5_column_drift", scored_sql("select * from cd", VALUES))
def d5(spark, sf):
    return _columns(spark, sf)


@query(
    "d5_no_shift",
    scored_sql(
        f"""select 'wage_income' as feature, 'Wasserstein distance (normed)' as stattest, {r4("w")} as score,
  'distance' as score_kind, w >= 1e-1 as drift_detected from (
  select sum(abs(c_ref / cast(t_ref as double) - c_cur / cast(t_cur as double)) * (next_x - x))
    / greatest((select stddev_pop(wage_income) from a where order_ts < timestamp '1998-01-01'), 1e-3) as w from (
    select x, sum(n_ref) over () as t_ref, sum(n_cur) over () as t_cur, sum(n_ref) over (order by x) as c_ref,
      sum(n_cur) over (order by x) as c_cur, lead(x) over (order by x) as next_x from (
      select wage_income as x, count(*) filter (order_ts < timestamp '1998-01-01') as n_ref,
        count(*) filter (order_ts >= timestamp '1998-01-01') as n_cur from a group by 1)))"""
    ),
)
def d5_same(spark, sf):
    return drift.column_drift(*_early_late(spark, sf), ["wage_income"])


SUMMARY = f"""
sm as (
  select count(*) as n_features, count(*) filter (drift_detected) as n_drifted,
    {r4("count(*) filter (drift_detected) / cast(count(*) as double)")} as drift_share,
    count(*) filter (drift_detected) / cast(count(*) as double) >= 5e-1 as dataset_drift from cd)"""


@query(
    "d6_drift_summary",
    scored_sql(
        """select *, drift_share > 2e-1 as alert, case when drift_share > 2e-1
  then 'Schedule retraining on fresh data' else 'No retraining required' end as action from sm""",
        VALUES + "," + SUMMARY,
    ),
)
def d6(spark, sf):
    return drift.drift_summary(_columns(spark, sf))


METRICS_SQL = """select 'DriftShare' as name, drift_share as value, 'None' as unit from sm
union all select 'DriftedFeatures', cast(n_drifted as double), 'Count' from sm
union all select 'DatasetDrift', cast(cast(dataset_drift as int) as double), 'None' from sm
union all select 'FeatureDrift_' || feature, cast(cast(drift_detected as int) as double), 'None' from cd"""


@query("d7_drift_metrics", scored_sql(METRICS_SQL, VALUES + "," + SUMMARY))
def d7(spark, sf):
    columns = _columns(spark, sf)
    return drift.drift_metrics(drift.drift_summary(columns), columns)


@query(
    "s9_metric_rows",
    scored_sql(
        f"""select 'Risk/Drift' as namespace, name, value, unit, '2024-01-01 06:00:00' as ts
from ({METRICS_SQL})""",
        VALUES + "," + SUMMARY,
    ),
)
def s9(spark, sf):
    path = new_path(spark, "metrics")
    tables.write_metrics(tables.metric_rows(d7(spark, sf), "Risk/Drift", RUN_TS), path)
    stored = spark.read.parquet(path)
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return stored.select("namespace", "name", "value", "unit", ts.alias("ts"))


@query("s11_report_table", scored_sql("select * from cd", VALUES))
def s11(spark, sf):
    target = tables.write_report(_columns(spark, sf), new_path(spark, "report"), "drift", RUN_TS)
    return spark.read.parquet(target)


def _yearly_js(year: int) -> str:
    parts = []
    for f in ("education", "marital_status", "class_of_worker"):
        value = f
        if year == 1999:
            value = f"case when {f} in ('1', 'F', 'BUILDING') then '?' else {f} end"
        parts.append(
            f"""select {year} as run, '{f}' as feature, sqrt(sum(case when p > 0 then p * ln(p / ((p + q) / 2)) / ln(2e0)
    else 0e0 end) / 2 + sum(case when q > 0 then q * ln(q / ((p + q) / 2)) / ln(2e0) else 0e0 end) / 2) as js
  from (select code, sum(r) / cast(sum(sum(r)) over () as double) as p,
      sum(c) / cast(sum(sum(c)) over () as double) as q from (
      select {f} as code, 1 as r, 0 as c from a where year(order_ts) < 1998
      union all select {value}, 0, 1 from a where year(order_ts) = {year}) group by 1)"""
        )
    return " union all ".join(parts)


@query(
    "d8_drift_spike",
    scored_sql(
        f"""select run, drift_share, step, case when step >= 5e-1 then 'check pipeline first'
  else 'as usual' end as advice from (
  select run, drift_share, {r4("drift_share - lag(drift_share) over (order by run)")} as step from (
    select run, {r4("count(*) filter (js >= 1e-1) / cast(count(*) as double)")} as drift_share
    from ({_yearly_js(1998)} union all {_yearly_js(1999)} union all {_yearly_js(2000)}) group by 1))"""
    ),
)
def d8(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    ref = scored.where("year(order_ts) < 1998")
    lost = {"education": "1", "marital_status": "F", "class_of_worker": "BUILDING"}
    runs = []
    for year in (1998, 1999, 2000):
        cur = scored.where(F.year("order_ts") == year)
        if year == 1999:
            cur = cur.withColumns(
                {c: F.when(F.col(c) == v, "?").otherwise(F.col(c)) for c, v in lost.items()}
            )
        found = drift.column_drift(ref, cur, CODES)
        runs.append(found.withColumn("run", F.lit(year)))
    summary = drift.drift_summary(reduce(DataFrame.unionAll, runs), ["run"])
    return drift.drift_spike(summary, "run")
