"""Queries of the group audit and its gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from equigauge.functions.scalar import round_half_up
from equigauge.operators import clean, fairness, metrics
from equigauge.plans import applicants as ap
from equigauge.plans.q_profile import RUN_CTE, auc_sql, run_metrics
from equigauge.plans.registry import query, r4, scored_sql

LABELS_SQL = ", ".join(
    f"('{dim}', '{code}', '{dim}: {text}')"
    for dim, labels in ap.DIMS.items()
    for code, text in labels.items()
)


def audit_cte(source: str, by: str = "", name: str = "audit") -> str:
    """The audit as SQL over ``source`` (score, pred, high_income, dims)."""
    key = f"{by}, " if by else ""
    over = f"partition by {by}" if by else ""
    return f"""
lb(dim, code, grp) as (values {LABELS_SQL}),
lo as (
  select {key}dim, code, score, pred, high_income from (
    select {key}score, pred, high_income, unnest(['race', 'sex', 'nativity']) as dim,
      unnest([race, sex, nativity]) as code from {source})),
lr as (
  select *, rank() over (partition by {key}dim, code order by score)
    + (count(*) over (partition by {key}dim, code, score) - 1) / 2e0 as rnk from lo),
lc as (
  select {key}dim, code, count(*) as n, cast(sum(high_income) as bigint) as pos,
    cast(sum(pred) as bigint) as said, cast(sum(pred * high_income) as bigint) as tp,
    sum(rnk) filter (high_income = 1) as rsum from lr group by all),
ov as (select {key}{r4("avg(cast(pred as double))")} as overall_ppr from {source} {f"group by {by}" if by else ""}),
au as (
  select {key}grp as "group", n, {r4("said / cast(n as double)")} as ppr,
    {r4("coalesce(tp / nullif(cast(said as double), 0), 0)")} as precision,
    {r4("coalesce(tp / nullif(cast(pos as double), 0), 0)")} as recall,
    {r4("coalesce(2 * tp / nullif(cast(said + pos as double), 0), 0)")} as f1,
    {r4("case when pos > 0 and pos < n then (rsum - cast(pos as double) * (pos + 1) / 2) / (cast(pos as double) * (n - pos)) end")} as auc_roc
  from lc join lb using (dim, code) where n >= 30),
{name} as (
  select *, {r4(f"abs(ppr - overall_ppr)")} as ppr_delta from au {"join ov using (" + by + ")" if by else "cross join ov"}),
{name}_f as (select * exclude (overall_ppr), ppr_delta > 2e-1 as flag from {name})"""


AUDIT = audit_cte("a")
RUN_AUDIT = "\nar as (select *, cast(year(order_ts) as int) as run from a)," + audit_cte("ar", "run")


def audit(spark, sf):
    return fairness.fairness_audit(ap.scored_applicants(spark, sf), ap.DIMS)


def run_audit(spark, sf):
    scored = ap.scored_applicants(spark, sf).withColumn("run", F.year("order_ts"))
    return fairness.fairness_audit(scored, ap.DIMS, ["run"])


@query("f1_fairness_audit", scored_sql("select * from audit_f", AUDIT))
def f1(spark, sf):
    return audit(spark, sf)


@query("f1_audit_by_run", scored_sql("select * from audit_f", RUN_AUDIT))
def f1_runs(spark, sf):
    return run_audit(spark, sf)


LANGUAGES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}


@query(
    "f1_audit_small_groups",
    f"""with d as (select lang, quality as high_income, n_chars / (n_chars + 2e3) as score,
    cast(n_chars / (n_chars + 2e3) >= 5e-1 as int) as pred
  from documents join labels using (doc_id)),
c as (
  select lang, count(*) as n, sum(high_income) as pos, sum(pred) as said, sum(pred * high_income) as tp
  from d group by 1),
u as (select lang, auc_roc from ({auc_sql("lang", "d")})),
o as (select {r4("avg(cast(pred as double))")} as overall from d)
select 'lang: ' || case lang when 'en' then 'English' when 'fr' then 'French' when 'de' then 'German'
    else 'Spanish' end as "group", n, {r4("said / cast(n as double)")} as ppr,
  {r4("coalesce(tp / nullif(cast(said as double), 0), 0)")} as precision,
  {r4("coalesce(tp / nullif(cast(pos as double), 0), 0)")} as recall,
  {r4("coalesce(2 * tp / nullif(cast(said + pos as double), 0), 0)")} as f1, auc_roc,
  {r4("abs(" + r4("said / cast(n as double)") + " - overall)")} as ppr_delta,
  {r4("abs(" + r4("said / cast(n as double)") + " - overall)")} > 2e-1 as flag
from c join u using (lang) cross join o where n >= 30""",
)
def f1_small(spark, sf):
    docs = ap.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    marks = ap.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("high_income"))
    score = F.col("n_chars") / (F.col("n_chars") + F.lit(2e3))
    scored = clean.classify(docs.join(marks, "doc_id").withColumn("score", score))
    return fairness.fairness_audit(scored, {"lang": LANGUAGES})


@query(
    "f2_ppr_delta",
    scored_sql("""select "group", ppr, ppr_delta, flag from audit_f""", AUDIT),
)
def f2(spark, sf):
    return audit(spark, sf).select("group", "ppr", "ppr_delta", "flag")


@query(
    "f3_fairness_gate",
    scored_sql(
        """select count(*) as groups, count(*) filter (flag) as flagged,
  coalesce(string_agg("group", '; ' order by "group") filter (flag), '') as failed_groups,
  case when count(*) = 0 then 'NOT EVALUABLE' when count(*) filter (flag) = 0 then 'PASSED'
    else 'FAILED' end as gate from audit_f""",
        AUDIT,
    ),
)
def f3(spark, sf):
    return fairness.fairness_gate(audit(spark, sf))


@query(
    "f4_auc_gate",
    scored_sql(
        """select run, auc_roc, 82e-2 as min_auc,
  case when auc_roc >= 82e-2 then 'PASSED' else 'FAILED' end as gate from rm""",
        RUN_CTE,
    ),
)
def f4(spark, sf):
    return fairness.auc_gate(run_metrics(spark, sf).select("run", "auc_roc"))


@query(
    "f5_flatten_audit",
    scored_sql(
        """select 'fairness/' || replace(lower(split_part("group", ': ', 2)), ' ', '_') || '/' || m as key, v as value
from (select "group", unnest(['ppr', 'ppr_delta', 'precision', 'recall', 'f1', 'auc_roc', 'n']) as m,
  unnest([ppr, ppr_delta, precision, recall, f1, auc_roc, cast(n as double)]) as v from audit_f)
where v is not null""",
        AUDIT,
    ),
)
def f5(spark, sf):
    return fairness.flatten_audit(audit(spark, sf))


@query(
    "f6_fairness_tiers",
    scored_sql(
        """select "group", ppr_delta, case when ppr_delta > 2e-1 then 'fail'
  when ppr_delta > 15e-2 then 'review' else 'ok' end as tier from audit_f""",
        AUDIT,
    ),
)
def f6(spark, sf):
    return fairness.fairness_tiers(audit(spark, sf)).select("group", "ppr_delta", "tier")


GAPS = f"""
gp as (
  select run, split_part("group", ': ', 1) as dim,
    first_value("group") over (w order by ppr desc, "group") as max_group, max(ppr) over (w) as max_ppr,
    first_value("group") over (w order by ppr, "group") as min_group, min(ppr) over (w) as min_ppr
  from audit_f where "group" <> 'race: Group C'
  window w as (partition by run, split_part("group", ': ', 1))),
gaps as (select distinct *, {r4("max_ppr - min_ppr")} as gap from gp)"""


@query("f7_group_gap", scored_sql("select * from gaps", RUN_AUDIT + "," + GAPS))
def f7(spark, sf):
    return fairness.group_gap(run_audit(spark, sf), ["race: Group C"], ["run"])


@query(
    "f8_gap_trend",
    scored_sql(
        """select run, dim, gap, gap_step, case when gap_step > 0 and before_step > 0 then 'block'
  when gap_step > 5e-2 then 'review' else 'ok' end as status
from (select *, lag(gap_step) over (partition by dim order by run) as before_step from st)""",
        RUN_AUDIT
        + ","
        + GAPS
        + f""",
st as (select run, dim, gap, {r4("gap - lag(gap) over (partition by dim order by run)")} as gap_step from gaps)""",
    ),
)
def f8(spark, sf):
    gaps = fairness.group_gap(run_audit(spark, sf), ["race: Group C"], ["run"])
    return fairness.gap_trend(gaps, "run")


@query(
    "f9_ppr_shift",
    scored_sql(
        f"""select c."group", c.ppr as current, b.ppr as base, {r4("c.ppr - b.ppr")} as change,
  abs({r4("c.ppr - b.ppr")}) > 1e-1 as rollback_signal
from audit_f c join audit_f b on c."group" = b."group" and c.run = 2000 and b.run = 1999""",
        RUN_AUDIT,
    ),
)
def f9(spark, sf):
    runs = run_audit(spark, sf)
    return fairness.ppr_shift(runs.where("run = 2000"), runs.where("run = 1999"))


@query(
    "j6_compare_runs",
    scored_sql(
        f"""select c."group", c.auc_roc as current, b.auc_roc as base, {r4("c.auc_roc - b.auc_roc")} as change
from audit_f c join audit_f b on c."group" = b."group" and c.run = 2000 and b.run = 1996""",
        RUN_AUDIT,
    ),
)
def j6(spark, sf):
    runs = run_audit(spark, sf)
    return fairness.compare_runs(
        runs.where("run = 2000"), runs.where("run = 1996"), ["group"], "auc_roc"
    )


@query(
    "f10_audit_coverage",
    scored_sql(
        """select 'race' as dim, count(*) as rows, count(*) filter (race <> '5') as audited,
  cast(0 as bigint) as in_small_groups, count(*) filter (race = '5') as without_label from a
union all select 'sex', count(*), count(*), cast(0 as bigint), cast(0 as bigint) from a
union all select 'nativity', count(*), count(*), cast(0 as bigint), cast(0 as bigint) from a"""
    ),
)
def f10(spark, sf):
    return fairness.audit_coverage(ap.scored_applicants(spark, sf), ap.DIMS)


@query(
    "f11_retraining_triggers",
    scored_sql(
        f"""select trigger, {r4("value")} as value, threshold, fires from (
  select 'auc' as trigger, auc as value, 82e-2 as threshold, auc < 82e-2 as fires from v
  union all select 'ppr_delta', delta, 15e-2, delta > 15e-2 from v
  union all select 'data_age_days', age, 365e0, age > 365 from v
  union all select 'feature_drift', drift, 2e-1, drift > 2e-1 from v)""",
        RUN_CTE
        + ","
        + AUDIT
        + """,
v as (select (select auc_roc from rm where run = 2001) as auc, (select max(ppr_delta) from audit) as delta,
  (select cast(date_diff('day', max(cast(order_ts as date)), date '2002-01-01') as double) from a) as age,
  (select avg(case when s > 2e-2 then 1e0 else 0e0 end) from (
    select abs(avg(cast(pred as double)) - (select avg(cast(pred as double)) from a)) as s
    from a group by year(order_ts))) as drift)""",
    ),
)
def f11(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    by_year = scored.groupBy(F.year("order_ts").alias("y")).agg(
        F.avg(F.col("pred").cast("double")).alias("rate")
    )
    rate = scored.agg(F.avg(F.col("pred").cast("double"))).scalar()
    moved = F.when(F.abs(F.col("rate") - rate) > F.lit(2e-2), F.lit(1e0)).otherwise(F.lit(0e0))
    last = metrics.overall_metrics(scored.where("year(order_ts) = 2001"))
    age = F.datediff(F.lit("2002-01-01").cast("date"), F.max("order_ts").cast("date"))
    row = scored.agg(age.alias("age")).select(
        "age",
        by_year.agg(F.avg(moved)).scalar().alias("drift"),
        last.select("auc_roc").scalar().alias("auc"),
        audit(spark, sf).agg(F.max("ppr_delta")).scalar().alias("delta"),
    )
    found = fairness.retraining_triggers(
        F.col("drift"), F.col("auc"), F.col("delta"), F.col("age"), row
    )
    return found.withColumn("value", round_half_up("value"))


@query("u1_union_dimensions", scored_sql("""select "group", n, ppr from audit_f""", AUDIT))
def u1(spark, sf):
    return audit(spark, sf).select("group", "n", "ppr")
