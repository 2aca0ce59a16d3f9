"""Queries of the profiles, encoders, classification metrics and running sums."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from equigauge.functions.scalar import round_half_up
from equigauge.operators import encode, metrics, prefix, profile, profiles, split
from equigauge.plans import applicants as ap
from equigauge.plans.q_tables import CODES_SQL, _early_late, _split, _stored_split
from equigauge.plans.registry import query, r4, raw_sql, scored_sql, split_sql
from equigauge.roles import ROLES
from equigauge.session import new_path
from equigauge.sources.tables import write_snapshot


def _rounded(df, *columns):
    """Sums of doubles depend on their order in the last digits."""
    return df.withColumns({c: round_half_up(c) for c in columns})


@query(
    "a1_class_balance",
    scored_sql(
        f"""select count(*) as rows, cast(sum(high_income) as bigint) as positives,
  cast(count(*) - sum(high_income) as bigint) as negatives,
  {r4("sum(high_income) / cast(count(*) as double)")} as positive_rate,
  {r4("(count(*) - sum(high_income)) / cast(sum(high_income) as double)")} as imbalance_ratio,
  not (sum(high_income) / cast(count(*) as double) between 3e-1 and 7e-1) as imbalanced from a"""
    ),
)
def a1(spark, sf):
    return profile.class_balance(ap.scored_applicants(spark, sf))


@query(
    "a2_value_shares",
    scored_sql(
        """select high_income, count(*) as n,
  count(*) / cast(sum(count(*)) over () as double) as share from a group by 1"""
    ),
)
def a2(spark, sf):
    return profile.value_shares(ap.scored_applicants(spark, sf), "high_income")


def _describe_sql(column: str) -> str:
    c = f"cast({column} as double)"
    return f"""select '{column}' as feature, count({c}) as count, {r4(f"avg({c})")} as mean,
  {r4(f"stddev_samp({c})")} as std, min({c}) as min, {r4(f"quantile_cont({c}, 25e-2)")} as q25,
  {r4(f"quantile_cont({c}, 5e-1)")} as q50, {r4(f"quantile_cont({c}, 75e-2)")} as q75,
  max({c}) as max from a"""


@query(
    "a3_describe",
    scored_sql(" union all ".join(_describe_sql(c) for c in ("age", "hours_per_week", "wage_income"))),
)
def a3(spark, sf):
    out = profile.describe(ap.scored_applicants(spark, sf), ["age", "hours_per_week", "wage_income"])
    return _rounded(out, "mean", "std", "q25", "q50", "q75")


@query(
    "a4_null_counts",
    raw_sql(
        """select 'hours_per_week' as feature, count(*) filter (hours_per_week is null) as nulls from raw
union all select 'age', count(*) filter (age is null) from raw
union all select 'occupation', count(*) filter (occupation is null) from raw"""
    ),
)
def a4(spark, sf):
    return profile.null_counts(
        ap.raw_applicants(spark, sf), ["hours_per_week", "age", "occupation"]
    )


@query(
    "a5_range_stats",
    f"""select min(o_totalprice) as min, max(o_totalprice) as max,
  {r4("avg(o_totalprice)")} as mean from orders""",
)
def a5(spark, sf):
    return _rounded(profile.range_stats(ap.table(spark, sf, "orders"), "o_totalprice"), "mean")


COUNTED = """
counted as (
  select feature, code, count(*) as n from (
    select unnest(['education', 'occupation', 'class_of_worker', 'marital_status']) as feature,
      unnest([education, occupation, class_of_worker, marital_status]) as code from raw)
  where code is not null group by 1, 2)"""


@query(
    "a6_modes",
    raw_sql(
        """select feature, code, n from (select *, row_number() over (
  partition by feature order by n desc, code) as r from counted) where r = 1""",
        COUNTED,
    ),
)
def a6(spark, sf):
    counts = encode.code_counts(ap.raw_applicants(spark, sf), ROLES.categorical)
    return encode.modes(counts)


def _with_gaps(spark, sf):
    """Records whose education is missing where no line item gives hours."""
    raw = ap.raw_applicants(spark, sf)
    known = F.when(F.col("hours_per_week").isNotNull(), F.col("education"))
    return raw.withColumn("education", known)


@query(
    "a6_mode_fill",
    raw_sql(
        """select person_id, coalesce(education, (select education from g where education is not null
  group by 1 order by count(*) desc, education limit 1)) as education from g""",
        """
g as (select person_id, case when hours_per_week is not null then education end as education from raw)""",
    ),
)
def a6_fill(spark, sf):
    filled = encode.mode_fill(_with_gaps(spark, sf), ["education"])
    return filled.select("person_id", "education")


@query(
    "a7_fit_codes",
    raw_sql(
        """select feature, code, cast(row_number() over (partition by feature order by code) - 1 as int)
  as idx from counted""",
        COUNTED,
    ),
)
def a7(spark, sf):
    return encode.fit_codes(ap.raw_applicants(spark, sf), ROLES.categorical)


@query(
    "a7_ranked_names",
    """select 'c_name' as feature, c_name as code,
  cast(row_number() over (order by c_name) - 1 as int) as idx from (select distinct c_name from customer)""",
)
def a7_ranges(spark, sf):
    """The way a code list takes that is too long for one sort."""
    return encode.fit_codes(ap.table(spark, sf, "customer"), ["c_name"], max_rows=0)


def _stats_sql(column: str) -> str:
    return f"""select '{column}' as feature, {r4(f"avg(cast({column} as double))")} as mean,
  {r4(f"stddev_pop(cast({column} as double))")} as std_pop from a"""


@query(
    "a8_fit_scaler",
    scored_sql(_stats_sql("age") + " union all " + _stats_sql("hours_per_week")),
)
def a8(spark, sf):
    stats = encode.fit_scaler(ap.scored_applicants(spark, sf), ["age", "hours_per_week"])
    return _rounded(stats, "mean", "std_pop")


@query(
    "a9_scale",
    scored_sql(
        f"""select person_id, {r4("(age - (select avg(age) from a)) / (select stddev_pop(age) from a)")} as age,
  {r4("(hours_per_week - (select avg(hours_per_week) from a)) / (select stddev_pop(hours_per_week) from a)")}
  as hours_per_week from a"""
    ),
)
def a9(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    stats = encode.fit_scaler(scored, ["age", "hours_per_week"])
    scaled = encode.scale(scored, stats, ["age", "hours_per_week"])
    return _rounded(
        scaled.select("person_id", "age", "hours_per_week"), "age", "hours_per_week"
    )


@query(
    "a10_missing_report",
    raw_sql(
        """select feature, cells, missing, missing / cast(cells as double) as share from (
  select 'age' as feature, count(*) as cells, count(*) filter (age is null) as missing from raw
  union all select 'hours_per_week', count(*), count(*) filter (hours_per_week is null) from raw
  union all select '*', 2 * count(*), count(*) filter (age is null)
    + count(*) filter (hours_per_week is null) from raw)"""
    ),
)
def a10(spark, sf):
    return profile.missing_report(ap.raw_applicants(spark, sf), ["age", "hours_per_week"])


def _most_common_sql(column: str, numeric: bool) -> str:
    text = f"cast(cast({column} as bigint) as varchar)" if numeric else column
    return f"""select side, '{column}' as feature, v as most_common, n as most_common_n from (
  select side, {text} as v, count(*) as n, row_number() over (
    partition by side order by count(*) desc, {text}) as r
  from two_sides where {column} is not null group by 1, 2) where r = 1"""


def _quality_plain_sql(column: str, numeric: bool) -> str:
    x = f"cast({column} as double)" if numeric else "cast(null as double)"
    return f"""select side, '{column}' as feature, count(*) as rows,
  count(*) filter ({column} is null) as missing, min({x}) as min, max({x}) as max,
  {r4(f"avg({x})")} as mean, {r4(f"stddev_samp({x})")} as std,
  count(distinct {column}) as "distinct", {r4(f"quantile_cont({x}, 25e-2)")} as q25,
  {r4(f"quantile_cont({x}, 5e-1)")} as q50, {r4(f"quantile_cont({x}, 75e-2)")} as q75
  from two_sides group by side"""


QUALITY_COLUMNS = (("age", True), ("hours_per_week", True), ("education", False))


@query(
    "a11_quality_report",
    scored_sql(
        f"""select q.*, c.most_common, c.most_common_n
from ({" union all ".join(_quality_plain_sql(*c) for c in QUALITY_COLUMNS)}) q
join ({" union all ".join(_most_common_sql(*c) for c in QUALITY_COLUMNS)}) c
  on q.side = c.side and q.feature = c.feature""",
        """
two_sides as (select case when order_ts < timestamp '1998-01-01' then 'reference' else 'current' end as side,
  age, hours_per_week, education from a)""",
    ),
)
def a11(spark, sf):
    ref, cur = _early_late(spark, sf)
    report = profile.quality_report(ref, cur, [c for c, _ in QUALITY_COLUMNS])
    return _rounded(report, "mean", "std", "q25", "q50", "q75")


@query(
    "a11_quality_sketch",
)
def a11_sketch(spark, sf):
    ref, cur = _early_late(spark, sf)
    return profile.quality_report(ref, cur, [c for c, _ in QUALITY_COLUMNS], exact=False)


@query(
    "a11_merged_profiles",
    scored_sql(
        """select feature, rows, missing, min, max, mean, std, distinct_ok, median_ok from ("""
        + " union all ".join(
            f"""select '{c}' as feature, count(*) as rows, count(*) filter ({c} is null) as missing,
  {"min(cast(%s as double))" % c if numeric else "cast(null as double)"} as min,
  {"max(cast(%s as double))" % c if numeric else "cast(null as double)"} as max,
  {r4("avg(%s)" % c) if numeric else "cast(null as double)"} as mean,
  {r4("stddev_samp(%s)" % c) if numeric else "cast(null as double)"} as std,
  true as distinct_ok, {"true" if numeric else "cast(null as boolean)"} as median_ok from a"""
            for c, numeric in QUALITY_COLUMNS
        )
        + ")"
    ),
)
def a11_merged(spark, sf):
    """Profiles of each year of orders, stored and merged; sketches held against the rows by their stated errors."""
    path = new_path(spark, "profiles")
    scored = ap.scored_applicants(spark, sf)
    columns = [c for c, _ in QUALITY_COLUMNS]
    yearly = profiles.build(scored.withColumn("year", F.year("order_ts")), columns, ["year"])
    write_snapshot(yearly.coalesce(1), path, date(2024, 1, 1))
    merged = profiles.report(profiles.merge(profiles.read(spark, path)))
    medians = {r.feature: r.q50 for r in merged.select("feature", "q50").collect()}
    checks = []
    for c, numeric in QUALITY_COLUMNS:
        n, middle = F.count(c), F.lit(medians[c])
        off = profiles.QUANTILE_ERROR * n
        fits = (F.count_if(F.col(c) < middle) - off <= n / 2) & (F.count_if(F.col(c) <= middle) + off >= n / 2)
        median_ok = fits if numeric else F.lit(None).cast("boolean")
        checks.append(F.struct(F.lit(c).alias("feature"), F.count_distinct(c).alias("d"), median_ok.alias("median_ok")))
    held = scored.agg(F.array(*checks).alias("c")).select(F.explode("c").alias("c")).select("c.*")
    near = F.abs(F.col("distinct") - F.col("d")) <= F.greatest(F.lit(1.0), 4 * profiles.DISTINCT_ERROR * F.col("d"))
    out = merged.join(held, "feature").withColumn("distinct_ok", near)
    return _rounded(out, "mean", "std").select("feature", "rows", "missing", "min", "max", "mean", "std", "distinct_ok", "median_ok")


@query(
    "l12_preprocess",
    split_sql(
        f"""select t.person_id, {r4("(t.age - m.ma) / m.sa")} as age, e.idx as education, o.idx as occupation,
  {r4("(t.hours_per_week - m.mh) / m.sh")} as hours_per_week, w.idx as class_of_worker,
  s.idx as marital_status, t.person_weight, t.high_income
from sp t cross join (select avg(age) as ma, stddev_pop(age) as sa, avg(hours_per_week) as mh,
    stddev_pop(hours_per_week) as sh from sp where not is_test) m
join codes e on e.feature = 'education' and e.code = t.education
join codes o on o.feature = 'occupation' and o.code = t.occupation
join codes w on w.feature = 'class_of_worker' and w.code = t.class_of_worker
join codes s on s.feature = 'marital_status' and s.code = t.marital_status""",
        CODES_SQL,
    ),
)
def l12(spark, sf):
    tagged = _stored_split(spark, sf)
    model = encode.Preprocessor().fit(tagged.where("not is_test"))
    return _rounded(model.transform(tagged), "age", "hours_per_week")


# --- metrics ---------------------------------------------------------------------------

COUNTS_SQL = """
c as (
  select race, count(*) filter (high_income = 1 and pred = 1) as tp,
    count(*) filter (high_income = 0 and pred = 1) as fp,
    count(*) filter (high_income = 1 and pred = 0) as fn,
    count(*) filter (high_income = 0 and pred = 0) as tn from a group by 1)"""


@query("m1_confusion", scored_sql("select race, tp, fp, fn, tn from c", COUNTS_SQL))
def m1(spark, sf):
    return metrics.confusion(ap.scored_applicants(spark, sf), ["race"])


@query(
    "m2_prf",
    scored_sql(
        f"""select race, {r4("coalesce(tp / nullif(cast(tp + fp as double), 0), 0)")} as precision,
  {r4("coalesce(tp / nullif(cast(tp + fn as double), 0), 0)")} as recall,
  {r4("coalesce(2 * tp / nullif(cast(2 * tp + fp + fn as double), 0), 0)")} as f1 from c""",
        COUNTS_SQL,
    ),
)
def m2(spark, sf):
    return metrics.prf(ap.scored_applicants(spark, sf), ["race"])


def auc_sql(group: str, source: str = "a") -> str:
    """Rank form of the AUC, ties by average rank."""
    over = f"partition by {group} order by score" if group else "order by score"
    key = f"{group}, " if group else ""
    grouped = f"group by {group}" if group else ""
    return f"""select {key}count(*) as n, cast(sum(high_income) as bigint) as pos,
  {r4("case when sum(high_income) > 0 and sum(high_income) < count(*) then (sum(rnk) filter (high_income = 1) - cast(sum(high_income) as double) * (sum(high_income) + 1) / 2) / (cast(sum(high_income) as double) * (count(*) - sum(high_income))) end")} as auc_roc
from (select *, rank() over ({over}) + (count(*) over (
  {f"partition by {group}, score" if group else "partition by score"}) - 1) / 2e0 as rnk from {source}) {grouped}"""


@query("m3_auc_roc", scored_sql(auc_sql("")))
def m3(spark, sf):
    return metrics.auc_roc(ap.scored_applicants(spark, sf))


@query("m3_auc_by_group", scored_sql(auc_sql("occupation")))
def m3_group(spark, sf):
    return metrics.auc_roc(ap.scored_applicants(spark, sf), ["occupation"])


def _doc_scores(spark, sf):
    """Quality label of documents with a coarse score: long ties."""
    docs = ap.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    marks = ap.table(spark, sf, "labels").select("doc_id", F.col("quality").alias("high_income"))
    score = F.floor(F.col("n_chars") / 1000).cast("double")
    return docs.join(marks, "doc_id").withColumn("score", score)


@query(
    "m3_auc_tied_scores",
    "with d as (select lang, quality as high_income, floor(n_chars / 1000) as score "
    "from documents join labels using (doc_id))\n" + auc_sql("lang", "d"),
)
def m3_tied(spark, sf):
    return metrics.auc_roc(_doc_scores(spark, sf), ["lang"])


@query(
    "m4_class_report",
    scored_sql(
        f"""select row, {r4("p")} as precision, {r4("r")} as recall, {r4("f")} as f1, s as support from (
  select '0' as row, p0 as p, r0 as r, f0 as f, s0 as s from q
  union all select '1', p1, r1, f1, s1 from q
  union all select 'accuracy', (tp + tn) / t, (tp + tn) / t, (tp + tn) / t, s0 + s1 from q
  union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 from q
  union all select 'weighted avg', (p0 * s0 + p1 * s1) / t, (r0 * s0 + r1 * s1) / t,
    (f0 * s0 + f1 * s1) / t, s0 + s1 from q)""",
        """
k as (
  select count(*) filter (high_income = 1 and pred = 1) as tp,
    count(*) filter (high_income = 0 and pred = 1) as fp,
    count(*) filter (high_income = 1 and pred = 0) as fn,
    count(*) filter (high_income = 0 and pred = 0) as tn from a),
q as (
  select tp, tn, tp / cast(tp + fp as double) as p1, tp / cast(tp + fn as double) as r1,
    2 * tp / cast(2 * tp + fp + fn as double) as f1, tp + fn as s1,
    tn / cast(tn + fn as double) as p0, tn / cast(tn + fp as double) as r0,
    2 * tn / cast(2 * tn + fp + fn as double) as f0, tn + fp as s0,
    cast(tp + fp + fn + tn as double) as t from k)""",
    ),
)
def m4(spark, sf):
    return metrics.class_report(ap.scored_applicants(spark, sf))


@query(
    "m5_ppr",
    scored_sql(f"select race, sex, count(*) as n, {r4('avg(cast(pred as double))')} as ppr from a group by 1, 2"),
)
def m5(spark, sf):
    return metrics.ppr(ap.scored_applicants(spark, sf), ["race", "sex"])


def run_metrics(spark, sf):
    """Overall metrics of yearly runs."""
    scored = ap.scored_applicants(spark, sf)
    return metrics.overall_metrics(scored.withColumn("run", F.year("order_ts")), ["run"])


RUN_CTE = f"""
ar as (select *, cast(year(order_ts) as int) as run from a),
rk as (select *, rank() over (partition by run order by score)
  + (count(*) over (partition by run, score) - 1) / 2e0 as rnk from ar),
rc as (
  select run, count(*) as n, cast(sum(high_income) as bigint) as pos, cast(sum(pred) as bigint) as said,
    cast(sum(pred * high_income) as bigint) as tp, sum(rnk) filter (high_income = 1) as rsum from rk group by 1),
rm as (
  select run, n, {r4("(rsum - cast(pos as double) * (pos + 1) / 2) / (cast(pos as double) * (n - pos))")} as auc_roc,
    {r4("tp / cast(said as double)")} as precision, {r4("tp / cast(pos as double)")} as recall,
    {r4("2 * tp / cast(said + pos as double)")} as f1, {r4("said / cast(n as double)")} as overall_ppr
  from rc)"""


@query("m_overall_by_run", scored_sql("select * from rm", RUN_CTE))
def m_overall(spark, sf):
    return run_metrics(spark, sf)


@query(
    "m6_progression",
    scored_sql(
        f"""select run, auc_roc, f1, {r4("auc_roc - lag(auc_roc) over (order by run)")} as auc_roc_delta,
  {r4("auc_roc - first_value(auc_roc) over (order by run)")} as auc_roc_delta_first,
  {r4("f1 - lag(f1) over (order by run)")} as f1_delta,
  {r4("f1 - first_value(f1) over (order by run)")} as f1_delta_first from rm""",
        RUN_CTE,
    ),
)
def m6(spark, sf):
    return metrics.progression(run_metrics(spark, sf), "run")


@query(
    "w3_with_previous",
    scored_sql(
        """select run, overall_ppr, lag(overall_ppr) over (order by run) as overall_ppr_previous,
  first_value(overall_ppr) over (order by run) as overall_ppr_first from rm""",
        RUN_CTE,
    ),
)
def w3(spark, sf):
    runs = run_metrics(spark, sf).select("run", "overall_ppr")
    return metrics.with_previous(runs, "run", ["overall_ppr"])


# --- running sums and ranks ----------------------------------------------------------------


@query(
    "w1_rank_in_class",
    split_sql("select person_id, high_income, rnk as rank from sp"),
)
def w1(spark, sf):
    scored = ap.scored_applicants(spark, sf).select("person_id", "high_income")
    return split.rank_in_class(scored, "high_income", "person_id", 42).withColumn(
        "rank", F.col("rank").cast("long")
    )


@query(
    "w2_prefix_sum",
    """select o_orderstatus, o_totalprice, count(*) as n,
  cast(sum(count(*)) over (partition by o_orderstatus order by o_totalprice) - count(*) as bigint) as n_before
from orders group by 1, 2""",
)
def w2(spark, sf):
    orders = ap.table(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    return prefix.running_counts(orders, ["o_orderstatus"], "o_totalprice")


@query(
    "w2_exact_quantiles",
    "select l_returnflag, p, "
    + r4(
        "case p when 1e-2 then quantile_cont(l_extendedprice, 1e-2) "
        "when 5e-1 then quantile_cont(l_extendedprice, 5e-1) "
        "else quantile_cont(l_extendedprice, 99e-2) end"
    )
    + " as value from lineitem, (values (1e-2), (5e-1), (99e-2)) t(p) group by 1, 2",
)
def w2_quantiles(spark, sf):
    items = ap.table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    found = prefix.quantiles(items, ["l_returnflag"], "l_extendedprice", [0.01, 0.5, 0.99])
    return _rounded(found, "value")


@query(
    "l1_stratified_split",
    split_sql("select person_id, high_income, is_test from sp"),
)
def l1(spark, sf):
    return _split(spark, sf).select("person_id", "high_income", "is_test")


@query(
    "l2_stratified_folds",
    split_sql(
        """select person_id, high_income, cast((rnk > floor(2e-1 * class_n + 5e-1)) as int)
  + cast((rnk > floor(4e-1 * class_n + 5e-1)) as int) + cast((rnk > floor(6e-1 * class_n + 5e-1)) as int)
  + cast((rnk > floor(8e-1 * class_n + 5e-1)) as int) as fold from sp"""
    ),
)
def l2(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    return split.stratified_folds(scored, ROLES.label, ROLES.key).select(
        "person_id", "high_income", "fold"
    )
