"""Queries of the sources, row rules and joins."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from equigauge.functions.scalar import round_half_up, slug
from equigauge.operators import clean, encode, joins, models, profile, runs, split
from equigauge.plans import applicants as ap
from equigauge.plans.registry import query, r4, raw_sql, scored_sql, split_sql
from equigauge.roles import ROLES
from equigauge.session import new_path
from equigauge.sources import matrix, tables

RUN_TS = datetime(2024, 1, 1, 6, 0, 0)
MATRIX_CODES = ("ID", "AGEP", "WAGP", "OCCP", "WKHP", "state")


def _matrix_docs(spark, sf):
    """Records as header-first JSON matrices of at most 1,000 records each."""
    raw = ap.raw_applicants(spark, sf)
    cells = [
        F.col("person_id").cast("string"),
        F.when(F.col("age") < 3, "n/a").otherwise(F.col("age").cast("string")),
        F.col("wage_income").cast("string"),
        "occupation",
        F.col("hours_per_week").cast("string"),
        "race",
    ]
    chunk = F.floor(F.col("person_id") / 1000)
    grouped = raw.select(chunk.alias("chunk"), F.array(*cells).alias("r")).groupBy("chunk")
    header = F.array(*[F.lit(c) for c in MATRIX_CODES])
    doc = F.to_json(F.concat(F.array(header), F.collect_list("r")))
    return grouped.agg(doc.alias("value"))


def _matrix_rows(spark, sf):
    return matrix.parse_matrix(_matrix_docs(spark, sf), "value", MATRIX_CODES).drop("row_no")


@query(
    "s1_json_matrix",
    raw_sql(
        """select cast(person_id as varchar) as "ID",
  case when age < 3 then 'n/a' else cast(age as varchar) end as "AGEP",
  cast(wage_income as varchar) as "WAGP", occupation as "OCCP",
  cast(hours_per_week as varchar) as "WKHP", race as state from raw"""
    ),
)
def s1(spark, sf):
    return _matrix_rows(spark, sf)


@query(
    "s2_scope",
    raw_sql("select person_id, occupation, wage_income from raw where occupation = '0100'"),
)
def s2(spark, sf):
    rows = matrix.scope(ap.raw_applicants(spark, sf), "0100", "occupation")
    return rows.select("person_id", "occupation", "wage_income")


def _snapshots(spark, sf):
    path = new_path(spark, "snapshots")
    raw = ap.raw_applicants(spark, sf).select("person_id", "wage_income", "race", "order_ts")
    early = raw.where("order_ts < timestamp'1998-01-01'").drop("order_ts")
    late = raw.where("order_ts >= timestamp'1998-01-01'").drop("order_ts")
    tables.write_snapshot(early, path, date(2024, 1, 1), ["race"])
    tables.write_snapshot(early, path, date(2024, 1, 2), ["race"])
    tables.write_snapshot(late, path, date(2024, 1, 2), ["race"])
    return path


@query(
    "s3_snapshot_rerun",
    raw_sql(
        """select case when order_ts < timestamp '1998-01-01' then '2024-01-01' else '2024-01-02' end
    as snapshot_date, race, count(*) as n from raw group by 1, 2"""
    ),
)
def s3(spark, sf):
    stored = spark.read.parquet(_snapshots(spark, sf))
    return stored.groupBy(
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.col("race").cast("string").alias("race"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "s4_read_latest",
    raw_sql("select person_id, wage_income from raw where order_ts >= timestamp '1998-01-01'"),
)
def s4(spark, sf):
    latest = tables.read_latest(spark, _snapshots(spark, sf))
    return latest.select("person_id", "wage_income")


def _split(spark, sf):
    return split.stratified_split(ap.scored_applicants(spark, sf), ROLES.label, ROLES.key)


_split_paths: dict[tuple[str, str], str] = {}


def _stored_split(spark, sf):
    """The split table, written once per session for the steps that fit on it."""
    key = (spark.sparkContext.applicationId, sf)
    tagged = _split(spark, sf) if key not in _split_paths else None
    if tagged is not None:
        _split_paths[key] = new_path(spark, "split")
        tagged.write.parquet(_split_paths[key])
    schema = ap.SCORED_SCHEMA + ", is_test boolean"
    return spark.read.schema(schema).parquet(_split_paths[key])


def _stored_splits(spark, sf):
    path, secret = new_path(spark, "splits"), new_path(spark, "sensitive")
    tables.write_splits(_split(spark, sf), path, secret)
    return path, secret


@query(
    "s5_write_splits",
    split_sql("select person_id, race, sex, nativity, high_income, is_test from sp"),
)
def s5(spark, sf):
    stored = spark.read.parquet(_stored_splits(spark, sf)[1])
    return stored.select("person_id", "race", "sex", "nativity", "high_income", F.col("is_test").cast("boolean").alias("is_test"))


@query(
    "s6_read_splits",
    split_sql(
        """select person_id, age, education, occupation, hours_per_week, class_of_worker,
  marital_status, high_income from sp where is_test"""
    ),
)
def s6(spark, sf):
    features, labels = tables.read_splits(spark, _stored_splits(spark, sf)[0], test=True)
    return features.join(labels, ROLES.key)


CODES_SQL = """
codes as (
  select feature, code, cast(row_number() over (partition by feature order by code) - 1 as int) as idx
  from (select distinct unnest(['education', 'occupation', 'class_of_worker', 'marital_status']) as feature,
    unnest([education, occupation, class_of_worker, marital_status]) as code from sp where not is_test)),
fills as (
  select feature, code, row_number() over (partition by feature order by n desc, code) as r
  from (select feature, code, count(*) as n from (
    select unnest(['education', 'occupation', 'class_of_worker', 'marital_status']) as feature,
      unnest([education, occupation, class_of_worker, marital_status]) as code from sp where not is_test)
    group by 1, 2))"""


@query(
    "s7_prep_roundtrip",
    split_sql(
        """select c.feature, c.code, c.idx, coalesce(f.r = 1, false) as is_fill
from codes c left join fills f on c.feature = f.feature and c.code = f.code and f.r = 1""",
        CODES_SQL,
    ),
)
def s7(spark, sf):
    path = new_path(spark, "prep")
    train = _stored_split(spark, sf).where("not is_test")
    encode.save_prep(encode.Preprocessor().fit(train), path)
    return encode.load_prep(path).codes


@query(
    "s8_csv_lines",
    raw_sql(
        """select person_id, concat_ws(',', cast(age as varchar), education, occupation,
  coalesce(cast(hours_per_week as varchar), 'nan'), class_of_worker, marital_status) as line
from raw"""
    ),
)
def s8(spark, sf):
    return tables.to_csv_lines(ap.raw_applicants(spark, sf), ROLES.feature_order)


RUN_METRICS_SQL = f"""
m as (
  select 'run-' || cast(year(order_ts) as varchar) as run_id, year(order_ts) as y,
    count(*) as n, sum(pred) as said, sum(high_income) as pos, sum(pred * high_income) as tp
  from a group by 1, 2),
mm as (
  select run_id, y, {r4("cast(tp as double) / said")} as prec,
    {r4("cast(tp as double) / pos")} as rec, {r4("cast(said as double) / n")} as ppr from m)"""


def _run_metrics(spark, sf):
    """Metrics of yearly runs of the scored table."""
    scored = ap.scored_applicants(spark, sf)
    said, pos = F.sum("pred"), F.sum("high_income")
    tp = F.sum(F.col("pred") * F.col("high_income"))
    return scored.groupBy(F.year("order_ts").alias("y")).agg(
        round_half_up(tp.cast("double") / said).alias("precision"),
        round_half_up(tp.cast("double") / pos).alias("recall"),
        round_half_up(said.cast("double") / F.count(F.lit(1))).alias("ppr"),
    )


@query(
    "s10_run_log",
    scored_sql(
        """select run_id, cast(row_number() over (order by y) as int) as version, 'precision' as key,
  prec as value from mm
union all select run_id, cast(row_number() over (order by y) as int), 'recall', rec from mm
union all select run_id, cast(row_number() over (order by y) as int), 'ppr', ppr from mm""",
        RUN_METRICS_SQL,
    ),
)
def s10(spark, sf):
    per_run = _run_metrics(spark, sf).withColumn("model", F.lit("risk"))
    run_id = F.concat(F.lit("run-"), F.col("y").cast("string"))
    numbered = runs.assign_versions(per_run.withColumn("run_id", run_id), "model", ["y"])
    return runs.wide_to_log(numbered, ["run_id", "version"], ["precision", "recall", "ppr"])


@query(
    "s10_logged_run",
    scored_sql(
        f"""select 'risk' as model, 2 as version, 'staging' as alias, key, value from (
  select 'overall_ppr' as key, {r4("avg(cast(pred as double))")} as value from a
  union all select 'rows', cast(count(*) as double) from a)"""
    ),
)
def s10_logged(spark, sf):
    path = new_path(spark, "runlog")
    scored = ap.scored_applicants(spark, sf)
    metrics = scored.agg(
        round_half_up(F.avg(F.col("pred").cast("double"))).alias("overall_ppr"),
        F.count(F.lit(1)).cast("double").alias("rows"),
    ).unpivot([], ["overall_ppr", "rows"], "key", "value")
    for i in (1, 2):
        runs.log_run(
            spark, path, f"run-{i}", "risk", RUN_TS, {"stage": "test"}, {"cut": 0.5}, metrics
        )
        runs.set_alias(spark, path, "risk", "staging", i, RUN_TS)
    named = runs.current_aliases(runs.read_log(spark, path, "aliases"))
    log = runs.read_log(spark, path, "metrics")
    return log.join(named, ["model", "version"]).select("model", "version", "alias", "key", "value")


# --- row rules ---------------------------------------------------------------------


@query(
    "p1_rename",
    'select o_orderkey as person_id, o_totalprice as wage_income, o_orderstatus as marital_status from orders',
)
def p1(spark, sf):
    names = {
        "o_orderkey": "person_id",
        "o_totalprice": "wage_income",
        "o_orderstatus": "marital_status",
        "o_missing": "ignored",
    }
    renamed = clean.rename_present(ap.table(spark, sf, "orders"), names)
    return renamed.select("person_id", "wage_income", "marital_status")


@query(
    "p2_drop",
    "select o_orderkey, o_custkey, o_totalprice from orders",
)
def p2(spark, sf):
    gone = ["o_orderstatus", "o_orderdate", "o_orderpriority", "state"]
    return clean.drop_present(ap.table(spark, sf, "orders"), gone)


@query(
    "p3_coerce_numeric",
    raw_sql(
        """select person_id as "ID", case when age < 3 then null else cast(age as double) end as age,
  wage_income, hours_per_week from raw"""
    ),
)
def p3(spark, sf):
    rows = clean.rename_present(
        _matrix_rows(spark, sf), {"AGEP": "age", "WAGP": "wage_income", "WKHP": "hours_per_week"}
    )
    typed = clean.coerce_numeric(rows, ["age", "wage_income", "hours_per_week", "absent"])
    return typed.select(F.col("ID").cast("long").alias("ID"), "age", "wage_income", "hours_per_week")


@query(
    "p3_coercion_report",
    raw_sql(
        """select 'AGEP' as feature, count(*) filter (age < 3) as unparseable from raw
union all select 'WAGP', 0"""
    ),
)
def p3_report(spark, sf):
    return clean.coercion_report(_matrix_rows(spark, sf), ["AGEP", "WAGP"])


@query(
    "p4_drop_invalid",
    raw_sql("select person_id, wage_income, age from raw where wage_income >= 0 and age >= 18"),
)
def p4(spark, sf):
    valid = clean.drop_invalid(ap.raw_applicants(spark, sf), clean.validity_rules())
    return valid.select("person_id", "wage_income", "age")


@query(
    "p5_row_audit",
    raw_sql(
        """select rule, before, after, before - after as dropped,
  (before - after) / cast(before as double) as dropped_share from (
  select 'total' as rule, count(*) as before, count(*) filter (age >= 18) as after from raw
  union all select 'income_present', count(*), count(*) from raw
  union all select 'income_not_negative', count(*), count(*) from raw
  union all select 'age_present', count(*), count(*) from raw
  union all select 'age_minimum', count(*), count(*) filter (age >= 18) from raw)"""
    ),
)
def p5(spark, sf):
    return clean.row_audit(ap.raw_applicants(spark, sf), clean.validity_rules())


@query(
    "p6_label",
    raw_sql("select person_id, cast(wage_income >= 390000 as int) as high_income from raw"),
)
def p6(spark, sf):
    labelled = clean.label(ap.raw_applicants(spark, sf), "wage_income", ap.LABEL_CUT, "high_income")
    return labelled.select("person_id", "high_income")


@query(
    "p7_separate_sensitive",
    scored_sql("select person_id, race, sex, nativity, high_income from a"),
)
def p7(spark, sf):
    return clean.separate(ap.scored_applicants(spark, sf))[1]


@query(
    "p7_separate_model",
    scored_sql(
        """select person_id, age, education, occupation, hours_per_week, class_of_worker,
  marital_status, person_weight, high_income from a"""
    ),
)
def p7_model(spark, sf):
    model, _ = clean.separate(ap.scored_applicants(spark, sf).drop("order_ts", "score", "pred"))
    return model


@query("p8_pop_weight", scored_sql("select person_id, person_weight from a"))
def p8(spark, sf):
    return clean.pop_weight(ap.scored_applicants(spark, sf))[1]


@query(
    "p9_select_features",
    scored_sql(
        """select person_id, age, education, occupation, hours_per_week, class_of_worker,
  marital_status from a"""
    ),
)
def p9(spark, sf):
    return clean.select_features(ap.scored_applicants(spark, sf))


@query("p10_classify", scored_sql("select person_id, score, pred from a"))
def p10(spark, sf):
    return ap.scored_applicants(spark, sf).select("person_id", "score", "pred")


@query(
    "p11_decode",
    scored_sql(
        """select person_id, race, case race when '1' then 'Group A' when '2' then 'Group B'
  when '3' then 'Group C' when '4' then 'Group D' end as race_label from a"""
    ),
)
def p11(spark, sf):
    return clean.decode(ap.scored_applicants(spark, sf), "race", ap.RACE).select(
        "person_id", "race", "race_label"
    )


@query(
    "p11_decode_table",
    raw_sql(
        """select person_id, n_name as occupation_label from raw
left join nation on occupation = lpad(cast(n_nationkey * 10 as varchar), 4, '0')"""
    ),
)
def p11_table(spark, sf):
    book = ap.table(spark, sf, "nation").select(
        F.lpad((F.col("n_nationkey") * 10).cast("string"), 4, "0").alias("code"),
        F.col("n_name").alias("label"),
    )
    return clean.decode(ap.raw_applicants(spark, sf), "occupation", book).select(
        "person_id", "occupation_label"
    )


@query(
    "p12_slug",
    """select p_partkey, replace(replace(lower('Dim ' || p_type), ' ', '_'), '/', '_') as slug
from part""",
)
def p12(spark, sf):
    part = ap.table(spark, sf, "part")
    named = F.concat(F.lit("dim: Dim "), "p_type")
    return part.select("p_partkey", slug(named).alias("slug"))


@query(
    "p13_canonical_codes",
    raw_sql(
        """select person_id, cast(age as double) as age, education, occupation,
  cast(person_weight as varchar) as class_of_worker from raw"""
    ),
)
def p13(spark, sf):
    raw = ap.raw_applicants(spark, sf).withColumns(
        {
            "education": F.col("education").cast("double"),
            "class_of_worker": F.concat(F.col("person_weight").cast("string"), F.lit(".0")),
        }
    )
    return clean.canonical_codes(raw).select(
        "person_id", "age", "education", "occupation", "class_of_worker"
    )


@query(
    "p14_check_domain",
    raw_sql(
        """select person_id, concat_ws(',', case when age between 18 and 95 then null else 'age' end,
    case when hours_per_week between 1 and 99 then null else 'hours_per_week' end,
    case when marital_status in ('F', 'O') then null else 'marital_status' end) as violations,
  coalesce(age between 18 and 95 and hours_per_week between 1 and 99
    and marital_status in ('F', 'O'), false) as valid from raw"""
    ),
)
def p14(spark, sf):
    rules = [
        clean.Domain("age", 18, 95),
        clean.Domain("hours_per_week", 1, 99),
        clean.Domain("marital_status", codes=("F", "O")),
    ]
    checked = clean.check_domain(ap.raw_applicants(spark, sf), rules)
    return checked.select(
        "person_id", F.array_join("violations", ",").alias("violations"), "valid"
    )


@query(
    "p15_check_contract",
    raw_sql(
        """select t.position, t."column", t.expected, t.actual, t.status, case "column" when 'person_id' then ni when 'age' then na when 'education' then ne
  when 'hours_per_week' then nh else 0 end as nulls
from (select count(*) filter (person_id is null) as ni, count(*) filter (age is null) as na,
    count(*) filter (education is null) as ne, count(*) filter (hours_per_week is null) as nh from raw), (values (0, 'person_id', 'bigint', 'bigint', 'ok'), (1, 'age', 'double', 'int', 'type_differs'),
  (2, 'education', 'string', 'string', 'ok'), (3, 'income', 'double', null, 'missing'),
  (4, 'hours_per_week', 'double', 'double', 'order_differs'))
  as t(position, "column", expected, actual, status)"""
    ),
)
def p15(spark, sf):
    expected = T.StructType(
        [
            T.StructField("person_id", T.LongType()),
            T.StructField("age", T.DoubleType()),
            T.StructField("education", T.StringType()),
            T.StructField("income", T.DoubleType()),
            T.StructField("hours_per_week", T.DoubleType()),
        ]
    )
    raw = ap.raw_applicants(spark, sf).select("person_id", "age", "education", "hours_per_week")
    nulls = profile.null_counts(raw).withColumnRenamed("feature", "column")
    found = clean.check_contract(raw, expected).join(nulls, "column", "left")
    return found.withColumn("nulls", F.coalesce("nulls", F.lit(0)))


# --- joins ---------------------------------------------------------------------------


@query("j1_align", split_sql("select person_id, race, sex, nativity, high_income from sp where is_test"))
def j1(spark, sf):
    tagged = _stored_split(spark, sf)
    _, sensitive = clean.separate(ap.scored_applicants(spark, sf))
    return joins.align(sensitive, tagged.where("is_test"), ROLES.key)


@query("j2_attach_groups", scored_sql("select person_id, score, pred, high_income, race, sex, nativity from a"))
def j2(spark, sf):
    scored = ap.scored_applicants(spark, sf).select("person_id", "score", "pred", "high_income")
    _, sensitive = clean.separate(ap.scored_applicants(spark, sf))
    return joins.attach_groups(scored, sensitive, ROLES.key)


@query(
    "j2_attach_report",
    split_sql(
        """select count(*) as scored_rows, count(*) filter (is_test) as joined_rows,
  count(*) filter (not is_test) as without_group, cast(0 as bigint) as repeated_keys,
  count(*) = count(*) filter (is_test) as complete from sp"""
    ),
)
def j2_report(spark, sf):
    tagged = _stored_split(spark, sf)
    _, sensitive = clean.separate(tagged.where("is_test"))
    return joins.attach_report(tagged, sensitive, ROLES.key)


@query(
    "j3_encode",
    split_sql(
        """select person_id, cast(coalesce(o.idx, 0) as int) as occupation,
  cast(coalesce(m.idx, 0) as int) as marital_status, m.idx is not null as marital_status_known
from sp left join codes o on o.feature = 'occupation' and o.code = occupation
left join codes m on m.feature = 'marital_status' and m.code = case when marital_status = 'P' then 'Q'
  else marital_status end where is_test""",
        CODES_SQL,
    ),
)
def j3(spark, sf):
    tagged = _stored_split(spark, sf)
    codes = encode.fit_codes(tagged.where("not is_test"), ["occupation", "marital_status"])
    moved = F.when(F.col("marital_status") == "P", "Q").otherwise(F.col("marital_status"))
    fresh = tagged.where("is_test").withColumn("marital_status", moved)
    coded = encode.encode(fresh, codes, ["occupation", "marital_status"], keep_known=True)
    return coded.select("person_id", "occupation", "marital_status", "marital_status_known")


@query(
    "j3_fallback_report",
    split_sql(
        """select 'marital_status' as feature, count(*) as rows,
  count(*) filter (marital_status = 'P') as fallback_rows,
  count(*) filter (marital_status = 'P') / cast(count(*) as double) as fallback_share
from sp where is_test"""
    ),
)
def j3_report(spark, sf):
    tagged = _stored_split(spark, sf)
    codes = encode.fit_codes(tagged.where("not is_test"), ["marital_status"])
    moved = F.when(F.col("marital_status") == "P", "Q").otherwise(F.col("marital_status"))
    return encode.fallback_report(
        tagged.where("is_test").withColumn("marital_status", moved), codes, ["marital_status"]
    )


def _early_late(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    return (
        scored.where("order_ts < timestamp'1998-01-01'"),
        scored.where("order_ts >= timestamp'1998-01-01'"),
    )


@query(
    "j4_histogram_pair",
    scored_sql(
        """select coalesce(l.code, c.code) as code, coalesce(n_ref, 0) as n_ref, coalesce(n_cur, 0) as n_cur
from (select education as code, count(*) as n_ref from a where order_ts < timestamp '1998-01-01'
    and education <> '2' group by 1) l
full outer join (select education as code, count(*) as n_cur from a
    where order_ts >= timestamp '1998-01-01' and education <> '1' group by 1) c on l.code = c.code"""
    ),
)
def j4(spark, sf):
    ref, cur = _early_late(spark, sf)
    pair = joins.histogram_pair(
        ref.where("education <> '2'"), cur.where("education <> '1'"), [F.col("education").alias("code")]
    )
    return pair


@query(
    "j5_reconcile",
    scored_sql(
        """select person_id, score_a, score_b, abs(score_a - score_b) as diff,
  case when score_a is null then 'missing_in_a' when score_b is null then 'missing_in_b'
    when abs(score_a - score_b) < 5e-2 then 'match' else 'differ' end as status
from (select person_id, case when race = '3' then null else score end as score_a,
  case when race = '2' then null when sex = '1' then score + 1e-3 else score + 1e-1 end as score_b from a)
where score_a is not null or score_b is not null"""
    ),
)
def j5(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    moved = F.when(F.col("sex") == "1", F.col("score") + F.lit(1e-3)).otherwise(
        F.col("score") + F.lit(1e-1)
    )
    second = scored.where("race <> '2'").withColumn("score", moved)
    return joins.reconcile(scored.where("race <> '3'"), second, ROLES.key, "score", 0.05)


@query(
    "j5_reconcile_summary",
    scored_sql(
        """select status, count(*) as n from (
  select case when race = '2' then 'missing_in_b' when race = '3' then 'missing_in_a'
    when sex = '1' then 'match' else 'differ' end as status from a) group by 1"""
    ),
)
def j5_summary(spark, sf):
    return joins.reconcile_summary(j5(spark, sf)).drop("max_diff")


@query(
    "j7_unseen_codes",
    scored_sql(
        """select 'class_of_worker' as feature, class_of_worker as code, count(*) as n from a
where class_of_worker not in (select class_of_worker from a where race = '1' and class_of_worker < 'F')
group by 2"""
    ),
)
def j7(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    known = scored.where("race = '1' and class_of_worker < 'F'")
    codes = encode.fit_codes(known, ["class_of_worker"])
    return joins.unseen(scored, codes, ["class_of_worker"])


@query("o1_ranked", "select p_partkey, p_retailprice from part")
def o1(spark, sf):
    part = ap.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return models.ranked(part, "p_retailprice")


@query(
    "o2_sample_head",
    raw_sql("select person_id, wage_income from raw order by person_id limit 5"),
)
def o2(spark, sf):
    raw = ap.raw_applicants(spark, sf).select("person_id", "wage_income")
    return models.sample_head(raw, "person_id", 5)


@query(
    "u2_code_difference",
    scored_sql(
        """select distinct occupation as code from a where occupation not in (
  select occupation from a where nativity = '1')"""
    ),
)
def u2(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    codes = encode.fit_codes(scored.where("nativity = '1'"), ["occupation"])
    return joins.unseen(scored, codes, ["occupation"]).select("code")
