"""Queries of the endpoint windows, alarms and delayed outcomes."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from equigauge.functions.scalar import round_half_up
from equigauge.operators import fairness, monitor
from equigauge.plans import applicants as ap
from equigauge.plans.q_drift import VALUES, _pair
from equigauge.plans.registry import query, r4, scored_sql
from equigauge.roles import LIMITS, ROLES
from equigauge.session import new_path
from equigauge.streaming import alarms as stream_alarms
from equigauge.streaming import drift as stream_drift
from equigauge.streaming import drift_state
from equigauge.streaming import labels as stream_labels
from equigauge.streaming import windows as stream_windows


def events(spark, sf):
    """Requests: an ``error`` event failed, ``value`` is its latency."""
    return _as_requests(ap.table(spark, sf, "events"))


def _as_requests(df):
    return df.select(
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        (F.col("event_type") == "error").cast("int").alias("is_error"),
        F.col("value").alias("latency"),
    )


RULES = (
    monitor.AlarmRule("availability", "n < 1", 2, monitor.BREACHING),
    monitor.AlarmRule("errors", "error_rate > 3e-1", 3),
    monitor.AlarmRule("latency", "p99 > 100D", 3),
)

WINDOWS = f"""
ev as (select cast(floor(epoch_us(ts) / 3e8) as bigint) * 300 as w, (event_type = 'error') as bad, value from events),
ww as (
  select w, count(*) as n, count(*) filter (bad) as errors,
    count(*) filter (bad) / cast(count(*) as double) as error_rate,
    {r4("quantile_cont(value, 99e-2)")} as p99 from ev group by 1)"""


def _windows(spark, sf):
    found = monitor.endpoint_windows(events(spark, sf))
    return found.withColumn("p99", round_half_up("p99"))


@query("t1_endpoint_windows", f"with {WINDOWS}\nselect w as window_start, n, errors, error_rate, p99 from ww")
def t1(spark, sf):
    return _windows(spark, sf).withColumn("window_start", F.unix_seconds("window_start"))


@query(
    "t1_windows_by_kind",
    f"""select event_type, cast(floor(epoch_us(ts) / 3e8) as bigint) * 300 as window_start, count(*) as n,
  {r4("quantile_cont(value, 99e-2)")} as p99 from events group by 1, 2""",
)
def t1_kinds(spark, sf):
    rows = ap.table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        F.lit(0).alias("is_error"),
        F.col("value").alias("latency"),
    )
    found = monitor.endpoint_windows(rows, by=["event_type"])
    return found.select(
        "event_type",
        F.unix_seconds("window_start").alias("window_start"),
        "n",
        round_half_up("p99").alias("p99"),
    )


@query(
    "t2_alarms",
    f"""with {WINDOWS},
cal as (select unnest(generate_series((select min(w) from ww), (select max(w) from ww), 300)) as w),
st as (
  select cal.w, coalesce(n, 0) < 1 as b1, coalesce(error_rate > 3e-1, false) as b2,
    coalesce(p99 > 1e2, false) as b3 from cal left join ww on cal.w = ww.w)
select 'availability' as rule, w as window_start, b1 as breach,
  coalesce(b1 and lag(b1, 1) over (order by w), false) as alarm from st
union all select 'errors', w, b2, coalesce(b2 and lag(b2, 1) over (order by w) and lag(b2, 2) over (order by w), false) from st
union all select 'latency', w, b3, coalesce(b3 and lag(b3, 1) over (order by w) and lag(b3, 2) over (order by w), false) from st""",
)
def t2(spark, sf):
    found = monitor.alarms(_windows(spark, sf), RULES)
    return found.withColumn("window_start", F.unix_seconds("window_start"))


def _outcomes(spark, sf):
    """First shipment of an order after which its outcome is known."""
    items = ap.table(spark, sf, "lineitem")
    first = items.groupBy(F.col("l_orderkey").alias("person_id")).agg(
        F.min("l_shipdate").alias("outcome_ts")
    )
    truth = ap.scored_applicants(spark, sf).select(ROLES.key, F.col(ROLES.label).alias("outcome"))
    return first.join(truth, ROLES.key)


def _predictions(spark, sf):
    scored = ap.scored_applicants(spark, sf)
    return scored.select(ROLES.key, "order_ts", "score", "pred", *ROLES.sensitive)


def _known(spark, sf):
    return monitor.delayed_labels(
        _predictions(spark, sf), _outcomes(spark, sf), ROLES.key, "order_ts", "outcome_ts", "interval 365 days"
    )


KNOWN = """
oc as (select l_orderkey as person_id, min(l_shipdate) as outcome_ts from lineitem group by 1),
kn as (
  select person_id, score, pred, high_income, race, sex, nativity from a join oc using (person_id)
  where outcome_ts >= order_ts and outcome_ts <= order_ts + interval 365 day)"""


@query("t3_delayed_labels", scored_sql("select person_id, score, pred, high_income as outcome from kn", KNOWN))
def t3(spark, sf):
    return _known(spark, sf).select(ROLES.key, "score", "pred", "outcome")


@query(
    "t3_live_performance",
    scored_sql(
        f"""select n, {r4("(rsum - cast(pos as double) * (pos + 1) / 2) / (cast(pos as double) * (n - pos))")} as auc_roc,
  {r4("tp / cast(said as double)")} as precision, {r4("tp / cast(pos as double)")} as recall,
  {r4("2 * tp / cast(said + pos as double)")} as f1, {r4("said / cast(n as double)")} as overall_ppr,
  (select count(*) from a) as predictions,
  (rsum - cast(pos as double) * (pos + 1) / 2) / (cast(pos as double) * (n - pos)) < 82e-2 as retrain
from (select count(*) as n, cast(sum(high_income) as bigint) as pos, cast(sum(pred) as bigint) as said,
    cast(sum(pred * high_income) as bigint) as tp, sum(rnk) filter (high_income = 1) as rsum
  from (select *, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2e0 as rnk from kn))""",
        KNOWN,
    ),
)
def t3_live(spark, sf):
    total = _predictions(spark, sf)
    return monitor.live_performance(_known(spark, sf), total, LIMITS.min_auc, "outcome")


@query(
    "t3_live_coverage",
    scored_sql(
        """select 'race' as dim, count(*) as rows, count(*) filter (race <> '5') as audited,
  cast(0 as bigint) as in_small_groups, count(*) filter (race = '5') as without_label from kn
union all select 'sex', count(*), count(*), cast(0 as bigint), cast(0 as bigint) from kn""",
        KNOWN,
    ),
)
def t3_coverage(spark, sf):
    dims = {d: ap.DIMS[d] for d in ("race", "sex")}
    return fairness.audit_coverage(_known(spark, sf), dims, min_n=1)


# --- streams: a finite run over the given tables, closed by the end of the input ----------


def _run_to_end(writer, path: str) -> None:
    """Run a stream over what is there; one state partition per core is enough for that."""
    spark = SparkSession.active()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    fewer = min(int(before), spark.sparkContext.defaultParallelism)
    options = writer.option("checkpointLocation", f"{path}/checkpoint")
    spark.conf.set("spark.sql.shuffle.partitions", str(fewer))
    try:
        options.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _stream(spark, df, name: str):
    """The table as a file stream."""
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


@query(
    "t1_stream_windows",
    f"""with {WINDOWS}
select w as window_start, n, errors, error_rate from ww
where (w + 300) * 1000000 <= (select max(epoch_us(ts)) from events) - 600 * 1000000""",
)
def t1_stream(spark, sf):
    path = new_path(spark, "stream-windows")
    stream = _stream(spark, events(spark, sf), "requests")
    closed = stream_windows.stream_windows(stream).drop("event_time", "p99")
    _run_to_end(closed.writeStream.format("parquet").option("path", f"{path}/out"), path)
    return spark.read.parquet(f"{path}/out").withColumn(
        "window_start", F.unix_seconds("window_start")
    )


@query(
    "t2_stream_alarms",
    f"""with {WINDOWS},
cal as (select unnest(generate_series((select min(w) from ww), (select max(w) from ww), 300)) as w),
st as (
  select cal.w, coalesce(n, 0) < 1 as b1, coalesce(error_rate > 3e-1, false) as b2
  from cal left join ww on cal.w = ww.w)
select 'all' as endpoint, * from (
  select 'availability' as rule, w as window_start, b1 as breach,
    coalesce(b1 and lag(b1, 1) over (order by w), false) as alarm from st
  union all select 'errors', w, b2,
    coalesce(b2 and lag(b2, 1) over (order by w) and lag(b2, 2) over (order by w), false) from st)
where (window_start + 300) * 1000000 <= (select max(epoch_us(ts)) from events) - 600 * 1000000""",
)
def t2_stream(spark, sf):
    path = new_path(spark, "stream-alarms")
    requests = events(spark, sf).withColumn("endpoint", F.lit("all"))
    closed = stream_windows.stream_windows(_stream(spark, requests, "requests"), by=["endpoint"])
    spark.conf.set(stream_alarms.PROVIDER_KEY, stream_alarms.PROVIDER)
    states = stream_alarms.stream_alarms(closed, RULES[:2], "endpoint")
    _run_to_end(states.writeStream.format("parquet").option("path", f"{path}/out"), path)
    return spark.read.parquet(f"{path}/out").withColumn(
        "window_start", F.unix_seconds("window_start")
    )


@query("t3_stream_delayed_labels", scored_sql("select person_id, score, high_income as outcome from kn", KNOWN))
def t3_stream(spark, sf):
    path = new_path(spark, "stream-labels")
    preds = _stream(spark, _predictions(spark, sf), "predictions")
    late = _stream(spark, _outcomes(spark, sf), "outcomes")
    joined = stream_labels.stream_delayed_labels(
        preds, late, ROLES.key, "order_ts", "outcome_ts", "interval 365 days"
    )
    rows = joined.select(ROLES.key, "score", "outcome")
    _run_to_end(rows.writeStream.format("parquet").option("path", f"{path}/out"), path)
    return spark.read.schema("person_id long, score double, outcome int").parquet(f"{path}/out")


# the stream is over when its input is; what the last watermark has not passed stays in state
SETTLED = """
oc as (select l_orderkey as person_id, min(l_shipdate) as outcome_ts from lineitem join a on l_orderkey = person_id group by 1),
wm as (select least((select max(order_ts) from a), (select max(outcome_ts) from oc)) - interval 1 day as upto),
st as (
  select person_id, score, order_ts, case when outcome_ts is null then null else high_income end as outcome,
    case when outcome_ts is null then 'expired' else 'matched' end as settled
  from a left join (select * from oc join a using (person_id) where outcome_ts >= order_ts and outcome_ts <= order_ts + interval 365 day) k
    using (person_id, score, order_ts, high_income), wm
  where outcome_ts is not null or order_ts + interval 365 day < upto)"""


def _settled(spark, sf):
    preds = _stream(spark, _predictions(spark, sf), "predictions")
    late = _stream(spark, _outcomes(spark, sf), "outcomes")
    return stream_labels.stream_settled(preds, late, ROLES.key, "order_ts", "outcome_ts", "interval 365 days")


@query("t3_stream_settled", scored_sql("select person_id, outcome, settled from st", SETTLED))
def t3_settled(spark, sf):
    """Predictions with their outcome, and those whose horizon passed without one."""
    path = new_path(spark, "stream-settled")
    rows = _settled(spark, sf).select(ROLES.key, "outcome", "settled")
    _run_to_end(rows.writeStream.format("parquet").option("path", f"{path}/out"), path)
    return spark.read.schema("person_id long, outcome int, settled string").parquet(f"{path}/out")


@query(
    "t4_drift_stream",
    scored_sql(
        """select *, (select count(*) from pr where not is_ref) as rows from cd
where feature in ('education', 'marital_status', 'age')""",
        VALUES,
    ),
)
def t4(spark, sf):
    path = new_path(spark, "stream-drift")
    columns = ["education", "marital_status", "age"]
    ref, cur = _pair(spark, sf)
    stream = _stream(spark, cur.select(*columns), "arriving")
    _run_to_end(stream_drift.drift_stream(stream, ref, columns, f"{path}/out"), path)
    return spark.read.parquet(f"{path}/out/columns").drop("batch").withColumn(
        "rows", F.col("rows").cast("long")
    )


QUARTER = 91 * 86400
SPANS = f"""
pq as (
  select order_ts < timestamp '1998-01-01' as is_ref, (cast(floor(epoch_us(order_ts) / {QUARTER}e6) as bigint) + 1) * {QUARTER} as e,
    cast(age as double) as age, order_ts, marital_status,
    case when order_ts >= timestamp '1998-01-01' and education = '1' then '5' else education end as education from a),
lv as (
  select is_ref, e, unnest(['education', 'marital_status', 'age']) as feature,
    unnest([education, marital_status, cast(age as varchar)]) as value from pq),
closed as (
  select distinct feature, e from lv
  where not is_ref and e * 1000000 <= (select max(epoch_us(order_ts)) from pq) - 86400000000),
cc as (
  select c.feature, c.e, value, count(*) as n from closed c join lv on lv.feature = c.feature and not is_ref
    and value is not null and lv.e <= c.e and lv.e > c.e - 4 * {QUARTER} group by all),
rc as (select feature, value, count(*) as n from lv where is_ref and value is not null group by all),
av as (
  select feature, e, value, sum(r) as n_ref, sum(c) as n_cur from (
    select feature, e, value, 0 as r, n as c from cc
    union all select feature, e, value, n, 0 from rc join closed using (feature)) group by all),
pv as (
  select *, n_ref / cast(sum(n_ref) over k as double) as p, n_cur / cast(sum(n_cur) over k as double) as q,
    sum(n_cur) over k as total_cur from av window k as (partition by feature, e)),
wv as (
  select feature, e, sum(abs(cp - cq) * (next_x - x)) as area from (
    select feature, e, cast(value as double) as x, sum(p) over o as cp, sum(q) over o as cq, lead(cast(value as double)) over o as next_x
    from pv where feature = 'age' window o as (partition by feature, e order by cast(value as double)))
  group by all)"""


@query(
    "t4_drift_from_state",
    scored_sql(
        f"""select feature, e as window_end, cast(any_value(total_cur) as bigint) as rows, 'Jensen-Shannon distance' as stattest,
  {r4("sqrt(sum(case when p > 0 then p * ln(p / ((p + q) / 2)) / ln(2e0) else 0e0 end) / 2 + sum(case when q > 0 then q * ln(q / ((p + q) / 2)) / ln(2e0) else 0e0 end) / 2)")} as score,
  sqrt(sum(case when p > 0 then p * ln(p / ((p + q) / 2)) / ln(2e0) else 0e0 end) / 2
    + sum(case when q > 0 then q * ln(q / ((p + q) / 2)) / ln(2e0) else 0e0 end) / 2) >= 1e-1 as drift_detected
from pv where feature <> 'age' group by feature, e
union all
select 'age', e, cast((select any_value(total_cur) from pv where pv.e = wv.e and pv.feature = 'age') as bigint),
  'Wasserstein distance (normed)', {r4("area / greatest((select stddev_pop(age) from pq where is_ref), 1e-3)")},
  area / greatest((select stddev_pop(age) from pq where is_ref), 1e-3) >= 1e-1
from wv""",
        SPANS,
    ),
)
def t4_state(spark, sf):
    """Drift of the last four quarters at the end of each, against the stored profile of the reference."""
    path = new_path(spark, "stream-drift-state")
    columns = ["education", "marital_status", "age"]
    ref, cur = _pair(spark, sf)
    drift_state.write_profile(drift_state.reference_profile(ref, columns), f"{path}/profile")
    stream = _stream(spark, cur.select("order_ts", *columns), "arriving")
    spark.conf.set(stream_alarms.PROVIDER_KEY, stream_alarms.PROVIDER)
    found = drift_state.stream_drift(stream, drift_state.read_profile(spark, f"{path}/profile"), "order_ts", QUARTER, span=4)
    _run_to_end(found.writeStream.format("parquet").option("path", f"{path}/out"), path)
    rows = spark.read.schema(drift_state.RESULT).parquet(f"{path}/out").drop("score_kind")
    return rows.withColumn("window_end", F.unix_seconds("window_end"))
