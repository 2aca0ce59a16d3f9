"""Queries of the classifiers, scoring and attributions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from equigauge.functions.scalar import round_half_up
from equigauge.operators import attribution, boosted, encode, models
from equigauge.plans import applicants as ap
from equigauge.plans.q_tables import _stored_split
from equigauge.plans.registry import query, r4, scored_sql, split_sql
from equigauge.roles import ROLES
from equigauge.session import materialize

FEATURES = list(ROLES.feature_order)
SMALL_TREES = {"n_estimators": 5, "max_depth": 3, "scale_pos_weight": 2.0}
SMALL_SPACE = {
    "n_estimators": ("int", 2, 4),
    "max_depth": ("int", 2, 3),
    "learning_rate": ("log", 0.05, 0.3),
    "scale_pos_weight": ("float", 1.0, 5.0),
}


_ready: dict[tuple[str, str], tuple] = {}


def _prepared(spark, sf):
    """Split, fit on the training side, transform; written once per session for the fits."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _ready:
        tagged = _stored_split(spark, sf)
        prep = encode.Preprocessor().fit(tagged.where("not is_test"))
        sides = [
            prep.transform(tagged.where(F.col("is_test") == F.lit(test))).withColumn(
                "is_test", F.lit(test)
            )
            for test in (False, True)
        ]
        _ready[key] = tagged, prep, materialize(sides[0].unionAll(sides[1]), "prepared")
    tagged, prep, ready = _ready[key]
    return tagged, prep, ready.where("not is_test"), ready.where("is_test")


@query("l3_logistic_coefficients")
def l3(spark, sf):
    _, _, train, _ = _prepared(spark, sf)
    return models.coef_table(models.fit_logistic(train, FEATURES, 1.0), FEATURES, spark)


@query("l4_ridge_cv_trials")
def l4(spark, sf):
    _, _, train, _ = _prepared(spark, sf)
    return models.fit_ridge_cv(train, FEATURES, (100.0, 1.0, 0.01), folds=3).trials


@query("l5_gbt_scores")
def l5(spark, sf):
    _, _, train, test = _prepared(spark, sf)
    model = models.fit_gbt(train, FEATURES, SMALL_TREES)
    return models.score(test, model, FEATURES).select(ROLES.key, ROLES.label, "score")


BOOSTED = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, "scale_pos_weight": 2.0, "gamma": 0.1, "min_child_weight": 3, "colsample_bytree": 0.8}
RAW_FEATURES = ["age", "hours_per_week"]


@query("l5_boosted_scores")
def l5_boosted(spark, sf):
    """Second-order trees on records with missing hours; scores of the test records."""
    _, _, train, test = _prepared(spark, sf)
    return boosted.fit(train, FEATURES, BOOSTED).score(test).select(ROLES.key, ROLES.label, "score")


@query("l5_boosted_nodes")
def l5_nodes(spark, sf):
    _, _, train, _ = _prepared(spark, sf)
    return boosted.fit(train, FEATURES, BOOSTED).nodes(spark)


def _gain(g: str, h: str) -> str:
    return f"({g}) * ({g}) / (({h}) + 1e0)"


@query(
    "l5_boosted_root_splits",
    scored_sql(
        f"""select feature, threshold, default_left,
  {r4(f"{_gain('gl', 'hl')} + {_gain('g - gl', 'h - hl')} - {_gain('g', 'h')}")} as gain,
  {r4("-gl / (hl + 1e0)")} as left_value, {r4("-(g - gl) / (h - hl + 1e0)")} as right_value
from (
  select c.feature, c.threshold, d.default_left, any_value(t.g) as g, any_value(t.h) as h,
    sum(case when x < threshold or (x is null and default_left) then lr.g else 0e0 end) as gl,
    sum(case when x < threshold or (x is null and default_left) then lr.h else 0e0 end) as hl
  from cuts c cross join (select true as default_left union all select false) d
    join long lr on lr.feature = c.feature cross join (select sum(g) as g, sum(h) as h from gh) t
  group by all)""",
        """
gh as (select cast(age as double) as age, cast(hours_per_week as double) as hours_per_week,
    person_weight * (case when high_income = 1 then 2e0 else 1e0 end) * (5e-1 - high_income) as g,
    person_weight * (case when high_income = 1 then 2e0 else 1e0 end) * 25e-2 as h from a),
long as (select 'age' as feature, age as x, g, h from gh union all select 'hours_per_week', hours_per_week, g, h from gh),
cuts as (select distinct feature, x as threshold from long v
         where x > (select min(x) from long w where w.feature = v.feature))""",
    ),
)
def l5_roots(spark, sf):
    """Gain and leaf values of every possible first split, both ways for missing hours."""
    found = boosted.root_splits(ap.scored_applicants(spark, sf), RAW_FEATURES, {"scale_pos_weight": 2.0, "max_bin": 512})
    return found.withColumns({c: round_half_up(c) for c in ("gain", "left_value", "right_value")})


@query("l6_halving_trials")
def l6_halving(spark, sf):
    _, _, train, _ = _prepared(spark, sf)
    space = {**boosted.SPACE, "n_estimators": ("int", 2, 4), "max_depth": ("int", 2, 3)}
    trials = boosted.halving_search(train, FEATURES, space, trials=4, keep=2, rungs=2, folds=2).trials
    return trials.select("trial", "mean_auc", "n_trees", "best", F.to_json("params").alias("params"))


@query("l6_search_trials")
def l6(spark, sf):
    _, _, train, _ = _prepared(spark, sf)
    trials = models.search(train, FEATURES, SMALL_SPACE, trials=2, folds=2).trials
    return trials.select("trial", "mean_auc", "best", F.to_json("params").alias("params"))


@query("l7_coefficients_unpenalised")
def l7(spark, sf):
    _, _, train, _ = _prepared(spark, sf)
    return models.coef_table(models.fit_logistic(train, FEATURES, None), FEATURES, spark)


@query("l8_gbt_importance")
def l8(spark, sf):
    _, _, train, _ = _prepared(spark, sf)
    model = models.fit_gbt(train, FEATURES, SMALL_TREES)
    return models.importance_table(model, FEATURES, spark)


@query("l8_boosted_importance")
def l8_boosted(spark, sf):
    """Splits and mean gain of every feature."""
    _, _, train, _ = _prepared(spark, sf)
    return boosted.fit(train, FEATURES, BOOSTED).importance(spark)


@query("l9_score_raw_records")
def l9(spark, sf):
    tagged, prep, train, _ = _prepared(spark, sf)
    model = models.fit_logistic(train, FEATURES, 1.0)
    filled = F.coalesce("hours_per_week", prep.stats.where("feature = 'hours_per_week'").select("mean").scalar())
    return models.score_raw(
        tagged.withColumn("hours_per_week", filled), models.bundle(prep, model, FEATURES)
    )


LINEAR = {"wage_income": 1e-5, "hours_per_week": 2e-3, "age": -1e-2}


def _linear(spark, sf):
    return attribution.attribute_linear(ap.scored_applicants(spark, sf), LINEAR, -38e-1)


def _part(c: str, w: str) -> str:
    return r4(f"coalesce({w} * ({c} - (select avg({c}) from a)), 0e0)")


@query(
    "l10_linear_attribution",
    scored_sql(
        f"""select person_id, {r4("-38e-1 + (select avg(wage_income) * 1e-5 + avg(hours_per_week) * 2e-3 + avg(age) * -1e-2 from a)")}
  as base, {_part("wage_income", "1e-5")} as wage_income, {_part("hours_per_week", "2e-3")} as hours_per_week,
  {_part("age", "-1e-2")} as age from a"""
    ),
)
def l10(spark, sf):
    parts = _linear(spark, sf)
    return parts.withColumns({c: round_half_up(c) for c in ("base", *LINEAR)})


@query("l10_tree_attribution")
def l10_trees(spark, sf):
    _, _, train, test = _prepared(spark, sf)
    model = models.fit_gbt(train, FEATURES, SMALL_TREES)
    return attribution.attribute_trees(test, model, FEATURES)


@query(
    "l10_tree_attribution_adds_up",
    split_sql("select person_id, true as adds_up from sp where is_test"),
)
def l10_sum(spark, sf):
    """Base value and attributions of every test record give its raw score."""
    _, _, train, test = _prepared(spark, sf)
    model = models.fit_gbt(train, FEATURES, SMALL_TREES)
    parts = attribution.attribute_trees(test, model, FEATURES)
    raw = vector_to_array("rawPrediction")[1]
    margin = model.transform(models.assemble(test, FEATURES)).select(ROLES.key, raw.alias("margin"))
    total = sum((F.col(c) for c in FEATURES), F.col("base"))
    close = F.abs(total - F.col("margin")) < F.lit(1e-9)
    return parts.join(margin, ROLES.key).select(ROLES.key, close.alias("adds_up"))


@query(
    "l11_attribution_summary",
    scored_sql(
        f"""select 'wage_income' as feature, {r4("avg(abs(1e-5 * (wage_income - (select avg(wage_income) from a))))")} as mean_abs from a
union all select 'hours_per_week',
  {r4("avg(coalesce(abs(2e-3 * (hours_per_week - (select avg(hours_per_week) from a))), 0e0))")} from a
union all select 'age', {r4("avg(abs(-1e-2 * (age - (select avg(age) from a))))")} from a"""
    ),
)
def l11(spark, sf):
    return attribution.attribution_summary(_linear(spark, sf), list(LINEAR))


@query(
    "o3_top_features",
    scored_sql(
        f"""select feature, mean_abs from (
  select 'wage_income' as feature, {r4("avg(abs(1e-5 * (wage_income - (select avg(wage_income) from a))))")} as mean_abs from a
  union all select 'age', {r4("avg(abs(-1e-2 * (age - (select avg(age) from a))))")} from a
  union all select 'hours_per_week',
    {r4("avg(coalesce(abs(2e-3 * (hours_per_week - (select avg(hours_per_week) from a))), 0e0))")} from a)
order by mean_abs desc limit 2"""
    ),
)
def o3(spark, sf):
    return attribution.attribution_summary(_linear(spark, sf), list(LINEAR), top=2)
