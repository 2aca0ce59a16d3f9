"""Classifiers on Spark ML: fit, search, tables of what was learned, scoring."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.functions.scalar import round_half_up
from equigauge.operators.split import stratified_folds
from equigauge.roles import LIMITS, ROLES
from equigauge.session import ensure_checkpoint_dir

FEATURES = "features"


def complete(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Numbers without NULL: a missing scaled value takes the mean, 0."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})


def assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES)


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return assembler(features).transform(complete(df, features))


def _logistic(reg: float, y: str) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=y,
        maxIter=1000,
        regParam=reg,
        elasticNetParam=0.0,
        standardization=False,
    )


def fit_logistic(
    df: DataFrame, features: Sequence[str], C: float | None = 1.0, y: str = ROLES.label
) -> LogisticRegressionModel:
    """Logistic regression with inverse L2 strength ``C``; None for no penalty."""
    reg = 0.0 if C is None else 1.0 / (C * df.count())
    return _logistic(reg, y).fit(assemble(df, features))


@dataclass(frozen=True)
class Tuned:
    """The refitted best model and the table of everything that was tried."""

    model: object
    best: dict
    trials: DataFrame


def _evaluator(y: str) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=y, metricName="areaUnderROC", numBins=0)


def fit_ridge_cv(
    df: DataFrame,
    features: Sequence[str],
    Cs: Sequence[float] = LIMITS.c_grid,
    folds: int = LIMITS.folds,
    seed: int = LIMITS.seed,
    parallelism: int = 4,
    key: str = ROLES.key,
    y: str = ROLES.label,
) -> Tuned:
    """Pick C by mean fold AUC, then refit on all training rows."""
    table = assemble(stratified_folds(df, y, key, folds, seed), features)
    n = df.count()
    base = _logistic(0.0, y)
    # the penalty is stated per training row, and a fold trains on fewer rows
    regs = [1.0 / (C * n * (folds - 1) / folds) for C in Cs]
    tried = CrossValidator(
        estimator=base,
        estimatorParamMaps=ParamGridBuilder().addGrid(base.regParam, regs).build(),
        evaluator=_evaluator(y),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(table)
    scores = list(zip(Cs, tried.avgMetrics, strict=True))
    best = max(scores, key=lambda s: s[1])[0]
    trials = df.sparkSession.createDataFrame(
        [(float(C), float(auc), C == best) for C, auc in scores],
        "C double, mean_auc double, best boolean",
    )
    return Tuned(fit_logistic(df, features, best, y), {"C": best}, trials)


GBT_DEFAULTS = {
    "n_estimators": 100,
    "max_depth": 5,
    "learning_rate": 0.1,
    "subsample": 1.0,
    "colsample": 1.0,
    "min_child_weight": 1.0,
    "gamma": 0.0,
    "scale_pos_weight": 1.0,
}

SEARCH_SPACE = {
    "n_estimators": ("int", 100, 500),
    "max_depth": ("int", 3, 8),
    "learning_rate": ("log", 0.01, 0.3),
    "subsample": ("float", 0.6, 1.0),
    "colsample": ("float", 0.6, 1.0),
    "min_child_weight": ("int", 1, 10),
    "gamma": ("float", 0.0, 1.0),
    "scale_pos_weight": ("float", 1.0, 5.0),
}


def _weighted(df: DataFrame, weight: str, y: str, positive: float) -> DataFrame:
    """Record weight times class weight, as the one weight Spark ML takes."""
    own = F.col(weight).cast("double") if weight in df.columns else F.lit(1.0)
    extra = F.when(F.col(y) == 1, F.lit(float(positive))).otherwise(F.lit(1.0))
    return df.withColumn("_w", own * extra)


def _gbt(params: Mapping[str, float], total_weight: float, seed: int, y: str) -> GBTClassifier:
    p = {**GBT_DEFAULTS, **params}
    return GBTClassifier(
        featuresCol=FEATURES,
        labelCol=y,
        weightCol="_w",
        maxIter=int(p["n_estimators"]),
        maxDepth=int(p["max_depth"]),
        stepSize=float(p["learning_rate"]),
        subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy="all" if p["colsample"] >= 1 else str(float(p["colsample"])),
        minWeightFractionPerNode=min(0.49, float(p["min_child_weight"]) / total_weight),
        minInfoGain=float(p["gamma"]),
        seed=seed,
        maxBins=64,
    )


def fit_gbt(
    df: DataFrame,
    features: Sequence[str],
    params: Mapping[str, float] | None = None,
    seed: int = LIMITS.seed,
    weight: str = ROLES.weight,
    y: str = ROLES.label,
) -> GBTClassificationModel:
    """Boosted trees with record weights and a class weight for positives."""
    p = {**GBT_DEFAULTS, **(params or {})}
    ensure_checkpoint_dir(df.sparkSession)
    table = assemble(_weighted(df, weight, y, p["scale_pos_weight"]), features)
    total = table.agg(F.sum("_w")).first()[0] or 1.0
    return _gbt(p, total, seed, y).fit(table)


def draw_params(space: Mapping[str, tuple], trials: int, seed: int) -> list[dict]:
    """Seeded random draws from a search space."""
    rng = random.Random(seed)

    def draw(kind, low, high):
        if kind == "int":
            return rng.randint(low, high)
        if kind == "log":
            return math.exp(rng.uniform(math.log(low), math.log(high)))
        return rng.uniform(low, high)

    return [{name: draw(*spec) for name, spec in space.items()} for _ in range(trials)]


def search(
    df: DataFrame,
    features: Sequence[str],
    space: Mapping[str, tuple] = SEARCH_SPACE,
    trials: int = 30,
    folds: int = LIMITS.folds,
    seed: int = LIMITS.seed,
    parallelism: int = 2,
    key: str = ROLES.key,
    weight: str = ROLES.weight,
    y: str = ROLES.label,
) -> Tuned:
    """Random search by mean fold AUC; the best draw is refitted on all rows."""
    ensure_checkpoint_dir(df.sparkSession)
    table = stratified_folds(df, y, key, folds, seed)
    drawn = draw_params(space, trials, seed)
    rows = []
    for i, params in enumerate(drawn):
        # the class weight is a column, so each draw has its own table
        weighted = assemble(
            _weighted(table, weight, y, params.get("scale_pos_weight", 1.0)), features
        )
        total = weighted.agg(F.sum("_w")).first()[0] or 1.0
        model = _gbt(params, total, seed, y)
        tried = CrossValidator(
            estimator=model,
            estimatorParamMaps=[{model.seed: seed}],
            evaluator=_evaluator(y),
            numFolds=folds,
            foldCol="fold",
            parallelism=parallelism,
        ).fit(weighted)
        rows.append((i, float(tried.avgMetrics[0]), {k: float(v) for k, v in params.items()}))
    best = max(rows, key=lambda r: r[1])[0]
    trial_table = df.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows],
        "trial int, mean_auc double, params map<string,double>, best boolean",
    )
    return Tuned(fit_gbt(df, features, drawn[best], seed, weight, y), drawn[best], trial_table)


def _ranked_table(spark, features, values, name: str) -> DataFrame:
    table = spark.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values, strict=True)], f"feature string, {name} double"
    )
    return ranked(table.withColumn(name, round_half_up(name)), name)


def coef_table(model: LogisticRegressionModel, features: Sequence[str], spark) -> DataFrame:
    return _ranked_table(spark, features, model.coefficients, "coefficient")


def importance_table(model: GBTClassificationModel, features: Sequence[str], spark) -> DataFrame:
    return _ranked_table(spark, features, model.featureImportances.toArray(), "importance")


def ranked(df: DataFrame, column: str, descending: bool = True) -> DataFrame:
    return df.orderBy(F.desc(column) if descending else F.asc(column))


def sample_head(df: DataFrame, key: str, n: int) -> DataFrame:
    """First rows by key, for a preview or a scoring sample."""
    return df.orderBy(key).limit(n)


def score(df: DataFrame, model, features: Sequence[str]) -> DataFrame:
    """Adds the positive-class probability as ``score``."""
    scored = model.transform(assemble(df, features))
    extra = [c for c in scored.columns if c in (FEATURES, "rawPrediction", "probability", "prediction")]
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(*extra)


def bundle(prep, model, features: Sequence[str]) -> PipelineModel:
    """Preprocessing and classifier as one model over raw records."""
    return PipelineModel(stages=[prep, assembler(features), model])


def score_raw(df: DataFrame, pipeline: PipelineModel, key: str = ROLES.key) -> DataFrame:
    scored = pipeline.transform(df)
    return scored.select(key, vector_to_array("probability")[1].alias("score"))
