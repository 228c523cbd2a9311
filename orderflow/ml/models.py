"""Model candidates on Spark ML, their comparison on the validation part, and persistence."""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.contract import FeatureContract
from orderflow.functions.derived import ROUTE, ROUTE_FREQUENCY, derived_names
from orderflow.ml.boosting import LOGISTIC, SQUARED, Settings, fit_boosted
from orderflow.ml.extra_trees import fit_extra_trees
from orderflow.ml.forests import fit_forest
from orderflow.ml.prep import DerivedFeatures, FrequencyEncoder, class_weights, preparation_stages
from orderflow.operators.evaluate import (
    COUNTS,
    DEFAULT_THRESHOLD,
    classification_metrics,
    predict_class,
    ranking_metrics,
    regression_metrics,
)
from orderflow.operators.ordering import medians
from orderflow.session import pin_partitions

FEATURES, LABEL, WEIGHT = "features", "_label", "_weight"
CLASS_TARGET, DAYS_TARGET = "_late", "_days"
SCORE, PREDICTION, NAME = "score", "prediction", "model_name"
SEED = 42
BOOSTED = ("hist_gradient_boosting", "gradient_boosted_trees")
#: Tasks of each pass over the training rows. The rows that bagging draws depend on this number, so it is a fixed
#: parameter and follows neither the rows nor the cores: raise it in ``prepare`` for large training parts, so that
#: a partition of vectors fits in an executor's memory.
TRAINING_PARTITIONS = 8
#: Split candidates per feature; as many as histogram learners on one machine take.
MAX_BINS = 255


class Constant(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The same prediction for every row (baseline model)."""

    value = Param(Params._dummy(), "value", "predicted value", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, outputCol=None, value=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), F.lit(self.getOrDefault(self.value)))


class PositiveScore(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Probability of class 1 as a plain number."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(SCORE, vector_to_array(F.col("probability"))[1])


class BackFromLog(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Undo log1p on the prediction."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(PREDICTION, F.expm1(PREDICTION))


@dataclass(frozen=True)
class Run:
    """One candidate: fitted stages, scored validation rows and wall times."""

    name: str
    stages: list
    scored: DataFrame
    fit_seconds: float
    score_seconds: float


Fit = Callable[[DataFrame], list]

# Settings of the candidate families, in comparison order.
CLASSIFIERS = {
    "dummy_classifier": {},
    "logistic_regression": {"C": 1.0, "maxIter": 2000},
    "decision_tree": {"maxDepth": 12, "minInstancesPerNode": 20},
    "random_forest": {"numTrees": 250, "maxDepth": 18, "minInstancesPerNode": 5},
}
ENGINEERED_CLASSIFIERS = {
    "dummy_classifier": {},
    "logistic_regression": {"C": 1.0, "maxIter": 2000},
    "hist_gradient_boosting": {"trees": 220, "step": 0.08, "depth": 5, "least_rows": 30, "l2": 1.0},
    "random_forest": {"numTrees": 50, "maxDepth": 12, "minInstancesPerNode": 15, "featureSubsetStrategy": "0.5"},
    "extra_trees": {"trees": 50, "depth": 14, "least_rows": 12, "features": 0.5},
    "gradient_boosted_trees": {"trees": 180, "step": 0.06, "depth": 6, "least_hessian": 5, "rows": 0.8, "features": 0.8, "l2": 2.0},
}
REGRESSORS = {
    "dummy_regressor": {},
    "linear_regression": {},
    "decision_tree_regressor": {"maxDepth": 15, "minInstancesPerNode": 20},
    "random_forest_regressor": {
        "numTrees": 200,
        "maxDepth": 20,
        "minInstancesPerNode": 5,
        "featureSubsetStrategy": "0.8",
    },
}
ENGINEERED_REGRESSORS = {
    "dummy_regressor": {},
    "ridge": {"alpha": 10.0},
    "ridge_log_target": {"alpha": 10.0},
    "elastic_net": {"alpha": 0.03, "l1_ratio": 0.2},
    "hist_gradient_boosting": {"trees": 180, "step": 0.06, "depth": 5, "least_rows": 30, "l2": 2.0},
    "random_forest": {"numTrees": 40, "maxDepth": 12, "minInstancesPerNode": 15, "featureSubsetStrategy": "0.5"},
    "extra_trees": {"trees": 40, "depth": 14, "least_rows": 12, "features": 0.5},
    "gradient_boosted_trees": {"trees": 180, "step": 0.06, "depth": 6, "least_hessian": 8, "rows": 0.8, "features": 0.8, "l2": 3.0},
}


# --- learners -----------------------------------------------------------------------------------


def _classifier(name: str, settings: dict) -> Fit:
    shared = {"featuresCol": FEATURES, "labelCol": LABEL, "weightCol": WEIGHT}

    def prior(train: DataFrame) -> list:
        return [Constant(outputCol=SCORE, value=train.agg(F.avg(LABEL)).first()[0])]

    def logistic(train: DataFrame) -> list:
        # The penalty of the summed loss, divided by the summed weights that Spark averages over.
        weight = train.agg(F.sum(WEIGHT)).first()[0]
        learner = LogisticRegression(
            **shared,
            maxIter=settings["maxIter"],
            regParam=1.0 / (settings["C"] * weight),
            elasticNetParam=0.0,
            standardization=False,
        )
        return [learner.fit(train), PositiveScore()]

    def tree(train: DataFrame) -> list:
        return [DecisionTreeClassifier(**shared, **{"maxBins": MAX_BINS, **settings}, seed=SEED).fit(train), PositiveScore()]

    def forest(train: DataFrame) -> list:
        return [fit_forest(train, settings, True, SEED, SCORE, FEATURES, LABEL, WEIGHT)]

    def randomised(train: DataFrame) -> list:
        return [fit_extra_trees(train, Settings(**{"step": 1.0, "seed": SEED, **settings}), SCORE, FEATURES, LABEL, WEIGHT)]

    def boosted(train: DataFrame) -> list:
        # One family weighs both classes, the other only the positive one: its weights are relative to the negative ones.
        unit = F.lit(1.0)
        if name == "gradient_boosted_trees":
            unit = F.lit(train.where(F.col(LABEL) == 0).agg(F.min(WEIGHT)).first()[0] or 1.0)
        weighted = train.withColumn(WEIGHT, F.col(WEIGHT) / unit)
        return [fit_boosted(weighted, LOGISTIC, Settings(**{"seed": SEED, **settings}), SCORE, FEATURES, LABEL, WEIGHT)]

    return {
        **dict.fromkeys(BOOSTED, boosted),
        "extra_trees": randomised,
        "dummy_classifier": prior,
        "logistic_regression": logistic,
        "decision_tree": tree,
        "random_forest": forest,
    }[name]


def _regressor(name: str, settings: dict) -> Fit:
    shared = {"featuresCol": FEATURES, "labelCol": LABEL}

    def middle(train: DataFrame) -> list:
        return [Constant(outputCol=PREDICTION, value=medians(train, LABEL).first()[0])]

    def linear(train: DataFrame) -> list:
        return [LinearRegression(**shared, regParam=0.0, solver="normal").fit(train)]

    def ridge(train: DataFrame) -> list:
        return [_penalised(train, l1=0.0, l2=settings["alpha"] / train.count())]

    def log_ridge(train: DataFrame) -> list:
        logged = train.withColumn(LABEL, F.log1p(LABEL))
        return [_penalised(logged, l1=0.0, l2=settings["alpha"] / train.count()), BackFromLog()]

    def elastic(train: DataFrame) -> list:
        alpha, share = settings["alpha"], settings["l1_ratio"]
        return [_penalised(train, l1=alpha * share, l2=alpha * (1 - share))]

    def tree(train: DataFrame) -> list:
        return [DecisionTreeRegressor(**shared, **{"maxBins": MAX_BINS, **settings}, seed=SEED).fit(train)]

    def forest(train: DataFrame) -> list:
        return [fit_forest(train, settings, False, SEED, PREDICTION, FEATURES, LABEL)]

    def randomised(train: DataFrame) -> list:
        return [fit_extra_trees(train, Settings(**{"step": 1.0, "seed": SEED, **settings}), PREDICTION, FEATURES, LABEL)]

    def boosted(train: DataFrame) -> list:
        return [fit_boosted(train, SQUARED, Settings(**{"seed": SEED, **settings}), PREDICTION, FEATURES, LABEL)]

    return {
        **dict.fromkeys(BOOSTED, boosted),
        "extra_trees": randomised,
        "dummy_regressor": middle,
        "linear_regression": linear,
        "ridge": ridge,
        "ridge_log_target": log_ridge,
        "elastic_net": elastic,
        "decision_tree_regressor": tree,
        "random_forest_regressor": forest,
        "random_forest": forest,
    }[name]


def _penalised(train: DataFrame, l1: float, l2: float):
    """Least squares with penalties stated for the raw label: Spark scales the label by its population
    deviation, which multiplies the quadratic term once more."""
    deviation = train.agg(F.stddev_pop(LABEL)).first()[0] or 1.0
    penalty = l1 + l2 * deviation
    return LinearRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        regParam=penalty,
        elasticNetParam=l1 / penalty if penalty else 0.0,
        standardization=False,
        solver="normal",
    ).fit(train)


def fit_classifier(name: str, settings: dict, train: DataFrame) -> PipelineModel:
    """One family on prepared rows (vector, label, weight); adds ``score``."""
    return PipelineModel(_classifier(name, settings)(train))


def fit_regressor(name: str, settings: dict, train: DataFrame) -> PipelineModel:
    """One family on prepared rows (vector, label); adds ``prediction``."""
    return PipelineModel(_regressor(name, settings)(train))


# --- comparison ---------------------------------------------------------------------------------


@dataclass
class Comparison:
    """Validation metrics of all candidates and the fitted pipeline of the best one."""

    metrics: DataFrame
    best_name: str
    best_pipeline: PipelineModel
    beats_baseline: bool
    best_metrics: dict


def build_preparation(contract: FeatureContract, engineered: bool) -> Pipeline:
    """Preparation pipeline on the contract's inputs, optionally with the derived features."""
    numerical, categorical = list(contract.numerical), list(contract.categorical)
    stages: list = []
    if engineered:
        names = derived_names(contract.features)
        stages = [DerivedFeatures(), FrequencyEncoder(inputCol=ROUTE, outputCol=ROUTE_FREQUENCY)]
        numerical += [n for n in names if n != ROUTE] + [ROUTE_FREQUENCY]
        categorical += [ROUTE]
    return Pipeline(stages=[*stages, *preparation_stages(numerical, categorical)])


@dataclass(frozen=True)
class Prepared:
    """The fitted preparation and both parts as narrow pinned frames (vector, both targets, weight)."""

    pipeline: PipelineModel
    train: DataFrame
    validation: DataFrame
    engineered: bool

    def part(self, df: DataFrame, target: str) -> DataFrame:
        return df.select(FEATURES, F.col(target).alias(LABEL), WEIGHT)


def prepare(
    contract: FeatureContract,
    train: DataFrame,
    validation: DataFrame,
    engineered: bool = False,
    partitions: int = TRAINING_PARTITIONS,
) -> Prepared:
    """Fit the preparation on train once; every candidate of both tasks then reads the same vectors.

    Rows are dealt to ``partitions`` by the hash of their key and ordered by it, so that sampling learners see the
    same rows in the same places whatever the cluster.
    """
    fitted = build_preparation(contract, engineered).fit(train)
    label = contract.classification_target
    weight = F.lit(1.0)
    for row in class_weights(train, label).collect():
        weight = F.when(F.col(label) == row["label"], row["balanced_weight"]).otherwise(weight)

    def narrow(df: DataFrame) -> DataFrame:
        ready = fitted.transform(df).select(
            F.col(contract.tracking[0]).alias("_key"),
            FEATURES,
            F.col(label).cast("double").alias(CLASS_TARGET),
            F.col(contract.regression_target).cast("double").alias(DAYS_TARGET),
            weight.alias(WEIGHT),
        )
        return pin_partitions(ready.repartition(partitions, "_key").sortWithinPartitions("_key").drop("_key"))

    return Prepared(fitted, narrow(train), narrow(validation), engineered)


def _run(name: str, fit: Fit, train: DataFrame, validation: DataFrame) -> Run:
    """Fit on train, score validation, and time both."""
    start = time.perf_counter()
    stages = fit(train)
    fitted = time.perf_counter()
    scored = PipelineModel(stages).transform(validation)
    scored.write.format("noop").mode("overwrite").save()
    return Run(name, stages, scored, fitted - start, time.perf_counter() - fitted)


def check_time_order(train: DataFrame, validation: DataFrame, time_column: str) -> None:
    last, first = train.agg(F.max(time_column)).first()[0], validation.agg(F.min(time_column)).first()[0]
    if last is not None and first is not None and last > first:
        raise ValueError("training rows are later than the first validation row")


def compare_classifiers(
    prepared: Prepared, candidates: dict[str, dict] | None = None, threshold: float = DEFAULT_THRESHOLD
) -> Comparison:
    """Fit every candidate on train; the best average precision on validation wins (first among equals)."""
    if candidates is None:
        candidates = ENGINEERED_CLASSIFIERS if prepared.engineered else CLASSIFIERS
    fit_rows, check_rows = (prepared.part(df, CLASS_TARGET) for df in (prepared.train, prepared.validation))
    runs = [_run(name, _classifier(name, settings), fit_rows, check_rows) for name, settings in candidates.items()]
    judged = _stack(runs, [LABEL, SCORE]).withColumn("_class", predict_class(SCORE, threshold))
    counts = classification_metrics(judged, LABEL, "_class", [NAME])
    ranking = ranking_metrics(judged, SCORE, LABEL, [NAME])
    rate = F.try_divide(F.col("positives"), F.col("positives") + F.col("negatives"))
    measured = counts.join(ranking, NAME).select(
        NAME,
        F.lit(float(threshold)).alias("threshold"),
        rate.alias("positive_rate"),
        F.col("average_precision").alias("pr_auc"),
        "roc_auc",
        "precision",
        "recall",
        "f1_score",
        "accuracy",
        *COUNTS,
    )
    return _choose(runs, measured, prepared, "pr_auc", True, "dummy_classifier")


def compare_regressors(prepared: Prepared, candidates: dict[str, dict] | None = None) -> Comparison:
    """Fit every candidate on train; the smallest absolute error on validation wins (first among equals)."""
    if candidates is None:
        candidates = ENGINEERED_REGRESSORS if prepared.engineered else REGRESSORS
    fit_rows, check_rows = (prepared.part(df, DAYS_TARGET) for df in (prepared.train, prepared.validation))
    runs = [_run(name, _regressor(name, settings), fit_rows, check_rows) for name, settings in candidates.items()]
    measured = regression_metrics(_stack(runs, [LABEL, PREDICTION]), LABEL, PREDICTION, [NAME])
    return _choose(runs, measured, prepared, "mae", False, "dummy_regressor")


def _stack(runs: Sequence[Run], columns: Sequence[str]) -> DataFrame:
    """Predictions of all candidates under each other, so that one set of jobs measures all of them."""
    frames = [r.scored.select(F.lit(r.name).alias(NAME), *columns) for r in runs]
    return reduce(DataFrame.unionByName, frames)


def _choose(
    runs: Sequence[Run], measured: DataFrame, prepared: Prepared, metric: str, larger: bool, baseline: str
) -> Comparison:
    """One metric row per candidate reaches the driver; the first of equal candidates is kept."""
    found = {row[NAME]: row.asDict() for row in measured.collect()}
    scored_rows = max(prepared.validation.count(), 1)
    rows = [
        {
            **found[r.name],
            "training_seconds": r.fit_seconds,
            "inference_seconds": r.score_seconds,
            "inference_ms_per_order": r.score_seconds * 1000.0 / scored_rows,
        }
        for r in runs
        if r.name in found
    ]
    sign = -1.0 if larger else 1.0
    best = min(rows, key=lambda row: sign * row[metric] if row[metric] is not None else float("inf"))
    floor = next((row for row in rows if row[NAME] == baseline), None)
    beats = best[NAME] != baseline and (floor is None or sign * best[metric] < sign * floor[metric])
    timing = "training_seconds double, inference_seconds double, inference_ms_per_order double"
    schema = T.StructType([*measured.schema.fields, *T.StructType.fromDDL(timing).fields])
    frame = measured.sparkSession.createDataFrame([tuple(row.values()) for row in rows], schema)
    stages = next(r.stages for r in runs if r.name == best[NAME])
    return Comparison(frame, best[NAME], PipelineModel([*prepared.pipeline.stages, *stages]), beats, dict(best))


# --- persistence --------------------------------------------------------------------------------


def save_best(comparison: Comparison, path: str, metadata: dict | None = None, require_gain: bool = False) -> bool:
    """Save the best pipeline with its metadata; with ``require_gain`` only if it beats the baseline."""
    spark = comparison.metrics.sparkSession
    saved = comparison.beats_baseline or not require_gain
    record = {"model_name": comparison.best_name, "model_saved": saved, **comparison.best_metrics, **(metadata or {})}
    if saved:
        comparison.best_pipeline.write().overwrite().save(os.path.join(path, "pipeline"))
    text = spark.createDataFrame([(json.dumps(record, default=str),)], "value string").coalesce(1)
    text.write.mode("overwrite").text(os.path.join(path, "metadata"))
    return saved


def load_model(spark, path: str) -> tuple[PipelineModel, dict]:
    """The saved pipeline and its metadata (the decision threshold travels with the model)."""
    record = json.loads(spark.read.text(os.path.join(path, "metadata")).first()["value"])
    if not record["model_saved"]:
        raise ValueError(f"the last comparison saved no model in {path}: its best did not beat the baseline")
    return PipelineModel.load(os.path.join(path, "pipeline")), record
