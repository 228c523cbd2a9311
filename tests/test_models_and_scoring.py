import json
import math
import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from orderflow.contract import ContractError, FeatureContract
from orderflow.ml import models, prep
from orderflow.ml.score import Scorer, evaluate_frozen, split_records
from orderflow.streaming.scoring import read_orders, score_stream

CONTRACT = FeatureContract(("id",), ("state",), ("x", "z"), "late", "days")
TYPES = {"state": "string", "x": "double", "z": "double"}


@pytest.fixture(scope="module")
def parts(spark):
    df = spark.range(600).select(
        F.col("id"),
        F.element_at(F.array(*[F.lit(s) for s in "ABC"]), (F.col("id") % 3 + 1).cast("int")).alias("state"),
        F.when(F.col("id") % 11 != 0, (F.hash("id") % 100) / 10.0).alias("x"),
        ((F.hash(F.col("id") + 5) % 70) / 7.0).alias("z"),
    )
    signal = F.coalesce("x", F.lit(0.0)) + F.col("z") / 2
    df = df.withColumn("late", (signal + F.hash(F.col("id") + 9) % 5 > 0).cast("int"))
    df = df.withColumn("days", F.lit(60.0) + 2 * signal + (F.hash(F.col("id") + 3) % 10) / 10.0)
    return df.where("id < 450").cache(), df.where("id >= 450").cache()


@pytest.fixture(scope="module")
def fitted(parts):
    prepared = models.prepare(CONTRACT, *parts)
    late = models.compare_classifiers(prepared, {"dummy_classifier": {}, "logistic_regression": {"C": 1.0, "maxIter": 100}})
    days = models.compare_regressors(
        prepared, {"dummy_regressor": {}, "ridge": {"alpha": 10.0}, "ridge_log_target": {"alpha": 10.0},
                   "elastic_net": {"alpha": 0.03, "l1_ratio": 0.2}, "decision_tree_regressor": {"maxDepth": 3}}
    )
    return prepared, late, days


def test_imputers_and_scaler_learn_from_train_only(spark):
    train = spark.createDataFrame([(1.0, "b"), (3.0, "b"), (5.0, "a"), (None, "a"), (9.0, None)], "x double, c string")
    median = prep.ExactMedianImputer(inputCols=["x"]).fit(train)
    assert median.learned() == {"x": 4.0}
    mode = prep.ModeImputer(inputCols=["c"]).fit(train)
    assert mode.learned() == {"c": "a"}  # a tie: the smallest
    scale = prep.Standardizer(inputCols=["x"]).fit(median.transform(train))
    values = np.array([1.0, 3.0, 5.0, 4.0, 9.0])
    assert np.allclose(scale.learned()["x"], [values.mean(), values.std()])
    other = spark.createDataFrame([(None, None), (100.0, "q")], "x double, c string")
    filled = mode.transform(median.transform(other)).collect()
    assert filled[0]["x"] == 4.0 and filled[0]["c"] == "a" and filled[1]["c"] == "q"


def test_numeric_mode_ties_compare_numbers(spark):
    df = spark.createDataFrame([(10,), (10,), (9,), (9,), (1,)], "m int")
    assert prep.ModeImputer(inputCols=["m"]).fit(df).learned() == {"m": "9"}


def test_columns_without_values_or_spread(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 2.0)], "e double, k double")
    imputed = prep.ExactMedianImputer(inputCols=["e", "k"]).fit(df).transform(df)
    scaled = prep.Standardizer(inputCols=["e", "k"]).fit(imputed).transform(imputed)
    assert [tuple(r) for r in scaled.collect()] == [(0.0, 0.0)] * 2


def test_prepared_vectors(fitted, parts):
    prepared, _, _ = fitted
    vectors = prepared.pipeline.transform(parts[0])
    assert prep.feature_names(vectors) == ["x", "z", "state_hot_A", "state_hot_B", "state_hot_C"]
    check = prep.finite_check(vectors).first()
    assert check["width"] == 5 and check["rows_not_finite"] == 0
    assert prep.learned_state(prepared.pipeline.stages)["category_counts"] == {"state": 3}
    unseen = prepared.pipeline.transform(parts[1].limit(1).withColumn("state", F.lit("Q"))).first()["features"]
    assert list(unseen.toArray())[2:] == [0.0, 0.0, 0.0]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = {r["label"]: r for r in prep.class_weights(df, "y").collect()}
    assert got[1]["balanced_weight"] == 2.0 and math.isclose(got[0]["balanced_weight"], 4 / 6)
    assert got[0]["positive_weight"] == 3.0


def test_ridge_equals_closed_form(fitted):
    prepared, _, _ = fitted
    rows = prepared.part(prepared.train, "_days").collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["_label"] for r in rows])
    model = models._regressor("ridge", {"alpha": 10.0})(prepared.part(prepared.train, "_days"))[0]
    xc = x - x.mean(axis=0)
    beta = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    assert np.allclose(model.coefficients.toArray(), beta, atol=1e-8)


def test_logistic_regression_solves_the_balanced_problem(fitted):
    prepared, _, _ = fitted
    train = prepared.part(prepared.train, "_late")
    model = models._classifier("logistic_regression", {"C": 1.0, "maxIter": 500})(train)[0]
    rows = train.collect()
    x = np.array([r["features"].toArray() for r in rows])
    y, w = np.array([r["_label"] for r in rows]), np.array([r["_weight"] for r in rows])
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    gradient = x.T @ (w * (p - y)) + model.coefficients.toArray()
    assert np.abs(gradient).max() < 1e-2


def test_comparison_chooses_and_reports(fitted):
    _, late, days = fitted
    assert late.best_name == "logistic_regression" and late.beats_baseline
    names = [r["model_name"] for r in days.metrics.collect()]
    assert names[0] == "dummy_regressor" and days.best_name != "dummy_regressor"
    by_name = {r["model_name"]: r["mae"] for r in days.metrics.collect()}
    assert by_name[days.best_name] == min(by_name.values())


def test_save_load_and_guard(spark, fitted, parts, tmp_path):
    _, late, days = fitted
    path = str(tmp_path / "late")
    assert models.save_best(late, path, {"classification_threshold": 0.65})
    loaded, record = models.load_model(spark, path)
    assert record["classification_threshold"] == 0.65 and record["model_name"] == "logistic_regression"
    a = late.best_pipeline.transform(parts[1]).select("id", "score").orderBy("id").collect()
    b = loaded.transform(parts[1]).select("id", "score").orderBy("id").collect()
    assert a == b
    weak = models.Comparison(days.metrics, "dummy_regressor", days.best_pipeline, False, {})
    assert not models.save_best(weak, str(tmp_path / "weak"), require_gain=True)
    assert not (tmp_path / "weak" / "pipeline").exists()


def test_scoring_contract_and_frozen_evaluation(fitted, parts):
    _, late, days = fitted
    scorer = Scorer(CONTRACT, late.best_pipeline, days.best_pipeline, 0.65)
    got = scorer.score(parts[1], ["id"])
    assert got.columns == ["id", "late_delivery_probability", "late_delivery_prediction", "classification_threshold", "predicted_delivery_days"]
    assert got.where("late_delivery_prediction <> cast(late_delivery_probability >= 0.65 as int)").count() == 0
    with pytest.raises(ContractError, match="missing columns: z"):
        scorer.score(parts[1].drop("z"))
    tested = evaluate_frozen(scorer, parts[1], "id").first()
    assert math.isclose(tested["absolute_delivery_error_days"], abs(tested["days"] - tested["predicted_delivery_days"]))


def test_payload_records(spark):
    good = json.dumps({"state": "A", "x": 1.5, "z": None, "extra": 1})
    df = spark.createDataFrame([(1, good), (2, '{"state": "A"}'), (3, "not json"), (4, None)], "id int, body string")
    accepted, rejected = split_records(df, "body", CONTRACT, TYPES)
    assert [tuple(r) for r in accepted.collect()] == [(1, "A", 1.5, None)]
    missing = {r["id"]: r["missing_features"] for r in rejected.collect()}
    assert missing == {2: ["x", "z"], 3: ["state", "x", "z"], 4: ["state", "x", "z"]}


def test_payload_values_that_do_not_fit_are_rejected(spark):
    contract = FeatureContract(("id",), ("state",), ("n", "x"), "late", "days")
    values = ["2", "2.0", '"abc"', "2.5", "1e30", "null", "true"]
    rows = [(i, f'{{"state": "A", "n": {v}, "x": 1}}') for i, v in enumerate(values)]
    rows += [(90, '{"state": "A", "n": 1, "x": "Infinity"}'), (91, '{"state": "A", "n": 1, "x": "NaN"}')]
    df = spark.createDataFrame(rows, "id int, body string")
    accepted, rejected = split_records(df, "body", contract, {"state": "string", "n": "bigint", "x": "double"})
    assert {r["id"]: r["n"] for r in accepted.collect()} == {0: 2, 1: 2, 5: None}
    assert {r["id"]: r["invalid_features"] for r in rejected.collect()} == {2: ["n"], 3: ["n"], 4: ["n"], 6: ["n"], 90: ["x"], 91: ["x"]}


SMALL_TREES = {"maxDepth": 3, "minInstancesPerNode": 5}
SMALL_CLASSIFIERS = {
    "dummy_classifier": {},
    "random_forest": {"numTrees": 5, **SMALL_TREES},
    "extra_trees": {"trees": 5, "depth": 4, "least_rows": 5, "features": 0.5},
    "hist_gradient_boosting": {"trees": 3, "step": 0.1, "depth": 3, "least_rows": 5, "l2": 1.0},
    "gradient_boosted_trees": {"trees": 3, "step": 0.1, "depth": 3, "least_hessian": 2, "rows": 0.8, "features": 0.8, "l2": 2.0},
}


def test_tree_families_learn_the_signal(fitted):
    prepared, _, _ = fitted
    late = models.compare_classifiers(prepared, SMALL_CLASSIFIERS)
    got = {r["model_name"]: r["roc_auc"] for r in late.metrics.collect()}
    assert set(got) == set(SMALL_CLASSIFIERS)
    assert all(v > 0.7 for name, v in got.items() if name != "dummy_classifier")
    named = {"random_forest_regressor" if n == "random_forest" else n: s for n, s in SMALL_CLASSIFIERS.items() if s}
    days = models.compare_regressors(prepared, {"dummy_regressor": {}, **named})
    errors = {r["model_name"]: r["mae"] for r in days.metrics.collect()}
    assert all(v < errors["dummy_regressor"] for name, v in errors.items() if name != "dummy_regressor")


def test_training_partitions_do_not_follow_the_input(fitted, parts):
    prepared, _, _ = fitted
    again = models.prepare(CONTRACT, parts[0].repartition(23), parts[1].repartition(2))
    assert prepared.train.rdd.getNumPartitions() == again.train.rdd.getNumPartitions() == models.TRAINING_PARTITIONS
    forests = [
        models.fit_regressor("random_forest_regressor", SMALL_CLASSIFIERS["random_forest"], p.part(p.train, "_days"))
        for p in (prepared, again)
    ]
    # The scaler's means add up in another order, so numbers may differ in their last bit.
    rounded = [re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.9f}", f.stages[0].toDebugString) for f in forests]
    assert rounded[0].split("\n")[1:] == rounded[1].split("\n")[1:]


def test_stream_equals_batch(spark, fitted, parts, tmp_path):
    _, late, days = fitted
    scorer = Scorer(CONTRACT, late.best_pipeline, days.best_pipeline, 0.65)
    source = str(tmp_path / "in")
    parts[1].repartition(3).write.parquet(source)
    orders = read_orders(spark, source, parts[1].schema, files_per_trigger=1)
    score_stream(orders, scorer, str(tmp_path / "out"), str(tmp_path / "check"), ["id"], available_now=True).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert streamed == scorer.score(parts[1], ["id"]).orderBy("id").collect()


def test_engineered_preparation_runs_on_the_delivery_contract(spark, tiny, tmp_path):
    from orderflow.plans import delivery
    from orderflow.plans.queries import parts as delivery_parts

    ready = delivery_parts(spark, tiny)
    pipeline = models.build_preparation(delivery.CONTRACT, engineered=True).fit(ready["train"])
    vectors = pipeline.transform(ready["validation"])
    assert prep.finite_check(vectors).first()["rows_not_finite"] == 0
    assert len(prep.feature_names(vectors)) > 100
    pipeline.write().overwrite().save(str(tmp_path / "prep"))
    again = PipelineModel.load(str(tmp_path / "prep")).transform(ready["validation"])
    first = vectors.orderBy("order_id").select("order_id", "features").collect()
    assert again.orderBy("order_id").select("order_id", "features").collect() == first
