import math

import pytest
from pyspark.sql import functions as F

from orderflow.operators import evaluate


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label int")


def test_average_precision_is_stepwise(spark):
    df = scored(spark, [(0.9, 1), (0.8, 0), (0.7, 1)])
    got = evaluate.ranking_metrics(df, "score", "label").first()
    assert round(got["average_precision"], 4) == 0.8333 and got["roc_auc"] == 0.5


def test_ties_count_half_and_layout_does_not_matter(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0.4).otherwise((F.hash("id") % 50) / 50.0).alias("score"),
        (F.hash(F.col("id") + 1) % 3 == 0).cast("int").alias("label"),
    )
    pdf = df.toPandas()
    pos, neg = pdf.score[pdf.label == 1].to_numpy(), pdf.score[pdf.label == 0].to_numpy()
    wins = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos) / (len(pos) * len(neg))
    for layout in (df.repartition(1), df.repartition(13)):
        assert math.isclose(evaluate.roc_auc(layout, "score", "label").first()["roc_auc"], wins)


def test_one_class_and_empty_input(spark):
    only = evaluate.ranking_metrics(scored(spark, [(0.5, 1), (0.2, 1)]), "score", "label").first()
    assert only["roc_auc"] is None and only["average_precision"] == 1.0
    none = evaluate.ranking_metrics(scored(spark, []), "score", "label").first()
    assert none["positives"] == 0 and none["roc_auc"] is None and none["average_precision"] is None


@pytest.mark.parametrize(
    "counts, expected",
    [
        ((10812, 2883, 317, 456), (0.13657, 0.58991, 0.22179, 0.77882)),
        ((12792, 903, 543, 230), (None, None, 0.24134, None)),
        ((5, 0, 0, 0), (0.0, 0.0, 0.0, 1.0)),
    ],
)
def test_metrics_follow_from_counts(spark, counts, expected):
    frame = spark.createDataFrame([counts], "true_negative long, false_positive long, false_negative long, true_positive long")
    got = evaluate.with_metrics(frame).first()
    for name, value in zip(("precision", "recall", "f1_score", "accuracy"), expected):
        if value is not None:
            assert round(got[name], 5) == value


def test_threshold_sweep_equals_direct_counts(spark):
    df = spark.range(400).select(((F.col("id") * 37) % 101 / 100.0).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    pdf = df.toPandas()
    sweep = evaluate.threshold_sweep(df, "score", "label").orderBy("threshold").collect()
    assert len(sweep) == 91 and sweep[0]["threshold"] == 0.05 and sweep[-1]["threshold"] == 0.95
    for r in sweep:
        hit = pdf.score >= r["threshold"]
        assert r["true_positive"] == (hit & (pdf.label == 1)).sum() and r["false_positive"] == (hit & (pdf.label == 0)).sum()
        assert r["true_negative"] == (~hit & (pdf.label == 0)).sum()
    best = evaluate.best_threshold(evaluate.threshold_sweep(df, "score", "label")).first()
    top = max(r["f1_score"] for r in sweep)
    assert best["f1_score"] == top and best["threshold"] == min(r["threshold"] for r in sweep if r["f1_score"] == top)


def test_classification_report(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, p int")
    got = {r["class"]: r for r in evaluate.classification_report(df, "label", "p").collect()}
    assert got["1"]["precision"] == 1.0 and got["1"]["recall"] == 0.5 and got["0"]["support"] == 2
    assert got["accuracy"]["f1_score"] == 0.75 and math.isclose(got["macro avg"]["precision"], (1 + 2 / 3) / 2)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 5.0), (9.0, 3.0), (None, 1.0)], "y double, p double")
    got = evaluate.regression_metrics(df, "y", "p").first()
    assert got["row_count"] == 3 and math.isclose(got["mae"], 7 / 3) and got["median_absolute_error"] == 1.0
    assert math.isclose(got["rmse"], math.sqrt(37 / 3)) and math.isclose(got["r2_score"], 1 - 37 / 32)
    assert math.isclose(got["within_2_days"], 2 / 3) and got["within_7_days"] == 1.0 and got["maximum_prediction"] == 5.0


def test_metrics_per_group(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("a", 0.1, 0), ("b", 0.1, 1), ("b", 0.9, 0)], "m string, score double, label int")
    got = {r["m"]: r["roc_auc"] for r in evaluate.ranking_metrics(df, "score", "label", ["m"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_change_against():
    assert evaluate.change_against(5.0, 4.0) == {"absolute_change": -1.0, "percent_change": -20.0}
    assert evaluate.change_against(None, 4.0)["percent_change"] is None


def test_rows_left_out_of_the_curves_are_counted(spark):
    df = scored(spark, [(0.9, 1), (0.1, 0), (None, 1), (float("nan"), 1), (0.5, None), (0.5, 2)])
    assert tuple(evaluate.score_coverage(df, "score", "label").first()) == (6, 2, 2, 1, 1)
    assert evaluate.roc_auc(df, "score", "label").first().asDict() == {"positives": 1, "negatives": 1, "roc_auc": 1.0}
