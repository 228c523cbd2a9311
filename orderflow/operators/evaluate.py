"""Classification and regression metrics as DataFrames.

Scores are aggregated to distinct values first; curves come from distributed running counts, and
threshold tables from counts per threshold interval (never thresholds times rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.operators.ordering import medians, prefix_sums

# Candidate thresholds 0.05 ... 0.95 and the day windows of the regression report.
THRESHOLDS = [round(0.05 + 0.01 * i, 2) for i in range(91)]
DEFAULT_THRESHOLD = 0.5
DAY_WINDOWS = (2.0, 5.0, 7.0)


def predict_class(probability: Column | str, threshold: float = DEFAULT_THRESHOLD) -> Column:
    p = F.col(probability) if isinstance(probability, str) else probability
    return (p >= F.lit(float(threshold))).cast("int")


# --- counts and the metrics that follow from them -----------------------------------------------


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("true_negative"),
        F.count_if((y == 0) & (p == 1)).alias("false_positive"),
        F.count_if((y == 1) & (p == 0)).alias("false_negative"),
        F.count_if((y == 1) & (p == 1)).alias("true_positive"),
    )


def _share(part: Column, whole: Column) -> Column:
    """Ratio with the zero-division rule of the metrics: nothing divided by nothing is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def metrics_of(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    return {
        "precision": _share(tp, tp + fp),
        "recall": _share(tp, tp + fn),
        "f1_score": _share(2 * tp, 2 * tp + fp + fn),
        "accuracy": _share(tp + tn, tp + tn + fp + fn),
    }


COUNTS = ("true_negative", "false_positive", "false_negative", "true_positive")


def with_metrics(counts: DataFrame) -> DataFrame:
    """Add precision, recall, F1 and accuracy to a frame that holds the four counts."""
    return counts.withColumns(metrics_of(*[F.col(c) for c in COUNTS]))


def classification_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return with_metrics(confusion_matrix(df, label, prediction, by))


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per class, macro and weighted precision, recall, F1 and support, and the accuracy."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    n = tn + fp + fn + tp
    late, on_time = metrics_of(tn, fp, fn, tp), metrics_of(tp, fn, fp, tn)
    names = ("precision", "recall", "f1_score")
    support = {"0": tn + fp, "1": fn + tp}

    def line(group: str, values: dict[str, Column], rows: Column) -> Column:
        cells = [values[m].alias(m) for m in names]
        return F.struct(F.lit(group).alias("class"), *cells, rows.cast("bigint").alias("support"))

    accuracy = late["accuracy"]
    macro = {m: (late[m] + on_time[m]) / 2 for m in names}
    weighted = {m: _share(late[m] * support["1"] + on_time[m] * support["0"], n) for m in names}
    lines = [
        line("0", on_time, support["0"]),
        line("1", late, support["1"]),
        line("accuracy", {m: accuracy for m in names}, n),
        line("macro avg", macro, n),
        line("weighted avg", weighted, n),
    ]
    return confusion_matrix(df, label, prediction).select(F.inline(F.array(*lines)))


# --- curves -------------------------------------------------------------------------------------


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives of each distinct score; score_coverage counts the rows left out."""
    return (
        df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isin(0, 1))
        .groupBy(*by, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))
    )


def ranked_scores(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Score counts with the positives and negatives above each score and in total."""
    measures = {"positives": "positives", "negatives": "negatives"}
    return prefix_sums(score_counts(df, score, label, by), [F.desc("score")], measures, by)


def roc_auc_column() -> Column:
    """Area from ranked scores, twice in whole pairs: exact in decimals whatever the order of summation."""
    wide = "decimal(19,0)"
    above = (2 * F.col("positives_before") + F.col("positives")).cast(wide)
    pairs = F.sum(F.col("negatives").cast(wide) * above).cast("double")
    p, n = F.max("positives_total").cast("double"), F.max("negatives_total").cast("double")
    return F.try_divide(pairs, F.lit(2.0) * p * n).alias("roc_auc")


def average_precision_column() -> Column:
    """Precision times recall gained, summed over ranked scores."""
    hits = F.col("positives_before") + F.col("positives")
    seen = hits + F.col("negatives_before") + F.col("negatives")
    gained = F.col("positives") / F.nullif(F.col("positives_total"), F.lit(0))
    return F.sum(gained * hits / seen).alias("average_precision")


def _class_totals() -> list[Column]:
    return [F.coalesce(F.max(f"{c}_total"), F.lit(0)).alias(c) for c in ("positives", "negatives")]


def score_coverage(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """How many rows the curves and the sweep can use, and why they leave the others out."""
    s, y = F.col(score).cast("double"), F.col(label)
    no_score, no_label = s.isNull() | F.isnan(s), y.isNull()
    other = ~no_label & ~y.isin(0, 1)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~no_score & ~no_label & ~other).alias("used_rows"),
        F.count_if(no_score).alias("rows_without_score"),
        F.count_if(no_label).alias("rows_without_label"),
        F.count_if(other).alias("rows_with_other_label"),
    )


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Exact area under the ROC curve (ties count half); NULL when only one class occurs."""
    return ranked_scores(df, score, label).agg(*_class_totals(), roc_auc_column())


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    """Sum of precision times recall gained, step by step; NULL without positives."""
    return ranked_scores(df, score, label).agg(average_precision_column())


def ranking_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC and average precision from one ranking of the scores, overall or per group."""
    ranked = ranked_scores(df, score, label, by)
    return ranked.groupBy(*by).agg(*_class_totals(), roc_auc_column(), average_precision_column())


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Precision and recall at every distinct score, with the base rate for comparison."""
    hits = F.col("positives_before") + F.col("positives")
    seen = hits + F.col("negatives_before") + F.col("negatives")
    rows = F.col("positives_total") + F.col("negatives_total")
    return ranked_scores(df, score, label).select(
        F.col("score").alias("threshold"),
        (hits / seen).alias("precision"),
        F.try_divide(hits.cast("double"), F.col("positives_total").cast("double")).alias("recall"),
        (F.col("positives_total") / rows).alias("base_rate"),
    )


# --- thresholds ---------------------------------------------------------------------------------


def threshold_sweep(df: DataFrame, score: str, label: str, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Counts and metrics at every threshold (class 1 when score >= threshold).

    Each row falls into one of the intervals between the sorted thresholds; the table of intervals
    (one more than there are thresholds) is then summed from the top.
    """
    cuts = sorted(thresholds)
    splits = [float("-inf"), *map(float, cuts), float("inf")]
    bucketizer = Bucketizer(splits=splits, inputCol="_score", outputCol="interval")
    known = df.select(F.col(score).cast("double").alias("_score"), label).where(
        F.col("_score").isNotNull() & ~F.isnan("_score")
    )
    counts = (
        bucketizer.transform(known)
        .groupBy(F.col("interval").cast("int").alias("interval"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    grid = df.sparkSession.createDataFrame(
        [(0, None), *[(i + 1, float(t)) for i, t in enumerate(cuts)]], "interval int, threshold double"
    )
    filled = grid.join(counts, "interval", "left").fillna(0, ["pos", "neg"])
    # len(thresholds) + 1 rows from here on.
    from_top = Window.orderBy(F.desc("interval")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = Window.orderBy(F.asc("interval")).rowsBetween(Window.unboundedPreceding, -1)
    counted = filled.select(
        "threshold",
        F.coalesce(F.sum("neg").over(below), F.lit(0)).alias("true_negative"),
        F.sum("neg").over(from_top).alias("false_positive"),
        F.coalesce(F.sum("pos").over(below), F.lit(0)).alias("false_negative"),
        F.sum("pos").over(from_top).alias("true_positive"),
    )
    return with_metrics(counted.where(F.col("threshold").isNotNull()))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Highest F1, then recall, then precision; the lowest threshold among equals."""
    order = [F.desc("f1_score"), F.desc("recall"), F.desc("precision"), F.asc("threshold")]
    return sweep.orderBy(*order).limit(1)


# --- regression ---------------------------------------------------------------------------------


def regression_metrics(df: DataFrame, actual: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, median absolute error, R2, shares within 2 / 5 / 7 days and the prediction range."""
    y, p = F.col(actual), F.col(prediction)
    errors = df.where(y.isNotNull() & p.isNotNull()).select(
        *by, y.cast("double").alias("y"), p.cast("double").alias("p"), F.abs(y - p).alias("e")
    )
    spread = F.var_pop("y") * F.count("y")
    basic = errors.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg("e").alias("mae"),
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"),
        (1 - F.try_divide(F.sum(F.col("e") * F.col("e")), spread)).alias("r2_score"),
        *[F.avg((F.col("e") <= d).cast("double")).alias(f"within_{int(d)}_days") for d in DAY_WINDOWS],
        F.min("p").alias("minimum_prediction"),
        F.max("p").alias("maximum_prediction"),
        F.avg("p").alias("average_prediction"),
    )
    middle = medians(errors, "e", by, "median_absolute_error")
    return basic.join(middle, list(by), "left") if by else basic.select("*", middle.scalar().alias("median_absolute_error"))


def change_against(old: float | None, new: float) -> dict[str, float | None]:
    """Absolute and relative change of a metric against an earlier run."""
    if old is None:
        return {"absolute_change": None, "percent_change": None}
    return {"absolute_change": new - old, "percent_change": 100.0 * (new - old) / old if old else None}
