"""Distribution change between two frames, for all columns of a kind in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.columns import cells_above, number_sql
from orderflow.operators.ordering import quantiles
from orderflow.operators.profile import long_categories, long_numbers

# Ten bins from the first frame and the weight given to an empty bin.
DECILES = {f"d{i}": i / 10 for i in range(11)}
EMPTY_BIN = 1e-6
SIDE = "_late"


def _stacked(train: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both frames under each other, marked 0 / 1, so that every statistic is a conditional sum."""
    return train.select(*columns, F.lit(0).alias(SIDE)).unionByName(other.select(*columns, F.lit(1).alias(SIDE)))


def decile_edges(train: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Distinct decile edges per column, learned from the first frame only (one row per column)."""
    edges = quantiles(long_numbers(train, columns), "value", DECILES, ["column_name"])
    return {r["column_name"]: sorted({r[d] for d in DECILES}) for r in edges.collect()}


def numeric_drift(train: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing rates, means, mean difference and population stability index of each column."""
    edges = decile_edges(train, columns)
    numbers = [f"{number_sql(c)} AS `{c}`" for c in columns]
    both = _stacked(train, other, columns).selectExpr(SIDE, *numbers)
    late = F.col(SIDE) == 1
    values = both.unpivot([SIDE], list(columns), "feature", "value")
    v = F.col("value")

    def rate(side):
        return F.sum(F.when(side & v.isNull(), 1).otherwise(0)) / F.nullif(F.count_if(side), F.lit(0))

    levels = values.groupBy("feature").agg(
        rate(~late).cast("double").alias("train_missing_rate"),
        rate(late).cast("double").alias("validation_missing_rate"),
        F.avg(F.when(~late, v)).alias("train_mean"),
        F.avg(F.when(late, v)).alias("validation_mean"),
    )
    # Open outer bins: only the inner edges matter, values beyond them stay in the first or last bin.
    bins = [cells_above(F.col(c), edges.get(c, [])[1:-1]).cast("int").alias(c) for c in columns]
    counts = (
        both.select(SIDE, *bins)
        .unpivot([SIDE], list(columns), "feature", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy("feature", "bin")
        .agg(F.count_if(~late).alias("before"), F.count_if(late).alias("after"))
    )
    totals = counts.groupBy("feature").agg(F.sum("before").alias("all_before"), F.sum("after").alias("all_after"))
    # At most ten bins per column, and one row per column in the totals.
    p = F.col("before") / F.col("all_before") + EMPTY_BIN
    q = F.col("after") / F.col("all_after") + EMPTY_BIN
    known = F.max("all_before").isNotNull() & (F.max("all_before") > 0) & (F.max("all_after") > 0)
    index = (
        counts.join(F.broadcast(totals.where("all_before > 0 and all_after > 0")), "feature")
        .groupBy("feature")
        .agg(F.when(known, F.sum((q - p) * F.ln(q / p))).alias("population_stability_index"))
    )
    return levels.join(index, "feature", "left").withColumn(
        "mean_difference", F.col("validation_mean") - F.col("train_mean")
    )


def categorical_drift(train: DataFrame, other: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing rates, total variation distance and rate of categories the first frame never had."""
    both = _stacked(train, other, columns)
    late = F.col(SIDE) == 1
    gaps = both.groupBy(SIDE).agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    missing = gaps.unpivot([SIDE], list(columns), "feature", "rate").groupBy("feature").agg(
        F.max(F.when(~late, F.col("rate"))).alias("train_missing_rate"),
        F.max(F.when(late, F.col("rate"))).alias("validation_missing_rate"),
    )
    counts = (
        long_categories(both, columns, [SIDE])
        .groupBy("feature", "category")
        .agg(F.count_if(~late).alias("before"), F.count_if(late).alias("after"))
    )
    totals = counts.groupBy("feature").agg(F.sum("before").alias("all_before"), F.sum("after").alias("all_after"))
    # One row per column in the totals; the categories themselves stay distributed.
    gap = F.abs(F.col("before") / F.col("all_before") - F.col("after") / F.col("all_after"))
    unseen = F.when(F.col("before") == 0, F.col("after") / F.col("all_after")).otherwise(0.0)
    distance = (
        counts.join(F.broadcast(totals.where("all_before > 0 and all_after > 0")), "feature")
        .groupBy("feature")
        .agg((F.sum(gap) * 0.5).alias("total_variation_distance"), F.sum(unseen).alias("validation_unseen_rate"))
    )
    return missing.join(distance, "feature", "left")


def drift_summary(train: DataFrame, other: DataFrame, numerical: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Numeric and categorical drift in one table with a shared score column for ranking."""
    numbers = numeric_drift(train, other, numerical).select(
        "feature",
        F.lit("numeric").alias("feature_type"),
        "train_missing_rate",
        "validation_missing_rate",
        "train_mean",
        "validation_mean",
        "mean_difference",
        F.col("population_stability_index").alias("drift_score"),
        F.lit(0.0).alias("validation_unseen_rate"),
    )
    categories = categorical_drift(train, other, categorical).select(
        "feature",
        F.lit("categorical").alias("feature_type"),
        "train_missing_rate",
        "validation_missing_rate",
        F.col("total_variation_distance").alias("drift_score"),
        "validation_unseen_rate",
    )
    return numbers.unionByName(categories, allowMissingColumns=True)
