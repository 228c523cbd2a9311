"""Chronological split by cut keys and the checks that belong to it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.operators.ordering import medians, value_at_position

# Split names and the cumulative share of rows at which each part ends.
DEFAULT_CUTS = {"train": 0.70, "validation": 0.85}
LAST_PART = "test"


def chronological_split(
    df: DataFrame,
    time: str,
    key: str,
    cuts: Mapping[str, float] = DEFAULT_CUTS,
    last: str = LAST_PART,
) -> DataFrame:
    """Add a ``split`` column: the oldest rows are the first part, ties in time are ordered by ``key``.

    Only the cut keys are searched for (counts per distinct time, then per key inside the one time
    value that is cut); the split itself is a filter on the scan. ``key`` must be unique.
    """
    total = df.count()
    positions = {name: int(total * share) for name, share in cuts.items()}
    at_time = value_at_position(df.select(time), time, positions)
    split: Column | None = None
    for name, position in positions.items():
        before = _strictly_before(df, time, key, position, at_time[name])
        split = F.when(before, name) if split is None else split.when(before, name)
    return df.withColumn("split", split.otherwise(last))


def _strictly_before(df: DataFrame, time: str, key: str, position: int, found: tuple | None) -> Column:
    """Condition that holds for exactly the first ``position`` rows in (time, key) order."""
    if found is None:  # the cut is past the last row
        return F.lit(True)
    moment, rows_before, _ = found
    offset = position - rows_before
    at = _literal(df, time, moment)
    same_moment = F.col(time).isNull() if moment is None else F.col(time) == at
    earlier = F.col(time).isNotNull() if moment is None else F.col(time) < at
    if offset == 0:
        return F.coalesce(earlier, F.lit(False))
    tied = df.where(same_moment).select(key)
    cut_key, keys_before, holders = value_at_position(tied, key, {"cut": offset})["cut"]
    if keys_before != offset:
        raise ValueError(f"{key} is not unique: {holders} rows hold {cut_key!r} at the cut")
    return F.coalesce(earlier | (same_moment & (F.col(key) < _literal(df, key, cut_key))), F.lit(False))


def _literal(df: DataFrame, column: str, value) -> Column:
    """The value as a literal of the column's own type (a plain datetime literal would carry a zone)."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType) and value is not None:
        return F.lit(str(value)).cast(kind)
    return F.lit(value)


def split_frames(df: DataFrame, names: Sequence[str] = (*DEFAULT_CUTS, LAST_PART)) -> dict[str, DataFrame]:
    return {name: df.where(F.col("split") == name).drop("split") for name in names}


def split_summary(
    df: DataFrame,
    time: str,
    key: str,
    label: str | None = None,
    measure: str | None = None,
    features: Sequence[str] = (),
) -> DataFrame:
    """Rows, distinct keys, time range, positives, mean and median measure, missing cells per split."""
    aggregates = [
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(key).alias("distinct_keys"),
        F.min(time).alias("start_time"),
        F.max(time).alias("end_time"),
    ]
    if label:
        aggregates += [
            F.sum(F.col(label).cast("bigint")).alias("positives"),
            (F.lit(100.0) * F.sum(label) / F.count(F.lit(1))).cast("double").alias("positive_percentage"),
        ]
    if measure:
        aggregates.append(F.avg(measure).alias("mean_measure"))
    if features:
        empty = " + ".join(f"CAST(`{c}` IS NULL AS BIGINT)" for c in features)
        aggregates.append(F.expr(f"sum({empty})").alias("missing_cells"))
    summary = df.groupBy("split").agg(*aggregates)
    if measure:
        summary = summary.join(medians(df, measure, ["split"], "median_measure"), "split", "left")
    return summary


def split_overlap(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur in more than one part (empty when the split is clean)."""
    return (
        df.groupBy(key)
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"), F.count(F.lit(1)).alias("row_count"))
        .where(F.col("first_split") != F.col("last_split"))
    )


def check_split(df: DataFrame, time: str, key: str, names: Sequence[str] = (*DEFAULT_CUTS, LAST_PART)) -> DataFrame:
    """One row per neighbouring pair of parts: whether time order holds (equal times are allowed)."""
    bounds = {r["split"]: r for r in df.groupBy("split").agg(F.min(time).alias("lo"), F.max(time).alias("hi")).collect()}
    pairs = [(a, b) for a, b in zip(names, names[1:]) if a in bounds and b in bounds]
    overlaps = split_overlap(df, key).limit(1).count()
    rows = [(a, b, bounds[a]["hi"] <= bounds[b]["lo"], overlaps == 0) for a, b in pairs]
    return df.sparkSession.createDataFrame(
        rows, "earlier string, later string, in_order boolean, keys_disjoint boolean"
    )
