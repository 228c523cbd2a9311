"""Summaries of columns and of the targets by group.

Columns are unpivoted to (column, value) so that one job profiles all of them, whatever their
number; no row is shuffled or stored for an order statistic.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions.columns import count_where, finite, number_sql
from orderflow.functions.derived import MISSING
from orderflow.operators.ordering import ACCURACY, brackets, prefix_sums, quantiles, quantiles_in_brackets, quantiles_of_ranked
from orderflow.session import pin

# Percentiles of the numeric summary, the outlier fence and the number of top groups.
PERCENTILES = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
FENCE = 1.5
TOP_GROUPS = 12
QUARTILES = {"e0": 0.0, "e1": 0.25, "e2": 0.5, "e3": 0.75, "e4": 1.0}
FEW_VALUES = 4
# Names the targets go by while features are unpivoted (a target may be one of the features).
LABEL, MEASURE = "_label", "_measure"
#: The bin of a row's measure, and about how many bins there are: a median is looked for in two of them at most.
BIN, BINS = "_bin", 500


def long_numbers(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, column_name, value) rows; anything that is not a finite number is NULL."""
    numbers = df.selectExpr(*keep, *[f"{number_sql(c)} AS `{c}`" for c in columns])
    return numbers.unpivot(list(keep), list(columns), "column_name", "value")


def long_categories(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, feature, category) rows of text values with a marker for a gap."""
    texts = df.selectExpr(*keep, *[f"coalesce(CAST(`{c}` AS STRING), '{MISSING}') AS `{c}`" for c in columns])
    return texts.unpivot(list(keep), list(columns), "feature", "category")


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value and their percentage of all rows."""
    counted = frequency(df, column)
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        column, "row_count", (F.col("row_count") * 100.0 / total.scalar()).cast("double").alias("percentage")
    )


def date_range(df: DataFrame, time: str) -> DataFrame:
    """Earliest and latest time and the number of calendar years covered."""
    return df.agg(
        F.min(time).alias("earliest"), F.max(time).alias("latest"), F.count_distinct(F.year(time)).alias("years")
    )


def target_distribution(df: DataFrame, measure: str) -> DataFrame:
    """Minimum, mean, exact median and 95th percentile, maximum."""
    values = df.select(F.lit(measure).alias("measure"), finite(measure).alias("value"))
    spread = quantiles(values, "value", {"median_value": 0.5, "p95_value": 0.95}, ["measure"])
    basic = df.agg(
        F.lit(measure).alias("measure"),
        F.min(measure).alias("minimum_value"),
        F.avg(measure).alias("mean_value"),
        F.max(measure).alias("maximum_value"),
    )
    return basic.join(spread, "measure", "left")


def numerical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts, moments, percentiles, bias-corrected skewness, outliers and negatives per column.

    Three passes over the values, each summed up to one row per column before it is shuffled: moments together with the sketch
    that brackets the percentiles, the values inside the brackets, and the values beyond the fences."""
    values = long_numbers(df, columns)
    v, name = F.col("value"), "column_name"
    found = brackets(
        values,
        "value",
        PERCENTILES,
        [name],
        missing_count=count_where(v.isNull()),
        mean=F.avg(v),
        std=F.stddev_samp(v),
        shape=F.skewness(v),
        minimum=F.min(v),
        maximum=F.max(v),
        negative_count=count_where(v < 0),
    )
    found = pin(found)
    spread = pin(quantiles_in_brackets(values, "value", found, PERCENTILES, [name]))
    width = F.col("p75") - F.col("p25")
    outside = (v < F.col("p25") - width * FENCE) | (v > F.col("p75") + width * FENCE)
    # One row per column: the last look at the values joins a table of the columns' own quartiles.
    beyond = values.join(F.broadcast(spread.select(name, "p25", "p75")), name).groupBy(name).agg(count_where(outside).alias("iqr_outlier_count"))
    rows = F.col("n").cast("double")
    corrected = F.sqrt(rows * (rows - 1)) / (rows - 2) * F.col("shape")
    skewness = F.when(rows > 2, F.when(F.col("minimum") == F.col("maximum"), 0.0).otherwise(corrected))
    described = found.join(spread, name, "left").join(beyond, name, "left")
    return described.select(
        name,
        F.col("n").alias("non_missing_count"),
        "missing_count",
        "mean",
        F.when(rows > 1, F.col("std")).alias("std"),
        "minimum",
        *PERCENTILES,
        "maximum",
        skewness.alias("skewness"),
        F.coalesce("iqr_outlier_count", F.lit(0)).alias("iqr_outlier_count"),
        "negative_count",
    )


def categorical_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, rate and rank of every category of every column (ties ranked by the category)."""
    counts = long_categories(df, columns).groupBy("feature", "category").agg(F.count(F.lit(1)).alias("row_count"))
    placed = prefix_sums(
        counts, [F.desc("row_count"), F.asc("category")], {"place": F.lit(1), "held": "row_count"}, ["feature"]
    )
    return placed.select(
        "feature",
        "category",
        "row_count",
        (F.col("row_count") / F.col("held_total")).alias("rate"),
        (F.col("place_before") + 1).alias("rank"),
    )


def suspicious_columns(summary: DataFrame) -> DataFrame:
    """Columns with negative values, from a numerical summary."""
    return summary.where((F.col("minimum") < 0) | (F.col("negative_count") > 0))


# --- targets by group ---------------------------------------------------------------------------


def in_bins(df: DataFrame, measure: str) -> DataFrame:
    """Add BIN: which of at most BINS bins of about equally many rows holds the measure (NULL without one). Equal values share a bin
    and the bins are in the order of their values, whatever the sketch that parts them finds. Done before rows become cells, so that
    a row is looked up once."""
    v = F.col(measure).cast("double")
    found = df.agg(F.percentile_approx(v, [i / BINS for i in range(1, BINS)], ACCURACY)).first()[0] or []
    cuts = sorted({c for c in found if math.isfinite(c)})
    # NaN falls into one more bin above the last.
    place = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_known", outputCol="_place", handleInvalid="keep")
    placed = place.transform(df.withColumn("_known", F.coalesce(v, F.lit(0.0))))
    return placed.withColumn(BIN, F.when(v.isNotNull(), F.col("_place").cast("int"))).drop("_known", "_place")


def grouped_targets(
    df: DataFrame, by: Sequence[str], label: str, measure: str, accuracy: int | None = None
) -> DataFrame:
    """Orders, rate of the label, mean and median measure of each group.

    The exact median takes two passes of plain sums: counts per group and bin of the measure give all but the median and the bins
    that hold it, then the values of those bins are counted. No sketch is kept for a group."""
    if accuracy is not None:
        groups = df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("order_count"),
            F.avg(label).alias("late_delivery_rate"),
            F.avg(measure).alias("mean_actual_delivery_days"),
        )
        middle = quantiles(df, measure, {"median_actual_delivery_days": 0.5}, by, accuracy)
        return groups.join(middle, list(by), "left")
    rows = df if BIN in df.columns else in_bins(df, measure)
    sums = {"rows": F.count(F.lit(1)), "labels": F.count(label), "late": F.sum(label), "n": F.count(measure), "days": F.sum(measure)}
    # At most BINS + 2 rows a group.
    counted = pin(rows.groupBy(*by, BIN).agg(*[c.alias(n) for n, c in sums.items()]))
    groups = counted.groupBy(*by).agg(
        F.sum("rows").alias("order_count"),
        F.try_divide(F.sum("late").cast("double"), F.sum("labels")).alias("late_delivery_rate"),
        F.try_divide(F.sum("days").cast("double"), F.sum("n")).alias("mean_actual_delivery_days"),
    )
    group = Window.partitionBy(*by)
    before = F.coalesce(F.sum("n").over(group.orderBy(BIN).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counted.where(F.col(BIN).isNotNull()).withColumns({"_before": before, "n_total": F.sum("n").over(group)})
    last, half = F.col("_before") + F.col("n") - 1, (F.col("n_total") - 1) / F.lit(2)
    holds = F.floor(half).between(F.col("_before"), last) | F.ceil(half).between(F.col("_before"), last)
    # One or two bins a group, which lie side by side.
    middle = placed.where(holds).select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], F.col(BIN).alias("_in"), "_before", "n_total")
    same = reduce(and_, [F.col(b) == F.col(f"_by{i}") for i, b in enumerate(by)])
    # Medians of groups lie near each other: rows of all other bins end at the scan, before they become cells.
    some = [r["_in"] for r in middle.select("_in").distinct().collect()]
    met = rows.where(F.col(BIN).isin(some)).join(F.broadcast(middle), same & (F.col(BIN) == F.col("_in")))
    values = met.groupBy(*by, measure).agg(F.count(F.lit(1)).alias("n"), F.min("_before").alias("_before"), F.max("n_total").alias("n_total"))
    earlier = F.sum("n").over(group.orderBy(measure).rowsBetween(Window.unboundedPreceding, -1))
    ranked = values.withColumn("n_before", F.min("_before").over(group) + F.coalesce(earlier, F.lit(0)))
    missed = F.raise_error(F.lit("a median lies outside its bins")).cast("double")
    medians = quantiles_of_ranked(ranked, measure, {"median_actual_delivery_days": 0.5}, by, missed)
    return groups.join(medians, list(by), "left")


def target_by_category(df: DataFrame, columns: Sequence[str], label: str, measure: str) -> DataFrame:
    """Both targets for every category of every column, in one job."""
    targets = df.select(F.col(label).alias(LABEL), F.col(measure).alias(MEASURE), *columns)
    long = long_categories(in_bins(targets, MEASURE), columns, [LABEL, MEASURE, BIN])
    return grouped_targets(long, ["feature", "category"], LABEL, MEASURE).withColumn("group_type", F.lit("category"))


def quartile_edges(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float]]:
    """Distinct quartile edges of each column; columns with fewer than four values keep those values.

    Reaches the driver with one row per column.
    """
    values, v, name = long_numbers(df, columns).where("value IS NOT NULL"), F.col("value"), "column_name"
    found = pin(brackets(values, "value", QUARTILES, [name], lowest=F.min(v), highest=F.max(v)))
    edges = quantiles_in_brackets(values, "value", found, QUARTILES, [name])
    # The sketch holds values of the column: where four of them differ, no more need be looked at.
    ends = {r[name]: r for r in found.collect()}
    shown = {c: {x for x in (r["lowest"], r["highest"], *r["low"], *r["high"]) if math.isfinite(x)} for c, r in ends.items()}
    unsure = [c for c, seen in shown.items() if len(seen) < FEW_VALUES]
    many = {c: c not in unsure for c in ends}
    if unsure:
        # Four values are two different ones between the lowest and the highest.
        bounds = F.broadcast(found.select(name, "lowest", "highest"))  # one row per column
        between = long_numbers(df, unsure).join(bounds, name).where((v > F.col("lowest")) & (v < F.col("highest")))
        many |= {r[name]: r["many"] for r in between.groupBy(name).agg((F.min(v) < F.max(v)).alias("many")).collect()}
    return {row[name]: sorted({row[e] for e in QUARTILES}) if many[row[name]] else [] for row in edges.collect()}


def target_by_quartile(df: DataFrame, columns: Sequence[str], label: str, measure: str) -> DataFrame:
    """Both targets by quartile of each numeric column, or by value where it has fewer than four. A quartile has its bounds:
    above ``lower_bound`` (the first one: from there) up to ``upper_bound``."""
    edges = quartile_edges(df, columns)
    quartiled = [c for c in columns if edges.get(c)]
    valued = [c for c in columns if c in edges and not edges[c]]
    used, parted = [*quartiled, *valued], F.col("_position") < len(quartiled)
    targets = in_bins(df.select(F.col(label).alias(LABEL), F.col(measure).alias(MEASURE), *used), MEASURE)
    # A cell is a position among the columns and a number: groups are told apart by numbers, and named when they are few.
    cells = targets.select(LABEL, MEASURE, BIN, F.posexplode(F.array(*[finite(c) for c in used])).alias("_position", "_value"))
    inner = [[*edges[c][1:-1], math.inf, math.inf, math.inf][:3] for c in quartiled]
    value = F.col("_value")

    def edge(i: int) -> Column:
        return F.get(F.array(*[F.lit(e[i]) for e in inner]), F.col("_position"))

    above = reduce(add, [(value > edge(i)).cast("int") for i in range(3)]) if quartiled else F.lit(0)
    cell = F.when(parted, F.coalesce((above + 1).cast("double"), F.lit(0.0))).otherwise(F.coalesce(value, F.lit(-1.0)))
    grouped = grouped_targets(cells.select(LABEL, MEASURE, BIN, "_position", cell.alias("_cell")), ["_position", "_cell"], LABEL, MEASURE)
    bucket = F.when(F.col("_cell") == 0, MISSING).otherwise(F.concat(F.lit("q"), F.col("_cell").cast("int").cast("string")))
    grouped = grouped.select(
        F.get(F.array(*[F.lit(c) for c in used]), F.col("_position")).alias("feature"),
        F.when(parted, bucket).otherwise(F.col("_cell").cast("string")).alias("category"),
        "order_count",
        "late_delivery_rate",
        "mean_actual_delivery_days",
        "median_actual_delivery_days",
        F.when(parted, "quartile").otherwise("value").alias("group_type"),
    )
    bounds = [(c, f"q{i + 1}", lo, hi) for c in quartiled for i, (lo, hi) in enumerate(zip(edges[c], edges[c][1:]))]
    frame = df.sparkSession.createDataFrame(bounds, "feature string, category string, lower_bound double, upper_bound double")
    return grouped.join(F.broadcast(frame), ["feature", "category"], "left")  # at most four rows per column


def top_categories(df: DataFrame, column: str, k: int = TOP_GROUPS) -> DataFrame:
    """The ``k`` most frequent values (ties by value)."""
    return frequency(df.where(F.col(column).isNotNull()), column).orderBy(F.desc("row_count"), F.asc(column)).limit(k)


def target_by_top_category(
    df: DataFrame, column: str, label: str, measure: str, k: int = TOP_GROUPS, other: str = "other_route"
) -> DataFrame:
    """Both targets for the ``k`` most frequent values; every other row counts under one name."""
    # k rows by construction, so the broadcast cannot grow with the data.
    top = F.broadcast(top_categories(df, column, k).select(column, F.lit(True).alias("_top")))
    grouped = df.join(top, column, "left").withColumn("category", F.when(F.col("_top"), F.col(column)).otherwise(other))
    return grouped_targets(grouped, ["category"], label, measure).select(
        F.lit(column).alias("feature"), "*", F.lit("top_route").alias("group_type")
    )


def group_chart(df: DataFrame, column: str, label: str, measure: str, k: int = TOP_GROUPS) -> DataFrame:
    """Orders, rate and mean days of the ``k`` largest groups."""
    groups = df.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("orders"), F.avg(label).alias("late_rate"), F.avg(measure).alias("delivery_days")
    )
    return groups.orderBy(F.desc("orders"), F.asc(column)).limit(k)


def monthly_trend(df: DataFrame, time: str, label: str, measure: str) -> DataFrame:
    """Orders, rate and mean days per calendar month."""
    return df.groupBy(F.date_format(time, "yyyy-MM").alias("period")).agg(
        F.count(F.lit(1)).alias("orders"), F.avg(label).alias("late_rate"), F.avg(measure).alias("mean_days")
    )


# --- histograms ---------------------------------------------------------------------------------


def histogram(df: DataFrame, columns: Mapping[str, int], clip: float | None = None) -> DataFrame:
    """Equal-width bins between minimum and maximum (the last bin is closed), empty bins included.

    ``columns`` maps names to bin counts. ``clip`` caps values at that quantile before binning.
    The range of each column (one row) is read first, so the bins are plain arithmetic on the scan.
    """
    names = list(columns)
    upper: dict[str, float] = {}
    if clip is not None:
        tops = quantiles(long_numbers(df, names), "value", {"top": clip}, ["column_name"])
        upper = {r["column_name"]: r["top"] for r in tops.collect()}
    numbers = df.select(*[finite(c).alias(c) for c in names])
    if upper:
        numbers = numbers.withColumns({c: F.when(F.col(c) > top, top).otherwise(F.col(c)) for c, top in upper.items()})
    span = numbers.agg(
        *[F.min(c).alias(f"lo_{c}") for c in names], *[F.max(c).alias(f"hi_{c}") for c in names]
    ).first()
    known = [c for c in names if span[f"lo_{c}"] is not None]

    def bin_of(c: str) -> Column:
        lo, hi, bins = span[f"lo_{c}"], span[f"hi_{c}"], columns[c]
        if lo == hi:  # a single value sits in the middle of a unit-wide range
            lo, hi = lo - 0.5, hi + 0.5
        place = F.floor((F.col(c) - F.lit(lo)) / F.lit(hi - lo) * bins)
        # The maximum belongs to the last bin (`least` would also pull missing values into it).
        return F.when(place >= bins, bins - 1).otherwise(place).cast("bigint").alias(c)

    filled = numbers.select(*[bin_of(c) for c in known]).unpivot([], known, "column_name", "bin")
    counts = filled.where(F.col("bin").isNotNull()).groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("row_count"))
    grid = [
        (c, b, lo + (hi - lo) * b / columns[c], lo + (hi - lo) * (b + 1) / columns[c])
        for c in known
        for lo, hi in [_range(span[f"lo_{c}"], span[f"hi_{c}"])]
        for b in range(columns[c])
    ]
    frame = df.sparkSession.createDataFrame(grid, "column_name string, bin bigint, lower double, upper double")
    return frame.join(counts, ["column_name", "bin"], "left").fillna(0, ["row_count"])


def _range(lo: float, hi: float) -> tuple[float, float]:
    return (lo - 0.5, hi + 0.5) if lo == hi else (lo, hi)
