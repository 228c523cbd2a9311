"""Order statistics without a global sort in one task.

The building block is ``prefix_sums``: rows are first aggregated to distinct keys (so that a value
held by a third of all rows is one row), then range-partitioned into even slices. Each slice is
summed on its own and shifted by the totals of the slices before it. Ranks, curves and cut positions are read
off the running counts. Quantiles need no running count of all values: a sketch brackets them, and one more pass counts the
values inside the brackets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderflow.session import pin

SLICE, ALL = "_slice", "_all"
#: Rank error of a sketch is 1 / ACCURACY of its rows.
ACCURACY = 10_000
#: Open bounds of a bracket; NaN is the largest number.
NONE_BELOW, ALL_BELOW = float("-inf"), float("nan")


def _slices(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    measures: Mapping[str, Column | str],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add ``<m>_before`` (sum over all earlier rows) and ``<m>_total`` for every measure ``m``.

    ``order`` must identify rows inside a ``within`` group; callers aggregate to distinct keys first.
    The slice of a row comes from a sampled range partitioning, so it is pinned before it is used
    twice: once for the slice totals, once for the running sums.
    """
    named = df.withColumns({m: F.col(c) if isinstance(c, str) else c for m, c in measures.items()})
    sliced = pin(
        named.repartitionByRange(_slices(df), *[F.asc(w) for w in within], *order).withColumn(
            SLICE, F.struct(*within, F.spark_partition_id().alias("part"))
        )
    )
    # One row per slice and group. With groups the windows below are spread by group.
    totals = sliced.groupBy(SLICE).agg(*[F.sum(m).alias(f"{m}_slice") for m in measures])
    over_group = Window.partitionBy(*[F.col(f"{SLICE}.{w}") for w in within])
    earlier = over_group.orderBy(f"{SLICE}.part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        SLICE,
        *[F.coalesce(F.sum(f"{m}_slice").over(earlier), F.lit(0)).alias(f"{m}_offset") for m in measures],
        *[F.sum(f"{m}_slice").over(over_group).alias(f"{m}_total") for m in measures],
    )
    # The join and the window share one shuffle: both are keyed by the slice.
    in_slice = Window.partitionBy(SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = {
        f"{m}_before": F.col(f"{m}_offset") + F.coalesce(F.sum(m).over(in_slice), F.lit(0)) for m in measures
    }
    return sliced.join(offsets, SLICE).withColumns(before).drop(SLICE, *[f"{m}_offset" for m in measures])


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-missing values of each group and how many rows hold them."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def ranked_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Value counts with the number of rows before each value (``n_before``), the group's row count
    (``n_total``) and the shared average rank of the value (``average_rank``)."""
    counted = prefix_sums(value_counts(df, value, by), [F.asc(value)], {"n": "n"}, by)
    return counted.withColumn("average_rank", F.col("n_before") + (F.col("n") + 1) / F.lit(2.0))


def quantiles_of_ranked(
    ranked: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str] = (), missed: Column | None = None
) -> DataFrame:
    """Exact linearly interpolated quantiles, one column per name, from ``ranked_values`` output; ``missed`` stands for a
    position without a value."""
    v = F.col(value).cast("double")
    last = F.col("n_before") + F.col("n") - 1
    picks = []
    for name, p in probabilities.items():
        position = (F.col("n_total") - 1) * F.lit(float(p))
        for end, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            picks.append(F.max(F.when(at.between(F.col("n_before"), last), v)).alias(f"_{end}_{name}"))
    grouped = ranked.groupBy(*by).agg(F.max("n_total").alias("_n"), *picks)
    columns = []
    for name, p in probabilities.items():
        position = (F.col("_n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        if missed is not None:
            lo, hi = (F.when(c.isNull() & (F.col("_n") > 0), missed).otherwise(c) for c in (lo, hi))
        columns.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return grouped.select(*by, *columns)


def brackets(
    df: DataFrame, value: str, probabilities: Mapping[str, float], by: Sequence[str] = (), accuracy: int = ACCURACY, **more: Column
) -> DataFrame:
    """(by, n, low, high, more): for each probability two values that enclose the quantile, by a mergeable sketch of bounded rank
    error, in one aggregation with any further aggregates ``more``. Groups of at most 4 * accuracy rows are kept whole: there the
    bounds are open."""
    v, error = F.col(value).cast("double"), 1 / accuracy
    at = [(max(p - 2 * error, 0.0), min(p + 2 * error, 1.0)) for p in probabilities.values()]
    sketch = F.percentile_approx(v, [lo for lo, _ in at] + [hi for _, hi in at], accuracy)
    found = df.groupBy(*by).agg(F.count(v).alias("_n"), sketch.alias("_q"), *[c.alias(n) for n, c in more.items()])
    whole = F.col("_n") <= 4 * accuracy
    low = [F.when(whole | F.lit(lo == 0), NONE_BELOW).otherwise(F.col("_q")[i]) for i, (lo, _) in enumerate(at)]
    high = [F.when(whole | F.lit(hi == 1), ALL_BELOW).otherwise(F.col("_q")[len(at) + i]) for i, (_, hi) in enumerate(at)]
    return found.select(*by, F.col("_n").alias("n"), F.array(*low).alias("low"), F.array(*high).alias("high"), *more)


def quantiles_in_brackets(df: DataFrame, value: str, found: DataFrame, probabilities: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    """Exact linearly interpolated quantiles, one column per name, by one counting pass: a value inside a bracket is counted by
    itself, all values between two brackets as one. ``found`` is the pinned result of ``brackets`` for the same rows."""
    v, names = F.col("_v"), [f"_by{i}" for i in range(len(by))]
    known = found.select(*[F.col(b).alias(n) for b, n in zip(by, names, strict=True)], "low", "high")
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    met = rows.join(known, reduce(and_, [F.col(b).eqNullSafe(F.col(n)) for b, n in zip(by, names, strict=True)]))
    each = range(len(probabilities))
    inside = reduce(or_, [(v >= F.col("low")[i]) & (v <= F.col("high")[i]) for i in each])
    below = F.greatest(F.lit(NONE_BELOW), *[F.when(F.col("high")[i] < v, F.col("high")[i]) for i in each])
    counted = (
        met.select(*by, F.when(inside, v).otherwise(below).alias("_at"), (~inside).alias("_between"))
        .groupBy(*by, "_at", "_between")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_at", "_between").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumns({"n_before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "n_total": F.sum("n").over(group)})
    missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    return quantiles_of_ranked(ranked.withColumn("_at", F.when(~F.col("_between"), F.col("_at"))), "_at", probabilities, by, missed)


def quantiles(
    df: DataFrame,
    value: str,
    probabilities: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Quantiles per group: exact by default, or one approximate pass when ``accuracy`` is given.

    Exact ones take two passes, neither of which shuffles or stores the rows: a sketch that brackets each quantile (one row a
    group is pinned), and a count of the values inside the brackets, 4 / ACCURACY of a large group's rows for each quantile."""
    if accuracy is None:
        present, groups = df.where(F.col(value).isNotNull()), list(by) or [ALL]
        if not by:
            present = present.withColumn(ALL, F.lit(0))
        found = pin(brackets(present, value, probabilities, groups, ACCURACY))
        return quantiles_in_brackets(present, value, found, probabilities, groups).select(*by, *probabilities)
    sketch = F.percentile_approx(F.col(value).cast("double"), list(probabilities.values()), accuracy)
    sketched = df.where(F.col(value).isNotNull()).groupBy(*by).agg(sketch.alias("_q"))
    return sketched.select(*by, *[F.col("_q")[i].alias(name) for i, name in enumerate(probabilities)])


def medians(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return quantiles(df, value, {name: 0.5}, by)


def value_at_position(df: DataFrame, value: str, positions: Mapping[str, int]) -> dict[str, tuple]:
    """For each 0-based position in ascending order (missing last): the value found there, the rows
    before that value and the rows holding it. Reaches the driver with one row per position."""
    counted = df.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    ranked = prefix_sums(counted, [F.asc_nulls_last(value)], {"n": "n"})
    last = F.col("n_before") + F.col("n") - 1
    hit = [F.lit(int(p)).between(F.col("n_before"), last) for p in positions.values()]
    found = ranked.where(_any(hit)).select(value, "n_before", "n").collect()
    return {
        name: next(((r[0], r[1], r[2]) for r in found if r[1] <= p < r[1] + r[2]), None)
        for name, p in positions.items()
    }


def _any(conditions: list[Column]) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result | c
    return result
