"""Keys, relationships, missing values and reconciled totals.

Each check aggregates by key before it joins or counts, so one key holding a large share of the
rows costs one partial row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.columns import count_where, exact_sum


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    child_columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def one_row(*frames: DataFrame) -> DataFrame:
    """Merge one-row frames side by side (their column names must differ)."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _status(ok: Column) -> Column:
    return F.when(ok, "PASSED").otherwise("FAILED").alias("status")


def _missing_sql(name: str, kind: str) -> str:
    empty = f"`{name}` IS NULL"
    return f"{empty} OR isnan(`{name}`)" if kind in ("double", "float") else empty


# --- profile and keys ---------------------------------------------------------------------------


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Name, rows and number of columns of every table."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).cast("bigint").alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing count and rate of each column, from one pass over the table."""
    kinds = dict(df.dtypes)
    names = list(columns or df.columns)
    counted = df.selectExpr("count(1) AS _rows", *[f"count_if({_missing_sql(c, kinds[c])}) AS `{c}`" for c in names])
    kind_of = F.create_map(*[F.lit(x) for c in names for x in (c, kinds[c])])
    return counted.unpivot(["_rows"], names, "column_name", "missing_count").select(
        "column_name",
        "missing_count",
        (F.col("missing_count") / F.nullif(F.col("_rows"), F.lit(0))).alias("missing_rate"),
        kind_of[F.col("column_name")].alias("data_type"),
    )


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """Column list of a table with position, type, rows and missing values."""
    place = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i + 1)])
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    return missing_values(df).select(
        F.lit(table).alias("table_name"),
        "column_name",
        place[F.col("column_name")].cast("bigint").alias("position"),
        "data_type",
        rows.scalar().alias("row_count"),
        "missing_count",
    )


def pk_check(df: DataFrame, keys: Sequence[str], name: str = "") -> DataFrame:
    """Rows, rows with a missing key part, distinct keys, duplicates after the first and all members."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0)
    return groups.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), zero).alias("row_count"),
        F.coalesce(F.sum(F.when(any_null, F.col("n"))), zero).alias("null_key_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), zero).alias("duplicate_rows_after_first"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), zero).alias("duplicate_rows_all"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def key_multiplicity(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur once, how many more often, and the most rows of one key."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("unique_keys"),
        count_where(F.col("n") == 1).alias("keys_with_one_row"),
        count_where(F.col("n") > 1).alias("keys_with_many_rows"),
        F.max("n").alias("maximum_rows_per_key"),
    )


def most_frequent_keys(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), F.asc(key)).limit(k)


# --- relationships ------------------------------------------------------------------------------


def _child_keys(child: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = [F.col(c).alias(f"k{i}") for i, c in enumerate(columns)]
    return child.select(*names).groupBy(*[f"k{i}" for i in range(len(columns))]).agg(F.count(F.lit(1)).alias("n"))


def _parent_keys(parent: DataFrame, columns: Sequence[str]) -> DataFrame:
    return parent.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)]).dropna().distinct()


def fk_check(
    child: DataFrame,
    child_columns: Sequence[str],
    parent: DataFrame,
    parent_columns: Sequence[str],
    name: str = "",
) -> DataFrame:
    """Child rows, distinct keys on both sides, orphan rows and distinct orphan keys.

    A missing child key is an orphan row but not an orphan key.
    """
    keys = [f"k{i}" for i in range(len(child_columns))]
    merged = _child_keys(child, child_columns).join(
        _parent_keys(parent, parent_columns).withColumn("in_parent", F.lit(True)), keys, "full_outer"
    )
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    in_child, orphan = F.col("n").isNotNull(), F.col("n").isNotNull() & F.col("in_parent").isNull()
    counts = merged.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("child_rows"),
        count_where(in_child & complete).alias("distinct_child_keys"),
        count_where(F.col("in_parent")).alias("distinct_parent_keys"),
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphan_rows"),
        count_where(orphan & complete).alias("distinct_orphan_keys"),
    )
    return counts.select(F.lit(name).alias("relationship"), "*", _status(F.col("orphan_rows") == 0))


def fk_orphans(
    child: DataFrame, child_columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> DataFrame:
    """Distinct child keys without a parent and the rows that hold them."""
    keys = [f"k{i}" for i in range(len(child_columns))]
    orphans = _child_keys(child, child_columns).join(_parent_keys(parent, parent_columns), keys, "left_anti")
    return orphans.select(*[F.col(k).alias(c) for k, c in zip(keys, child_columns)], F.col("n").alias("row_count"))


def fk_check_all(tables: Mapping[str, DataFrame], relationships: Sequence[ForeignKey]) -> DataFrame:
    checks = [
        fk_check(tables[r.child], r.child_columns, tables[r.parent], r.parent_columns, r.name) for r in relationships
    ]
    return reduce(DataFrame.unionByName, checks)


# --- reconciliation -----------------------------------------------------------------------------


def _keyed(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(f"{side}_rows"),
        F.count(F.lit(1)).alias(f"{side}_keys"),
        count_where(F.col("n") > 1).alias(f"{side}_duplicate_keys"),
    )


def join_preserves_rows(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, keys and duplicated keys before and after a join that must neither drop nor multiply rows."""
    both = one_row(_keyed(before, keys, "before"), _keyed(after, keys, "after"))
    same = (
        (F.col("before_rows") == F.col("after_rows"))
        & (F.col("before_keys") == F.col("after_keys"))
        & (F.col("before_duplicate_keys") == F.col("after_duplicate_keys"))
    )
    return both.select("*", _status(same))


def rollup_reconcile(source: DataFrame, rolled: DataFrame, key: str, counter: str) -> DataFrame:
    """A rollup holds each source key once and its counter adds up to the source rows."""
    added_up = rolled.agg(F.coalesce(F.sum(counter), F.lit(0)).alias("counted_rows"))
    both = one_row(_keyed(source, [key], "source"), _keyed(rolled, [key], "rolled"), added_up)
    ok = (
        (F.col("source_keys") == F.col("rolled_rows"))
        & (F.col("rolled_duplicate_keys") == 0)
        & (F.col("counted_rows") == F.col("source_rows"))
    )
    return both.select("source_rows", "source_keys", "rolled_rows", "rolled_duplicate_keys", "counted_rows", _status(ok))


#: Relative difference of totals that comes from adding up doubles in another order.
RELATIVE = 1e-12


def totals_reconcile(
    source: DataFrame, rolled: DataFrame, measures: Mapping[str, tuple[str, str]], tolerance: float = 0.01
) -> DataFrame:
    """Source and rolled-up total of each measure and whether they agree: within the tolerance, or within RELATIVE
    of the source total where doubles can't hold the tolerance any more."""
    names = list(measures)
    sides = []
    for side, df, place in (("source_total", source, 0), ("rolled_total", rolled, 1)):
        sums = df.agg(*[exact_sum(measures[m][place]).alias(m) for m in names])
        sides.append(sums.unpivot([], names, "measure", side))
    merged = sides[0].unionByName(sides[1], allowMissingColumns=True)
    totals = merged.groupBy("measure").agg(
        F.max("source_total").alias("source_total"), F.max("rolled_total").alias("rolled_total")
    )
    difference = F.abs(F.col("source_total") - F.col("rolled_total"))
    return totals.select("*", difference.alias("difference"), _status(difference <= F.greatest(F.lit(tolerance), F.abs("source_total") * RELATIVE)))


def condition_counts(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows and rows meeting each named condition, overall or per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"), *[count_where(c).alias(name) for name, c in conditions.items()]
    )


def value_reconciliation(df: DataFrame, left: Column, right: Column, tolerance: float = 0.01) -> DataFrame:
    """Comparable rows, rows that agree within the tolerance, mean and largest absolute difference."""
    gap = F.abs(left - right)
    gaps = df.select(gap.alias("gap")).where(F.col("gap").isNotNull())
    return gaps.agg(
        F.count(F.lit(1)).alias("comparable_rows"),
        count_where(F.col("gap") <= tolerance).alias("matching_rows"),
        F.avg("gap").alias("mean_absolute_difference"),
        F.max("gap").alias("maximum_absolute_difference"),
    )


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str, tolerance: float = 0.0
) -> DataFrame:
    """Compare two keyed tables: MATCH, MISMATCH, MISSING (only left) or UNEXPECTED (only right)."""
    a = left.select(*keys, F.col(measure).alias("left_value"), F.lit(True).alias("_in_left"))
    b = right.select(*keys, F.col(measure).alias("right_value"), F.lit(True).alias("_in_right"))
    agrees = F.col("left_value").eqNullSafe(F.col("right_value")) | (
        F.abs(F.col("left_value") - F.col("right_value")) <= tolerance
    )
    status = (
        F.when(F.col("_in_right").isNull(), "MISSING")
        .when(F.col("_in_left").isNull(), "UNEXPECTED")
        .when(agrees, "MATCH")
        .otherwise("MISMATCH")
    )
    return a.join(b, list(keys), "full_outer").select(*keys, "left_value", "right_value", status.alias("status"))


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    """Row counts and totals of each status."""
    return reconciled.groupBy("status").agg(
        F.count(F.lit(1)).alias("row_count"),
        exact_sum("left_value").alias("left_total"),
        exact_sum("right_value").alias("right_total"),
    )


# --- labels -------------------------------------------------------------------------------------


def label_checks(df: DataFrame, key: str, required: Sequence[str], non_negative: Sequence[str]) -> DataFrame:
    """Rows, distinct keys, missing targets and negative durations of a labelled table."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(key).alias("distinct_keys"),
        *[count_where(F.col(c).isNull()).alias(f"null_{c}") for c in required],
        *[count_where(F.col(c) < 0).alias(f"negative_{c}") for c in non_negative],
    )


def binary_domain(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.lit(column).alias("target"),
        F.count(F.lit(1)).alias("row_count"),
        count_where(c.isNull()).alias("null_rows"),
        count_where(~c.isin(0, 1)).alias("out_of_domain_rows"),
    ).select("*", _status((F.col("null_rows") == 0) & (F.col("out_of_domain_rows") == 0)))


def non_negative_domain(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(
        F.lit(column).alias("target"),
        F.count(F.lit(1)).alias("row_count"),
        count_where(c.isNull()).alias("null_rows"),
        count_where(c < 0).alias("out_of_domain_rows"),
    ).select("*", _status((F.col("null_rows") == 0) & (F.col("out_of_domain_rows") == 0)))
