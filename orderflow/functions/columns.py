"""Small column builders shared by the operators. All of them stay inside JVM code generation."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3600.0
SECONDS_PER_DAY = 86400.0


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- missing and non-finite values --------------------------------------------------------------


def number_sql(name: str) -> str:
    """SQL text for a column as a number: text that is not a number, NaN and infinities become NULL.

    NaN compares greater than infinity, so one comparison rules out both. Operators that touch many
    columns build SQL text: one call per projection instead of several per column.
    """
    number = f"try_cast(`{name}` AS DOUBLE)"
    return f"CASE WHEN abs({number}) < double('Infinity') THEN {number} END"


def finite(name: str) -> Column:
    """The column as a number with NULL as its only missing value."""
    return F.expr(number_sql(name))


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def equality_flag(left: Column | str, right: Column | str) -> Column:
    """1 / 0 for equal / different, NULL when either side is missing."""
    return (as_column(left) == as_column(right)).cast("int")


# --- dates --------------------------------------------------------------------------------------


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds crossed between two timestamps, from the wall clock (no session zone involved)."""
    start, end = as_column(start), as_column(end)

    def of_day(ts: Column) -> Column:
        return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)

    return F.datediff(end, start).cast("bigint") * 86400 + of_day(end) - of_day(start)


def hours_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / F.lit(SECONDS_PER_HOUR)


def days_between(start: Column | str, end: Column | str) -> Column:
    return seconds_between(start, end) / F.lit(SECONDS_PER_DAY)


def weekday(ts: Column | str) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(as_column(ts)) - 1


# --- aggregates ---------------------------------------------------------------------------------


def exact_sum(value: Column | str, scale: int = 12) -> Column:
    """Sum through Decimal: the same bits whatever the partitioning, order or task retries. A row is rounded to
    ``scale`` places only, and values up to 1e26 fit."""
    return F.sum(as_column(value).cast(f"decimal(38,{scale})")).cast("double")


def count_where(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0)).cast("bigint")


def any_flag(condition: Column) -> Column:
    return F.max(flag(condition))


def value_at_max(value: Column | str, by: Column | str, ties: list[Column | str]) -> Column:
    """Value of the row with the largest ``by``; rows missing either are skipped, ties go to the first
    row in ``ties`` order. A single min_by keeps one candidate per map task, whatever the group size."""
    v, b = as_column(value), as_column(by)
    order = F.struct((-b).alias("by"), *[as_column(t).alias(f"t{i}") for i, t in enumerate(ties)])
    return F.min_by(v, F.when(v.isNotNull() & b.isNotNull(), order))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio only where the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def cells_above(value: Column, edges: list[float]) -> Column:
    """How many of the few sorted ``edges`` lie below the value: its bin in a right-closed binning."""
    if not edges:
        return F.when(value.isNotNull(), F.lit(0))
    return reduce(add, [(value > F.lit(e)).cast("int") for e in edges])
