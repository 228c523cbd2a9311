"""Columns that repeat each other: rank correlation and exact duplicates."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.columns import number_sql
from orderflow.operators.ordering import prefix_sums
from orderflow.session import pin, unpin

# Fewest complete rows of a pair and the correlation that is worth reporting.
FEWEST_PAIRS = 100
HIGH_CORRELATION = 0.95
PAIRS_PER_PASS = 100
# A value is hot when it holds more than this share of the rows; at most 1/share values can be.
HOT_SHARE = 0.001
# Distinct values of all columns together whose ranks are sent to every task.
LOOKUP = 1_000_000


def _mask_classes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """For each column the first column that is missing in exactly the same rows (None: never missing)."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    gappy = [c for c in columns if nulls[c]]
    # Only columns with equally many gaps can share them.
    twins = [(a, b) for a, b in combinations(gappy, 2) if nulls[a] == nulls[b]]
    shared: set[tuple[str, str]] = set()
    for start in range(0, len(twins), PAIRS_PER_PASS):
        chunk = twins[start : start + PAIRS_PER_PASS]
        row = df.agg(
            *[F.count_if(F.col(a).isNull() != F.col(b).isNull()).alias(f"p{i}") for i, (a, b) in enumerate(chunk)]
        ).first()
        shared |= {pair for i, pair in enumerate(chunk) if not row[f"p{i}"]}
    classes: dict[str, str | None] = {c: None for c in columns if not nulls[c]}
    for c in gappy:
        classes[c] = next((a for a in gappy if (a, c) in shared and classes.get(a) == a), c)
    return classes


def _ranks(wide: DataFrame, variables: Sequence[str], masks: Sequence[str]) -> DataFrame:
    """(variable, value, n, n_total, counts, ranks): each distinct value with its average ranks less their mean, among all rows
    that have the variable and among those that each mask leaves of them, and how many rows those are."""
    long = wide.unpivot(list(masks), list(variables), "variable", "value").where(F.col("value").isNotNull())
    within = ["n", *[f"n_{m}" for m in masks]]
    counted = long.groupBy("variable", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(m)).alias(f"n_{m}") for m in masks]
    )
    summed = prefix_sums(counted, [F.asc("value")], {n: n for n in within}, ["variable"])
    centred = [F.col(f"{n}_before") + (F.col(n) - F.col(f"{n}_total")) / F.lit(2.0) for n in within]
    return pin(summed.select("variable", "value", "n", "n_total", F.array(*[f"{n}_total" for n in within]).alias("counts"), F.array(*centred).alias("ranks")))


def _looked_up(wide: DataFrame, key: str, ranks: DataFrame, variables: Sequence[str], masks: Sequence[str]) -> DataFrame:
    """``wide`` with the ranks of ``variables`` in place of their values, one column ``<variable>_<i>`` for each array position.

    A value held by many rows is looked up in a small broadcast table (at most 1 / HOT_SHARE rows per variable, by definition);
    all remaining values are spread enough for a shuffle join. Rows are dealt by key before they are put together again, as a
    partial row of all variables for each value is far larger than the value."""
    ranks = ranks.where(F.col("variable").isin(*variables))
    hot, pairs, row = F.col("n") > F.col("n_total") * HOT_SHARE, ["variable", "value"], "_row"
    long = wide.select(F.col(key).alias(row), *variables).unpivot([row], list(variables), "variable", "value").where(F.col("value").isNotNull())
    looked_up = long.join(F.broadcast(ranks.where(hot).select(*pairs, "ranks")), pairs, "left")
    rare = looked_up.where(F.col("ranks").isNull()).drop("ranks")
    ranked = looked_up.where(F.col("ranks").isNotNull()).unionByName(rare.join(ranks.where(~hot).select(*pairs, "ranks"), pairs))
    places = [(v, i, F.when(F.col("variable") == v, F.col("ranks")[i])) for v in variables for i in range(len(masks) + 1)]
    by_row = ranked.repartition(row).groupBy(row).agg(*[F.max(r).alias(f"{v}_{i}") for v, i, r in places])
    return wide.drop(*variables).join(by_row, F.col(key).eqNullSafe(F.col(row)), "left").drop(row)


def _products(wide: DataFrame, tables: dict, used: Sequence[tuple[str, int]], masks: Sequence[str], wanted: Sequence[tuple[int, int]]) -> dict:
    """Sums over all rows of the products of two used variables' ranks, from one pass: a task adds up one matrix of variables by
    variables. ``tables`` has the sorted values and ranks of variables that are looked up here."""
    sent = wide.sparkSession.sparkContext.broadcast(tables)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram = np.zeros((len(used), len(used)))
        for rows in batches:
            present = [None, *[rows[m].to_numpy(bool) for m in masks]]
            ranks = np.zeros((len(rows), len(used)))
            places: dict = {}
            for k, (name, mask) in enumerate(used):
                if name in sent.value:
                    values, table = sent.value[name]
                    if name not in places:
                        found = rows[name].to_numpy(float, na_value=np.nan)
                        held = ~np.isnan(found)
                        places[name] = held, np.searchsorted(values, found[held])
                    held, at = places[name]
                    ranks[held, k] = table[at, mask]
                else:
                    ranks[:, k] = np.nan_to_num(rows[f"{name}_{mask}"].to_numpy(float, na_value=np.nan))
                if mask:
                    ranks[~present[mask], k] = 0
            gram += ranks.T @ ranks
        yield pd.DataFrame([(i, j, gram[i, j]) for i, j in wanted], columns=["i", "j", "s"])

    sums = wide.mapInPandas(summed, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    return {(r["i"], r["j"]): r["s"] for r in sums}


def spearman_pairs(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    at_least: float | None = None,
    fewest_pairs: int = FEWEST_PAIRS,
) -> DataFrame:
    """Spearman correlation of every column pair over the rows where both are present.

    Ranks are learned once per column, among its rows and among those of them that the gaps of any other column leave, so a pair
    whose gaps differ is ranked on its common rows. Columns with few distinct values (LOOKUP for all of them together) are ranked
    where the rows lie, the others by a join. ``key`` identifies a row.
    """
    numbers = df.selectExpr(key, *[f"{number_sql(c)} AS `{c}`" for c in columns])
    classes = _mask_classes(numbers, columns)
    gaps = [c for c in columns if classes[c] == c]
    names, masks = {c: f"v{i}" for i, c in enumerate(columns)}, [f"m{i}" for i in range(len(gaps))]
    wide = numbers.select(
        F.col(key).alias("_key"),
        *[F.col(c).alias(v) for c, v in names.items()],
        *[F.col(c).isNotNull().alias(m) for c, m in zip(gaps, masks, strict=True)],
    )
    ranks = _ranks(wide, list(names.values()), masks)

    def variable(column: str, partner: str) -> tuple[str, int]:
        mask = classes[partner]
        return names[column], 0 if mask is None or mask == classes[column] else gaps.index(mask) + 1

    pairs = [(a, b, variable(a, b), variable(b, a)) for a, b in combinations(columns, 2)]
    sizes = ranks.groupBy("variable").agg(F.count(F.lit(1)).alias("values"), F.first("counts").alias("counts")).collect()
    near, room = [], LOOKUP
    for row in sorted(sizes, key=lambda r: (r["values"], r["variable"])):
        room -= row["values"]
        if room >= 0:
            near.append(row["variable"])
    held = {r["variable"]: r["counts"] for r in sizes}
    far = sorted(v for v in held if v not in near)
    tables = {}
    if near:
        few = ranks.where(F.col("variable").isin(*near)).select("variable", "value", *[F.col("ranks")[i].alias(f"r{i}") for i in range(len(masks) + 1)])
        for name, rows in few.toPandas().groupby("variable"):
            rows = rows.sort_values("value")
            tables[name] = rows["value"].to_numpy(float), rows.drop(columns=["variable", "value"]).to_numpy(float)
    used = sorted({x for *_, left, right in pairs for x in (left, right) if x[0] in held})
    place = {x: k for k, x in enumerate(used)}
    both = [(a, b, place.get(x), place.get(y), held[x[0]][x[1]] if x in place and y in place else 0) for a, b, x, y in pairs]
    wanted = sorted({p for *_, x, y, n in both if n for p in ((x, x), (y, y), (x, y))})
    ready = _looked_up(wide, "_key", ranks, far, masks) if far else wide
    kept = [c for c in ready.columns if c in masks or c in tables or c.rpartition("_")[0] in far]
    sums = _products(ready.select(*kept), tables, used, masks, wanted) if wanted else {}
    unpin(ranks)

    def value(x: int, y: int) -> float | None:
        # A constant variable has no correlation.
        spread = math.sqrt(sums[x, x]) * math.sqrt(sums[y, y])
        return max(-1.0, min(1.0, sums[x, y] / spread)) if spread else None

    found = [(a, b, n, value(x, y) if n else None) for a, b, x, y, n in both]
    result = df.sparkSession.createDataFrame(found, "left_column string, right_column string, pair_count long, value double")
    result = result.where((F.col("pair_count") >= fewest_pairs) & F.col("value").isNotNull())
    return result if at_least is None else result.where(F.abs("value") >= at_least)


def correlation_matrix(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Spearman correlation of every two columns, both ways and with themselves: (left_column, right_column, pair_count, value),
    without the pairs that have none, as one is constant or no row has both."""
    upper = spearman_pairs(df, key, columns, fewest_pairs=0)
    numbers = df.selectExpr(*[f"{number_sql(c)} AS `{c}`" for c in columns])
    own = numbers.unpivot([], list(columns), "left_column", "value").groupBy("left_column").agg(
        F.count("value").alias("pair_count"), F.when(F.min("value") < F.max("value"), 1.0).alias("value")
    )
    lower = upper.select(F.col("right_column").alias("left_column"), F.col("left_column").alias("right_column"), "pair_count", "value")
    return upper.unionByName(lower).unionByName(own.withColumn("right_column", F.col("left_column")))


def duplicate_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairs of columns of one type that agree in every row, gaps included.

    One pass fingerprints all columns; only columns with equal fingerprints are compared row by row.
    """
    row = F.xxhash64(*[F.col(c) for c in columns])
    prints = df.select(row.alias("_row"), *columns).agg(
        *[F.bit_xor(F.xxhash64(F.col("_row"), F.col(c))).alias(c) for c in columns]
    ).first()
    kinds = dict(df.dtypes)
    maybe = [(a, b) for a, b in combinations(columns, 2) if kinds[a] == kinds[b] and prints[a] == prints[b]]
    found = []
    for start in range(0, len(maybe), PAIRS_PER_PASS):
        chunk = maybe[start : start + PAIRS_PER_PASS]
        differing = df.agg(
            *[F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"d{i}") for i, (a, b) in enumerate(chunk)]
        ).first()
        found += [(a, b, 1.0) for i, (a, b) in enumerate(chunk) if not differing[f"d{i}"]]
    return df.sparkSession.createDataFrame(found, "left_column string, right_column string, value double")


def redundancy_report(df: DataFrame, key: str, numerical: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Highly correlated numeric pairs and exact duplicates among all features."""
    names = ["left_column", "right_column", "value"]
    correlated = spearman_pairs(df, key, numerical, HIGH_CORRELATION)
    return correlated.select(F.lit("high_spearman_correlation").alias("relationship"), *names).unionByName(
        duplicate_columns(df, features).select(F.lit("exact_duplicate").alias("relationship"), *names)
    )
