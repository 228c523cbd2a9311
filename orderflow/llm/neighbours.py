"""Approximate nearest neighbours by largest inner product: cross-polytope hashing with multiprobe tables.

Vectors are brought to unit length such that order by inner product becomes order by angle: one more component fills an indexed
vector up to the largest norm, and is zero in a query. So that a few long vectors don't leave all others with that component alone, the index is split
into ranges of norms within a factor of two (more, where ranges times buckets would pass LAYOUT), each with its own largest norm and tables. Each of ``tables`` tables turns them by pseudo-rotations (three rounds of random
signs and a fast Hadamard transform) and assigns them to the nearest signed axis, ``functions`` times; together the axes are the
bucket. A query looks into its ``probes`` nearest buckets by the lost squared length. What it meets is scored exactly on the
original vectors in double precision, chosen by scores rounded relative to both norms; each bucket's best k are merged into the query's best k.

The buckets of a table lie side by side in blocks of about BLOCK_BYTES of vectors: small buckets share one, a larger one takes several and
its rows are dealt to them by vec_id. A query goes once to each block that holds one of its buckets, with their list, and meets
the rows of just those. A block and at most about QUERIES queries are one task's work; beyond, the block is repeated for each part of the
queries. Nothing is left out. A range of at most k + 1 vectors is searched whole, and so is everything for queries that met fewer than k vectors. Where the buckets lie is told by their sizes: a histogram of tables * axes ** functions numbers, which
is independent of the data, checked against LAYOUT and sent to the workers.

More ``functions`` make smaller buckets and need more probes: the defaults reach a recall above 0.95 even on vectors without any
clusters, where each query must score over half of all rows; clustered vectors allow two functions.

Defined results: null vectors, zero vectors and vectors with null or non-finite components take no part, nor do rows with a null vec_id. Ties
are broken by smaller vec_id; a query's own vec_id is never its neighbour; repeated rows count once. Vectors must have one length, else an error is
raised. No more than k candidates: all of them, from all buckets. No vectors or no queries: no rows. Other columns are not read.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from orderflow.session import pin

TABLES, FUNCTIONS, PROBES, SEED = 8, 1, 32, 9
#: A task's vectors as doubles, its queries, and the scores it holds at once.
BLOCK_BYTES, QUERIES, SCORES_AT_ONCE = 32 << 20, 32_768, 4_000_000
LAYOUT = 1_000_000
#: Digits by which candidates are chosen, of scores over the norms of query and range, so that equal vectors tie; the score itself is not rounded.
DIGITS = 10
ROWS_AT_ONCE, QUERIES_AT_ONCE = 1_000, 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast transform of the rows, whose length is a power of two, scaled to keep lengths."""
    n, width = x.shape
    h = 1
    while h < width:
        y = x.reshape(n, width // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(n, width)
        h *= 2
    return x / math.sqrt(width)


class Rotations:
    def __init__(self, dim: int, tables: int, functions: int, seed: int):
        self.dim, self.width = dim, 1 << max(1, (dim - 1).bit_length())
        signs = np.random.default_rng(seed).integers(0, 2, (tables, functions, 3, self.width))
        self.signs, self.tables, self.functions = signs * 2.0 - 1, tables, functions
        self.buckets = (2 * self.width) ** functions

    def turned(self, x: np.ndarray, table: int, function: int) -> np.ndarray:
        y = np.zeros((len(x), self.width))
        y[:, : self.dim] = x
        for signs in self.signs[table, function]:
            y = hadamard(y * signs)
        return y

    def bucket(self, x: np.ndarray, table: int) -> np.ndarray:
        """Number of the signed axes nearest to each row."""
        out = np.zeros(len(x), np.int64)
        for f in range(self.functions):
            y = self.turned(x, table, f)
            axis = np.abs(y).argmax(axis=1)
            out = out * 2 * self.width + 2 * axis + (y[np.arange(len(y)), axis] < 0)
        return out

    def probes(self, x: np.ndarray, table: int, n: int) -> np.ndarray:
        """The n buckets that lose least, for each row."""
        loss, key = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for f in range(self.functions):
            y = self.turned(x, table, f)
            both = np.stack((y, -y), axis=2).reshape(len(x), -1)
            lost = both.max(axis=1, keepdims=True) - both
            some = np.argsort(lost, axis=1, kind="stable")[:, :n]
            cost = np.take_along_axis(lost, some, 1) ** 2
            total = (loss[:, :, None] + cost[:, None, :]).reshape(len(x), -1)
            keys = (key[:, :, None] * 2 * self.width + some[:, None, :]).reshape(len(x), -1)
            best = np.argsort(total, axis=1, kind="stable")[:, :n]
            loss, key = np.take_along_axis(total, best, 1), np.take_along_axis(keys, best, 1)
        return key


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id long, v array, norm) of the rows that take part; floats stay floats, all else is double."""
    single = vectors.schema[vector].dataType == ArrayType(FloatType(), vectors.schema[vector].dataType.containsNull)
    v = F.col(vector) if single else F.col(vector).cast("array<double>")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.where(~F.exists("v", bad))
    rows = rows.withColumn("top", F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))).where("top > 0")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + (x.cast("double") / F.col("top")) * (x.cast("double") / F.col("top")))
    norm = F.least(F.col("top") * F.sqrt(square), F.lit(sys.float_info.max))
    return rows.select("vec_id", "v", norm.alias("norm")).dropDuplicates(["vec_id", "v"])


class Ranges:
    """Ranges of norms from the largest down, by powers of two; ``tops`` and ``sizes`` of those that hold vectors."""

    def __init__(self, longest: float, shortest: float):
        self.bounds = np.ldexp(longest, -np.arange(int(math.log2(longest) - math.log2(shortest)) + 2))

    def power(self, norm: np.ndarray) -> np.ndarray:
        return np.maximum(np.searchsorted(-self.bounds, -norm, side="left") - 1, 0)

    def settle(self, found: dict[int, tuple[int, float]], most: int) -> None:
        """At most ``most`` ranges from size and largest norm of each power."""
        self.step = 1
        while len({p // self.step for p in found}) > most:
            self.step *= 2
        joined: dict[int, tuple[int, float]] = {}
        for p, (n, top) in sorted(found.items()):
            before = joined.get(p // self.step, (0, 0.0))
            joined[p // self.step] = (before[0] + n, max(before[1], top))
        self.known = np.array(list(joined), np.int64)
        self.sizes, self.tops = (np.array([v[i] for v in joined.values()]) for i in (0, 1))

    def of(self, norm: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.known, self.power(norm) // self.step)


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows, without overflow of the squares."""
    top = np.abs(x).max(axis=1)
    return np.minimum(top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1)), sys.float_info.max)


class Layout:
    """Blocks of the buckets: those of ``first`` to ``last``, by table and bucket; -1 where a bucket is empty."""

    def __init__(self, sizes: np.ndarray, block: int):
        end = np.cumsum(sizes, axis=1)
        self.first = np.where(sizes > 0, (end - sizes) // block, -1)
        self.last = np.where(sizes > 0, (end - 1) // block, -1)

    def block(self, table: int, bucket: np.ndarray, ids: np.ndarray) -> np.ndarray:
        first = self.first[table, bucket]
        return first + spread(ids) % (self.last[table, bucket] - first + 1)

    def visits(self, table: int, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, block, bucket) of each block to visit for the buckets in the rows, ordered by row and block."""
        row, bucket = np.repeat(np.arange(len(buckets)), buckets.shape[1]), buckets.ravel()
        row, bucket = row[self.first[table, bucket] >= 0], bucket[self.first[table, bucket] >= 0]
        many = self.last[table, bucket] - self.first[table, bucket] + 1
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        row, bucket = np.repeat(row, many), np.repeat(bucket, many)
        block = self.first[table, bucket] + step
        order = np.lexsort((bucket, block, row))
        return row[order], block[order], bucket[order]


def spread(ids: np.ndarray) -> np.ndarray:
    """Non-negative numbers without the order of the ids (multiplicative hashing)."""
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best of each row of ``scores``, whose columns have ascending ``ids``; ties to smaller ids."""
    scores[ids[None, :] == own[:, None]] = -np.inf
    chosen = scores > -np.inf
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k, None]
        chosen &= scores >= least
        tied = np.flatnonzero(chosen.sum(axis=1) > k)
        some, bound = scores[tied], least[tied]
        above, equal = some > bound, some == bound
        chosen[tied] = above | equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1, keepdims=True))
    return np.nonzero(chosen)


def best_in_block(q: np.ndarray, own: np.ndarray, asked: list[np.ndarray], x: np.ndarray, ids: np.ndarray, bucket: np.ndarray, k: int, scale: float) -> pd.DataFrame:
    """The k best for each query among the rows of the buckets it asks for; rows are ordered by (bucket, id), none longer than ``scale``."""
    unit, within = q / norms(q)[:, None], x / scale
    want = np.concatenate(asked)
    who = np.repeat(np.arange(len(q)), [len(a) for a in asked])
    order = np.argsort(want, kind="stable")
    want, who = want[order], who[order]
    rows, columns, nearness = [], [], []
    for b in np.unique(want):
        lo, hi = np.searchsorted(bucket, [b, b + 1])
        some = who[np.searchsorted(want, b) : np.searchsorted(want, b, side="right")]
        step = max(1, SCORES_AT_ONCE // max(1, hi - lo))
        for part in (some[at : at + step] for at in range(0, len(some), step) if lo < hi):
            scores = np.round(unit[part] @ within[lo:hi].T, DIGITS)
            row, column = best_of(scores, ids[lo:hi], own[part], k)
            rows.append(part[row])
            columns.append(lo + column)
            nearness.append(scores[row, column])
    if not rows:
        return pd.DataFrame({"query_id": own[:0], "vec_id": ids[:0], "score": np.zeros(0)})
    row, column, near = np.concatenate(rows), np.concatenate(columns), np.concatenate(nearness)
    order = np.lexsort((ids[column], -near, row))
    row, column = row[order], column[order]
    kept = np.arange(len(row)) - np.searchsorted(row, row) < k
    row, column = row[kept], column[kept]
    # Summed pair by pair: the same for a pair in every table and for equal vectors.
    return pd.DataFrame({"query_id": own[row], "vec_id": ids[column], "score": (q[row] * x[column]).sum(axis=1)})


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    functions: int = FUNCTIONS,
    probes: int = PROBES,
    seed: int = SEED,
    block: int | None = None,
    queries_at_most: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k found with the largest inner product, for each row of ``queries``."""
    index = pin(usable(vectors, vec_id, vector))
    asked = pin(usable(queries, vec_id, vector))
    facts = index.agg(F.count(F.lit(1)), F.max("norm"), F.min("norm"), F.min(F.size("v")), F.max(F.size("v"))).first()
    out = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    number = asked.count()
    if not facts[0] or not number:
        return spark.createDataFrame([], out)
    rows, longest, shortest, dim, widest = facts
    if dim != widest:
        raise ValueError(f"vectors of {dim} and of {widest} components")
    block = block or max(1, BLOCK_BYTES // (8 * dim))
    turns = Rotations(dim + 1, tables, functions, seed)
    if tables * turns.buckets > LAYOUT:
        raise ValueError(f"{tables} tables of {turns.buckets} buckets: at most {LAYOUT} buckets in all")
    # The bytes that hold a vector exactly, on either side.
    kinds = ["<f4" if df.schema["v"].dataType.elementType == FloatType() else "<f8" for df in (index, asked)]

    ranges = Ranges(longest, shortest)

    def powers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            power = ranges.power(batch["norm"].to_numpy())
            yield batch["norm"].groupby(power).agg(["size", "max"]).rename_axis("power").reset_index()

    found = index.select("norm").mapInPandas(powers, "power int, size long, max double").groupBy("power").agg(F.sum("size"), F.max("max"))
    ranges.settle({r[0]: (r[1], r[2]) for r in found.collect()}, LAYOUT // (tables * turns.buckets))

    def lots(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, vectors, unit vectors, ranges) of some rows at a time; a query's range means nothing."""
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                some = batch.iloc[at : at + ROWS_AT_ONCE]
                norm, v = some["norm"].to_numpy(), np.stack(some["v"].to_numpy()).astype(np.float64)
                yield some["vec_id"].to_numpy(), v, v / norm[:, None], ranges.of(norm)

    def lifted(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(range, ids, vectors, vectors filled up to the range's largest norm, over it)."""
        for ids, v, x, which in lots(batches):
            for g in np.unique(which):
                mine, top = which == g, ranges.tops[g]
                part = v[mine] / top
                rest = np.sqrt(np.maximum(1 - (norms(v[mine]) / top) ** 2, 0))
                yield int(g), ids[mine], v[mine], np.hstack((part, rest[:, None]))

    def places(g: int, all_of_it: bool) -> list[tuple[int, int]]:
        """(place, table) to search for range ``g``."""
        n = 1 if all_of_it or ranges.sizes[g] <= k + 1 else tables
        return [(g * tables + t, t) for t in range(n)]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = np.zeros((len(ranges.tops) * tables, turns.buckets), np.int64)
        for g, _, _, x in lifted(batches):
            for place, t in places(g, False):
                sizes[place] += np.bincount(turns.bucket(x, t), minlength=turns.buckets)
        place, bucket = np.nonzero(sizes)
        yield pd.DataFrame({"place": place, "bucket": bucket, "n": sizes[place, bucket]})

    sizes = np.zeros((len(ranges.tops) * tables, turns.buckets), np.int64)
    for row in index.mapInPandas(counted, "place int, bucket long, n long").groupBy("place", "bucket").agg(F.sum("n").alias("n")).collect():
        sizes[row["place"], row["bucket"]] = row["n"]
    layout = spark.sparkContext.broadcast(Layout(sizes, block))

    def packed(v: np.ndarray, query: bool) -> np.ndarray:
        return np.array([r.tobytes() for r in v.astype(kinds[query])], object)

    def stored(all_of_it: bool, parts: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for g, ids, v, x in lifted(batches):
                raw = packed(v, False)
                for place, t in places(g, all_of_it):
                    bucket = turns.bucket(x, t)
                    at = layout.value.block(place, bucket, ids)
                    for part in range(parts):
                        yield pd.DataFrame({"place": place, "block": at, "part": part, "id": ids, "v": raw, "bucket": bucket})

        return rows

    def wanted(all_of_it: bool, parts: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for ids, v, unit, _ in lots(batches):
                raw, x = packed(v, True), np.hstack((unit, np.zeros((len(unit), 1))))
                near = [turns.probes(x, t, probes) for t in range(tables)]
                for g in range(len(ranges.tops)):
                    for place, t in places(g, all_of_it):
                        buckets = near[t]
                        if all_of_it or ranges.sizes[g] <= k + 1:
                            buckets = np.tile(np.flatnonzero(layout.value.first[place] >= 0), (len(x), 1))
                        row, at, bucket = layout.value.visits(place, buckets)
                        if not len(row):
                            continue
                        new = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(at) != 0)])
                        mine = row[new]
                        part = spread(ids[mine]) % parts
                        yield pd.DataFrame(
                            {"place": place, "block": at[new], "part": part, "id": ids[mine], "v": raw[mine], "buckets": np.split(bucket, new[1:])}
                        )

        return rows

    def vectors_of(raw: pd.Series, query: bool) -> np.ndarray:
        return np.frombuffer(b"".join(raw), kinds[query]).reshape(len(raw), -1).astype(np.float64)

    def scored(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
        if len(left) and len(right):
            left = left.sort_values(["bucket", "id"], kind="stable")
            x, ids, bucket = vectors_of(left["v"], False), left["id"].to_numpy(), left["bucket"].to_numpy()
            scale = float(ranges.tops[left["place"].iloc[0] // tables])
            for at in range(0, len(right), QUERIES_AT_ONCE):
                some = right.iloc[at : at + QUERIES_AT_ONCE]
                found.append(best_in_block(vectors_of(some["v"], True), some["id"].to_numpy(), some["buckets"].tolist(), x, ids, bucket, k, scale))
        return pd.concat(found[1:] or found)

    by, key = ["place", "block", "part"], "place int, block long, part long, id long, v binary"

    def search(asked: DataFrame, number: int, all_of_it: bool) -> DataFrame:
        parts = -(-number // queries_at_most)
        blocks = index.mapInPandas(stored(all_of_it, parts), f"{key}, bucket long").groupBy(*by)
        seekers = asked.mapInPandas(wanted(all_of_it, parts), f"{key}, buckets array<long>").groupBy(*by)
        met = blocks.cogroup(seekers).applyInPandas(scored, "query_id long, vec_id long, score double")
        # A query has at most k rows for each block it visits; one shuffle serves both the merge and the ranks.
        met = met.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return met.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    met = pin(search(asked, number, False))
    full = met.where(F.col("rank") == min(k, rows - 1)).select(F.col("query_id").alias("vec_id"))
    short = pin(asked.join(full, "vec_id", "left_anti"))
    missing = short.count()
    if not missing or rows <= k + 1:
        return met
    rest = met.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti")
    return rest.unionByName(search(short, missing, True))
