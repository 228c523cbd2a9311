import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.operators import ordering, split


def numbers(spark, n=3000):
    """Skewed: a third of all rows share one value."""
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.hash("id") % 1000) / 4.0).alias("v"),
        (F.col("id") % 4).cast("string").alias("g"),
    )


def test_quantiles_equal_numpy_on_every_layout(spark):
    df = numbers(spark)
    values = df.toPandas()
    wanted = {"a": 0.01, "b": 0.5, "c": 0.95}
    for layout in (df.repartition(1), df.repartition(17), df.orderBy(F.rand(3))):
        got = ordering.quantiles(layout, "v", wanted).first()
        assert np.allclose([got[k] for k in wanted], np.quantile(values.v, list(wanted.values())))
    grouped = ordering.quantiles(df, "v", {"m": 0.5}, ["g"]).collect()
    assert {r["g"]: r["m"] for r in grouped} == values.groupby("g").v.median().to_dict()


def test_quantiles_of_groups_with_missing_key_and_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 2.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in ordering.medians(df, "v", ["g"], "m").collect()}
    assert got == {None: 2.0, "b": 2.0}


def test_quantiles_of_groups_beyond_the_sketch_are_exact_and_store_no_rows(spark, monkeypatch):
    """With a coarse sketch the groups are large: brackets are closed, and values between them are counted as one."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5).alias("g"),
        F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 7 != 0, (F.hash("id") % 10_000) / 8).otherwise(F.pow(F.lit(1.5), F.col("id") % 90)).alias("v"),
    )
    rows = rows.unionByName(spark.createDataFrame([(None, 1.0), (None, 2.0), (99, None)], "g long, v double"))
    stored, real = [], ordering.pin
    monkeypatch.setattr(ordering, "pin", lambda df: stored.append(real(df)) or stored[-1])
    monkeypatch.setattr(ordering, "ACCURACY", 200)
    wanted = {"least": 0.0, "a": 0.001, "b": 0.25, "c": 0.5, "d": 0.501, "e": 0.99, "most": 1.0}
    got = {r["g"]: r for r in ordering.quantiles(rows.repartition(5), "v", wanted, ["g"]).collect()}
    groups = {}
    for g, v in rows.dropna(subset=["v"]).collect():
        groups.setdefault(g, []).append(v)
    assert got.keys() == groups.keys() and len(groups) == 7
    for g, values in groups.items():
        row = got[g]
        assert np.allclose([row[k] for k in wanted], np.quantile(values, list(wanted.values())), rtol=0, atol=1e-9)
    assert sum(df.count() for df in stored) == 7
    closed = stored[0].where("n > 800").select(F.explode("low").alias("low"))
    assert closed.where("low > double('-Infinity')").count() > 0
    plan = ordering.quantiles(rows, "v", wanted, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2 and plan.count("Window [") == 2


def test_approximate_quantiles_are_close(spark):
    df = numbers(spark)
    exact = ordering.quantiles(df, "v", {"m": 0.9}).first()["m"]
    assert abs(ordering.quantiles(df, "v", {"m": 0.9}, accuracy=10000).first()["m"] - exact) <= 0.5


def test_average_ranks_equal_pandas(spark):
    df = numbers(spark, 500)
    ranks = {r["v"]: r["average_rank"] for r in ordering.ranked_values(df, "v").collect()}
    expected = df.toPandas()
    expected["r"] = expected.v.rank()
    assert all(ranks[v] == r for v, r in zip(expected.v, expected.r))


def test_prefix_sums_descending_within_groups(spark):
    df = numbers(spark, 400).groupBy("g", "v").agg(F.count("*").alias("n"))
    got = ordering.prefix_sums(df, [F.desc("v")], {"n": "n"}, ["g"]).toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("v", ascending=False)
        assert list(part.n_before) == list(part.n.cumsum() - part.n)
        assert set(part.n_total) == {part.n.sum()}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_on_row_level_data(spark):
    for by in ([], ["g"]):
        lines = plan_of(ordering.ranked_values(numbers(spark), "v", by)).splitlines()
        single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
        # Only the slice totals (one row per slice) may meet in one task, and only without groups.
        assert all("HashAggregate(keys=[_slice" in lines[i + 1] for i in single)
        assert bool(single) == (not by)


@pytest.mark.parametrize("rows", [1, 10, 101, 999])
def test_split_sizes_and_order(spark, rows):
    hot = F.when(F.col("id") % 3 == 0, F.lit("2020-01-05 00:00:00")).otherwise(
        F.date_format(F.expr("timestamp'2020-01-01' + make_dt_interval(cast(id % 40 as int))"), "yyyy-MM-dd HH:mm:ss")
    )
    df = spark.range(rows).select(F.col("id").alias("k"), hot.cast("timestamp_ntz").alias("t"))
    got = split.chronological_split(df, "t", "k").toPandas().sort_values(["t", "k"])
    a, b = int(rows * 0.70), int(rows * 0.85)
    assert list(got.split) == ["train"] * a + ["validation"] * (b - a) + ["test"] * (rows - b)


def test_split_with_text_keys_and_missing_times(spark):
    df = spark.createDataFrame(
        [("a", "2020-01-01"), ("b", None), ("c", "2020-01-01"), ("d", "2020-01-02")], "k string, t string"
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {r["k"]: r["split"] for r in split.chronological_split(df, "t", "k", {"one": 0.25, "two": 0.75}, "three").collect()}
    assert got == {"a": "one", "c": "two", "d": "two", "b": "three"}


def test_split_with_repeated_key_at_the_cut_fails(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (1, 1)], "t int, k int")
    with pytest.raises(ValueError, match="not unique"):
        split.chronological_split(df, "t", "k")


def test_split_checks(spark):
    df = spark.createDataFrame(
        [(1, "train", 1), (2, "validation", 2), (2, "test", 3), (1, "test", 4)], "k int, split string, t int"
    )
    assert {r["k"] for r in split.split_overlap(df, "k").collect()} == {1, 2}
    checks = split.check_split(df, "t", "k").collect()
    assert all(r["in_order"] for r in checks) and not any(r["keys_disjoint"] for r in checks)
