import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderflow.operators import drift, profile, redundancy


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 1200
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "a": rng.lognormal(3, 1, n).round(3),
            "b": rng.integers(0, 3, n).astype(float),
            "c": rng.normal(0, 5, n).round(2),
            "late": rng.integers(0, 2, n),
            "days": rng.integers(1, 30, n).astype(float),
            "kind": rng.choice(["x", "y", "z"], n, p=[0.6, 0.3, 0.1]),
        }
    )
    pdf.loc[rng.choice(n, 100, replace=False), "a"] = np.nan
    pdf.loc[rng.choice(n, 50, replace=False), "kind"] = None
    df = spark.createDataFrame(pdf).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    return pdf, df.cache()


def test_numerical_summary_equals_pandas(data):
    pdf, df = data
    got = {r["column_name"]: r for r in profile.numerical_summary(df, ["a", "b", "c"]).collect()}
    for c in "abc":
        v = pdf[c].dropna()
        q1, q3 = v.quantile([0.25, 0.75])
        outliers = ((v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))).sum()
        row = got[c]
        assert row["non_missing_count"] == len(v) and row["missing_count"] == pdf[c].isna().sum()
        assert math.isclose(row["mean"], v.mean()) and math.isclose(row["std"], v.std())
        assert math.isclose(row["skewness"], v.skew(), rel_tol=1e-9)
        assert math.isclose(row["p99"], v.quantile(0.99)) and row["iqr_outlier_count"] == outliers
        assert row["negative_count"] == (v < 0).sum()


def test_summary_of_an_empty_and_a_constant_column(spark):
    df = spark.createDataFrame([(None, 2.0), (None, 2.0), (None, 2.0)], "e double, k double")
    got = {r["column_name"]: r for r in profile.numerical_summary(df, ["e", "k"]).collect()}
    assert got["e"]["non_missing_count"] == 0 and got["e"]["mean"] is None and got["e"]["negative_count"] == 0
    assert got["k"]["std"] == 0.0 and got["k"]["skewness"] == 0.0 and got["k"]["iqr_outlier_count"] == 0


def test_categories_with_missing(data):
    pdf, df = data
    got = {r["category"]: r for r in profile.categorical_summary(df, ["kind"]).collect()}
    counts = pdf.kind.fillna("<missing>").value_counts()
    assert {c: r["row_count"] for c, r in got.items()} == counts.to_dict()
    assert got["x"]["rank"] == 1 and math.isclose(got["x"]["rate"], counts["x"] / len(pdf))


def test_target_by_quartile(data):
    pdf, df = data
    got = {(r["feature"], r["category"]): r for r in profile.target_by_quartile(df, ["a", "b"], "late", "days").collect()}
    codes = pd.qcut(pdf.a, 4, labels=["q1", "q2", "q3", "q4"]).astype(object).fillna("<missing>")
    for name, part in pdf.groupby(codes):
        row = got["a", name]
        assert row["order_count"] == len(part) and row["median_actual_delivery_days"] == part.days.median()
        assert math.isclose(row["late_delivery_rate"], part.late.mean()) and row["group_type"] == "quartile"
    assert got["b", "1.0"]["group_type"] == "value" and got["b", "1.0"]["order_count"] == (pdf.b == 1).sum()


def test_grouped_targets_keep_no_sketch_per_group(spark):
    """Medians of many groups, with ties, gaps, NaN, infinities and values in one bin only, without a sketch in the plan."""
    rng = np.random.default_rng(5)
    days = np.where(rng.random(6000) < 0.4, 7.5, rng.exponential(9.0, 6000).round(2))
    days[rng.random(6000) < 0.01], days[rng.random(6000) < 0.01] = np.inf, -np.inf
    days[rng.random(6000) < 0.01] = np.nan
    rows = [
        (i % 150, None if i % 150 == 3 or i % 11 == 0 else float(d), None if i % 13 == 0 else int(i % 7 == 0)) for i, d in enumerate(days)
    ]
    df = spark.createDataFrame(rows, "g int, days double, late int")
    grouped = profile.grouped_targets(df, ["g"], "late", "days")
    assert "percentile" not in grouped._jdf.queryExecution().toString()
    got = {r["g"]: r for r in grouped.collect()}
    assert len(got) == 150
    for g in range(150):
        part = [r for r in rows if r[0] == g]
        known = sorted((r[1] for r in part if r[1] is not None), key=lambda x: (math.isnan(x), x))
        labels = [r[2] for r in part if r[2] is not None]
        assert got[g]["order_count"] == len(part) and math.isclose(got[g]["late_delivery_rate"], sum(labels) / len(labels))
        median = got[g]["median_actual_delivery_days"]
        if not known:
            assert median is None and got[g]["mean_actual_delivery_days"] is None
            continue
        lo, hi = known[(len(known) - 1) // 2], known[len(known) // 2]
        assert math.isclose(median, lo + (hi - lo) * 0.5)


def test_top_categories_and_rest(data):
    pdf, df = data
    got = {r["category"]: r["order_count"] for r in profile.target_by_top_category(df, "kind", "late", "days", k=1).collect()}
    assert got == {"x": (pdf.kind == "x").sum(), "other_route": (pdf.kind != "x").sum()}


def test_histogram_equals_numpy(data):
    pdf, df = data
    got = profile.histogram(df, {"c": 7}).orderBy("bin").collect()
    counts, edges = np.histogram(pdf.c, bins=7)
    assert [r["row_count"] for r in got] == list(counts)
    assert np.allclose([r["lower"] for r in got], edges[:-1])
    clipped = profile.histogram(df, {"a": 5}, clip=0.99).agg(F.sum("row_count"), F.max("upper")).first()
    assert clipped[0] == pdf.a.notna().sum() and math.isclose(clipped[1], pdf.a.quantile(0.99))


def test_population_stability_index(data):
    pdf, df = data
    early, late = df.where("id < 600"), df.where("id >= 600")
    got = {r["feature"]: r for r in drift.numeric_drift(early, late, ["a", "b"]).collect()}
    for c in "ab":
        t, v = pdf[c][pdf.id < 600].dropna(), pdf[c][pdf.id >= 600].dropna()
        edges = np.unique(t.quantile(np.linspace(0, 1, 11)))
        edges[0], edges[-1] = -np.inf, np.inf
        p = pd.cut(t, edges, include_lowest=True).value_counts(sort=False, normalize=True) + 1e-6
        q = pd.cut(v, edges, include_lowest=True).value_counts(sort=False, normalize=True) + 1e-6
        assert math.isclose(got[c]["population_stability_index"], float(((q - p) * np.log(q / p)).sum()), rel_tol=1e-9)
        assert math.isclose(got[c]["mean_difference"], v.mean() - t.mean(), rel_tol=1e-9)


def test_drift_of_constant_and_empty_columns(spark):
    one = spark.createDataFrame([(1.0, None), (1.0, None)], "k double, e double")
    got = {r["feature"]: r for r in drift.numeric_drift(one, one, ["k", "e"]).collect()}
    assert got["k"]["population_stability_index"] == 0.0 and got["e"]["population_stability_index"] is None
    assert got["e"]["train_missing_rate"] == 1.0


def test_categorical_drift(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    b = spark.createDataFrame([("x",), ("z",), ("z",), (None,)], "c string")
    row = drift.categorical_drift(a, b, ["c"]).first()
    assert row["total_variation_distance"] == 0.5 and row["validation_unseen_rate"] == 0.5
    assert row["train_missing_rate"] == 0.25


def test_spearman_uses_pairwise_complete_ranks(data):
    pdf, df = data
    got = {(r["left_column"], r["right_column"]): r["value"] for r in redundancy.spearman_pairs(df, "id", ["a", "b", "c", "days"]).collect()}
    expected = pdf[["a", "b", "c", "days"]].corr(method="spearman")
    assert len(got) == 6
    for (x, y), value in got.items():
        assert math.isclose(value, expected.loc[x, y], abs_tol=1e-12)


def test_redundancy_report(data):
    pdf, df = data
    wide = df.withColumn("a2", F.col("a") * 3).withColumn("b2", F.col("b")).withColumn("bi", F.col("b").cast("int"))
    wide = wide.withColumn("flat", F.lit(1.0))
    got = redundancy.redundancy_report(wide, "id", ["a", "a2", "b", "b2", "flat"], ["a", "a2", "b", "b2", "bi"]).collect()
    assert {(r["relationship"], r["left_column"], r["right_column"]) for r in got} == {
        ("high_spearman_correlation", "a", "a2"),
        ("high_spearman_correlation", "b", "b2"),
        ("exact_duplicate", "b", "b2"),
    }


@pytest.mark.parametrize("lookup", [0, 400, 1_000_000])
def test_spearman_is_equal_however_ranks_are_looked_up(data, monkeypatch, lookup):
    """Ranks by a join, by a table in the tasks, or some of each; a column without any value has no pair."""
    monkeypatch.setattr(redundancy, "LOOKUP", lookup)
    pdf, df = data
    names = ["a", "b", "c", "days", "half"]
    gapped = df.withColumn("half", F.when(F.col("id") % 2 == 0, F.col("a") % 7)).withColumn("none", F.lit(None).cast("double"))
    pdf = pdf.assign(half=(pdf.a % 7).where(pdf.id % 2 == 0))
    got = redundancy.spearman_pairs(gapped, "id", [*names, "none"], fewest_pairs=0).collect()
    expected = pdf[names].corr(method="spearman")
    assert len(got) == 10
    for r in got:
        x, y = r["left_column"], r["right_column"]
        assert math.isclose(r["value"], expected.loc[x, y], abs_tol=1e-9)
        assert r["pair_count"] == (pdf[x].notna() & pdf[y].notna()).sum()


def test_spearman_moves_no_rows_where_values_are_few(data, monkeypatch):
    """Rows went through a join and one partial row of all variables for each value."""
    _, df = data
    monkeypatch.setattr(redundancy, "_looked_up", None)
    assert redundancy.spearman_pairs(df, "id", ["a", "b", "c", "days"]).count() == 6
