import pytest
from pyspark.sql import functions as F

from orderflow.contract import ContractError, FeatureContract, require_numeric, require_same_schema
from orderflow.operators import quality
from orderflow.plans.delivery import CONTRACT, RELATIONSHIPS, table_specs


def row(df):
    return df.first().asDict()


def test_primary_key_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (3, "c")], "a int, b string")
    got = row(quality.pk_check(df, ["a", "b"]))
    assert got["row_count"] == 6 and got["null_key_rows"] == 2 and got["distinct_keys"] == 3
    assert got["duplicate_rows_after_first"] == 3 and got["duplicate_rows_all"] == 5
    assert row(quality.pk_check(df.limit(0), ["a", "b"]))["row_count"] == 0


def test_foreign_key_with_missing_child_key(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "p int")
    got = row(quality.fk_check(child, ["k"], parent, ["p"]))
    assert got["child_rows"] == 6 and got["distinct_child_keys"] == 3 and got["distinct_parent_keys"] == 3
    assert got["orphan_rows"] == 3 and got["distinct_orphan_keys"] == 1 and got["status"] == "FAILED"
    orphans = {(r["k"], r["row_count"]) for r in quality.fk_orphans(child, ["k"], parent, ["p"]).collect()}
    assert orphans == {(9, 2), (None, 1)}


def test_multiplicity(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (None,)], "k int")
    assert row(quality.key_multiplicity(df, "k")) == {
        "unique_keys": 2, "keys_with_one_row": 1, "keys_with_many_rows": 1, "maximum_rows_per_key": 2
    }
    assert [tuple(r) for r in quality.most_frequent_keys(df, "k").collect()] == [(1, 2), (2, 1)]


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), "x"), (None, "y")], "a double, b string")
    got = {r["column_name"]: (r["missing_count"], round(r["missing_rate"], 4)) for r in quality.missing_values(df).collect()}
    assert got == {"a": (2, 0.6667), "b": (1, 0.3333)}


def test_rollup_and_totals(spark):
    items = spark.createDataFrame([(1, 10.0), (1, 5.5), (2, 1.0)], "k int, price double")
    rolled = items.groupBy("k").agg(F.count("*").alias("n"), F.sum("price").alias("total"))
    assert row(quality.rollup_reconcile(items, rolled, "k", "n"))["status"] == "PASSED"
    assert row(quality.rollup_reconcile(items, rolled.limit(1), "k", "n"))["status"] == "FAILED"
    assert row(quality.totals_reconcile(items, rolled, {"price": ("price", "total")}))["status"] == "PASSED"
    off = rolled.withColumn("total", F.col("total") + 1)
    assert row(quality.totals_reconcile(items, off, {"price": ("price", "total")}))["difference"] == 2.0


def test_join_preserves_rows(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    doubled = left.unionByName(left.limit(1))
    assert row(quality.join_preserves_rows(left, left, ["k"]))["status"] == "PASSED"
    assert row(quality.join_preserves_rows(left, doubled, ["k"]))["status"] == "FAILED"


def test_reconcile_statuses(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "name string, size int")
    right = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "name string, size int")
    got = quality.reconcile(left, right, ["name"], "size")
    assert {r["name"]: r["status"] for r in got.collect()} == {
        "a": "MATCH", "b": "MISMATCH", "c": "MISSING", "d": "UNEXPECTED"
    }
    assert {r["status"]: r["row_count"] for r in quality.reconcile_summary(got).collect()}["MATCH"] == 1


def test_label_domains(spark):
    df = spark.createDataFrame([(0, 1.0), (1, -2.0), (2, None), (None, 0.0)], "y int, d double")
    assert row(quality.binary_domain(df, "y"))["out_of_domain_rows"] == 1
    assert row(quality.non_negative_domain(df, "d"))["null_rows"] == 1
    assert row(quality.label_checks(df, "y", ["d"], ["d"]))["negative_d"] == 1


def test_contract(spark):
    CONTRACT.lint()
    assert len(CONTRACT.features) == 47 and len(CONTRACT.columns) == 55 and len(CONTRACT.forbidden) == 8
    bad = FeatureContract(("id",), ("a", "a"), ("a", "y"), "y", "z")
    assert len(bad.problems()) == 3
    with pytest.raises(ContractError):
        bad.lint()
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ContractError, match="not numeric: b"):
        require_numeric(df, ["b"])
    with pytest.raises(ContractError, match="differs"):
        require_same_schema({"one": df, "two": df.select("b", "a")})
    assert '"feature_count": 47' in CONTRACT.manifest()


def test_table_specs_cover_relationships():
    specs = table_specs()
    for r in RELATIONSHIPS:
        assert set(r.child_columns) <= set(specs[r.child].schema.names)
        assert set(r.parent_columns) <= set(specs[r.parent].primary_key)


def test_totals_of_thirds_agree(spark):
    source = spark.range(200_000).selectExpr("id % 1000 AS k", "1D / 3 AS v")
    rolled = source.groupBy("k").agg(F.sum("v").alias("v"))
    row = quality.totals_reconcile(source, rolled, {"v": ("v", "v")}).first()
    assert row["status"] == "PASSED" and abs(row["source_total"] - 200_000 / 3) < 1e-6
