import math
import os

import duckdb
import pytest

from __spark_entry__ import LLM_QUERIES, entry, oracle_sql, queries
from check_queries import TABLES, rows_of
from orderflow.plans import queries as catalogue
from orderflow.plans.delivery import table_specs
from orderflow.sources import readers, writers


def test_csv_with_declared_types(spark, tmp_path):
    spec = table_specs()["payments"]
    path = tmp_path / "payments.csv"
    path.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\na,1,boleto,1,10.5\nb,x,voucher,2,3\n")
    df = readers.read_csv(spark, spec, str(path), ["order_id", "payment_value"])
    assert [tuple(r) for r in df.collect()] == [("a", 10.5), ("b", 3.0)]
    kept = readers.read_csv(spark, spec, str(path), keep_corrupt=True)
    assert [r["order_id"] for r in kept.cache().where("_corrupt_record is not null").collect()] == ["b"]
    inferred = dict(readers.infer_csv(spark, "payments", str(path)).dtypes)
    assert inferred["payment_value"] == "double" and inferred["payment_installments"] == "int"


def test_malformed_rows_end_the_read_or_are_set_aside(spark, tmp_path):
    specs = {"payments": table_specs()["payments"]}
    path = tmp_path / "payments.csv"
    path.write_text("order_id,payment_sequential,payment_type,payment_installments,payment_value\na,1,boleto,1,abc\nb,1,voucher,2,3\nc,2\n")
    paths = {"payments": str(path)}
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST"):
        readers.read_tables(spark, specs, paths)["payments"].select("order_id").collect()
    fit, unfit = readers.split_malformed(spark, specs["payments"], str(path))
    assert [r["order_id"] for r in fit.collect()] == ["b"]
    assert sorted(r["_corrupt_record"] for r in unfit.collect()) == ["a,1,boleto,1,abc", "c,2"]
    counted = readers.malformed_rows(spark, specs, paths).first()
    assert (counted["table_name"], counted["row_count"], counted["malformed_rows"]) == ("payments", 3, 2)


def test_missing_source_names_the_table(spark, tmp_path):
    with pytest.raises(readers.SourceMissing, match="payments"):
        readers.read_csv(spark, table_specs()["payments"], str(tmp_path / "nothing.csv"))


def test_verified_write_and_split_layout(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "if(id < 70, 'train', 'test') AS split", "id % 7 AS t")
    assert writers.write_splits(df, str(tmp_path / "s"), "t") == 100
    assert sorted(d for d in os.listdir(tmp_path / "s") if d.startswith("split=")) == ["split=test", "split=train"]
    assert any("zstd" in f for d in os.listdir(tmp_path / "s") if d.startswith("split=") for f in os.listdir(tmp_path / "s" / d))
    plan = spark.read.parquet(str(tmp_path / "s")).where("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_reports_and_file_listing(spark, tmp_path):
    df = spark.range(3)
    writers.write_report(df, str(tmp_path / "c"))
    writers.write_report(df, str(tmp_path / "j"), "json")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3
    files = readers.file_listing(spark, str(tmp_path / "j"), "*.json").collect()
    assert sum(r["bytes"] for r in files) > 0 and all(r["file_name"].endswith(".json") for r in files)


def test_projection_and_filter_reach_the_scan(spark, tiny):
    plan = queries()["scan_projected"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,45.0)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_extendedprice:double>" in plan


def test_entry(spark):
    df = entry(spark)
    assert "total_item_price" in df.columns and df.count() > 0


FAST = [
    "pk_check", "fk_check", "fk_orphans", "missing_values", "rollup_reconcile", "totals_reconcile", "reconcile_two_tables",
    "order_item_rollup", "payment_rollup", "model_dataset", "ratio_features", "route_frequency", "chronological_split",
    "split_summary", "numerical_summary", "categorical_summary", "target_by_quartile", "numeric_drift", "spearman_pairs",
    "categorical_drift", "drift_ranking", "median_impute", "standardize", "score_coverage", "reject_records", "roc_auc", "pr_curve", "threshold_sweep", "regression_metrics",
]


@pytest.fixture(scope="module")
def db(tiny):
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    return connection


def alike(a: str, b: str) -> bool:
    """Equal, or numbers on both sides of a half that the queries' last digit rounds."""
    try:
        return a == b or math.isclose(float(a), float(b), rel_tol=1e-12, abs_tol=1.1e-6)
    except ValueError:
        return False


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, tiny, db, name):
    df = queries()[name](spark, tiny)
    result = db.execute(oracle_sql()[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[1] == want[1] and len(got[0]) == len(want[0])
    assert all(alike(a, b) for x, y in zip(got[0], want[0], strict=True) for a, b in zip(x, y, strict=True))


def test_every_query_but_the_models_has_sql():
    assert set(queries()) - set(oracle_sql()) - set(LLM_QUERIES) == {"model_compare", "score_batch"}


def test_split_writes_the_model_dataset_no_second_time(spark, tiny):
    parted = catalogue.split_model(spark, tiny)
    assert set(parted.inputFiles()) == set(catalogue.model(spark, tiny).inputFiles())
    assert {r[0] for r in parted.select("split").distinct().collect()} == {"train", "validation", "test"}
