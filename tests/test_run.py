import json

import pytest

from orderflow.operators.quality import reconcile
from orderflow.plans.run import CheckFailed, DeliveryRun
from orderflow.plans.testbed import delivery_tables
from orderflow.sources.readers import file_listing


@pytest.fixture(scope="module")
def run(spark, tiny, tmp_path_factory):
    work = DeliveryRun(spark, str(tmp_path_factory.mktemp("delivery")))
    tables = delivery_tables(spark, tiny)
    work.check_sources(tables)
    work.build(tables)
    work.split()
    return work


def test_splits_and_manifest(run):
    rows = {n: run.part(n).count() for n in ("train", "validation", "test")}
    total = run.read("model_dataset").count()
    assert rows["train"] == int(total * 0.70) and sum(rows.values()) == total
    manifest = json.loads("\n".join(r["value"] for r in run.spark.read.text(run.path("manifest"), wholetext=True).collect()))
    assert [s["row_count"] for s in manifest["splits"]] == [rows[n] for n in ("test", "train", "validation")]


def test_reports_are_written(run):
    run.explore()
    read = run.spark.read.option("header", True)
    assert read.csv(run.path("reports", "numerical_summary")).count() == 42
    assert read.csv(run.path("reports", "drift")).count() == 47
    kinds = {r["group_type"] for r in read.csv(run.path("reports", "feature_targets")).collect()}
    assert kinds == {"category", "quartile", "value", "top_route"}


def test_models_are_saved_and_tested_frozen(run):
    made = run.train(
        {"dummy_classifier": {}, "logistic_regression": {"C": 1.0, "maxIter": 20}},
        {"dummy_regressor": {}, "ridge": {"alpha": 10.0}, "ridge_log_target": {"alpha": 10.0}},
        engineered=False,
    )
    late, days = run.test(made)
    assert late.first()["roc_auc"] is not None and days.first()["row_count"] == run.part("test").count()
    record = json.loads(run.spark.read.text(run.path("models", "classifier", "metadata")).first()["value"])
    assert record["classification_threshold"] == made.threshold


def test_failed_checks_stop_the_run(run, spark, tiny):
    tables = delivery_tables(spark, tiny)
    broken = DeliveryRun(spark, run.path("broken"))
    twice = tables.__class__(**{**tables.named(), "customers": tables.customers.unionByName(tables.customers)})
    with pytest.raises(CheckFailed):
        broken.build(twice)


def test_two_file_sets(run, spark):
    a = file_listing(spark, run.path("item_features"), "*.parquet")
    b = file_listing(spark, run.path("payment_features"), "*.parquet")
    assert {r["status"] for r in reconcile(a, a, ["file_name"], "bytes").collect()} == {"MATCH"}
    assert {r["status"] for r in reconcile(a, b, ["file_name"], "bytes").collect()} == {"MISSING", "UNEXPECTED"}


def test_a_lost_run_resumes_behind_its_last_complete_step(run, spark, tiny, monkeypatch):
    """Killed between two steps: complete ones are kept as they are, half written ones are made again; other inputs make all anew."""
    tables, work = delivery_tables(spark, tiny), DeliveryRun(spark, run.path("lost"))

    def lost(self):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(type(tables), "payment_features", lost)
        with pytest.raises(RuntimeError):
            work.build(tables)
    spark.range(3).write.parquet(work.path("payment_features"))  # no manifest: not complete
    kept = {n: sorted(work.read(n).inputFiles()) for n in ("enriched_items", "item_features")}
    work.build(tables)
    assert all(sorted(work.read(n).inputFiles()) == files for n, files in kept.items())
    assert work.read("model_dataset").count() == run.read("model_dataset").count()
    names = ["enriched_items", "item_features", "payment_features", "joined_orders", "model_dataset"]
    before = {n: sorted(work.read(n).inputFiles()) for n in names}
    work.build(tables)
    assert all(sorted(work.read(n).inputFiles()) == files for n, files in before.items())
    fewer = spark.read.parquet(f"{tiny}/lineitem.parquet").where("l_orderkey % 5 <> 0")
    fewer.write.parquet(work.path("fewer"))
    changed = tables.__class__(**{**tables.named(), "payments": spark.read.parquet(work.path("fewer")).selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS payment_sequential", "'voucher' AS payment_type",
        "CAST(l_quantity AS INT) % 12 AS payment_installments", "l_extendedprice AS payment_value",
    )})
    work.build(changed)
    after = {n: sorted(work.read(n).inputFiles()) for n in names}
    assert [n for n in names if after[n] != before[n]] == names[2:]


def test_a_step_is_computed_once(run, spark, tmp_path):
    from pyspark.sql import functions as F

    from orderflow.sources.writers import write_verified

    done = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        done.add(1)
        return x

    rows = spark.range(50)
    assert write_verified(rows.select(counted("id").alias("id")), str(tmp_path / "once"), grain=rows) == 50
    assert done.value == 50
    with pytest.raises(IOError):
        write_verified(rows, str(tmp_path / "short"), grain=rows.limit(49))


def test_split_files_hold_ranges_of_time(run, spark, tmp_path):
    from pyspark.sql import functions as F

    from orderflow.sources.writers import write_splits

    data = run.read("splits")
    assert write_splits(data, str(tmp_path / "s"), "order_purchase_timestamp", data, rows_per_file=40) == data.count()
    named = spark.read.parquet(str(tmp_path / "s")).withColumn("file", F.input_file_name())
    spans = named.groupBy("split", "file").agg(F.min("order_purchase_timestamp").alias("a"), F.max("order_purchase_timestamp").alias("b"), F.count("*").alias("n"))
    spans = sorted(spans.collect(), key=lambda r: (r.split, r.a))
    assert len(spans) > 5 and max(r.n for r in spans) < 120
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]) if x.split == y.split)


def test_ordered_and_further_reports(run):
    read = run.spark.read.option("header", True)
    lines = [r.value for r in run.spark.read.text(run.path("reports", "categorical_summary")).collect()]
    assert len(lines) > 10
    ranked = [float(r.iqr_outlier_count) for r in read.csv(run.path("reports", "outlier_ranking")).collect()]
    assert len(ranked) == 42 and ranked == sorted(ranked, reverse=True)
    assert {r.feature for r in read.csv(run.path("reports", "group_charts")).collect()} == {"customer_state", "primary_seller_state", "primary_payment_type"}
    assert read.csv(run.path("reports", "histograms")).count() == 105
    assert read.csv(run.path("reports", "missing_joins_by_status")).count() > 2
    assert {r.rows_not_finite for r in read.csv(run.path("reports", "prepared_vectors")).collect()} == {"0"}
    assert "ExactMedianImputerModel" in json.loads("\n".join(r.value for r in run.spark.read.text(run.path("reports", "learned_state"), wholetext=True).collect()))
