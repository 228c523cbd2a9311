"""The whole delivery run: checks, labelled table, split, reports, models, frozen test."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.contract import require_same_schema
from orderflow.functions.derived import ROUTE, add_reporting_groups
from orderflow.ml import models, prep
from orderflow.ml.score import CLASS, DAYS, PROBABILITY, Scorer, evaluate_frozen
from orderflow.operators import drift, evaluate, profile, quality, redundancy, split
from orderflow.plans.delivery import CONTRACT, RELATIONSHIPS, DeliveryTables, table_specs
from orderflow.session import pin
from orderflow.sources.writers import run_stage, write_report, write_splits, write_verified

BOUGHT, KEY = "order_purchase_timestamp", "order_id"
CHARTED = ["customer_state", "primary_seller_state", "primary_payment_type"]
BINNED = ["total_item_price", "total_freight", "total_payment_value"]
GROUPS = ["delivery_scope", "multi_item_group", "multi_seller_group"]


class CheckFailed(ValueError):
    """A check that later steps rely on did not pass."""


@dataclass(frozen=True)
class DeliveryRun:
    """One output folder; each step writes what the next one reads, and a lost run resumes behind its last complete step."""

    spark: SparkSession
    output: str

    def path(self, *names: str) -> str:
        return os.path.join(self.output, *names)

    def read(self, *names: str) -> DataFrame:
        return self.spark.read.parquet(self.path(*names))

    def part(self, name: str) -> DataFrame:
        """One split; the other folders are pruned."""
        return self.read("splits").where(F.col("split") == name).drop("split")

    # --- tables -----------------------------------------------------------------------------

    def check_sources(self, tables: DeliveryTables) -> None:
        """Key and relationship reports; findings are reported, not fatal, as raw data may be dirty."""
        named = tables.named()
        keys = [quality.pk_check(named[n], s.primary_key, n) for n, s in table_specs().items()]
        report = keys[0]
        for more in keys[1:]:
            report = report.unionByName(more)
        write_report(report, self.path("reports", "primary_keys"))
        write_report(quality.fk_check_all(named, RELATIONSHIPS), self.path("reports", "relationships"))

    def stage(self, name: str, make, inputs: list[DataFrame], grain=None, check=None, write=None) -> bool:
        return run_stage(self.spark, self.output, name, make, inputs, grain, check, write)

    def build(self, tables: DeliveryTables) -> None:
        """Write the joined and the labelled table and fail if a step lost or multiplied rows. Steps that are complete and
        whose input files are the same are skipped."""
        items, read, require = tables.order_items, self.read, self._require
        # The rollup reads the enriched items twice: written once, the product and seller joins (shuffles, when those tables are
        # large) happen once.
        self.stage(
            "enriched_items",
            tables.enriched_items,
            [items, tables.products, tables.sellers],
            check=lambda df: require(quality.join_preserves_rows(items, df, [KEY])),
        )
        totals = {"price": ("price", "total_item_price"), "freight": ("freight_value", "total_freight")}
        self.stage(
            "item_features",
            lambda: tables.item_features(read("enriched_items")),
            [read("enriched_items")],
            lambda: read("enriched_items").select(KEY).distinct(),
            lambda df: require(quality.rollup_reconcile(items, df, KEY, "item_count"), quality.totals_reconcile(items, df, totals)),
        )
        self.stage(
            "payment_features",
            tables.payment_features,
            [tables.payments],
            lambda: tables.payments.select(KEY).distinct(),
            lambda df: require(quality.rollup_reconcile(tables.payments, df, KEY, "payment_count")),
        )
        parts = ["item_features", "payment_features"]
        self.stage(
            "joined_orders",
            lambda: tables.joined_orders(*map(read, parts)),
            [tables.orders, tables.customers, *map(read, parts)],
            check=lambda df: require(quality.join_preserves_rows(tables.orders, df, [KEY])),
        )
        self.stage(
            "model_dataset",
            lambda: tables.model_dataset(read("joined_orders")),
            [read("joined_orders")],
            # Filters only: counted on the stored table, without its other columns.
            lambda: tables.model_dataset(read("joined_orders")),
            self._check_model,
        )
        self._report_joins(read("joined_orders"))

    def _check_model(self, data: DataFrame) -> None:
        CONTRACT.lint()
        CONTRACT.check(data)
        self._require(
            quality.binary_domain(data, CONTRACT.classification_target),
            quality.non_negative_domain(data, CONTRACT.regression_target),
        )

    def _report_joins(self, joined: DataFrame) -> None:
        """What the joins left open, also by status, and how payments and order values compare."""
        open_ = {
            "orders_without_items": F.col("has_item_features") == 0,
            "orders_without_payments": F.col("has_payment_features") == 0,
            "orders_without_customer_state": F.col("customer_state").isNull(),
        }
        value = F.col("total_item_price") + F.col("total_freight")
        reports = {
            "missing_joins": quality.condition_counts(joined, open_),
            "missing_joins_by_status": quality.condition_counts(joined, open_, ["order_status"]),
            "value_reconciliation": quality.value_reconciliation(joined, F.col("total_payment_value"), value),
        }
        for name, report in reports.items():
            write_report(report, self.path("reports", name))

    def split(self) -> None:
        """Write the three parts, check them and store the contract with their summary."""
        data = self.read("model_dataset")
        self.stage(
            "splits",
            lambda: split.chronological_split(data, BOUGHT, KEY),
            [data],
            lambda: data,
            self._check_split,
            lambda df, path, grain: write_splits(df, path, BOUGHT, grain),
        )
        summary = split.split_summary(
            self.read("splits"), BOUGHT, KEY, CONTRACT.classification_target, CONTRACT.regression_target, CONTRACT.features
        )
        manifest = self.spark.createDataFrame([(CONTRACT.manifest(summary),)], "value string")
        manifest.coalesce(1).write.mode("overwrite").text(self.path("manifest"))

    def _check_split(self, written: DataFrame) -> None:
        if not all(r["in_order"] and r["keys_disjoint"] for r in split.check_split(written, BOUGHT, KEY).collect()):
            raise CheckFailed("the parts overlap")
        require_same_schema({name: self.part(name) for name in ("train", "validation", "test")})

    @staticmethod
    def _require(*checks: DataFrame) -> None:
        for check in checks:
            failed = [row.asDict() for row in check.collect() if row["status"] != "PASSED"]
            if failed:
                raise CheckFailed(str(failed))

    # --- reports ----------------------------------------------------------------------------

    def explore(self) -> None:
        """Training-part reports, and feature drift to the validation part (its targets are not read)."""
        train = add_reporting_groups(self.part("train"))
        label, days = CONTRACT.classification_target, CONTRACT.regression_target
        numerical, categorical = list(CONTRACT.numerical), list(CONTRACT.categorical)
        targets = profile.target_by_category(train, [*categorical, *GROUPS], label, days)
        targets = targets.unionByName(profile.target_by_quartile(train, numerical, label, days), allowMissingColumns=True)
        targets = targets.unionByName(profile.target_by_top_category(train, ROUTE, label, days), allowMissingColumns=True)
        validation = self.part("validation").select(*CONTRACT.features)
        summary = pin(profile.numerical_summary(train, [*numerical, label, days]))
        drifted = pin(drift.drift_summary(train, validation, numerical, categorical))
        charts = [profile.group_chart(train, c, label, days).select(F.lit(c).alias("feature"), F.col(c).cast("string").alias("group"), "orders", "late_rate", "delivery_days") for c in CHARTED]
        reports = {
            "missing_values": quality.missing_values(train),
            "numerical_summary": summary,
            "suspicious_columns": profile.suspicious_columns(summary),
            "group_charts": reduce(DataFrame.unionByName, charts),
            "histograms": profile.histogram(train, dict.fromkeys(BINNED, 35), clip=0.99),
            "correlation_matrix": redundancy.correlation_matrix(train, KEY, [*numerical, label, days]),
            "categorical_summary": profile.categorical_summary(train, [*categorical, *GROUPS, ROUTE]),
            "feature_targets": targets,
            "monthly_trend": profile.monthly_trend(train, BOUGHT, label, days),
            "drift": drifted,
            "redundancy": redundancy.redundancy_report(train, KEY, numerical, CONTRACT.features),
        }
        for name, report in reports.items():
            write_report(report, self.path("reports", name))
        ranked = {"outlier_ranking": (summary, "iqr_outlier_count"), "drift_ranking": (drifted, "drift_score")}
        for name, (report, by) in ranked.items():
            write_report(report, self.path("reports", name), order=[F.desc_nulls_last(by), report.columns[0]])

    # --- models -----------------------------------------------------------------------------

    def train(
        self,
        classifiers: dict[str, dict] | None = None,
        regressors: dict[str, dict] | None = None,
        engineered: bool = True,
    ) -> Scorer:
        """Compare candidates on validation, choose the threshold there, and save the winners."""
        train, validation = self.part("train"), self.part("validation")
        models.check_time_order(train, validation, BOUGHT)
        prepared = models.prepare(CONTRACT, train, validation, engineered)
        finite = [prep.finite_check(df, models.FEATURES).select(F.lit(n).alias("split"), "*") for n, df in (("train", prepared.train), ("validation", prepared.validation))]
        finite = pin(finite[0].unionByName(finite[1]))
        if finite.where("rows_not_finite > 0").count():
            raise CheckFailed("prepared vectors hold values that are not finite")
        write_report(finite, self.path("reports", "prepared_vectors"))
        state = json.dumps(prep.learned_state(prepared.pipeline.stages), indent=2)
        self.spark.createDataFrame([(state,)], "value string").coalesce(1).write.mode("overwrite").text(self.path("reports", "learned_state"))
        late = models.compare_classifiers(prepared, classifiers)
        days = models.compare_regressors(prepared, regressors)
        scored = late.best_pipeline.transform(validation)
        sweep = evaluate.threshold_sweep(scored, models.SCORE, CONTRACT.classification_target)
        threshold = evaluate.best_threshold(sweep).first()["threshold"]
        write_report(late.metrics, self.path("reports", "classifiers"))
        write_report(days.metrics, self.path("reports", "regressors"))
        write_report(sweep, self.path("reports", "thresholds"))
        models.save_best(late, self.path("models", "classifier"), {"classification_threshold": threshold})
        models.save_best(days, self.path("models", "regressor"), require_gain=True)
        return Scorer(CONTRACT, late.best_pipeline, days.best_pipeline, threshold)

    def load_scorer(self) -> Scorer:
        """The saved models; the threshold comes from the classifier's metadata."""
        late, record = models.load_model(self.spark, self.path("models", "classifier"))
        days, _ = models.load_model(self.spark, self.path("models", "regressor"))
        return Scorer(CONTRACT, late, days, record["classification_threshold"])

    def test(self, scorer: Scorer) -> tuple[DataFrame, DataFrame]:
        """Score the test part once with the frozen models; metrics of both tasks."""
        tested = self.part("test")
        write_verified(evaluate_frozen(scorer, tested, KEY), self.path("test_predictions"), grain=tested)
        predictions = self.read("test_predictions")
        actual = "late_delivery_actual"
        late = quality.one_row(
            evaluate.classification_metrics(predictions, actual, CLASS),
            evaluate.ranking_metrics(predictions, PROBABILITY, actual),
        )
        days = evaluate.regression_metrics(predictions, CONTRACT.regression_target, DAYS)
        coverage = evaluate.score_coverage(predictions, PROBABILITY, actual)
        write_report(late, self.path("reports", "test_classification"), "json")
        write_report(coverage, self.path("reports", "test_coverage"), "json")
        write_report(evaluate.pr_curve(predictions, PROBABILITY, actual), self.path("reports", "test_pr_curve"))
        write_report(evaluate.classification_report(predictions, actual, CLASS), self.path("reports", "test_classes"))
        write_report(days, self.path("reports", "test_regression"), "json")
        return late, days
