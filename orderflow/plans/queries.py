"""One query per operator over the test tables. Every query reads whole tables.

Floating-point outputs are rounded here (not in the operators) so that two engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.contract import FeatureContract
from orderflow.functions import derived
from orderflow.functions.columns import days_between, hours_between, seconds_between
from orderflow.ml import prep
from orderflow.ml.models import (
    CLASSIFIERS,
    ENGINEERED_REGRESSORS,
    LABEL,
    REGRESSORS,
    compare_classifiers,
    compare_regressors,
    fit_classifier,
    fit_regressor,
    prepare,
)
from orderflow.ml.score import Scorer, split_records
from orderflow.operators import drift, evaluate, profile, quality, redundancy, reports, rollup, split
from orderflow.plans.delivery import CONTRACT, RELATIONSHIPS
from orderflow.plans.testbed import delivery_tables, table
from orderflow.session import pin

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LATE, DAYS, BOUGHT = "late_delivery", "actual_delivery_days", "order_purchase_timestamp"
MONEY = ["total_item_price", "total_freight", "total_payment_value"]
NUMERICAL, CATEGORICAL = list(CONTRACT.numerical), list(CONTRACT.categorical)
SUMMARISED = [*NUMERICAL, LATE, DAYS]
GROUPED = [*CATEGORICAL, "delivery_scope", "multi_item_group", "multi_seller_group"]
RANKED = [*MONEY, "item_count", "total_product_weight_g", "total_product_volume_cm3", DAYS]


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = {name: F.round(name, digits) for name, kind in df.dtypes if kind == "double"}
    return df.withColumns(doubles) if doubles else df


# A stage output is written once and read by every step behind it, as in the chained pipeline.
_stages: dict[tuple, DataFrame] = {}


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stages:
        _stages[key] = pin(build())
    return _stages[key]


def model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, sf_dir, "model", lambda: delivery_tables(spark, sf_dir).model_dataset())


def split_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model dataset with its split. Once the cut keys are found, the split is a comparison with them on the scan of the model
    dataset, so nothing is written again."""
    key = (spark.sparkContext.applicationId, sf_dir, "split")
    if key not in _stages:
        _stages[key] = split.chronological_split(model(spark, sf_dir), BOUGHT, "order_id")
    return _stages[key]


def parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return split.split_frames(split_model(spark, sf_dir))


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a score and a label made of their integers."""
    return table(spark, sf_dir, "lineitem").select(
        (((F.col("l_linenumber") * 37 + F.col("l_partkey")) % 101).cast("double") / 100).alias("score"),
        ((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 10 < 3).cast("int").alias("label"),
    )


# --- sources and quality ------------------------------------------------------------------------

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query
def table_row_counts(spark, sf_dir):
    return quality.table_counts({n: table(spark, sf_dir, n) for n in TABLES})


@query
def profile_columns(spark, sf_dir):
    return quality.profile_columns(table(spark, sf_dir, "lineitem"), "lineitem")


@query
def scan_projected(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_quantity >= 45").select("l_orderkey", "l_linenumber", "l_extendedprice")


@query
def pk_check(spark, sf_dir):
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return (
        quality.pk_check(line, ["l_orderkey", "l_linenumber"], "lineitem")
        .unionByName(quality.pk_check(line, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "lineitem_full"))
        .unionByName(quality.pk_check(orders, ["o_orderkey"], "orders"))
    )


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _young_orders(spark, sf_dir):
    """Orders without one status, so that relationships to them have orphans."""
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")


@query
def fk_check(spark, sf_dir):
    return quality.fk_check(
        table(spark, sf_dir, "lineitem"), ["l_orderkey"], _young_orders(spark, sf_dir), ["o_orderkey"], "line -> order"
    )


@query
def fk_orphans(spark, sf_dir):
    return quality.fk_orphans(
        table(spark, sf_dir, "lineitem"), ["l_orderkey"], _young_orders(spark, sf_dir), ["o_orderkey"]
    )


@query
def fk_check_all(spark, sf_dir):
    return quality.fk_check_all(delivery_tables(spark, sf_dir).named(), RELATIONSHIPS)


@query
def key_multiplicity(spark, sf_dir):
    return quality.key_multiplicity(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def key_multiplicity_top(spark, sf_dir):
    return quality.most_frequent_keys(table(spark, sf_dir, "lineitem"), "l_orderkey")


@query
def missing_values(spark, sf_dir):
    return rounded(quality.missing_values(delivery_tables(spark, sf_dir).products), 9)


@query
def join_row_preservation(spark, sf_dir):
    tables = delivery_tables(spark, sf_dir)
    return quality.join_preserves_rows(tables.order_items, tables.enriched_items(), ["order_id"])


@query
def rollup_reconcile(spark, sf_dir):
    tables = delivery_tables(spark, sf_dir)
    return quality.rollup_reconcile(tables.order_items, tables.item_features(), "order_id", "item_count")


@query
def totals_reconcile(spark, sf_dir):
    tables = delivery_tables(spark, sf_dir)
    measures = {"price": ("price", "total_item_price"), "freight": ("freight_value", "total_freight")}
    return rounded(quality.totals_reconcile(tables.order_items, tables.item_features(), measures), 2)




def _gaps():
    return {
        "orders_without_items": F.col("has_item_features") == 0,
        "orders_without_payments": F.col("has_payment_features") == 0,
        "orders_without_customer_state": F.col("customer_state").isNull(),
    }


@query
def missing_join_summary(spark, sf_dir):
    return quality.condition_counts(delivery_tables(spark, sf_dir).joined_orders(), _gaps())


@query
def missing_join_by_status(spark, sf_dir):
    return quality.condition_counts(delivery_tables(spark, sf_dir).joined_orders(), _gaps(), ["order_status"])


@query
def value_reconciliation(spark, sf_dir):
    joined = delivery_tables(spark, sf_dir).joined_orders()
    order_value = F.col("total_item_price") + F.col("total_freight")
    return rounded(quality.value_reconciliation(joined, F.col("total_payment_value"), order_value), 4)


@query
def label_checks(spark, sf_dir):
    """On raw ship dates, which are unrelated to order dates: violations are expected."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    shipped = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "l_orderkey", days_between("o_orderdate", "l_shipdate").alias("ship_days")
    )
    return quality.label_checks(shipped, "l_orderkey", ["ship_days"], ["ship_days"])


@query
def target_domain(spark, sf_dir):
    labels, data = table(spark, sf_dir, "labels"), model(spark, sf_dir)
    checks = [
        quality.binary_domain(labels, "quality"),
        quality.binary_domain(labels, "toxic"),
        quality.binary_domain(data, LATE),
        quality.non_negative_domain(data, DAYS),
        quality.non_negative_domain(data, "lateness_days"),
    ]
    result = checks[0]
    for check in checks[1:]:
        result = result.unionByName(check)
    return result


@query
def reconcile_two_tables(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
    totals = line.agg(F.sum("l_extendedprice").alias("total"))
    orders = _young_orders(spark, sf_dir).select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total"))
    return rounded(quality.reconcile(orders, totals, ["order_id"], "total", 150000.0), 4)


@query
def reconcile_summary(spark, sf_dir):
    return rounded(quality.reconcile_summary(reconcile_two_tables(spark, sf_dir)), 2)


# --- rollups and the labelled table -------------------------------------------------------------


@query
def enrich_items(spark, sf_dir):
    return rounded(delivery_tables(spark, sf_dir).enriched_items(), 6)


@query
def order_item_rollup(spark, sf_dir):
    return rounded(delivery_tables(spark, sf_dir).item_features(), 8)


@query
def payment_rollup(spark, sf_dir):
    return rounded(delivery_tables(spark, sf_dir).payment_features(), 8)


@query
def joined_orders(spark, sf_dir):
    return rounded(delivery_tables(spark, sf_dir).joined_orders(), 7)


@query
def model_dataset(spark, sf_dir):
    return rounded(delivery_tables(spark, sf_dir).model_dataset(), 8)


@query
def purchase_time_features(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in rollup.purchase_time("ts").items()])


@query
def duration_features(spark, sf_dir):
    later = F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 1000) / F.lit(10.0))
    moved = table(spark, sf_dir, "events").select("event_id", "ts", later.alias("later"))
    return rounded(
        moved.select(
            "event_id",
            seconds_between("ts", "later").alias("seconds"),
            hours_between("ts", "later").alias("hours"),
            days_between("later", "ts").alias("days"),
        ),
        9,
    )


def _derived(spark, sf_dir, names: list[str]) -> DataFrame:
    return rounded(derived.add_derived(model(spark, sf_dir), names).select("order_id", *names), 8)


@query
def calendar_flags(spark, sf_dir):
    return _derived(
        spark, sf_dir, ["is_weekend_purchase", "is_night_purchase", "is_business_hours", "cross_state_delivery"]
    )


@query
def cyclic_features(spark, sf_dir):
    """Over events, whose times cover all hours."""
    timed = table(spark, sf_dir, "events").select("event_id", *[c.alias(n) for n, c in rollup.purchase_time("ts").items()])
    names = [f"{prefix}_{part}" for prefix, *_ in derived.CYCLES for part in ("sin", "cos")]
    flags = ["is_weekend_purchase", "is_night_purchase", "is_business_hours"]
    return rounded(derived.add_derived(timed, [*names, *flags]).select("event_id", *names, *flags), 9)


@query
def multi_flags(spark, sf_dir):
    return _derived(spark, sf_dir, [name for name, _ in derived.MORE_THAN_ONE])


@query
def ratio_features(spark, sf_dir):
    names = [*[name for name, *_ in derived.RATIOS], "freight_per_kg", "photos_per_item", "promised_minus_shipping_window"]
    # Sums of at most four decimals, brought to the same bits before they are divided.
    inputs = model(spark, sf_dir).withColumns({c: F.round(c, 4) for c in MONEY})
    return derived.add_derived(inputs, names).select("order_id", *names)


@query
def log_features(spark, sf_dir):
    return _derived(spark, sf_dir, [name for name, _ in derived.LOGARITHMS])


@query
def reporting_groups(spark, sf_dir):
    grouped = derived.add_reporting_groups(model(spark, sf_dir))
    names = ["purchase_period", "delivery_scope", "multi_item_group", "multi_seller_group", derived.ROUTE]
    return grouped.select("order_id", *names)


@query
def route_frequency(spark, sf_dir):
    """Learned on the training part, applied to every order."""
    everything = derived.add_derived(split_model(spark, sf_dir), [derived.ROUTE])
    encoder = prep.FrequencyEncoder(inputCol=derived.ROUTE, outputCol=derived.ROUTE_FREQUENCY)
    fitted = encoder.fit(everything.where("split = 'train'"))
    return rounded(fitted.transform(everything).select("order_id", derived.ROUTE, derived.ROUTE_FREQUENCY), 9)


# --- reports ------------------------------------------------------------------------------------


@query
def status_distribution(spark, sf_dir):
    return profile.frequency(delivery_tables(spark, sf_dir).orders, "order_status")


@query
def type_distribution(spark, sf_dir):
    payments = delivery_tables(spark, sf_dir).payments
    totals = payments.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payment_rows"),
        F.count_distinct("order_id").alias("orders"),
        F.sum("payment_value").alias("total_value"),
    )
    return rounded(totals, 3)


@query
def label_share(spark, sf_dir):
    return rounded(profile.share_of_total(model(spark, sf_dir), LATE), 9)


@query
def date_range(spark, sf_dir):
    return profile.date_range(model(spark, sf_dir), BOUGHT)


@query
def largest_orders(spark, sf_dir):
    features = delivery_tables(spark, sf_dir).item_features()
    picked = features.select("order_id", "item_count", "unique_product_count", "unique_seller_count", "total_item_price")
    return rounded(reports.largest(picked, "item_count", "order_id"), 4)


@query
def most_payments(spark, sf_dir):
    features = delivery_tables(spark, sf_dir).payment_features()
    picked = features.select("order_id", "payment_count", "payment_type_count", "total_payment_value")
    return rounded(reports.largest(picked, "payment_count", "order_id"), 4)


@query
def earliest_orders(spark, sf_dir):
    joined = delivery_tables(spark, sf_dir).joined_orders()
    complete = joined.where("has_item_features = 1 and has_payment_features = 1")
    picked = complete.select("order_id", "order_status", "customer_state", "primary_seller_state", BOUGHT)
    return reports.earliest(picked, BOUGHT, "order_id")


# --- split --------------------------------------------------------------------------------------


@query
def chronological_split(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return split.chronological_split(orders, "o_orderdate", "o_orderkey")


@query
def split_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return split.chronological_split(events, "ts", "event_id", {"train": 0.5, "validation": 0.9})


@query
def split_summary(spark, sf_dir):
    return rounded(split.split_summary(split_model(spark, sf_dir), BOUGHT, "order_id", LATE, DAYS, CONTRACT.features), 6)


@query
def split_overlap(spark, sf_dir):
    """Customers with orders in more than one part."""
    return split.split_overlap(split_model(spark, sf_dir), "customer_id")


# --- profiles -----------------------------------------------------------------------------------


@query
def target_distribution(spark, sf_dir):
    return rounded(profile.target_distribution(model(spark, sf_dir), DAYS), 6)


@query
def line_quantiles(spark, sf_dir):
    from orderflow.operators.ordering import quantiles

    line = table(spark, sf_dir, "lineitem")
    return rounded(quantiles(line, "l_extendedprice", {"p25": 0.25, "median": 0.5, "p95": 0.95}, ["l_returnflag"]), 4)


@query
def numerical_summary(spark, sf_dir):
    return rounded(profile.numerical_summary(model(spark, sf_dir), SUMMARISED), 7)


@query
def categorical_summary(spark, sf_dir):
    grouped = derived.add_reporting_groups(model(spark, sf_dir))
    return rounded(profile.categorical_summary(grouped, [*GROUPED, derived.ROUTE]), 9)


@query
def suspicious_columns(spark, sf_dir):
    summary = profile.suspicious_columns(profile.numerical_summary(model(spark, sf_dir), [*SUMMARISED, "lateness_days"]))
    return rounded(summary.select("column_name", "minimum", "negative_count"), 6)


@query
def target_by_category(spark, sf_dir):
    grouped = derived.add_reporting_groups(model(spark, sf_dir))
    return rounded(profile.target_by_category(grouped, GROUPED, LATE, DAYS), 8)


@query
def target_by_quartile(spark, sf_dir):
    return rounded(profile.target_by_quartile(model(spark, sf_dir), NUMERICAL, LATE, DAYS), 8)


@query
def top_routes(spark, sf_dir):
    grouped = derived.add_reporting_groups(model(spark, sf_dir))
    return rounded(profile.target_by_top_category(grouped, derived.ROUTE, LATE, DAYS), 8)


@query
def group_target_top(spark, sf_dir):
    return rounded(profile.group_chart(model(spark, sf_dir), "customer_state", LATE, DAYS), 8)


@query
def monthly_trend(spark, sf_dir):
    return rounded(profile.monthly_trend(model(spark, sf_dir), BOUGHT, LATE, DAYS), 8)


@query
def histogram(spark, sf_dir):
    return rounded(profile.histogram(table(spark, sf_dir, "lineitem"), {"l_extendedprice": 50}), 4)


@query
def clipped_histogram(spark, sf_dir):
    return rounded(profile.histogram(model(spark, sf_dir), dict.fromkeys(MONEY, 35), clip=0.99), 4)


def _early_late(spark, sf_dir):
    ready = parts(spark, sf_dir)
    return ready["train"], ready["validation"]


@query
def numeric_drift(spark, sf_dir):
    return rounded(drift.numeric_drift(*_early_late(spark, sf_dir), NUMERICAL), 6)


@query
def event_drift(spark, sf_dir):
    """Values of the older half of the events against the newer ones."""
    ready = split.split_frames(split_events(spark, sf_dir), ["train", "validation", "test"])
    values = table(spark, sf_dir, "events").select("event_id", "value", F.col("user_id").cast("double").alias("user_id"))
    early, late = (values.join(ready[n].select("event_id"), "event_id", "left_semi") for n in ("train", "validation"))
    return rounded(drift.numeric_drift(early, late, ["value", "user_id"]), 6)


@query
def categorical_drift(spark, sf_dir):
    train, validation = _early_late(spark, sf_dir)
    return rounded(drift.categorical_drift(train, validation, CATEGORICAL), 9)


@query
def drift_ranking(spark, sf_dir):
    """The strongest drift over both kinds of columns."""
    train, validation = _early_late(spark, sf_dir)
    scores = drift.drift_summary(train, validation, NUMERICAL, CATEGORICAL)
    picked = scores.select("feature", "feature_type", "drift_score", "validation_unseen_rate")
    return rounded(reports.largest(picked, "drift_score", "feature"), 6)


@query
def outlier_columns(spark, sf_dir):
    """Columns with the most values beyond the outlier fences."""
    summary = profile.numerical_summary(model(spark, sf_dir), list(CONTRACT.numerical))
    return reports.largest(summary.select("column_name", "iqr_outlier_count"), "iqr_outlier_count", "column_name")


@query
def spearman_pairs(spark, sf_dir):
    return rounded(redundancy.spearman_pairs(model(spark, sf_dir), "order_id", RANKED), 7)


@query
def correlation_matrix(spark, sf_dir):
    """All numeric inputs and both targets. Sums and ratios are brought to the same bits before they are ranked."""
    inputs = rounded(model(spark, sf_dir).select("order_id", *SUMMARISED), 8)
    return rounded(redundancy.correlation_matrix(inputs, "order_id", SUMMARISED), 7)


@query
def duplicate_columns(spark, sf_dir):
    return redundancy.duplicate_columns(model(spark, sf_dir), CONTRACT.features)


# --- preparation --------------------------------------------------------------------------------

@query
def median_impute(spark, sf_dir):
    everything = split_model(spark, sf_dir)
    fitted = prep.ExactMedianImputer(inputCols=NUMERICAL).fit(everything.where("split = 'train'"))
    return rounded(fitted.transform(everything).select("order_id", *NUMERICAL), 8)


@query
def mode_impute(spark, sf_dir):
    """Learned on the smaller products, applied to all."""
    products = delivery_tables(spark, sf_dir).products
    columns = ["product_category_name", "product_weight_g"]
    fitted = prep.ModeImputer(inputCols=columns).fit(products.where("product_height_cm <= 10"))
    return fitted.transform(products).select("product_id", *columns)


@query
def standardize(spark, sf_dir):
    everything = split_model(spark, sf_dir)
    fitted = prep.Standardizer(inputCols=NUMERICAL).fit(everything.where("split = 'train'"))
    return rounded(fitted.transform(everything).select("order_id", *NUMERICAL), 7)


@query
def one_hot(spark, sf_dir):
    """Payment types learned without credit cards: those rows are all zeros."""
    data = model(spark, sf_dir)
    stages = prep.one_hot_stages(["primary_payment_type"])
    fitted = Pipeline(stages=stages).fit(data.where("primary_payment_type <> 'credit_card'"))
    labels = fitted.stages[0].labelsArray[0]
    slots = vector_to_array(F.col("primary_payment_type_hot"))
    encoded = fitted.transform(data).withColumn("_slots", slots)
    return encoded.select("order_id", *[F.col("_slots")[i].cast("int").alias(f"is_{x}") for i, x in enumerate(labels)])


@query
def class_weights(spark, sf_dir):
    return rounded(prep.class_weights(parts(spark, sf_dir)["train"], LATE), 9)


# --- evaluation ---------------------------------------------------------------------------------


def _classified(spark, sf_dir):
    return scored_lines(spark, sf_dir).withColumn("prediction", evaluate.predict_class("score", 0.65))


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_classified(spark, sf_dir), "label", "prediction")


@query
def classification_metrics(spark, sf_dir):
    return rounded(evaluate.classification_metrics(_classified(spark, sf_dir), "label", "prediction"), 9)


@query
def classification_report(spark, sf_dir):
    return rounded(evaluate.classification_report(_classified(spark, sf_dir), "label", "prediction"), 9)


@query
def roc_auc(spark, sf_dir):
    return rounded(evaluate.roc_auc(scored_lines(spark, sf_dir), "score", "label"), 9)


@query
def score_coverage(spark, sf_dir):
    """Payments as scores: some are missing, and some labels are neither 0 nor 1."""
    line = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") % 5 != 0, F.col("l_discount")).alias("score"),
        F.when(F.col("l_orderkey") % 11 != 0, (F.col("l_partkey") % 3).cast("int")).alias("label"),
        "l_returnflag",
    )
    return evaluate.score_coverage(line, "score", "label", ["l_returnflag"])


@query
def average_precision(spark, sf_dir):
    return rounded(evaluate.average_precision(scored_lines(spark, sf_dir), "score", "label"), 9)


@query
def pr_curve(spark, sf_dir):
    return rounded(evaluate.pr_curve(scored_lines(spark, sf_dir), "score", "label"), 9)


@query
def threshold_sweep(spark, sf_dir):
    return rounded(evaluate.threshold_sweep(scored_lines(spark, sf_dir), "score", "label"), 9)


@query
def best_threshold(spark, sf_dir):
    return rounded(evaluate.best_threshold(evaluate.threshold_sweep(scored_lines(spark, sf_dir), "score", "label")), 9)


@query
def regression_metrics(spark, sf_dir):
    guessed = model(spark, sf_dir).withColumn("guess", (15 + F.col("order_id") % 17).cast("double"))
    return rounded(evaluate.regression_metrics(guessed, DAYS, "guess"), 8)


# --- models -------------------------------------------------------------------------------------

# All base families and the penalised linear ones, at their full settings.
COMPARED_REGRESSORS = {**REGRESSORS, **{n: ENGINEERED_REGRESSORS[n] for n in ("ridge", "ridge_log_target", "elastic_net")}}


_models: dict[tuple, tuple] = {}


def _fitted(spark, sf_dir):
    """Both comparisons; models are trained once and then frozen."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        ready = parts(spark, sf_dir)
        prepared = prepare(CONTRACT, ready["train"], ready["validation"])
        _models[key] = (
            compare_classifiers(prepared, CLASSIFIERS),
            compare_regressors(prepared, COMPARED_REGRESSORS),
        )
    return _models[key]


@query
def baseline_models(spark, sf_dir):
    """Both constant models, learned on train and measured on validation."""
    ready = parts(spark, sf_dir)
    train = ready["train"]
    prior = fit_classifier("dummy_classifier", {}, train.select(F.col(LATE).alias(LABEL)))
    middle = fit_regressor("dummy_regressor", {}, train.select(F.col(DAYS).alias(LABEL)))
    guessed = middle.transform(prior.transform(ready["validation"]))
    return rounded(
        guessed.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("score").alias("late_probability"),
            F.max("prediction").alias("days"),
            F.avg(F.abs(F.col(DAYS) - F.col("prediction"))).alias("mae"),
        ),
        8,
    )


@query
def linear_model(spark, sf_dir):
    """Least squares of the payment on the item price, learned on train and applied to validation."""
    ready = parts(spark, sf_dir)
    vector = VectorAssembler(inputCols=["total_item_price"], outputCol="features")
    train = vector.transform(ready["train"]).select("features", F.col("total_payment_value").alias(LABEL))
    fitted = fit_regressor("linear_regression", {}, train)
    return rounded(fitted.transform(vector.transform(ready["validation"])).select("order_id", "prediction"), 4)


@query
def model_compare(spark, sf_dir):
    late, days = _fitted(spark, sf_dir)
    return late.metrics.select("model_name", "pr_auc", "roc_auc", "f1_score").unionByName(
        days.metrics.select("model_name", "mae", "rmse", "r2_score"), allowMissingColumns=True
    )


@query
def score_batch(spark, sf_dir):
    late, days = _fitted(spark, sf_dir)
    scorer = Scorer(CONTRACT, late.best_pipeline, days.best_pipeline, 0.65)
    return scorer.score(parts(spark, sf_dir)["test"], ["order_id"])


ORDER_RECORD = FeatureContract(("o_orderkey",), (), ("quantity", "amount"), LATE, DAYS)


@query
def reject_records(spark, sf_dir):
    """Payloads made of all orders: whole numbers written as 2.0 are accepted; text, fractions and infinity for a number,
    missing names and payloads that aren't JSON are sent back."""
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 7
    whole = key.cast("string")
    quantity = (
        F.when(kind == 0, F.concat(F.lit('"quantity": '), whole, F.lit(".0, ")))
        .when(kind == 1, F.lit('"quantity": "abc", '))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.lit('"quantity": null, '))
        .when(kind == 5, F.lit('"quantity": 2.5, '))
        .otherwise(F.concat(F.lit('"quantity": '), whole, F.lit(", ")))
    )
    price = F.coalesce(F.col("o_totalprice").cast("string"), F.lit("null"))
    amount = F.when(key % 5 == 0, F.lit('"Infinity"')).otherwise(price)
    body = F.concat(F.lit("{"), quantity, F.lit('"amount": '), amount, F.lit("}"))
    payloads = table(spark, sf_dir, "orders").select(key, F.when(kind == 4, F.lit("not json")).otherwise(body).alias("body"))
    accepted, rejected = split_records(payloads, "body", ORDER_RECORD, {"quantity": "bigint", "amount": "double"})
    names = [F.concat_ws(",", c).alias(c) for c in ("missing_features", "invalid_features")]
    back = rejected.select("o_orderkey", F.lit("rejected").alias("status"), *names)
    fine = accepted.withColumns({"status": F.lit("accepted"), "missing_features": F.lit(""), "invalid_features": F.lit("")})
    return fine.unionByName(back, allowMissingColumns=True)
